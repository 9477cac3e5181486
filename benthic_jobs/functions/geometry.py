"""Places and seasons: transects, UTM zones and patches, season ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996
_N = _F / (2 - _F)
_E = np.sqrt(_F * (2 - _F))
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
#: The Kruger series to the fourth power of the third flattening, forward and back.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
          61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
         17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
PATCH = "epsg int, x double, y double, origin_x double, origin_y double, west double, south double, east double, north double"


def interpolate(site_m: Column, length_m: Column, start: Column, end: Column) -> Column:
    """Along a transect; positions behind its end count as the end."""
    return start + F.least(site_m / length_m, F.lit(1.0)) * (end - start)


def utm_zone(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("int") + 1


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)


def season(day: Column) -> Column:
    return F.floor((F.month(day) - 1) / 3).cast("int")


def season_range(year: Column, first_month: int, last_month: int) -> tuple[Column, Column]:
    """First day, and first day after; a range that ends before it begins runs into the next year."""
    start = F.make_date(year, F.lit(first_month), F.lit(1))
    end_year = year + (1 if last_month < first_month else 0)
    return start, F.add_months(F.make_date(end_year, F.lit(last_month), F.lit(1)), 1)


def utm_forward(lon: np.ndarray, lat: np.ndarray, zone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    turn, phi = np.radians(lon - (zone * 6 - 183)), np.radians(lat)
    t = np.sinh(np.arctanh(np.sin(phi)) - _E * np.arctanh(_E * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(turn)), np.arcsinh(np.sin(turn) / np.hypot(t, np.cos(turn)))
    x = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    y = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return 500000 + _K0 * _RADIUS * x, _K0 * _RADIUS * y + np.where(lat < 0, 1e7, 0)


def utm_back(x: np.ndarray, y: np.ndarray, zone: np.ndarray, south: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xi, eta = (y - np.where(south, 1e7, 0)) / (_K0 * _RADIUS), (x - 500000) / (_K0 * _RADIUS)
    xi2 = xi - sum(b * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    eta2 = eta - sum(b * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    tau = np.sin(xi2) / np.hypot(np.sinh(eta2), np.cos(xi2))
    t = tau.copy()
    for _ in range(6):  # Newton steps from the conformal to the geographic latitude
        sigma = np.sinh(_E * np.arctanh(_E * t / np.sqrt(1 + t * t)))
        now = t * np.sqrt(1 + sigma**2) - sigma * np.sqrt(1 + t * t)
        slope = (1 - _E**2) * np.sqrt((1 + now**2) * (1 + t * t)) / (1 + (1 - _E**2) * t * t)
        t = t + (tau - now) / slope
    return np.degrees(np.arctan2(np.sinh(eta2), np.cos(xi2))) + zone * 6 - 183, np.degrees(np.arctan(t))


def patch_geometry(lon: Column, lat: Column, size_m: float) -> Column:
    """The square of ``size_m`` round a point in its UTM zone, and its extent in degrees; NULL without a point."""

    @F.pandas_udf(PATCH)
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lons, lats in batches:
            lo, la = lons.to_numpy(float), lats.to_numpy(float)
            zone = np.floor((np.nan_to_num(lo) + 180) / 6).astype(int) + 1
            x, y = utm_forward(lo, la, zone)
            west, south = x - size_m / 2, y - size_m / 2
            corners = [utm_back(west + i * size_m, south + j * size_m, zone, la < 0) for i in (0, 1) for j in (0, 1)]
            lon4, lat4 = np.stack([c[0] for c in corners]), np.stack([c[1] for c in corners])
            epsg = np.where(la >= 0, 32600, 32700) + zone
            yield pd.DataFrame({
                "epsg": epsg, "x": x, "y": y, "origin_x": west, "origin_y": south,
                "west": lon4.min(0), "south": lat4.min(0), "east": lon4.max(0), "north": lat4.max(0),
            })

    return F.when(lon.isNotNull() & lat.isNotNull(), place(lon.cast("double"), lat.cast("double")))
