"""Reflectance, spectral indices and water-column corrections. NULL in, or a denominator of 0, gives NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sensors import BANDS, FORMULAS, INDICES, KD, LYZENGA, ROLES, bands


def reflectance(pixels: DataFrame, rows: list[tuple] = BANDS) -> DataFrame:
    """``pixels`` (sensor, scene_id, band, dn) with ``value``: scaled, if the scene has all bands of its sensor.

    ``rows`` are those of ``sensors.BANDS``, with more for a new sensor. Quality bands pass through. With a band count other than the sensor's, all bands stay unscaled.
    """
    table = bands(pixels.sparkSession, rows)
    expected = table.groupBy("sensor").agg(F.count("*").alias("expected"))
    counted = pixels.groupBy("sensor", "scene_id").agg(F.count_distinct("band").alias("found"))
    whole = counted.join(F.broadcast(expected), "sensor").where("found = expected").select("sensor", "scene_id", F.lit(True).alias("whole"))
    joined = pixels.join(whole, ["sensor", "scene_id"], "left").join(F.broadcast(table), ["sensor", "band"], "left")
    scaled = F.when(F.col("whole") & ~F.col("is_qa"), F.col("dn") * F.col("scale") + F.col("offset"))
    return joined.withColumn("value", F.coalesce(scaled, F.col("dn").cast("double")))


def scale(dn: Column, factor: float, offset: float = 0.0) -> Column:
    return dn * F.lit(factor) + F.lit(offset)


def normalised_difference(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def indices(
    sensor: str, prefix: str, *, roles: dict[str, dict[str, str]] = ROLES, formulas: list[tuple[str, str, str, float]] = FORMULAS, names: dict[str, list[str]] = INDICES
) -> dict[str, Column]:
    """All indices of a sensor over columns named ``<prefix><band>``: the formulas' roles become its bands, and a denominator of 0 NULL.

    Sensors, roles and formulas are rows; a formula that asks for a role which the sensor doesn't have is an error.
    """
    band = lambda m: f"`{prefix}{roles[sensor][m[0]]}`"
    bound = lambda text: re.sub(r"\b[a-z_]+\b", band, text)
    known, out = {name: rest for name, *rest in formulas}, {}
    for name in names[sensor]:
        above, below, more = known[name]
        value = F.try_divide(F.expr(bound(above)), F.expr(bound(below)))
        out[name] = value + F.lit(more) if more else value
    return out


def depth_invariant(sensor: str, prefix: str) -> dict[str, Column]:
    """Log ratios of band pairs; both bands must be positive."""
    out = {}
    for a, b, k in LYZENGA[sensor]:
        x, y = F.col(prefix + a), F.col(prefix + b)
        out[f"lyzenga_{a}{b}"] = F.when((x > 0) & (y > 0), F.log(x) - k * F.log(y))
    return out


def bottom_reflectance(value: Column, depth: Column, kd: Column) -> Column:
    """Two-way attenuation taken out, at most 1; needs a positive depth and attenuation."""
    return F.when((depth > 0) & (kd > 0) & value.isNotNull(), F.least(value * F.exp(2 * kd * depth), F.lit(1.0)))


def bottom_reflectances(sensor: str, prefix: str, depth: Column, kd: dict[str, float] | dict[str, Column] | None = None) -> dict[str, Column]:
    """Of each band; the attenuation is the sensor's, or given as numbers or, for a site's own, as columns."""
    return {f"bottom_{b}": bottom_reflectance(F.col(prefix + b), depth, F.lit(k)) for b, k in (kd or KD[sensor]).items()}


def site_attenuation(rows: DataFrame, table: DataFrame, keys: list[str], sensor: str) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` with their site's attenuation (columns ``kd_<band>`` of ``table``), and those columns, the sensor's where it has none."""
    joined = rows.join(table, keys, "left")
    kd = {b: F.coalesce(F.col(f"kd_{b}"), F.lit(k)) if f"kd_{b}" in table.columns else F.lit(k) for b, k in KD[sensor].items()}
    return joined, kd


def glint_slopes(pixels: DataFrame, scene: str, nir: str, band_cols: list[str]) -> DataFrame:
    """Per scene the least near infrared and each band's regression slope on it."""
    slopes = [F.regr_slope(b, nir).alias(f"slope_{b}") for b in band_cols]
    return pixels.groupBy(scene).agg(F.min(nir).alias("nir_min"), *slopes)


def deglint(value: Column, slope: Column, nir: Column, nir_min: Column) -> Column:
    """Unchanged where the near infrared is missing."""
    return F.coalesce(value - slope * (nir - nir_min), value)


def turbidity_class(index: Column) -> Column:
    return F.when(index < -1, None).when(index < 0.03, "clear").when(index < 0.08, "moderate").when(index.isNotNull(), "turbid")


def bit(word: Column, position: int) -> Column:
    return F.shiftright(word.cast("int"), position).bitwiseAND(F.lit(1)) == 1


def depth_with_source(least_ft: Column, most_ft: Column, bin_name: Column) -> tuple[Column, Column]:
    """Metres from measured feet (the middle), else the middle of the depth bin, and which it was."""
    measured = (least_ft + most_ft) / 2 * 0.3048
    by_bin = F.when(bin_name == "Shallow", 3.0).when(bin_name == "Mid", 12.0).when(bin_name == "Deep", 24.0)
    source = F.when(measured.isNotNull(), "measured").when(by_bin.isNotNull(), "depth_bin")
    return F.coalesce(measured, by_bin), source


def bathymetry_depth(elevation: Column, nodata: Column | None = None) -> Column:
    depth = F.greatest(-elevation, F.lit(0.0))
    return F.when(elevation.isNotNull() & (F.lit(True) if nodata is None else elevation != nodata), depth)


def bottom_visible(habitat: Column, kd490: Column) -> Column:
    """Coral and seagrass where the water is clear or unknown; all else always."""
    return ~F.coalesce(habitat.isin("coral", "seagrass"), F.lit(False)) | F.coalesce(kd490 <= 0.3, F.lit(True))
