"""Pixels at points: cell lookups, window means, clear shares and median composites.

The list of wanted cells is built first and joined with the pixels on (scene, row, column); pixels are never
collected round a point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact
from .ranks import quantiles


def cell_of(lon: Column, lat: Column, west: float, north: float, size: float) -> tuple[Column, Column]:
    """(row, column) of the cell that holds the point; row 0 is the northernmost."""
    return F.floor((north - lat) / size).cast("int"), F.floor((lon - west) / size).cast("int")


def nearest_cell(lon: Column, lat: Column, first_lon: float, first_lat: float, step: float) -> tuple[Column, Column]:
    """(row, column) of the nearest grid point of a grid that runs east and south."""
    return F.round((first_lat - lat) / step).cast("int"), F.round((lon - first_lon) / step).cast("int")


def at_cells(points: DataFrame, pixels: DataFrame, on: list[str], value: str) -> DataFrame:
    """The pixel of each point's cell, NULL where there is none."""
    return points.join(pixels.select(*on, value), on, "left")


def window_mean(points: DataFrame, pixels: DataFrame, point_id: str, scene: str, row: str, col: str, value: str, *, radius: int = 1, valid: Column | None = None) -> DataFrame:
    """The mean of valid pixels in the square of ``radius`` cells round each point, NULL without any."""
    step = F.sequence(F.lit(-radius), F.lit(radius))
    wanted = points.select(point_id, scene, F.col(row).alias("__r"), F.col(col).alias("__c"))
    wanted = wanted.withColumn("__i", F.explode(step)).withColumn("__j", F.explode(step))
    wanted = wanted.select(point_id, scene, (F.col("__r") + F.col("__i")).alias(row), (F.col("__c") + F.col("__j")).alias(col))
    good = pixels if valid is None else pixels.where(valid)
    mean = wanted.join(good.select(scene, row, col, value), [scene, row, col]).groupBy(point_id).agg(F.avg(value).alias(value))
    return points.join(mean, point_id, "left")


def clear_fraction(pixels: DataFrame, keys: list[str], clear: Column, score: Column) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.avg(clear.cast("double")).alias("clear_fraction"), exact.mean(score).alias("mean_score"))


def turbidity_index(pixels: DataFrame, aoi: str, cell: list[str], red: str, green: str) -> DataFrame:
    """The mean over an area of (r - g) / (r + g) of the per-pixel medians over all scenes.

    Both bands' medians come from one count of equal values, so no task holds a pixel's values. An area without any has NULL.
    """
    keys = [aoi, *cell]
    each = [F.struct(F.lit(name).alias("__band"), F.col(c).cast("double").alias("__v")) for name, c in (("r", red), ("g", green))]
    long = pixels.select(*keys, F.inline(F.array(*each)))
    halves = quantiles(long, [*keys, "__band"], "__v", {"__m": 0.5})
    medians = halves.groupBy(*keys).agg(*(F.max(F.when(F.col("__band") == b, F.col("__m"))).alias(b) for b in ("r", "g")))
    medians = medians.unionByName(pixels.select(aoi).distinct(), allowMissingColumns=True)
    return medians.groupBy(aoi).agg(exact.mean(F.try_divide(F.col("r") - F.col("g"), F.col("r") + F.col("g"))).alias("turbidity_index"))
