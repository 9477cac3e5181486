"""Unions and range prunes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame], after: tuple[str, str] | None = ("Station", "Location")) -> DataFrame:
    """Frames with different columns, missing ones NULL; the first name of ``after`` stands behind the second."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    names = out.columns
    if after and set(after) <= set(names):
        names.remove(after[0])
        names.insert(names.index(after[1]) + 1, after[0])
    return out.select(*names)


def relabel(rows: DataFrame, location: str = "Location", station: str = "Station") -> DataFrame:
    """The station becomes part of the location's name."""
    named = F.concat_ws(" ", location, F.lit("Station"), F.col(station).cast("string"))
    return rows.withColumn(location, F.when(F.col(station).isNull(), F.col(location)).otherwise(named)).drop(station)


def in_service(pairs: DataFrame, service: DataFrame) -> DataFrame:
    """(satellite, window_start, window_end) that overlap the satellite's life; an open end is still in service."""
    rows = pairs.join(F.broadcast(service), "satellite")  # a row for each satellite
    alive = (F.col("window_end") >= F.col("first_day")) & (F.col("last_day").isNull() | (F.col("window_start") <= F.col("last_day")))
    return rows.where(alive).select(*pairs.columns)
