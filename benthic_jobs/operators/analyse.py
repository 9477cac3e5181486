"""Numbers behind a data set's report: bias, histograms, gaps, alignment, rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.sensors import MATCHED
from ..storage import stored
from .matching import day_of, neighbours, seeded
from .ranks import quantiles, running_totals


def matched_bands(low: DataFrame, high: DataFrame, pairs: list[tuple[str, str]] = MATCHED) -> DataFrame:
    """(location_id, band, mean) of both sensors, paired by band: ``diff`` is high minus low."""
    table = F.broadcast(low.sparkSession.createDataFrame(pairs, "lr_band string, hr_band string"))
    a = low.select("location_id", F.col("band").alias("lr_band"), F.col("mean").alias("lr")).join(table, "lr_band")
    b = high.select("location_id", F.col("band").alias("hr_band"), F.col("mean").alias("hr"))
    return a.join(b, ["location_id", "hr_band"]).withColumn("diff", F.col("hr") - F.col("lr"))


def patch_statistics(pixels: DataFrame, keys: list[str], value: str, valid: Column) -> DataFrame:
    """Mean of the valid values clipped to [0, 1], and the share that reaches 1 before the clip."""
    v = F.col(value)
    good = pixels.where(valid & v.isNotNull() & ~F.isnan(v.cast("double")))
    return good.groupBy(*keys).agg(
        exact.mean(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))).alias("mean"), F.avg((v >= 1).cast("double")).alias("clip_frac")
    )


def clip_rates(stats: DataFrame) -> DataFrame:
    return stats.groupBy("band").agg(exact.mean("clip_frac").alias("mean_clip"), F.max("clip_frac").alias("max_clip"))


def histogram(rows: DataFrame, keys: list[str], value: str, low: Column, high: Column, bins: int, *, density: bool = False) -> DataFrame:
    """Equal bins on [low, high]; the last one is closed on the right. ``n`` or, for a density, ``density`` by bin."""
    v = F.col(value)
    at = F.least(F.floor((v - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    counts = rows.where((v >= low) & (v <= high)).groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("n"), F.first(high - low).alias("__w"))
    if not density:
        return counts.drop("__w")
    total = F.sum("n").over(Window.partitionBy(*keys))  # ``bins`` rows for each key
    return counts.select(*keys, "bin", (F.col("n") / total / (F.col("__w") / bins)).alias("density"))


def time_gap(high: DataFrame, low: DataFrame) -> DataFrame:
    """Least days between a high-resolution date and a low-resolution one, of each location that has both."""
    days = lambda rows, c: rows.select("location_id", day_of(c).alias("__d")).distinct()
    near = neighbours(days(high, "hr_date"), days(low, "lr_date").withColumn("low", F.lit(1)), ["location_id"], ["low"])
    gap = F.least(*(F.abs(F.col(f"low_{side}.__d") - F.col("__d")) for side in "az"))
    return near.groupBy("location_id").agg(F.min(gap).alias("gap_days")).where("gap_days IS NOT NULL")


def alignment_summary(shifts: DataFrame, keys: list[str], magnitude: str) -> DataFrame:
    m = F.col(magnitude)
    shares = shifts.groupBy(*keys).agg(
        F.avg((m > 3).cast("double")).alias("share_over_3"), *(F.avg((m <= x).cast("double")).alias(f"share_to_{x}") for x in (1, 3, 10))
    )
    return quantiles(shifts, keys, magnitude, {"median_px": 0.5, "p95_px": 0.95}).join(shares, keys)


def worst(rows: DataFrame, value: str, key: str, n: int = 6) -> DataFrame:
    return rows.orderBy(F.desc_nulls_last(value), key).limit(n)


def random_subset(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in the order of a seeded hash."""
    return rows.orderBy(seeded(F.col(key), seed), key).limit(n)


def rolling_bias(rows: DataFrame, gap: str, bias: str, key: str, *, least: int = 5) -> DataFrame:
    """Centred mean of ``bias`` in the order of ``gap`` over ``max(30, n div 20)`` rows; NULL with under ``least``.

    A window is the difference of two running totals, which are found by their row numbers: no frame is summed anew. The
    totals are decimals of twelve places, so that they are exact however long they run.
    """
    known = F.col(bias).isNotNull()
    totals = {"__i": F.lit(1).cast("long"), "__s": F.coalesce(F.col(bias).cast("decimal(28,12)"), F.lit(0)), "__n": known.cast("long")}
    ranked = stored(running_totals(rows, [gap, key], totals), "rolling")
    n = ranked.count()
    width = max(30, n // 20)
    end = lambda side: ranked.select(F.col("__i").alias(f"__{side}"), F.col("__s").alias(f"__s{side}"), F.col("__n").alias(f"__n{side}"))
    asked = ranked.withColumns({"__z": F.col("__i") + (width - 1) // 2, "__a": F.col("__i") - width // 2 - 1})
    last = ranked.where(F.col("__i") == n).select(F.col("__s").alias("__s_all"), F.col("__n").alias("__n_all"))  # one row
    both = asked.join(end("z"), "__z", "left").join(end("a"), "__a", "left").crossJoin(F.broadcast(last))  # past the end: the total
    inside = lambda c: F.coalesce(f"__{c}z", f"__{c}_all") - F.coalesce(f"__{c}a", F.lit(0))
    mean = F.when(inside("n") >= least, inside("s").cast("double") / inside("n"))
    return both.select(*rows.columns, mean.alias("rolling"))
