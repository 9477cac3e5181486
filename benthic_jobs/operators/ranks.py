"""Global order without a global task: running totals, row numbers and exact quantiles by sorted ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored


def running_totals(rows: DataFrame, order: list, values: dict[str, Column]) -> DataFrame:
    """``rows`` with the sum of each value up to the row in a global order: ranges are summed, then go on from their offsets.

    The rows are sorted in ranges, as many as the session's shuffle partitions and the data's size ask for, so no single
    task sees them all; equal keys of the order must not matter.
    """
    names = {name: f"__v{i}" for i, name in enumerate(values)}
    ranged = rows.withColumns({names[name]: value for name, value in values.items()})
    ranged = stored(ranged.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("__p").agg(*(F.sum(v).alias(v) for v in names.values()))  # a row for each range
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("__p", *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}_base") for v in names.values()))
    upto = Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumns({f"{v}_own": F.sum(v).over(upto) for v in names.values()})
    joined = within.join(F.broadcast(base), "__p")
    done = joined.withColumns({name: F.col(f"{v}_base") + F.col(f"{v}_own") for name, v in names.items()})
    return done.drop("__p", *(f"{v}{end}" for v in names.values() for end in ("", "_base", "_own")))


def running_total(rows: DataFrame, order: list, value: Column, name: str) -> DataFrame:
    return running_totals(rows, order, {name: value})


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Global row numbers from 1."""
    return running_total(rows, order, F.lit(1).cast("long"), name)


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(keys, one column for each share): exact quantiles with linear interpolation; nulls don't count.

    Values are counted first, so a value that most rows have is one row, and the counts are summed up in one order of all keys.
    A value then owns an interval of places in its key, and the wanted places are found in it: no task holds the values of a
    key, and no value is more than a row. Keys without a value have no row.
    """
    x = F.col(value).cast("double")
    counts = rows.where(x.isNotNull()).groupBy(*keys, (x + F.lit(0.0)).alias("__x")).agg(F.count("*").alias("__c"))  # one zero, not two
    counts = stored(running_total(counts, [*keys, "__x"], F.col("__c"), "__upto"), "counted")
    begin = F.col("__upto") - F.col("__c")
    ends = counts.groupBy(*keys).agg(F.min(begin).alias("__first"), F.sum("__c").alias("__n"))
    if keys:
        names = [f"__k{i}" for i in range(len(keys))]
        same = F.lit(True)
        for k, n in zip(keys, names):
            same = same & F.col(k).eqNullSafe(F.col(n))
        placed = counts.join(ends.withColumnsRenamed(dict(zip(keys, names))), same)  # a row for each key
    else:
        placed = counts.crossJoin(F.broadcast(ends))  # one row
    held = lambda place: F.max(F.when((place >= begin - F.col("__first")) & (place < F.col("__upto") - F.col("__first")), F.col("__x")))
    found = []
    for i, p in enumerate(shares.values()):
        at = (F.col("__n") - 1) * float(p)
        found += [held(F.floor(at)).alias(f"__l{i}"), held(F.ceil(at)).alias(f"__h{i}"), F.max(at - F.floor(at)).alias(f"__f{i}")]
    low = lambda i: F.col(f"__l{i}") + (F.col(f"__h{i}") - F.col(f"__l{i}")) * F.col(f"__f{i}")
    ends = placed.groupBy(*keys).agg(*found, F.count("*").alias("__any")).where("__any > 0")
    return ends.select(*keys, *(low(i).alias(name) for i, name in enumerate(shares)))
