"""Sums of doubles that don't depend on the order in which a shuffle brings the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Twelve places, and sixteen digits before them: sums of as many rows as there are stay exact.
KIND = "decimal(28,12)"


#: The largest count that a value is multiplied by, so that the product has all its places.
MOST = 999_999_999


def counted(rows: DataFrame, times: str) -> DataFrame:
    """``rows`` with counts of at most ``MOST``: a larger one becomes several rows."""
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{times}` - 1) div {MOST}")))
    return rows.withColumn("__part", part).withColumn(times, F.least(F.lit(MOST).cast("long"), F.col(times) - F.col("__part") * MOST)).drop("__part")


def mean(value: Column | str, times: str | None = None) -> Column:
    """The mean of the known values, from their exact sum: the last bit is the same for any order of rows. NULL without one.

    With ``times`` (a column of ``counted``) each value counts as often as that says.
    """
    x = F.col(value) if isinstance(value, str) else value
    if times is None:
        return F.try_divide(F.sum(x.cast(KIND)).cast("double"), F.count(x))
    total = F.sum(x.cast(KIND) * F.col(times).cast("decimal(9,0)"))
    return F.try_divide(total.cast("double"), F.sum(F.when(x.isNotNull(), F.col(times))))
