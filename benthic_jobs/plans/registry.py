"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .carriers import with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = with_ctes(sql)
        return f

    return keep


def rounded(c: Column | str, digits: int) -> Column:
    """Half away from zero on the scaled double, as the oracle's engine rounds; decimal rounding differs on ties.

    The whole part stays a double: as a long it would end at 2**63, which a value with a denominator near 0 is above.
    """
    x = F.col(c) if isinstance(c, str) else c
    y = F.abs(x.cast("double")) * float(10**digits)
    scaled = (y - y % 1.0 + F.when(y % 1.0 >= 0.5, 1.0).otherwise(0.0)) / float(10**digits)
    return F.when(y < float("inf"), F.when(x < 0, -scaled).otherwise(scaled)).otherwise(x.cast("double"))


def mean_sql(x: str) -> str:
    """The exact mean of ``functions.exact`` in the oracle's words."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(28, 12))) AS DOUBLE) / count({x}))"
