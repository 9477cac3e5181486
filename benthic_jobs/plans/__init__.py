"""Queries over the given tables, one for each operator, with the SQL that they must equal."""

from . import q_aggregates, q_functions, q_joins, q_rasters, q_sources, q_windows, workloads  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
