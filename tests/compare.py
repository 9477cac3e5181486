"""Comparison of a query's rows with its SQL in DuckDB, as multisets."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def same(df, sql: str, sf_dir: str) -> None:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    types = dict(con.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    columns = sorted(df.columns)
    assert columns == sorted(types)
    for name, kind in df.dtypes:
        assert TYPES.get(kind, types[name]) == types[name], name
    order = list(types)
    theirs = Counter(repr(tuple(norm(r[order.index(c)]) for c in columns)) for r in con.execute(sql).fetchall())
    mine = Counter(repr(tuple(norm(v) for v in r)) for r in df.select(*(f"`{c}`" for c in columns)).collect())
    assert mine == theirs, (list((mine - theirs))[:3], list((theirs - mine))[:3])
