"""Inputs of the library's jobs derived from the given tables, once in SQL for both engines.

``carrier(spark, sf_dir, name)`` gives a DataFrame; ``with_ctes(sql, ...)`` puts the same views in front of an oracle query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()

_PIXELS = """
SELECT vec_id, label, CAST(vec_id % 8 AS INT) AS band, CAST(@div(vec_id, 8) AS BIGINT) AS scene_id,
       CAST(@div(pos, 8) AS INT) AS prow, CAST(pos % 8 AS INT) AS pcol,
       CASE WHEN vec_id % 29 = 0 OR (vec_id + pos) % 13 = 0 THEN 0
            ELSE CAST(FLOOR((CAST(v AS DOUBLE) + 1.0) * 5000.0) AS INT) END AS dn
FROM @values
"""

SQL = {
    "obs": """
        SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                         CAST(l_suppkey AS STRING), CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) AS STRING)) AS obs_id,
               l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_shipdate AS DATE) AS obs_date,
               CAST(l_suppkey AS INT) AS tile, CASE WHEN l_linenumber % 2 = 0 THEN 'S2' ELSE 'LS' END AS sensor,
               l_quantity AS site_m, CAST((l_quantity - 5) * 0.5 AS DOUBLE) AS depth_m,
               CAST(-82.9 + (l_suppkey % 100) * 0.005 AS DOUBLE) AS lon, CAST(27.4 + (l_partkey % 100) * 0.005 AS DOUBLE) AS lat
        FROM lineitem""",
    "scenes": """
        SELECT o_orderkey AS scene_id, CAST(o_custkey % (SELECT count(*) FROM supplier) AS INT) AS tile,
               CASE WHEN o_orderstatus = 'F' THEN 'LS' ELSE 'S2' END AS sensor, CAST(o_orderdate AS DATE) AS acq_date,
               CAST(o_orderkey % 24 AS INT) AS acq_hour, CAST(FLOOR(o_totalprice) % 100 AS DOUBLE) AS cloud_cover,
               CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(1.0 - (FLOOR(o_totalprice) % 100) / 100.0 AS DOUBLE) END AS clear_score
        FROM orders""",
    "annotations": """
        SELECT l_suppkey AS site, l_orderkey AS image, CAST(s_nationkey % 8 AS INT) AS island,
               CASE l_suppkey % 3 WHEN 0 THEN 'Shallow' WHEN 1 THEN 'Mid' ELSE 'Deep' END AS depth_bin,
               CASE WHEN l_suppkey % 2 = 0 THEN CAST(10 + l_suppkey % 40 AS DOUBLE) END AS min_depth_ft,
               CASE WHEN l_suppkey % 2 = 0 THEN CAST(12 + l_suppkey % 40 AS DOUBLE) END AS max_depth_ft,
               CASE WHEN p_type = 'PROMO' THEN 'Tape and wand' WHEN p_size % 17 = 0 THEN NULL ELSE p_type END AS category,
               p_name AS subcategory, CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_brand END AS genus,
               CAST(l_linenumber AS INT) AS analyst, CAST(l_shipdate AS DATE) AS survey_date
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "trees": """
        SELECT concat(l_returnflag, l_linestatus) AS site, CAST(l_suppkey % 50 AS INT) AS plot_no,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS INT) END AS tree_no, l_quantity AS dbh_cm,
               CAST(l_extendedprice / 10000.0 AS DOUBLE) AS height_m, p_name AS species,
               CASE l_linenumber % 3 WHEN 0 THEN 'Dead' WHEN 1 THEN 'Live' END AS comment, l_orderkey, l_partkey, l_suppkey
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "samples": """
        SELECT c_custkey AS location_id,
               CASE c_nationkey % 4 WHEN 0 THEN 'coral' WHEN 1 THEN 'seagrass' WHEN 2 THEN 'mangrove' END AS habitat_class,
               CAST(-60 + c_custkey % 121 AS DOUBLE) AS latitude, CAST(-180 + (c_custkey * 7) % 360 AS DOUBLE) AS longitude,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal / 100 END AS depth_m, CAST(c_custkey % 9 AS INT) AS lowres_count,
               c_mktsegment AS segment, CAST(c_custkey % (SELECT count(*) FROM supplier) AS INT) AS tile
        FROM customer""",
    "cells": """
        SELECT DISTINCT CASE l_linenumber % 3 WHEN 0 THEN 'coral' WHEN 1 THEN 'seagrass' ELSE 'mangrove' END AS habitat,
               CAST(l_partkey % 660 AS INT) AS grid_row, CAST(l_orderkey % 1400 AS INT) AS grid_col
        FROM lineitem""",
    "water": """
        SELECT DISTINCT CAST(o_custkey % 660 AS INT) AS grid_row, CAST(o_orderkey % 1400 AS INT) AS grid_col FROM orders""",
    "pixels": _PIXELS,
    "stacks": """
        SELECT scene_id, prow, pcol, CAST(MAX(CASE WHEN band = 0 THEN dn END) AS DOUBLE) / 10000 AS b1,
               CAST(MAX(CASE WHEN band = 1 THEN dn END) AS DOUBLE) / 10000 AS b2, CAST(MAX(CASE WHEN band = 2 THEN dn END) AS DOUBLE) / 10000 AS b3,
               CAST(MAX(CASE WHEN band = 3 THEN dn END) AS DOUBLE) / 10000 AS b4, CAST(MAX(CASE WHEN band = 4 THEN dn END) AS DOUBLE) / 10000 AS b5,
               CAST(MAX(CASE WHEN band = 5 THEN dn END) AS DOUBLE) / 10000 AS b6, CAST(MAX(CASE WHEN band = 6 THEN dn END) AS DOUBLE) / 10000 AS b7,
               CAST(MAX(CASE WHEN band = 7 THEN dn END) AS DOUBLE) / 10000 AS b8
        FROM pixels GROUP BY scene_id, prow, pcol""",
}
NEEDS = {"stacks": ["pixels"]}

_VALUES = {
    "spark": "embeddings LATERAL VIEW posexplode(embedding) AS pos, v",
    "duckdb": "(SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)",
}
_DIV = {"spark": r"(\1 DIV \2)", "duckdb": r"(\1 // \2)"}


def dialect(sql: str, engine: str) -> str:
    return re.sub(r"@div\((\w+), (\w+)\)", _DIV[engine], sql).replace("@values", _VALUES[engine])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carrier(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = dialect(SQL[name], "spark")
    inputs = {}
    for t in [*TABLES, *NEEDS.get(name, [])]:
        named = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
        if named != sql:
            inputs[t], sql = carrier(spark, sf_dir, t) if t in SQL else table(spark, sf_dir, t), named
    return spark.sql(sql, **inputs)


def with_ctes(sql: str) -> str:
    """The oracle query with the views that it names in front."""
    names: list[str] = []

    def need(text: str) -> None:
        for name in SQL:
            if re.search(rf"\b{name}\b", text) and name not in names:
                need(SQL[name])
                names.append(name)

    need(sql)
    views = ",\n".join(f"{n} AS ({dialect(SQL[n], 'duckdb')})" for n in names)
    if not views:
        return sql
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
