"""Queries of the top-k, sampling and set operators (T1-T13, U1-U4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sensors import SERVICE
from ..operators import analyse, collapse, curation, habitat, matching, sets
from .carriers import carrier, table
from .q_joins import supplier_polygons
from .registry import query, rounded


@query("t01_top_k_cloud", """
SELECT tile, scene_id, CAST(r AS INT) AS rank FROM (SELECT tile, scene_id, row_number() OVER (PARTITION BY tile ORDER BY cloud_cover, acq_date, scene_id) AS r FROM scenes) WHERE r <= 8""")
def t01(spark: SparkSession, d: str) -> DataFrame:
    return matching.top_k(carrier(spark, d, "scenes"), ["tile"], ["cloud_cover", "acq_date", "scene_id"], 8).select("tile", "scene_id", "rank")


@query("t02_quality_order", """
SELECT tile, scene_id, CAST(row_number() OVER (PARTITION BY tile ORDER BY cloud_cover NULLS LAST, md5('7|' || scene_id), scene_id) AS INT) AS place FROM scenes""")
def t02(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "scenes")
    order = [*matching.quality_order(F.col("cloud_cover"), F.col("scene_id"), 7), F.col("scene_id")]
    return matching.top_k(s, ["tile"], order, 2**31 - 1).select("tile", "scene_id", F.col("rank").alias("place"))


@query("t03_keep_first", """
SELECT l_suppkey, obs_id FROM (SELECT l_suppkey, obs_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY obs_date, obs_id) AS r FROM obs) WHERE r = 1""")
def t03(spark: SparkSession, d: str) -> DataFrame:
    return matching.first_by(carrier(spark, d, "obs"), ["l_suppkey"], ["obs_date", "obs_id"]).select("l_suppkey", "obs_id")


@query("t04_stratified_cap", """
WITH s AS (SELECT DISTINCT site, island, depth_bin FROM annotations),
q AS (SELECT *, greatest(1, round_even(30.0::DOUBLE * count(*) OVER (PARTITION BY island, depth_bin) / count(*) OVER (), 0)) AS quota,
  row_number() OVER (PARTITION BY island, depth_bin ORDER BY md5('5|' || site), site) AS r FROM s)
SELECT site, island, depth_bin FROM q WHERE r <= quota ORDER BY md5('5|' || site), site LIMIT 30""")  # fmt: skip
def t04(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "annotations").select("site", "island", "depth_bin").distinct()
    return collapse.stratified_cap(s, ["island", "depth_bin"], "site", 30, 5)


@query("t05_equal_split", """
SELECT s_suppkey, CAST(100009 // n + CASE WHEN row_number() OVER (ORDER BY md5('3|' || s_suppkey), s_suppkey) <= 100009 % n THEN 1 ELSE 0 END AS INT) AS quota
FROM supplier, (SELECT count(*) AS n FROM supplier)""")  # fmt: skip
def t05(spark: SparkSession, d: str) -> DataFrame:
    return curation.equal_split(table(spark, d, "supplier").select("s_suppkey"), "s_suppkey", 100009, 3)


@query("t06_allocate_ids", """
WITH u AS (SELECT location_id FROM samples WHERE location_id % 3 <> 0), f AS (SELECT location_id FROM samples WHERE location_id % 3 = 0 UNION SELECT location_id FROM samples WHERE location_id % 30 = 1),
a AS (SELECT location_id, row_number() OVER (ORDER BY location_id) AS i FROM f WHERE location_id NOT IN (SELECT location_id FROM u)),
n AS (SELECT scene_id, row_number() OVER (ORDER BY acq_date, scene_id) AS i FROM scenes)
SELECT scene_id, CAST(coalesce(a.location_id, (SELECT max(location_id) FROM samples) + n.i - (SELECT count(*) FROM a)) AS BIGINT) AS location_id FROM n LEFT JOIN a USING (i)""")  # fmt: skip
def t06(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples").select("location_id")
    freed = s.where("location_id % 3 = 0").union(s.where("location_id % 30 = 1"))
    new = carrier(spark, d, "scenes").select("scene_id", "acq_date")
    out = curation.allocate_ids(new, freed, s.where("location_id % 3 <> 0"), ["acq_date", "scene_id"], "location_id")
    return out.select("scene_id", "location_id")


@query("t07_worst", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 6")
def t07(spark: SparkSession, d: str) -> DataFrame:
    return analyse.worst(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query("t08_rolling_bias", """
WITH n AS (SELECT greatest(30, count(*) // 20) AS w FROM samples),
r AS (SELECT location_id, depth_m, row_number() OVER (ORDER BY latitude, location_id) AS i FROM samples)
SELECT a.location_id, CASE WHEN count(b.depth_m) >= 5 THEN round(CAST(sum(CAST(b.depth_m AS DECIMAL(28, 12))) AS DOUBLE) / count(b.depth_m), 6) END AS rolling
FROM r a, n JOIN r b ON b.i BETWEEN a.i - w // 2 AND a.i + (w - 1) // 2 GROUP BY a.location_id""")  # fmt: skip
def t08(spark: SparkSession, d: str) -> DataFrame:
    out = analyse.rolling_bias(carrier(spark, d, "samples").select("location_id", "latitude", "depth_m"), "latitude", "depth_m", "location_id")
    return out.select("location_id", rounded("rolling", 6).alias("rolling"))


_U = "(('0x' || substr(md5('9|draw|' || d), 1, 8))::BIGINT / 4294967296.0)"


@query("t09_weighted_polygons", f"""
WITH g AS (SELECT s_suppkey AS poly, -60 + s_suppkey % 11 * 10 + 0.0 AS y, s_suppkey % 2 AS kind FROM supplier),
r AS (SELECT poly, kind, sin(radians(y)) AS s0, sin(radians(y + 2)) AS s2, sin(radians(y + 3)) AS s3, sin(radians(y + 6)) AS s6, sin(radians(y + 9)) AS s9, sin(radians(y + 11)) AS s11 FROM g),
a AS (SELECT poly, CASE WHEN kind = 0 THEN abs(14 * (s11 - s0) - 3 * (s2 - s0)) / 2 ELSE 9 * (s9 - s0) - 3 * (s6 - s3) END AS area FROM r),
c AS (SELECT poly, sum(area) OVER (ORDER BY poly) / sum(area) OVER () AS hi, (sum(area) OVER (ORDER BY poly) - area) / sum(area) OVER () AS lo FROM a)
SELECT d AS draw, poly FROM range(500) t(d) JOIN c ON {_U} >= lo AND {_U} < hi""")  # fmt: skip
def t09(spark: SparkSession, d: str) -> DataFrame:
    return habitat.weighted_polygons(supplier_polygons(spark, d), "poly", 500, 9).select("draw", "poly")


def _unit(salt: str, key: str, seed: int = 1) -> str:
    return f"(('0x' || substr(md5('{seed}|{salt}|' || {key}), 1, 8))::BIGINT / 4294967296.0)"


#: Triangles, squares with a hole and thin slivers, one for each supplier.
_SHAPES = """
g AS (SELECT s_suppkey AS poly, -60 + s_suppkey % 11 * 10 + 0.0 AS y, -180 + s_suppkey % 36 * 10 + 0.0 AS x, s_suppkey % 3 AS kind FROM supplier),
c AS (
  SELECT poly, unnest(CASE kind WHEN 0 THEN [x, x + 14, x + 3] WHEN 1 THEN [x, x + 9, x + 9, x, x + 3, x + 6, x + 6, x + 3] ELSE [x, x + 9, x + 9.0001] END) AS x1,
         unnest(CASE kind WHEN 0 THEN [y, y + 2, y + 11] WHEN 1 THEN [y, y, y + 9, y + 9, y + 3, y + 3, y + 6, y + 6] ELSE [y, y + 9, y + 9.001] END) AS y1,
         unnest(CASE kind WHEN 0 THEN [x + 14, x + 3, x] WHEN 1 THEN [x + 9, x + 9, x, x, x + 6, x + 6, x + 3, x + 3] ELSE [x + 9, x + 9.0001, x] END) AS x2,
         unnest(CASE kind WHEN 0 THEN [y + 2, y + 11, y] WHEN 1 THEN [y, y + 9, y + 9, y, y + 3, y + 6, y + 6, y + 3] ELSE [y + 9, y + 9.001, y] END) AS y2 FROM g),
e AS (SELECT poly, CASE WHEN y1 < y2 THEN x1 ELSE x2 END::DOUBLE AS ax, least(y1, y2)::DOUBLE AS ay, CASE WHEN y1 < y2 THEN x2 ELSE x1 END::DOUBLE AS bx, greatest(y1, y2)::DOUBLE AS b_y
  FROM c WHERE y1 <> y2)"""


def _shapes(spark: SparkSession, d: str) -> DataFrame:
    s, one = F.col("s_suppkey"), lambda v: v.cast("double")
    x, y = -180 + s % 36 * 10, -60 + s % 11 * 10
    ring = lambda *xy: F.array(*(F.array(one(x + a), one(y + b)) for a, b in xy))
    thin, hole = F.array(ring((0, 0), (9, 9), (9.0001, 9.001))), F.array(ring((0, 0), (9, 0), (9, 9), (0, 9)), ring((3, 3), (6, 3), (6, 6), (3, 6)))
    rings = F.when(s % 3 == 0, F.array(ring((0, 0), (14, 2), (3, 11)))).when(s % 3 == 1, hole).otherwise(thin)
    return table(spark, d, "supplier").select(s.cast("long").alias("poly"), rings.alias("rings"))


@query("t09_points_in_polygons", f"""
WITH {_SHAPES},
v AS (SELECT poly, y AS y0, lead(y) OVER (PARTITION BY poly ORDER BY y) AS y1 FROM (SELECT poly, ay AS y FROM e UNION SELECT poly, b_y FROM e)),
s AS (SELECT v.*, ax + (bx - ax) / (b_y - ay) * (y0 - ay) AS l0, ax + (bx - ax) / (b_y - ay) * (y1 - ay) AS l1 FROM v JOIN e ON e.poly = v.poly AND ay <= y0 AND b_y >= y1),
o AS (SELECT *, lead(l0) OVER w AS r0, lead(l1) OVER w AS r1, row_number() OVER w AS i FROM s WINDOW w AS (PARTITION BY poly, y0 ORDER BY l0, l1)),
t AS (SELECT poly, 1 AS half, y0 AS o, i, (r0 - l0) * (y1 - y0) AS area, l0 AS px, y0 AS py, r0 AS qx, y0 AS qy, l1 AS zx, y1 AS zy FROM o WHERE i % 2 = 1
  UNION ALL SELECT poly, 2, y0, i, (r1 - l1) * (y1 - y0), r0, y0, r1, y1, l1, y1 FROM o WHERE i % 2 = 1),
u AS (SELECT *, sum(area) OVER (PARTITION BY poly ORDER BY half, o, i) / sum(area) OVER (PARTITION BY poly) AS hi, row_number() OVER (PARTITION BY poly ORDER BY half DESC, o DESC, i DESC) AS back
  FROM t WHERE area > 0),
h AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY poly ORDER BY half, o, i), 0) AS lo, CASE WHEN back = 1 THEN 1 ELSE hi END AS top FROM u),
d AS (SELECT s_suppkey * 3 + k AS draw, s_suppkey AS poly FROM supplier, range(3) r(k)),
n AS (SELECT draw, poly, {_unit('part', 'draw', 4)} AS a, sqrt({_unit('away', 'draw', 4)}) AS b, {_unit('side', 'draw', 4)} AS c FROM d)
SELECT draw, n.poly, round(px + b * ((1 - c) * (qx - px) + c * (zx - px)), 9)::DOUBLE AS lon, round(py + b * ((1 - c) * (qy - py) + c * (zy - py)), 9)::DOUBLE AS lat
FROM n LEFT JOIN h ON h.poly = n.poly AND a >= lo AND a < top""")  # fmt: skip
def t09_points(spark: SparkSession, d: str) -> DataFrame:
    draws = _shapes(spark, d).select("poly", F.explode(F.sequence(F.col("poly") * 3, F.col("poly") * 3 + 2)).alias("draw")).select("draw", "poly")
    out = habitat.points_in_polygons(draws, _shapes(spark, d), "poly", 4)
    return out.withColumns({c: rounded(c, 9) for c in ("lon", "lat")})


def presence_sql(n: int) -> str:
    key = "habitat || '|' || grid_row || '|' || grid_col || '|' || k"
    return f"""
      SELECT habitat, CAST(k * n + i AS INT) AS number, grid_row, grid_col, round(95 + (grid_col + {_unit('x', key)}) * 0.05, 9)::DOUBLE AS lon,
             round(22 - (grid_row + {_unit('y', key)}) * 0.05, 9)::DOUBLE AS lat
      FROM (SELECT *, row_number() OVER (PARTITION BY habitat ORDER BY md5('1|' || habitat || '|' || grid_row || '|' || grid_col), grid_row, grid_col) - 1 AS i,
                   count(*) OVER (PARTITION BY habitat) AS n FROM masks), range(100) t(k) WHERE k * n + i < {n}"""  # fmt: skip


@query("t10_presence_points", f"WITH masks AS (SELECT * FROM cells) SELECT * FROM ({presence_sql(900)})")
def t10(spark: SparkSession, d: str) -> DataFrame:
    out = habitat.presence_points(carrier(spark, d, "cells"), ["habitat"], 900, 1, west=95.0, north=22.0, size=0.05)
    return out.withColumns({c: rounded(c, 9) for c in ("lon", "lat")})


#: Cells of the survey's absence radius: 20 km at 0.005 degrees.
RADIUS = 36


def runs_sql(cells: str, keys: str) -> str:
    """Cells as the longest runs."""
    return f"""SELECT {keys}grid_row, CAST(min(grid_col) AS INT) AS col_first, CAST(max(grid_col) AS INT) AS col_last
  FROM (SELECT *, grid_col - row_number() OVER (PARTITION BY {keys}grid_row ORDER BY grid_col) AS g FROM (SELECT DISTINCT {keys}grid_row, grid_col FROM {cells})) GROUP BY {keys}grid_row, g"""


def near_sql(keys: str, k: int) -> str:
    """The neighbourhoods of ``cells`` as runs: columns first, then along the rows by the gaps between cells."""
    return f"""SELECT {keys}CAST(grid_row AS INT) AS grid_row, CAST(greatest(min(grid_col) - {k}, 0) AS INT) AS col_first, CAST(least(max(grid_col) + {k}, 1399) AS INT) AS col_last
  FROM (SELECT *, sum(new) OVER (PARTITION BY {keys}grid_row ORDER BY grid_col) AS g FROM (
    SELECT *, CASE WHEN grid_col - lag(grid_col) OVER (PARTITION BY {keys}grid_row ORDER BY grid_col) <= {2 * k + 1} THEN 0 ELSE 1 END AS new FROM (
      SELECT DISTINCT {keys}unnest(range(greatest(grid_row - {k}, 0), least(grid_row + {k}, 659) + 1)) AS grid_row, grid_col FROM cells))) GROUP BY {keys}grid_row, g"""


def unrolled_sql(runs: str, keys: str) -> str:
    return f"SELECT {keys}grid_row, CAST(unnest(range(col_first, col_last + 1)) AS INT) AS grid_col FROM ({runs})"


_ABSENT = f"""SELECT habitat, grid_row, grid_col FROM ({unrolled_sql(near_sql("habitat, ", RADIUS), "habitat, ")}) n ANTI JOIN cells x ON x.grid_row = n.grid_row AND x.grid_col = n.grid_col
  WHERE habitat = 'mangrove' OR EXISTS (SELECT 1 FROM water w WHERE w.grid_row = n.grid_row AND w.grid_col = n.grid_col)"""


def _absent(spark: SparkSession, d: str) -> DataFrame:
    cells, water, out = carrier(spark, d, "cells"), carrier(spark, d, "water"), None
    for h in curation.HABITATS:
        part = habitat.absence_runs(cells, h, RADIUS, 660, 1400, water)
        out = part if out is None else out.unionByName(part)
    return out


@query("t11_absence_cells", runs_sql(f"({_ABSENT})", "habitat, "))
def t11(spark: SparkSession, d: str) -> DataFrame:
    return _absent(spark, d)


@query("t12_presence_absence", f"""
WITH p AS (WITH masks AS (SELECT * FROM cells) SELECT * FROM ({presence_sql(500)})), a AS (WITH masks AS ({_ABSENT}) SELECT * FROM ({presence_sql(500)}))
SELECT habitat || '_presence_' || printf('%04d', number) AS point_id, habitat, 1 AS label, lon, lat FROM p
UNION ALL SELECT habitat || '_absence_' || printf('%04d', number), habitat, 0, lon, lat FROM a""")  # fmt: skip
def t12(spark: SparkSession, d: str) -> DataFrame:
    points = lambda cells: habitat.presence_points(cells, ["habitat"], 500, 1, west=95.0, north=22.0, size=0.05)
    out = habitat.presence_absence(points(carrier(spark, d, "cells")), points(habitat.cells_of(_absent(spark, d), ["habitat"])))
    return out.withColumns({c: rounded(c, 9) for c in ("lon", "lat")})


@query("t13_random_subset", "SELECT location_id FROM samples ORDER BY md5('0|' || location_id), location_id LIMIT 100")
def t13(spark: SparkSession, d: str) -> DataFrame:
    return analyse.random_subset(carrier(spark, d, "samples").select("location_id"), "location_id", 100, 0)


@query("u01_union_by_name", """
SELECT 'A' AS Location, NULL AS Station, o_orderkey AS key, o_totalprice AS cover, NULL::BIGINT AS dbh FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'B', o_orderpriority, o_orderkey, NULL, o_custkey FROM orders WHERE o_orderkey % 2 = 1""")  # fmt: skip
def u01(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    a = o.where("o_orderkey % 2 = 0").select(F.lit("A").alias("Location"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("cover"))
    b = o.where("o_orderkey % 2 = 1").select(F.lit("B").alias("Location"), F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("dbh"), F.col("o_orderpriority").alias("Station"))
    return sets.union_by_name([a, a.limit(0), b])


@query("u02_relabel", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus ELSE o_orderstatus || ' Station ' || o_orderpriority END AS "Location" FROM orders""")
def u02(spark: SparkSession, d: str) -> DataFrame:
    station = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("Station")
    return sets.relabel(table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("Location"), station))


@query("u03_mask_union_difference", f"""
SELECT 'union' AS part, * FROM ({runs_sql("cells", "")})
UNION ALL SELECT 'difference', * FROM ({runs_sql(f"(SELECT grid_row, grid_col FROM ({unrolled_sql(near_sql('', RADIUS), '')}) EXCEPT SELECT grid_row, grid_col FROM cells)", "")})""")
def u03(spark: SparkSession, d: str) -> DataFrame:
    cells = carrier(spark, d, "cells")
    each = [habitat.runs_of(cells.where(F.col("habitat") == h), []) for h in curation.HABITATS]
    whole = each[0]
    for one in each[1:]:
        whole = habitat.union_runs(whole, one, [])
    near = habitat.dilate_runs(whole, [], RADIUS, 660, 1400)
    rest = habitat.difference_runs(near, whole, [])
    return whole.select(F.lit("union").alias("part"), "*").unionByName(rest.select(F.lit("difference").alias("part"), "*"))


@query("u04_in_service", """
WITH v(satellite, a, z) AS (VALUES ('L8', DATE '2013-03-18', NULL::DATE), ('L9', DATE '2013-03-18', NULL), ('L7', DATE '1999-04-15', NULL), ('L5', DATE '1982-07-16', DATE '2013-06-05'), ('S2', DATE '2015-07-01', NULL))
SELECT satellite, tile, window_start, window_end FROM (SELECT DISTINCT tile, obs_date - 30 AS window_start, obs_date + 30 AS window_end FROM obs), v
WHERE window_end >= a AND (z IS NULL OR window_start <= z)""")  # fmt: skip
def u04(spark: SparkSession, d: str) -> DataFrame:
    service = spark.createDataFrame(SERVICE, "satellite string, f string, l string")
    service = service.select("satellite", F.col("f").cast("date").alias("first_day"), F.col("l").cast("date").alias("last_day"))
    w = carrier(spark, d, "obs").select("tile", F.date_sub("obs_date", 30).alias("window_start"), F.date_add("obs_date", 30).alias("window_end")).distinct()
    pairs = w.withColumn("satellite", F.explode(F.array(*(F.lit(s[0]) for s in SERVICE))))
    return sets.in_service(pairs, service).select("satellite", "tile", "window_start", "window_end")
