"""Queries of the joins (J1-J18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..operators import curation, habitat, matching, sampling
from ..operators.analyse import matched_bands
from .carriers import carrier, table
from .registry import query, rounded

_DIST = "CAST(abs(date_diff('day', obs_date, acq_date)) AS INT)"


@query("j01_nearest_scene", f"""
SELECT o.obs_id, s.scene_id, s.dist FROM obs o LEFT JOIN (
  SELECT obs_id, scene_id, {_DIST} AS dist, row_number() OVER (PARTITION BY obs_id ORDER BY {_DIST}, acq_date, scene_id) AS r
  FROM obs JOIN scenes USING (tile, sensor) WHERE {_DIST} <= 60) s ON o.obs_id = s.obs_id AND r = 1""")  # fmt: skip
def j01(spark: SparkSession, d: str) -> DataFrame:
    obs, scenes = carrier(spark, d, "obs"), carrier(spark, d, "scenes")
    return matching.nearest_scene(obs, scenes, ["tile", "sensor"], "obs_date", "acq_date", "scene_id", 60).select("obs_id", "scene_id", "dist")


_TIER = "CASE WHEN clear_score >= 0.75 THEN 0 WHEN clear_score >= 0.6 THEN 1 WHEN clear_score >= 0.4 THEN 2 WHEN clear_score IS NOT NULL THEN 3 ELSE 4 END"
_HOURS = "CAST(abs(floor((date_diff('day', obs_date, acq_date) * 24 + acq_hour) / 24.0)) AS INT)"


@query("j02_clearest_scene", f"""
WITH c AS (
  SELECT obs_id, scene_id, {_TIER} AS tier, {_HOURS} AS dist, acq_date, acq_hour FROM obs JOIN scenes USING (tile, sensor)
  WHERE {_HOURS} <= 45 AND acq_date < obs_date + 45),
b AS (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY tier, CASE WHEN tier < 4 THEN dist END, acq_date, acq_hour, scene_id) AS r FROM c)
SELECT o.obs_id, scene_id, dist, tier FROM obs o LEFT JOIN b ON o.obs_id = b.obs_id AND r = 1""")  # fmt: skip
def j02(spark: SparkSession, d: str) -> DataFrame:
    scenes = carrier(spark, d, "scenes")
    scenes = scenes.withColumn("acquired", F.timestamp_seconds(F.unix_date("acq_date").cast("long") * 86400 + F.col("acq_hour") * 3600))
    obs = carrier(spark, d, "obs")
    out = matching.clearest_scene(obs, scenes, ["tile", "sensor"], "obs_date", "acquired", "scene_id", "clear_score", 45)
    return out.select("obs_id", "scene_id", "dist", "tier")


@query("j03_same_day_else_nearest", """
WITH v AS (SELECT DISTINCT l_suppkey AS site, tile, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE obs_date END AS day FROM obs),
f AS (SELECT tile, acq_date, printf('scene_%08d.tif', scene_id) AS file FROM scenes)
SELECT site, day, file, CAST(dist AS INT) AS dist FROM (
  SELECT site, v.day, file, abs(date_diff('day', v.day, acq_date)) AS dist,
         row_number() OVER (PARTITION BY site, v.day ORDER BY abs(date_diff('day', v.day, acq_date)) NULLS LAST, file) AS r
  FROM v LEFT JOIN f USING (tile)) WHERE r = 1""")  # fmt: skip
def j03(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("l_suppkey") % 7 == 0, None).otherwise(F.col("obs_date")).alias("day")
    visits = carrier(spark, d, "obs").select(F.col("l_suppkey").alias("site"), "tile", day).distinct()
    files = carrier(spark, d, "scenes").select("tile", "acq_date", F.format_string("scene_%08d.tif", "scene_id").alias("file"))
    return matching.same_day_else_nearest(visits, files, ["tile"], "day", "acq_date", "file").select("site", "day", "file", "dist")


#: Triangles asked for and diamonds taken: many meet in their boxes alone. What two convex outlines share has as corners those of
#: each that lie in the other and the points where edges cross, in the order of their angles.
@query("j04_catalogue_search", """
WITH a AS (SELECT location_id, longitude AS lon, latitude AS lat, [longitude - 0.4, longitude + 0.4, longitude - 0.4] AS ax, [latitude - 0.4, latitude - 0.4, latitude + 0.4] AS ay FROM samples),
s AS (SELECT scene_id, acq_date, cloud_cover, x, y, [x - 1.5, x, x + 1.5, x] AS sx, [y, y - 1.5, y, y + 1.5] AS sy
  FROM (SELECT *, -180 + (scene_id * 7) % 360 AS x, -60 + scene_id % 121 AS y FROM scenes)
  WHERE cloud_cover < 20 AND scene_id % 13 <= 5 AND 70 + scene_id % 31 >= 75 AND acq_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'),
p AS MATERIALIZED (SELECT * FROM a JOIN s ON abs(lon - x) <= 1.9 AND abs(lat - y) <= 1.9),
u AS (SELECT location_id, scene_id, ax[i] AS px, ay[i] AS py, ax[i % 3 + 1] AS qx, ay[i % 3 + 1] AS qy, ax, ay, sx, sy FROM p, range(1, 4) t(i)),
w AS (SELECT location_id, scene_id, sx[j] AS rx, sy[j] AS ry, sx[j % 4 + 1] AS tx, sy[j % 4 + 1] AS ty, ax, ay FROM p, range(1, 5) t(j)),
c AS (
  SELECT location_id, scene_id, px, py FROM u WHERE len([1 for j in [1, 2, 3, 4] if (sx[j % 4 + 1] - sx[j]) * (py - sy[j]) - (sy[j % 4 + 1] - sy[j]) * (px - sx[j]) >= 0]) = 4
  UNION ALL SELECT location_id, scene_id, rx, ry FROM w WHERE len([1 for i in [1, 2, 3] if (ax[i % 3 + 1] - ax[i]) * (ry - ay[i]) - (ay[i % 3 + 1] - ay[i]) * (rx - ax[i]) >= 0]) = 3
  UNION ALL SELECT location_id, scene_id, px + m * (qx - px), py + m * (qy - py) FROM (
    SELECT u.location_id, u.scene_id, px, py, qx, qy, ((rx - px) * (ty - ry) - (ry - py) * (tx - rx)) / nullif((qx - px) * (ty - ry) - (qy - py) * (tx - rx), 0) AS m,
           ((rx - px) * (qy - py) - (ry - py) * (qx - px)) / nullif((qx - px) * (ty - ry) - (qy - py) * (tx - rx), 0) AS k
    FROM u JOIN w ON u.location_id = w.location_id AND u.scene_id = w.scene_id) WHERE m BETWEEN 0 AND 1 AND k BETWEEN 0 AND 1),
o AS (SELECT *, atan2(py - avg(py) OVER g, px - avg(px) OVER g) AS angle FROM c WINDOW g AS (PARTITION BY location_id, scene_id)),
n AS (SELECT *, coalesce(lead(px) OVER v, first_value(px) OVER v) AS nx, coalesce(lead(py) OVER v, first_value(py) OVER v) AS ny FROM o WINDOW v AS (PARTITION BY location_id, scene_id ORDER BY angle)),
q AS (SELECT location_id, scene_id, abs(sum(px * ny - nx * py)) / 2 / 0.32 * 100 AS share FROM n GROUP BY ALL)
SELECT location_id, scene_id, round(share, 6)::DOUBLE AS share_pct, CAST(rank AS INT) AS rank FROM (
  SELECT location_id, scene_id, share, row_number() OVER (PARTITION BY location_id ORDER BY cloud_cover, acq_date, scene_id) AS rank
  FROM q JOIN s USING (scene_id) WHERE share >= 17.3) WHERE rank <= 8""")  # fmt: skip
def j04(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    ring = lambda x, y, *xy: F.array(*(F.array((x + a).cast("double"), (y + b).cast("double")) for a, b in xy))
    day = lambda x: F.lit(x).cast("date")
    a = carrier(spark, d, "samples").select(
        "location_id", ring(c("longitude"), c("latitude"), (-0.4, -0.4), (0.4, -0.4), (-0.4, 0.4)).alias("ring"), day("1996-01-01").alias("first_day"), day("1999-12-31").alias("last_day")
    )
    x, y = -180 + (c("scene_id") * 7) % 360, -60 + c("scene_id") % 121
    s = carrier(spark, d, "scenes").select(
        "scene_id", c("acq_date").alias("acquired"), "cloud_cover", (c("scene_id") % 13).cast("double").alias("nodata_pct"), (70 + c("scene_id") % 31).cast("double").alias("coverage_pct"),
        ring(x, y, (-1.5, 0), (0, -1.5), (1.5, 0), (0, 1.5)).alias("footprint"),
    )
    out = matching.catalogue_search(a, s, "location_id", cell=3.0, coverage=75, overlap=17.3)
    return out.select("location_id", "scene_id", rounded("share_pct", 6).alias("share_pct"), "rank")


@query("j05_pair_resolutions", """
WITH h AS (
  SELECT location_id, tile, scene_id AS hr_id, acq_date AS hr_date, scene_id % 3 <> 0 AS qa_ok, r FROM (
    SELECT location_id, tile, scene_id, acq_date, row_number() OVER (PARTITION BY location_id ORDER BY cloud_cover, md5('42|' || scene_id), scene_id) AS r
    FROM samples JOIN scenes USING (tile) WHERE sensor = 'S2' AND cloud_cover < 20) WHERE r <= 30),
n AS (
  SELECT location_id, hr_id, least(count(*), 8) AS n FROM h JOIN (SELECT tile, acq_date FROM scenes WHERE sensor = 'LS' AND cloud_cover < 60) USING (tile)
  WHERE abs(date_diff('day', hr_date, acq_date)) <= 180 GROUP BY ALL),
x AS (
  SELECT h.*, coalesce(n, 0) AS n_low, sum(CASE WHEN coalesce(n, 0) < 3 THEN 1 ELSE 0 END) OVER (PARTITION BY location_id ORDER BY r) AS short
  FROM h LEFT JOIN n USING (location_id, hr_id))
SELECT location_id, hr_id, CAST(n_low AS INT) AS n_low FROM (
  SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY r) AS k FROM x WHERE short = 0 AND qa_ok) WHERE k = 1""")  # fmt: skip
def j05(spark: SparkSession, d: str) -> DataFrame:
    scenes = carrier(spark, d, "scenes")
    places = carrier(spark, d, "samples").select("location_id", "tile")
    order = [*matching.quality_order(F.col("cloud_cover"), F.col("scene_id"), 42), "scene_id"]
    best = matching.top_k(scenes.where("sensor = 'S2' AND cloud_cover < 20"), ["tile"], order, 30)  # the order is the same for all places
    high = places.join(best, "tile").select("location_id", "tile", F.col("scene_id").alias("hr_id"), F.col("acq_date").alias("hr_date"), "rank", (F.col("scene_id") % 3 != 0).alias("qa_ok"))
    low = scenes.where("sensor = 'LS'").select("tile", F.col("scene_id").alias("lr_id"), F.col("acq_date").alias("lr_date"), "cloud_cover")
    return matching.pair_resolutions(high, low, keys=["tile"], days=180, least=3, cloud=60).select("location_id", "hr_id", "n_low")


@query("j06_fuzzy_names", """
WITH l AS (SELECT DISTINCT CASE WHEN p_size % 4 = 0 THEN p_name || ' north' WHEN p_size % 4 = 1 THEN trim(substr(p_name, 1, 5)) ELSE p_name END AS site FROM part),
r AS (SELECT p_name AS folder, count(*) AS files FROM part GROUP BY 1)
SELECT site, folder, CAST(gap AS INT) AS gap FROM (
  SELECT site, folder, abs(length(site) - length(folder)) AS gap,
         row_number() OVER (PARTITION BY site ORDER BY abs(length(site) - length(folder)), files, folder) AS k
  FROM l JOIN r ON starts_with(site, folder) OR starts_with(folder, site)) WHERE k = 1""")  # fmt: skip
def j06(spark: SparkSession, d: str) -> DataFrame:
    part, name, m = table(spark, d, "part"), F.col("p_name"), F.col("p_size") % 4
    site = F.when(m == 0, F.concat(name, F.lit("-NORTH"))).when(m == 1, F.substring(name, 1, 5)).otherwise(F.upper(name))
    left = part.select(labels.normalise_label(site).alias("site")).distinct()
    right = part.groupBy(labels.normalise_label(name).alias("folder")).agg(F.count("*").alias("files"))
    return matching.fuzzy_names(left, right, "site", "folder", "files").select("site", "folder", "gap")


@query("j07_primary_else_fallback", """
SELECT scene_id, round(CASE WHEN scene_id % 3 = 0 THEN cloud_cover WHEN scene_id % 3 = 1 THEN NULL ELSE 1 END, 6)::DOUBLE AS b1,
  round(CASE WHEN scene_id % 3 = 0 THEN NULL WHEN scene_id % 3 = 1 THEN acq_hour END, 6)::DOUBLE AS b2,
  CASE WHEN scene_id % 3 = 0 THEN 'primary' WHEN scene_id % 3 = 1 THEN 'fallback' ELSE 'primary' END AS source FROM scenes""")  # fmt: skip
def j07(spark: SparkSession, d: str) -> DataFrame:
    s, m, none = carrier(spark, d, "scenes"), F.col("scene_id") % 3, F.lit(None).cast("double")
    primary = s.where(m != 1).select("scene_id", F.when(m == 0, F.col("cloud_cover")).otherwise(1.0).alias("b1"), none.alias("b2"))
    primary = primary.unionByName(s.where(m == 1).select("scene_id", none.alias("b1"), none.alias("b2")))
    fallback = s.select("scene_id", F.when(m == 0, 9.0).otherwise(none).alias("b1"), F.col("acq_hour").cast("double").alias("b2"))
    return matching.primary_else_fallback(s.select("scene_id"), primary, fallback, "scene_id", ["b1", "b2"])


@query("j08_onto_children", """
WITH p AS (SELECT site, plot_no, round(avg(dbh_cm), 6) AS mean_dbh FROM trees GROUP BY ALL)
SELECT t.site, t.plot_no, t.tree_no, t.dbh_cm, mean_dbh FROM trees t LEFT JOIN p ON t.site = p.site AND t.plot_no = p.plot_no""")
def j08(spark: SparkSession, d: str) -> DataFrame:
    trees = carrier(spark, d, "trees").select("site", "plot_no", "tree_no", "dbh_cm")
    plots = trees.groupBy("site", "plot_no").agg(rounded(F.avg("dbh_cm"), 6).alias("mean_dbh"), F.first("tree_no").alias("tree_no"))
    return matching.onto_children(trees, plots, ["site", "plot_no"])


def stack_count(spark: SparkSession, d: str) -> DataFrame:
    """One row: how many stacks there are."""
    return table(spark, d, "embeddings").agg((F.expr("max(vec_id) div 8") + 1).alias("n_stacks"))


@query("j09_point_to_cell", """
WITH p AS (SELECT obs_id, CAST(l_suppkey % (SELECT max(vec_id) // 8 + 1 FROM embeddings) AS BIGINT) AS scene_id, CAST(l_partkey % 8 AS INT) AS pcol, CAST(l_orderkey % 8 AS INT) AS prow FROM obs)
SELECT obs_id, dn FROM p LEFT JOIN (SELECT scene_id, prow, pcol, dn FROM pixels WHERE band = 3) USING (scene_id, prow, pcol)""")  # fmt: skip
def j09(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = (F.col("l_partkey") % 8) * 0.5 + 100.2, 10 - ((F.col("l_orderkey") % 8) * 0.5 + 0.2)
    row, col = sampling.cell_of(lon, lat, 100.0, 10.0, 0.5)
    obs = carrier(spark, d, "obs").crossJoin(F.broadcast(stack_count(spark, d)))
    points = obs.select("obs_id", (F.col("l_suppkey") % F.col("n_stacks")).alias("scene_id"), row.alias("prow"), col.alias("pcol"))
    return sampling.at_cells(points, carrier(spark, d, "pixels").where("band = 3"), ["scene_id", "prow", "pcol"], "dn").select("obs_id", "dn")


@query("j10_window_mean", """
WITH p AS (SELECT scene_id * 100 + k AS point_id, scene_id, CAST((scene_id + k) % 9 AS INT) AS prow, CAST((scene_id * 3 + k) % 9 AS INT) AS pcol
           FROM (SELECT DISTINCT scene_id FROM pixels), range(3) t(k))
SELECT point_id, round(avg(dn), 6) AS dn FROM p LEFT JOIN (SELECT * FROM pixels WHERE band = 2 AND dn <> 0) x
  ON x.scene_id = p.scene_id AND abs(x.prow - p.prow) <= 1 AND abs(x.pcol - p.pcol) <= 1 GROUP BY point_id""")  # fmt: skip
def j10(spark: SparkSession, d: str) -> DataFrame:
    points = carrier(spark, d, "pixels").select("scene_id").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
    s, k = F.col("scene_id"), F.col("k")
    points = points.select((s * 100 + k).alias("point_id"), "scene_id", ((s + k) % 9).cast("int").alias("prow"), ((s * 3 + k) % 9).cast("int").alias("pcol"))
    out = sampling.window_mean(points, carrier(spark, d, "pixels").where("band = 2"), "point_id", "scene_id", "prow", "pcol", "dn", valid=F.col("dn") != 0)
    return out.select("point_id", rounded("dn", 6).alias("dn"))


#: Triangles and squares with a hole, one for each supplier.
_RINGS = """
SELECT s_suppkey AS poly, -60 + s_suppkey % 11 * 10 + 0.0 AS y, -180 + s_suppkey % 36 * 10 + 0.0 AS x, s_suppkey % 2 AS kind FROM supplier"""


_IN_POLYGON = f"""
WITH g AS ({_RINGS}),
e AS (
  SELECT poly, unnest(CASE WHEN kind = 0 THEN [x, x + 14, x + 3] ELSE [x, x + 9, x + 9, x, x + 3, x + 6, x + 6, x + 3] END) AS x1,
         unnest(CASE WHEN kind = 0 THEN [y, y + 2, y + 11] ELSE [y, y, y + 9, y + 9, y + 3, y + 3, y + 6, y + 6] END) AS y1,
         unnest(CASE WHEN kind = 0 THEN [x + 14, x + 3, x] ELSE [x + 9, x + 9, x, x, x + 6, x + 6, x + 3, x + 3] END) AS x2,
         unnest(CASE WHEN kind = 0 THEN [y + 2, y + 11, y] ELSE [y, y + 9, y + 9, y, y + 3, y + 6, y + 6, y + 3] END) AS y2 FROM g),
p AS (SELECT location_id, longitude + 0.37 AS px, latitude + 0.21 AS py FROM samples),
h AS (SELECT location_id, poly, count(*) AS n FROM p JOIN e ON (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 GROUP BY ALL),
i AS (SELECT DISTINCT location_id FROM h WHERE n % 2 = 1)"""


@query("j11_point_in_polygon", _IN_POLYGON + "SELECT location_id FROM i")
def j11(spark: SparkSession, d: str) -> DataFrame:
    return habitat.inside(_places(spark, d), supplier_polygons(spark, d), "location_id", cell=5.0).select("location_id")


@query("j11_off_land", _IN_POLYGON + "SELECT location_id FROM p WHERE location_id NOT IN (SELECT location_id FROM i)")
def j11_off_land(spark: SparkSession, d: str) -> DataFrame:
    return habitat.off_land(_places(spark, d), supplier_polygons(spark, d), "location_id", cell=5.0).select("location_id")


def _places(spark: SparkSession, d: str) -> DataFrame:
    return carrier(spark, d, "samples").select("location_id", (F.col("longitude") + 0.37).alias("lon"), (F.col("latitude") + 0.21).alias("lat"))


def supplier_polygons(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.sql(_RINGS.replace("FROM supplier", "FROM {supplier}"), supplier=table(spark, d, "supplier"))
    ring = lambda *xy: F.array(*(F.array((F.col("x") + a).cast("double"), (F.col("y") + b).cast("double")) for a, b in xy))
    one = F.array(ring((0, 0), (14, 2), (3, 11)))
    two = F.array(ring((0, 0), (9, 0), (9, 9), (0, 9)), ring((3, 3), (6, 3), (6, 6), (3, 6)))
    return rows.select(F.col("poly").cast("long").alias("poly"), F.when(F.col("kind") == 0, one).otherwise(two).alias("rings"))


@query("j12_missing_samples", "SELECT location_id FROM samples WHERE location_id % 7 = 0")
def j12(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples")
    return curation.missing_samples(s.select("location_id"), s.where("location_id % 7 <> 0"), "location_id")


@query("j13_drop_listed", """
SELECT 'kept' AS part, location_id FROM samples WHERE location_id % 5 <> 0 UNION ALL SELECT 'dropped', location_id FROM samples WHERE location_id % 5 = 0
UNION ALL SELECT 'unknown', -location_id - 1 FROM samples WHERE location_id % 50 = 0""")  # fmt: skip
def j13(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples").select("location_id")
    listed = s.where("location_id % 5 = 0").union(s.where("location_id % 50 = 0")).union(s.where("location_id % 50 = 0").select(-F.col("location_id") - 1))
    parts = zip(("kept", "dropped", "unknown"), curation.drop_listed(s, listed, "location_id"))
    return _stacked({name: rows.select("location_id") for name, rows in parts})


def _stacked(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, rows in parts.items():
        rows = rows.select(F.lit(name).alias("part"), *rows.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


@query("j14_still_to_do", """
SELECT 'fresh' AS part, scene_id FROM scenes WHERE scene_id % 3 <> 0 UNION ALL SELECT 'stale', scene_id FROM scenes""")
def j14(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "scenes").select("scene_id")
    done = s.where("scene_id % 3 = 0")
    stale = done.union(spark.range(1).select(F.lit(-5).cast("long")))
    return _stacked({"fresh": curation.still_to_do(s, done, ["scene_id"]), "stale": curation.still_to_do(s, stale, ["scene_id"])})


@query("j15_sample_state", """
SELECT location_id, CASE WHEN location_id % 4 = 0 THEN 'untouched' WHEN location_id % 6 = 1 THEN 'broken' ELSE 'ok' END AS state FROM samples""")
def j15(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples").select("location_id")
    folders = s.where("location_id % 4 <> 0")
    return curation.sample_state(s, folders, folders.where("location_id % 6 <> 1"), "location_id")


@query("j16_apply_decisions", """
WITH f AS (SELECT location_id, k, CASE WHEN k = 0 THEN 'hr' ELSE 'lr' END AS role, CASE WHEN k = 0 THEN 'hr.tif' ELSE 'lr_' || k || '.tif' END AS file FROM samples, range(4) t(k))
SELECT location_id, file, role, coalesce(CASE location_id % 7 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN role = 'hr' WHEN 3 THEN role = 'lr'
  WHEN 4 THEN file = 'lr_2.tif' ELSE false END, false) AS removed FROM f""")  # fmt: skip
def j16(spark: SparkSession, d: str) -> DataFrame:
    s, m = carrier(spark, d, "samples").select("location_id"), F.col("location_id") % 7
    k = F.col("k")
    files = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        "location_id", F.when(k == 0, "hr").otherwise("lr").alias("role"), F.when(k == 0, "hr.tif").otherwise(F.format_string("lr_%d.tif", k)).alias("file")
    )
    action = F.when(m == 0, "delete").when(m == 1, "replace_both").when(m == 2, "replace_hr").when(m.isin(3, 4), "replace_lr").when(m == 5, "keep")
    decisions = s.select("location_id", action.alias("action"), F.when(m == 4, F.array(F.lit("lr_2.tif"))).alias("files")).where("action IS NOT NULL")
    return curation.apply_decisions(files, decisions)


@query("j16_decisions_left", """
SELECT location_id, CASE WHEN location_id % 7 = 5 THEN 'keep' ELSE 'look_again' END AS action FROM samples WHERE location_id % 7 > 4""")
def j16_left(spark: SparkSession, d: str) -> DataFrame:
    names = ["delete", "replace_both", "replace_hr", "replace_lr", "replace_lr", "keep", "look_again"]
    action = F.get(F.array(*map(F.lit, names)), (F.col("location_id") % 7).cast("int"))
    return curation.decisions_left(carrier(spark, d, "samples").select("location_id", action.alias("action")))


@query("j17_legacy_purge", """
SELECT CASE WHEN habitat_class IS NULL THEN 'removed' ELSE 'kept' END AS part, location_id FROM samples""")
def j17(spark: SparkSession, d: str) -> DataFrame:
    kept, removed = curation.legacy_split(carrier(spark, d, "samples").select("location_id", "habitat_class"), "habitat_class")
    return _stacked({"kept": kept.select("location_id"), "removed": removed.select("location_id")})


@query("j18_matched_bands", """
WITH m AS (SELECT scene_id AS location_id, band, avg(dn) AS mean FROM pixels WHERE dn <> 0 GROUP BY ALL),
p(lr, hr, a, b) AS (VALUES ('B1', 'B1', 0, 0), ('B2', 'B2', 1, 1), ('B3', 'B3', 2, 2), ('B4', 'B4', 3, 3), ('B5', 'B8A', 4, 7), ('B6', 'B11', 5, 5), ('B7', 'B12', 6, 6))
SELECT l.location_id, p.lr AS lr_band, p.hr AS hr_band, round(h.mean - l.mean, 6) AS diff
FROM p JOIN m l ON l.band = p.a JOIN m h ON h.band = p.b AND h.location_id = l.location_id""")  # fmt: skip
def j18(spark: SparkSession, d: str) -> DataFrame:
    means = carrier(spark, d, "pixels").where("dn <> 0").groupBy(F.col("scene_id").alias("location_id"), "band").agg(F.avg("dn").alias("mean"))
    hr_name = F.element_at(F.create_map(*[F.lit(x) for kv in {0: "B1", 1: "B2", 2: "B3", 3: "B4", 7: "B8A", 5: "B11", 6: "B12"}.items() for x in kv]), F.col("band"))
    low = means.where("band < 7").select("location_id", F.concat(F.lit("B"), F.col("band") + 1).alias("band"), "mean")
    high = means.where("band <> 4").select("location_id", hr_name.alias("band"), "mean")
    return matched_bands(low, high).select("location_id", "lr_band", "hr_band", rounded("diff", 6).alias("diff"))
