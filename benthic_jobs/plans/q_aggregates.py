"""Queries of the aggregations (A1-A26)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import season
from ..operators import analyse, collapse, curation, quality, sampling
from ..operators.ranks import quantiles
from .carriers import carrier, table
from .registry import mean_sql, query, rounded

OTHER = ["Tape and wand", "STANDARD"]
_BENTHIC = "coalesce(category NOT IN ('Tape and wand', 'STANDARD'), true)"
_KEEP = {"LARGE": "cover_large", "SMALL": "cover_small", "MEDIUM": "cover_medium", "ECONOMY": "cover_economy"}


def benthic() -> Column:
    return collapse.is_benthic(F.col("category"), OTHER)


def _mode(table_: str, key: str, value: str) -> str:
    """The most frequent value, ties to the smallest."""
    return f"""SELECT {key}, {value} FROM (SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS r
      FROM {table_} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) WHERE r = 1"""  # fmt: skip


@query("a01_plots", f"""
WITH m AS (SELECT site, plot_no, species FROM (SELECT site, plot_no, species, row_number() OVER (PARTITION BY site, plot_no ORDER BY count(*) DESC, species) AS r
  FROM trees GROUP BY site, plot_no, species) WHERE r = 1)
SELECT t.site, t.plot_no, arg_min(height_m, l_orderkey * 1000000 + l_partkey * 100 + l_suppkey) AS height_m, count(tree_no) AS n_trees, round({mean_sql("dbh_cm")}, 6) AS mean_dbh_cm,
  max(dbh_cm) AS max_dbh_cm, round({mean_sql("height_m")}, 6) AS mean_height_m, count(DISTINCT t.species) AS n_species, any_value(m.species) AS dominant_species,
  round(avg(CASE WHEN coalesce(comment, 'Live') = 'Live' THEN 1 ELSE 0 END), 6) AS live_fraction
FROM trees t JOIN m ON t.site = m.site AND t.plot_no = m.plot_no GROUP BY t.site, t.plot_no""")  # fmt: skip
def a01(spark: SparkSession, d: str) -> DataFrame:
    trees = carrier(spark, d, "trees").withColumn("n", F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 100 + F.col("l_suppkey"))
    out = collapse.plots(trees, ["site", "plot_no"], "n", ["height_m"])
    return out.withColumns({c: rounded(c, 6) for c in ("mean_dbh_cm", "mean_height_m", "live_fraction")})


@query("a02_sites", f"""
WITH m AS ({_mode('annotations', 'site', 'analyst')})
SELECT a.site, min(island) AS island, min(depth_bin) AS depth_bin, count(DISTINCT image) AS n_images, count(DISTINCT a.analyst) AS n_analysts, count(*) AS n_points,
  CAST(sum(CASE WHEN {_BENTHIC} THEN 1 ELSE 0 END) AS BIGINT) AS n_benthic, any_value(m.analyst) AS primary_analyst
FROM annotations a JOIN m ON a.site = m.site GROUP BY a.site""")  # fmt: skip
def a02(spark: SparkSession, d: str) -> DataFrame:
    return collapse.sites(carrier(spark, d, "annotations"), "site", "image", ["island", "depth_bin"], benthic())


_COVER = f"""
WITH own AS (SELECT * FROM annotations WHERE {_BENTHIC}),
t AS (SELECT site, count(*) AS total, count(category) AS labelled FROM own GROUP BY site),
k(category) AS (VALUES ('LARGE'), ('SMALL'), ('MEDIUM'), ('ECONOMY')),
c AS (SELECT s.site, k.category, CASE WHEN any_value(labelled) > 0 THEN round(count(own.image) * 100.0 / any_value(total), 6) END AS cover
  FROM (SELECT DISTINCT site FROM annotations) s CROSS JOIN k LEFT JOIN t ON t.site = s.site
  LEFT JOIN own ON own.site = s.site AND own.category = k.category GROUP BY s.site, k.category)"""


@query("a03_cover_long", _COVER + " SELECT site, category, CAST(cover AS DOUBLE) AS cover FROM c")
def a03(spark: SparkSession, d: str) -> DataFrame:
    out = collapse.cover_long(carrier(spark, d, "annotations"), "site", "category", list(_KEEP), benthic())
    return out.withColumn("cover", rounded("cover", 6))


@query("a03_cover_wide", _COVER + """ SELECT site, CAST(max(CASE WHEN category = 'LARGE' THEN cover END) AS DOUBLE) AS cover_large,
  CAST(max(CASE WHEN category = 'SMALL' THEN cover END) AS DOUBLE) AS cover_small, CAST(max(CASE WHEN category = 'MEDIUM' THEN cover END) AS DOUBLE) AS cover_medium,
  CAST(max(CASE WHEN category = 'ECONOMY' THEN cover END) AS DOUBLE) AS cover_economy FROM c GROUP BY site""")  # fmt: skip
def a03w(spark: SparkSession, d: str) -> DataFrame:
    return collapse.cover_wide(a03(spark, d), "site", "category", _KEEP)


@query("a04_category_share", """
SELECT site, round(sum(CASE WHEN category = 'Tape and wand' THEN 1 ELSE 0 END) * 100.0 / count(*), 6)::DOUBLE AS pct_points_tape FROM annotations GROUP BY site""")
def a04(spark: SparkSession, d: str) -> DataFrame:
    out = collapse.category_share(carrier(spark, d, "annotations"), "site", "category", {"Tape and wand": "pct_points_tape"})
    return out.withColumn("pct_points_tape", rounded("pct_points_tape", 6))


@query("a05_common_labels", f"""
SELECT genus, count(*) AS n FROM annotations WHERE {_BENTHIC} AND genus IS NOT NULL GROUP BY genus
HAVING count(*) >= 0.036 * (SELECT count(*) FROM annotations WHERE {_BENTHIC})""")
def a05(spark: SparkSession, d: str) -> DataFrame:
    return collapse.common_labels(carrier(spark, d, "annotations").where(benthic()), "genus", 0.036)


@query("a06_richness", f"""
WITH b AS (SELECT * FROM annotations WHERE {_BENTHIC}), x AS ({_mode('b', 'site', 'category')}), y AS ({_mode('b', 'site', 'subcategory')}), z AS ({_mode('b', 'site', 'genus')})
SELECT b.site, count(DISTINCT b.category) AS n_category, count(DISTINCT b.subcategory) AS n_subcategory, count(DISTINCT b.genus) AS n_genus,
  any_value(x.category) AS top_category, any_value(y.subcategory) AS top_subcategory, any_value(z.genus) AS top_genus
FROM b LEFT JOIN x ON x.site = b.site LEFT JOIN y ON y.site = b.site LEFT JOIN z ON z.site = b.site GROUP BY b.site""")  # fmt: skip
def a06(spark: SparkSession, d: str) -> DataFrame:
    return collapse.richness(carrier(spark, d, "annotations").where(benthic()), "site", ["category", "subcategory", "genus"])


@query("a07_shannon", """
WITH c AS (SELECT site, genus, count(*) AS n FROM annotations WHERE genus IS NOT NULL GROUP BY ALL),
t AS (SELECT site, n / sum(n) OVER (PARTITION BY site) AS p FROM c)
SELECT s.site, round(h, 6) AS shannon FROM (SELECT DISTINCT site FROM annotations) s LEFT JOIN (SELECT site, sum(-p * ln(p)) AS h FROM t GROUP BY site) h ON h.site = s.site""")  # fmt: skip
def a07(spark: SparkSession, d: str) -> DataFrame:
    return collapse.shannon(carrier(spark, d, "annotations"), "site", "genus").withColumn("shannon", rounded("shannon", 6))


@query("a08_date_spread", """
SELECT island, CAST(date_trunc('month', survey_date) AS DATE) AS month, count(DISTINCT survey_date) AS n_dates, count(*) AS n, min(survey_date) AS first_day,
  max(survey_date) AS last_day, min(27 + analyst * 0.25)::DOUBLE AS south, min(-83 + site % 40 * 0.5)::DOUBLE AS west, max(27 + analyst * 0.25)::DOUBLE AS north,
  max(-83 + site % 40 * 0.5)::DOUBLE AS east FROM annotations GROUP BY ALL""")  # fmt: skip
def a08(spark: SparkSession, d: str) -> DataFrame:
    places = {"lat": F.lit(27.0) + F.col("analyst") * F.lit(0.25), "lon": F.lit(-83.0) + F.col("site") % 40 * F.lit(0.5)}
    return collapse.date_spread(carrier(spark, d, "annotations").withColumns(places), "island", "survey_date", "lon", "lat")


@query("a09_merged_windows", """
WITH w AS (SELECT DISTINCT tile, obs_date, obs_date - 2 AS s, obs_date + 2 AS e FROM obs),
n AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY tile ORDER BY obs_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS new FROM w),
i AS (SELECT *, sum(new) OVER (PARTITION BY tile ORDER BY obs_date) AS island FROM n)
SELECT tile, min(s) AS window_start, max(e) AS window_end, count(*) AS n_dates FROM i GROUP BY tile, island""")  # fmt: skip
def a09(spark: SparkSession, d: str) -> DataFrame:
    return collapse.merged_windows(carrier(spark, d, "obs"), ["tile"], "obs_date", 2)


@query("a10_extents", f"""
WITH m AS (SELECT l_linenumber AS cluster, median(lon) AS mx, median(lat) AS my FROM obs GROUP BY 1),
i AS (SELECT cluster, lon, lat FROM obs JOIN m ON l_linenumber = cluster
  WHERE sqrt(((lon - mx) * 111320 * cos(radians(my))) ** 2 + ((lat - my) * 110540) ** 2) <= 20000),
b AS (SELECT cluster, min(lon) - 0.05 AS west, min(lat) - 0.05 AS south, max(lon) + 0.05 AS east, max(lat) + 0.05 AS north, {mean_sql("lon")} AS lon, {mean_sql("lat")} AS lat
  FROM i GROUP BY 1)
SELECT cluster, round(west, 6)::DOUBLE AS west, round(south, 6)::DOUBLE AS south, round(east, 6)::DOUBLE AS east, round(north, 6)::DOUBLE AS north,
  round(any_value(b.lon), 6) AS lon, round(any_value(b.lat), 6) AS lat,
  round(max(sqrt(((o.lon - b.lon) * 111320 * cos(radians(b.lat))) ** 2 + ((o.lat - b.lat) * 110540) ** 2)), 3) AS radius_m
FROM i o JOIN b USING (cluster) GROUP BY cluster, west, south, east, north""")  # fmt: skip
def a10(spark: SparkSession, d: str) -> DataFrame:
    out = collapse.extents(carrier(spark, d, "obs").withColumnRenamed("l_linenumber", "cluster"), "cluster", "lon", "lat", 0.05, limit_m=20000)
    return out.withColumns({c: rounded(c, 6) for c in ("west", "south", "east", "north", "lon", "lat")}).withColumn("radius_m", rounded("radius_m", 3))


@query("a11_outliers", """
WITH m AS (SELECT l_suppkey, median(lon) AS mx, median(lat) AS my FROM obs GROUP BY 1)
SELECT obs_id, round(d, 3) AS dist_m, d > 20000 AS outlier FROM (
  SELECT obs_id, sqrt(((lon - mx) * 111320 * cos(radians(my))) ** 2 + ((lat - my) * 110540) ** 2) AS d FROM obs JOIN m USING (l_suppkey))""")  # fmt: skip
def a11(spark: SparkSession, d: str) -> DataFrame:
    out = collapse.outlier_flags(carrier(spark, d, "obs"), "l_suppkey", "lon", "lat", 20000)
    return out.select("obs_id", rounded("dist_m", 3).alias("dist_m"), "outlier")


@query("a12_clear_fraction", f"""
SELECT scene_id, band, round(avg(CASE WHEN dn <= 6000 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS clear_fraction, round({mean_sql("dn / 10000.0")}, 6)::DOUBLE AS mean_score
FROM pixels GROUP BY ALL""")
def a12(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.clear_fraction(carrier(spark, d, "pixels"), ["scene_id", "band"], F.col("dn") <= 6000, F.col("dn") / 10000.0)
    return out.withColumns({c: rounded(c, 6) for c in ("clear_fraction", "mean_score")})


@query("a13_turbidity_index", f"""
WITH m AS (SELECT scene_id % 6 AS aoi, prow, pcol, median(b4) AS r, median(b3) AS g FROM stacks GROUP BY ALL)
SELECT aoi, round({mean_sql("(r - g) / nullif(r + g, 0)")}, 6) AS turbidity_index FROM m GROUP BY aoi""")
def a13(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "stacks").withColumn("aoi", F.col("scene_id") % 6)
    return sampling.turbidity_index(s, "aoi", ["prow", "pcol"], "b4", "b3").withColumn("turbidity_index", rounded("turbidity_index", 6))


@query("a14_empty_rasters", """
SELECT scene_id, band, bool_and(dn = 0) OR bool_and(dn IS NULL OR dn = 9999) AS is_empty FROM pixels GROUP BY ALL""")
def a14(spark: SparkSession, d: str) -> DataFrame:
    return quality.empty_rasters(carrier(spark, d, "pixels"), ["scene_id", "band"], "dn", 9999)


@query("a15_nodata_cloud", """
WITH f AS (SELECT scene_id, band, avg(CASE WHEN dn = 0 THEN 1.0 ELSE 0.0 END) AS n,
  coalesce(avg(CASE WHEN dn <> 0 THEN CASE WHEN dn > 6000 THEN 1.0 ELSE 0.0 END END), 0) AS c FROM pixels GROUP BY ALL)
SELECT scene_id, band, round(n, 6)::DOUBLE AS nodata_frac, round(c, 6)::DOUBLE AS cloud_frac, CASE WHEN n > 0.2 THEN 'nodata' WHEN c > 0.1 THEN 'cloud' ELSE 'ok' END AS finding FROM f""")  # fmt: skip
def a15(spark: SparkSession, d: str) -> DataFrame:
    p = carrier(spark, d, "pixels").withColumn("qa", F.when(F.col("dn") > 6000, 8).otherwise(64))
    out = quality.nodata_and_cloud(p, ["scene_id", "band"], "dn", "qa", 0)
    return out.withColumns({c: rounded(c, 6) for c in ("nodata_frac", "cloud_frac")})


@query("a16_glint_haze", f"""
WITH m AS (SELECT scene_id, {mean_sql("CASE WHEN b8 > 0.45 THEN b8 END")} AS n, {mean_sql("CASE WHEN b2 > 0 THEN b2 END")} AS b FROM (SELECT scene_id, b2, CASE WHEN b8 > 0.45 THEN b8 ELSE -1 END AS b8 FROM stacks) GROUP BY scene_id)
SELECT scene_id, round(n, 6) AS nir_mean, round(b, 6) AS blue_mean, CASE WHEN n > 0.535 AND b > 0.12 THEN 'glint' WHEN b > 0.495 THEN 'haze' ELSE 'ok' END AS screen FROM m""")  # fmt: skip
def a16(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "stacks").withColumn("b8", F.when(F.col("b8") > 0.45, F.col("b8")).otherwise(-1.0))
    out = quality.glint_haze(s, ["scene_id"], "b8", "b2", glint_nir=0.535, haze=0.495)
    return out.withColumns({c: rounded(c, 6) for c in ("nir_mean", "blue_mean")})


@query("a17_accepted_stacks", """
WITH i AS (SELECT scene_id, CASE WHEN bool_and(dn = 0) THEN 'fail' WHEN avg(CASE WHEN dn = 0 THEN 1.0 ELSE 0.0 END) > 0.07 THEN 'skip' ELSE 'ok' END AS status FROM pixels GROUP BY scene_id, band)
SELECT scene_id, bool_or(status = 'fail') AS failed, CAST(sum((status = 'ok')::INT) AS BIGINT) AS n_ok, NOT bool_or(status = 'fail') AND sum((status = 'ok')::INT) >= 2 AS accepted
FROM i GROUP BY scene_id""")  # fmt: skip
def a17(spark: SparkSession, d: str) -> DataFrame:
    p = carrier(spark, d, "pixels").groupBy("scene_id", "band").agg(F.bool_and(F.col("dn") == 0).alias("e"), F.avg((F.col("dn") == 0).cast("double")).alias("n"))
    images = p.select("scene_id", F.when(F.col("e"), "fail").when(F.col("n") > 0.07, "skip").otherwise("ok").alias("status"))
    return quality.accepted_stacks(images, "scene_id", least=2)


_STATS = f"""SELECT scene_id, band, {mean_sql("least(greatest(dn / 6000.0, 0), 1)")} AS mean, avg(CASE WHEN dn / 6000.0 >= 1 THEN 1.0 ELSE 0.0 END) AS clip_frac
  FROM pixels WHERE dn <> 0 GROUP BY scene_id, band"""


def _stats(spark: SparkSession, d: str) -> DataFrame:
    p = carrier(spark, d, "pixels").withColumn("v", F.col("dn") / 6000.0)
    return analyse.patch_statistics(p, ["scene_id", "band"], "v", F.col("dn") != 0)


@query("a18_patch_statistics", f"SELECT scene_id, band, round(mean, 6)::DOUBLE AS mean, round(clip_frac, 6)::DOUBLE AS clip_frac FROM ({_STATS})")
def a18(spark: SparkSession, d: str) -> DataFrame:
    return _stats(spark, d).withColumns({c: rounded(c, 6) for c in ("mean", "clip_frac")})


@query("a19_clip_rates", f"SELECT band, round({mean_sql("clip_frac")}, 6)::DOUBLE AS mean_clip, round(max(clip_frac), 6)::DOUBLE AS max_clip FROM ({_STATS}) GROUP BY band")
def a19(spark: SparkSession, d: str) -> DataFrame:
    return analyse.clip_rates(_stats(spark, d)).withColumns({c: rounded(c, 6) for c in ("mean_clip", "max_clip")})


@query("a20_class_counts", """
SELECT habitat_class, CASE WHEN latitude >= 0 THEN 'north' ELSE 'south' END AS hemisphere, CAST((month(o_orderdate) - 1) // 3 AS INT) AS season, count(*) AS n
FROM samples JOIN orders ON location_id = o_custkey GROUP BY ALL""")  # fmt: skip
def a20(spark: SparkSession, d: str) -> DataFrame:
    hemisphere = F.when(F.col("latitude") >= 0, "north").otherwise("south").alias("hemisphere")
    return _dated_samples(spark, d).groupBy("habitat_class", hemisphere, season(F.col("day")).alias("season")).agg(F.count("*").alias("n"))


@query("a20_year_counts", """
SELECT habitat_class, CAST(year(o_orderdate) AS INT) AS year, count(*) AS n FROM samples JOIN orders ON location_id = o_custkey GROUP BY ALL""")
def a20_years(spark: SparkSession, d: str) -> DataFrame:
    return _dated_samples(spark, d).groupBy("habitat_class", F.year("day").alias("year")).agg(F.count("*").alias("n"))


def _dated_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples with the days of their acquisitions."""
    days = table(spark, d, "orders").select(F.col("o_custkey").alias("location_id"), F.col("o_orderdate").cast("date").alias("day"))
    return carrier(spark, d, "samples").join(days, "location_id")


@query("a21_depth_histogram", """
WITH q AS (SELECT greatest(quantile_cont(depth_m, 0.99), 1) AS hi FROM samples)
SELECT habitat_class, CAST(least(floor(depth_m / hi * 50), 49) AS INT) AS bin, count(*) AS n FROM samples, q WHERE depth_m BETWEEN 0 AND hi GROUP BY ALL""")
def a21(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples")
    top = quantiles(s, [], "depth_m", {"q": 0.99}).select(F.greatest("q", F.lit(1.0)).alias("hi"))
    return analyse.histogram(s.crossJoin(F.broadcast(top)), ["habitat_class"], "depth_m", F.lit(0.0), F.col("hi"), 50)


@query("a21_intensity_density", """
WITH c AS (SELECT band, CAST(least(floor(dn / 10000.0 * 59), 58) AS INT) AS bin, count(*) AS n FROM pixels WHERE dn > 0 AND dn <= 10000 GROUP BY ALL)
SELECT band, bin, round(n / sum(n) OVER (PARTITION BY band) * 59, 6)::DOUBLE AS density FROM c""")
def a21d(spark: SparkSession, d: str) -> DataFrame:
    p = carrier(spark, d, "pixels").where("dn > 0").withColumn("v", F.col("dn") / 10000.0)
    return analyse.histogram(p, ["band"], "v", F.lit(0.0), F.lit(1.0), 59, density=True).withColumn("density", rounded("density", 6))


@query("a22_time_gap", """
SELECT tile AS location_id, CAST(min(abs(date_diff('day', h.acq_date, l.acq_date))) AS INT) AS gap_days
FROM (SELECT * FROM scenes WHERE sensor = 'S2') h JOIN (SELECT * FROM scenes WHERE sensor = 'LS') l USING (tile) GROUP BY tile""")
def a22(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "scenes")
    high = s.where("sensor = 'S2'").select(F.col("tile").alias("location_id"), F.col("acq_date").alias("hr_date"))
    low = s.where("sensor = 'LS'").select(F.col("tile").alias("location_id"), F.col("acq_date").alias("lr_date"))
    return analyse.time_gap(high, low)


@query("a23_alignment_summary", """
WITH s AS (SELECT tile, cloud_cover / 8 AS m FROM scenes)
SELECT tile, round(median(m), 6)::DOUBLE AS median_px, round(quantile_cont(m, 0.95), 6)::DOUBLE AS p95_px, round(avg((m > 3)::INT), 6)::DOUBLE AS share_over_3,
  round(avg((m <= 1)::INT), 6)::DOUBLE AS share_to_1, round(avg((m <= 3)::INT), 6)::DOUBLE AS share_to_3, round(avg((m <= 10)::INT), 6)::DOUBLE AS share_to_10 FROM s GROUP BY tile""")  # fmt: skip
def a23(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "scenes").select("tile", (F.col("cloud_cover") / 8).alias("m"))
    out = analyse.alignment_summary(s, ["tile"], "m")
    return out.select("tile", *(rounded(c, 6).alias(c) for c in out.columns if c != "tile"))


@query("a24_issue_report", """
WITH i AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'glint' WHEN 1 THEN 'landsat_clipped' ELSE 'missing_highres_file' END AS code, o_custkey AS sample FROM orders)
SELECT CASE WHEN code = 'missing_highres_file' THEN 'FILE COUNTS' ELSE 'DATA QUALITY' END AS section, code, count(*) AS n, count(DISTINCT sample) AS n_samples FROM i GROUP BY ALL""")
def a24(spark: SparkSession, d: str) -> DataFrame:
    o, m = table(spark, d, "orders"), F.col("o_orderkey") % 3
    parts = [quality.issues(o, c, m == i, "o_custkey", F.lit("")) for i, c in enumerate(("glint", "landsat_clipped", "missing_highres_file"))]
    return curation.issue_report(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("a25_review_progress", """
SELECT CASE location_id % 5 WHEN 0 THEN 'keep' WHEN 1 THEN 'delete' WHEN 2 THEN 'replace_lr' END AS action, count(*) AS n FROM samples GROUP BY ALL""")
def a25(spark: SparkSession, d: str) -> DataFrame:
    s, m = carrier(spark, d, "samples").select("location_id"), F.col("location_id") % 5
    decisions = s.select("location_id", F.when(m == 0, "keep").when(m == 1, "delete").when(m == 2, "replace_lr").alias("action")).where("action IS NOT NULL")
    return curation.review_progress(s, decisions)


@query("a26_remaining_quota", """
SELECT h AS habitat_class, t AS target, count(location_id) AS existing, greatest(0, t - count(location_id)) AS remaining
FROM (VALUES ('coral', 400::BIGINT), ('seagrass', 100), ('kelp', 7)) v(h, t) LEFT JOIN samples ON habitat_class = h GROUP BY h, t""")
def a26(spark: SparkSession, d: str) -> DataFrame:
    targets = spark.createDataFrame([("coral", 400), ("seagrass", 100), ("kelp", 7)], "habitat_class string, target long")
    return curation.remaining_quota(targets, carrier(spark, d, "samples"), "habitat_class")
