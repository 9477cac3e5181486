"""Three workloads end to end: survey to feature table, pair building, check of a built data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spectral
from ..functions.sensors import specs
from ..functions import exact
from ..operators import collapse, curation, matching, quality, sampling
from ..storage import stored
from .carriers import carrier
from .q_aggregates import _BENTHIC, benthic
from .q_joins import stack_count
from .q_rasters import _FILES_SQL, _files, _flags
from .registry import mean_sql, query, rounded

_W1 = f"""
WITH n AS (SELECT site, genus, count(*) AS n FROM annotations WHERE genus IS NOT NULL GROUP BY ALL),
h AS (SELECT site, sum(-p * ln(p)) AS shannon FROM (SELECT site, n / sum(n) OVER (PARTITION BY site) AS p FROM n) GROUP BY site),
s AS (SELECT site, min(island) AS island, min(survey_date) AS survey_date, count(*) AS n_points, CAST(site AS INT) AS tile,
        round(sum(CASE WHEN {_BENTHIC} AND category = 'LARGE' THEN 1 ELSE 0 END) * 100.0 / nullif(sum(CASE WHEN {_BENTHIC} THEN 1 ELSE 0 END), 0), 6)::DOUBLE AS cover_large
      FROM annotations GROUP BY site),
m AS (SELECT site, scene_id, dist FROM (
  SELECT site, scene_id, abs(date_diff('day', survey_date, acq_date)) AS dist,
         row_number() OVER (PARTITION BY site ORDER BY abs(date_diff('day', survey_date, acq_date)), acq_date, scene_id) AS r
  FROM s JOIN scenes USING (tile) WHERE sensor = 'S2' AND abs(date_diff('day', survey_date, acq_date)) <= 45) WHERE r = 1)
SELECT s.site, island, survey_date, n_points, cover_large, round(shannon, 6) AS shannon, m.scene_id, CAST(dist AS INT) AS dist,
  round((b8 - b4) / nullif(b8 + b4, 0), 6) AS ndvi, CASE WHEN b2 > 0 AND b3 > 0 THEN round(ln(b2) - 1.8 * ln(b3), 6) END AS lyzenga_b2b3
FROM s LEFT JOIN h ON h.site = s.site LEFT JOIN m ON m.site = s.site
LEFT JOIN stacks x ON x.scene_id = m.scene_id % (SELECT max(vec_id) // 8 + 1 FROM embeddings) AND x.prow = s.site % 8 AND x.pcol = s.site % 5"""  # fmt: skip


@query("w1_survey_features", _W1)
def survey_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations to sites, each with its nearest scene's pixel and features."""
    points, scenes = carrier(spark, sf_dir, "annotations"), carrier(spark, sf_dir, "scenes").where("sensor = 'S2'")
    counts = points.groupBy("site", "category", "genus").agg(F.min("island").alias("island"), F.min("survey_date").alias("day"), F.count("*").alias("n"))
    counts = stored(counts, "counts")  # the annotations are a join of three tables: once is enough
    of = lambda c: F.sum(F.when(c, F.col("n")))
    labelled, large = benthic() & F.col("category").isNotNull(), benthic() & (F.col("category") == "LARGE")
    cover = F.when(of(labelled) > 0, F.coalesce(of(large), F.lit(0)) * 100.0 / of(benthic())).alias("cover_large")
    sites = counts.groupBy("site").agg(F.min("island").alias("island"), F.min("day").alias("survey_date"), F.sum("n").alias("n_points"), cover)
    sites = sites.join(collapse.shannon_of_counts(counts, "site", "genus", "n"), "site", "left")
    sites = sites.withColumn("tile", F.col("site").cast("int"))
    found = matching.nearest_scene(sites, scenes, ["tile"], "survey_date", "acq_date", "scene_id", 45)
    found = found.crossJoin(F.broadcast(stack_count(spark, sf_dir)))
    at = found.withColumns({"stack": F.col("scene_id") % F.col("n_stacks"), "prow": (F.col("site") % 8).cast("int"), "pcol": (F.col("site") % 5).cast("int")})
    pixels = carrier(spark, sf_dir, "stacks").withColumnRenamed("scene_id", "stack").withColumn("all", F.struct(*(f"b{i}" for i in range(1, 9))))
    rows = sampling.at_cells(at, pixels, ["stack", "prow", "pcol"], "all").select(*at.columns, "all.*")
    dii = spectral.depth_invariant("S2", "")["lyzenga_b2b3"]
    ndvi = spectral.normalised_difference(F.col("b8"), F.col("b4"))
    named = {k: rounded(v, 6).alias(k) for k, v in {"cover_large": F.col("cover_large"), "shannon": F.col("shannon"), "ndvi": ndvi, "lyzenga_b2b3": dii}.items()}
    return rows.select("site", "island", "survey_date", "n_points", named["cover_large"], named["shannon"], "scene_id", "dist", named["ndvi"], named["lyzenga_b2b3"])


@query("w2_build_pairs", """
WITH q(h, quota) AS (VALUES ('coral', 60), ('seagrass', 60), ('mangrove', 60)),
h AS (
  SELECT location_id, habitat_class, tile, scene_id AS hr_id, acq_date AS hr_date, scene_id % 3 <> 0 AS qa_ok, r FROM (
    SELECT location_id, habitat_class, tile, scene_id, acq_date, row_number() OVER (PARTITION BY location_id ORDER BY cloud_cover, md5('42|' || scene_id), scene_id) AS r
    FROM samples JOIN scenes USING (tile) WHERE sensor = 'S2' AND cloud_cover < 20 AND habitat_class IS NOT NULL) WHERE r <= 30),
n AS (SELECT location_id, hr_id, least(count(*), 8) AS n FROM h JOIN (SELECT tile, acq_date FROM scenes WHERE sensor = 'LS' AND cloud_cover < 60) USING (tile)
  WHERE abs(date_diff('day', hr_date, acq_date)) <= 180 GROUP BY ALL),
x AS (SELECT h.*, coalesce(n, 0) AS n_low, sum(CASE WHEN coalesce(n, 0) < 3 THEN 1 ELSE 0 END) OVER (PARTITION BY location_id ORDER BY r) AS short
  FROM h LEFT JOIN n USING (location_id, hr_id)),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY r) AS k FROM x WHERE short = 0 AND qa_ok) WHERE k = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY habitat_class ORDER BY md5('8|' || location_id), location_id) AS place FROM b)
SELECT row_number() OVER (ORDER BY location_id) - 1 AS sample_id, location_id, habitat_class, hr_id, CAST(n_low AS INT) AS n_low
FROM p JOIN q ON q.h = habitat_class WHERE place <= quota""")  # fmt: skip
def build_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of every location, paired and tested in one pass; the first ones of each habitat up to its quota."""
    scenes = carrier(spark, sf_dir, "scenes")
    places = carrier(spark, sf_dir, "samples").where("habitat_class IS NOT NULL").select("location_id", "habitat_class", "tile")
    order = [*matching.quality_order(F.col("cloud_cover"), F.col("scene_id"), 42), "scene_id"]
    best = matching.top_k(scenes.where("sensor = 'S2' AND cloud_cover < 20"), ["tile"], order, 30)  # the order is the same for all places
    high = places.drop("habitat_class").join(best, "tile").select("location_id", "tile", F.col("scene_id").alias("hr_id"), F.col("acq_date").alias("hr_date"), "rank", (F.col("scene_id") % 3 != 0).alias("qa_ok"))
    low = scenes.where("sensor = 'LS'").select("tile", F.col("scene_id").alias("lr_id"), F.col("acq_date").alias("lr_date"), "cloud_cover")
    pairs = matching.pair_resolutions(high, low, keys=["tile"], days=180, least=3, cloud=60).join(places.select("location_id", "habitat_class"), "location_id")
    strata = spark.createDataFrame([(h,) for h in curation.HABITATS], "habitat_class string")
    total = 180
    quota = curation.equal_split(strata, "habitat_class", total, 8)
    seeded = pairs.withColumn("seeded", matching.seeded(F.col("location_id"), 8))
    ranked = matching.top_k_dealt(seeded, ["habitat_class"], ["seeded", "location_id"], total, F.col("seeded"))  # no quota is over the total
    kept = ranked.join(F.broadcast(quota), "habitat_class").where("rank <= quota")
    none = spark.createDataFrame([], "sample_id long")
    return curation.allocate_ids(kept, none, none, ["location_id"], "sample_id").select("sample_id", "location_id", "habitat_class", "hr_id", "n_low")


@query("w3_check_dataset", f"""
WITH {_FILES_SQL},
b AS (SELECT location_id FROM f WHERE bands <> n_bands OR width <= 1 OR is_empty UNION SELECT location_id FROM samples WHERE location_id % 11 = 0
  UNION SELECT location_id FROM samples, range(6) t(k) WHERE (location_id + k) % 5 = 0 AND location_id % 2 = 0)
SELECT habitat_class, count(*) AS n, round({mean_sql("depth_m")}, 6) AS mean_depth FROM samples WHERE location_id NOT IN (SELECT location_id FROM b) GROUP BY habitat_class""")  # fmt: skip
def check_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks as issues; the samples with any are dropped, and the rest is summarised."""
    samples, files = carrier(spark, sf_dir, "samples"), _files(spark, sf_dir)
    found = quality.raster_issues(files, specs(spark), "location_id")
    found = found.unionByName(quality.count_issues(samples.select("location_id", "lowres_count"), files, "location_id", "lowres_count").where("code = 'missing_highres_file'"))
    flags = _flags(spark, sf_dir).withColumn("swath", F.col("swath") & (F.col("location_id") % 2 == 0))
    found = found.unionByName(quality.scene_issues(flags, "location_id", "file").where("code = 'lr_swath_edge'"))
    kept, _, _ = curation.drop_listed(samples, found.select(F.col("sample").alias("location_id")), "location_id")
    return kept.groupBy("habitat_class").agg(F.count("*").alias("n"), rounded(exact.mean("depth_m"), 6).alias("mean_depth"))
