"""Queries of the sources and sinks (S1-S8) and the stream: derived inputs are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import manifests, surveys, trees
from ..storage import new_dir
from ..streaming.resumable import collect_new_metadata, screen_new_images, screened_images
from .carriers import carrier, table
from .registry import mean_sql, query, rounded


def _new(spark: SparkSession, name: str) -> str:
    return new_dir(spark, name)


@query("s01_survey_csv", """
SELECT p_partkey AS "Station", CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END AS "Location", CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS "Coverage", p_brand AS "Date"
FROM part""")  # fmt: skip
def s01(spark: SparkSession, d: str) -> DataFrame:
    at = _new(spark, "survey")
    cover = F.when(F.col("p_size") % 7 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    rows = table(spark, d, "part").select(
        F.col("p_partkey").alias("﻿Station "), F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.concat(F.lit(" "), "p_name")).alias(" Location"),
        cover.alias("Coverage"), F.col("p_brand").alias("Unnamed: 3"),
    )
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(at)
    return surveys.read_survey_csv(spark, at, {"Station": "bigint", "Coverage": "double"})


@query("s02_unit_row_csv", """
SELECT CAST(s_suppkey AS VARCHAR) AS plot, s_suppkey % 90 + 0.5::DOUBLE AS lon, -(s_suppkey % 60 + 0.25)::DOUBLE AS lat FROM supplier""")
def s02(spark: SparkSession, d: str) -> DataFrame:
    at, key = _new(spark, "plots"), F.col("s_suppkey")
    rows = table(spark, d, "supplier").select(
        key.cast("string").alias("plot"), F.concat((key % 90).cast("string"), F.lit("°30'0\"E")).alias("lon"), F.concat((key % 60).cast("string"), F.lit("°15′0″")).alias("lat")
    )
    head = spark.createDataFrame([("Plot", "Longitude", "Latitude"), ("", "dms", "dms")], rows.schema)
    head.unionByName(rows).write.option("header", False).option("escape", '"').csv(at)
    return surveys.read_unit_row_csv(spark, at, ["plot", "lon", "lat"], lon="lon", lat="lat", dms=True, south=True)


_BAD_FILES = "o_orderkey // 64 % 9 = 5"


@query("s03_transects", f"""
SELECT o_orderkey AS "ID", CAST(o_custkey % 50 AS VARCHAR) AS "Transect", l_quantity AS site_m, round(l_tax * 1000 / 100, 6)::DOUBLE AS depth_m, CAST(l_shipdate AS DATE) AS obs_date,
  round(-82.5 + least(l_quantity / (o_custkey % 50), 1) * 0.1, 6)::DOUBLE AS lon, l_linenumber / 2::DOUBLE AS blade_length_avg, NULL AS file, NULL AS problem
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 50 BETWEEN 1 AND 39 AND l_linenumber <> 4 AND NOT {_BAD_FILES}
UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, NULL::DATE, NULL, NULL, o_orderkey // 64 % 10 || '/' || o_orderkey // 64 || '.json', 'no JSON of transects'
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {_BAD_FILES}""")  # fmt: skip
def s03(spark: SparkSession, d: str) -> DataFrame:
    """Files of up to 64 records in ten folders; one in nine is cut off before its end."""
    at = _new(spark, "transects")
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    seen = F.struct(
        F.when(F.col("l_linenumber") != 4, F.col("l_quantity")).alias("Site"), (F.col("l_tax") * -1000).alias("Depth"), F.date_format("l_shipdate", "yyyyMMdd").alias("ObservationDate"),
        F.concat(F.lit(" "), "l_returnflag").alias("Species"), F.lit("2 = sparse").alias("SpeciesAbundance"), (F.col("l_linenumber") / 2).alias("BladeLength_Avg"),
    )
    key = F.concat((F.col("o_custkey") % 50).cast("string"), F.lit(" ")).alias("Transect")
    records = rows.groupBy(F.col("o_orderkey").alias("ID"), key).agg(F.collect_list(seen).alias("Observation"))
    texts = records.groupBy(F.expr("ID DIV 64").alias("n")).agg(F.to_json(F.collect_list(F.struct("ID", "Transect", "Observation"))).alias("text"))
    cut = F.when(F.col("n") % 9 == 5, F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    trees.write_texts(texts.select(F.concat((F.col("n") % 10).cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(".json")).alias("path"), cut.alias("text")), at)
    ends = spark.range(40).select(
        F.col("id").cast("string").alias("Transect"), F.col("id").cast("double").alias("length_m"), F.lit(-82.5).alias("start_lon"), F.lit(27.0).alias("start_lat"),
        F.lit(-82.4).alias("end_lon"), F.lit(27.1).alias("end_lat"),
    )
    out, bad = surveys.read_transects(spark, at, ends)
    out = out.select("ID", "Transect", "site_m", rounded("depth_m", 6).alias("depth_m"), "obs_date", rounded("lon", 6).alias("lon"), "blade_length_avg")
    return out.unionByName(bad.select(F.col("path").alias("file"), "problem"), allowMissingColumns=True)


@query("s04_scene_index", """
SELECT o_orderkey % 20 || '/' || CASE o_orderkey % 4 WHEN 0 THEN 'S2A_MSI_' WHEN 1 THEN 'LC08_' ELSE 'L9_oli_' END || strftime(o_orderdate, '%Y_%m_%d') || '_' || o_orderkey || '.nc' AS path,
  CAST(o_orderdate AS DATE) AS date, CASE WHEN o_orderkey % 4 = 0 THEN 'S2' ELSE 'LS' END AS sensor FROM orders WHERE o_orderkey % 4 <> 2 AND o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0""")  # fmt: skip
def s04(spark: SparkSession, d: str) -> DataFrame:
    """A file for each order in twenty folders; some without a sensor or a date in their name, some of another kind."""
    at, m = _new(spark, "scenes"), F.col("o_orderkey") % 4
    head = F.when(m == 0, "S2A_MSI_").when(m == 1, "LC08_").when(m == 2, "x_").otherwise("L9_oli_")
    day = F.when(F.col("o_orderkey") % 10 == 0, "undated").otherwise(F.date_format("o_orderdate", "yyyy_MM_dd"))
    tail = F.when(F.col("o_orderkey") % 7 == 0, ".log").otherwise(".nc")
    path = F.concat((F.col("o_orderkey") % 20).cast("string"), F.lit("/"), head, day, F.lit("_"), F.col("o_orderkey").cast("string"), tail)
    trees.write_empty(table(spark, d, "orders").select(path.alias("path")), at)
    return surveys.read_scene_index(spark, at)[0]


def _samples(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples")
    images = F.transform(F.sequence(F.lit(1), F.col("lowres_count") + 1), lambda i: F.concat(F.lit("S2/"), i.cast("string")))
    count = F.when(F.col("location_id") % 2 == 0, F.col("lowres_count"))
    return s.withColumns({"lowres_images": F.when(F.col("location_id") % 6 != 5, images), "highres_item_ids": F.when(F.col("location_id") % 6 != 5, images), "lowres_count": count})


@query("s05_manifest_write", """
SELECT CAST(location_id AS VARCHAR) AS location_id, coalesce(habitat_class, '') AS habitat_class, CASE WHEN location_id % 6 = 5 THEN '' ELSE
  '["S2/1"' || coalesce((SELECT string_agg(',"S2/' || i || '"', '' ORDER BY i) FROM range(2, lowres_count + 2) t(i)), '') || ']' END AS highres_item_ids, '' AS province,
  CASE WHEN location_id % 2 = 0 THEN lowres_count::VARCHAR WHEN location_id % 6 = 5 THEN '' ELSE (lowres_count + 1)::VARCHAR END AS lowres_count FROM samples""")  # fmt: skip
def s05(spark: SparkSession, d: str) -> DataFrame:
    return manifests.to_manifest(_samples(spark, d)).select("location_id", "habitat_class", "highres_item_ids", "province", "lowres_count")


@query("s06_manifest_read", """
SELECT location_id, habitat_class, depth_m, CASE WHEN location_id % 6 = 5 THEN NULL ELSE lowres_count + 1 END AS n_images,
  CASE WHEN location_id % 2 = 0 THEN lowres_count WHEN location_id % 6 = 5 THEN NULL ELSE lowres_count + 1 END AS lowres_count FROM samples""")  # fmt: skip
def s06(spark: SparkSession, d: str) -> DataFrame:
    at = _new(spark, "manifest")
    manifests.write_manifest(_samples(spark, d), at)
    rows = manifests.read_manifest(spark, at)
    n = F.col("highres_count")
    return rows.select("location_id", "habitat_class", "depth_m", n.alias("n_images"), "lowres_count")


@query("s07_sensor_outputs", """
SELECT 'S2' AS sensor, scene_id, prow, pcol, b4 AS red, b8 AS nir FROM stacks UNION ALL SELECT 'LS', scene_id, prow, pcol, b4, b5 FROM stacks""")
def s07(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    wide = carrier(spark, d, "stacks").select("scene_id", "prow", "pcol", c("b4").alias("s2_red"), c("b8").alias("s2_nir"), c("b4").alias("ls_red"), c("b5").alias("ls_nir"))
    parts = manifests.sensor_outputs(wide, ["scene_id", "prow", "pcol"], {"S2": "s2_", "LS": "ls_"})
    out = None
    for name, rows in parts.items():
        at = _new(spark, f"sensor-{name}")
        rows.write.parquet(at)
        rows = spark.read.parquet(at).withColumnsRenamed({f"{name.lower()}_{b}": b for b in ("red", "nir")}).select(F.lit(name).alias("sensor"), "scene_id", "prow", "pcol", "red", "nir")
        out = rows if out is None else out.unionByName(rows)
    return out


_CHECKPOINT = "location_id long, habitat_class string, depth_m double"


@query("s08_rebuild_metadata", """
SELECT location_id, habitat_class, depth_m, NULL AS problem FROM samples WHERE location_id % 8 > 2
UNION ALL SELECT location_id, NULL, NULL, CASE location_id % 8 WHEN 2 THEN 'no file' ELSE 'no JSON with a key' END FROM samples WHERE location_id % 8 <= 2""")
def s08(spark: SparkSession, d: str) -> DataFrame:
    """A folder for each sample; of eight one has a broken file, one a file without a key, one another file alone."""
    at, s, m = _new(spark, "checkpoints"), carrier(spark, d, "samples").select("location_id", "habitat_class", "depth_m"), F.col("location_id") % 8
    manifests.write_checkpoints(s.where(m > 2), at, "location_id")
    name = F.when(m == 2, "notes.txt").otherwise(manifests.CHECKPOINT)
    path = F.concat(F.lit(manifests.SAMPLE), F.col("location_id").cast("string"), F.lit("/"), name)
    trees.write_texts(s.where(m <= 2).select(path.alias("path"), F.when(m == 1, '{"other": 1}').otherwise("{oops").alias("text")), at)
    good, bad = manifests.read_checkpoints(spark, at, _CHECKPOINT, "location_id")
    bad = bad.select(F.expr(f"CAST(substr(sample, {len(manifests.SAMPLE) + 1}) AS BIGINT)").alias("location_id"), "problem")
    return good.unionByName(bad, allowMissingColumns=True)


@query("stream_screen_new_images", f"""
WITH m AS (SELECT scene_id, {mean_sql("CASE WHEN b8 > 0 THEN b8 END")} AS n, {mean_sql("CASE WHEN b2 > 0 THEN b2 END")} AS b FROM stacks GROUP BY scene_id)
SELECT scene_id, round(n, 6) AS nir_mean, round(b, 6) AS blue_mean, CASE WHEN n > 0.25 AND b > 0.12 THEN 'glint' WHEN b > 0.25 THEN 'haze' ELSE 'ok' END AS screen FROM m""")  # fmt: skip
def stream_images(spark: SparkSession, d: str) -> DataFrame:
    source, out, checkpoint = (_new(spark, f"stream-{n}") for n in ("in", "out", "state"))
    s = carrier(spark, d, "stacks").select("scene_id", "prow", "b2", "b8")
    for part in (0, 1):  # every image arrives in two parts, each summed up by a run of its own
        s.where(F.col("prow") % 2 == part).write.mode("append").parquet(source)
        screen_new_images(spark, source, s.schema, out, checkpoint, keys=["scene_id"], nir="b8", blue="b2")
    rows = screened_images(spark, out, ["scene_id"])
    return rows.select("scene_id", rounded("nir_mean", 6).alias("nir_mean"), rounded("blue_mean", 6).alias("blue_mean"), "screen")


@query("stream_collect_metadata", "SELECT location_id, habitat_class, depth_m FROM samples WHERE location_id % 8 > 1")
def stream_metadata(spark: SparkSession, d: str) -> DataFrame:
    folder, out, checkpoint = (_new(spark, f"meta-{n}") for n in ("in", "out", "state"))
    s, m = carrier(spark, d, "samples"), F.col("location_id") % 8
    text = F.when(m == 0, "{oops").when(m == 1, '{"other": 1}').otherwise(F.to_json(F.struct("location_id", "habitat_class", "depth_m")))
    s.select(text.alias("value")).repartition(8).write.option("lineSep", "\n").text(folder)
    collect_new_metadata(spark, folder, _CHECKPOINT, "location_id", out, checkpoint)
    return spark.read.schema(_CHECKPOINT).parquet(out)
