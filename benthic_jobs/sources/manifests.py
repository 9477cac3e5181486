"""Manifests and per-sample metadata: CSV and JSON in and out. JSON texts only at the edge; NULL inside."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import stored
from . import trees

#: How a sample's folder begins, and the file in it.
SAMPLE, CHECKPOINT = "sample_", "sample_metadata.json"

#: Fixed values. Column and type of the manifest, in order; ``json`` columns are texts of lists in the file.
COLUMNS = [
    ("location_id", "bigint"), ("latitude", "double"), ("longitude", "double"), ("season_id", "int"), ("province", "string"), ("habitat_class", "string"),
    ("depth_m", "double"), ("date_range_start", "string"), ("date_range_end", "string"), ("alignment_crs", "string"), ("patch_size_pixels", "int"),
    ("patch_size_meters", "double"), ("target_origin_x", "double"), ("target_origin_y", "double"), ("lowres_satellite", "string"), ("lowres_count", "int"),
    ("highres_satellite", "string"), ("highres_item_ids", "json"), ("highres_order_id", "string"), ("highres_product_bundle", "string"),
    ("highres_aoi_geojson", "string"), ("highres_count", "int"),
]


def to_manifest(samples: DataFrame) -> DataFrame:
    """Texts in a fixed column order: lists as JSON, NULL or a missing column as an empty text.

    Counts by one rule: the count after QA if there is one, else the size of ``lowres_images`` or of the item ids.
    """
    none = F.lit(None).cast("string")
    have = lambda c: F.col(c) if c in samples.columns else none
    size = lambda c: F.size(c) if c in samples.columns else none.cast("int")
    value = {c: have(c) for c, _ in COLUMNS}
    value["lowres_count"] = F.coalesce(have("lowres_count").cast("int"), size("lowres_images"))
    value["highres_count"] = F.coalesce(have("highres_count").cast("int"), size("highres_item_ids"))
    text = {c: F.to_json(value[c]) if t == "json" and c in samples.columns else value[c].cast("string") for c, t in COLUMNS}
    return samples.select(*(F.coalesce(x, F.lit("")).alias(c) for c, x in text.items()))


def from_manifest(rows: DataFrame) -> DataFrame:
    """Types back: numbers where there are any, JSON only where a text begins with a bracket, else the raw text in ``<name>_raw``."""
    out = []
    for c, t in COLUMNS:
        raw = F.nullif(F.col(c), F.lit(""))
        if t == "json":
            like = raw.rlike(r"^[\[{]")
            out += [F.when(like, F.from_json(raw, "array<string>")).alias(c), F.when(~like, raw).alias(f"{c}_raw")]
        else:
            out.append(raw.try_cast(t).alias(c))
    return rows.select(*out)


def write_manifest(samples: DataFrame, path: str, form: str = "csv") -> None:
    rows = to_manifest(samples)
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path) if form == "csv" else rows.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{c} string" for c, _ in COLUMNS)
    return from_manifest(spark.read.schema(schema).option("header", True).option("escape", '"').csv(path).na.fill(""))


def rebuild(texts: DataFrame, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Per-sample JSON texts (path, json) as one metadata table, and the paths that hold none or have no key."""
    parsed = texts.withColumn("r", F.from_json("json", schema, {"mode": "PERMISSIVE"}))
    good = F.col("r").isNotNull() & F.col(f"r.{key}").isNotNull()
    return parsed.where(good).select("r.*"), parsed.where(~good).select("path")


def write_checkpoints(samples: DataFrame, folder: str, key: str) -> int:
    """A folder ``sample_<key>`` with one JSON file for each sample; rows without a key have no folder. Returns their number."""
    path = F.concat(F.lit(SAMPLE), F.col(key).cast("string"), F.lit(f"/{CHECKPOINT}"))
    text = F.to_json(F.struct(*(F.col(f"`{c}`") for c in samples.columns)))
    return trees.write_texts(samples.where(F.col(key).isNotNull()).select(path.alias("path"), text.alias("text")), folder)


def read_checkpoints(spark: SparkSession, folder: str, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The metadata of all sample folders of ``folder``, and what was skipped: (sample, problem).

    A sample folder lies directly in ``folder`` and its name begins with ``sample_``. It is skipped if it has no metadata file, or one
    that can't be read, is no JSON or has no key. Other files and folders don't count. Files are listed and read by tasks, each
    read once: the parsed rows are stored, so that both results come from the same read.
    """
    entries = trees.entries(spark, folder)
    top = entries.where(F.col("is_folder") & F.col("path").rlike(f"^{SAMPLE}[^/]*$"))
    of = F.regexp_extract("path", f"^({SAMPLE}[^/]*)/{re.escape(CHECKPOINT)}$", 1)
    found = trees.texts(entries.where(~F.col("is_folder") & (of != "")), folder).withColumn("sample", of)
    # A folder that can't be listed comes twice: as a name, and with its problem.
    named = top.groupBy(F.col("path").alias("sample")).agg(F.max("problem").alias("unlisted"))
    rows = named.join(found, "sample", "left").withColumn("r", F.from_json("text", schema, {"mode": "PERMISSIVE"}))
    why = F.coalesce("unlisted", "problem", F.when(F.col("path").isNull(), "no file").when(F.col(f"r.{key}").isNull(), "no JSON with a key"))
    rows = stored(rows.select("sample", "r", why.alias("problem")), "checkpoints")
    return rows.where("problem IS NULL").select("r.*"), rows.where("problem IS NOT NULL").select("sample", "problem")


def sensor_outputs(wide: DataFrame, shared: list[str], prefixes: dict[str, str]) -> dict[str, DataFrame]:
    """One table for each sensor: the shared columns and those with its prefix."""
    return {s: wide.select(*shared, *(c for c in wide.columns if c.startswith(p))) for s, p in prefixes.items()}
