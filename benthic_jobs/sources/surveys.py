"""Readers of field surveys: CSV with untidy headers, unit rows, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, labels
from ..storage import stored
from . import trees

#: The fields of a file's transect records.
TRANSECTS = (
    "array<struct<ID: bigint, Transect: string, BaySegment: string, AssessmentYear: int, MonitoringAgency: string, Observation: array<struct<"
    "Site: double, Depth: double, ObservationDate: string, Species: string, SpeciesAbundance: string, BladeLength_Avg: double, BladeLength_StdDev: double, "
    "ShootDensity_Avg: double, ShootDensity_StdDev: double, EpiphyteDensity: string, SedimentType: string>>>>"
)


def clean_names(names: list[str]) -> list[str]:
    """Without a byte order mark and outer blanks; a blank name is the date column. Repeated names get a number."""
    out: list[str] = []
    for raw in names:
        name = raw.replace("﻿", "").strip()
        name = "Date" if not name or name.startswith(("Unnamed:", "_c")) else name
        out.append(name if name not in out else f"{name}_{out.count(name) + 1}")
    return out


def read_survey_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """Rows of a CSV with a header, cleaned; columns of ``types`` are cast, bad values NULL, empty texts NULL."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    rows = raw.toDF(*clean_names(raw.columns))
    rows = rows.select(*(F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in rows.columns))
    return rows.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in (types or {}).items()})


def read_unit_row_csv(spark: SparkSession, path: str, names: list[str], *, lon: str, lat: str, dms: bool = False, south: bool = False) -> DataFrame:
    """A CSV without a usable header: rows without a number in the plot column (titles, units) go.

    Coordinates are DMS or decimal; ``south`` makes latitudes negative.
    """
    schema = ", ".join(f"`{n}` string" for n in names)
    rows = spark.read.schema(schema).option("header", False).option("escape", "\"").csv(path)
    rows = rows.where(F.col(names[0]).rlike(r"\d")).where(labels.number(F.regexp_extract(names[0], r"(\d+)", 1)).isNotNull())
    degrees = labels.dms_to_degrees if dms else labels.number
    at = degrees(F.col(lat))
    return rows.withColumns({lon: degrees(F.col(lon)), lat: -F.abs(at) if south else at})


def observations(records: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Nested transect records as one row for each observation, placed on their transect.

    Observations without a site, of unknown transects or of transects without a positive length go. ``endpoints``:
    Transect, length_m, start_lon, start_lat, end_lon, end_lat (a row for each transect). Names come without outer blanks.
    """
    name = F.trim("Transect").alias("Transect")
    rows = records.select("ID", name, F.trim("BaySegment").alias("BaySegment"), "AssessmentYear", "MonitoringAgency", F.explode("Observation").alias("o"))
    rows = rows.where("o.Site IS NOT NULL").join(endpoints.where("length_m > 0"), "Transect")
    place = lambda a, z: geometry.interpolate(F.col("o.Site"), F.col("length_m"), F.col(a), F.col(z))
    return rows.select(
        "ID", "Transect", "BaySegment", "AssessmentYear", F.col("o.Site").alias("site_m"), (F.abs("o.Depth") / 100).alias("depth_m"),
        labels.parse_date(F.col("o.ObservationDate")).alias("obs_date"), F.trim("o.Species").alias("species"), F.trim("o.SpeciesAbundance").alias("species_abundance"),
        labels.abundance_code(F.col("o.SpeciesAbundance")).alias("abundance"), place("start_lon", "end_lon").alias("lon"), place("start_lat", "end_lat").alias("lat"),
        F.col("o.BladeLength_Avg").alias("blade_length_avg"), F.col("o.BladeLength_StdDev").alias("blade_length_stddev"),
        F.col("o.ShootDensity_Avg").alias("shoot_density_avg"), F.col("o.ShootDensity_StdDev").alias("shoot_density_stddev"),
        F.col("o.EpiphyteDensity").alias("epiphyte_density"), F.col("o.SedimentType").alias("sediment_type"), F.col("MonitoringAgency").alias("monitoring_agency"),
    )


def read_transects(spark: SparkSession, folder: str, endpoints: DataFrame, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """The observations of all files under a folder, each an array of transect records, and (path, problem) of the files that are none.

    A file with one record alone counts as an array of it; an empty array has no observations and is no problem.
    """
    read = trees.texts(trees.files(spark, folder, glob), folder)
    parsed = read.withColumn("records", F.from_json("text", TRANSECTS, {"mode": "PERMISSIVE"}))
    # A single malformed record comes back as one without any field.
    blank = F.exists("records", lambda r: r.isNull()) | (F.size("records") == 1) & F.col("records")[0]["ID"].isNull() & F.col("records")[0]["Transect"].isNull()
    why = F.coalesce("problem", F.when(F.col("records").isNull() | blank, "no JSON of transects"))
    rows = stored(parsed.select("path", "records", why.alias("problem")), "transects")
    records = rows.where("problem IS NULL").select(F.explode("records").alias("r")).select("r.*")
    return observations(records, endpoints), rows.where("problem IS NOT NULL").select("path", "problem")


def scene_index(paths: DataFrame, path: str = "path") -> DataFrame:
    """Date and sensor from file names; files without either go."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    day = F.regexp_extract(name, r"(\d{4})[-_](\d{2})[-_](\d{2})", 0)
    date = F.try_to_timestamp(F.regexp_replace(day, "_", "-"), F.lit("yyyy-MM-dd")).cast("date")
    return paths.select(F.col(path).alias("path"), date.alias("date"), _sensor(F.upper(name)).alias("sensor")).where("date IS NOT NULL AND sensor IS NOT NULL")


def _sensor(name: Column) -> Column:
    return F.when(name.rlike("S2A|S2B|MSI|SENTINEL-?2"), "S2").when(name.rlike("L8|L9|LC08|LC09|OLI|LANDSAT"), "LS")


def read_scene_index(spark: SparkSession, folder: str, glob: str = "*.nc") -> tuple[DataFrame, DataFrame]:
    """The index of the files under a folder, and (path, problem) of folders that can't be listed. Contents are not read."""
    found = trees.files(spark, folder, glob)
    return scene_index(found.where("problem IS NULL")), found.where("problem IS NOT NULL").select("path", "problem")
