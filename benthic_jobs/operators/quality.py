"""Image and data set checks on long pixels and file tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..functions.spectral import bit

#: Fixed values. Issue codes by section.
SECTIONS = {
    "STRUCTURE": ["missing_sample_dir", "missing_metadata", "invalid_metadata"],
    "FILE COUNTS": ["lowres_count_mismatch", "missing_highres_file"],
    "RASTER INTEGRITY": ["raster_open_failed", "band_count_mismatch"],
    "DIMENSIONS": ["degenerate_raster", "hr_wrong_dimensions"],
    "GEOREFERENCING": ["hr_crs_mismatch", "hr_pixel_size_mismatch", "hr_origin_mismatch"],
    "VALUES": ["all_nodata"],
    "DATA QUALITY": ["landsat_clipped", "large_shift", "glint", "haze", "lr_swath_edge", "lr_cloud", "hr_partial"],
}


def is_nodata(value: Column, nodata: Column | float | None) -> Column:
    """NULL, NaN or the nodata value."""
    bad = value.isNull() | F.isnan(value.cast("double"))
    return bad if nodata is None else bad | F.coalesce(value == nodata, F.lit(False))


def empty_rasters(pixels: DataFrame, keys: list[str], value: str, nodata: float | None = None) -> DataFrame:
    """Whether a band is all zero or all nodata."""
    v = F.col(value)
    return pixels.groupBy(*keys).agg(
        (F.bool_and(F.coalesce(v == 0, F.lit(False))) | F.bool_and(is_nodata(v, nodata))).alias("is_empty")
    )


def nodata_and_cloud(pixels: DataFrame, keys: list[str], value: str, qa: str, nodata: float, *, most_nodata: float = 0.2, most_cloud: float = 0.1) -> DataFrame:
    """Share of nodata, share of valid pixels under cloud, and the finding: nodata, cloud or ok."""
    bad = is_nodata(F.col(value), nodata)
    rows = pixels.groupBy(*keys).agg(
        F.avg(bad.cast("double")).alias("nodata_frac"),
        F.coalesce(F.avg(F.when(~bad, bit(F.col(qa), 3).cast("double"))), F.lit(0.0)).alias("cloud_frac"),
    )
    finding = F.when(F.col("nodata_frac") > most_nodata, "nodata").when(F.col("cloud_frac") > most_cloud, "cloud").otherwise("ok")
    return rows.withColumn("finding", finding)


def glint_parts(wide: DataFrame, keys: list[str], nir: str, blue: str, valid: Column | None = None) -> DataFrame:
    """Exact sums and counts of the positive reflectances of both bands: parts of an image add up to it."""
    good = lambda c: F.when((F.col(c) > 0) & (F.lit(True) if valid is None else valid), F.col(c))
    each = {"nir": good(nir), "blue": good(blue)}
    return wide.groupBy(*keys).agg(
        *(F.sum(x.cast(exact.KIND)).cast("decimal(38,12)").alias(f"{n}_sum") for n, x in each.items()), *(F.count(x).alias(f"{n}_count") for n, x in each.items())
    )


def screened(parts: DataFrame, keys: list[str], *, glint_nir: float = 0.25, glint_blue: float = 0.12, haze: float = 0.25) -> DataFrame:
    """glint, haze or ok of each image, from all of its parts."""
    mean = lambda n: F.try_divide(F.sum(f"{n}_sum").cast("double"), F.sum(f"{n}_count")).alias(f"{n}_mean")
    rows = parts.groupBy(*keys).agg(mean("nir"), mean("blue"))
    flag = F.when((F.col("nir_mean") > glint_nir) & (F.col("blue_mean") > glint_blue), "glint")
    return rows.withColumn("screen", flag.when(F.col("blue_mean") > haze, "haze").otherwise("ok"))


def glint_haze(wide: DataFrame, keys: list[str], nir: str, blue: str, valid: Column | None = None, **limits: float) -> DataFrame:
    """glint, haze or ok, from band means over positive reflectances."""
    return screened(glint_parts(wide, keys, nir, blue, valid), keys, **limits)


def accepted_stacks(images: DataFrame, sample: str, *, least: int = 6) -> DataFrame:
    """A hard failure rejects the sample; else enough images must be ok. ``images``: sample, status (ok, skip, fail)."""
    rows = images.groupBy(sample).agg(F.bool_or(F.col("status") == "fail").alias("failed"), F.count_if(F.col("status") == "ok").alias("n_ok"))
    return rows.withColumn("accepted", ~F.col("failed") & (F.col("n_ok") >= least))


def issues(rows: DataFrame, code: str, when: Column, sample: str, detail: Column) -> DataFrame:
    section = next(s for s, codes in SECTIONS.items() if code in codes)
    return rows.where(when).select(F.lit(code).alias("code"), F.lit(section).alias("section"), F.col(sample).alias("sample"), detail.cast("string").alias("detail"))


def metadata_issues(manifest: DataFrame, files: DataFrame, sample: str, required: list[str]) -> DataFrame:
    """Samples without a metadata text, and with one that is no JSON or lacks a required field."""
    rows = manifest.select(sample).join(files.select(sample, "json"), sample, "left")
    fields = [F.get_json_object("json", f"$.{f}").isNotNull() for f in required]
    whole = fields[0]
    for f in fields[1:]:
        whole = whole & f
    return issues(rows, "missing_metadata", F.col("json").isNull(), sample, F.lit("no file")).unionByName(
        issues(rows, "invalid_metadata", F.col("json").isNotNull() & ~F.coalesce(whole, F.lit(False)), sample, F.lit("fields"))
    )


def count_issues(manifest: DataFrame, files: DataFrame, sample: str, count: str) -> DataFrame:
    """File counts other than the manifest's, and samples without a high-resolution file."""
    found = files.groupBy(sample).agg(F.count_if(F.col("role") == "lr").alias("n_lr"), F.count_if(F.col("role") == "hr").alias("n_hr"))
    rows = manifest.join(found, sample, "left").na.fill(0, ["n_lr", "n_hr"])
    detail = F.concat_ws("/", F.col("n_lr").cast("string"), F.col(count).cast("string"))
    return issues(rows, "lowres_count_mismatch", F.col("n_lr") != F.col(count), sample, detail).unionByName(
        issues(rows, "missing_highres_file", F.col("n_hr") == 0, sample, F.lit("none"))
    )


def presence_issues(manifest: DataFrame, found: DataFrame, files: DataFrame, sample: str) -> DataFrame:
    """Samples of the manifest without a directory, and files that cannot be opened (``readable``)."""
    gone = manifest.join(found.select(sample), sample, "left_anti")
    return issues(gone, "missing_sample_dir", F.lit(True), sample, F.lit("no directory")).unionByName(
        issues(files, "raster_open_failed", ~F.col("readable"), sample, F.col("file"))
    )


def raster_issues(files: DataFrame, specs: DataFrame, sample: str) -> DataFrame:
    """Band counts against the sensor's, sizes of one pixel, rasters of nodata alone (``is_empty``)."""
    rows = files.join(F.broadcast(specs.select("sensor", "n_bands")), "sensor", "left")
    size = (F.col("width") <= 1) | (F.col("height") <= 1)
    return (
        issues(rows, "band_count_mismatch", F.col("bands") != F.col("n_bands"), sample, F.col("file"))
        .unionByName(issues(rows, "degenerate_raster", size, sample, F.col("file")))
        .unionByName(issues(rows, "all_nodata", F.col("is_empty"), sample, F.col("file")))
    )


def grid_issues(high: DataFrame, sample: str, patch: int, pixel: float, *, close: float = 1e-3) -> DataFrame:
    """A high-resolution file's size, CRS, pixel size and lower-left origin against its sample's grid."""
    low_y = F.col("top") - F.col("height") * F.col("pixel")
    origin = (F.abs(F.col("left") - F.col("origin_x")) > close) | (F.abs(low_y - F.col("origin_y")) > close)
    return (
        issues(high, "hr_wrong_dimensions", (F.col("width") != patch) | (F.col("height") != patch), sample, F.col("width"))
        .unionByName(issues(high, "hr_crs_mismatch", F.col("crs") != F.col("epsg"), sample, F.col("crs")))
        .unionByName(issues(high, "hr_pixel_size_mismatch", F.abs(F.col("pixel") - pixel) > close, sample, F.col("pixel")))
        .unionByName(issues(high, "hr_origin_mismatch", origin, sample, F.lit("origin")))
    )


def clipping_issues(stats: DataFrame, sample: str, *, most: float = 0.05) -> DataFrame:
    return issues(stats, "landsat_clipped", F.col("clip_frac") > most, sample, F.col("band"))


def scene_issues(files: DataFrame, sample: str, order: str) -> DataFrame:
    """Glint, haze, swath and cloud of low-resolution files: at most one of each code for a sample, in file order.

    The file that raises the sample's first glint is not tested for haze; all others are. ``files`` has the booleans
    glint, haze, swath, cloud.
    """
    first_glint = F.row_number().over(Window.partitionBy(sample, F.col("glint")).orderBy(order)) == 1
    rows = files.withColumn("haze", F.col("haze") & ~(F.col("glint") & first_glint))
    codes = {"glint": "glint", "haze": "haze", "swath": "lr_swath_edge", "cloud": "lr_cloud"}
    named = F.array(*(F.when(F.col(c), F.lit(code)) for c, code in codes.items()))
    long = rows.select(sample, F.col(order).alias("detail"), F.explode(named).alias("code")).where("code IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy(sample, "code").orderBy("detail"))
    first = long.withColumn("__r", rank).where("__r = 1")
    return first.select("code", F.lit("DATA QUALITY").alias("section"), F.col(sample).alias("sample"), F.col("detail").cast("string").alias("detail"))


def high_scene_issues(files: DataFrame, sample: str, order: str) -> DataFrame:
    """Of high-resolution files only the first counts; glint and haze may both stand."""
    rank = F.row_number().over(Window.partitionBy(sample).orderBy(order))
    first = files.withColumn("__r", rank).where("__r = 1")
    return issues(first, "glint", F.col("glint"), sample, F.col(order)).unionByName(issues(first, "haze", F.col("haze"), sample, F.col(order)))


def partial_issues(pixels: DataFrame, sample: str, value: str, nodata: float, *, most: float = 0.1) -> DataFrame:
    """High-resolution images (one band of each) with too much nodata."""
    share = pixels.groupBy(sample).agg(F.avg(is_nodata(F.col(value), nodata).cast("double")).alias("nodata_frac"))
    return issues(share, "hr_partial", F.col("nodata_frac") > most, sample, F.lit("nodata"))


def alignment_issues(shifts: DataFrame, sample: str, *, most: float = 3.0) -> DataFrame:
    return issues(shifts, "large_shift", F.col("magnitude") > most, sample, F.round("magnitude", 2))
