"""Queries of the raster and grid jobs (G1-G8) and the integrity checks (K1-K7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sensors import specs
from ..operators import analyse, habitat, quality, raster
from .carriers import carrier, table
from .q_joins import _RINGS, supplier_polygons
from .q_windows import RADIUS, near_sql
from .registry import query, rounded

EDGES = f"""g AS ({_RINGS}),
e AS (
  SELECT poly, unnest(CASE WHEN kind = 0 THEN [x, x + 14, x + 3] ELSE [x, x + 9, x + 9, x, x + 3, x + 6, x + 6, x + 3] END) AS x1,
         unnest(CASE WHEN kind = 0 THEN [y, y + 2, y + 11] ELSE [y, y, y + 9, y + 9, y + 3, y + 3, y + 6, y + 6] END) AS y1,
         unnest(CASE WHEN kind = 0 THEN [x + 14, x + 3, x] ELSE [x + 9, x + 9, x, x, x + 6, x + 6, x + 3, x + 3] END) AS x2,
         unnest(CASE WHEN kind = 0 THEN [y + 2, y + 11, y] ELSE [y, y + 9, y + 9, y, y + 3, y + 6, y + 6, y + 3] END) AS y2 FROM g)"""


@query("g01_rasterize", f"""
WITH {EDGES},
c AS (SELECT poly, CAST(r AS INT) AS grid_row, CAST(k AS INT) AS grid_col, -179.93 + (k + 0.5) * 0.7 AS px, 61.3 - (r + 0.5) * 0.7 AS py
  FROM g, range(0, 175) a(r), range(0, 515) b(k) WHERE abs(-179.93 + (k + 0.5) * 0.7 - (x + 7)) < 8 AND abs(61.3 - (r + 0.5) * 0.7 - (y + 6)) < 7),
h AS (SELECT poly, grid_row, grid_col, count(*) AS n FROM c JOIN e USING (poly) WHERE (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 GROUP BY ALL)
SELECT DISTINCT grid_row, grid_col FROM h WHERE n % 2 = 1""")  # fmt: skip
def g01(spark: SparkSession, d: str) -> DataFrame:
    runs = habitat.rasterize(supplier_polygons(spark, d), "poly", west=-179.93, north=61.3, size=0.7, rows=175, cols=515)
    return habitat.cells_of(runs.drop("poly").distinct(), [])


@query("g02_dilate", near_sql("habitat, ", RADIUS))
def g02(spark: SparkSession, d: str) -> DataFrame:
    runs = habitat.runs_of(carrier(spark, d, "cells"), ["habitat"])
    return habitat.dilate_runs(runs, ["habitat"], RADIUS, 660, 1400)


@query("g03_tiles", """
SELECT scene_id, band, CAST(prow // 3 AS INT) AS tile_row, CAST(pcol // 3 AS INT) AS tile_col,
  concat_ws('_', scene_id::VARCHAR, band::VARCHAR, (prow // 3)::VARCHAR, (pcol // 3)::VARCHAR) AS tile, round(avg(CASE WHEN dn <> 0 THEN dn END), 6) AS mean
FROM pixels GROUP BY scene_id, band, prow // 3, pcol // 3 HAVING count(*) = 9 AND bool_or(dn <> 0)""")  # fmt: skip
def g03(spark: SparkSession, d: str) -> DataFrame:
    return raster.tiles(carrier(spark, d, "pixels"), ["scene_id", "band"], "prow", "pcol", "dn", 3, F.col("dn") != 0).withColumn("mean", rounded("mean", 6))


def _images(spark: SparkSession, d: str) -> DataFrame:
    """Each vector as an 8 x 8 image in a place of its own, a sample being eight of them."""
    v = F.col("vec_id")
    return table(spark, d, "embeddings").where(F.size("embedding") == 64).select(
        "vec_id", F.expr("vec_id div 8").alias("scene_id"), (v % 8).cast("int").alias("band"), F.transform("embedding", lambda x: x.cast("double") * 5000 + 5000).alias("data"),
        F.lit(8).alias("h"), F.lit(8).alias("w"), (v * 10.0 - 15).alias("left"), (v * 5.0 + 255).alias("top"), F.lit(30.0).alias("px"),
        (v * 10.0).alias("origin_x"), (v * 5.0).alias("origin_y"), (v % 8 == 7).alias("is_qa"),
    )


#: The images' pixels; those of a place come back by number.
_DATA = """v AS (SELECT vec_id, [CAST(x AS DOUBLE) * 5000 + 5000 for x in embedding] AS d FROM embeddings WHERE len(embedding) = 64)"""


def _long(images: DataFrame, keys: list[str], n: str) -> DataFrame:
    """A row for each pixel of square images."""
    pixels = images.select(*keys, F.expr(n).alias("n"), F.posexplode("data").alias("at", "value"))
    return pixels.select(*keys, F.expr("CAST(at DIV n AS INT)").alias("grid_row"), F.expr("CAST(at % n AS INT)").alias("grid_col"), "value")


_ALIGNED = f"""
WITH {_DATA},
p AS (SELECT vec_id, d, r, c, least(r + 1, 7) AS r1, least(c + 1, 7) AS c1 FROM v, range(8) a(r), range(8) b(c))
SELECT vec_id, CAST(r AS INT) AS grid_row, CAST(c AS INT) AS grid_col, round(CAST(CASE WHEN vec_id % 8 = 7 THEN d[r1 * 8 + c1 + 1]
  ELSE (d[r * 8 + c + 1] + d[r * 8 + c1 + 1] + d[r1 * 8 + c + 1] + d[r1 * 8 + c1 + 1]) / 4 END AS FLOAT)::DOUBLE, 3) AS value FROM p"""


@query("g04_align", _ALIGNED)
def g04(spark: SparkSession, d: str) -> DataFrame:
    """Each image begins half a pixel beside its sample's grid, so a pixel is the mean of four, or the next one of a QA band."""
    out = raster.aligned(_images(spark, d), ["vec_id", "scene_id", "band"], patch_m=240)
    return _long(out, ["vec_id"], "n").withColumn("value", rounded(F.col("value").cast("double"), 3))


_STANDARDIZED = f"""
WITH {_DATA},
a AS (SELECT i, i // 2 AS r, least(i // 2 + 1, 7) AS r1, 0.25 + i % 2 * 0.5 AS f FROM range(16) t(i)),
p AS (SELECT vec_id, d, y.i AS y, x.i AS x, y.r AS r, y.r1 AS r1, y.f AS fy, x.r AS c, x.r1 AS c1, x.f AS fx FROM v, a y, a x)
SELECT vec_id, CAST(y AS INT) AS grid_row, CAST(x AS INT) AS grid_col, CASE WHEN y = 15 OR x = 15 THEN 0 ELSE CAST(round_even(
  d[r * 8 + c + 1] * (1 - fy) * (1 - fx) + d[r * 8 + c1 + 1] * (1 - fy) * fx + d[r1 * 8 + c + 1] * fy * (1 - fx)
  + d[r1 * 8 + c1 + 1] * fy * fx, 0) AS INT) END AS value FROM p"""


@query("g05_standardize", _STANDARDIZED)
def g05(spark: SparkSession, d: str) -> DataFrame:
    """Pixels of half the size from a quarter of a pixel on; the last row and column lie outside the image."""
    out = raster.standardized(_images(spark, d), ["vec_id"], patch=16, step=15.0)
    return _long(out, ["vec_id"], "16")


#: Pixels of a block's side: it does not divide the images, so that blocks at their edges are smaller.
_BLOCK = 3


def _image_blocks(images: DataFrame) -> DataFrame:
    """The images cut into blocks: a row for each block."""
    side = F.sequence(F.lit(0), F.expr(f"(h - 1) DIV {_BLOCK}").cast("int"))
    rows = images.withColumn("block_row", F.explode(side)).withColumn("block_col", F.explode(side))
    lines = F.transform(
        F.sequence(F.col("block_row") * _BLOCK, F.least(F.col("block_row") * _BLOCK + _BLOCK, F.col("h")) - 1),
        lambda i: F.slice("data", i * F.col("w") + F.col("block_col") * _BLOCK + 1, F.least(F.lit(_BLOCK), F.col("w") - F.col("block_col") * _BLOCK)),
    )
    return rows.withColumn("data", F.flatten(lines))


def _from_blocks(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each pixel of blocks."""
    wide = F.least(F.lit(_BLOCK), F.col("n") - F.col("block_col") * _BLOCK)
    pixels = blocks.select(*keys, "block_row", "block_col", wide.alias("wide"), F.posexplode("data").alias("at", "value"))
    row, col = F.expr(f"CAST(block_row * {_BLOCK} + at DIV wide AS INT)"), F.expr(f"CAST(block_col * {_BLOCK} + at % wide AS INT)")
    return pixels.select(*keys, row.alias("grid_row"), col.alias("grid_col"), "value")


@query("g04_align_blocks", _ALIGNED)
def g04_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The same, image by blocks; every output block needs pixels of four."""
    out = raster.aligned_blocks(_image_blocks(_images(spark, d)), ["vec_id"], size=_BLOCK, patch_m=240)
    return _from_blocks(out, ["vec_id"]).withColumn("value", rounded(F.col("value").cast("double"), 3))


@query("g05_standardize_blocks", _STANDARDIZED)
def g05_blocks(spark: SparkSession, d: str) -> DataFrame:
    out = raster.standardized_blocks(_image_blocks(_images(spark, d)), ["vec_id"], size=_BLOCK, patch=16, step=15.0)
    return _from_blocks(out, ["vec_id"])


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Low against high resolution: the second image is the first, rolled by a known shift."""
    v = _images(spark, d).select(F.col("vec_id").alias("scene_id"), "data")
    rolled = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("data")[(((F.floor(i / 8) + F.col("scene_id") % 3) % 8) * 8 + (i % 8 + 2) % 8).cast("int")])
    return v.select("scene_id", F.col("data").alias("lr"), F.lit(8).alias("lr_h"), F.lit(8).alias("lr_w"), rolled.alias("hr"), F.lit(8).alias("hr_h"), F.lit(8).alias("hr_w"))


@query("g06_phase_shift", """
SELECT vec_id AS scene_id, CAST(-2 AS INT) AS dx, CAST(-(vec_id % 3) AS INT) AS dy, round(sqrt(4 + (vec_id % 3) ** 2), 6) AS magnitude FROM embeddings""")  # fmt: skip
def g06(spark: SparkSession, d: str) -> DataFrame:
    return raster.shifts(_pairs(spark, d), "scene_id").withColumn("magnitude", rounded("magnitude", 6))


def _upsampled_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The high-resolution image is the low one at twice its size, rolled by a known shift. One of three is narrower than that, one of
    seven wider, which fits no cut."""
    v = _images(spark, d).select(F.col("vec_id").alias("scene_id"), F.col("data").alias("lr"), F.lit(8).alias("lr_h"), F.lit(8).alias("lr_w"))
    v = v.withColumn("hr_w", F.when(F.col("scene_id") % 7 == 0, 20).when(F.col("scene_id") % 3 == 0, 12).otherwise(16))

    def rolled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in raster.parts_of(batches):
            out = []
            for r in b.to_dict("records"):
                large = raster.upsample(raster.image(r["lr"], 8, 8), 16, max(16, r["hr_w"]))[:, : r["hr_w"]]
                out.append(np.roll(large, (r["scene_id"] % 5 - 2, 3), axis=(0, 1)).ravel())
            yield b.assign(hr=out, hr_h=16)

    return v.mapInPandas(rolled, "scene_id long, lr array<double>, lr_h int, lr_w int, hr array<double>, hr_h int, hr_w int")


@query("g06_phase_shift_sizes", """
SELECT vec_id AS scene_id, CASE WHEN vec_id % 7 <> 0 THEN CAST(3 AS INT) END AS dx, CASE WHEN vec_id % 7 <> 0 THEN CAST(vec_id % 5 - 2 AS INT) END AS dy,
  CASE WHEN vec_id % 7 <> 0 THEN round(sqrt(9 + (vec_id % 5 - 2) ** 2), 6) END AS magnitude FROM embeddings""")  # fmt: skip
def g06_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Images of unlike size: the low one is brought to the size of the high one by the spline, and cut."""
    return raster.shifts(_upsampled_pairs(spark, d), "scene_id").withColumn("magnitude", rounded("magnitude", 6))


@query("g07_spectra", f"""
WITH {_DATA},
w AS (SELECT k, 0.5 - 0.5 * cos(2 * pi() * k / 7) AS h FROM range(8) t(k)),
x AS (SELECT vec_id, y.k AS y, x.k AS x, d[y.k * 8 + x.k + 1] * y.h * x.h AS v FROM v, w y, w x),
f AS (SELECT vec_id, a.k AS a, b.k AS b, sum(v * cos(2 * pi() * ((y * a.k + x * b.k) % 8) / 8)) AS re, sum(v * sin(2 * pi() * ((y * a.k + x * b.k) % 8) / 8)) AS im
  FROM x, w a, w b GROUP BY ALL),
r AS (SELECT vec_id, CAST(floor(sqrt(((a + 4) % 8 - 4) ** 2 + ((b + 4) % 8 - 4) ** 2)) AS INT) AS freq, avg((re * re + im * im) / 64) AS power FROM f GROUP BY ALL)
SELECT CAST(vec_id % 8 AS INT) AS band, freq, round(avg(power), 2) AS mean_power, round(stddev_pop(power), 2) AS sd_power FROM r WHERE freq < 4 GROUP BY ALL""")  # fmt: skip
def g07(spark: SparkSession, d: str) -> DataFrame:
    return raster.spectra(_images(spark, d), ["band"]).withColumns({c: rounded(c, 2) for c in ("mean_power", "sd_power")})


@query("g08_stretch", """
WITH l AS (SELECT scene_id, unnest([b4, b3, b2]) AS v FROM stacks WHERE b4 > 0 AND b3 > 0 AND b2 > 0),
q AS (SELECT scene_id, quantile_cont(v, 0.02) AS lo, quantile_cont(v, 0.98) AS hi FROM l GROUP BY scene_id)
SELECT s.scene_id, prow, pcol, CASE WHEN b4 > 0 AND b3 > 0 AND b2 > 0 THEN CAST(floor(least(greatest((b4 - lo) / (hi - lo), 0), 1) * 255) AS INT) ELSE 0 END AS b4,
  CASE WHEN b4 > 0 AND b3 > 0 AND b2 > 0 THEN CAST(floor(least(greatest((b3 - lo) / (hi - lo), 0), 1) * 255) AS INT) ELSE 0 END AS b3,
  CASE WHEN b4 > 0 AND b3 > 0 AND b2 > 0 THEN CAST(floor(least(greatest((b2 - lo) / (hi - lo), 0), 1) * 255) AS INT) ELSE 0 END AS b2
FROM stacks s LEFT JOIN q ON q.scene_id = s.scene_id""")  # fmt: skip
def g08(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "stacks").select("scene_id", "prow", "pcol", "b4", "b3", "b2")
    valid = F.coalesce((F.col("b4") > 0) & (F.col("b3") > 0) & (F.col("b2") > 0), F.lit(False))
    s = s.withColumn("ok", valid)
    return raster.stretched(s, ["scene_id"], ["b4", "b3", "b2"], F.col("ok")).drop("ok")


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Nine files of each sample: the first is the high-resolution one."""
    c, k = F.col, F.col("k")
    rows = carrier(spark, d, "samples").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(8))))
    rows = rows.where(~((c("location_id") % 11 == 0) & (k == 0)) & ~((c("location_id") % 13 == 0) & (k > 5)))
    return rows.withColumns({
        "role": F.when(k == 0, "hr").otherwise("lr"), "file": F.format_string("%06d_%d.tif", "location_id", k), "sensor": F.when(k == 0, "S2").otherwise("LS"),
        "bands": F.when(k == 0, 13).otherwise(8) - F.when((c("location_id") + k) % 17 == 0, 1).otherwise(0), "width": F.when((c("location_id") + k) % 19 == 0, 1).otherwise(512),
        "height": F.lit(512), "is_empty": (c("location_id") * 3 + k) % 23 == 0,
    })


#: The same files in SQL.
_FILES_SQL = """f AS (SELECT location_id, lowres_count, k, CASE WHEN k = 0 THEN 'hr' ELSE 'lr' END AS role, printf('%06d_%d.tif', location_id, k) AS file,
  CASE WHEN k = 0 THEN 13 ELSE 8 END AS n_bands, CASE WHEN k = 0 THEN 13 ELSE 8 END - CASE WHEN (location_id + k) % 17 = 0 THEN 1 ELSE 0 END AS bands,
  CASE WHEN (location_id + k) % 19 = 0 THEN 1 ELSE 512 END AS width, (location_id * 3 + k) % 23 = 0 AS is_empty
  FROM samples, range(9) t(k) WHERE NOT (location_id % 11 = 0 AND k = 0) AND NOT (location_id % 13 = 0 AND k > 5))"""


@query("k01_metadata_issues", """
SELECT CASE WHEN location_id % 9 = 0 THEN 'missing_metadata' ELSE 'invalid_metadata' END AS code, 'STRUCTURE' AS section, location_id AS sample,
  CASE WHEN location_id % 9 = 0 THEN 'no file' ELSE 'fields' END AS detail
FROM samples WHERE location_id % 9 = 0 OR location_id % 9 = 1 OR habitat_class IS NULL OR depth_m IS NULL""")  # fmt: skip
def k01(spark: SparkSession, d: str) -> DataFrame:
    s, m = carrier(spark, d, "samples"), F.col("location_id") % 9
    text = F.when(m == 1, "{broken").otherwise(F.to_json(F.struct("location_id", "habitat_class", "depth_m", "latitude")))
    files = s.where(m != 0).select("location_id", text.alias("json"))
    return quality.metadata_issues(s, files, "location_id", ["location_id", "habitat_class", "depth_m", "latitude"])


@query("k02_count_issues", f"""
WITH {_FILES_SQL}, n AS (SELECT s.location_id, s.lowres_count AS c, count(CASE WHEN role = 'lr' THEN 1 END) AS lr, count(CASE WHEN role = 'hr' THEN 1 END) AS hr
  FROM samples s LEFT JOIN f ON f.location_id = s.location_id GROUP BY ALL)
SELECT 'lowres_count_mismatch' AS code, 'FILE COUNTS' AS section, location_id AS sample, lr || '/' || c AS detail FROM n WHERE lr <> c
UNION ALL SELECT 'missing_highres_file', 'FILE COUNTS', location_id, 'none' FROM n WHERE hr = 0""")  # fmt: skip
def k02(spark: SparkSession, d: str) -> DataFrame:
    return quality.count_issues(carrier(spark, d, "samples").select("location_id", "lowres_count"), _files(spark, d), "location_id", "lowres_count")


@query("k03_raster_issues", f"""
WITH {_FILES_SQL} SELECT 'band_count_mismatch' AS code, 'RASTER INTEGRITY' AS section, location_id AS sample, file AS detail FROM f WHERE bands <> n_bands
UNION ALL SELECT 'degenerate_raster', 'DIMENSIONS', location_id, file FROM f WHERE width <= 1 UNION ALL SELECT 'all_nodata', 'VALUES', location_id, file FROM f WHERE is_empty""")  # fmt: skip
def k03(spark: SparkSession, d: str) -> DataFrame:
    return quality.raster_issues(_files(spark, d), specs(spark), "location_id")


@query("k04_grid_issues", """
WITH h AS (SELECT location_id, CASE WHEN location_id % 7 = 0 THEN 500 ELSE 512 END AS w, 32601 + location_id % 3 AS crs, CASE WHEN location_id % 5 = 0 THEN 10.5 ELSE 10 END AS px,
  CASE WHEN location_id % 4 = 0 THEN 0.5 ELSE 0.0005 END AS shift FROM samples)
SELECT 'hr_wrong_dimensions' AS code, 'DIMENSIONS' AS section, location_id AS sample, w::VARCHAR AS detail FROM h WHERE w <> 512
UNION ALL SELECT 'hr_crs_mismatch', 'GEOREFERENCING', location_id, crs::VARCHAR FROM h WHERE crs <> 32601
UNION ALL SELECT 'hr_pixel_size_mismatch', 'GEOREFERENCING', location_id, '10.5' FROM h WHERE px <> 10
UNION ALL SELECT 'hr_origin_mismatch', 'GEOREFERENCING', location_id, 'origin' FROM h WHERE shift > 0.001 OR px <> 10""")  # fmt: skip
def k04(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("location_id")
    px = F.when(i % 5 == 0, 10.5).otherwise(10.0)
    high = carrier(spark, d, "samples").select(
        "location_id", F.when(i % 7 == 0, 500).otherwise(512).alias("width"), F.lit(512).alias("height"), (32601 + i % 3).alias("crs"), F.lit(32601).alias("epsg"), px.alias("pixel"),
        (i * 10 + F.when(i % 4 == 0, 0.5).otherwise(0.0005)).alias("left"), (i * 10.0 + 5120).alias("top"), (i * 10.0).alias("origin_x"), (i * 10.0).alias("origin_y"),
    ).withColumn("height", F.lit(512))
    return quality.grid_issues(high, "location_id", 512, 10.0)


@query("k05_clipping_issues", """
SELECT 'landsat_clipped' AS code, 'DATA QUALITY' AS section, scene_id AS sample, band::VARCHAR AS detail FROM (
  SELECT scene_id, band, avg(CASE WHEN dn / 6000.0 >= 1 THEN 1.0 ELSE 0.0 END) AS c FROM pixels WHERE dn <> 0 GROUP BY ALL) WHERE c > 0.05""")
def k05(spark: SparkSession, d: str) -> DataFrame:
    p = carrier(spark, d, "pixels").withColumn("v", F.col("dn") / 6000.0)
    return quality.clipping_issues(analyse.patch_statistics(p, ["scene_id", "band"], "v", F.col("dn") != 0), "scene_id")


@query("k05_partial_issues", """
SELECT 'hr_partial' AS code, 'DATA QUALITY' AS section, scene_id AS sample, 'nodata' AS detail FROM pixels WHERE band = 1 GROUP BY scene_id
HAVING avg(CASE WHEN dn = 0 THEN 1.0 ELSE 0.0 END) > 0.07""")
def k05p(spark: SparkSession, d: str) -> DataFrame:
    return quality.partial_issues(carrier(spark, d, "pixels").where("band = 1"), "scene_id", "dn", 0, most=0.07)


@query("k01_presence_issues", f"""
WITH {_FILES_SQL} SELECT 'missing_sample_dir' AS code, 'STRUCTURE' AS section, location_id AS sample, 'no directory' AS detail FROM samples WHERE location_id % 8 = 0
UNION ALL SELECT 'raster_open_failed', 'RASTER INTEGRITY', location_id, file FROM f WHERE (location_id + k) % 31 = 0""")
def k01p(spark: SparkSession, d: str) -> DataFrame:
    s = carrier(spark, d, "samples")
    files = _files(spark, d).withColumn("readable", (F.col("location_id") + F.col("k")) % 31 != 0)
    return quality.presence_issues(s, s.where("location_id % 8 <> 0"), files, "location_id")


_FLAGS_SQL = """f AS (SELECT location_id, printf('%06d_%d.tif', location_id, k) AS file, (location_id + k) % 3 = 0 AS glint, (location_id + k) % 2 = 0 AS haze,
  (location_id + k) % 5 = 0 AS swath, (location_id * k) % 7 = 3 AS cloud FROM samples, range(6) t(k))"""


def _flags(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("location_id"), F.col("k")
    rows = carrier(spark, d, "samples").select("location_id").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
    return rows.withColumns({
        "file": F.format_string("%06d_%d.tif", i, k), "glint": (i + k) % 3 == 0, "haze": (i + k) % 2 == 0, "swath": (i + k) % 5 == 0, "cloud": (i * k) % 7 == 3,
    })


@query("k06_scene_issues", f"""
WITH {_FLAGS_SQL}, x AS (SELECT *, row_number() OVER (PARTITION BY location_id, glint ORDER BY file) AS g FROM f),
l AS (SELECT location_id, file, 'glint' AS code FROM x WHERE glint UNION ALL SELECT location_id, file, 'haze' FROM x WHERE haze AND NOT (glint AND g = 1)
  UNION ALL SELECT location_id, file, 'lr_swath_edge' FROM x WHERE swath UNION ALL SELECT location_id, file, 'lr_cloud' FROM x WHERE cloud)
SELECT code, 'DATA QUALITY' AS section, location_id AS sample, min(file) AS detail FROM l GROUP BY code, location_id""")  # fmt: skip
def k06(spark: SparkSession, d: str) -> DataFrame:
    return quality.scene_issues(_flags(spark, d), "location_id", "file")


@query("k06_high_scene_issues", f"""
WITH {_FLAGS_SQL}, x AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY file) AS r FROM f)
SELECT 'glint' AS code, 'DATA QUALITY' AS section, location_id AS sample, file AS detail FROM x WHERE r = 1 AND glint
UNION ALL SELECT 'haze', 'DATA QUALITY', location_id, file FROM x WHERE r = 1 AND haze""")  # fmt: skip
def k06h(spark: SparkSession, d: str) -> DataFrame:
    return quality.high_scene_issues(_flags(spark, d), "location_id", "file")


@query("k07_alignment_issues", """
SELECT 'large_shift' AS code, 'DATA QUALITY' AS section, vec_id AS sample, CAST(round(sqrt(4 + (vec_id % 3) ** 2), 2) AS VARCHAR) AS detail
FROM embeddings WHERE sqrt(4 + (vec_id % 3) ** 2) > 2.5""")  # fmt: skip
def k07(spark: SparkSession, d: str) -> DataFrame:
    return quality.alignment_issues(raster.shifts(_pairs(spark, d), "scene_id"), "scene_id", most=2.5)
