"""Raster work on rows that hold one image each: tiles, resampling, registration, spectra, stretches.

Images are ``data ARRAY<FLOAT>`` in row-major order with ``h`` and ``w``; NULL and NaN are nodata. The numpy helpers see
one image at a time, so keep ``spark.sql.execution.arrow.maxRecordsPerBatch`` small for large images.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import quantiles

#: Images that are worked on and handed on at a time.
FRAME = 256


def tiles(pixels: DataFrame, keys: list[str], row: str, col: str, value: str, size: int, valid: Column) -> DataFrame:
    """Full tiles only, without those of nodata alone; named ``<key>_<row>_<col>``."""
    tr, tc = (F.floor(F.col(c) / size).cast("int").alias(n) for c, n in ((row, "tile_row"), (col, "tile_col")))
    rows = pixels.groupBy(*keys, tr, tc).agg(
        F.count("*").alias("n"), F.bool_or(F.coalesce(valid, F.lit(False))).alias("some"), F.avg(F.when(valid, F.col(value))).alias("mean")
    )
    kept = rows.where((F.col("n") == size * size) & F.col("some"))
    name = F.concat_ws("_", *(F.col(k).cast("string") for k in keys), F.col("tile_row").cast("string"), F.col("tile_col").cast("string"))
    return kept.select(*keys, "tile_row", "tile_col", name.alias("tile"), "mean")


def image(values, h: int, w: int) -> np.ndarray:
    return np.array([np.nan if v is None else v for v in values], float).reshape(h, w)


def parts_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches as frames of at most ``FRAME`` images, so that what is made of them at a time does not grow with the session's batches."""
    for b in batches:
        for at in range(0, len(b), FRAME):
            yield b.iloc[at : at + FRAME]


def _places(n: int, left: float, top: float, px: float, x0: float, y0: float, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a source, with fractions, at the pixel centres of an n x n grid."""
    x = (x0 + (np.arange(n) + 0.5) * step - left) / px - 0.5
    y = (top - (y0 + (n - np.arange(n) - 0.5) * step)) / px - 0.5
    return y, x


def _neighbours(at: np.ndarray, size: int, nearest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Along one axis: which places lie inside, and their first and second pixel (the same one for ``nearest``)."""
    first = np.clip(np.floor(at + 0.5 if nearest else at), 0, size - 1).astype(int)
    return (at >= -0.5) & (at <= size - 0.5), first, first if nearest else np.minimum(first + 1, size - 1)


def _sampled(window: np.ndarray, y: np.ndarray, x: np.ndarray, h: int, w: int, row: int = 0, col: int = 0, *, nearest: bool = False) -> np.ndarray:
    """Values of an h x w image at y and x; ``window`` is the part of it that begins at (row, col) and holds all pixels they need."""
    (in_y, r0, r1), (in_x, c0, c1) = _neighbours(y, h, nearest), _neighbours(x, w, nearest)
    inside = in_y[:, None] & in_x[None, :]
    if not window.size:
        return np.full(inside.shape, np.nan)
    take = lambda r, c: window[np.clip(r - row, 0, window.shape[0] - 1)][:, np.clip(c - col, 0, window.shape[1] - 1)]
    if nearest:
        return np.where(inside, take(r0, c0), np.nan)
    fy, fx = np.clip(y - r0, 0, 1)[:, None], np.clip(x - c0, 0, 1)[None, :]
    total, weight = np.zeros(inside.shape), np.zeros(inside.shape)
    for r, wy in ((r0, 1 - fy), (r1, fy)):
        for c, wx in ((c0, 1 - fx), (c1, fx)):
            v = take(r, c)
            ok = ~np.isnan(v)
            total += np.where(ok, v * wy * wx, 0)
            weight += np.where(ok, wy * wx, 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(inside & (weight > 0), total / weight, np.nan)


def resample(source: np.ndarray, left: float, top: float, px: float, x0: float, y0: float, step: float, n: int, *, nearest: bool = False) -> np.ndarray:
    """The source on an n x n grid whose lower-left corner is (x0, y0); row 0 is the top. NaN outside the source.

    Bilinear between pixel centres (weights of missing neighbours are shared out), or the nearest pixel.
    """
    return _sampled(source, *_places(n, left, top, px, x0, y0, step), *source.shape, nearest=nearest)


def aligned(images: DataFrame, keys: list[str], *, patch_m: float, qa: str | None = "is_qa") -> DataFrame:
    """Images (keys, data, h, w, left, top, px, origin_x, origin_y) on their sample's grid of ceil(patch / px) pixels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                n = int(np.ceil(patch_m / r["px"]))
                grid = resample(image(r["data"], r["h"], r["w"]), r["left"], r["top"], r["px"], r["origin_x"], r["origin_y"], r["px"], n, nearest=bool(qa and r[qa]))
                out.append({**{k: r[k] for k in keys}, "n": n, "data": grid.ravel().astype(np.float32)})
            yield pd.DataFrame(out, columns=[*keys, "n", "data"])

    fields = ", ".join(f"`{k}` {images.schema[k].dataType.simpleString()}" for k in keys)
    return images.mapInPandas(run, f"{fields}, n int, data array<float>")


def standardized(images: DataFrame, keys: list[str], *, patch: int, step: float) -> DataFrame:
    """High-resolution images on a fixed grid of patch x patch pixels: bilinear, zero outside, whole numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                grid = resample(image(r["data"], r["h"], r["w"]), r["left"], r["top"], r["px"], r["origin_x"], r["origin_y"], step, patch)
                out.append({**{k: r[k] for k in keys}, "data": np.rint(np.nan_to_num(grid)).clip(0, 65535).astype(np.int32).ravel()})
            yield pd.DataFrame(out, columns=[*keys, "data"])

    fields = ", ".join(f"`{k}` {images.schema[k].dataType.simpleString()}" for k in keys)
    return images.mapInPandas(run, f"{fields}, data array<int>")


#: What a block says of its whole image.
GRID = ["h", "w", "left", "top", "px", "origin_x", "origin_y"]


def aligned_blocks(blocks: DataFrame, keys: list[str], *, size: int, patch_m: float, qa: str | None = "is_qa") -> DataFrame:
    """``aligned`` for images of any size, which come and go as blocks: (keys, n, block_row, block_col, data).

    ``blocks``: keys, block_row, block_col, data and the columns ``GRID`` of the whole image, the same in all its blocks. A block has
    ``size`` x ``size`` pixels, fewer at the lower and right edges; missing blocks and null data are nodata. No task holds
    an image: a source block gives each output block the pixels that it needs, neighbours across borders included, so
    the values are those of the whole image to the last bit.
    """

    def plan(r: dict) -> tuple[int, float, bool]:
        return int(np.ceil(patch_m / r["px"])), r["px"], bool(qa and r[qa])

    return _by_blocks(blocks, keys, size, plan, lambda grid: grid.astype(np.float32), "float", [qa] if qa else [])


def standardized_blocks(blocks: DataFrame, keys: list[str], *, size: int, patch: int, step: float) -> DataFrame:
    """``standardized`` for images of any size, in blocks as ``aligned_blocks`` takes and gives them."""
    whole = lambda grid: np.rint(np.nan_to_num(grid)).clip(0, 65535).astype(np.int32)
    return _by_blocks(blocks, keys, size, lambda r: (patch, step, False), whole, "int", [])


def _by_blocks(blocks: DataFrame, keys: list[str], size: int, plan, finish, kind: str, more: list[str]) -> DataFrame:
    meta = [c for c in [*GRID, *more] if c not in keys]

    def grid_of(r: dict) -> tuple[int, bool, np.ndarray, np.ndarray]:
        n, step, nearest = plan(r)
        return n, nearest, *_places(n, r["left"], r["top"], r["px"], r["origin_x"], r["origin_y"], step)

    def needs(at: np.ndarray, of: int, nearest: bool) -> list[tuple[int, int]]:
        """For each output block along an axis the first pixel that it needs and the one after the last."""
        inside, first, second = _neighbours(at, of, nearest)
        out = []
        for i in range(0, len(at), size):
            here = inside[i : i + size]
            out.append((int(first[i : i + size][here].min()), int(second[i : i + size][here].max()) + 1) if here.any() else (0, 0))
        return out

    columns = ["out_row", "out_col", "row", "col", "rows", "cols", "part", *keys, *meta]

    def frames(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        held, pixels = [], 0
        for r in rows:
            held.append(r)
            pixels += 16 + len(r[6])
            if pixels > 1_000_000:
                yield pd.DataFrame(held, columns=columns, dtype=object)
                held, pixels = [], 0
        yield pd.DataFrame(held, columns=columns, dtype=object)

    def cuts(r: dict) -> Iterator[tuple]:
        _, nearest, y, x = grid_of(r)
        top, left, rest = r["block_row"] * size, r["block_col"] * size, tuple(r[c] for c in [*keys, *meta])
        h, w = min(size, r["h"] - top), min(size, r["w"] - left)
        block = image(r["data"], h, w) if r["data"] is not None else np.full((h, w), np.nan)
        across = needs(x, r["w"], nearest)
        for i, (r0, r1) in enumerate(needs(y, r["h"], nearest)):
            r0, r1 = max(r0, top), min(r1, top + h)
            for j, (c0, c1) in enumerate(across if r0 < r1 else ()):
                c0, c1 = max(c0, left), min(c1, left + w)
                if c0 < c1:
                    yield (i, j, r0, c0, r1 - r0, c1 - c0, block[r0 - top : r1 - top, c0 - left : c1 - left].ravel(), *rest)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from frames(row for b in batches for r in b.to_dict("records") for row in cuts(r))

    def every(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A part without pixels for each output block, so that those outside the source are there too."""

        def all_of(r: dict) -> Iterator[tuple]:
            side = range(-(-plan(r)[0] // size))
            yield from ((i, j, 0, 0, 0, 0, [], *(r[c] for c in [*keys, *meta])) for i in side for j in side)

        yield from frames(row for b in batches for r in b.to_dict("records") for row in all_of(r))

    def joined(r: dict) -> tuple:
        n, nearest, y, x = grid_of(r)
        i, j = r["out_row"] * size, r["out_col"] * size
        y, x = y[i : i + size], x[j : j + size]
        (row, below), (col, beside) = needs(y, r["h"], nearest)[0], needs(x, r["w"], nearest)[0]
        window = np.full((below - row, beside - col), np.nan)  # missing blocks leave nodata
        for p in r["parts"]:
            if p["rows"]:
                window[p["row"] - row :, p["col"] - col :][: p["rows"], : p["cols"]] = image(p["part"], p["rows"], p["cols"])
        grid = _sampled(window, y, x, r["h"], r["w"], row, col, nearest=nearest)
        return (*(r[k] for k in keys), n, r["out_row"], r["out_col"], finish(grid).ravel())

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([joined(r) for r in b.to_dict("records")], columns=[*keys, "n", "block_row", "block_col", "data"], dtype=object)

    fields = lambda cs: ", ".join(f"`{c}` {blocks.schema[c].dataType.simpleString()}" for c in cs)
    sent = f"out_row int, out_col int, row int, col int, rows int, cols int, part array<double>, {fields([*keys, *meta])}"
    images = blocks.groupBy(*keys).agg(*(F.min(c).alias(c) for c in meta))
    parts = blocks.select(*keys, *meta, "block_row", "block_col", "data").mapInPandas(cut, sent).unionByName(images.mapInPandas(every, sent))
    # An output block meets few parts, by the ratio of the pixels' sizes, whatever the image's size.
    windows = parts.groupBy(*keys, "out_row", "out_col").agg(*(F.min(c).alias(c) for c in meta), F.collect_list(F.struct("row", "col", "rows", "cols", "part")).alias("parts"))
    return windows.mapInPandas(join, f"{fields(keys)}, n int, block_row int, block_col int, data array<{kind}>")


@cache
def _spline(m: int, n: int) -> np.ndarray:
    """The n x m matrix of third-order spline interpolation with the corners in place and mirrored ends."""
    mirror = lambda i: np.abs((i + m - 1) % max(1, 2 * (m - 1)) - (m - 1)) if m > 1 else i * 0
    basis = np.zeros((m, m))
    for k, weight in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
        np.add.at(basis, (np.arange(m), mirror(np.arange(m) + k)), weight)
    at = np.arange(n) * ((m - 1) / max(1, n - 1))
    i = np.floor(at).astype(int)
    t, values = at - i, np.zeros((n, m))
    for k, weight in ((-1, (1 - t) ** 3), (0, 3 * t**3 - 6 * t**2 + 4), (1, -3 * t**3 + 3 * t**2 + 3 * t + 1), (2, t**3)):
        np.add.at(values, (np.arange(n), mirror(i + k)), weight / 6)
    return values @ np.linalg.inv(basis)


def upsample(source: np.ndarray, h: int, w: int) -> np.ndarray:
    """Third-order spline interpolation with the corners in place."""
    return _spline(source.shape[0], h) @ source @ _spline(source.shape[1], w).T


def phase_shift(low: np.ndarray, high: np.ndarray) -> tuple[int, int, float] | None:
    """(dx, dy, magnitude): how far ``high`` is shifted against ``low``, brought to its size; none if that cannot be.

    ``low`` is scaled by the ratio of the heights and cut off where it is larger. Half a period counts as negative.
    """
    filled = lambda x: np.nan_to_num(x, nan=float(np.nanmean(x)))
    low, (h, w) = filled(low), high.shape
    if low.shape != high.shape:
        scale = h / low.shape[0]
        low = upsample(low, round(low.shape[0] * scale), round(low.shape[1] * scale))[:h, :w]
    if low.shape != high.shape:
        return None
    std = lambda x: (x - x.mean()) / (x.std() or 1.0)
    cross = np.fft.fft2(std(filled(high))) * np.conj(np.fft.fft2(std(low)))
    peak = np.unravel_index(int(np.argmax(np.abs(np.fft.ifft2(cross / (np.abs(cross) + 1e-12))))), (h, w))
    dy, dx = (int(p) - n if p >= n - n // 2 else int(p) for p, n in zip(peak, (h, w)))
    return dx, dy, float(np.hypot(dx, dy))


def shifts(pairs: DataFrame, key: str) -> DataFrame:
    """Registration of rows (key, lr, lr_h, lr_w, hr, hr_h, hr_w); images without two distinct values, or of shapes that don't fit, have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in parts_of(batches):
            out = []
            for r in b.to_dict("records"):
                low, high = image(r["lr"], r["lr_h"], r["lr_w"]), image(r["hr"], r["hr_h"], r["hr_w"])
                flat = any(np.isnan(x).all() or np.nanstd(x) == 0 for x in (low, high))
                out.append((r[key], *((None if flat else phase_shift(low, high)) or (None, None, None))))
            columns = zip([key, "dx", "dy", "magnitude"], zip(*out) if out else [()] * 4)
            yield pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in columns})

    return pairs.mapInPandas(run, f"`{key}` {pairs.schema[key].dataType.simpleString()}, dx int, dy int, magnitude double")


def radial_spectrum(x: np.ndarray) -> np.ndarray:
    """Mean power by whole radius under a Hann window."""
    h, w = x.shape
    x = np.nan_to_num(x, nan=float(np.nanmean(x)) if not np.isnan(x).all() else 0.0)
    power = np.abs(np.fft.fftshift(np.fft.fft2(x * np.outer(np.hanning(h), np.hanning(w))))) ** 2 / (h * w)
    y, z = np.indices((h, w))
    radius = np.hypot(y - h // 2, z - w // 2).astype(int).ravel()
    return np.bincount(radius, power.ravel()) / np.bincount(radius)


def spectra(images: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, freq, mean_power, sd_power) over all images of a key, up to half the width."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.to_dict("records"):
                power = radial_spectrum(image(r["data"], r["h"], r["w"]))[: r["w"] // 2]
                yield pd.DataFrame({**{k: r[k] for k in keys}, "freq": np.arange(len(power), dtype=np.int32), "power": power})

    fields = ", ".join(f"`{k}` {images.schema[k].dataType.simpleString()}" for k in keys)
    long = images.mapInPandas(run, f"{fields}, freq int, power double")
    return long.groupBy(*keys, "freq").agg(F.avg("power").alias("mean_power"), F.stddev_pop("power").alias("sd_power"))


def stretched(pixels: DataFrame, keys: list[str], bands: list[str], valid: Column, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Eight-bit bands by a percentile stretch shared by all bands of a key; nodata is 0."""
    long = pixels.where(valid).select(*keys, F.explode(F.array(*bands)).alias("v"))
    ends = quantiles(long, keys, "v", {"__lo": low, "__hi": high})
    scaled = lambda b: F.least(F.greatest(F.try_divide(F.col(b) - F.col("__lo"), F.col("__hi") - F.col("__lo")), F.lit(0.0)), F.lit(1.0)) * 255
    rows = pixels.join(ends, keys, "left")
    return rows.withColumns({b: F.when(valid, F.coalesce(F.floor(scaled(b)), F.lit(0))).otherwise(0).cast("int") for b in bands}).drop("__lo", "__hi")
