"""Habitat masks as sparse cells: polygons to cells, dilation, presence and absence points.

A mask is a table of TRUE cells or of runs (row, first, last); a dense grid never exists. Polygons are arrays of
rings, each an array of [x, y]; a point or cell centre is inside by the even-odd rule over all rings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored
from .matching import seeded, top_k_dealt
from .ranks import running_total

#: Polygons that a task cuts into triangles, and triangles that are handed on at a time, about.
POLYGONS, FRAME = 1_000, 10_000


def _rings(value) -> list[np.ndarray]:
    return [np.array([np.asarray(p, float) for p in ring]) for ring in value]


def with_boxes(polygons: DataFrame) -> DataFrame:
    flat = F.flatten("rings")
    x, y = F.transform(flat, lambda p: p[0]), F.transform(flat, lambda p: p[1])
    return polygons.withColumns({"x0": F.array_min(x), "x1": F.array_max(x), "y0": F.array_min(y), "y1": F.array_max(y)})


def crossings(edges: Column, x: Column, y: Column) -> Column:
    """How many edges (x1, y1, x2, y2) a ray from the point to the east meets; odd: the point is inside."""

    def met(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        return F.when((e["y1"] > y) != (e["y2"] > y), F.when(x < at, 1).otherwise(0)).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda n, e: n + met(e))


def edges_of(rings: Column) -> Column:
    """The edges of all rings, each closed by its first point."""
    def one(r: Column) -> Column:
        return F.transform(r, lambda p, i: F.struct(
            p[0].alias("x1"), p[1].alias("y1"), r[(i + 1) % F.size(r)][0].alias("x2"), r[(i + 1) % F.size(r)][1].alias("y2"),
        ))

    return F.flatten(F.transform(rings, one))


#: Grid lines of the cells are moved by this share of a cell, away from the round numbers on which vertices lie.
_OFF = 0.381966011250105


def polygon_cells(polygons: DataFrame, *, cell: float) -> DataFrame:
    """Polygons (rings) cut along a grid: (poly, cx, cy, parity, edges).

    ``parity`` says whether the cell's south-east corner is inside, and ``edges`` are those that cross the cell; cells without
    either are left out, inner cells have no edges. So a polygon ships each edge as often as it crosses cells, whatever its size.
    A polygon is known by its hash; equal ones are one.
    """
    at = lambda c: F.floor(c / cell - _OFF).cast("long")
    line = lambda i: (i + _OFF) * cell
    shapes = polygons.select(F.md5(F.to_json("rings")).alias("poly"), "rings").dropDuplicates(["poly"])
    edges = shapes.select("poly", F.explode(edges_of(F.col("rings"))).alias("e")).select("poly", "e.*").where("x1 <> x2 OR y1 <> y2")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("cy", F.explode(F.sequence(at(low), at(high))))
    x_at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise((F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    flat = F.col("y1") == F.col("y2")
    a, z = F.when(flat, F.col("x1")).otherwise(x_at(F.greatest(low, line(F.col("cy"))))), F.when(flat, F.col("x2")).otherwise(x_at(F.least(high, line(F.col("cy") + 1))))
    slack = cell * 1e-9  # an edge more changes nothing
    crossed = rows.withColumns({"__a": at(F.least(a, z) - slack), "__z": at(F.greatest(a, z) + slack)})
    crossed = crossed.withColumn("cx", F.explode(F.sequence("__a", "__z"))).groupBy("poly", "cx", "cy").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    # Where the southern line of a row of cells is inside: between its first and second meeting with the polygon, and so on.
    south = line(F.col("cy"))
    met = rows.where((F.col("y1") > south) != (F.col("y2") > south)).select("poly", "cy", x_at(south).alias("x"))
    order = Window.partitionBy("poly", "cy").orderBy("x")
    pairs = met.withColumns({"i": F.row_number().over(order), "to": F.lead("x").over(order)}).where("i % 2 = 1")
    first, last = F.ceil(F.col("x") / cell - _OFF).cast("long") - 1, F.ceil(F.col("to") / cell - _OFF).cast("long") - 2
    corners = pairs.withColumns({"a": first, "z": last}).where("a <= z").select("poly", "cy", F.explode(F.sequence("a", "z")).alias("cx"), F.lit(1).alias("parity"))
    both = crossed.join(corners, ["poly", "cx", "cy"], "full")
    none = F.array().cast(crossed.schema["edges"].dataType)
    return both.select("poly", "cx", "cy", F.coalesce("parity", F.lit(0)).alias("parity"), F.coalesce("edges", none).alias("edges"))


def inside(points: DataFrame, polygons: DataFrame, key: str, *, cell: float) -> DataFrame:
    """The points (key, lon, lat) that lie in any polygon (rings), by the even-odd rule.

    Candidates come from an equi-join of points with the cells of ``polygon_cells``. Within a cell the way from the point east to the
    border and south along it to the corner, whose parity is known, meets the cell's own edges alone.
    """
    at = lambda c: F.floor(c / cell - _OFF).cast("long")
    east, south, x, y = (F.col("cx") + 1 + _OFF) * cell, (F.col("cy") + _OFF) * cell, F.col("lon"), F.col("lat")

    def met(e: Column) -> Column:
        x_at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        y_at = (e["y2"] - e["y1"]) * (east - e["x1"]) / (e["x2"] - e["x1"]) + e["y1"]
        across = F.when((e["y1"] > y) != (e["y2"] > y), F.when((x < x_at) & (x_at <= east), 1).otherwise(0)).otherwise(0)
        return across + F.when((e["x1"] > east) != (e["x2"] > east), F.when((south < y_at) & (y_at <= y), 1).otherwise(0)).otherwise(0)

    pairs = points.withColumns({"cx": at(x), "cy": at(y)}).join(polygon_cells(polygons, cell=cell), ["cx", "cy"])
    hits = pairs.where(F.aggregate("edges", F.col("parity"), lambda n, e: n + met(e)) % 2 == 1).select(key).distinct()
    return points.join(hits, key, "left_semi")


def off_land(points: DataFrame, land: DataFrame, key: str, *, cell: float) -> DataFrame:
    """The points that are in no land polygon."""
    return points.join(inside(points, land, key, cell=cell).select(key), key, "left_anti")


def rasterize(polygons: DataFrame, key: str, *, west: float, north: float, size: float, rows: int, cols: int) -> DataFrame:
    """Runs (key, grid_row, col_first, col_last) of cells whose centre is in the polygon; row 0 is the northernmost."""

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, value in zip(b[key], b["rings"]):
                rings = _rings(value)
                y_all = np.concatenate([r[:, 1] for r in rings])
                first = max(0, int(np.floor((north - y_all.max()) / size - 0.5)))
                last = min(rows - 1, int(np.ceil((north - y_all.min()) / size)))
                for row in range(first, last + 1):
                    y, xs = north - (row + 0.5) * size, []
                    for r in rings:
                        x1, y1 = r[:, 0], r[:, 1]
                        x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
                        on = (y1 > y) != (y2 > y)
                        xs.append((x2[on] - x1[on]) * (y - y1[on]) / (y2[on] - y1[on]) + x1[on])
                    edge = np.sort(np.concatenate(xs))
                    for a, z in edge.reshape(-1, 2):  # a centre is inside where a <= x < z
                        c0, c1 = int(np.ceil((a - west) / size - 0.5)), int(np.ceil((z - west) / size - 0.5)) - 1
                        if max(c0, 0) <= min(c1, cols - 1):
                            out.append((k, row, max(c0, 0), min(c1, cols - 1)))
            yield pd.DataFrame(out, columns=[key, "grid_row", "col_first", "col_last"])

    kind = polygons.schema[key].dataType.simpleString()
    return polygons.select(key, "rings").mapInPandas(fill, f"`{key}` {kind}, grid_row int, col_first int, col_last int").distinct()


def cells_of(runs: DataFrame, keys: list[str]) -> DataFrame:
    return runs.select(*keys, "grid_row", F.explode(F.sequence("col_first", "col_last")).alias("grid_col")).distinct()


def _merged(runs: DataFrame, keys: list[str], low: str, high: str) -> DataFrame:
    """Overlapping and touching integer runs of each key become one."""
    order = Window.partitionBy(*keys).orderBy(low, high)
    before = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(low) > before + 1), 1).otherwise(0)
    runs = runs.withColumn("__new", new).withColumn("__g", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "__g").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("__g")


def runs_of(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells as runs (keys, grid_row, col_first, col_last), as long as they can be."""
    runs = cells.select(*keys, "grid_row", F.col("grid_col").alias("col_first"), F.col("grid_col").alias("col_last")).distinct()
    return _merged(runs, [*keys, "grid_row"], "col_first", "col_last")


def dilate_runs(runs: DataFrame, keys: list[str], radius: int, rows: int, cols: int, *, block: int = 128) -> DataFrame:
    """The square neighbourhood of ``radius`` cells round runs, clipped to the grid, as runs.

    Runs are widened and merged along rows. Blocks of rows then get the runs that reach them, two blocks for a run at most where
    a block is as high as the neighbourhood, and a sweep down the block unites for each row the runs of the rows within the radius.
    Nothing is ever a cell; a block holds its own runs.
    """
    wide = runs.select(*keys, "grid_row", F.greatest(F.col("col_first") - radius, F.lit(0)).alias("a"), F.least(F.col("col_last") + radius, F.lit(cols - 1)).alias("z"))
    wide = _merged(wide, [*keys, "grid_row"], "a", "z")
    high = max(block, 2 * radius + 1)
    at = lambda r: F.floor(r / high).cast("int")
    r = F.col("grid_row")
    near = F.sequence(at(F.greatest(r - radius, F.lit(0))), at(F.least(r + radius, F.lit(rows - 1))))
    dealt = wide.withColumn("__b", F.explode(near))

    def sweep(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("grid_row", kind="stable")
        row, a, z = (group[c].to_numpy() for c in ("grid_row", "a", "z"))
        first = int(group["__b"].iloc[0]) * high
        out = []
        for at_row in range(first, min(first + high, rows)):
            lo, hi = np.searchsorted(row, (at_row - radius, at_row + radius + 1))
            if lo == hi:
                continue
            order = np.argsort(a[lo:hi], kind="stable")
            begin, end = a[lo:hi][order], np.maximum.accumulate(z[lo:hi][order])
            new = np.flatnonzero(np.append(True, begin[1:] > end[:-1] + 1))
            out.append(np.column_stack([np.full(len(new), at_row), begin[new], end[np.append(new[1:] - 1, len(end) - 1)]]))
        flat = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        named = pd.DataFrame(flat, columns=["grid_row", "col_first", "col_last"])
        for k in reversed(keys):
            named.insert(0, k, group[k].iloc[0])
        return named

    kinds = ", ".join(f"`{k}` {runs.schema[k].dataType.simpleString()}" for k in keys)
    return dealt.groupBy(*keys, "__b").applyInPandas(sweep, f"{kinds}, grid_row int, col_first int, col_last int" if keys else "grid_row int, col_first int, col_last int")


def dilate(cells: DataFrame, keys: list[str], radius: int, rows: int, cols: int) -> DataFrame:
    """The square neighbourhood of ``radius`` cells, clipped to the grid, as cells."""
    return cells_of(dilate_runs(runs_of(cells, keys), keys, radius, rows, cols), keys)


def combined_runs(first: DataFrame, second: DataFrame, keys: list[str], keep: Column) -> DataFrame:
    """Set algebra of two masks of runs: where ``keep`` holds of the booleans ``in_first`` and ``in_second``, as runs.

    Every run is two events, one where it begins and one past its end; running sums of the events of a row say how many runs of
    either mask are open up to the next event. Runs may overlap, and a mask may have any number of them.
    """
    own = [*keys, "grid_row"]

    def events(runs: DataFrame, a: int, b: int) -> DataFrame:
        ends = F.array(F.struct(F.col("col_first").alias("at"), F.lit(1).alias("s")), F.struct((F.col("col_last") + 1).alias("at"), F.lit(-1).alias("s")))
        return runs.select(*own, F.explode(ends).alias("e")).select(*own, "e.at", (F.col("e.s") * a).alias("a"), (F.col("e.s") * b).alias("b"))

    steps = events(first, 1, 0).unionByName(events(second, 0, 1)).groupBy(*own, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    order = Window.partitionBy(*own).orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    spans = steps.select(*own, F.col("at").alias("col_first"), (F.lead("at").over(order) - 1).alias("col_last"),
                         (F.sum("a").over(upto) > 0).alias("in_first"), (F.sum("b").over(upto) > 0).alias("in_second"))
    kept = spans.where(keep & F.col("col_last").isNotNull()).select(*own, "col_first", "col_last")
    return _merged(kept, own, "col_first", "col_last")


def union_runs(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    return combined_runs(first, second, keys, F.col("in_first") | F.col("in_second"))


def difference_runs(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    return combined_runs(first, second, keys, F.col("in_first") & ~F.col("in_second"))


def common_runs(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    return combined_runs(first, second, keys, F.col("in_first") & F.col("in_second"))


def unit(key: Column, seed: int, salt: str) -> Column:
    """A number in [0, 1) from the first digits of a seeded hash, the same in every engine."""
    return F.conv(F.substring(seeded(F.concat_ws("|", F.lit(salt), key), seed), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def presence_points(cells: DataFrame, keys: list[str], n: int, seed: int, *, west: float, north: float, size: float) -> DataFrame:
    """``n`` points of each key: cells in seeded order (again from the first if there are too few), jittered inside.

    The first cells of each of many parts of a key are kept before the last rank, and cells are counted by groups.
    """
    cell = F.concat_ws("|", *keys, "grid_row", "grid_col")
    first = top_k_dealt(cells.withColumn("__h", seeded(cell, seed)), keys, ["__h", "grid_row", "grid_col"], n, F.col("__h"))
    ranked = first.withColumn("__i", F.col("rank") - 1).join(cells.groupBy(*keys).agg(F.count("*").alias("__n")), keys)
    picked = ranked.withColumn("__round", F.explode(F.sequence(F.lit(0), F.expr(f"({n} - 1 - __i) div __n"))))
    key = F.concat_ws("|", cell, "__round")
    number = (F.col("__round") * F.col("__n") + F.col("__i")).cast("int")
    return picked.select(
        *keys, number.alias("number"), "grid_row", "grid_col", (F.lit(west) + (F.col("grid_col") + unit(key, seed, "x")) * size).alias("lon"),
        (F.lit(north) - (F.col("grid_row") + unit(key, seed, "y")) * size).alias("lat"),
    )


def absence_runs(cells: DataFrame, habitat: str, radius: int, rows: int, cols: int, water: DataFrame | None = None) -> DataFrame:
    """Runs near one habitat and in none of all; coral and seagrass only in ``water`` (cells)."""
    own = runs_of(cells.where(F.col("habitat") == habitat), [])
    near = difference_runs(dilate_runs(own, [], radius, rows, cols), runs_of(cells, []), [])
    if water is not None and habitat in ("coral", "seagrass"):
        near = common_runs(near, runs_of(water, []), [])
    return near.select(F.lit(habitat).alias("habitat"), "grid_row", "col_first", "col_last")


def presence_absence(presence: DataFrame, absence: DataFrame) -> DataFrame:
    """One balanced table with ids ``<habitat>_presence_0000`` and labels 1 and 0."""
    part = lambda rows, kind, label: rows.select(
        F.format_string(f"%s_{kind}_%04d", "habitat", "number").alias("point_id"), "habitat", F.lit(label).alias("label"), "lon", "lat"
    )
    return part(presence, "presence", 1).unionByName(part(absence, "absence", 0))


def weighted_polygons(polygons: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` draws of polygons with the probability of their equal-area area (key, draw, how many).

    Each draw is a seeded number; it falls into the interval of its polygon's running share. Draws and intervals meet in
    as many buckets of the unit interval as there are draws, so that a bucket has about one draw.
    """
    lat = lambda p: F.sin(F.radians(p[1]))
    ring_area = lambda r: F.abs(F.aggregate(
        F.sequence(F.lit(0), F.size(r) - 1), F.lit(0.0),
        lambda acc, i: acc + (r[i][0] * lat(r[(i + 1) % F.size(r)]) - r[(i + 1) % F.size(r)][0] * lat(r[i])),
    )) / 2
    areas = F.aggregate("rings", F.lit(0.0), lambda acc, r: acc + ring_area(r))
    area = (2 * ring_area(F.col("rings")[0]) - areas).cast("decimal(28,15)")  # the first ring without the others, which are holes
    areas = polygons.select(key, area.alias("area"))
    total = areas.agg(F.sum("area").alias("t"))
    shares = running_total(areas, [key], F.col("area"), "upto").crossJoin(F.broadcast(total))
    share = lambda c: c.cast("double") / F.col("t").cast("double")
    # Sums of decimals are exact, so an interval ends where the next begins, and the last at 1.
    shares = shares.withColumns({"low": share(F.col("upto") - F.col("area")), "high": share(F.col("upto"))})
    bucket = lambda c: F.floor(c * float(n)).cast("long")
    spread = shares.withColumn("b", F.explode(F.sequence(bucket(F.col("low")), bucket(F.col("high")))))
    draws = polygons.sparkSession.range(n).select(F.col("id").alias("draw"), unit(F.col("id"), seed, "draw").alias("u"))
    hit = draws.withColumn("b", bucket(F.col("u"))).join(spread, "b").where("u >= low AND u < high")
    return hit.select("draw", key, "u")


def _slabs(rings: list[np.ndarray]) -> np.ndarray:
    """(y0, y1, left and right at y0, left and right at y1) of the trapezoids that a polygon consists of, by the even-odd rule."""
    start, end = np.concatenate(rings), np.concatenate([np.roll(r, -1, axis=0) for r in rings])
    up = start[:, 1] != end[:, 1]
    a, z = start[up], end[up]
    swap = a[:, 1] > z[:, 1]
    a[swap], z[swap] = z[swap], a[swap].copy()
    order = np.argsort(a[:, 1], kind="stable")
    a, z = a[order], z[order]
    slope = (z[:, 0] - a[:, 0]) / (z[:, 1] - a[:, 1])
    levels = np.unique(np.concatenate([a[:, 1], z[:, 1]]))
    entered = np.searchsorted(a[:, 1], levels, side="right")
    slack = 1e-12 * (1 + np.abs(start[:, 0]).max())  # what rounding makes of two edges that meet
    out, active = [], np.zeros(0, np.int64)
    for i in range(len(levels) - 1):
        before = entered[i - 1] if i else 0
        active = np.concatenate([active, np.arange(before, entered[i])])
        active = active[z[active, 1] > levels[i]]
        todo = [(levels[i], levels[i + 1])]
        while todo:
            lo, hi = todo.pop()
            x = lambda y: a[active, 0] + slope[active] * (y - a[active, 1])  # noqa: B023, E731
            order = np.argsort(x((lo + hi) / 2), kind="stable")
            x0, x1 = x(lo)[order], x(hi)[order]
            d0, d1 = np.diff(x0), np.diff(x1)  # neighbours that cross within the slab change sides: it is cut at the lowest crossing
            turned = (np.minimum(d0, d1) < -slack) & (np.maximum(d0, d1) > 0)
            if turned.any():
                cut = lo + (hi - lo) * float((d0[turned] / (d0[turned] - d1[turned])).min())
                if lo < cut < hi:
                    todo += [(cut, hi), (lo, cut)]
                    continue
            left, right = slice(0, len(x0) - len(x0) % 2, 2), slice(1, None, 2)
            out.append(np.column_stack([np.full(len(x0) // 2, lo), np.full(len(x0) // 2, hi), x0[left], x0[right], x1[left], x1[right]]))
    return np.concatenate(out) if out else np.zeros((0, 6))


def triangles(polygons: DataFrame, key: str) -> DataFrame:
    """Triangles (ax, ay, bx, by, cx, cy) that a polygon (rings) consists of by the even-odd rule, holes and crossings too, with each one's share
    of the polygon's area as an interval: ``low`` of one is ``high`` of the one before it, the last ends at 1. ``n`` is their number.

    A polygon is cut at the heights of its vertices (and of crossings of its edges), which gives trapezoids of two triangles each;
    work and memory grow with the edges of one polygon and the levels that they span. Polygons without an area have none.
    """
    names = ["low", "high", "n", "ax", "ay", "bx", "by", "cx", "cy"]

    def framed(keys: list, found: list[np.ndarray]) -> pd.DataFrame:
        rows = pd.DataFrame(np.concatenate(found), columns=names)
        of = np.empty(len(keys), object)
        of[:] = keys
        rows.insert(0, key, np.repeat(of, [len(x) for x in found]))
        return rows.astype({"n": "int64"})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, found, held = [], [], 0
        for batch in batches:
            for k, value in zip(batch[key], batch["rings"]):
                rings = [] if value is None else [r for r in _rings(value) if len(r) > 2]
                if not rings:
                    continue
                y0, y1, l0, r0, l1, r1 = _slabs(rings).T
                corners = np.concatenate([np.column_stack([l0, y0, r0, y0, l1, y1]), np.column_stack([r0, y0, r1, y1, l1, y1])])
                area = np.concatenate([(r0 - l0) * (y1 - y0), (r1 - l1) * (y1 - y0)])
                corners, area = corners[area > 0], area[area > 0]
                if len(area):
                    ends = np.minimum(np.cumsum(area) / area.sum(), 1.0)
                    ends[-1] = 1.0
                    rows = np.column_stack([np.append(0.0, ends[:-1]), ends, np.full(len(area), len(area)), corners])
                    keys.append(k)
                    found.append(rows[rows[:, 0] < rows[:, 1]])
                    held += len(found[-1])
                    if held >= FRAME:
                        yield framed(keys, found)
                        keys, found, held = [], [], 0
        if found:
            yield framed(keys, found)

    kind = polygons.schema[key].dataType.simpleString()
    n = polygons.count()
    dealt = polygons.select(key, "rings").repartition(max(1, -(-n // POLYGONS)))  # a small file of many polygons is no single task
    return dealt.mapInPandas(cut, f"`{key}` {kind}, low double, high double, n long, " + ", ".join(f"{c} double" for c in names[3:]))


def points_in_polygons(draws: DataFrame, polygons: DataFrame, key: str, seed: int) -> DataFrame:
    """A uniform point (lon, lat) in the polygon of each draw (draw, key): one number picks a triangle by its share of the area, two
    place the point in it. NULLs for a polygon that has no area or is not there.

    Draws and shares meet in as many buckets of the unit interval as the polygon has triangles, so a bucket has few of them.
    """
    parts = stored(triangles(polygons, key), "triangles")  # used twice
    bucket = lambda u: F.least(F.floor(u * F.col("n")), F.col("n") - 1).cast("long")
    sizes = parts.groupBy(key).agg(F.max("n").alias("n"))
    parts = parts.withColumn("__b", F.explode(F.sequence(bucket(F.col("low")), bucket(F.col("high")))))
    name = F.col("draw").cast("string")
    asked = draws.join(sizes, key, "left").withColumn("__u", unit(name, seed, "part"))
    asked = asked.select(*draws.columns, "__u", bucket(F.col("__u")).alias("__b"))
    parts = parts.drop("n").withColumnsRenamed({key: "__poly", "__b": "__at"})
    own = (F.col(key) == F.col("__poly")) & (F.col("__b") == F.col("__at")) & (F.col("__u") >= F.col("low")) & (F.col("__u") < F.col("high"))
    root, side = F.sqrt(unit(name, seed, "away")), unit(name, seed, "side")
    place = lambda c: F.col(f"a{c}") + root * ((1 - side) * (F.col(f"b{c}") - F.col(f"a{c}")) + side * (F.col(f"c{c}") - F.col(f"a{c}")))
    return asked.join(parts, own, "left").select(*draws.columns, place("x").alias("lon"), place("y").alias("lat"))
