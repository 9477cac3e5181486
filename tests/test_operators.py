"""Properties of the operators that SQL does not cover, and their edges."""

import datetime as dt
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from benthic_jobs.functions import exact
from benthic_jobs.operators import analyse, collapse, curation, habitat, matching, quality, ranks, raster, sampling


def test_day_distance_and_ties(spark):
    obs = spark.createDataFrame([(1, "a", dt.date(2020, 1, 10)), (2, "b", dt.date(2020, 1, 10)), (3, "c", dt.date(2020, 1, 10))], "id int, k string, day date")
    at = dt.datetime
    scenes = spark.createDataFrame([(1, "a", at(2020, 1, 9, 12)), (2, "a", at(2020, 1, 10, 12)), (3, "b", at(2020, 1, 12)), (4, "b", at(2020, 1, 8))], "scene int, k string, t timestamp")
    got = {r["id"]: (r["scene"], r["dist"]) for r in matching.nearest_scene(obs, scenes, ["k"], "day", "t", "scene", 5).collect()}
    assert got == {1: (2, 0), 2: (4, 2), 3: (None, None)}  # noon before: a day, noon after: none; equal distance: the earlier


def test_days_around_against_brute_force(spark):
    day, rng = dt.date(2020, 1, 1), np.random.default_rng(5)
    some = lambda n: [(i, "abc"[rng.integers(3)], day + dt.timedelta(int(rng.integers(0, 400)))) for i in range(n)]
    asked, seen = some(150) + [(900, None, day), (901, "a", None), (902, "d", day)], some(40)
    obs = spark.createDataFrame(asked, "id int, k string, day date")
    scenes = spark.createDataFrame([(i, k, dt.datetime.combine(d, dt.time(3))) for i, k, d in seen], "scene int, k string, t timestamp")
    got = {r["id"]: (r["scene"], r["dist"]) for r in matching.nearest_scene(obs, scenes, ["k"], "day", "t", "scene", 20).collect()}
    for i, k, d in asked:
        near = [(abs((t - d).days), t, s) for s, key, t in seen if d and key == k and abs((t - d).days) <= 20]
        assert got[i] == ((min(near)[2], min(near)[0]) if near else (None, None))
    plan = matching.nearest_scene(obs, scenes, ["k"], "day", "t", "scene", 20)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1  # both directions in one order


def test_turbidity_of_areas_without_values(spark):
    rows = [("a", 1, 4.0, 2.0), ("a", 1, 6.0, 2.0), ("a", 1, None, 8.0), ("a", 2, None, 1.0), ("b", 1, None, None), ("c", 1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "aoi string, cell int, r double, g double")
    got = {r["aoi"]: r["turbidity_index"] for r in sampling.turbidity_index(df, "aoi", ["cell"], "r", "g").collect()}
    assert got == {"a": pytest.approx(3 / 7), "b": None, "c": None}
    assert sampling.turbidity_index(df.limit(0), "aoi", ["cell"], "r", "g").count() == 0


def test_clarity_without_scores(spark):
    obs = spark.createDataFrame([(1, "a", dt.date(2020, 1, 10))], "id int, k string, day date")
    scenes = spark.createDataFrame([(1, "a", dt.datetime(2020, 1, 9), None), (2, "a", dt.datetime(2020, 1, 5), None)], "scene int, k string, t timestamp, s double")
    row = matching.clearest_scene(obs, scenes, ["k"], "day", "t", "scene", "s", 30).first()
    assert (row["scene"], row["tier"]) == (2, 4)  # without any score: the first in acquisition order


def test_covers(spark):
    rows = [("a", "X"), ("a", "Y"), ("a", None), ("a", "Tape"), ("b", "Tape"), ("c", None)]
    df = spark.createDataFrame(rows, "site string, label string")
    long = collapse.cover_long(df, "site", "label", ["X", "Y", "Z"], collapse.is_benthic(F.col("label"), ["Tape"]))
    got = {(r[0], r[1]): r[2] for r in long.collect()}
    assert got["a", "X"] == pytest.approx(100 / 3) and got["a", "Z"] == 0.0
    assert got["b", "X"] is None and got["c", "X"] is None


def test_merged_windows_touch_and_repeat(spark):
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 5), dt.date(2020, 1, 5), dt.date(2020, 1, 10)]
    df = spark.createDataFrame([("k", d) for d in days] + [("k", None)], "k string, d date")
    got = sorted((str(r["window_start"]), str(r["window_end"]), r["n_dates"]) for r in collapse.merged_windows(df, ["k"], "d", 2).collect())
    assert got == [("2019-12-30", "2020-01-07", 2), ("2020-01-08", "2020-01-12", 1)]


def test_stratified_cap_below_the_limit(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(9)], "k int, s int")
    assert collapse.stratified_cap(df, ["s"], "k", 20, 1).count() == 9
    assert collapse.stratified_cap(df, ["s"], "k", 6, 1).groupBy("s").count().where("count = 2").count() == 3


@pytest.mark.parametrize("n_free", [0, 2, 9])
def test_allocate_ids(spark, n_free):
    new = spark.createDataFrame([(f"n{i}",) for i in range(4)], "name string")
    freed = spark.createDataFrame([(i * 2,) for i in range(n_free)], "id long")
    used = spark.createDataFrame([(1,), (2,)], "id long")
    got = [r["id"] for r in curation.allocate_ids(new, freed, used, ["name"], "id").orderBy("name").collect()]
    free = [i * 2 for i in range(n_free) if i * 2 != 2]
    top = max([1, 2, *(i * 2 for i in range(n_free))])
    assert got == (free + [top + 1 + i for i in range(4)])[:4]


def test_numbered_is_order_free(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000)
    for rows in (df, df.repartition(7)):
        assert ranks.numbered(rows, ["v"], "n").where("n <> v + 1").count() == 0


def test_dilation_against_brute_force(spark):
    rng = np.random.default_rng(4)
    mask = rng.random((50, 50)) < 0.02
    cells = spark.createDataFrame([("h", int(r), int(c)) for r, c in np.argwhere(mask)], "habitat string, grid_row int, grid_col int")
    want = {(r, c) for r in range(50) for c in range(50) if mask[max(r - 3, 0) : r + 4, max(c - 3, 0) : c + 4].any()}
    got = [(r["grid_row"], r["grid_col"]) for r in habitat.dilate(cells, ["habitat"], 3, 50, 50).collect()]
    assert set(got) == want and len(got) == len(want)


def test_phase_shift_of_rolled_images():
    rng = np.random.default_rng(2)
    x = rng.random((64, 64))
    for dy, dx in ((0, 0), (3, -5), (-7, 2), (-32, -32)):
        assert raster.phase_shift(x, np.roll(x, (dy, dx), (0, 1)))[:2] == (dx, dy)
    small = x.reshape(32, 2, 32, 2).mean(axis=(1, 3))
    for dy, dx in ((0, 0), (3, -5), (10, 9)):
        assert raster.phase_shift(small, np.roll(raster.upsample(small, 64, 64), (dy, dx), (0, 1)))[:2] == (dx, dy)
    assert raster.phase_shift(np.ones((32, 16)) * x[:32, :16], x) is None  # twice its size is not the other's


def test_phase_shift_against_a_direct_sum():
    rng = np.random.default_rng(5)
    low, high = rng.random((4, 4)), rng.random((8, 8))
    a, b = raster.upsample(low, 8, 8), high
    wave = np.exp(-2j * np.pi * np.outer(np.arange(8), np.arange(8)) / 8)
    cross = (wave @ (b - b.mean()) @ wave) * np.conj(wave @ (a - a.mean()) @ wave)
    cross /= np.abs(cross) + 1e-12
    surface = {(dx, dy): abs((cross * np.exp(2j * np.pi * (np.arange(8)[:, None] * dy + np.arange(8) * dx) / 8)).sum()) for dx in range(-4, 4) for dy in range(-4, 4)}
    assert raster.phase_shift(low, high)[:2] == max(surface, key=surface.get)


def test_spline_keeps_points_and_cubics():
    x = np.arange(9.0)
    assert np.allclose(raster.upsample(np.outer(x, x), 9, 9), np.outer(x, x))
    fine = raster.upsample(np.outer(np.ones(9), np.cos(x * np.pi / 8)), 9, 33)  # even at both ends, as the mirror takes it
    assert np.allclose(fine[0], np.cos(np.linspace(0, np.pi, 33)), atol=1e-3)


@pytest.mark.parametrize("n", [1, 4, 31, 700])
def test_rolling_bias_against_brute_force(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, float(rng.integers(0, 20)), None if rng.random() < 0.2 else float(rng.normal())) for i in range(n)]
    got = {r["k"]: r["rolling"] for r in analyse.rolling_bias(spark.createDataFrame(rows, "k int, g double, b double"), "g", "b", "k").collect()}
    order, width = sorted(rows, key=lambda r: (r[1], r[0])), max(30, n // 20)
    for i, (k, _, _) in enumerate(order):
        own = [b for _, _, b in order[max(0, i - width // 2) : i + (width - 1) // 2 + 1] if b is not None]
        assert got[k] == (pytest.approx(np.mean(own), abs=1e-9) if len(own) >= 5 else None)


def test_quantiles_against_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(v)) for k, n in (("a", 1), ("b", 2), ("c", 101)) for v in rng.integers(0, 30, n)] + [("d", None), (None, 3.0), (None, 4.0)]
    got = {r["k"]: (r["x"], r["y"], r["z"]) for r in ranks.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"x": 0.0, "y": 0.37, "z": 1.0}).collect()}
    assert set(got) == {"a", "b", "c", None}
    for k in got:
        assert got[k] == pytest.approx(np.quantile([v for q, v in rows if q == k], [0, 0.37, 1]))


def test_scenes_against_all_pairs(spark):
    rng = np.random.default_rng(8)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=int(n))
    obs = [(i, "ab"[i % 2] if i % 17 else None, day(rng.integers(0, 90)) if i % 13 else None) for i in range(150)]
    scenes = [(i, "ab"[i % 2] if i % 19 else None, day(rng.integers(0, 90)) if i % 11 else None, None if i % 5 == 0 else float(rng.random())) for i in range(40)]
    left = spark.createDataFrame(obs, "id int, k string, day date")
    right = spark.createDataFrame(scenes, "scene int, k string, t date, s double")
    near = {r["id"]: (r["scene"], r["dist"]) for r in matching.nearest_scene(left, right, ["k"], "day", "t", "scene", 4).collect()}
    clear = {r["id"]: r["scene"] for r in matching.clearest_scene(left, right, ["k"], "day", "t", "scene", "s", 9).collect()}
    other = {r["id"]: r["scene"] for r in matching.same_day_else_nearest(left, right, ["k"], "day", "t", "scene").collect()}
    asked = left.selectExpr("k", "unix_date(day) AS __d").dropna()
    counts = {(r["k"], r["__d"]): r["n"] for r in matching.counts_within(asked, right.selectExpr("k", "unix_date(t) AS __d"), ["k"], 6).collect()}
    tier = lambda s: 4 if s is None else 0 if s >= 0.75 else 1 if s >= 0.6 else 2 if s >= 0.4 else 3
    assert len(near) == len(clear) == len(other) == 150
    for i, k, d in obs:
        own = [(abs((t - d).days), t, c, s) for c, q, t, s in scenes if k and q == k and t and d]
        close = min(((g, t, c) for g, t, c, _ in own if g <= 4), default=(None, None, None))
        assert near[i] == (close[2], close[0])
        ranked = [(tier(s), g if s is not None else 0, t, c) for g, t, c, s in own if -9 <= (t - d).days <= 8]
        assert clear[i] == (min(ranked)[3] if ranked else None)
        same = min(((g, c) for g, _, c, _ in own), default=(None, min((c for c, q, _, _ in scenes if k and q == k), default=None)))
        assert other[i] == same[1]
        if k and d:
            assert counts[k, (d - dt.date(1970, 1, 1)).days] == sum(g <= 6 for g, *_ in own)


def even_odd(x, y, rings):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            inside ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return inside


@pytest.mark.parametrize("cell", [0.7, 3.0, 100.0])
def test_points_in_polygons_against_brute_force(spark, cell):
    rng = np.random.default_rng(6)
    polygons = [(p, [[[float(v) for v in rng.uniform(-9, 9, 2)] for _ in range(rng.integers(3, 9))] for _ in range(1 + p % 2)]) for p in range(5)]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-10, 10, (300, 2)))]
    shapes = spark.createDataFrame(polygons, "poly int, rings array<array<array<double>>>")
    df = spark.createDataFrame(points, "i int, lon double, lat double")
    want = {i for i, x, y in points if any(even_odd(x, y, r) for _, r in polygons)}
    assert {r["i"] for r in habitat.inside(df, shapes, "i", cell=cell).collect()} == want
    assert {r["i"] for r in habitat.off_land(df, shapes, "i", cell=cell).collect()} == {i for i, *_ in points} - want
    draws = spark.createDataFrame([(d, d % 5) for d in range(200)], "draw int, poly int")
    got = habitat.points_in_polygons(draws, shapes, "poly", 3).collect()
    assert len(got) == 200 and all(even_odd(r["lon"], r["lat"], polygons[r["poly"]][1]) for r in got)


def test_presence_points_repeat_cells_of_small_masks(spark):
    cells = spark.createDataFrame([("a", i, i) for i in range(700)] + [("b", 1, 1), ("b", 2, 2)], "habitat string, grid_row int, grid_col int")
    got = habitat.presence_points(cells, ["habitat"], 5, 1, west=0.0, north=0.0, size=1.0).collect()
    assert sorted((r["habitat"], r["number"]) for r in got) == [(h, i) for h in "ab" for i in range(5)]
    assert len({(r["lon"], r["lat"]) for r in got}) == 10 and len({r["grid_row"] for r in got if r["habitat"] == "a"}) == 5


@pytest.mark.parametrize("step, size", [(10.0, 4), (3.7, 5), (41.0, 3), (10.0, 64)])
def test_images_in_blocks_equal_whole_images(spark, step, size):
    rng = np.random.default_rng(11)
    rows, cut = [], []
    for i, (h, w, left, top) in enumerate([(23, 17, -13.0, 160.0), (9, 31, 40.5, 77.7), (5, 5, 9000.0, 9000.0), (1, 1, 3.0, 40.0), (16, 16, 0.0, 160.0)]):
        x = rng.uniform(0, 70000, (h, w))
        x[rng.random((h, w)) < 0.2] = np.nan
        data = [None if np.isnan(v) else float(v) for v in x.ravel()]
        for qa in (False, True):
            meta = (h, w, left, top, 10.0, 0.0, 0.0, qa)
            rows.append((i, data, *meta))
            for r in range(-(-h // size)):
                for c in range(-(-w // size)):
                    part = [None if np.isnan(v) else float(v) for v in x[r * size : r * size + size, c * size : c * size + size].ravel()]
                    cut.append((i, part, r, c, *meta))
    meta = "h int, w int, left double, top double, px double, origin_x double, origin_y double, is_qa boolean"
    images = spark.createDataFrame(rows, f"i int, data array<double>, {meta}")
    blocks = spark.createDataFrame(cut, f"i int, data array<double>, block_row int, block_col int, {meta}").repartition(7)
    keys = ["i", "is_qa"]

    def whole(df):
        return {(r["i"], r["is_qa"]): np.array(r["data"], float) for r in df.collect()}

    def joined(df):
        out = {}
        for r in df.collect():
            grid = out.setdefault((r["i"], r["is_qa"]), np.full((r["n"], r["n"]), -9.0))
            at = grid[r["block_row"] * size : (r["block_row"] + 1) * size, r["block_col"] * size : (r["block_col"] + 1) * size]
            at[:] = np.array(r["data"], float).reshape(at.shape)
        return {k: g.ravel() for k, g in out.items()}

    for a, b in (
        (whole(raster.aligned(images, keys, patch_m=163)), joined(raster.aligned_blocks(blocks, keys, size=size, patch_m=163))),
        (whole(raster.standardized(images, keys, patch=13, step=step)), joined(raster.standardized_blocks(blocks, keys, size=size, patch=13, step=step))),
    ):
        assert a.keys() == b.keys() and len(a) == 10
        assert all(np.array_equal(a[k], b[k], equal_nan=True) for k in a)
    gone = blocks.where("i = 4 AND NOT is_qa AND NOT (block_row = 0 AND block_col = 0)")  # a block that is missing is nodata
    if size < 16:
        got = joined(raster.aligned_blocks(gone, keys, size=size, patch_m=163))[4, False].reshape(17, 17)
        full = joined(raster.aligned_blocks(blocks, keys, size=size, patch_m=163))[4, False].reshape(17, 17)
        assert np.isnan(got[1:size, :size]).all() and np.array_equal(got[size + 2 :], full[size + 2 :], equal_nan=True)
    assert raster.aligned_blocks(blocks.where("false"), keys, size=size, patch_m=163).count() == 0


def test_resample():
    x = np.arange(16.0).reshape(4, 4)
    same = raster.resample(x, 0, 40, 10, 0, 0, 10, 4)
    assert np.allclose(same, x)
    shifted = raster.resample(x, 0, 40, 10, 5, 0, 10, 4)
    assert np.allclose(shifted[:, :3], x[:, :3] + 0.5) and np.isnan(raster.resample(x, 0, 40, 10, 100, 0, 10, 4)).all()
    hole = x.copy()
    hole[1, 1] = np.nan
    assert np.allclose(raster.resample(hole, 0, 40, 10, 5, 0, 10, 4)[1, 0], x[1, 0])
    assert raster.resample(hole, 0, 40, 10, 0, 0, 5, 8, nearest=True)[7, 0] == x[3, 0]


def test_spectrum_of_a_wave():
    wave = np.sin(np.arange(64) * 2 * np.pi * 8 / 64)[None, :] * np.ones((64, 1))
    assert int(np.argmax(raster.radial_spectrum(wave))) == 8


def test_tiles_keep_full_ones_only(spark):
    df = spark.createDataFrame([("i", r, c, None if r < 2 else 1) for r in range(5) for c in range(4)], "i string, r int, c int, v int")
    got = {r["tile"] for r in raster.tiles(df, ["i"], "r", "c", "v", 2, F.col("v").isNotNull()).collect()}
    assert got == {"i_1_0", "i_1_1"}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (1.1,)], "v double")
    got = {r["bin"]: r["n"] for r in analyse.histogram(df, [], "v", F.lit(0.0), F.lit(1.0), 2).collect()}
    assert got == {0: 1, 1: 2}


def test_first_glint_hides_its_haze(spark):
    rows = [(1, "a", True, True), (1, "b", True, True), (2, "a", True, True)]
    df = spark.createDataFrame(rows, "s int, f string, glint boolean, haze boolean").withColumns({"swath": F.lit(False), "cloud": F.lit(False)})
    got = {(r["sample"], r["code"], r["detail"]) for r in quality.scene_issues(df, "s", "f").collect()}
    assert got == {(1, "glint", "a"), (1, "haze", "b"), (2, "glint", "a")}


def test_nodata_is_null_nan_or_the_value(spark):
    df = spark.createDataFrame([("a", float("nan"), 64), ("a", None, 64), ("a", -1.0, 64), ("b", 5.0, 8)], "k string, v double, qa int")
    got = {r["k"]: r["finding"] for r in quality.nodata_and_cloud(df, ["k"], "v", "qa", -1.0).collect()}
    assert got == {"a": "nodata", "b": "cloud"}


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "site string, label string, d date, grid_row int, grid_col int, habitat string")
    assert collapse.shannon(none, "site", "label").count() == 0
    assert collapse.merged_windows(none, ["site"], "d", 2).count() == 0
    assert habitat.dilate(none, ["habitat"], 2, 9, 9).count() == 0
    assert collapse.stratified_cap(none.select("site", "label"), ["label"], "site", 5, 1).count() == 0


def test_stored_tables_go_with_their_block(spark):
    from benthic_jobs import storage

    outer = storage.stored(spark.range(2), "x")
    with pytest.raises(ValueError), storage.cleared(spark):
        held = storage.stored(spark.range(3), "x")
        with storage.cleared(spark):
            inner = storage.stored(spark.range(4), "x")
            assert inner.count() == 4
        assert held.count() == 3 and not Path(inner.inputFiles()[0].removeprefix("file:")).exists()
        raise ValueError
    assert not Path(held.inputFiles()[0].removeprefix("file:")).exists() and outer.count() == 2
    assert "scope-" not in storage.stored(spark.range(2), "x").inputFiles()[0]


def test_shared_folder(spark):
    from types import SimpleNamespace as Fake

    from benthic_jobs import storage

    assert ":" in storage.shared_dir(spark) and storage.stored(spark.range(3), "x").count() == 3
    own = spark.sparkContext

    def session(master, folder=None, at=None):
        fake = Fake(master=master, getConf=lambda: {"spark.checkpoint.dir": folder}, getCheckpointDir=lambda: held.get("at"), _jvm=own._jvm, _jsc=own._jsc)
        held, fake.setCheckpointDir = {"at": at}, lambda x: held.update(at=x)
        return Fake(sparkContext=fake, conf=Fake(get=lambda key, default: default))

    assert storage.shared_dir(session("spark://somewhere:7077", "/shared/x")) == "file:/shared/x"
    assert storage.shared_dir(session("yarn", "hdfs://name/x/")) == "hdfs://name/x" and storage.shared_dir(session("yarn", at="s3a://b/y")) == "s3a://b/y"
    alone = session("local[4]")
    assert storage.shared_dir(alone) == storage.shared_dir(alone) != storage.shared_dir(session("local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(session("spark://somewhere:7077"))


SHAPES = {
    "thin": [[[0.0, 0.0], [9.0, 9.0], [9.0001, 9.001]]],
    "holed": [[[0.0, 0.0], [9.0, 0.0], [9.0, 9.0], [0.0, 9.0]], [[3.0, 3.0], [6.0, 3.0], [6.0, 6.0], [3.0, 6.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0]]],
    "bow": [[[0.0, 0.0], [4.0, 4.0], [4.0, 0.0], [0.0, 4.0]]],  # crosses itself
    "comb": [[[0.0, 0.0], [9.0, 0.0], [9.0, 5.0], [8.0, 1.0], [7.0, 5.0], [6.0, 1.0], [5.0, 5.0], [4.0, 1.0], [3.0, 5.0], [0.0, 0.0]]],
    "two": [[[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]], [[5.0, 5.0], [7.0, 5.0], [5.0, 7.0]]],
    "flat": [[[0.0, 0.0], [3.0, 3.0], [6.0, 6.0]]], "line": [[[1.0, 1.0], [2.0, 1.0]]], "none": [],
}


def shoelace(ring):
    return abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]))) / 2


def test_triangles_have_the_area_and_the_shares(spark):
    rng = np.random.default_rng(3)
    wild = {f"wild{i}": [[[float(v) for v in rng.uniform(-9, 9, 2)] for _ in range(12)] for _ in range(1 + i % 2)] for i in range(6)}
    df = spark.createDataFrame([*SHAPES.items(), *wild.items(), ("gone", None)], "poly string, rings array<array<array<double>>>")
    rows = habitat.triangles(df, "poly").orderBy("poly", "low").collect()
    area, last = {}, {}
    for r in rows:
        p = r["poly"]
        assert r["low"] == last.get(p, 0.0) < r["high"]
        last[p], area[p] = r["high"], area.get(p, 0.0) + shoelace([(r["ax"], r["ay"]), (r["bx"], r["by"]), (r["cx"], r["cy"])])
    assert set(last.values()) == {1.0}
    want = {"thin": shoelace(SHAPES["thin"][0]), "holed": 81 - 9 - 0.5, "bow": 8.0, "comb": shoelace(SHAPES["comb"][0]), "two": 2.5}
    assert set(area) - set(wild) == set(want) and all(area[k] == pytest.approx(v, rel=1e-6) for k, v in want.items())
    for k, rings in wild.items():
        xy = np.random.default_rng(1).uniform(-9, 9, (4000, 2))
        share = np.mean([even_odd(x, y, rings) for x, y in xy])
        assert area[k] / 324 == pytest.approx(share, abs=0.03)


def test_a_point_for_each_draw(spark):
    """No draw is lost, and the points lie evenly over the polygon: as many in each cell as its share of the area."""
    df = spark.createDataFrame(list(SHAPES.items()), "poly string, rings array<array<array<double>>>")
    names = list(SHAPES)
    draws = spark.range(16000).selectExpr("id AS draw", f"element_at(array({', '.join(repr(n) for n in [*names, 'gone'])}), int(id % {len(names) + 1}) + 1) AS poly")
    got = habitat.points_in_polygons(draws, df, "poly", 9).collect()
    assert len(got) == 16000
    for name in [*names, "gone"]:
        own = [(r["lon"], r["lat"]) for r in got if r["poly"] == name]
        if name in ("flat", "line", "none", "gone"):
            assert all(x is None and y is None for x, y in own)
            continue
        assert all(x is not None for x, _ in own) and all(even_odd(x, y, SHAPES[name]) for x, y in own) or name == "thin"
        if name == "holed":
            fine = [(i / 40, j / 40) for i in range(360) for j in range(360) if even_odd(i / 40 + 0.0125, j / 40 + 0.0125, SHAPES[name])]
            for cell in {(int(x) // 3, int(y) // 3) for x, y in fine}:
                share = np.mean([(int(x) // 3, int(y) // 3) == cell for x, y in fine])
                assert np.mean([(int(x) // 3, int(y) // 3) == cell for x, y in own]) == pytest.approx(share, abs=0.035)


def test_a_large_polygon_ships_the_edges_that_cells_cross(spark):
    """A hundred thousand edges: each goes to the cells that it crosses, and inner cells have none."""
    t = np.linspace(0, 2 * np.pi, 100_000, endpoint=False)
    r = 8 + 0.3 * np.sin(40 * t)
    ring = np.column_stack([r * np.cos(t), r * np.sin(t)]).tolist()
    df = spark.createDataFrame([(1, [ring])], "poly int, rings array<array<array<double>>>")
    cells = habitat.polygon_cells(df, cell=0.25).select("cx", "cy", "parity", F.size("edges").alias("n")).collect()
    assert sum(c["n"] for c in cells) < 1.1 * len(ring)
    assert sum(c["n"] == 0 for c in cells) > 2000 and all(c["parity"] == 1 for c in cells if c["n"] == 0)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.random.default_rng(2).uniform(-9, 9, (3000, 2)))]
    inner = {i for i, x, y in points if np.hypot(x, y) < 8 + 0.3 * np.sin(40 * np.arctan2(y, x))}
    assert {r["i"] for r in habitat.inside(spark.createDataFrame(points, "i int, lon double, lat double"), df, "i", cell=0.25).collect()} == inner


@pytest.mark.parametrize("radius, share", [(36, 0.0005), (36, 0.02), (0, 0.1), (90, 0.0002)])
def test_dilated_runs_against_brute_force(spark, radius, share):
    rng = np.random.default_rng(radius)
    mask = rng.random((300, 200)) < share
    cells = spark.createDataFrame([("h", None, int(r), int(c)) for r, c in np.argwhere(mask)], "habitat string, k string, grid_row int, grid_col int")
    runs = habitat.dilate_runs(habitat.runs_of(cells, ["habitat", "k"]), ["habitat", "k"], radius, 300, 200)
    want = np.zeros_like(mask)
    for r, c in np.argwhere(mask):
        want[max(r - radius, 0) : r + radius + 1, max(c - radius, 0) : c + radius + 1] = True
    got = np.zeros_like(mask)
    seen = {}
    for r in runs.collect():
        assert r["habitat"] == "h" and r["k"] is None and not got[r["grid_row"], max(r["col_first"] - 1, 0) : r["col_last"] + 2].any()  # the longest runs
        got[r["grid_row"], r["col_first"] : r["col_last"] + 1] = True
        seen[r["grid_row"]] = 1
    assert (got == want).all()


def test_set_algebra_of_runs(spark):
    rng = np.random.default_rng(5)
    one, two = (rng.random((20, 60)) < p for p in (0.4, 0.3))
    table = lambda mask: spark.createDataFrame([("k", int(r), int(c)) for r, c in np.argwhere(mask)], "k string, grid_row int, grid_col int")
    a, b = habitat.runs_of(table(one), ["k"]), habitat.runs_of(table(two), ["k"])
    loose = a.unionByName(a.select("k", "grid_row", "col_first", F.col("col_first").alias("col_last")))  # runs that overlap
    for work, want in ((habitat.union_runs, one | two), (habitat.difference_runs, one & ~two), (habitat.common_runs, one & two)):
        rows = habitat.cells_of(work(loose, b, ["k"]), ["k"]).collect()
        assert len(rows) == want.sum() and all(want[r["grid_row"], r["grid_col"]] for r in rows)
        plan = work(loose, b, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan
    assert habitat.union_runs(a.limit(0), a.limit(0), ["k"]).count() == 0


def test_quantiles_count_ties_first(spark, monkeypatch):
    """A value that nine of ten rows have is one row in the global order."""
    rows = spark.range(20_000).selectExpr("id % 2 AS k", "CASE WHEN id % 10 < 9 THEN 7.0D ELSE double(id % 97) END AS v")
    held = []
    monkeypatch.setattr(ranks, "running_total", lambda df, *a, own=ranks.running_total: held.append(df.count()) or own(df, *a))
    got = {r["k"]: (r["m"], r["t"]) for r in ranks.quantiles(rows, ["k"], "v", {"m": 0.5, "t": 0.97}).collect()}
    assert held[0] <= 2 * 98
    for k in (0, 1):
        own = [7.0 if i % 10 < 9 else float(i % 97) for i in range(20_000) if i % 2 == k]
        assert got[k] == pytest.approx(tuple(np.quantile(own, [0.5, 0.97])))


def test_clipped_rings_against_a_raster(spark):
    rng = np.random.default_rng(11)
    hull = lambda: [[float(6 * np.cos(t)), float(4 * np.sin(t))] for t in np.sort(rng.uniform(0, 2 * np.pi, 6))]
    star = lambda: [[float(r * np.cos(t) + 2), float(r * np.sin(t))] for t, r in zip(np.linspace(0, 6.2, 9), rng.uniform(1, 7, 9))]
    rows = [(i, star(), hull()[:: 1 if i % 2 else -1]) for i in range(6)] + [(6, [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]], [[1.0, 1.0], [1.0, 0.6], [2.0, 2.0]])]
    df = spark.createDataFrame(rows, "i int, ring array<array<double>>, window array<array<double>>")
    got = {r["i"]: r["a"] for r in df.select("i", F.abs(matching.ring_area(matching.clipped(F.col("ring"), F.col("window")))).alias("a")).collect()}
    grid = [(x, y) for x in np.arange(-6.95, 7, 0.1) for y in np.arange(-6.95, 7, 0.1)]
    for i, ring, window in rows[:6]:
        assert got[i] == pytest.approx(0.01 * sum(even_odd(x, y, [ring]) and even_odd(x, y, [window]) for x, y in grid), abs=0.6)
    assert got[6] == 0.0  # they meet in their boxes alone


def test_search_reports_each_pair_once(spark):
    """Areas over many cells: one row for each scene, with the share that it covers."""
    day = dt.date(2020, 1, 1)
    square = lambda x, y, n: [[x, y], [x + n, y], [x + n, y + n], [x, y + n]]
    aois = spark.createDataFrame([(1, square(0.0, 0.0, 10.0), day, day)], "a int, ring array<array<double>>, first_day date, last_day date")
    scenes = [(1, square(-1.0, -1.0, 12.0), day, 1.0, 0.0, 90.0), (2, square(5.0, 5.0, 10.0), day, 2.0, 0.0, 90.0), (3, square(10.0, 0.0, 5.0), day, 0.0, 0.0, 90.0), (4, square(0.0, 0.0, 10.0), day, 0.0, 0.0, 60.0)]
    df = spark.createDataFrame(scenes, "scene_id int, footprint array<array<double>>, acquired date, cloud_cover double, nodata_pct double, coverage_pct double")
    got = [(r["scene_id"], r["share_pct"], r["rank"]) for r in matching.catalogue_search(aois, df, "a", cell=1.0, coverage=75).orderBy("rank").collect()]
    assert got == [(1, 100.0, 1), (2, 25.0, 2)]  # 3 only touches, 4 has too little data
    assert [r["scene_id"] for r in matching.catalogue_search(aois, df, "a", cell=3.0, coverage=75, overlap=30).collect()] == [1]


def test_one_prefix_of_many_names(spark, monkeypatch):
    """A short name meets the best of the names that begin with it, not all of them."""
    right = spark.range(100_000).selectExpr("concat('reef ', lpad(id, 6, '0')) AS folder", "id % 7 AS files").unionByName(spark.createDataFrame([("reef x", 3), ("reef y", 1), ("ree", 9), ("", 1)], "folder string, files long"))
    left = spark.createDataFrame([("reef",), ("reef 000123 north",), ("r",), ("bay",), ("reef x",)], "site string")
    got = {r["site"]: (r["folder"], r["gap"]) for r in matching.fuzzy_names(left, right, "site", "folder", "files").collect()}
    assert got == {"reef": ("ree", 1), "reef 000123 north": ("reef 000123", 6), "r": ("ree", 2), "reef x": ("reef x", 0)}
    held = matching.fuzzy_names(left, right, "site", "folder", "files")._jdf.queryExecution().optimizedPlan().toString()
    assert held.index("Aggregate") < held.index("Join") or "Aggregate [__p" in held


def test_catalogue_search_clips_equal_outlines_once(spark):
    """Nine hundred pairs of two outlines: the cost is that of one, and the answers are those of a search for each."""
    square, day = [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]], dt.date(2020, 1, 1)
    aois = spark.createDataFrame([(a, square, day, dt.date(2020, 1, 9 + a % 3)) for a in range(30)], "a long, ring array<array<double>>, first_day date, last_day date")
    rows = [(s, [[1.0, 0.0], [5.0, 0.0], [5.0, 2.0], [1.0, 2.0]], dt.date(2020, 1, 1 + s % 20), float(s * 7 % 5), 0.0, 90.0) for s in range(30)]
    scenes = spark.createDataFrame(rows, "scene_id long, footprint array<array<double>>, acquired date, cloud_cover double, nodata_pct double, coverage_pct double")
    out = matching.catalogue_search(aois, scenes, "a", cell=1.0)
    want = {(a, r[0], 50.0, i + 1) for a in range(30) for i, r in enumerate(sorted((r for r in rows if r[2].day <= 9 + a % 3), key=lambda r: (r[3], r[2], r[0]))[:8])}
    assert {tuple(r) for r in out.select("a", "scene_id", "share_pct", "rank").collect()} == want
    stored = [p for p in out.inputFiles() if "/shares-" in p]
    assert stored and spark.read.parquet(*stored).count() == 1


def test_covered_share_against_the_columns(spark):
    rng = np.random.default_rng(5)
    ring = lambda n, r: [[float(r * np.cos(t)), float(r * np.sin(t))] for t in np.sort(rng.uniform(0, 2 * np.pi, n))]
    rows = [(ring(5, 3 + i % 2), ring(6, 3)[:: 1 if i % 2 else -1]) for i in range(40)]
    df = spark.createDataFrame(rows, "ring array<array<double>>, w array<array<double>>")
    area = lambda c: F.abs(matching.ring_area(c))
    got = df.select(matching.covered_pct("ring", "w"), area(matching.clipped(F.col("ring"), F.col("w"))) / area(F.col("ring")) * 100).collect()
    assert [r[0] for r in got] == [pytest.approx(r[1]) for r in got]
    assert spark.createDataFrame([([[0.0, 0.0], [1.0, 1.0]], rows[0][1])], df.schema).select(matching.covered_pct("ring", "w")).first()[0] is None


def test_triangles_of_many_polygons_in_one_file(spark):
    ring = lambda i: [[[0.0, 0.0], [1.0 + i, 0.0], [1.0 + i, 1.0], [0.0, 1.0]]]
    df = spark.createDataFrame([(f"p{i}", ring(i)) for i in range(2500)], "poly string, rings array<array<array<double>>>").coalesce(1)
    out = habitat.triangles(df, "poly")
    assert out.rdd.getNumPartitions() == 3
    got = out.groupBy("poly").agg(F.count("*").alias("c"), F.max("n").alias("n"), F.max("cx").alias("x"), F.max("high").alias("high")).collect()
    assert len(got) == 2500 and all(r["c"] == r["n"] == 2 and r["high"] == 1 for r in got)


def test_extents_count_places_before_they_meet_their_cluster(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("k"), (F.col("id") % 3 * 0.001).alias("lon"), F.when(F.col("id") % 3 == 0, 0.002).otherwise(0.0).alias("lat"))
    more = spark.createDataFrame([(1, 90.0, 0.0), (1, None, 0.0), (2, 5.0, 6.0)], "k int, lon double, lat double")
    out = collapse.extents(rows.unionByName(more), "k", "lon", "lat", 0.5, limit_m=5000)
    places = spark.read.parquet(*[p for p in out.inputFiles() if "/places-" in p])
    assert places.count() == 6 and places.agg(F.sum("__n")).first()[0] == 30_003
    got = {r["k"]: (r["west"], r["east"], r["lon"], r["lat"]) for r in out.collect()}
    assert got == {1: (-0.5, 0.502, 0.001, pytest.approx(0.002 / 3, abs=1e-12)), 2: (4.5, 5.5, 5.0, 6.0)}


def test_exact_means_of_counted_values(spark):
    rows = spark.createDataFrame([(0.1, 2_500_000_000), (0.4, 500_000_000), (None, 7)], "x double, n long")
    parts = exact.counted(rows, "n")
    assert parts.count() == 5 and parts.agg(exact.mean("x", "n")).first()[0] == pytest.approx(0.15, abs=1e-12)
    assert parts.where("x IS NULL").agg(exact.mean("x", "n")).first()[0] is None


def test_images_come_in_frames_of_one_size():
    import pandas as pd

    frames = list(raster.parts_of(iter([pd.DataFrame({"i": range(1000)}), pd.DataFrame({"i": []}), pd.DataFrame({"i": [1000]})])))
    assert max(map(len, frames)) <= raster.FRAME and [i for f in frames for i in f["i"]] == list(range(1001))
