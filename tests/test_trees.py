"""Readers of folders: what they list, what they report, and that no task or folder of the driver holds the tree."""

import os

from pyspark.sql import functions as F

from benthic_jobs.sources import manifests, surveys, trees


def put(root, files):
    for path, text in files.items():
        at = root / path
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_bytes(text if isinstance(text, bytes) else text.encode())
    return root.as_uri()


def test_listing_equals_a_walk(spark, tmp_path):
    names = {f"a{i % 3}/b {i % 5}/c%20{i}.{'nc' if i % 2 else 'txt'}": "x" * i for i in range(150)}
    root = put(tmp_path, {**names, "top.nc": "", "_SUCCESS": "", ".hidden/x.nc": "", "a0/.part.crc": "1"})
    (tmp_path / "empty" / "inner").mkdir(parents=True)
    got = {r["path"]: (r["is_folder"], r["size"], r["problem"]) for r in trees.entries(spark, root).collect()}
    want = {p: (False, len(t), None) for p, t in {**names, "top.nc": ""}.items()}
    for at, folders, _ in os.walk(tmp_path):
        want.update({os.path.relpath(os.path.join(at, f), tmp_path): (True, None, None) for f in folders if ".hidden" not in f})
    assert got == want
    assert {r["path"] for r in trees.files(spark, root, "*.nc").collect()} == {p for p, (folder, *_) in want.items() if not folder and p.endswith(".nc")}


def test_round_trip_and_unreadable_files(spark, tmp_path):
    rows = [(f"d{i % 4}/ü {i}.txt", "zeile\r\n\0" * i) for i in range(60)] + [("d0/none.txt", None)]
    root = (tmp_path / "made").as_uri()
    assert trees.write_texts(spark.createDataFrame(rows, "path string, text string"), root) == 61
    assert trees.write_texts(spark.createDataFrame(rows, "path string, text string"), root) == 61  # again, as a task that is retried
    (tmp_path / "made" / "bad.txt").write_bytes(b"\xff\xfe")
    listing = trees.files(spark, root)
    (tmp_path / "made" / "d1" / "ü 1.txt").unlink()
    got = {r["path"]: (r["text"], r["problem"]) for r in trees.texts(listing, root).collect()}
    want = {p: (t or "", None) for p, t in rows}
    assert got == {**want, "bad.txt": (None, "UnicodeDecodeError"), "d1/ü 1.txt": (None, "FileNotFoundError")}


def test_empty_and_missing_roots(spark, tmp_path):
    import pytest
    from pyspark.errors import PySparkException

    assert trees.entries(spark, tmp_path.as_uri()).count() == 0
    assert trees.texts(trees.files(spark, tmp_path.as_uri()), tmp_path.as_uri()).count() == 0
    assert trees.write_texts(spark.createDataFrame([], "path string, text string"), tmp_path.as_uri()) == 0
    with pytest.raises(PySparkException):
        trees.entries(spark, (tmp_path / "not there").as_uri())


def test_one_folder_with_most_files_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    root = put(tmp_path, {f"hot/{i}.txt": "x" for i in range(400)} | {f"cold/{i}.txt": "x" for i in range(10)})
    monkeypatch.setattr(trees, "FILES", 50)
    parts = trees.texts(trees.files(spark, root), root).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 9 and max(r["count"] for r in parts) < 100 and sum(r["count"] for r in parts) == 410


def test_checkpoints_and_what_is_skipped(spark, tmp_path):
    good = '{"location_id": 1, "habitat_class": "coral", "depth_m": null, "more": [1]}'
    root = put(tmp_path, {
        "sample_1/sample_metadata.json": good, "sample_2/other.json": good, "sample_3/sample_metadata.json": good[:30], "sample_4/sample_metadata.json": "",
        "sample_5/sample_metadata.json": b"\xff", "sample_6/deep/sample_metadata.json": good, "other_7/sample_metadata.json": good, "sample_8": good,
    })
    (tmp_path / "sample_9").mkdir()
    rows, skipped = manifests.read_checkpoints(spark, root, "location_id long, habitat_class string, depth_m double", "location_id")
    assert [tuple(r) for r in rows.collect()] == [(1, "coral", None)]
    assert {tuple(r) for r in skipped.collect()} == {
        ("sample_2", "no file"), ("sample_3", "no JSON with a key"), ("sample_4", "no JSON with a key"), ("sample_5", "UnicodeDecodeError"), ("sample_6", "no file"), ("sample_9", "no file"),
    }


def test_transect_files(spark, tmp_path):
    record = '{"ID": %d, "Transect": " T1 ", "BaySegment": "x", "Observation": %s}'
    seen = '[{"Site": 5, "Depth": -150, "Species": " Halodule ", "EpiphyteDensity": "low"}, {"Site": null}]'
    root = put(tmp_path, {
        "2020/a.json": f"[{record % (1, seen)}, {record % (2, 'null')}]", "2021/b.json": record % (3, seen), "2021/c.json": "[]", "2021/d.json": "[{", "2021/e.json": "oops",
        "2021/f.txt": "oops", "2021/g.json": '[{"a": 1}]', "2021/h.json": "",
    })
    ends = spark.createDataFrame([("T1", 10.0, 0.0, 0.0, 1.0, 2.0), ("T2", 0.0, 0.0, 0.0, 1.0, 2.0)], "Transect string, length_m double, start_lon double, start_lat double, end_lon double, end_lat double")
    rows, bad = surveys.read_transects(spark, root, ends)
    got = sorted((r["ID"], r["Transect"], r["lon"], r["lat"], r["depth_m"], r["species"], r["epiphyte_density"]) for r in rows.collect())
    assert got == [(i, "T1", 0.5, 1.0, 1.5, "Halodule", "low") for i in (1, 3)]
    assert {r["path"] for r in bad.collect()} == {f"2021/{n}.json" for n in "degh"}


def test_scene_files(spark, tmp_path):
    names = ["S2A_MSI_2020_01_02.nc", "L9_OLI_2020-03-04.nc", "SENTINEL-2_2020_01_05.nc", "SENTINEL3_2020_01_05.nc", "S2A_2020_13_40.nc", "S2A_undated.nc", "S2A_2020_01_02.txt"]
    root = put(tmp_path, {f"x/y/{n}": "" for n in names})
    rows, bad = surveys.read_scene_index(spark, root)
    assert {(r["path"][4:], str(r["date"]), r["sensor"]) for r in rows.collect()} == {(names[0], "2020-01-02", "S2"), (names[1], "2020-03-04", "LS"), (names[2], "2020-01-05", "S2")}
    assert bad.count() == 0


def test_rows_of_one_file_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i % 7}/{i}", None if i % 2 else str(i)) for i in range(500)], "path string, text string").coalesce(1)
    assert trees._dealt(rows).rdd.getNumPartitions() >= 4
    assert trees.write_texts(rows, f"file://{tmp_path}") == 500
    assert {p.name: p.read_text() for p in tmp_path.glob("*/*") if not p.name.startswith(".")} == {str(i): "" if i % 2 else str(i) for i in range(500)}


def test_folders_are_listed_in_frames(tmp_path):
    from pyarrow import fs

    put(tmp_path, {f"t/{i}.nc": "x" * i for i in range(25)} | {"t/in/a": "", "real/b": ""})
    os.symlink(tmp_path / "real", tmp_path / "t" / "link")
    os.symlink(tmp_path / "none", tmp_path / "t" / "broken")
    store, seen = fs.LocalFileSystem(), lambda infos: sorted((i.path, str(i.type), i.size, i.mtime) for i in infos)
    frames = list(trees._found(store, f"{tmp_path}/t", 10))
    assert [len(f) <= 10 for f in frames] == [True] * 3
    assert seen(i for f in frames for i in f) == seen(store.get_file_info(fs.FileSelector(f"{tmp_path}/t")))


def test_few_folders_are_listed_by_many_tasks(spark, tmp_path, monkeypatch):
    root, tasks, stored = put(tmp_path, {f"{i}/{i}.nc": "" for i in range(20)}), [], trees.stored
    monkeypatch.setattr(trees, "stored", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or stored(df, name))
    assert trees.files(spark, root).count() == 20
    assert tasks[1] >= 4


def test_empty_files_take_few_inodes(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i % 7}/ü {i}.nc",) for i in range(2000)] + [("top.nc",)], "path string")
    for _ in range(2):  # again, as a task that is retried
        assert trees.write_empty(rows, tmp_path.as_uri()) == 2001
    found = [p for p in tmp_path.rglob("*") if p.is_file()]
    assert {p.relative_to(tmp_path).as_posix() for p in found} == {r["path"] for r in rows.collect()}
    assert {p.stat().st_size for p in found} == {0} and len({p.stat().st_ino for p in found}) < 100
    assert trees.files(spark, tmp_path.as_uri()).where("size = 0 AND problem IS NULL").count() == 2001


def test_a_file_takes_some_links_or_none(tmp_path, monkeypatch):
    import errno

    import pytest

    link = os.link
    for most, code, own in ((3, errno.EMLINK, 5), (0, errno.EPERM, 20)):

        def limited(file, at, most=most, code=code):
            if os.stat(file).st_nlink > most:
                raise OSError(code, os.strerror(code))
            link(file, at)

        monkeypatch.setattr(os, "link", limited)
        at, place = tmp_path / str(most), trees._linked()
        at.mkdir()
        for i in range(20):
            place(f"{at}/{i}")
        assert len(list(at.iterdir())) == 20 and len({p.stat().st_ino for p in at.iterdir()}) == own
        (at / "full").write_text("x")
        with pytest.raises(FileExistsError):
            place(f"{at}/full")
        assert (at / "full").read_text() == "x"


def test_scenes_of_the_query_take_few_inodes(spark, sf_dir, tmp_path, monkeypatch):
    from benthic_jobs.plans import q_sources

    monkeypatch.setattr(q_sources, "_new", lambda spark, name: f"{tmp_path.as_uri()}/{name}")
    assert q_sources.s04(spark, sf_dir).count() > 0
    scenes = [p.stat().st_ino for p in tmp_path.glob("scenes/*/*")]
    assert len(scenes) == spark.read.parquet(f"{sf_dir}/orders.parquet").count() and len(set(scenes)) < 100
