"""Fill-in-the-middle, clustering and sharding against brute force, on the given tables and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from benthic_jobs.llm import centroids, fill_middle, queries, sharding  # noqa: E402
from benthic_jobs.llm.shared import word_ends  # noqa: E402
from compare import same  # noqa: E402

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, key string, salt int, at long, form string, slot long, shard int, record string, size long"


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def filled(doc_id, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = [int(sha(f"{seed}:{'' if doc_id is None else doc_id}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text), text
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), sha(out), sha(text), out


def odd_rows():
    r = random.Random(5)
    words = lambda n: " ".join("".join(r.choice("abcé<PSM>日😀") for _ in range(r.randint(1, 9))) for _ in range(n))
    rows = [(None, None), (None, "one two"), (None, "one two"), (0, ""), (1, " "), (2, "\t\n x"), (3, "x "), (4, "<P> a <S> b"), (5, "a <M"), (6, "<")]
    rows += [(7, "y" * 300_000), (8, "z " * 40_000), (9, "é" * 70_000 + " " + "w" * 70_000)]
    rows += [(i, words(r.randint(1, 60))) for i in range(10, 120)] + [(200, "same text here")] * 40 + [(i, "same text here") for i in range(201, 230)]
    rows += [(i, "< <P < S> <" + " <M" * (i % 7)) for i in range(300, 330)] + [(2**53 + 1, "big id"), (2**53 + 2, "big id")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "k", 1, 2, "f", 3, 4, "r", 5) for i, t in odd_rows()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_centroid_clustering", "op13_sharding"])
def test_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name], sf_dir)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\xa0é　", max_size=40))
def test_word_ends(text):
    ends, at = [], 0
    for unit in UNIT.findall(text):
        at += len(unit.encode())
        ends.append(at)
    assert word_ends(np.frombuffer(text.encode(), np.uint8)).tolist() == ends


@pytest.mark.parametrize("units, size", [(512, 1 << 16), (1, 1), (2, 3)])
def test_fill_middle_on_odd_rows(spark, odd, none, monkeypatch, units, size):
    """Pieces of any size give the same rows, also if they cut marks and characters."""
    docs = odd if units == 512 else odd.where("length(text) < 1000 OR text IS NULL")
    cells = sorted(map(repr, (filled(r["doc_id"], r["text"])[:7] for r in docs.collect())))
    monkeypatch.setattr(fill_middle, "UNITS", units)
    monkeypatch.setattr(fill_middle, "BYTES", size)
    forms = {r["form"] for r in fill_middle.planned(docs).select("form").distinct().collect()}
    assert forms == {"plain", "psm", "spm"}
    done = fill_middle.read_back(fill_middle.assembled(docs))
    assert done.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(repr(tuple(r)) for r in done.collect()) == cells
    assert fill_middle.read_back(fill_middle.assembled(none)).count() == 0


def test_fill_middle_texts(spark, odd):
    got = sorted(repr((r["doc_id"], r["form"], r["output"])) for r in fill_middle.texts(fill_middle.assembled(odd)).collect())
    assert got == sorted(repr((x[0], x[2], x[7])) for x in (filled(i, t) for i, t in odd_rows()))


def test_fill_middle_streams(spark, odd):
    """One shuffle: the documents stay where they are for the second sort, and a repeated row goes to several partitions."""
    plan = fill_middle.read_back(fill_middle.assembled(odd))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY") == 2 and plan.count("Sort [") == 2  # one of the two is the fixture's own
    pieces = fill_middle.pieces(odd)
    assert pieces.where("doc_id = 200 AND at = 0").select("salt").distinct().count() > 1
    assert pieces.agg(F.max(F.length("piece"))).first()[0] <= fill_middle.BYTES + 3


def test_fill_middle_ids_of_other_types(spark):
    docs = spark.createDataFrame([("a", "x y z"), ("7", "p q r"), (None, "t")], "doc_id string, text string")
    want = sorted(repr(filled(*x)[:7]) for x in [("a", "x y z"), ("7", "p q r"), (None, "t")])
    assert sorted(repr(tuple(r)) for r in fill_middle.read_back(fill_middle.assembled(docs)).collect()) == want


def lloyd(rows, dims, k, rounds, seed=3, scale=1024):
    """Whole numbers of any size, one vector at a time."""
    exact = lambda v: float(v).as_integer_ratio()[0] * scale // float(v).as_integer_ratio()[1]
    kept = [(i, [exact(v) for v in x], x) for i, x in rows if x is not None and len(x) == dims and all(v is not None and math.isfinite(v) for v in x)]
    first = sorted(kept, key=lambda r: (sha(f"{seed}:{'' if r[0] is None else r[0]}"), r[2]))[:k]
    cents = [r[1] for r in first]
    gap = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    place = lambda x: min((gap(x, c), j) for j, c in enumerate(cents))[::-1]
    for _ in range(rounds):
        at = [place(x)[0] for _, x, _ in kept]
        for j in range(len(cents)):
            own = [x for (_, x, _), p in zip(kept, at) if p == j]
            if own:
                cents[j] = [sum(c) // len(own) for c in zip(*own)]
    done = [(i, *place(x)) for i, x, _ in kept]
    sums = {j: sum(d for _, p, d in done if p == j) for j in range(len(cents))}
    long = lambda v: v if v < 2**63 else None
    lost = {j: any(d >= 2**63 for _, p, d in done if p == j) for j in sums}
    return sorted(
        repr((i, p, long(d), None if lost[p] else long(sums[p]), None if any(lost.values()) else long(sum(sums.values())), sha(",".join(map(str, cents[p]))))) for i, p, d in done
    )


def vectors(n, dims, seed, most=1.0):
    r = random.Random(seed)
    return [(i, [r.uniform(-most, most) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize(
    "rows, dims, k, width",
    [
        (vectors(60, 5, 1), 5, 4, 2),
        (vectors(3, 4, 2), 4, 8, 16),  # fewer vectors than centroids
        ([(i % 4, [1.0, 2.0, 3.0]) for i in range(30)] + vectors(10, 3, 3), 3, 5, 1),  # repeated rows, empty clusters
        (vectors(20, 6, 4, 1e6) + vectors(20, 6, 5), 6, 3, 4),  # too large for 64 bits beside small ones
        (vectors(6, 2, 6, 1e25) + vectors(6, 2, 7), 2, 2, 1),  # distances that no long holds
        ([(None, [0.5, 0.5]), (None, [0.25, -0.5]), (2**53 + 1, [0.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]), (5, [1.0]), (6, []), (7, [-1e-9, 1.0])], 2, 3, 1),
        ([(1, [0.0, 1.0, 2.0])], 2, 3, 1),  # nothing is kept
    ],
)
def test_clusters_against_brute_force(spark, monkeypatch, rows, dims, k, width):
    monkeypatch.setattr(centroids, "ROWS", 7)
    df = spark.createDataFrame([(i, x, 1, "c") for i, x in rows], "vec_id long, embedding array<double>, cluster int, chunk string").repartition(3)
    done = centroids.cluster(df, dims=dims, k=k, rounds=4, width=width)
    assert done.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(repr(tuple(r)) for r in done.collect()) == lloyd(rows, dims, k, 4)


def test_clusters_do_not_depend_on_the_deal(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    one = centroids.cluster(rows, rounds=3, width=64).collect()
    two = centroids.cluster(rows.repartition(7), rounds=3, width=7).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_no_shard_moves_in_a_round(spark, sf_dir):
    """Shards are dealt once: after that a round shuffles labels and distances, not vectors."""
    rdd = spark.sparkContext.parallelize([((b, c), np.ones((3, 2), np.int64)) for b in range(2) for c in range(5)]).partitionBy(4, centroids._dealt)
    labels = spark.sparkContext.parallelize([((b, c), np.zeros(3, np.int32)) for b in range(2) for c in range(5)]).partitionBy(4, centroids._dealt)
    both = rdd.union(labels)
    assert both.partitioner == rdd.partitioner and both.getNumPartitions() == 4
    assert both.groupByKey(4, centroids._dealt).getNumPartitions() == 4


def sharded(rows, shards, extra):
    md5 = lambda x: hashlib.md5(str("" if x is None else x).encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (md5(r[1]) + md5(r[0])))
    sizes = [len((t or "").encode()) + extra for _, t in rows]
    total, upto, out, slots = sum(sizes), 0, [], {}
    for (i, t), n in zip(rows, sizes):
        upto += n
        s = min(shards - 1, (2 * upto - n) * shards // (2 * total))
        out.append((i, n, zlib.crc32((t or "").encode()), "bytes", s, slots.get(s, 0), None))
        slots[s] = slots.get(s, 0) + 1
    return sorted(map(repr, out))


@pytest.mark.parametrize("shards, extra", [(24, 8), (3, 8), (1, 8), (200, 1)])
def test_shards_against_brute_force(spark, odd, shards, extra):
    path = sharding.write_shards(odd, shards=shards, extra=extra)
    back = sharding.read_shards(spark, path, odd)
    assert sorted(repr(tuple(r)) for r in sharding.digest(back, extra=extra).collect()) == sharded(odd_rows(), shards, extra)
    # Every column of every row comes back as it was, whatever its name.
    assert sorted(map(repr, back.select("record.*").collect())) == sorted(map(repr, odd.collect()))


def test_no_documents_no_shards(spark, none):
    path = sharding.write_shards(none)
    assert sharding.read_shards(spark, path, none).count() == 0


def test_texts_without_bytes(spark):
    docs = spark.createDataFrame([(i, None) for i in range(50)], "doc_id long, text string")
    got = sharding.digest(sharding.read_shards(spark, sharding.write_shards(docs, extra=0), docs), extra=0)
    assert got.count() == 50 and {r["size"] for r in got.collect()} == {0}


def test_hot_groups_are_divided(spark):
    """A third of all rows have one text, and one document is as large as many: no range holds more than twice its share but a key alone."""
    rows = [(i, "copy " * 20 if i % 3 == 0 else f"text {i} " * (1 + i % 17)) for i in range(6000)] + [(9999, "q" * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keys = docs.select(sharding.order_key(F.col("text"), F.col("doc_id")).alias("key"), sharding.size_of(F.col("text"), 8).alias("size"))
    for seed in (7, 8):
        boundaries, offsets = sharding.splitters(keys, ranges=40, seed=seed)
        share = -(-keys.agg(F.sum("size")).first()[0] // 40)
        sums = keys.groupBy(sharding.range_of(F.col("key"), boundaries).alias("r")).agg(F.sum("size").alias("b"), F.countDistinct("key").alias("k")).collect()
        assert all(r["b"] <= 2 * share or r["k"] == 1 for r in sums) and len(sums) == offsets.count() <= 120


def test_sizes_are_near_equal(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.digest(sharding.read_shards(spark, sharding.write_shards(docs, shards=8), docs))
    sizes = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert max(sizes) - min(sizes) <= got.agg(F.max("size")).first()[0] and len(sizes) == 8
