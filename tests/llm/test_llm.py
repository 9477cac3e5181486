"""The operators of the llm subpackage: SQL where there is one, else brute force, round trips and held-out accuracy."""

from __future__ import annotations

import gzip
import hashlib
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from benthic_jobs.llm import (  # noqa: E402
    audio_match, chat_format, decontaminate, html_extract, language_id, ngram_join, packing, quality, queries, substring_dedup, warc,
)
from benthic_jobs.llm.fm_index import FMIndex  # noqa: E402
from compare import same  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, hit_spans int, label string"


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Null, empty, wordless, repeated, very long and tied rows, with columns that clash with the operators' own."""
    text = words(120, 1)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "!!! ???"), (5, text), (5, text), (6, text), (None, text), (None, None), (7, "x" * 200_000),
        (8, words(30_000, 2)), (9, "la " * 20_000), (10, text + " tail"), (11, "é è ü " + words(40, 3)), (12, "one two"),
    ]
    return [(i, t, "en" if i and i % 2 else "fr" if i else None, None, None, "a", "b", 3, "c") for i, t in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


BIG = 2**53 + 1


@pytest.fixture(scope="module")
def large(spark):
    """Ids that no double holds beside null ones in one batch, and other columns that pandas would change."""
    rows = [(None, words(60, 1), float("nan"), None), (BIG, words(60, 1), None, BIG), (BIG + 2, words(60, 2), 1.5, BIG + 2), (BIG + 4, None, float("nan"), None)]
    return spark.createDataFrame(rows, "doc_id long, text string, share double, other long").coalesce(1)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name], sf_dir)


# 1. n-gram join


def brute_links(rows, k=5, threshold=0.8):
    sets = []
    for _, t in rows:
        w = (t or "").encode().translate(decontaminate.ALNUM).split()
        sets.append({tuple(w[i : i + min(k, len(w))]) for i in range(max(1, len(w) - k + 1))} if w else set())
    links = {i: {j for j in range(len(sets)) if j != i and sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-12} for i in range(len(sets))}
    label = list(range(len(sets)))
    while True:
        new = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(sets))]
        if new == label:
            return links, label
        label = new


@pytest.mark.parametrize("limit", [3, 400])
def test_near_duplicates_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(ngram_join, "LIMIT", limit)  # small: buckets are split again and compared in blocks
    r, rows = random.Random(5), []
    base = [words(80, s).split() for s in range(6)]
    for i in range(90):
        w = list(base[i % 6])
        for _ in range(r.choice((0, 1, 1, 2, 4, 9))):
            w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    links, label = brute_links(rows)
    got = {x["doc_id"]: x for x in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i]["n_links"] for i in got} == {i: len(links[i]) for i in links}
    assert {i: got[i]["class_id"] for i in got} == dict(enumerate(label))


def alike(n, share, seed, own=60):
    """``n`` texts of ``own`` words with a passage of about the given share of their shingles in common."""
    passage = words(round(own * share), seed).split()
    return [passage + words(own - len(passage), seed * 1000 + i).split() for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_crowded_buckets_go_deeper_without_losing_links(spark, monkeypatch, levels):
    monkeypatch.setattr(ngram_join, "LIMIT", 8)
    monkeypatch.setattr(ngram_join, "DEEP", levels)
    r, texts = random.Random(levels), alike(150, 0.5, 3)
    for i in range(0, 150, 5):  # near copies of some, among many that share half of their shingles
        w = list(texts[i])
        w[-1 - i % 3] = f"new{i}"
        texts.append(w)
    texts += [texts[0][:-1] + [f"t{r.random()}"] for _ in range(30)]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    links, label = brute_links(rows)
    got = {x["doc_id"]: x for x in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i]["n_links"] for i in got} == {i: len(links[i]) for i in links}
    assert {i: got[i]["class_id"] for i in got} == dict(enumerate(label))


def test_sets_of_a_crowded_bucket_are_shipped_a_bounded_number_of_times(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIMIT", 10)
    shipped = {}
    deal = ngram_join._dealt

    def counting(members):
        dealt = deal(members)
        shipped[size] = dealt.count()
        return dealt

    monkeypatch.setattr(ngram_join, "_dealt", counting)
    for size in (300, 1200):
        rows = [(i, " ".join(w)) for i, w in enumerate(alike(size, 0.45, 7))]
        assert ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).where("n_links > 0").count() == 0
    assert shipped[1200] < 6 * max(shipped[300], 1)  # four times the sets; pairs of blocks would be sixteen times as many


def test_near_duplicates_of_odd_rows(odd, none):
    rows = ngram_join.near_duplicates(odd).collect()
    assert len(rows) == len(odd_rows())
    got = {r["doc_id"]: r for r in rows}
    assert got[2]["n_links"] == 0 and got[2]["class_id"] == 2 and got[6]["n_links"] == 4 and got[10]["class_id"] == got[6]["class_id"]
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == 11 and {1, 2, 3, 4, 7, 8, 9, 11, 12} <= set(ids)
    assert ngram_join.near_duplicates(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "set long, to long")
    got = {r["node"]: r["label"] for r in ngram_join.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_near_duplicates_keep_large_ids(large):
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.near_duplicates(large).collect()), key=str)
    assert got == sorted([(None, BIG, 1), (BIG, BIG, 1), (BIG + 2, BIG + 2, 0), (BIG + 4, BIG + 4, 0)], key=str)
    named = ngram_join.near_duplicates(large.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))))
    assert {r["class_id"] for r in named.collect()} == {f"d{BIG}", f"d{BIG + 2}", f"d{BIG + 4}"}


def test_near_duplicates_of_words_with_structure(spark):
    one, other = morse_words()
    rows = [(1, " ".join([one] * 30)), (2, " ".join([other] * 30)), (3, f"{one} {other}"), (4, f"{other} {one}")]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 2: 2, 3: 3, 4: 4}


# 2. decontamination


def test_contamination_in_blocks_and_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [("a", words(120, 1)), ("a", words(120, 1)), ("b", "One, TWO"), ("c", None), ("d", ""), (None, "one two"), ("e", "zz top nothing")],
        "item_id string, text string",
    )
    whole = decontaminate.find_contamination(odd, items)
    want = {tuple(map(str, r)) for r in decontaminate.digest(whole).collect()}
    got = {tuple(map(str, r)) for r in decontaminate.digest(decontaminate.find_contamination(odd, items, block=20)).collect()}
    assert got == want and whole.count() == len(odd_rows())
    by_id = {r["doc_id"]: r for r in whole.collect()}
    assert by_id[10]["hit_spans"] == [[0, 120]] and by_id[10]["hit_items"] == ["a"] and by_id[12]["hit_items"] == ["b"] and by_id[1]["hit_spans"] == []
    assert decontaminate.find_contamination(none, items).count() == 0
    assert decontaminate.find_contamination(odd, items.limit(0)).where(F.size("hit_spans") > 0).count() == 0


def test_contamination_by_items_without_an_id(spark):
    docs = spark.createDataFrame([(1, "say zero one two now"), (2, "other words"), (3, "one two and six")], "doc_id long, text string")
    for more in ([], [("b", "six"), ("c", "one two")]):
        items = spark.createDataFrame([(None, "one two"), (None, "zero one"), *more], "item_id string, text string")
        for block in (1, 200_000):
            got = {r["doc_id"]: r for r in decontaminate.find_contamination(docs, items, block=block).collect()}
            assert [got[i]["hit_spans"] for i in (1, 2, 3)] == [[[1, 4]], [], [[0, 2], [3, 4]] if more else [[0, 2]]]
            assert [got[i]["hit_items"] for i in (1, 2, 3)] == ([["c"], [], ["b", "c"]] if more else [[], [], []])
    told = decontaminate.digest(decontaminate.find_contamination(docs, items.limit(2))).orderBy("doc_id").collect()
    assert [(r["n_hit"], r["n_items"], r["contaminated"]) for r in told] == [(3, 0, True), (0, 0, False), (2, 0, True)]


def morse_words(n=1024):
    """Two words whose polynomials are equal modulo 2 ** 64 whatever the base."""
    one, swap = "a", str.maketrans("ab", "ba")
    while len(one) < n:
        one += one.translate(swap)
    return one, one.translate(swap)


def test_contamination_by_words_with_structure(spark):
    one, other = morse_words()
    docs = spark.createDataFrame([(1, f"x {one} y"), (2, f"x {other} y"), (3, "one two three")], "doc_id long, text string")
    items = spark.createDataFrame([("a", f"X {one.upper()}"), ("b", "one two three")], "item_id string, text string")
    for block in (1, 200_000):
        got = {r["doc_id"]: r["hit_spans"] for r in decontaminate.find_contamination(docs, items, block=block).collect()}
        assert got == {1: [[0, 2]], 2: [], 3: [[0, 3]]}


def test_contamination_changes_no_other_column(spark, large):
    items = spark.createDataFrame([(BIG, words(60, 1)), (None, "none")], "item_id long, text string").coalesce(1)
    for block in (1, 200_000):
        found = decontaminate.find_contamination(large, items, block=block)
        assert sorted(map(repr, found.select(*large.columns).collect())) == sorted(map(repr, large.collect()))
        assert {r["doc_id"]: r["hit_items"] for r in found.collect()} == {None: [str(BIG)], BIG: [str(BIG)], BIG + 2: [], BIG + 4: []}


def test_contamination_of_the_tables_in_both_forms(spark, sf_dir):
    docs, items = queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "benchmark")
    few, many = (decontaminate.digest(decontaminate.find_contamination(docs, items, block=n)) for n in (200_000, 1))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect())) and few.where("contaminated").count() > 0


def test_contamination_by_a_passage_that_all_documents_hold(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "HOT", 20)
    held = "this page is shown to all who ask"
    texts = [f"{words(i % 7, i)} {held} {words(i % 5, i + 9)} {held}" for i in range(150)] + ["none of it", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(f"i{i}", f"{held} {w}") for i, w in enumerate(words(30, 3).split())] + [("all", held)], "item_id string, text string")
    got, want = (sorted(map(repr, decontaminate.find_contamination(docs, items, block=n).collect())) for n in (1, 200_000))
    assert got == want and sum("'all'" in r for r in got) == 150
    met = spark.range(1000).selectExpr("unhex(sha2(cast(id as string), 256)) as key", "cast(id as int) as pos", "if(id < 900, 7, id) as shingle")
    chosen = spark.createDataFrame([(7, "a"), (7, "b"), (950, "c")], "shingle long, text string")
    rows, windows = decontaminate._dealt(met, chosen)
    assert rows.groupBy("shingle", "part").count().agg(F.max("count")).first()[0] < 60 and rows.count() == 1000
    assert rows.join(windows, ["shingle", "part"]).count() == rows.select("key", "shingle").join(chosen, "shingle").count() == 1801


# 3. WARC


def test_warc_of_odd_pages(spark):
    rows = [(5, "http://a/\r\nx", "<p>é</p>"), (3, None, "<p>é</p>"), (7, "u", None), (8, "u", ""), (9, "u", "z" * 3_000_000), (9, "u", "other"), (None, "u", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    index = warc.write_archives(pages)
    records = warc.read_records(index)
    got = sorted((tuple(r) for r in warc.digest(records).collect()), key=str)
    size = {(r[0], r[3]): (r[1], r[4]) for r in got}
    assert len(got) == 7 and size[None, "response"] == (1, None) and size[5, "revisit"] == (9, 3) and size[3, "response"] == (9, None) and size[8, "revisit"] == (0, 7)
    chosen = warc.read_records(index.where("key = 9")).collect()
    assert sorted(len(r["payload"]) for r in chosen) == [5, 3_000_000]
    assert all(r["digest"] == warc.sha1_base32(bytes(r["payload"])) for r in records.collect() if r["record_type"] == "response")
    least = warc.write_archives(pages, least=10)
    assert least.where("record_type = 'revisit'").count() == 0
    assert warc.digest(warc.read_records(warc.write_archives(pages.limit(0)))).count() == 0


def test_warc_of_keys_with_several_payloads(spark):
    rows = [(3, "A"), (9, "A"), (9, "B"), (9, "B"), (3, "CC"), (9, "CC"), (None, "A"), (None, "D"), (4, "D"), (5, "D")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("u"))
    sha = {x: warc.sha1_base32(x.encode()) for x in ("A", "B", "CC", "D")}
    want = [(3, "response", None, "A"), (9, "revisit", 3, "A"), (9, "response", None, "B"), (9, "response", None, "B")]
    want += [(3, "response", None, "CC"), (9, "revisit", 3, "CC"), (4, "response", None, "D"), (5, "revisit", 4, "D")]
    want += [(None, "revisit", 3, "A"), (None, "revisit", 4, "D")]
    got = [(r[0], r[3], r[4], r[1], r[2]) for r in warc.digest(warc.read_records(warc.write_archives(pages))).collect()]
    assert sorted(got, key=str) == sorted(((k, t, to, len(x), sha[x]) for k, t, to, x in want), key=str)


def test_warc_of_large_and_repeated_keys(spark):
    rows = [(BIG, "A"), (BIG + 2, "A"), (BIG + 4, "B"), (1, "C"), (2, "D"), (5, "C"), (5, "D"), (None, "E"), (None, "E"), (None, "C")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({"url": F.lit("u"), "key": F.lit(1), "body": F.lit("x")}).coalesce(1)
    got = [(r[0], r[3], r[4], r[2]) for r in warc.digest(warc.read_records(warc.write_archives(pages))).collect()]
    sha = {x: warc.sha1_base32(x.encode()) for x in "ABCDE"}
    want = [(BIG, "response", None, "A"), (BIG + 2, "revisit", BIG, "A"), (BIG + 4, "response", None, "B"), (1, "response", None, "C")]
    want += [(2, "response", None, "D"), (5, "revisit", 1, "C"), (5, "revisit", 2, "D"), (None, "response", None, "E")]
    want += [(None, "response", None, "E"), (None, "revisit", 1, "C")]
    assert sorted(got, key=str) == sorted(((k, t, to, sha[x]) for k, t, to, x in want), key=str)


def test_warc_reference_without_its_response_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "A"), (2, "u", "A")], "page_id long, url string, html string")
    index = warc.write_archives(pages)
    with pytest.raises(Exception, match="no response for the reference to 1"):
        warc.digest(warc.read_records(index.where("key = 2"))).collect()


def test_warc_frames_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 1000)
    pages = spark.createDataFrame([(i, "u", f"{i} " * 150) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    got = warc.digest(warc.read_records(warc.write_archives(pages))).collect()
    assert {r["page_id"]: r["payload_bytes"] for r in got} == {i: 150 * len(f"{i} ") for i in range(60)}


def test_archives_are_whole_gzip_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>") for i in range(10)], "page_id long, url string, html string").coalesce(1)
    index = warc.write_archives(pages, path=f"file://{tmp_path}").collect()
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("*.warc.gz"))
    assert raw.count(b"WARC/1.1\r\n") == 10 == len(index)


# 4. language


def test_language_is_learned(spark, sf_dir):
    got = queries.op4_language_id(spark, sf_dir).join(queries.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.93 * got.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(odd, none):
    model = language_id.fit(odd, train=F.lit(True), rounds=5)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.tagged(odd, model).collect()}
    assert got[1] == got[2] == got[3] == got[4] == ("und", 0.0) and got[8][0] in ("en", "fr") and 0 < got[7][1] <= 1
    assert language_id.fit(none, train=F.lit(True)) is None
    assert language_id.tagged(odd, None).where("lang_pred <> 'und'").count() == 0
    assert language_id.tagged(none, model).count() == 0
    clash = odd.withColumns({"__FOUND": F.lit("f"), "__p": F.lit("p"), "Score": F.lit("s")})
    told = language_id.tagged(clash, model)
    assert {c.lower() for c in told.columns} == {c.lower() for c in clash.columns} | {"lang_pred"}
    assert {(r["__FOUND"], r["__p"]) for r in told.collect()} == {("f", "p")} and dict(told.dtypes).get("score", dict(told.dtypes).get("Score")) == "double"


@pytest.mark.parametrize(("text", "want"), [
    (None, False), ("", False), ("12 _ -", False), ("½ ² ①", False), ("\u2160 \u0e51", False), ("½ a", True), ("é", True), ("ª", True), ("日", True), ("_x", True),
])
def test_letters(text, want):
    assert language_id.has_letter(text) == want


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    g, x = language_id.Gru(rng, 4), rng.integers(1, 5, (6, 3)).astype(np.uint8)
    g.byte, g.state = g.byte.astype(float), g.state.astype(float)
    weight = rng.normal(size=(6, 4, 3))
    _, kept = g.run(x, True)
    slopes = g.back(x, kept, weight)
    for name, slope in zip(("byte", "state"), slopes):
        w = getattr(g, name)
        for i, j in ((0, 1), (5, 2), (9, 3)):
            old, ends = w[i, j], []
            for e in (1e-3, -1e-3):
                w[i, j] = old + e
                ends.append(float((g.run(x)[0] * weight).sum()))
            w[i, j] = old
            assert slope[i, j] == pytest.approx((ends[0] - ends[1]) / 2e-3, abs=2e-3)


def test_every_position_is_pooled_once():
    model = language_id.ByteTagger(["a", "b"])
    text = words(400, 9).encode()
    pooled = model.pooled([text, b"", text[:100]])
    assert pooled[0].sum() == pytest.approx(1, abs=1e-4) and pooled[1].sum() == 0 and pooled[2].sum() == pytest.approx(1, abs=1e-4)


# 5. chat


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.text(alphabet="a<>|[]/\\IS NTims_endtrp\n", max_size=30)), max_size=5))
def test_turns_round_trip(turns):
    text = "".join(f"{chat_format.BEGIN}{chat_format.escape(r)}{chat_format.SEP}{chat_format.escape(t)}{chat_format.END}" for r, t in turns)
    assert chat_format.parse_turns(text) == turns


def test_layouts(spark):
    rows = [
        (1, '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": null}]}', [("user", "a"), ("assistant", "")]),
        (2, '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}', [("user", "a"), ("assistant", "b")]),
        (3, '{"prompt": "p", "response": "r"}', [("user", "p"), ("assistant", "r")]),
        (4, '{"instruction": "i", "input": "x", "output": "o", "system": "s"}', [("system", "s"), ("user", "i"), ("user", "x"), ("assistant", "o")]),
        (5, '{"question": "q", "answer": "a"}', [("user", "q"), ("assistant", "a")]),
        (6, '{"other": 1}', None), (7, "broken", None), (8, None, None), (9, '{"messages": []}', []),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "conv_id long, record string")
    canonical = chat_format.canonical_turns(df)
    got = {r["conv_id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in canonical.collect()}
    assert {r[0]: got[r[0]] or None for r in rows} == {r[0]: r[2] or None for r in rows}
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(canonical)).collect()}
    assert back[6]["n_turns"] == 0 and back[2]["loss_sha256"] == hashlib.sha256(b"b").hexdigest()


def test_odd_conversations(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 3, "assistant", "</s>\\<|im_end|>"), (2, 0, "assistant", "y" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(chat_format.canonical_turns(chat_format.from_rows(df)))).collect()}
    assert got[1]["n_turns"] == 3 and got[2]["loss_chars"] == 300_000 and got[None]["loss_sha256"] == hashlib.sha256(rows[3][3].encode()).hexdigest()


def test_conversations_keep_large_ids_and_hide_other_columns(spark):
    rows = [(None, 0, "user", "a"), (BIG, 0, "user", "<start_of_turn>user<end_of_turn><bos><<SYS>><</SYS>>"), (BIG, 1, "assistant", "b"), (BIG + 2, 0, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1)
    df = df.withColumns({"record": F.lit(1), "turns": F.lit("x"), "formatted": F.lit(2), "loss_spans": F.lit(None).cast("string"), "m": F.lit(0)})
    formatted = chat_format.format_turns(chat_format.canonical_turns(chat_format.from_rows(df)))
    got = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in got.items()} == {None: (1, 0), BIG: (2, 1), BIG + 2: (1, 1)}
    text = formatted.where(F.col("conv_id") == BIG).first()["formatted"]
    assert not any(x in text for x in ("<start_of_turn>", "<end_of_turn>", "<bos>", "<<SYS>>", "<</SYS>>")) and chat_format.parse_turns(text)[0][1] == rows[1][3]


def test_very_long_texts_are_whole(spark):
    n = 20_500_000  # over the JSON parser's own limit
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "y" * n), (2, 0, "assistant", "z" * n)]  # a prompt record and a list of messages
    records = chat_format.from_rows(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(chat_format.canonical_turns(records))).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in got.items()} == {1: (2, n), 2: (1, n)}


def test_known_layout_that_cannot_be_read_is_an_error(spark):
    df = spark.createDataFrame([(1, '{"messages": "x"}')], "conv_id long, record string")
    with pytest.raises(Exception, match="cannot be read"):
        chat_format.canonical_turns(df).collect()
    fine = spark.createDataFrame([(1, '{"messages": null}'), (2, '{"prompt": %s, "response": null}' % ("1" * 3000))], "conv_id long, record string")
    got = {r["conv_id"]: r["turns"] for r in chat_format.canonical_turns(fine).collect()}
    assert got[1] is None and got[2] == [("user", "1" * 3000)]


# 6. quality


def test_quality_held_out(spark, sf_dir):
    got = queries.op6_quality(spark, sf_dir).join(queries.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").where("held_out")
    assert got.where("quality = predicted").count() >= 0.9 * got.count()


def test_rules_compile_to_the_same_scores(spark, sf_dir):
    docs = quality.with_statistics(queries.table(spark, sf_dir, "documents").select("doc_id", "text"))
    model = quality.fit(queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "labels"))
    rows = docs.withColumn("score", model.column()).collect()
    x = np.array([r["stats"] for r in rows])
    total = model.bias + sum(w * quality.holds(rule, x) for rule, w in model.rules)
    assert np.allclose([r["score"] for r in rows], 1 / (1 + np.exp(-total))) and 0 < len(model.rules) < 200


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (8, 0, None), (9, None, 1), (None, 1, 1), (11, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels)
    scored = quality.scored(odd, model)
    assert scored.where("score is null or score < 0 or score > 1").count() == 0 and scored.count() == len(odd_rows())
    for few in (labels.limit(0), labels.where("quality = 1 and doc_id = 11")):
        assert 0 <= quality.scored(odd, quality.fit(odd, few)).first()["score"] <= 1
    assert quality.keep_good(odd, labels).columns == odd.columns and quality.keep_good(none, labels).count() == 0


def test_good_documents_keep_their_columns(spark, odd, large, sf_dir):
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    clash = odd.withColumns({"stats": F.lit("s"), "score": F.lit("t"), "label": F.lit("u")})
    assert quality.keep_good(clash, labels).schema == clash.schema and {r["stats"] for r in quality.keep_good(clash, labels).collect()} == {"s"}
    busy = odd.withColumns({"__Stats": F.lit("x"), "__stats_": F.lit("y")})
    for out in (quality.keep_good(busy, labels), quality.scored(busy, model).drop("score")):
        assert out.columns == busy.columns and {(r["__Stats"], r["__stats_"]) for r in out.collect()} == {("x", "y")}
    kept = quality.keep_good(large, labels.limit(0))
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, large.collect()))


def test_lasso_drops_noise():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 2, (4000, 12)).astype(float)
    y = (rng.random(4000) < 1 / (1 + np.exp(1.5 - 3 * z[:, 0]))).astype(float)
    _, w = quality.lasso_logistic(z, y, penalty=0.01)
    assert w[0] > 1.5 and (np.abs(w[1:]) < 0.05).all() and (w[1:] == 0).sum() >= 6


# 7. packing


def test_packing_is_gapless_and_whole(spark, sf_dir):
    got = queries.op7_packing(spark, sf_dir).collect()
    check_packing(got)
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1] for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in got:
        piece = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(piece) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))
    assert len({r["sequence_id"] for r in got}) <= 1.03 * sum(map(len, ids.values())) / 2048 + 2


def check_packing(rows, most=2048):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= most


def test_packing_of_odd_rows(odd, none, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 2)
    rows = packing.pack(odd, keep_ids=True)
    got = rows.collect()
    check_packing(got)
    assert sum(r["doc_id"] in (1, 2) and r["length"] == 1 for r in got) == 2 and len([r for r in got if r["doc_id"] == 5 and r["start"] == 0]) == 2
    lengths = [len(r["input_ids"]) for r in packing.sequences(rows).collect()]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths)
    assert packing.pack(none).count() == 0


def test_tokens_are_those_of_the_named_library(spark):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(4)
    texts = ["<|endoftext|> x", "a<|endoftext|><|endoftext|>", "\n" * 1_000_000, " " * 1_500_000, "a" + " \t" * 100_000 + "b", "x" + " " * 3999 + "y", " " * 4000 + "z"]
    texts += ["".join(r.choice(("a", "Zé", " ", "  ", "\n", "\u00a0", "\u2003", "\x85", "'s", "12", "½", "日本", "!?", "<|endoftext|", "\u200d", "😀")) for _ in range(200)) for _ in range(60)]
    texts += ["!" * 300_000, "x" * 300_000, "1" * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = packing.tokenised(df, keep_ids=True).orderBy("doc_id", "start").collect()
    for i, t in enumerate(texts):
        ids = np.frombuffer(b"".join(bytes(x["ids"]) for x in got if x["doc_id"] == i), "<u4").tolist()
        assert ids == [*tokenizer.encode(t, add_special_tokens=False).ids, 1], repr(t[:30])


def test_packing_keeps_large_ids(large):
    got = packing.pack(large).collect()
    check_packing(got)
    assert sorted((r["doc_id"] for r in got), key=str) == sorted([None, BIG, BIG + 2, BIG + 4], key=str)


@pytest.mark.parametrize("group", [1, 7, 1000])
def test_placement_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    r = random.Random(9)
    rows = [(i, 0, r.choice((2048, 2048, 3, 700, 701, 1024, r.randint(1, 2048))), i % 5, 0) for i in range(300)] + [(7, 0, 3, 2, 0)] * 9
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    got = packing.packed(pieces).collect()
    check_packing(got)
    assert sorted((x["doc_id"], x["length"]) for x in got) == sorted((x[0], x[2]) for x in rows)
    demand = {}
    for x in rows:
        demand[-(-x[2] // packing.GRAIN)] = demand.get(-(-x[2] // packing.GRAIN), 0) + 1
    used = len({x["sequence_id"] for x in got})
    assert used <= sum(n for _, n in packing.plan_patterns(demand, 2048 // packing.GRAIN)) and used >= sum(x[2] for x in rows) / 2048


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.choice(np.arange(5, 200), 40, replace=False))
    demand = rng.integers(1, 500, 40).astype(float)
    plan = packing.column_generation(sizes, demand, 256)
    used = sum(a for _, a in plan)
    assert used <= (sizes * demand).sum() / 256 * 1.02 + 40
    assert (sum(p * a for p, a in plan) >= demand - 1e-6).all() and all((p * sizes).sum() <= 256 for p, _ in plan)
    whole = packing.plan_patterns({int(s): int(n) for s, n in zip(sizes, demand)}, 256)
    assert all(sum(p.get(int(s), 0) * t for p, t in whole) >= n for s, n in zip(sizes, demand))


# 8. substrings


def brute_repeats(texts, window):
    seen = {}
    lists = [(t or "").encode().split() for t in texts]
    for w in lists:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append(b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("hot", [0, 5000])
def test_repeats_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)  # 0: every segment is dealt out window by window
    r, shared = random.Random(2), [words(n, 50 + n) for n in (34, 35, 36, 70, 300)]
    texts = [" ".join(r.choice((words(r.randint(0, 60), i * 7 + j), r.choice(shared))) for j in range(4)) for i in range(40)]
    texts += ["a b " * 60, "a b " * 25, "z " * 54, "q " * 35, "", None, " x " * 80, words(50, 1), words(50, 1) + " more"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [x["kept_text"] for x in substring_dedup.remove_repeats(df).orderBy("doc_id").collect()]
    assert got == brute_repeats(texts, 35)


def test_repeats_of_odd_rows(odd, none):
    rows = odd.collect()
    got = substring_dedup.remove_repeats(odd)
    want = dict(zip(((r["doc_id"], r["text"]) for r in rows), brute_repeats([r["text"] for r in rows], 35)))
    assert all(want[r["doc_id"], r["text"]] == r["kept_text"] for r in got.collect()) and got.count() == len(rows)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_repeats_of_words_with_structure_and_other_columns(spark, large):
    one, other = morse_words()
    rows = [(1, f"{one} " + words(40, 3)), (2, f"{other} " + words(34, 3)), (3, " ".join([one] * 35)), (4, " ".join([other] * 35))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"anchor": F.lit(1.5), "n_words": F.lit("x"), "r": F.lit(None).cast("long")})
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup.remove_repeats(df).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == brute_repeats([t for _, t in rows], 35)
    done = substring_dedup.remove_repeats(large)
    assert sorted(map(repr, done.select(*large.columns).collect())) == sorted(map(repr, large.collect()))
    assert {(r["doc_id"], r["n_removed"]) for r in done.collect()} == {(None, 60), (BIG, 60), (BIG + 2, 0), (BIG + 4, 0)}


def test_weights_of_the_fm_index():
    rng = np.random.default_rng(1)
    symbols = np.concatenate([np.append(rng.integers(1, 3, 12), 0) for _ in range(8)])
    text_of, weights = np.repeat(np.arange(8), 13), np.array([1, 1, 3, 1, 2, 1, 1, 5])
    index, text = FMIndex(symbols, text_of, weights, 6), "".join(map(str, symbols))
    for least in (2, 5, 9):
        for end, length in zip(range(6, 100), index.matching(symbols, np.arange(6, 100), 6, least)):
            best = 0
            for k in range(1, 7):
                p = text[end - k : end]
                if "0" in p or sum(weights[text_of[i]] for i in range(len(text)) if text.startswith(p, i)) < least:
                    break
                best = k
            assert best == length


def test_fm_index_against_counting():
    rng = np.random.default_rng(0)
    symbols = np.concatenate([np.append(rng.integers(1, 4, 60), 0) for _ in range(20)])
    index = FMIndex(symbols, np.repeat(np.arange(20), 61), np.ones(20, int), 8)
    text, ends = "".join(map(str, symbols)), np.arange(8, 400)
    for end, length in zip(ends, index.matching(symbols, ends, 8, 2)):
        best = 0
        for k in range(1, 9):
            p = text[end - k : end]
            if "0" in p or sum(text.startswith(p, i) for i in range(len(text))) < 2:
                break
            best = k
        assert best == length


# 9. audio


def test_audio_against_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(audio_match, "BLOCK", 3)
    sound = audio_match.sonified(queries.table(spark, sf_dir, "embeddings"))
    prints = {r["recording_id"]: np.frombuffer(bytes(r["fingerprint"]), np.uint32) for r in audio_match.fingerprints(sound).collect()}
    for r in audio_match.search(audio_match.fingerprints(sound), F.col("recording_id") % 20 == 0).collect():
        got = []
        for q in prints:
            found = audio_match.align(prints[q], prints[r["recording_id"]]) if q % 20 == 0 else None
            if found and found[2] <= 0.2:
                got.append((found[2], q, found[0]))
        assert r["n_matches"] == len([g for g in got if g[1] != r["recording_id"]])
        best = min(got) if got else (None, None, None)
        assert (r["best_id"], r["best_offset"]) == best[1:]


def test_shifted_and_noisy_sound_aligns():
    rng = np.random.default_rng(6)
    t = np.arange(40_000) / audio_match.RATE
    song = sum(np.sin(2 * np.pi * f * t + 3 * np.sin(2 * np.pi * 0.7 * t * k)) for k, f in enumerate((220, 330, 440), 1)) * 4000
    late = np.concatenate([np.zeros(8 * audio_match.HOP), song])[:40_000] + rng.normal(0, 60, 40_000)
    a, b = audio_match.fingerprint(song.astype("<i2")), audio_match.fingerprint(late.astype("<i2"))
    offset, votes, errors = audio_match.align(a, b)
    assert offset == 8 and errors < 0.2 and votes > 10


def test_recall_against_bit_errors_at_all_offsets(spark, sf_dir):
    rng, rows = np.random.default_rng(4), []
    for i, r in enumerate(audio_match.sonified(queries.table(spark, sf_dir, "embeddings").orderBy("vec_id").limit(25)).orderBy("recording_id").collect()):
        pcm = np.frombuffer(bytes(r["pcm"]), "<i2")
        rows.append((20 * i, bytes(r["pcm"])))
        for j, noise in enumerate((1000, 3000, 6000, 7500, 9000), 1):
            late = np.concatenate([np.zeros(rng.integers(0, 5000)), pcm])[: len(pcm)] + rng.normal(0, noise, len(pcm))
            rows.append((20 * i + j, late.clip(-32768, 32767).astype("<i2").tobytes()))
    prints = audio_match.fingerprints(spark.createDataFrame(rows, "recording_id long, pcm binary"))
    own = {r["recording_id"]: np.frombuffer(bytes(r["fingerprint"]), np.uint32) for r in prints.collect()}

    def least_errors(a, b):
        bits = np.bitwise_count(a[:, None] ^ b[None, :])
        every = (np.diagonal(bits, o) for o in range(1 - len(a), len(b)))
        return min(float(d.mean()) / 32 for d in every if len(d) >= audio_match.OVERLAP)

    want = {i: sum(least_errors(own[q], p) <= 0.2 for q in own if q % 20 == 0 and q != i) for i, p in own.items()}
    got = {r["recording_id"]: r["n_matches"] for r in audio_match.search(prints, F.col("recording_id") % 20 == 0).collect()}
    assert sum(want.values()) > 100 and all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.9 * sum(want.values())


def test_every_candidate_offset_is_judged_over_a_least_overlap(spark):
    rng = np.random.default_rng(8)
    query = rng.integers(0, 2**32, 60, dtype=np.uint32)
    query[50:] = query[50]  # a sustained sound, which votes for wrong offsets
    copy = query ^ (np.uint32(1) << rng.integers(0, 32, 60).astype(np.uint32)) ^ (np.uint32(1) << rng.integers(0, 32, 60).astype(np.uint32))
    copy[10:20] = query[50]
    chance = rng.integers(0, 2**32, 60, dtype=np.uint32)
    chance[-1] = query[0]  # equal over an overlap of one integer
    df = spark.createDataFrame([(0, query.tobytes()), (1, copy.tobytes()), (2, chance.tobytes())], "recording_id long, fingerprint binary")
    got = {r["recording_id"]: r for r in audio_match.search(df, F.col("recording_id") == 0).collect()}
    assert (got[1]["n_matches"], got[1]["best_id"], got[1]["best_offset"]) == (1, 0, 0) and got[2]["n_matches"] == 0 and got[2]["best_id"] is None
    assert audio_match.align(query, copy)[0] == 0 and audio_match.align(query, chance) is None


def test_odd_recordings(spark):
    rows = [(0, bytes(40_000)), (20, bytes(40_000)), (40, None), (1, b""), (2, b"\x01\x02" * 100), (None, bytes(40_000))]
    df = spark.createDataFrame(rows, "recording_id long, pcm binary")
    got = {r["recording_id"]: r for r in audio_match.search(audio_match.fingerprints(df), F.col("recording_id") % 20 == 0).collect()}
    assert got[20]["class_id"] == 0 and got[20]["n_matches"] == 1 and got[1]["best_id"] is None and got[40]["class_id"] == 40 and len(got) == 6
    assert audio_match.search(audio_match.fingerprints(df.limit(0)), F.lit(True)).count() == 0


def test_recordings_that_tie_repeat_and_are_long(spark, monkeypatch):
    monkeypatch.setattr(audio_match, "BLOCK", 2)
    monkeypatch.setattr(audio_match, "STEP", 500)
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**32, 3000, dtype=np.uint32), rng.integers(0, 2**32, 40, dtype=np.uint32)
    rows = [(BIG, a, 0), (BIG + 2, a, 0), (BIG + 2, a, 0), (None, b, 1), (None, np.flip(b), 1), (BIG + 6, a[700:760], 1), (BIG + 8, a[700:760], 1), (4, b, 0), (2, b, 0)]
    df = spark.createDataFrame([(i, p.tobytes(), q, 1.5) for i, p, q in rows], "recording_id long, fingerprint binary, query int, class_id double").coalesce(1)
    got = [tuple(r) for r in audio_match.search(df.drop("class_id"), F.col("query") == 1).collect()]
    want = [(BIG, BIG, 2, BIG + 6, 700, 0.0), *[(BIG + 2, BIG, 2, BIG + 6, 700, 0.0)] * 2, (None, 2, 0, None, None, None), (None, None, 0, None, None, None)]
    want += [(BIG + 6, BIG + 6, 1, BIG + 6, 0, 0.0), (BIG + 8, BIG + 6, 1, BIG + 6, 0, 0.0), (4, 2, 0, None, None, None), (2, 2, 0, None, None, None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def _sound(spark, sf_dir, n):
    rows = audio_match.sonified(queries.table(spark, sf_dir, "embeddings").orderBy("vec_id").limit(n)).orderBy("recording_id").collect()
    return [np.frombuffer(bytes(r["pcm"]), "<i2") for r in rows]


def test_lookup_finds_every_near_integer_and_compares_few(spark, sf_dir, monkeypatch):
    prints = [audio_match.fingerprint(x) for x in _sound(spark, sf_dir, 200)]
    index = audio_match._Index([(i, 1, p.tobytes()) for i, p in enumerate(prints[:100])])
    others, compared = np.concatenate(prints[100:]), []

    def counted(x, count=np.bitwise_count):
        compared.append(x.size)
        return count(x)

    want = {(int(a), int(h)) for a, h in zip(*np.nonzero(np.bitwise_count(others[:, None] ^ index.flat[None, :]) <= audio_match.NEAR))}
    monkeypatch.setattr(audio_match.np, "bitwise_count", counted)
    for step, chunk in ((1_000_000, 4096), (500, 64)):
        monkeypatch.setattr(audio_match, "STEP", step)
        monkeypatch.setattr(audio_match, "CHUNK", chunk)
        compared.clear()
        assert {(int(a), int(h)) for at, hit in index._near(others) for a, h in zip(at, hit)} == want
        assert len(want) > 1000 and sum(compared) < 10 * len(want)  # 20 by two bytes of four


def test_matches_of_a_batch_equal_alignment_one_by_one(monkeypatch):
    rng = np.random.default_rng(11)
    song = rng.integers(0, 2**32, 900, dtype=np.uint32)

    def noisy(x, bits):
        for _ in range(bits):
            x = x ^ np.where(rng.random(len(x)) < 0.9, np.uint32(1) << rng.integers(0, 32, len(x)).astype(np.uint32), np.uint32(0))
        return x

    spans = [(0, 900), (5, 870), (300, 317), (300, 340), (640, 649), (100, 700), (0, 0), (17, 50)]
    asked = [noisy(song[a:z], b) for (a, z), b in zip([s for s in spans if s[0] < s[1]], (0, 2, 1, 3, 0, 4, 3))]
    others = [noisy(song[a:z], b) for a, z in spans for b in (0, 3, 5)] + [np.repeat(song[:1], 70)]
    index = audio_match._Index([(10 * i, i + 1, p.tobytes()) for i, p in enumerate(asked)])
    pairs = [(i, j, audio_match.align(q, o)) for j, o in enumerate(others) for i, q in enumerate(asked) if len(o)]
    want = [(j, i, found[0], found[2]) for i, j, found in pairs if found and found[2] <= 0.2]
    for step, chunk, long in ((1_000_000, 4096, 256), (500, 64, 16), (50, 10, 8)):
        monkeypatch.setattr(audio_match, "STEP", step)
        monkeypatch.setattr(audio_match, "CHUNK", chunk)
        monkeypatch.setattr(audio_match, "LONG", long)
        assert sorted(zip(*(x.tolist() for x in index.matches(others, 0.2)))) == sorted(want) and len(want) > 40
        best = {j: (sum(i + 1 for k, i, *_ in want if k == j), min((e, 10 * i, o) for k, i, o, e in want if k == j)) for j, *_ in want}
        assert {j: (n, b) for j, n, b in index.best(others, 0.2)} == best


def test_fingerprints_of_unlike_recordings_in_one_batch(spark, sf_dir, monkeypatch):
    rng, sound = np.random.default_rng(12), _sound(spark, sf_dir, 40)
    sound = [x[: rng.integers(0, len(x))] if i % 3 else x for i, x in enumerate(sound)] + [np.zeros(9000, "<i2"), np.zeros(0, "<i2")]
    df = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sound)], "recording_id long, pcm binary").coalesce(1)
    got = {r["recording_id"]: r["fingerprint"] for r in audio_match.fingerprints(df).collect()}
    assert all((bytes(got[i]) if got[i] else b"") == audio_match.fingerprint(x).tobytes() for i, x in enumerate(sound)) and got[41] is None


# 10. HTML


def test_main_text_of_odd_pages(spark):
    model = html_extract.trained()
    body = " ".join(f"Sentence number {i} is quite long and plain." for i in range(8))
    page = f"""<html><head><title>no</title><style>p{{}}</style><script>x='</p>'</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>
      <article><h1>Big&nbsp;title &amp; more</h1><p>{body}<p>a&lt;b &#233; <b>bold</b><br>next</p><div class="ad">Buy this now</div></article>
      <footer>&copy; us</footer></body></html>"""
    want = f"Big title & more\n{body}\na<b é bold next"
    cases = {1: page, 2: None, 3: "", 4: page[: page.index("<footer")] + "<foot", 5: "<article><p>" + "w " * 200_000, 6: "<" * 50_000, 7: "<div>" * 3000 + "x"}
    df = spark.createDataFrame(list(cases.items()), "page_id long, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df, model=model).collect()}
    assert got[1] == want and got[4] == want and got[2] == got[3] == "" and got[5].count("w") == 200_000 and len(got) == 7


@pytest.mark.parametrize(("part", "want"), [
    ('<p>A <a href="foo"">link</a> is here.</p>', "A link is here."), ("<p title=it's>It is a plain sentence.</p>", "It is a plain sentence."),
    ("<p title='x>No quote ends this value.</p>", "No quote ends this value."), ('<p title="a > b" \'>A value has a mark.</p>', "A value has a mark."),
    ('<p>One <svg width="5"/> two.</p>', "One two."), ("<p>One <math/> two.</p>", "One two."), ("<p>One <svg><path d=M></p>", "One"),
    ("<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>", "So x=2 holds."), ("<p>A <b><svg><text>no</b> plain end.</p>", "A plain end."),
    ("<p>a <svg><svg><title>no</title></svg><a href=x>no</a><style/><text>no</text></svg> b.</p>", "a b."),
    ("<p>One is here.</p><svg><text>no</text><foreignObject><p>Two is here.</p></foreignObject><text>no</text></svg>", "One is here.\nTwo is here."),
])
def test_malformed_tags_drop_nothing_else(part, want):
    body = " ".join(f"Sentence number {i} is quite long and plain." for i in range(8))
    page = f"<body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><p>{body}</p>{part}<p>{body}</p></article><footer>&copy; us</footer>"
    assert html_extract.main_text(page, html_extract.trained()) == f"{body}\n{want}\n{body}"


def test_closing_is_linear():
    import time

    deep = "<blockquote>" * 20_000 + "<p>x" + "</section>" * 100_000 + "</blockquote>" * 20_000
    wide = "<p><div>" + "<figure>" * 50_000 + "y"
    drawn = "<dl>" * 20_000 + "<svg>" + "</x>" * 100_000 + "</svg>z"
    for page, want in ((deep, "x"), (wide, "y"), (drawn, "z")):
        began = time.process_time()
        assert [n.parts for n in html_extract.nodes_of(html_extract.parse(page)) if n.tag == "#text"] == [[want]]
        assert time.process_time() - began < 10


def test_parser_against_another_one():
    """All text of generated pages, closed or not, by the standard library's parser."""
    from html.parser import HTMLParser

    class Texts(HTMLParser):
        def __init__(self):
            super().__init__()
            self.raw, self.text = "", []

        def handle_starttag(self, tag, attrs):
            self.raw = tag if tag in ("script", "style") else ""

        def handle_endtag(self, tag):
            self.raw = ""

        def handle_data(self, data):
            self.text.append("" if self.raw else data)

    r = random.Random(12)
    tags = "p div article section ul li table tr td h1 b i a span blockquote br header dl dt dd pre em".split()
    for _ in range(400):
        parts = []
        for _ in range(r.randint(1, 60)):
            tag = r.choice(tags)
            parts.append(r.choice((
                lambda: f"<{tag}>", lambda: f"</{tag}>", lambda: f'<{tag} class="a{r.randint(0, 9)} > b" data-x=\'"\'>', lambda: f"<{tag.upper()} hidden id=x{r.randint(0, 9)}>",
                lambda: "<!-- no <p>text</p> -->", lambda: "<script>if (a < b) { '<p>' }</script>", lambda: "<style>p > b {}</style>",
                lambda: words(r.randint(1, 5), r.random()), lambda: " \n ", lambda: "&amp;&eacute;&#65;&nbsp; a < b", lambda: "<br/>",
            ))())
        page, other = "".join(parts), Texts()
        other.feed(page)
        other.close()
        mine = "".join("".join(n.parts) for n in html_extract.nodes_of(html_extract.parse(page)) if n.tag == "#text")
        assert "".join(mine.split()) == "".join("".join(other.text).split()), page


def test_pages_that_tie_and_repeat(spark):
    page = "<article><p>" + "It is a plain sentence. " * 12 + "</p></article>"
    rows = [(1, page, 1.5), (1, page, float("nan")), (None, page, None), (BIG, "", 0.0), (BIG + 2, None, None)]
    df = spark.createDataFrame(rows, "page_id long, html string, n_chars double").coalesce(1)
    got = html_extract.extract(df)
    assert sorted(map(repr, got.drop("text").collect())) == sorted(map(repr, df.collect()))
    assert {r["text"] for r in got.where("html <> ''").collect()} == {("It is a plain sentence. " * 12).strip()}


def test_marginals_against_enumeration():
    from itertools import product

    model = html_extract.trained()
    nodes = html_extract.nodes_of(html_extract.parse("<body><div class=ad><p>x</p></div><article><p>yes it is.</p></article></body>"))
    names = [html_extract.features(x) for x in nodes]
    place, total, one = {id(x): i for i, x in enumerate(nodes)}, 0.0, np.zeros(len(nodes))
    for y in product((0, 1), repeat=len(nodes)):
        s = sum(sum(model.unary.get(f, 0) for f in fs) for fs, v in zip(names, y) if v)
        s += sum(model.pair[html_extract.kind_of(x, names[i])][y[place[id(x.parent)]]][y[i]] for i, x in enumerate(nodes) if x.parent)
        total += np.exp(s)
        one += np.exp(s) * np.array(y)
    assert np.allclose(model.marginals(nodes)[0], one / total)


def test_pages_of_the_training_generator_are_told_apart():
    model, wrong, n = html_extract.trained(), 0, 0
    for page in html_extract.labelled_pages(60, seed=99):
        nodes, gold = html_extract.nodes_of(html_extract.parse(page)), {}
        for x in nodes:
            gold[id(x)] = int(x.gold) if x.gold is not None else gold.get(id(x.parent), 0)
        for x, p in zip(nodes, model.marginals(nodes)[0]):
            if x.tag == "#text":
                n, wrong = n + 1, wrong + ((p > 0.5) != bool(gold[id(x)]))
    assert wrong <= 0.06 * n


def test_layouts_written_by_hand():
    """Layouts of other makers: names, wrappers and tables that the training generator doesn't draw."""
    from layouts import layouts

    model, kept, all_kept, wrong, dropped = html_extract.trained(), 0, 0, 0, 0
    for page, keep, drop in (x for seed in range(5) for x in layouts(seed)):
        blocks = html_extract.main_text(page, model).split("\n")
        kept, all_kept = kept + sum(x in blocks for x in keep), all_kept + len(keep)
        wrong, dropped = wrong + sum(any(x in b for b in blocks) for x in drop), dropped + len(drop)
    assert kept >= 0.98 * all_kept and wrong <= 0.05 * dropped


@pytest.mark.parametrize("name", "overflow-hidden unhidden text-more share-price social-history side-by-side legal-text".split())
@pytest.mark.parametrize("tag", ["div", "section", "p"])
def test_one_word_of_a_compound_name_drops_nothing(name, tag):
    inner = "The engine stood idle in the yard for most of that winter. Nobody from the council had come to look at it before the spring."
    page = f"<body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>The idle engine</h1><p>{words(30, 1)}.</p><{tag} class='{name}'>{inner}</{tag}><p>{words(40, 2)}.</p></article></body>"
    assert inner in html_extract.main_text(page, html_extract.trained()).split("\n")


@pytest.mark.parametrize("how", ["hidden", "hidden=''", "style='color:red; Display: NONE'", "aria-hidden=true", "class='box hidden'"])
def test_hidden_is_an_attribute_a_style_or_a_class(how):
    page = f"<body><article><h1>The idle engine</h1><p>{words(30, 1)}.</p><div {how}><p>{words(30, 3)}.</p></div><p>{words(40, 2)}.</p></article></body>"
    assert html_extract.main_text(page, html_extract.trained()).split("\n") == ["The idle engine", words(30, 1) + ".", words(40, 2) + "."]


def test_given_pages(spark, sf_dir):
    """The given pages' articles, by their tags."""
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in queries.table(spark, sf_dir, "pages").collect()}
    for r in queries.op10_html_extract(spark, sf_dir).collect():
        article = re.sub(r"<[^>]*$", "", pages[r["page_id"]].partition("<article>")[2].split("</article>")[0]).replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("roles", [["user assistant"], ["system user", "assistant"], ["user", "assistant "], ["", "user assistant"], ["user", "assistant"], ["system", "user", "assistant"]])
def test_roles_with_blanks_keep_their_turns(spark, roles):
    rows = spark.createDataFrame([(1, i, role, f"text {i}") for i, role in enumerate(roles)], "conv_id long, turn long, role string, text string")
    canonical = chat_format.canonical_turns(chat_format.from_rows(rows))
    got = chat_format.read_back(chat_format.format_turns(chat_format.known(canonical))).first()
    told = hashlib.sha256("".join(f"{r}\ntext {i}\n" for i, r in enumerate(roles)).encode()).hexdigest()
    loss = "".join(f"text {i}" for i, r in enumerate(roles) if r == "assistant")
    assert (got["n_turns"], got["turns_sha256"], got["loss_chars"]) == (len(roles), told, len(loss))


def test_a_record_without_a_layout_is_no_conversation(spark):
    records = spark.createDataFrame([(1, '{"strange": 1}')], "conv_id long, record string")
    canonical = chat_format.canonical_turns(records)
    assert canonical.first()["turns"] is None
    with pytest.raises(Exception, match="no layout"):
        chat_format.known(canonical).collect()
