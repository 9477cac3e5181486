"""The stages of the corpus pipeline on the small tables, against brute force on their own input, and on odd rows."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from benthic_jobs.llm import decontaminate, quality
from benthic_jobs.llm.shared import stored
from test_llm import brute_links, brute_repeats, check_packing


def rows_of(df):
    return sorted(df.collect(), key=lambda r: r["doc_id"])


def by_quality(spark, docs, sf_dir):
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = rows_of(docs)
    x = np.array([quality.statistics(r["text"]) for r in rows])
    total = model.bias + sum(w * quality.holds(rule, x) for rule, w in model.rules)
    return [r for r, t in zip(rows, total) if t >= 0]


def by_links(spark, docs, sf_dir):
    rows = rows_of(docs)
    _, label = brute_links([(r["doc_id"], r["text"]) for r in rows])
    return [rows[i] for i in sorted(set(label))]


def by_windows(spark, docs, sf_dir):
    out = []
    for r, kept in zip(rows := rows_of(docs), brute_repeats([r["text"] for r in rows], 35)):
        n = len((r["text"] or "").encode().split())
        if len(kept.encode().split()) == n:
            out.append(r)
        elif kept:
            out.append(type(r)(**(r.asDict() | {"text": kept, "n_chars": len(kept)})))
    return out


def by_items(spark, docs, sf_dir):
    split = lambda t: (t or "").encode().translate(decontaminate.ALNUM).split()
    windows: dict[int, set] = {}
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = split(item["text"])
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(n, set()).add(tuple(words[i : i + n]))
    hit = lambda w: any(tuple(w[i : i + n]) in own for n, own in windows.items() for i in range(len(w) - n + 1))
    return [r for r in rows_of(docs) if not hit(split(r["text"]))]


BRUTE = {"quality": by_quality, "near_copies": by_links, "repeats": by_windows, "benchmarks": by_items}


def test_stages(spark, sf_dir):
    from tokenizers import Tokenizer

    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns and docs.count() <= seen[-1] and docs.count() > 0.5 * seen[0]
        assert docs.where("n_chars <> char_length(text)").count() == 0
        assert rows_of(docs) == BRUTE[name](spark, before, sf_dir), name
        assert rows_of(docs) != rows_of(before), name  # each stage has something to do
        seen.append(docs.count())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    check_packing(pieces)
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want = {r["doc_id"]: len(encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect()}
    held: Counter = Counter()
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        assert p["start"] == held[p["doc_id"]] and p["doc_tokens"] == want[p["doc_id"]]
        held[p["doc_id"]] += p["length"]
    assert held == want


def test_stages_of_odd_rows(spark, sf_dir):
    rows = [(1, None), (2, ""), (3, "x" * 100_000), (None, "a b c"), (5, "same words here " * 40), (5, "same words here " * 40)]
    more = "stats score label n_words n_removed removed_spans kept_text hit_spans hit_items set first size leaf run own "
    more += "N_Words __key __ranges __r __found __spans __items __stats __p Score ROW_KEY Hit_Spans Kept key c0 none _1"
    more = list({c.lower(): c for c in more.split()}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.char_length("text").cast("long"), **{c: F.lit(f"own {c}") for c in more}}
    )
    schema, all_docs = docs.schema, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for own in (all_docs, docs if name != "quality" else all_docs, all_docs.limit(0)):
            done = stage(spark, own, sf_dir)
            assert [(f.name, f.dataType) for f in done.schema] == [(f.name, f.dataType) for f in schema], name
            assert all(r[c] == f"own {c}" for r in done.collect() for c in more), name
        if name != "quality":  # its decisions are its own; the rows are those that came
            docs = stored(stage(spark, docs, sf_dir), name)
    assert {r["doc_id"] for r in docs.collect()} == {1, 2, 3, None}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in pieces} == {1, 2, 3, None} and sum(r["doc_tokens"] == 1 for r in pieces) == 2
    some = {(r["doc_id"], r["text"]) for r in corpus_pipeline.STAGES[0][1](spark, all_docs, sf_dir).collect()}
    assert some <= set(rows)
