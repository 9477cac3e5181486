"""Removal of word passages that occur more than once in a corpus, with an FM-index for each shard.

A window is ``window`` consecutive words of one document. Each window has an anchor: the smallest hash of
its ``ANCHOR``-word shingles. Equal windows have equal anchors, so shards by anchor hold every occurrence of
whatever they are asked for, and no document meets more than the shards that its own windows name.
Consecutive windows with one anchor travel together as a segment.

1. Count the anchors (a partial sum in each task); an anchor that occurs once can repeat nothing.
2. Keep the segments of the other anchors, as hashes; equal segments become one row with a weight.
3. Fetch the words of one occurrence of each segment and deal them out to the shards.
4. Each shard builds a compressed FM-index (``fm_index``) over its segments, with their weights, and streams those
   that stand alone through backward search; a window whose matching statistic reaches ``window`` with a weight of 2
   repeats. Segments with a weight repeat as a whole.
   Within a shard words are compared by their bytes.
5. The window ranges go back to the documents by joins on hashed keys, and the covered words are removed.

Segments are one where anchor and digest, 128 bits in all, agree; both come from 64-bit word hashes without structure.

A hot passage is one weighted segment. An anchor with over ``HOT`` different segments is dealt out again, window by
window, by the hash of the whole window, so that no shard grows with it. Null, empty and short texts keep
everything; repeated rows count as occurrences of their own and each is reported. Nothing is capped. Other columns,
ids among them, never leave the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .shared import grams, hashed_words, mix, numbered_words, powers, slices, stored

ANCHOR, LONGEST, HOT = 10, 64, 5_000
#: Bytes of text that are hashed at a time; words of a shard on average.
STEP_BYTES, SHARD_WORDS = 1_000_000, 150_000
_M = np.uint64(0xD6E8FEB86659FD93)
_M_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


def _least(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The minimum of each ``width`` consecutive values, and where it first stands."""
    n, at, span = len(x) - width + 1, np.arange(len(x)), 1
    while span < width:
        far = min(span, width - span)
        later = x[far:] < x[:-far]
        x, at = np.where(later, x[far:], x[:-far]), np.where(later, at[far:], at[:-far])
        span += far
    return x[:n], at[:n]


def segments(words: np.ndarray, bounds: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Of all texts the runs of windows with one anchor: text, first window, windows, anchor, digest.

    ``places``: at how many places of the run the anchor leads a window; equal windows of one run differ in it.
    """
    empty = np.zeros(0, np.int64)
    if len(words) < window:
        return {"text": empty, "first": empty, "windows": empty, "anchor": empty, "digest": empty, "places": empty}
    anchor, lead = _least(grams(words, min(ANCHOR, window)), window - min(ANCHOR, window) + 1)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    own = np.flatnonzero(text[: len(words) - window + 1] == text[window - 1 :])
    new = np.ones(len(own), bool)
    new[1:] = (np.diff(own) > 1) | (anchor[own[1:]] != anchor[own[:-1]])
    begin = np.flatnonzero(new)
    place = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
    begin = np.flatnonzero(new | (place % LONGEST == 0))
    count = np.diff(np.append(begin, len(own)))
    first = own[begin]
    moved = np.zeros(len(own), np.int64)
    moved[1:] = lead[own[1:]] != lead[own[:-1]]
    moved[begin] = 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(len(words), _M))])
    back = powers(len(words), _M_INVERSE)
    digest = mix((total[first + count + window - 1] - total[first]) * back[first] + count.astype(np.uint64))
    return {
        "text": text[first], "first": first - bounds[text[first]], "windows": count,
        "anchor": anchor[first].view(np.int64), "digest": digest.view(np.int64),
        "places": np.add.reduceat(moved, begin) if len(begin) else empty,
    }


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace") for t in texts]


def _found(batch: pd.DataFrame, window: int) -> Iterator[tuple[slice, dict[str, np.ndarray]]]:
    texts = _bytes(batch["text"])
    for part in slices([len(t) for t in texts], STEP_BYTES):
        yield part, segments(*hashed_words(texts[part]), window)


def _repeated_anchors(keyed: DataFrame, window: int) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, found in _found(batch, window):
                anchor, at = np.unique(found["anchor"], return_inverse=True)
                n = np.bincount(at, found["places"], len(anchor)).astype(np.int64)
                yield pd.DataFrame({"anchor": anchor, "n": n})

    counts = keyed.select("text").mapInPandas(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return stored(counts.where("n > 1").select("anchor"), "anchors")


def _segments(keyed: DataFrame, window: int) -> DataFrame:
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["row_key"].to_numpy()
            for part, found in _found(batch, window):
                yield pd.DataFrame({
                    "anchor": found["anchor"], "digest": found["digest"], "row_key": keys[part][found["text"]],
                    "first": found["first"].astype(np.int32), "windows": found["windows"].astype(np.int32),
                })

    return keyed.select("row_key", "text").mapInPandas(
        emit, "anchor long, digest long, row_key binary, first int, windows int"
    )


def _cut(window: int):
    """Takes documents with the segments wanted of them; returns the segments' words, to be dealt out."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, wanted in zip(batch["text"], batch["wanted"]):
                words = text.encode("utf-8", "replace").split()
                for x in wanted:
                    a, z = x["first"], x["first"] + x["windows"]
                    if x["hot"]:
                        own, _ = hashed_words([b" ".join(words[a : z + window - 1])])
                        deal = grams(own, window).view(np.int64).tolist()
                        rows += [
                            (x["anchor"], x["digest"], x["n"], deal[w], w, b" ".join(words[a + w : a + w + window]))
                            for w in range(z - a)
                        ]
                    else:
                        own_words = b" ".join(words[a : z + window - 1])
                        rows.append((x["anchor"], x["digest"], x["n"], x["anchor"], 0, own_words))
            yield pd.DataFrame(rows, columns=["anchor", "digest", "n", "deal", "offset", "words"])

    return emit


def _shard(window: int):
    """Indexes a shard's segments and streams them through it."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        symbols, bounds = numbered_words(list(pdf["words"]))
        symbols, lens = symbols + 1, np.diff(bounds)
        text_of = np.repeat(np.arange(len(lens)), lens + 1)
        flat = np.zeros(len(symbols) + len(lens), np.int64)
        at = np.arange(len(symbols)) + np.repeat(np.arange(len(lens)), lens)
        flat[at] = symbols
        index = FMIndex(flat, text_of, pdf["n"].to_numpy(), window)
        begin = bounds[:-1] + np.arange(len(lens))
        windows = lens - window + 1
        seg = np.repeat(np.arange(len(lens)), windows)
        place = np.arange(len(seg)) - np.repeat(np.cumsum(windows) - windows, windows)
        hit = pdf["n"].to_numpy()[seg] > 1  # a segment with a weight repeats as a whole
        ask = np.flatnonzero(~hit)
        hit[ask] = index.matching(flat, begin[seg[ask]] + place[ask] + window, window, 2) == window
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        starts, ends = edge[::2], edge[1::2]
        cuts = np.flatnonzero(np.diff(seg)) + 1  # no range goes from one segment to the next
        inner = cuts[(np.searchsorted(starts, cuts, "left") > np.searchsorted(ends, cuts, "right"))]
        starts, ends = np.union1d(starts, inner), np.union1d(ends, inner)
        own, offset = seg[starts], pdf["offset"].to_numpy()
        return pd.DataFrame({
            "anchor": pdf["anchor"].to_numpy()[own], "digest": pdf["digest"].to_numpy()[own],
            "a": (place[starts] + offset[own]).astype(np.int32), "z": (place[ends - 1] + 1 + offset[own]).astype(np.int32),
        })

    return search


def _remove(window: int):
    @F.pandas_udf("struct<n_words:long,n_removed:long,removed_spans:array<array<int>>,kept_text:string>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n_words, spans, kept = [], [], []
            for text, ranges in zip(*batch):
                words = (text or "").encode("utf-8", "replace").split()
                n_words.append(len(words))
                if ranges is None:
                    spans.append([])
                    kept.append(b" ".join(words).decode())
                    continue
                mark = np.zeros(len(words) + 1, np.int64)
                for x in ranges:
                    mark[x["a"]] += 1
                    mark[x["z"] + window - 1] -= 1
                gone = np.cumsum(mark[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append(edge.reshape(-1, 2).tolist())
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
            n_removed = np.array([sum(z - a for a, z in s) for s in spans], np.int64)
            yield pd.DataFrame({"n_words": np.array(n_words, np.int64), "n_removed": n_removed, "removed_spans": spans, "kept_text": kept})

    return cut.asNondeterministic()


def repeated_windows(docs: DataFrame, *, text_col: str = "text", window: int = 35) -> tuple[DataFrame, DataFrame]:
    """Keyed documents (``row_key`` and the text) and, by ``row_key``, the ranges [a, z) of repeated windows."""
    keyed = docs.select(_row_key(docs, text_col).alias("row_key"), F.col(text_col).alias("text"))
    anchors = _repeated_anchors(keyed, window)
    found = stored(_segments(keyed, window).join(anchors, "anchor", "left_semi"), "segments")
    some = F.min(F.struct("row_key", "first", "windows")).alias("some")
    weighed = stored(found.groupBy("anchor", "digest").agg(F.count("*").alias("n"), some), "weighed")
    crowded = weighed.groupBy("anchor").agg(F.count("*").alias("different")).where(F.col("different") > HOT)
    crowded = stored(crowded.select("anchor", F.lit(True).alias("hot")), "crowded")
    wanted = weighed.join(crowded, "anchor", "left").groupBy("some.row_key").agg(
        F.collect_list(
            F.struct("anchor", "digest", "n", "some.first", "some.windows", F.coalesce("hot", F.lit(False)).alias("hot"))
        ).alias("wanted")
    )
    once = keyed.where("text is not null").join(wanted, "row_key")
    cut = once.select("text", "wanted").mapInPandas(
        _cut(window), "anchor long, digest long, n long, deal long, offset int, words binary"
    )
    size = weighed.agg(F.coalesce(F.sum(F.col("some.windows") + window), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_WORDS))
    hits = cut.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards))).groupBy("shard").applyInPandas(
        _shard(window), "anchor long, digest long, a int, z int"
    )
    hits = stored(hits, "hits")
    ranges = found.join(hits, ["anchor", "digest"]).select(
        "row_key", F.struct((F.col("first") + F.col("a")).alias("a"), (F.col("first") + F.col("z")).alias("z")).alias("r")
    )
    return keyed, ranges.groupBy("row_key").agg(F.collect_set("r").alias("ranges"))


def _row_key(docs: DataFrame, text_col: str):
    """16 bytes of the row's id and text: repeated rows share them, and so their result."""
    ids = [F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n"))] if "doc_id" in docs.columns else []
    return F.unhex(F.md5(F.concat_ws("|", *ids, F.coalesce(F.col(text_col), F.lit("")))))


def remove_repeats(docs: DataFrame, *, text_col: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``removed_spans`` (word positions) and ``kept_text``.

    Columns of these names are replaced. Windows are judged on the input; of a passage that stands in several places no copy stays.
    """
    docs = docs.drop("n_words", "n_removed", "removed_spans", "kept_text")
    _, ranges = repeated_windows(docs, text_col=text_col, window=window)
    ranges = ranges.withColumnsRenamed({"row_key": "__key", "ranges": "__ranges"})
    joined = docs.withColumn("__key", _row_key(docs, text_col)).join(ranges, "__key", "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    done = joined.select(*own, _remove(window)(F.col(text_col), F.col("__ranges")).alias("__r"))
    return done.select(*own, "__r.*")


def digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT r, p, hash(array_to_string(w[p:p + 34], ' ')) AS h, sha256(array_to_string(w[p:p + 34], ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
rep AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, q FROM (SELECT r, unnest(range(p, p + 35)) AS q FROM win JOIN rep USING (g))),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY q) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
