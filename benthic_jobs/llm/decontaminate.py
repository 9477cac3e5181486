"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ``size`` consecutive words of an item (a shorter item is one window). It is contained in a
document where all of its shingles stand in their places, so by the prefix principle (overlap needed =
all shingles) one shingle is enough to find every occurrence. The windows' shingles are ordered by their
count over the whole corpus and each window keeps its rarest one. A document position with that shingle is
a candidate; the positional bound (the window would begin before the document) and the length bound (it
would end behind it) drop candidates, and the rest are verified word by word: hashes first, then the words' bytes.

Up to ``block`` windows are broadcast, and documents pass them without a shuffle. With more windows the join is a
shuffle, in the same two passes over the corpus whatever their number: shingles are counted in a sketch of fixed size
(any order of the shingles keeps the prefix principle), a bit map of fixed size of the windows' rarest shingles lets
through the documents' candidate positions, and these meet the windows in an equi-join on the shingle. Candidates of
equal texts are one row. A shingle with more than ``HOT`` candidates is dealt to parts of about so many, and its windows
are copied to each part, so no task has all places of a passage that every document holds.

Null or empty texts and items without words have no windows and no hits. Repeated rows are reported each
by itself; repeated item ids count once. An item with a null id has windows like any other: its words are hit, and only
its id is missing in ``hit_items``. Other columns of the documents never leave the JVM; those named ``n_words``,
``hit_spans`` or ``hit_items`` are replaced. Further columns of the items are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ALNUM, grams, hashed_words, slices, stored

SHINGLE = 3
#: Words that are hashed, and candidates that are verified, at a time.
STEP_BYTES, STEP_PAIRS = 4_000_000, 100_000
#: Bits of a shingle's hash that choose its counter in the sketch, and its bit in the map: both have a fixed size.
COUNTERS, FILTER = 18, 27
#: Candidates of one shingle that a part of the join has, at least; at most ``SPLITS`` shingles are dealt to parts.
HOT, SPLITS = 100_000, 10_000
FOUND = "struct<n_words:long,hit_spans:array<array<int>>,hit_items:array<string>>"


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace").translate(ALNUM) for t in texts]


def _windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(item, n, text): the distinct windows of each item, their words joined by one space."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], _bytes(batch["text"])):
                words = text.split()
                n = min(size, len(words))
                if n:
                    own = {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}
                    yield pd.DataFrame({"item": item, "n": n, "text": [w.decode() for w in sorted(own)]})

    columns = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return columns.mapInPandas(split, "item string, n int, text string")


class _Block:
    """The windows that are broadcast, by length, with their shingles."""

    def __init__(self, rows: list) -> None:
        self.items = sorted({r["item"] for r in rows if r["item"] is not None})
        number = {x: i for i, x in enumerate(self.items)} | {None: -1}
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, list[bytes]]] = {}
        for n in {r["n"] for r in rows}:
            own = [r for r in rows if r["n"] == n]
            texts = [r["text"].encode() for r in own]
            self.by_size[n] = (hashed_words(texts)[0].reshape(-1, n), np.array([number[r["item"]] for r in own]), texts)

    def shingles(self) -> dict[int, np.ndarray]:
        """Of each shingle length the sorted distinct hashes."""
        found: dict[int, list[np.ndarray]] = {}
        for n, (words, _, _) in self.by_size.items():
            k = min(SHINGLE, n)
            found.setdefault(k, []).append(_rows(words, k).ravel())
        return {k: np.unique(np.concatenate(v)) for k, v in found.items()}


def _rows(words: np.ndarray, k: int) -> np.ndarray:
    """The shingles of each row of words."""
    n = words.shape[1] - k + 1
    flat = grams(words.ravel(), k)
    flat = np.concatenate([flat, np.zeros(k - 1, np.uint64)]).reshape(words.shape)
    return flat[:, :n]


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``keys`` that occur in ``sorted_keys``, and where they begin there."""
    at = np.searchsorted(sorted_keys, keys)
    ok = sorted_keys[np.minimum(at, len(sorted_keys) - 1)] == keys
    hit = np.flatnonzero(ok)
    return hit, at[hit]


def _counts(docs: DataFrame, text_col: str, shingles) -> DataFrame:
    """How often each shingle of the block stands in the corpus."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {k: np.zeros(len(v), np.int64) for k, v in shingles.value.items()}
        for batch in batches:
            texts = _bytes(batch["text"])
            for part in slices([len(t) for t in texts], STEP_BYTES):
                words, _ = hashed_words(texts[part])
                for k, keys in shingles.value.items():
                    _, at = _lookup(keys, grams(words, k))
                    total[k] += np.bincount(at, minlength=len(keys))
        for k, keys in shingles.value.items():
            some = np.flatnonzero(total[k])
            yield pd.DataFrame({"k": k, "shingle": keys.view(np.int64)[some], "n": total[k][some]})

    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "k int, shingle long, n long")
    return rows.groupBy("k", "shingle").agg(F.sum("n").alias("n"))


def _prefixes(block: _Block, counts: dict[int, dict[int, int]]) -> dict[int, dict]:
    """Of each window length: windows ordered by their rarest shingle, with that shingle's place."""
    out = {}
    for n, (words, item, texts) in block.by_size.items():
        k = min(SHINGLE, n)
        own = _rows(words, k)
        seen = counts.get(k, {})
        freq = np.array([[seen.get(x, 0) for x in r] for r in own.view(np.int64).tolist()])
        place = np.lexsort((own, freq), axis=1)[:, 0]
        rare = own[np.arange(len(own)), place]
        keep = np.flatnonzero(freq.min(axis=1) > 0)  # a shingle that no text has: no occurrence
        order = keep[np.argsort(rare[keep], kind="stable")]
        keys, begin = np.unique(rare[order], return_index=True)
        out[n] = {
            "k": k, "keys": keys, "begin": np.append(begin, len(order)), "place": place[order],
            "words": words[order], "item": item[order], "text": [texts[i] for i in order],
        }
    return out


def _hits(texts: list[bytes], words: np.ndarray, bounds: np.ndarray, index: dict[int, dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hit words as a mask, and (text, item) pairs with an occurrence; the item is -1 where its id is null."""
    mark = np.zeros(len(words) + 1, np.int64)
    found, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    shingle_of = {k: grams(words, k) for k in {x["k"] for x in index.values()}}
    split: dict[int, list[bytes]] = {}
    for n, x in index.items():
        if not len(x["keys"]):
            continue
        pos, at = _lookup(x["keys"], shingle_of[x["k"]])
        many = x["begin"][at + 1] - x["begin"][at]
        for part in slices(many.tolist(), STEP_PAIRS):
            m = many[part]
            start = np.repeat(pos[part], m)
            win = np.repeat(x["begin"][at[part]], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            text = np.searchsorted(bounds, start, side="right") - 1
            start = start - x["place"][win]
            ok = (start >= bounds[text]) & (start + n <= bounds[text + 1])
            start, win, text = start[ok], win[ok], text[ok]
            same = np.ones(len(start), bool)
            for j in range(n):
                same[same] = words[start[same] + j] == x["words"][win[same], j]
            for i in np.flatnonzero(same).tolist():
                own = split.get(text[i])
                if own is None:
                    own = split[text[i]] = texts[text[i]].split()
                begin = start[i] - bounds[text[i]]
                same[i] = b" ".join(own[begin : begin + n]) == x["text"][win[i]]
            start, win, text = start[same], win[same], text[same]
            np.add.at(mark, start, 1)
            np.add.at(mark, start + n, -1)
            found.append(text)
            items.append(x["item"][win])
    return np.cumsum(mark[:-1]) > 0, np.concatenate(found), np.concatenate(items)


def _runs(mask: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


def _by_broadcast(docs: DataFrame, text_col: str, windows: DataFrame):
    """The column of findings where the windows are few."""
    context = docs.sparkSession.sparkContext
    block = _Block(windows.collect())  # at most ``block`` windows
    shingles = context.broadcast(block.shingles())
    counts: dict[int, dict[int, int]] = {}
    for r in _counts(docs, text_col, shingles).collect() if block.by_size else []:  # as many as the block has
        counts.setdefault(r["k"], {})[r["shingle"]] = r["n"]
    index = context.broadcast((_prefixes(block, counts), block.items))

    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        by_size, names = index.value
        for batch in batches:
            texts = _bytes(batch)
            n_words, spans, hit = [], [], []
            for part in slices([len(t) for t in texts], STEP_BYTES):
                words, bounds = hashed_words(texts[part])
                mask, text, item = _hits(texts[part], words, bounds, by_size)
                found: dict[int, set] = {}
                for t, i in set(zip(text.tolist(), item.tolist())):
                    found.setdefault(t, set()).update(names[i : i + 1] if i >= 0 else ())
                for i, (a, z) in enumerate(zip(bounds[:-1], bounds[1:])):
                    n_words.append(int(z - a))
                    spans.append(_runs(mask[a:z]) if i in found else [])
                    hit.append(sorted(found.get(i, ())))
            yield pd.DataFrame({"n_words": np.array(n_words, np.int64), "hit_spans": spans, "hit_items": hit})

    return F.pandas_udf(match, FOUND).asNondeterministic()(F.col(text_col))


def _sketch(docs: DataFrame) -> dict[int, np.ndarray]:
    """Counts of shingles over the corpus, by the first bits of their hashes."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((SHINGLE + 1, 1 << COUNTERS), np.int64)
        for batch in batches:
            texts = _bytes(batch["text"])
            for part in slices([len(t) for t in texts], STEP_BYTES):
                words, _ = hashed_words(texts[part])
                for k in range(1, SHINGLE + 1):
                    total[k] += np.bincount((grams(words, k) >> np.uint64(64 - COUNTERS)).astype(np.int64), minlength=1 << COUNTERS)
        k, at = np.nonzero(total)
        yield pd.DataFrame({"k": k.astype(np.int32), "at": at.astype(np.int32), "n": total[k, at]})

    rows = docs.select("text").mapInPandas(count, "k int, at int, n long").groupBy("k", "at").agg(F.sum("n").alias("n"))
    out = {k: np.zeros(1 << COUNTERS, np.int64) for k in range(1, SHINGLE + 1)}
    for r in rows.collect():  # at most SHINGLE * 2 ** COUNTERS
        out[r["k"]][r["at"]] = r["n"]
    return out


def _rarest(windows: DataFrame, sketch) -> DataFrame:
    """``windows`` with their rarest ``shingle`` and its ``place``."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, own in batch.groupby("n"):
                k = min(SHINGLE, n)
                rows = _rows(hashed_words([t.encode() for t in own["text"]])[0].reshape(-1, n), k)
                freq = sketch.value[k][(rows >> np.uint64(64 - COUNTERS)).astype(np.int64)]
                place = np.lexsort((rows, freq), axis=1)[:, 0]
                yield own.assign(shingle=rows[np.arange(len(rows)), place].view(np.int64), place=place.astype(np.int32))

    return windows.mapInPandas(choose, "item string, n int, text string, shingle long, place int")


def _bit(shingles: np.ndarray) -> np.ndarray:
    return (shingles.view(np.uint64) >> np.uint64(64 - FILTER)).astype(np.int64)


def _dealt(met: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates and windows with the ``part`` of their shingle in which they meet: a row of one, copies in all parts of the other."""
    counts = met.groupBy("shingle").agg(F.count("*").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(HOT, total // SPLITS)  # so fewer than SPLITS shingles have more
    hot = F.broadcast(counts.where(F.col("n") > most).select("shingle", F.ceil(F.col("n") / most).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    met = met.join(hot, "shingle", "left").withColumn("part", F.pmod(F.xxhash64("key", "pos"), parts).cast("int")).drop("parts")
    chosen = chosen.join(hot, "shingle", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return met, chosen


def _by_shuffle(docs: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """(key, hit_spans, hit_items) of the texts (key, text) that have any, where the windows are many."""
    context = docs.sparkSession.sparkContext
    chosen = stored(_rarest(windows, context.broadcast(_sketch(docs))), "prefixes")
    bit = F.shiftrightunsigned("shingle", 64 - FILTER) + 1  # the functions below count from 1
    maps = chosen.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    bits = np.zeros((1 << FILTER) // 8, np.uint8)
    for r in maps.collect():  # at most 2 ** FILTER bits
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[(r["bucket"] - 1) * len(own) : r["bucket"] * len(own)] = own
    known = context.broadcast(bits)

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _bytes(batch["text"])
            for part in slices([len(t) for t in texts], STEP_BYTES):
                words, bounds = hashed_words(texts[part])
                keys, split = batch["key"].to_numpy()[part], {}
                for k in range(1, SHINGLE + 1):
                    shingle = grams(words, k)
                    at = _bit(shingle)
                    pos = np.flatnonzero(known.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                    text = np.searchsorted(bounds, pos, side="right") - 1
                    inside = pos + k <= bounds[text + 1]
                    rows = []
                    for p, t in zip(pos[inside].tolist(), text[inside].tolist()):
                        own = split.get(t)
                        if own is None:
                            own = split[t] = [w.decode() for w in texts[part][t].split()]
                        p -= int(bounds[t])
                        low = max(0, p - size + 1)
                        rows.append((keys[t], p, low, own[low : p + size]))
                    out = pd.DataFrame(rows, columns=["key", "pos", "low", "around"])
                    yield out.assign(shingle=shingle.view(np.int64)[pos[inside]])

    met = docs.mapInPandas(candidates, "key binary, pos int, low int, around array<string>, shingle long").distinct()
    met, chosen = _dealt(stored(met, "candidates"), chosen)
    start = F.col("pos") - F.col("place")
    inside = (start >= F.col("low")) & (start - F.col("low") + F.col("n") <= F.size("around"))
    met = met.join(chosen, ["shingle", "part"]).where(inside)
    met = met.where(F.array_join(F.slice("around", start - F.col("low") + 1, F.col("n")), " ") == F.col("text"))
    span = F.struct(start.alias("a"), (start + F.col("n")).alias("z"))
    found = met.groupBy("key").agg(F.collect_set(span).alias("spans"), F.array_sort(F.collect_set("item")).alias("hit_items"))

    @F.pandas_udf("array<array<int>>")
    def joined(rows: pd.Series) -> pd.Series:
        return pd.Series([_joined([[x["a"], x["z"]] for x in r]) for r in rows], dtype=object)

    return found.select("key", joined("spans").alias("hit_spans"), "hit_items")


def find_contamination(
    docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = 10, block: int = 200_000,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (word positions [begin, end)) and ``hit_items``.

    Words are runs of letters and digits (non-ASCII characters count as letters) after A-Z became lower case.
    Every occurrence of every window counts; nothing is capped.
    """
    windows = stored(_windows(items, item_id, item_text, size), "windows")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "hit_spans", "hit_items")]
    if windows.count() <= block:
        out = docs.select(*rest, _by_broadcast(docs, text_col, windows).alias("__found"))
        return out.select(*rest, *(f"__found.{c}" for c in ("n_words", "hit_spans", "hit_items")))

    @F.pandas_udf("long")
    def count_words(texts: pd.Series) -> pd.Series:
        return pd.Series([len(t.split()) for t in _bytes(texts)], dtype="int64")

    key = F.unhex(F.sha2(F.col(text_col).cast("binary"), 256))
    keyed = docs.where(F.col(text_col).isNotNull()).select(key.alias("key"), F.col(text_col).alias("text"))
    found = _by_shuffle(keyed, windows, size).withColumnsRenamed({"key": "__key", "hit_spans": "__spans", "hit_items": "__items"})
    out = docs.select(*rest, count_words(F.col(text_col)).alias("n_words"), key.alias("__key")).join(found, "__key", "left")
    empty = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    return out.select(
        *rest, "n_words", empty("__spans", "array<array<int>>").alias("hit_spans"), empty("__items", "array<string>").alias("hit_items")
    )


def _joined(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(z, out[-1][1])
        else:
            out.append([a, z])
    return out


def digest(found: DataFrame) -> DataFrame:
    """The figures of each document, from what ``find_contamination`` reports."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
occ AS (
  SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT r, p, o.n, item FROM occ o JOIN win USING (n, g)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
