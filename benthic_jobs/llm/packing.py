"""Packing of tokenised documents into sequences: cutting stock by column generation.

Documents are cut at multiples of the sequence length; what is left over, and short documents, are pieces of any
length. The histogram of piece lengths, in classes of ``GRAIN`` tokens, is all that the driver sees, and it has a
fixed number of classes. A linear program over patterns (how many pieces of each class fill a sequence) is solved
by column generation: the simplex method prices the classes, an unbounded knapsack finds the pattern with the best
reduced cost, until none has one. The patterns' counts are rounded down and the pieces that are left, a few for
each pattern, are placed first-fit decreasing.

Pieces are then ranked within their class and a pattern owns an interval of ranks. The ranks come from counts of
(class, salt) groups, so that a class that most pieces belong to is dealt over many tasks.

Null texts are empty and pack as the end id alone; repeated rows are packed each for itself. Ids of any type stay as they
are. Of the documents nothing but the id and the text is read.

Ids are those of the library and file that ``public_tokenizer`` names. The same vocabulary is read as ranks by another
library, which is several times as fast and gives equal ids; it cannot split very long runs of white space, so texts
with one go to the named library.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranks import running_total
from .shared import stored

GRAIN, END_ID = 8, 1
#: White space that the faster library is not given in one run.
LONG_SPACE = re.compile(r"\s{4000}")
#: Pieces of one class that are ranked in one group, about.
GROUP = 1_000
PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"


@cache
def encoder(vocabulary: str, ranks: str, pattern: str) -> Callable[[str], list[int]]:
    """Text to ids. ``vocabulary`` is a tokenizer file; ``ranks`` and ``pattern`` say the same for the faster library."""
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens=special)

    def encode(text: str) -> list[int]:
        if len(text) >= 4000 and LONG_SPACE.search(text):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode(text, allowed_special="all")

    return encode


def public_tokenizer() -> tuple[str, str, str]:
    import public_tokenizers as public

    return public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN


def tokenised(
    docs: DataFrame, *, text_col: str = "text", most: int = 2048, vocabulary: tuple[str, str, str] | None = None, keep_ids: bool = False
) -> DataFrame:
    """A row for each piece of each document; ``ids`` (unsigned little-endian 32-bit) if asked for."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(*(vocabulary or public_tokenizer()))
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encode(text or ""), END_ID], "<u4")
                for start in range(0, len(ids), most):
                    piece = ids[start : start + most].tobytes()
                    rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), len(ids), piece)[: 6 if keep_ids else 5])
            yield pd.DataFrame(rows, columns=names)

    schema = PIECES + ", ids binary" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInPandas(cut, schema).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: how often each size is taken so that the values add up to most."""
    best, take = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        fit = int(np.searchsorted(sizes, r, side="right"))
        if fit:
            total = best[r - sizes[:fit]] + value[:fit]
            k = int(np.argmax(total))
            if total[k] > best[r]:
                best[r], take[r] = total[k], k
    count, r = np.zeros(len(sizes), np.int64), room
    while r > 0:
        if take[r] < 0:
            r -= 1
        else:
            count[take[r]] += 1
            r -= sizes[take[r]]
    return float(best[room]), count


def _first_columns(sizes: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """A basis: patterns filled with the largest sizes left, each used until one of its sizes is met, and then without it."""
    left, columns = demand.astype(float), []
    open_ = np.ones(len(sizes), bool)
    for _ in range(len(sizes)):
        pattern, free = np.zeros(len(sizes), np.int64), room
        for i in np.flatnonzero(open_)[::-1]:
            pattern[i] = free // sizes[i]
            if len(columns) + 1 < len(sizes):  # no more than are left, so that small sizes last for later patterns
                pattern[i] = min(pattern[i], max(1, int(left[i])))
            free -= pattern[i] * sizes[i]
        some = np.flatnonzero(pattern)
        times = left[some] / pattern[some]
        met = some[int(np.argmin(times))]
        left = np.maximum(left - pattern * times.min(), 0)
        open_[met], left[met] = False, 0
        columns.append(pattern)
    return np.array(columns).T


def _inverse(a: np.ndarray) -> np.ndarray:
    """By elimination with pivots; at most 256 classes, so no linear algebra library (and none of its threads) is worth it."""
    n = len(a)
    both = np.hstack([a.astype(float), np.eye(n)])
    for i in range(n):
        pivot = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        way = both[:, i].copy()
        way[i] = 0
        both -= np.outer(way, both[i])
    return both[:, n:]


def _times(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (a * x).sum(axis=1)


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, *, close: float = 1e-4) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often to use each, so that every demand is met with the fewest sequences.

    It stops where the bounds (of the prices, and of the pieces' total length) lie within ``close`` of what is used, or
    within half a sequence, as counts are rounded anyway.
    """
    least = float((sizes * demand).sum()) / room
    basis = _first_columns(sizes, demand, room)
    inverse, columns = _inverse(basis), list(basis.T)
    amount = np.maximum(_times(inverse, demand), 0)
    while True:
        worth, pattern = best_pattern(np.maximum(inverse.sum(axis=0), 0), sizes, room)
        used = float(amount.sum())
        if worth <= 1 + 1e-9 or used - max(least, used / worth) <= max(0.5, close * used):
            break
        way = _times(inverse, pattern)
        up = way > 1e-9
        ratio = np.where(up, amount / np.where(up, way, 1), np.inf)
        out = int(np.argmin(ratio))
        inverse[out] /= way[out]
        step = way.copy()
        step[out] = 0
        inverse -= np.outer(step, inverse[out])
        amount = np.maximum(_times(inverse, demand), 0)
        columns[out] = pattern
    return list(zip(columns, amount))


def plan_patterns(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (pieces of each size) with whole counts that hold every piece of the histogram."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(s)] for s in sizes], float)
    plan, rest = [], demand.astype(np.int64)
    for pattern, amount in column_generation(sizes, demand, room):
        whole = int(amount + 1e-6)
        if whole:
            plan.append(({int(sizes[i]): int(pattern[i]) for i in np.flatnonzero(pattern)}, whole))
            rest -= pattern * whole
    bins: list[tuple[int, dict[int, int]]] = []
    for size, n in sorted(zip(sizes.tolist(), rest.tolist()), reverse=True):
        for _ in range(max(0, n)):
            at = next((i for i, (free, _) in enumerate(bins) if free >= size), None)
            if at is None:
                bins.append((room, {}))
                at = len(bins) - 1
            free, held = bins[at]
            bins[at] = free - size, held | {size: held.get(size, 0) + 1}
    return plan + [(held, 1) for _, held in bins]


def _slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end, first sequence, pieces in each sequence) of each pattern's share of a class."""
    rows, used, first = [], {}, 0
    for pattern, times in plan:
        for size, each in pattern.items():
            begin = used.get(size, 0)
            used[size] = begin + each * times
            rows.append((size, begin, used[size], first, each))
        first += times
    return rows


def packed(pieces: DataFrame, *, most: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, start, length and more) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    size = F.ceil(F.col("length") / GRAIN).cast("int")
    pieces = stored(pieces.withColumn("size", size), "pieces")
    histogram = {r["size"]: r["n"] for r in pieces.groupBy("size").agg(F.count("*").alias("n")).collect()}  # most / GRAIN rows
    slots = _slots(plan_patterns(histogram, most // GRAIN))
    slots = spark.createDataFrame(slots, "size int, low long, high long, first long, each long")
    groups = F.array(*(F.lit(max(1, -(-histogram.get(c, 0) // GROUP))) for c in range(most // GRAIN + 1)))
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), groups[F.col("size")])
    salted = pieces.withColumn("salt", salt.cast("int"))
    counts = salted.groupBy("size", "salt").agg(F.count("*").alias("n"))
    upto = running_total(counts, ["size", "salt"], F.col("n"), "upto")  # by ranges: no task holds the groups of a class
    ahead, first = 0, [0] * (most // GRAIN + 1)
    for c in sorted(histogram):
        first[c], ahead = ahead, ahead + histogram[c]
    base = F.col("upto") - F.col("n") - F.array(*(F.lit(x).cast("long") for x in first))[F.col("size")]
    base = stored(upto.select("size", "salt", base.alias("base")), "ranks")
    within = F.row_number().over(Window.partitionBy("size", "salt").orderBy("doc_id", "start", "ids_crc32"))
    rank = (F.col("base") + F.col("row") - 1).alias("rank")
    ranked = salted.withColumn("row", within).join(base, ["size", "salt"]).select(*pieces.columns, rank)
    # The slots' number is bounded by the classes: 2 * most / GRAIN patterns of as many classes at most.
    slots = F.broadcast(slots.withColumnRenamed("size", "of"))
    fits = (F.col("size") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(slots, fits).withColumn("sequence_id", F.expr("first + (rank - low) div each"))
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(ahead), F.lit(0)).alias("offset")
    return placed.select(*(c for c in pieces.columns if c != "size"), "sequence_id", offset)


def sequences(placed: DataFrame, *, most: int = 2048, pad_id: int = END_ID) -> DataFrame:
    """The token ids of each sequence, padded to ``most`` unless its length is a power of two; needs ``ids``."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for parts in batch["parts"]:
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4")
                full = len(ids) if len(ids) & (len(ids) - 1) == 0 else most
                rows.append(np.concatenate([ids, np.full(full - len(ids), pad_id, "<u4")]).astype(np.int32))
            yield pd.DataFrame({"sequence_id": batch["sequence_id"], "input_ids": rows})

    grouped = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.mapInPandas(join, "sequence_id long, input_ids array<int>")


def pack(docs: DataFrame, **options) -> DataFrame:
    return packed(tokenised(docs, **options), most=options.get("most", 2048))
