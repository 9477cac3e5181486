"""Audio columns: chroma fingerprints and their alignment.

A recording (16-bit samples) becomes frames of twelve pitch-class energies; an integral image over the frames
makes every box sum four reads, and sixteen box-difference filters, each with two bits, pack a window of frames into
one 32-bit integer. An offset at which two integers differ in at most ``NEAR`` bits is a candidate, and all candidates
with an overlap of at least ``OVERLAP`` integers (the whole of a shorter recording) are judged by the share of bits that
differ over the overlap. Two recordings are aligned by the offset with the least share; ties: the longest overlap, then
the least offset.

Search: a stated query set against all recordings. Equal fingerprints are one row on both sides. Queries come in
blocks of at most about ``BLOCK`` fingerprints and ``INTEGERS`` integers, each a job with an inverted index that is broadcast; every recording looks its integers up. The index
has a table for each byte of an integer, keyed by the other three: of integers that differ in two bits at most, the lowest
byte that differs is left out, and of the rest one bit differs at most, in a higher byte, which is flipped for the lookup.
Bit errors are summed some words at a time, and an offset is given up once it has more than allowed. Nothing is capped: an integer that many queries share is a candidate for all of them, and recordings of any length are
compared whole, a million integers at a time. Ties between queries go to the least id.

Null and too short recordings have no fingerprint, no match and are classes of their own. Repeated rows share a
class and each has its own row; a null id stays null and is its own class's last resort. Columns but the id and the
samples are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import new_dir, slices, stored

RATE, FRAME, HOP, WINDOW = 4000, 1024, 256, 12
#: Fingerprints and integers of a block of queries, about; an index takes some 80 bytes an integer.
BLOCK, INTEGERS = 10_000, 500_000
NEAR, OVERLAP = 2, 16
#: Bytes of sound whose images are packed together.
SOUND = 1 << 22
#: Pairs of integers that are compared at a time, and integers that are looked up at a time.
STEP, CHUNK = 1_000_000, 1024
#: Integers of an overlap that are compared for all offsets together; longer ones go on by themselves.
LONG = 256
#: Of the differences' distribution, where the two-bit steps lie (their Gray code is packed).
STEPS = (-0.12, 0.0, 0.12)


@cache
def _classes(rate: int) -> np.ndarray:
    """Which pitch class each frequency bin belongs to, as a 0/1 table; bins outside 80-1800 Hz to none."""
    hertz = np.fft.rfftfreq(FRAME, 1 / rate)
    inside = (hertz >= 80) & (hertz <= 1800)
    table = np.zeros((len(hertz), 12))
    pitch = np.round(12 * np.log2(hertz[inside] / 440)).astype(int) % 12
    table[np.flatnonzero(inside), pitch] = 1
    return table


@cache
def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, classes, frames): kinds in turn, positions and sizes by rule."""
    return [(i % 4, 3 * i % 11, 2 + i % (12 - 3 * i % 11) if 3 * i % 11 < 10 else 1, WINDOW - 2 * (i // 4)) for i in range(16)]


@cache
def _taper() -> np.ndarray:
    return np.hanning(FRAME).astype(np.float32)


def chroma(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    """Frames by twelve pitch classes, each frame of unit length (silence stays zero)."""
    n = (len(samples) - FRAME) // HOP + 1
    if n <= 0:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(np.float32), FRAME)[::HOP] * _taper()
    energy = np.abs(np.fft.rfft(frames, axis=1)) ** 2 @ _classes(rate)
    return energy / np.maximum(np.linalg.norm(energy, axis=1, keepdims=True), 1e-9)


def _integers(images: np.ndarray) -> np.ndarray:
    """One unsigned 32-bit integer for each window of ``WINDOW`` frames, for images of equal length (image, frame, class)."""
    n = images.shape[1] - WINDOW + 1
    whole = np.zeros((len(images), images.shape[1] + 1, 13))
    whole[:, 1:, 1:] = images.cumsum(axis=1).cumsum(axis=2)

    def box(a: int, z: int, low: int, high: int) -> np.ndarray:
        return whole[:, z : z + n, high] - whole[:, a : a + n, high] - whole[:, z : z + n, low] + whole[:, a : a + n, low]

    out = np.zeros((len(images), n), np.uint32)
    for kind, low, height, width in _filters():
        high, mid, half = min(12, low + height), low + max(1, min(12, low + height) - low) // 2, width // 2
        every = box(0, width, low, high)
        part = {
            0: lambda: box(0, half, low, high),  # earlier against later
            1: lambda: box(0, width, low, mid),  # lower against higher classes
            2: lambda: box(0, half, low, mid) + box(half, width, mid, high),  # the diagonals
            3: lambda: box(width // 4, width - width // 4, low, high),  # the middle against the ends
        }[kind]()
        ratio = np.log((1 + part) / (1 + every - part))
        step = np.searchsorted(np.array(STEPS), ratio)
        out = (out << np.uint32(2)) | (step ^ (step >> 1)).astype(np.uint32)
    return out


def fingerprint(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    """One unsigned 32-bit integer for each window of ``WINDOW`` frames."""
    image = chroma(samples, rate)
    return _integers(image[None])[0] if len(image) >= WINDOW else np.zeros(0, np.uint32)


def fingerprints(recordings: DataFrame, id_col: str = "recording_id", pcm_col: str = "pcm", rate: int = RATE) -> DataFrame:
    """(id, fingerprint) from little-endian 16-bit samples."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            sound, out = [x or b"" for x in batch], np.full(len(batch), None, object)
            for part in slices([len(x) for x in sound], SOUND):
                images = [chroma(np.frombuffer(x, "<i2"), rate) for x in sound[part]]
                sizes = np.array([len(x) for x in images])
                for n in np.unique(sizes[sizes >= WINDOW]):
                    same = np.flatnonzero(sizes == n)
                    for i, row in zip(part.start + same, _integers(np.stack([images[j] for j in same]))):
                        out[i] = row.tobytes()
            yield pd.Series(out, dtype=object)

    return recordings.select(F.col(id_col).alias("recording_id"), run(F.col(pcm_col)).alias("fingerprint"))


def align(query: np.ndarray, other: np.ndarray) -> tuple[int, int, float] | None:
    """(offset, integers that differ in at most ``NEAR`` bits, share of differing bits), or null without a candidate."""
    near = np.argwhere(np.bitwise_count(query[:, None] ^ other[None, :]) <= NEAR)
    found = []
    for offset, votes in zip(*np.unique(near[:, 1] - near[:, 0], return_counts=True)):
        a, z = max(0, -offset), min(len(query), len(other) - offset)
        if z - a >= min(OVERLAP, len(query), len(other)):
            bits = np.bitwise_count(query[a:z] ^ other[a + offset : z + offset]).sum(dtype=np.int64)
            found.append((float(bits / (32 * (z - a))), int(a - z), int(offset), int(votes)))
    if not found:
        return None
    errors, _, offset, votes = min(found)
    return offset, votes, errors


def _words(integers: np.ndarray) -> np.ndarray:
    """Each integer with the next one, as a 64-bit word; after the last integer comes zero."""
    return integers.astype(np.uint64) | np.append(integers[1:], np.zeros(1, np.uint32))[: len(integers)].astype(np.uint64) << np.uint64(32)


#: Of the first, second, ... word of eight integers: what counts where only so many integers do.
_MASKS = [np.array([(1 << 32 * min(2, max(0, n - 2 * i))) - 1 for n in range(8)], np.uint64) for i in range(4)]


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Distinct numbers of at least zero, sorted; ``np.unique`` hashes, which is slower."""
    numbers.sort()
    return numbers[np.flatnonzero(np.diff(numbers, prepend=-1))]


class _Index:
    """Inverted index of a block of query fingerprints."""

    def __init__(self, queries: list[tuple[int, int, bytes]]) -> None:
        self.ids = np.array([q[0] for q in queries])
        self.rows = np.array([q[1] for q in queries])
        prints = [np.frombuffer(q[2], np.uint32) for q in queries]
        self.flat = np.concatenate(prints)
        self.words = _words(self.flat)
        self.size = np.array([len(p) for p in prints])
        self.begin = np.cumsum(self.size) - self.size
        self.query = np.repeat(np.arange(len(queries), dtype=np.int32), self.size)
        self.bits = max(16, len(self.flat).bit_length() + 1)
        self.tables = []
        for byte in range(4):
            bucket = self._bucket(self.flat & ~np.uint32(255 << 8 * byte))
            starts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=1 << self.bits))])
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            self.tables.append((starts.astype(np.int32), order, self.flat[order]))

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint32(0x9E3779B1) >> np.uint32(32 - self.bits)).astype(np.int64)

    def _near(self, others: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in ``others``, place in the index) of integers that differ in at most ``NEAR`` bits; some more than once."""
        for first in range(0, len(others), CHUNK):
            chunk = others[first : first + CHUNK]
            for byte, (starts, order, integers) in enumerate(self.tables):
                flips = np.array([0, *(1 << bit for bit in range(8 * byte + 8, 32))], np.uint32)
                bucket = self._bucket((chunk & ~np.uint32(255 << 8 * byte))[:, None] ^ flips).ravel()
                begin = starts[bucket]
                n = starts[bucket + 1] - begin
                some = np.flatnonzero(n)
                begin, n, place = begin[some], n[some], some // len(flips)
                for step in slices(n.tolist(), STEP) if n.sum(dtype=np.int64) > STEP else (slice(None),):
                    m = n[step]
                    slot = np.arange(m.sum(dtype=np.int64)) + np.repeat(begin[step] - (np.cumsum(m) - m), m)
                    near = np.flatnonzero(np.bitwise_count(integers[slot] ^ np.repeat(chunk[place[step]], m)) <= NEAR)
                    yield first + np.repeat(place[step], m)[near], order[slot[near]]

    def _bits(self, others: np.ndarray, mine: np.ndarray, other: np.ndarray, length: np.ndarray, least: float) -> np.ndarray:
        """Bits that differ in ``length`` integers from ``mine`` (index) and ``other`` on; where they are too many, of some of them."""
        words, limit, eights = _words(others), least * 32 * length + 1, length // 8 * 8
        bits, left, done = np.zeros(len(length), np.int64), np.flatnonzero(eights), 0
        a, b, most, end, some = mine[left], other[left], limit[left], eights[left], bits[left]
        while len(left) and done < LONG:
            for i in (done, done + 4):
                one = np.bitwise_count(self.words[i:].take(a) ^ words[i:].take(b))
                some += one + np.bitwise_count(self.words[i + 2 :].take(a) ^ words[i + 2 :].take(b))
            done += 8
            bits[left] = some
            go = np.flatnonzero((some <= most) & (end > done))
            left, a, b, most, end, some = (x[go] for x in (left, a, b, most, end, some))
        for j in left:  # longer than LONG
            at = done
            while at < eights[j] and bits[j] <= limit[j]:
                n = min(STEP, eights[j] - at)
                bits[j] += np.bitwise_count(self.flat[mine[j] + at : mine[j] + at + n] ^ others[other[j] + at : other[j] + at + n]).sum(dtype=np.int64)
                at += n
        left = np.flatnonzero((bits <= limit) & (length > eights))
        a, b, rest = (mine + eights)[left], (other + eights)[left], (length - eights)[left]
        for i in range(4):  # what eight integers at a time leave over
            both = self.words.take(a + 2 * i, mode="clip") ^ words.take(b + 2 * i, mode="clip")
            bits[left] += np.bitwise_count(both & _MASKS[i].take(rest))
        return bits

    def matches(self, others: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(recording, query, offset, bit errors) of every query that aligns with a recording with at most ``least`` bit errors.

        Recordings are numbered as they come; rows are sorted by recording and query.
        """
        sizes = np.array([len(x) for x in others], np.int64)
        start, flat = np.cumsum(sizes) - sizes, np.concatenate(others)
        of, span, low = np.repeat(np.arange(len(others)), sizes), 1 << 24, len(self.ids).bit_length()
        found, waiting = [np.zeros(0, np.int64)], 0
        for at, hit in self._near(flat):
            query, recording = self.query[hit], of[at]
            offset = at - start[recording] - (hit - self.begin[query])
            found.append((recording << low | query) * span + (offset + span // 2))
            waiting += len(hit)
            if waiting > max(STEP, len(found[0])):
                found, waiting = [_distinct(np.concatenate(found))], 0
        both = _distinct(np.concatenate(found))
        pair, offset = both >> 24, (both & span - 1) - span // 2
        recording, query = pair >> low, pair & (1 << low) - 1
        first = np.maximum(0, -offset)
        length = np.minimum(self.size[query], sizes[recording] - offset) - first
        keep = np.flatnonzero(length >= np.minimum(OVERLAP, np.minimum(self.size[query], sizes[recording])))
        pair, recording, query, offset, first, length = (x[keep] for x in (pair, recording, query, offset, first, length))
        bits = self._bits(flat, self.begin[query] + first, start[recording] + first + offset, length, least)
        errors = bits / (32 * length)
        good = np.flatnonzero(errors <= least)
        order = good[np.lexsort((offset[good], -length[good], errors[good], pair[good]))]
        best = order[np.flatnonzero(np.diff(pair[order], prepend=-1))]
        return recording[best], query[best], offset[best], errors[best]

    def best(self, others: list[np.ndarray], least: float) -> Iterator[tuple[int, int, tuple[float, int, int]]]:
        """(recording, matching query rows, best of (bit errors, id, offset)) of every recording that has a match."""
        for part in slices([len(x) for x in others], CHUNK):
            recording, query, offset, errors = self.matches(others[part], least)
            order = np.lexsort((offset, self.ids[query], errors, recording))
            heads = np.flatnonzero(np.diff(recording, prepend=-1))
            rows = np.add.reduceat(self.rows[query], heads) if len(heads) else heads
            for n, i in zip(rows, order[heads]):
                yield part.start + int(recording[i]), int(n), (float(errors[i]), int(self.ids[query[i]]), int(offset[i]))


def search(prints: DataFrame, is_query: Column, *, least: float = 0.2) -> DataFrame:
    """Each recording with its class of equal fingerprints and what it has among the queries.

    ``class_id``: the least id with the same fingerprint. ``n_matches``: the query recordings, but for the row itself,
    that align with at most ``least`` bit errors. ``best_id``, ``best_offset``, ``bit_errors``: the best class of queries
    (its least query id), by bit errors and id; a query row may find its own class.
    """
    spark = prints.sparkSession
    prints = stored(prints.withColumn("is_query", is_query), "prints")
    known = prints.where(F.col("fingerprint").isNotNull())
    query_id = F.when(F.col("is_query"), F.col("recording_id"))
    classes = known.groupBy("fingerprint").agg(
        F.min("recording_id").alias("class_id"), F.min(query_id).alias("query_id"), F.count(query_id).alias("rows")
    )
    classes = stored(classes.withColumn("key", F.sha2("fingerprint", 256)), "classes")  # ids may be null, and stay out of Python
    queries = classes.where("rows > 0").select("query_id", "rows", "fingerprint")
    size = queries.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("fingerprint") / 4), F.lit(0.0)).alias("integers")).first()
    blocks = max(1, -(-size["n"] // BLOCK), -(-int(size["integers"]) // INTEGERS))
    queries = stored(queries.withColumn("block", F.pmod(F.xxhash64("fingerprint"), F.lit(blocks))), "queries")
    schema = "key string, matches long, best struct<bit_errors:double,id:long,offset:int>"
    path = new_dir(spark, "matches")
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks):  # each block is a job of its own, whose matches are added to one table
        rows = [tuple(r) for r in queries.where(F.col("block") == b).drop("block").orderBy("query_id").collect()]
        if not rows:
            continue
        index = spark.sparkContext.broadcast(_Index([(r[0], r[1], bytes(r[2])) for r in rows]))  # about BLOCK fingerprints

        def vote(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = index.value.best([np.frombuffer(raw, np.uint32) for raw in batch["fingerprint"]], least)
                out = [(batch["key"].iat[i], n, dict(zip(("bit_errors", "id", "offset"), best))) for i, n, best in found]
                yield pd.DataFrame(out, columns=["key", "matches", "best"])

        classes.select("key", "fingerprint").mapInPandas(vote, schema).write.mode("append").parquet(path)
        index.unpersist()
    found = spark.read.schema(schema).parquet(path)
    best = found.groupBy("key").agg(F.sum("matches").alias("matches"), F.min("best").alias("best"))
    best = stored(classes.select("fingerprint", "class_id", "key").join(best, "key", "left").drop("key"), "best")
    own = F.when(F.col("is_query") & F.col("matches").isNotNull(), 1).otherwise(0)
    return prints.join(best, "fingerprint", "left").select(
        "recording_id", F.coalesce("class_id", "recording_id").alias("class_id"),
        F.greatest(F.coalesce("matches", F.lit(0)) - own, F.lit(0)).alias("n_matches"), F.col("best.id").alias("best_id"),
        F.col("best.offset").alias("best_offset"), F.col("best.bit_errors").alias("bit_errors"),
    )


def sonified(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", note: int = 256, rate: int = RATE) -> DataFrame:
    """Recordings made of vectors, a note for each value: test sound where a table has none."""

    def play(values: np.ndarray | None) -> bytes:
        v = np.nan_to_num(np.asarray(values if values is not None else [], float))
        semitone = np.floor(np.clip((v + 1) * 18, 0, 47)) if len(v) else v
        phase = np.cumsum(np.repeat(110 * 2 ** (semitone / 12), note)) * (2 * np.pi / rate)
        return (np.sin(phase) * 12000).astype("<i2").tobytes()

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([play(v) for v in batch], dtype=object)

    return vectors.select(F.col(id_col).cast("long").alias("recording_id"), run(F.col(vector_col)).alias("pcm"))
