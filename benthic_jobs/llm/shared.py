"""What several operators of this subpackage need: tables in the shared folder and hashed words.

Every intermediate that is used twice is written to the folder that the session names in
``spark.checkpoint.dir`` and read back, so that a lost executor costs a re-read and no more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .. import storage

#: Of the 64-bit word hash: a random number for each byte at each of 64 places. They come from one fixed seed.
_PLACES = 64
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, _PLACES * 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)

#: ASCII white space, the separators of ``bytes.split()``.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Lower-cases A-Z, keeps digits, a-z and every byte of a non-ASCII character, blanks the rest.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def new_dir(spark: SparkSession, name: str) -> str:
    return storage.new_dir(spark, name, "benthic")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: it cuts the lineage."""
    return storage.stored(df, name, "benthic")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _scanned(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words without the white space between them, where each word begins, its size, and each text's bounds."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens + 1)
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begin = np.flatnonzero(first)
    bounds = np.concatenate([[0], np.searchsorted(begin, ends)]).astype(np.int64)
    packed = raw[solid]
    index = np.cumsum(solid, dtype=np.int64)[begin] - 1
    return packed, index, np.diff(np.append(index, len(packed))), bounds


def _hashes(packed: np.ndarray, index: np.ndarray, size: np.ndarray) -> np.ndarray:
    if not len(index):
        return np.zeros(0, np.uint64)
    place = np.arange(len(packed)) - np.repeat(index, size)
    value = _BYTES[(place % _PLACES) * 256 + packed]
    if size.max() > _PLACES:
        far = np.flatnonzero(place >= _PLACES)
        value[far] = mix(value[far] + (place[far] // _PLACES).astype(np.uint64) * _STEP)
    return mix(np.add.reduceat(value, index) + size.astype(np.uint64) * _STEP)


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, split at ASCII white space, and each text's bounds in them.

    Text i has the words ``hashes[bounds[i]:bounds[i + 1]]``; an empty text has none. A hash is a sum of random numbers
    that depend on both the byte and its place, so no structure within words makes two of them equal.
    """
    *words, bounds = _scanned(texts)
    return _hashes(*words), bounds


def numbered_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 of the words of all texts, equal where their bytes are equal, and each text's bounds in them."""
    packed, index, size, bounds = _scanned(texts)
    _, leader, number = np.unique(_hashes(packed, index, size), return_index=True, return_inverse=True)
    lead = leader[number]  # the first word of the same hash
    same = size == size[lead]
    if same.all() and len(size):
        shift = np.repeat(index[lead] - index, size)
        same = packed[np.arange(len(packed)) + shift] == packed
    if not same.all():
        words, seen = [packed[a : a + n].tobytes() for a, n in zip(index, size)], {}
        number = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    return number, bounds


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; the caller leaves out those that cross two texts."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out *= _STEP
        out += words[j : j + n]
    return mix(out)


def word_ends(raw: np.ndarray) -> np.ndarray:
    """Where each unit of a text's bytes ends: a word with the white space before it, or white space at the text's end."""
    solid = ~_SPACE[raw]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    if len(raw):
        last[-1] = True
    return np.flatnonzero(last) + 1


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``most``; a larger item stands alone."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield slice(begin, len(sizes))
