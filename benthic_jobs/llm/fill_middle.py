"""Fill-in-the-middle documents, assembled by a secondary sort.

A text is cut into units (a word with the white space before it; white space at the end is a unit of its own). Two numbers
from a seeded hash of the id choose where the prefix and the middle end; two more choose the form. What goes on from there
are pieces, some units of one part of one document each, keyed by document and by their place in the output. The pieces
are dealt by document and sorted within partitions by place, so that every document passes as a stream: each piece goes into the
digest of the output and on as pieces of the restored text, which are found at the marks in that stream alone. The same
partitions are sorted again, by place in the text, and stream into the digest of the restored text. No task holds a
document's pieces together, so neither its length nor its number of pieces matters.

Null texts are empty, and an empty text is plain. A null id is hashed as an empty string and stays null. Rows that are alike in id
and text give a row each: they are counted, not sorted side by side, and are dealt over the partitions by a number from
their batch. Of the documents nothing but the id and the text is read; ids of any type that has a text form stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import word_ends

#: The marks, and the place in the text of the part that each begins.
MARKS = {b"<P>": 0, b"<M>": 1, b"<S>": 2}
_MARK = re.compile(b"<[PSM]>")
#: Units in a piece, and bytes after which a piece of longer units is cut.
UNITS, BYTES = 512, 1 << 16
#: Bytes of pieces that leave a task in one batch, about.
BATCH = 8 << 20
_LAST = 3  # the place, after all parts, of the row that ends a document

_PIECES = [
    ("key", "binary"), ("salt", "int"), ("at", "long"), ("piece", "binary"), ("n", "long"), ("form", "string"), ("prefix_chars", "long"),
    ("middle_chars", "long"),
]
_BACK = [
    ("key", "binary"), ("salt", "int"), ("part", "int"), ("seq", "long"), ("piece", "binary"), ("copies", "long"), ("n", "long"), ("form", "string"),
    ("prefix_chars", "long"), ("middle_chars", "long"), ("output_sha256", "string"),
]
_TOLD = [("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"), ("output_sha256", "string"), ("restored_sha256", "string")]
_ARROW = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _schema(doc_id: T.DataType, fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField("doc_id", doc_id)] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])


class _Rows:
    """Rows on their way out: ids as Arrow values of the batches they came in, the rest as lists."""

    def __init__(self, fields: list[tuple[str, str]]) -> None:
        self.fields, self.ids, self.rows, self.bytes = fields, [], [], 0

    def add(self, doc_id: pa.Array, row: tuple, size: int = 0) -> None:
        self.ids.append(doc_id)
        self.rows.append(row)
        self.bytes += size + 64

    def full(self) -> bool:
        return self.bytes >= BATCH

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*self.rows), self.fields)]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(self.ids), *columns], ["doc_id", *(n for n, _ in self.fields)])
        self.ids, self.rows, self.bytes = [], [], 0


def numbers(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of the seed and the id's decimal text."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(told, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def planned(docs: DataFrame, *, text_col: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, text as bytes, a key of both, the numbers of the two cuts and the form: ``rate`` of 100 documents are
    rearranged, ``spm`` of 100 of those with the suffix first. A text that contains a mark stays plain."""
    h1, h2, h3, h4 = numbers(F.col("doc_id"), seed)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | text.contains(mark.decode())
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    told = F.concat(F.col("doc_id").isNull().cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), text)
    return docs.select(
        "doc_id", text.cast("binary").alias("text"), F.unhex(F.md5(told)).alias("key"), h1.alias("h1"), h2.alias("h2"), form.alias("form")
    )


def _chars(raw: np.ndarray) -> int:
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _cut(raw: bytes, ends: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """Units ``first`` to ``last`` in pieces."""
    for u in range(first, last, UNITS):
        begin, end = int(ends[u - 1]) if u else 0, int(ends[min(u + UNITS, last) - 1])
        for at in range(begin, end, BYTES):
            yield raw[at : min(at + BYTES, end)]


def _pieces_of(raw: bytes, form: str, h1: int, h2: int) -> tuple[list[bytes], int, int | None, int | None]:
    """The output in pieces, the number of units, and the characters of prefix and middle."""
    view = np.frombuffer(raw, np.uint8)
    ends = word_ends(view)
    n = len(ends)
    if form == "plain":
        return list(_cut(raw, ends, 0, n)), n, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    lo, hi = (int(ends[u - 1]) if u else 0 for u in (a, b))
    parts = {b"<P>": (0, a), b"<M>": (a, b), b"<S>": (b, n)}
    out = []
    for mark in (b"<S>", b"<P>", b"<M>") if form == "spm" else (b"<P>", b"<S>", b"<M>"):
        held = list(_cut(raw, ends, *parts[mark]))
        out += [mark + held[0], *held[1:]] if held else [mark]
    return out, n, _chars(view[:lo]), _chars(view[lo:hi])


def pieces(docs: DataFrame, **options) -> DataFrame:
    """The pieces of every output, each with its document and its place (``at``, bytes before it); what is known of a
    document stands in its first piece."""
    plan = planned(docs, **options)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECES)
        for batch in batches:
            ids, seen = batch.column(0), {}
            for i, (raw, key, h1, h2, form) in enumerate(zip(*(batch.column(c) for c in range(1, 6)))):
                raw, key, form = raw.as_py(), key.as_py(), form.as_py()
                salt = seen[key] = seen.get(key, -1) + 1
                held, n, prefix, middle = _pieces_of(raw, form, h1.as_py(), h2.as_py())
                at = 0
                for piece in held or [b""]:
                    told = (n, form, prefix, middle) if at == 0 else (None,) * 4
                    out.add(ids.slice(i, 1), (key, salt, at, piece, *told), len(piece))
                    at += len(piece)
                    if out.full():
                        yield from out.take()
            yield from out.take()

    return plan.mapInArrow(cut, _schema(docs.schema["doc_id"].dataType, _PIECES))


def assembled(docs: DataFrame, **options) -> DataFrame:
    """The pieces of each output next to each other and in order: dealt by document, sorted within partitions by place."""
    return pieces(docs, **options).repartition("key", "salt").sortWithinPartitions("key", "salt", "at")


class _Document:
    """A document as it passes: the digest of its output, and its pieces as they belong to the text."""

    def __init__(self, doc_id: pa.Array, key: bytes, salt: int, told: tuple) -> None:
        self.doc_id, self.key, self.salt, self.told = doc_id, key, salt, told
        self.copies, self.at, self.seq, self.held = 0, -1, 0, b""
        self.part = 0 if told[1] == "plain" else -1
        self.digest = hashlib.sha256()

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        self.digest.update(piece)
        if self.told[1] == "plain":
            yield 0, piece
            return
        data, at = self.held + piece, 0
        for mark in _MARK.finditer(data):
            if mark.start() > at:
                yield self.part, data[at : mark.start()]
            self.part, at = MARKS[mark[0]], mark.end()
        tail = data[at:]  # its last bytes may begin a mark that the next piece ends
        keep = 2 if tail[-2:] in (b"<P", b"<M", b"<S") else int(tail.endswith(b"<"))
        self.held = tail[len(tail) - keep :]
        if len(tail) > keep:
            yield self.part, tail[: len(tail) - keep]

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.held:
            yield self.part, self.held


def read_back(outputs: DataFrame) -> DataFrame:
    """A row for each document: its units, form and parts, the digest of its output as assembled, and the digest of the text
    that is restored from that output and the form."""
    kind = outputs.schema["doc_id"].dataType

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, doc = _Rows(_BACK), None

        def send(doc: _Document, found: Iterator[tuple[int, bytes]]) -> None:
            for part, piece in found:
                out.add(doc.doc_id, (doc.key, doc.salt, part, doc.seq, piece, *(None,) * 6), len(piece))
                doc.seq += 1

        def end(doc: _Document | None) -> None:
            if doc:
                send(doc, doc.rest())
                out.add(doc.doc_id, (doc.key, doc.salt, _LAST, doc.seq, None, doc.copies, *doc.told, doc.digest.hexdigest()))

        for batch in batches:
            ids = batch.column(0)
            for i, (key, salt, at, piece, *told) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(1, 9)))):
                if doc is None or (key, salt) != (doc.key, doc.salt):
                    end(doc)
                    doc = _Document(ids.slice(i, 1), key, salt, tuple(told))
                doc.copies += at == 0
                if at > doc.at:  # else a piece of a copy
                    doc.at = at
                    send(doc, doc.feed(piece))
                if out.full():
                    yield from out.take()
        end(doc)
        yield from out.take()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Rows(_TOLD), hashlib.sha256()
        for batch in batches:
            ids = batch.column(0)
            for i, (part, piece, copies, *told) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 5, 6, 7, 8, 9, 10, 11)))):
                if part == _LAST:
                    for _ in range(copies):
                        out.add(ids.slice(i, 1), (*told, digest.hexdigest()))
                        if out.full():
                            yield from out.take()
                    digest = hashlib.sha256()
                else:
                    digest.update(piece)
            yield from out.take()

    back = outputs.mapInArrow(stream, _schema(kind, _BACK))
    again = back.sortWithinPartitions("key", "salt", "part", "seq")  # the documents are where they were
    return again.mapInArrow(restore, _schema(kind, _TOLD))


def texts(outputs: DataFrame) -> DataFrame:
    """doc_id, form and the whole output of each document, for those who want it as one value."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, last = _Rows([("form", "string"), ("output", "string")]), [], None

        def end() -> None:
            if last:
                whole = b"".join(held).decode()
                for _ in range(last[4]):
                    out.add(last[0], (last[3], whole), len(whole))

        for batch in batches:
            ids = batch.column(0)
            for i, (key, salt, at, piece, form) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3, 4, 6)))):
                if last is None or last[1:3] != [key, salt]:
                    end()
                    held, last = [], [ids.slice(i, 1), key, salt, form, 0, -1]
                last[4] += at == 0
                if at > last[5]:
                    held.append(piece)
                    last[5] = at
                if out.full():
                    yield from out.take()
        end()
        yield from out.take()

    return outputs.mapInArrow(join, _schema(outputs.schema["doc_id"].dataType, [("form", "string"), ("output", "string")]))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS k1, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS k2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, coalesce(array_to_string(w[1:least(k1, k2)], ''), '') AS prefix,
         coalesce(array_to_string(w[least(k1, k2) + 1:greatest(k1, k2)], ''), '') AS middle,
         coalesce(array_to_string(w[greatest(k1, k2) + 1:n], ''), '') AS suffix FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
