"""WARC archives: written with an index, read back by coalesced byte ranges.

``write_archives`` writes one gzip member per record, so that each record can be read by itself, and returns
the index: a row per record with file, offset, length, URL and digest. ``read_records`` takes the index rows
of the records that are wanted, sorts them by file and offset, merges ranges with gaps of up to ``gap``
bytes and reads each merged range once.

Of records with equal payloads the one with the smallest key becomes a ``response``; the others become
``revisit`` records without payload that refer to it. Payloads under ``least`` bytes are all responses.
Null payloads are empty, null URLs become ``urn:key:<key>``. Rows that repeat the smallest key are all
responses. Payloads are compared by SHA-1, SHA-256 and length. A key may stand on pages of several payloads: each row
goes by its own payload. A page with a null key is a record with a random id; it repeats the smallest key of its
payload, and is a response where no page of that payload has a key. Keys are text wherever Python sees them, so that
none is rounded. Other columns of the pages are not read, whatever their names.

A task writes under a name of its own and the index names the file, so a task that is repeated after a lost
executor leaves at most a file that no index row names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_dir, stored

INDEX = "file string, offset long, length long, key string, url string, record_type string, digest string, refers_to string"
RECORD = "key string, url string, record_type string, refers_to string, digest string, payload binary"
#: Bytes of a merged range; a file's records are split there, so that no task reads a whole large archive.
RANGE = 8_000_000
#: Bytes of payloads that are handed on at a time; a larger one stands alone.
FRAME = 16_000_000
#: Bytes of archive that a task reads, about: index rows are small, so their own size says nothing.
TASK = 16_000_000


def _open_store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, key: str | None, url: str, payload: bytes, digest: str, refers_to: str | None, refers_url: str | None) -> bytes:
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{f'urn:key:{key}' if key else uuid.uuid4().urn}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:key:{refers_to}>", f"WARC-Refers-To-Target-URI: {refers_url}",
        ]
        block = http
    else:
        block = http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _key_of(record_id: str | None) -> str | None:
    return record_id[9:-1] if record_id and record_id.startswith("<urn:key:") else None


def _clean(url: str | None, key: str | None) -> str:
    return "".join(c for c in url if c >= " ") if url else f"urn:key:{key or ''}"


def _planned(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """Each page with the key and URL of the response that it repeats, or null."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), body.alias("body"))
    row = F.xxhash64("key", "url")  # rows of one key and URL are alike here: their payloads are compared below
    marks = {"row": row, "sha": F.sha1("body"), "sha256": F.sha2("body", 256), "size": F.octet_length("body")}
    by = ["sha", "sha256", "size"]
    same = stored(rows.withColumns(marks).drop("body").where(F.col("size") >= least), "payloads")
    named = F.when(F.col("key").isNotNull(), F.struct("key", "url"))
    groups = same.groupBy(*by).agg(F.count("*").alias("n"), F.min(named).alias("best")).where("n > 1 AND best IS NOT NULL")
    groups = stored(groups.select(*by, F.col("best.key").alias("refers_to"), F.col("best.url").alias("refers_url")), "groups")
    again = same.join(groups, by).where("NOT key <=> refers_to").select("row", *by, "refers_to", "refers_url").distinct()
    return rows.withColumns(marks).join(again, ["row", *by], "left").drop("row", *by)


def write_archives(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, path: str | None = None
) -> DataFrame:
    """Writes the archives under ``path`` (the shared folder if none is given) and returns their index."""
    spark = pages.sparkSession
    path = path or new_dir(spark, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, folder = _open_store(path)
        store.create_dir(folder, recursive=True)
        name, offset, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                rows = []
                for k, u, body, to, to_url in zip(*(batch[c] for c in ("key", "url", "body", "refers_to", "refers_url"))):
                    body, kind = bytes(body), "response" if to is None else "revisit"
                    digest, u = sha1_base32(body), _clean(u, k)
                    raw = _record(kind, k, u, body, digest, to, None if to is None else _clean(to_url, to))
                    raw = gzip.compress(raw, 3, mtime=0)
                    out = out or store.open_output_stream(f"{folder}/{name}", compression=None)
                    out.write(raw)
                    rows.append((f"{path}/{name}", offset, len(raw), k, u, kind, digest, to))
                    offset += len(raw)
                yield pd.DataFrame(rows, columns=[x.split()[0] for x in INDEX.split(", ")])
        finally:
            if out:
                out.close()

    planned = _planned(pages, key, url, payload, least)
    texts = planned.withColumns({c: F.col(c).cast("string") for c in ("key", "refers_to")})
    return stored(_numbers(texts.mapInPandas(write, INDEX)), "index")


def _numbers(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("long") for c in ("key", "refers_to")})


def read_records(index: DataFrame, *, gap: int = 65_536) -> DataFrame:
    """The selected records: key, url, record_type, refers_to, the digest they state and the payload."""

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: tuple = ()
        columns = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            runs: list[list] = []
            for file, offset, length in batch[["file", "offset", "length"]].itertuples(index=False):
                last = runs[-1] if runs else None
                near = last and last[0] == file and 0 <= offset - last[2] <= gap and offset + length - last[1] <= RANGE
                if near:
                    last[2] = offset + length
                    last[3].append((offset, length))
                else:
                    runs.append([file, offset, offset + length, [(offset, length)]])
            for file, begin, end, parts in runs:
                if not opened or opened[0] != file:
                    if opened:
                        opened[1].close()
                    store, at = _open_store(file)
                    opened = (file, store.open_input_file(at))
                data, rows, held = opened[1].read_at(end - begin, begin), [], 0
                for offset, length in parts:
                    fields, body = parse_record(gzip.decompress(data[offset - begin : offset - begin + length]))
                    if rows and held + len(body) > FRAME:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, held = [], 0
                    rows.append((
                        _key_of(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"],
                        _key_of(fields.get("warc-refers-to")), fields["warc-payload-digest"].removeprefix("sha1:"), body,
                    ))
                    held += len(body)
                yield pd.DataFrame(rows, columns=columns)
        if opened:
            opened[1].close()

    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // TASK))
    ordered = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset")
    return _numbers(ordered.sortWithinPartitions("file", "offset").mapInPandas(ranges, RECORD))


def digest(records: DataFrame) -> DataFrame:
    """Size and digest of each record's full payload; a revisit's are those of the response it refers to.

    A reference to a response that is not among the records is an error.
    """

    @F.pandas_udf("string")
    def sha(payloads: pd.Series) -> pd.Series:
        return pd.Series([sha1_base32(bytes(x)) for x in payloads], dtype=object)

    own = F.octet_length("payload").cast("long").alias("payload_bytes"), sha("payload").alias("payload_digest")
    measured = stored(records.select("key", "record_type", "refers_to", "digest", *own), "measured")
    responses = measured.where("record_type = 'response'").select(
        F.col("key").alias("refers_to"), "digest", F.col("payload_bytes").alias("full"), F.col("payload_digest").alias("sha")
    )
    revisits = measured.where("record_type = 'revisit'").select("key", "record_type", "refers_to", "digest")
    by = ["refers_to", "digest"]  # a key may have responses with several payloads
    named = revisits.select(*by).distinct()
    targets = stored(responses.join(named, by, "left_semi").dropDuplicates(by), "targets")
    lost = F.concat(F.lit("no response for the reference to "), F.col("refers_to").cast("string"))
    full = F.when(F.col("full").isNull(), F.raise_error(lost)).otherwise(F.col("full"))
    resolved = revisits.join(targets, by, "left").withColumn("full", full).select("key", "record_type", "refers_to", "full", "sha")
    both = measured.where("record_type = 'response'").drop("digest").unionByName(
        resolved.withColumnsRenamed({"full": "payload_bytes", "sha": "payload_digest"})
    )
    return both.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT html, min(page_id) AS best FROM p GROUP BY html),
g AS (
  SELECT r, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(h, 5 * (k // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31), 1), '' ORDER BY k) AS b32
  FROM p, range(32) AS t(k) GROUP BY r)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, b32 AS payload_digest,
       CASE WHEN best IS NULL OR p.page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM p JOIN f USING (html) JOIN g USING (r)
"""
