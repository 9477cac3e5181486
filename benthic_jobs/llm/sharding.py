"""Sharding by bytes: sampled splitters deal documents into ranges, and shards are cut where the running size says.

Documents stand in one order, by a hash of the text and then of the id, so equal texts are neighbours and a group of copies,
however large, can be split by id. A table of (key, size) is drawn from: a key is drawn in proportion to its size, and quantiles
of the draw's weights are the boundaries of ranges of about equal bytes. The exact sizes of the ranges are then summed; a range of over
twice its share is divided by boundaries of a new draw from that range alone, again and again, until none is left that holds more than
one key. Ranges are what a task sorts; with their offsets every document knows the bytes and rows before it, so
``shard = floor((bytes before + half of its own) * shards / all bytes)`` is exact, whatever was drawn. Shards differ from equal sizes by
half a document at each end, and a document larger than a shard's share has one alone.

The documents move once, by range, with their texts, and are written by shard. The driver holds the boundaries (at most ``most_ranges``
and those of divided ranges) and the draw (``PER_RANGE`` for each range, about), neither of which grows with the rows beyond that.

A null text has no bytes, an empty one neither; both have the size ``extra``. A null id is hashed as an empty string. Rows with equal
id and text are rows of their own in one range, in any order (they are alike but for further columns, by which they are ordered
too). All columns of the documents, whatever their names, are written as they are, in one struct.
"""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import new_dir, stored

PER_RANGE = 32  # keys drawn for each range, about
TARGET = 64 << 20  # bytes of a range
SHARDS = 24


def order_key(text: Column, doc_id: Column) -> Column:
    """Equal texts are neighbours; within them the ids' hashes order."""
    told = lambda c: F.md5(F.coalesce(c.cast("string"), F.lit("")))
    return F.concat(told(text), told(doc_id))


def size_of(text: Column, extra: int) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + extra).cast("long")


def range_of(key: Column, boundaries: list[str]) -> Column:
    """The number of boundaries up to the key."""

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(boundaries, k) for k in keys], dtype="int32")

    return find(key) if boundaries else F.lit(0)


def _drawn(keys: DataFrame, rate: Column, seed: int) -> DataFrame:
    """(key, weight, range): keys drawn with a chance of size * rate, the weights being the bytes that each stands for."""
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), "key")), 1, 12), 16, 10).cast("long") / float(1 << 48)
    return keys.withColumn("rate", rate).where(u < F.col("size") * F.col("rate")).select("key", "range", F.greatest(F.col("size"), 1 / F.col("rate")).alias("weight"))


def _quantiles(drawn: list[tuple[str, float]], parts: int) -> list[str]:
    """Boundaries that cut the draw into ``parts`` of equal weight; a key that alone has a part's weight gets its own range."""
    weights: dict[str, float] = {}
    for key, weight in drawn:
        weights[key] = weights.get(key, 0.0) + weight
    part, upto, cuts = sum(weights.values()) / parts, 0.0, []
    for key in sorted(weights):
        if weights[key] >= part:
            cuts += [key, key + "0"]  # all keys have one length, so nothing else lies between the two
        elif (upto + weights[key]) // part > upto // part:
            cuts.append(key)
        upto += weights[key]
    return cuts


def splitters(keys: DataFrame, *, ranges: int, seed: int = 7) -> tuple[list[str], DataFrame]:
    """Boundaries of ranges of ``keys`` (key, size), none over twice its share unless it is one key, and each range's exact
    rows and bytes, with those before it."""
    spark = keys.sparkSession
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = max(1, -(-total // ranges))
    draw = _drawn(keys.withColumn("range", F.lit(0)), F.lit(float(PER_RANGE) / share), seed).collect()  # PER_RANGE a range
    boundaries = sorted(set(_quantiles([(r["key"], r["weight"]) for r in draw], ranges)))
    while True:
        placed = keys.withColumn("range", range_of(F.col("key"), boundaries))
        sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"))
        found = sorted(sums.collect(), key=lambda r: r["range"])  # a row for each range
        over = {r["range"]: r for r in found if r["bytes"] > 2 * share and r["low"] < r["high"]}
        if not over:
            break
        seed += 1
        draw = _drawn(placed.where(F.col("range").isin(list(over))), F.lit(float(PER_RANGE) / share), seed).collect()
        for number, r in over.items():
            own = [(d["key"], d["weight"]) for d in draw if d["range"] == number]
            inner = {k for k in _quantiles(own, -(-r["bytes"] // share)) if k > r["low"]}
            boundaries += inner or {r["high"]}  # at least its last key goes
        boundaries = sorted(set(boundaries))
    rows, bytes_before, rows_before = [], 0, 0
    for r in found:
        rows.append((r["range"], bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + r["bytes"], rows_before + r["rows"]
    return boundaries, spark.createDataFrame(rows, "range int, bytes_before long, rows_before long")


def _placed(keyed: DataFrame, boundaries: list[str], offsets: DataFrame, total: int, shards: int, ties: list[Column]) -> DataFrame:
    """``keyed`` (key, size and more) with ``shard`` and ``place``, the number of rows before it in the order of all."""
    ranged = keyed.withColumn("range", range_of(F.col("key"), boundaries)).join(F.broadcast(offsets), "range")  # a row for each range
    order = Window.partitionBy("range").orderBy("key", *ties).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("bytes_before") + F.sum("size").over(order)
    place = F.col("rows_before") + F.row_number().over(Window.partitionBy("range").orderBy("key", *ties)) - 1
    placed = ranged.withColumns({"upto": upto, "place": place})
    # The middle of a document, in whole numbers of any length.
    shard = F.expr(f"cast(2 * upto - size AS decimal(38, 0)) * {shards} div {2 * max(1, total)}")
    return placed.withColumn("shard", F.least(shard, F.lit(shards - 1)).cast("int"))


def write_shards(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, extra: int = 8, most_ranges: int = 10_000) -> str:
    """Writes every document into its shard and returns the folder: ``shard=N`` with the columns ``record`` (the document) and ``slot``."""
    spark = docs.sparkSession
    key, size = order_key(F.col(text_col), F.col(id_col)), size_of(F.col(text_col), extra)
    keys = stored(docs.select(key.alias("key"), size.alias("size")), "keys")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    boundaries, offsets = splitters(keys, ranges=min(max(shards, 2 * parallel, total // TARGET), max(shards, most_ranges)))
    first = _placed(keys, boundaries, offsets, total, shards, []).groupBy("shard").agg(F.min("place").alias("first"))
    first = {r["shard"]: r["first"] for r in first.collect()}  # a row for each shard
    firsts = F.array(*(F.lit(first.get(s, 0)).cast("long") for s in range(shards)))
    record = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record")
    told = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns if not docs.schema[c].dataType.simpleString().startswith(("map", "variant"))))
    whole = docs.select(key.alias("key"), size.alias("size"), told.alias("tie"), record)
    placed = _placed(whole, boundaries, offsets, total, shards, [F.col("tie")])
    path = new_dir(spark, "shards")
    slot = (F.col("place") - firsts[F.col("shard")]).alias("slot")
    placed.select("record", slot, "shard").write.partitionBy("shard").parquet(path)
    return path


def read_shards(spark: SparkSession, path: str, docs: DataFrame) -> DataFrame:
    """What was written: ``record`` (the columns of ``docs``), ``shard`` and ``slot``, gapless from 0 within a shard."""
    kind = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("record")).schema
    return spark.read.schema(kind.add("slot", T.LongType()).add("shard", T.IntegerType())).parquet(path)


def digest(written: DataFrame, *, extra: int = 8) -> DataFrame:
    """The figures of each document, from what was read back."""
    text = F.col("record.text")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return written.select(
        "record.doc_id", size_of(text, extra).alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: CRC-32 of blocks of 256 bytes by a table of (byte, zero bytes after it), then of the blocks by four of its entries.
ORACLE = """
WITH RECURSIVE s AS (
  SELECT i, CAST(i AS BIGINT) AS x, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM s WHERE k < 8),
t AS MATERIALIZED (SELECT i, x FROM s WHERE k = 8),
u AS (SELECT i, x, 0 AS z FROM t UNION ALL SELECT u.i, xor(u.x >> 8, t.x), z + 1 FROM u JOIN t ON t.i = u.x & 255 WHERE z < 255),
u1 AS MATERIALIZED (SELECT * FROM u),
w AS MATERIALIZED (SELECT list(x ORDER BY z, i) AS w FROM u1 WHERE z >= 252),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
e AS (SELECT r, n, j, substr(h, 512 * j + 1, 512) AS h FROM d, LATERAL (SELECT unnest(range((n + 255) // 256)) AS j)),
p AS (SELECT r, n, 256 * j + i AS i, (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1 AS b
  FROM e, LATERAL (SELECT unnest(range(length(h) // 2)) AS i)),
q AS (SELECT r, (n - 1 - p.i) // 256 AS block, bit_xor(x) AS c FROM p JOIN u1 ON u1.i = CASE WHEN p.i < 4 THEN xor(b, 255) ELSE b END AND z = (n - 1 - p.i) % 256 GROUP BY ALL),
l AS (SELECT r, list(c ORDER BY block DESC) AS c FROM q GROUP BY r),
c AS (SELECT r, list_reduce(c, lambda a, x: xor(x, xor(xor(w[769 + (a & 255)], w[513 + ((a >> 8) & 255)]), xor(w[257 + ((a >> 16) & 255)], w[1 + (a >> 24)])))) AS c FROM l, w),
k AS (SELECT d.r, doc_id, n + 8 AS size, xor(xor(coalesce(c, 0), CASE WHEN n < 4 THEN 4294967295 >> (8 * n) ELSE 0 END), 4294967295) AS crc,
             md5(text) || md5(CAST(doc_id AS VARCHAR)) AS key FROM d LEFT JOIN c ON c.r = d.r),
o AS (SELECT *, sum(size) OVER (ORDER BY key, r) AS upto, sum(size) OVER () AS total FROM k),
h AS (SELECT *, CAST(least(((2 * upto - size) * 24) // (2 * total), 23) AS INT) AS shard FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, r) - 1 AS slot,
       CAST(NULL AS INT) AS grown_shard
FROM h
"""
