"""Lloyd's clustering with the dimensions dealt out: exact, and a task never sees more than a block of columns.

Vectors become whole numbers (floor of ``scale`` times each component) and are cut twice: into chunks of rows and into blocks
of columns. A shard is one block of one chunk. In each round the task of a shard computes exact squared partial distances of its
rows to its own slice of the centroids; ``reduceByKey`` adds the blocks of a chunk, and the least sum gives each row's cluster (ties: the
smaller number). The clusters of a chunk, a number for each row, go back to the chunk's shards, which sum their columns by cluster;
the sums of a block meet and give that block's new slice, the floor of sum / count. The shards are dealt once, by (block, chunk),
and stay where they are: a round moves ``k`` numbers a row and block, and one number a row and block back. A shard on a lost executor is read again
from the table of shards. The driver holds the centroids alone, ``k`` times ``dims`` numbers, both parameters.

Kept are vectors with exactly ``dims`` components, none null or not finite; others have no row. The first centroids are the ``k``
kept vectors with the smallest hash of seed and id (fewer if there are fewer); ties of the hash go by the vector. Ids may repeat or
be null (a null id is hashed as an empty string); repeated rows are vectors of their own. Components of any size are computed
exactly, as Python's integers where 64 bits could overflow; a distance or a sum that no 64-bit integer holds is null. Of the table
nothing but the id and the vector is read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Rows of a chunk.
ROWS = 2_048
#: Components up to this size are 64-bit integers: squares of differences, summed over 256 dimensions, fit.
_NARROW = 1 << 26
_SHARDS = "chunk long, block int, ids array<string>, wide boolean, numbers binary"
_ARROW = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("ids", pa.list_(pa.string())), ("wide", pa.bool_()), ("numbers", pa.binary())])

Slices = dict[int, np.ndarray]


def kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(id, x): the vectors that have exactly ``dims`` finite components."""
    infinite = lambda x: F.abs(x.cast("double")) == float("inf")
    whole = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x")).where(F.size("x") == dims)
    return whole.where(~F.exists("x", lambda x: x.isNull() | F.isnan(x) | infinite(x)))


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """The floor of ``scale`` times each component; Python's integers if one of them is large."""
    scaled = np.floor(x.astype(np.float64) * scale)
    if scaled.size == 0 or np.abs(scaled).max() <= _NARROW and x.shape[-1] <= 256:
        return scaled.astype(np.int64)
    return np.array([[_floor(v, scale) for v in row] for row in x.astype(np.float64)], dtype=object).reshape(x.shape)


def _floor(v: float, scale: int) -> int:
    top, bottom = float(v).as_integer_ratio()
    return top * scale // bottom


def _packed(numbers: np.ndarray) -> tuple[bool, bytes]:
    if numbers.dtype == object:
        return True, " ".join(map(str, numbers.ravel())).encode()
    return False, numbers.astype("<i8").tobytes()


def _unpacked(wide: bool, data: bytes, width: int) -> np.ndarray:
    flat = np.array([int(x) for x in bytes(data).split()], dtype=object) if wide else np.frombuffer(data, "<i8")
    return flat.reshape(-1, width)


def _bounds(dims: int, width: int) -> list[tuple[int, int]]:
    return [(a, min(a + width, dims)) for a in range(0, dims, width)]


def shards(vectors: DataFrame, *, dims: int, width: int, scale: int) -> DataFrame:
    """The table of shards; the ids of a chunk, as text, stand in its first block."""
    bounds = _bounds(dims, width)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_pylist()
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            for at in range(0, len(ids), ROWS):
                numbers = whole_numbers(flat[at : at + ROWS], scale)
                rows = [(chunk, b, ids[at : at + ROWS] if b == 0 else None, *_packed(numbers[:, lo:hi])) for b, (lo, hi) in enumerate(bounds)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
                chunk += 1

    return stored(vectors.select(F.col("id").cast("string"), "x").mapInArrow(cut, _SHARDS), "shards")


def first_centroids(vectors: DataFrame, *, k: int, seed: int, scale: int) -> np.ndarray:
    """The ``k`` vectors whose seeded hash is smallest, in that order."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(told.alias("h"), "x").orderBy("h", "x").limit(k).collect()  # k rows
    return whole_numbers(np.array([r["x"] for r in rows], np.float64), scale) if rows else np.zeros((0, 1), np.int64)


def _dealt(key: tuple[int, int] | int) -> int:
    return zlib.crc32(repr(key).encode())


def distances(numbers: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids, over the columns at hand."""
    if numbers.dtype != centroids.dtype:
        numbers, centroids = numbers.astype(object), centroids.astype(object)
    out = np.zeros((len(numbers), len(centroids)), numbers.dtype)
    for j, c in enumerate(centroids):
        out[:, j] = ((numbers - c) ** 2).sum(axis=1)
    return out


def _nearest(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    labels = np.argmin(total, axis=1).astype(np.int32)  # the first of equals
    return labels, total[np.arange(len(total)), labels]


def _assigned(dealt: RDD, slices: Slices, parts: int) -> RDD:
    """(chunk, (clusters, distances)) of all rows: partial distances of shards, added up by chunk."""
    partial = dealt.map(lambda kv: (kv[0][1], distances(kv[1], slices[kv[0][0]])))
    return partial.reduceByKey(lambda a, b: a + b, parts, _dealt).mapValues(_nearest)


def _sums(found: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one shard, the sum of the columns and the number of rows of each cluster."""
    labels, numbers = sorted(found, key=lambda x: x.ndim)  # one number a row, and one row of numbers a row
    out = np.zeros((k, numbers.shape[1]), numbers.dtype)
    for j in np.unique(labels):
        out[j] = numbers[labels == j].sum(axis=0)
    return out, np.bincount(labels, minlength=k)


def _moved(old: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A block's new slice: floors of means; a cluster without rows keeps its own."""
    new = old.astype(object if object in (old.dtype, sums.dtype) else np.int64)
    for j in np.flatnonzero(counts):
        new[j] = sums[j] // int(counts[j])
    return new


def _next_slices(dealt: RDD, slices: Slices, parts: int, k: int) -> Slices:
    blocks = list(slices)
    labels = _assigned(dealt, slices, parts).flatMap(lambda kv: [((b, kv[0]), kv[1][0]) for b in blocks]).partitionBy(parts, _dealt)
    # Both are dealt alike, so that no shard moves.
    own = dealt.union(labels).groupByKey(parts, _dealt).map(lambda kv: (kv[0][0], _sums(tuple(kv[1]), k)))
    sums = own.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(parts, len(blocks)), _dealt)
    return dict(sums.map(lambda kv: (kv[0], _moved(slices[kv[0]], *kv[1]))).collect())  # k * dims numbers


def _long(value: object) -> int | None:
    return int(value) if -(2**63) <= value < 2**63 else None


def cluster(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 8, rounds: int = 10,
    width: int = 16, scale: int = 1024, seed: int = 3,
) -> DataFrame:
    """Every kept vector's id (named ``id_col``), cluster, squared distance, ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType
    whole = kept(vectors, id_col, vector_col, dims)
    start = first_centroids(whole, k=k, seed=seed, scale=scale)
    table = shards(whole, dims=dims, width=width, scale=scale)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(dims, width)
    slices: Slices = {b: start[:, lo:hi] for b, (lo, hi) in enumerate(bounds)}
    widths = [hi - lo for lo, hi in bounds]
    read = table.select("chunk", "block", "wide", "numbers").rdd
    dealt = read.map(lambda r: ((r[1], r[0]), _unpacked(r[2], r[3], widths[r[1]]))).partitionBy(parts, _dealt).persist()
    parts = dealt.getNumPartitions()
    for _ in range(rounds if len(start) else 0):
        slices = _next_slices(dealt, slices, parts, len(start)) or slices
    found = _assigned(dealt, slices, parts) if len(start) else spark.sparkContext.emptyRDD()
    rows = found.map(lambda kv: (kv[0], kv[1][0].tolist(), [_long(x) for x in kv[1][1]]))
    found = spark.createDataFrame(rows, "chunk long, cluster array<int>, distance array<long>")
    named = found.join(table.where("block = 0").select("chunk", "ids"), "chunk")
    each = named.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("e"))
    each = stored(each.select(F.col("e.ids").cast(kind).alias("id"), "e.cluster", "e.distance"), "clusters")
    dealt.unpersist()

    total = F.when(F.count("distance") == F.count("*"), F.expr("try_cast(sum(cast(distance AS decimal(38, 0))) AS bigint)"))
    of_one = each.groupBy("cluster").agg(total.alias("cluster_inertia"))
    of_all = each.agg(total.alias("inertia"))
    finals = np.concatenate([slices[b] for b in range(len(bounds))], axis=1) if len(start) else start[:0]
    hashes = [(j, hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest()) for j, c in enumerate(finals)]
    hashes = spark.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    told = F.broadcast(of_one.join(F.broadcast(hashes), "cluster").crossJoin(F.broadcast(of_all)))  # k rows
    out = each.join(told, "cluster")
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(rounds: int = 10, k: int = 8, dims: int = 64) -> str:
    """All rounds as one statement."""
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda z: CAST(floor(1024 * CAST(z AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS INT) AS j, x FROM v QUALIFY j < {k})"]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, x, min(struct_pack(d := d, j := j)) AS m FROM
  (SELECT v.vec_id, v.x, c.j, CAST({distance} AS BIGINT) AS d FROM v, c{i} c) GROUP BY vec_id, x)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT j, list(z ORDER BY p) AS x FROM
  (SELECT j, p, (CAST(sum(z) AS BIGINT) - ((CAST(sum(z) AS BIGINT) % count(*)) + count(*)) % count(*)) // count(*) AS z FROM
    (SELECT m.j AS j, unnest(x) AS z, generate_subscripts(x, 1) AS p FROM a{i}) GROUP BY j, p) GROUP BY j) n ON n.j = c.j)""")
    last = f"""SELECT vec_id, m.j AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.j) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c ON c.j = m.j"""
    return "WITH " + ",\n".join(parts) + "\n" + last


ORACLE = oracle()
