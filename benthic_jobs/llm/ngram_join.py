"""N-gram Jaccard self-join of documents by chosen paths.

A document is the set of its ``WORDS``-word shingles (a shorter one has one shingle: all of its words). Equal sets
become one row with a weight. A run descends a tree: at each level every set follows one of its own tokens, the one
that a hash function drawn for that run and level puts first, so that two sets stay together with the probability of
their similarity. A bucket of at most ``LIMIT`` sets is compared by brute force; larger ones are split again by
the next level's tokens. Runs repeat until a pair at the threshold is met with at least the probability ``recall``;
every pair that is met is verified on the whole sets.

Most buckets are small after ``LEVELS`` levels. The sets of those that are not, and of which a further token keeps no more
than ``DENSE`` together on average over ``PROBES`` of them (different texts with a passage in common), are split by as many
levels as that share asks for (``DEEP`` at most) instead, in as many more runs as keep the recall at that depth: a deeper
path costs runs, so only such sets pay for it, and each of them is shipped a bounded number of times, whatever the size
of the bucket it came from. Buckets that stop shrinking (near copies of one text, which all have to be counted) and
those still large after the last level are compared in blocks of ``LIMIT``, dealt over many tasks, so that no bucket is
cut or dropped.

A pair counts in the first run whose leaf it shares, so links add up without listing pairs. Buckets whose members
have all met in one earlier leaf are left out. Tasks return, for each set, its links' weight and one member of its
local component; alternating minimum labels and pointer jumps join these into classes.

Null, empty and wordless texts are classes of their own without links. Repeated rows are equal sets. Ids may repeat.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ALNUM, grams, hashed_words, mix, slices, stored

WORDS, LIMIT, LEVELS, DEEP = 5, 400, 2, 8
DENSE, PROBES = 0.7, 8
#: Rows of two keys (some 60 bytes each) that are broadcast at most.
BROADCAST = 100_000
STEP_BYTES, SHARD_BYTES = 4_000_000, 8_000_000


def runs_needed(threshold: float, recall: float, levels: int = LEVELS) -> int:
    """How many runs meet a pair at the threshold with the given probability, if every bucket is split to the end."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**levels)))


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace").translate(ALNUM) for t in texts]


def shingle_sets(texts: list[bytes], k: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for part in slices([len(t) for t in texts], STEP_BYTES):
        words, bounds = hashed_words(texts[part])
        every = grams(words, k)
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield np.unique(every[a : z - k + 1] if z - a >= k else grams(words[a:z], z - a) if z > a else every[:0])


def _row_key():
    ids = F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n"))
    return F.unhex(F.md5(F.concat_ws("|", ids, F.coalesce(F.col("text"), F.lit("")))))


def _signer(runs: int, levels: int, first_seed: int):
    """Of a text (and its row key) a digest of its set, its size and the chosen token of each run and level."""

    @F.pandas_udf("struct<set:binary,size:int,first:array<long>>")
    def sign(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        seeds = mix(np.arange(first_seed, first_seed + 2 * runs * levels, dtype=np.uint64))
        for texts, keys in batches:
            rows = []
            for key, own in zip(keys, shingle_sets(_bytes(texts))):
                first = []
                for i in range(0, len(seeds) if len(own) else 0, 2):
                    h = (own ^ seeds[i]) * (seeds[i + 1] | np.uint64(1))
                    first.append(int((h ^ (h >> np.uint64(29))).min()) >> 1)
                rows.append((hashlib.blake2b(own.tobytes() or bytes(key), digest_size=16).digest(), len(own), first))
            yield pd.DataFrame(rows, columns=["set", "size", "first"])

    return sign


def _paths(sets: DataFrame, runs: int, levels: int, first_run: int) -> DataFrame:
    """A row for each set and run, with the token of each level as p0, p1, ..."""
    token = lambda r, i: F.get("first", r * levels + i).alias(f"p{i}")
    every = F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.struct((r + first_run).alias("run"), *(token(r, i) for i in range(levels)))
    )
    return sets.select("set", F.inline(every))


def _split(rows: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Leaves (set, run, leaf, n) of up to ``LIMIT`` sets, and the rows of the buckets that are larger after all levels."""
    done = None
    for level in range(levels):
        key = F.xxhash64(F.lit(level), "run", *(f"p{i}" for i in range(level + 1)))
        rows = rows.withColumn("leaf", key)
        here = rows.join(stored(rows.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1"), "buckets"), "leaf")
        small = here.where(F.col("n") <= LIMIT).select("set", "run", "leaf", "n")
        done = small if done is None else done.unionByName(small)
        rows = stored(here.where(F.col("n") > LIMIT), "crowded")
        if level + 1 < levels:
            if rows.isEmpty():
                break
            rows = rows.drop("leaf", "n")
    return done, rows


def _meetings(sets: DataFrame, keyed: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Rows (set, run, leaf, n, leaves of the runs before) of the buckets that are not covered by an earlier leaf."""
    runs = runs_needed(threshold, recall)
    found, crowded = _split(_paths(sets.where("size > 0"), runs, LEVELS, 0), LEVELS)
    others = F.array(*(F.get("first", (F.col("run") + k) % runs * LEVELS) for k in range(1, PROBES + 1)))
    spread = crowded.join(sets.select("set", "first"), "set").select("leaf", "n", F.posexplode(others).alias("probe", "token"))
    spread = spread.groupBy("leaf", "probe", "token").agg(F.count("*").alias("most"), F.first("n").alias("n"))
    spread = spread.groupBy("leaf", "probe").agg(F.max("most").alias("most"), F.first("n").alias("n"))
    spread = spread.groupBy("leaf").agg((F.avg("most") / F.first("n")).alias("share"), F.first("n").alias("n"))
    more = F.when(F.col("share") <= DENSE, F.ceil(F.log(F.col("n") / LIMIT) / -F.log("share")))  # levels until it is small
    spread = stored(spread.select("leaf", (F.col("share") > DENSE).alias("dense"), more.alias("more")), "spread")
    crowded = crowded.join(spread.drop("more"), "leaf")
    found = stored(found.unionByName(crowded.where("dense").select("set", "run", "leaf", "n")), "found")
    hot = stored(crowded.where("NOT dense").select("set").distinct(), "hot")
    total = runs
    n_hot = hot.count()
    if n_hot:
        levels = min(DEEP, LEVELS + 1 + int(spread.agg(F.max("more")).first()[0]))
        deep = runs_needed(threshold, recall, levels)
        total += deep
        few = F.broadcast if n_hot <= BROADCAST else lambda rows: rows
        rows = stored(sets.select("set", "row_key").join(few(hot), "set"), "hot_rows")
        texts = keyed.join(few(rows), "row_key").dropDuplicates(["set"])
        sign = _signer(deep, levels, 1_000_001)
        texts = stored(texts.select("set", sign("text", "row_key").alias("s")).select("set", "s.first"), "deep")
        deeper, still = _split(_paths(texts, deep, levels, runs), levels)
        found = found.unionByName(deeper).unionByName(still.select("set", "run", "leaf", "n"))
    leaves = found.groupBy("set").agg(F.map_from_entries(F.collect_list(F.struct("run", F.struct("leaf", "n")))).alias("leaves"))
    leaf = lambda r: F.coalesce(F.try_element_at("leaves", r)["leaf"], F.lit(0))
    own = F.transform(F.sequence(F.lit(0), F.lit(total - 1)), leaf)
    rows = stored(leaves, "leaves").select(own.alias("own"), "set", F.explode("leaves").alias("run", "x"))
    before = F.slice("own", F.lit(1), F.col("run"))
    rows = stored(rows.select("set", before.alias("own"), "run", F.col("x.leaf").alias("leaf"), F.col("x.n").alias("n")), "members")
    covered = F.lit(False)
    for r in range(total):
        low, high = F.min(F.get("own", F.lit(r))), F.max(F.get("own", F.lit(r)))
        covered = covered | F.coalesce((low == high) & (low != 0), F.lit(False))
    open_ = stored(rows.groupBy("leaf").agg(covered.alias("covered")).where("not covered").select("leaf"), "open")
    return rows.join(open_, "leaf")


def _dealt(members: DataFrame) -> DataFrame:
    """Each member once for each two blocks of its bucket that it is compared in: a small bucket is one block."""
    blocks = F.ceil(F.col("n") / LIMIT).cast("int")
    dealt = members.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("set"), blocks).cast("int")})
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return dealt.select("set", "run", "leaf", "own", "block", "low", "high")


def _compare(threshold: float):
    """Brute force within the buckets of one shard."""

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, low, high), bucket in pdf.groupby(["leaf", "low", "high"], sort=False):
            tokens = [np.frombuffer(t, np.uint64) for t in bucket["tokens"]]
            size = np.array([len(t) for t in tokens])
            weight, run, block = bucket["weight"].to_numpy(), int(bucket["run"].iat[0]), bucket["block"].to_numpy()
            n = len(tokens)
            if n < 2:
                continue
            shared = _intersections(tokens)
            alike = shared * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-9
            if low != high:
                alike &= block[:, None] != block[None, :]
            a, b = np.nonzero(np.triu(alike, 1))
            own = np.array(bucket["own"].tolist(), np.int64).reshape(n, run)
            met = np.zeros(len(a), bool)
            for r in range(run):
                met |= (own[a, r] == own[b, r]) & (own[a, r] != 0)
            a, b = a[~met], b[~met]
            if not len(a):
                continue
            total = np.bincount(a, weight[b], n) + np.bincount(b, weight[a], n)
            root = np.arange(n)
            while True:  # minimum labels with pointer jumps, within the bucket
                new = root.copy()
                np.minimum.at(new, a, root[b])
                np.minimum.at(new, b, root[a])
                new = new[new]
                if (new == root).all():
                    break
                root = new
            some = np.flatnonzero(total)
            names = bucket["set"].to_numpy()
            out.append(pd.DataFrame({"set": names[some], "to": names[root[some]], "links": total[some].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"set": [], "to": [], "links": []}, dtype=object)

    return links


def _intersections(tokens: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many tokens each two sets share."""
    n = len(tokens)
    every, column = np.unique(np.concatenate(tokens), return_inverse=True)
    often = np.bincount(column, minlength=len(every)) > 1
    name = np.cumsum(often) - 1
    row = np.repeat(np.arange(n), [len(t) for t in tokens])
    row, column = row[often[column]], name[column[often[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((n, n), np.float64)
    for begin in range(0, int(often.sum()), width):
        a, z = np.searchsorted(column, [begin, begin + width])
        grid = np.zeros((n, width), np.float32)
        grid[row[a:z], column[a:z] - begin] = 1
        shared += grid @ grid.T
    return shared


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component of ``edges`` (set, to)."""
    both = edges.where("set <> to").select(F.col("set").alias("a"), F.col("to").alias("b"))
    both = stored(both.union(both.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        near = stored(near.select(F.col("a").alias("node"), "near"), "near")
        lower = stored(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low")), "lower")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        new = stored(lower.join(jump, "low").select("node", F.col("lowest").alias("new"), "label"), "jumped")
        if new.where("new <> label").isEmpty():
            return labels
        labels = new.select("node", F.col("new").alias("label"))


def near_duplicates(docs: DataFrame, *, text_col: str = "text", threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """Of each row of ``docs``: row_key, doc_id, class_id, n_links, and whether it stands for its class.

    ``class_id`` is the least id of the connected component (null only if all are null); ``n_links`` counts the other
    rows with a similarity of ``threshold`` or more. One row of a class is ``kept``: the one with the least id (and of
    equal rows any). ``doc_id`` may be of any type that has an order; other columns are not read.
    """
    keyed = docs.select("doc_id", F.col(text_col).alias("text"))
    keyed = keyed.withColumn("row_key", _row_key())
    sign = _signer(runs_needed(threshold, recall), LEVELS, 1)
    signed = keyed.select("doc_id", "row_key", sign("text", "row_key").alias("s")).select("doc_id", "row_key", "s.*")
    signed = stored(signed, "signed")
    sets = signed.groupBy("set").agg(
        F.count("*").alias("weight"), F.min("row_key").alias("row_key"), F.first("size").alias("size"), F.first("first").alias("first"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("least"),
    )
    sets = stored(sets, "sets")
    members = stored(_meetings(sets, keyed, threshold, recall), "open_members")
    held = members.select("set").distinct().join(sets.select("set", "weight", "row_key", "size"), "set")
    bytes_ = members.join(sets.select("set", "size"), "set").agg(F.sum(F.col("size") * 8 * F.ceil(F.col("n") / LIMIT))).first()[0]
    shards = max(1, -(-int(bytes_ or 0) // SHARD_BYTES))

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets_ = [x.tobytes() for x in shingle_sets(_bytes(batch["text"]))]
            yield pd.DataFrame({"set": batch["set"], "weight": batch["weight"], "tokens": sets_})

    texts = keyed.select("row_key", "text").join(held, "row_key")
    texts = texts.select("set", "weight", "text").mapInPandas(tokens, "set binary, weight long, tokens binary")
    texts = texts.dropDuplicates(["set"])  # rows that repeat have one key
    dealt = _dealt(members).join(texts, "set")
    shard = F.pmod(F.xxhash64("leaf", "low", "high"), F.lit(shards))
    found = dealt.withColumn("shard", shard).groupBy("shard").applyInPandas(
        _compare(threshold), "set binary, to binary, links long"
    )
    found = stored(found, "links")
    labels = components(found.select("set", "to"))
    links = found.groupBy("set").agg(F.sum("links").alias("links"))
    classes = sets.select("set", "weight", "size", "least").join(labels.withColumnRenamed("node", "set"), "set", "left")
    classes = classes.join(links, "set", "left").withColumn("label", F.coalesce("label", "set"))
    classes = stored(classes, "classes")
    heads = stored(classes.groupBy("label").agg(F.min("least").alias("head")), "heads")
    named = classes.join(heads, "label").select(
        "set", F.col("head.doc_id").alias("class_id"), F.col("head.row_key").alias("head"),
        (F.coalesce("links", F.lit(0)) + F.when(F.col("size") > 0, F.col("weight") - 1).otherwise(0)).alias("n_links"),
    )
    named = stored(named, "named")
    own = signed.select("row_key", "doc_id", "set").join(named, "set")
    return own.select("row_key", "doc_id", "class_id", "n_links", (F.col("row_key") == F.col("head")).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class, by ``near_duplicates`` over the column ``text``."""
    kept = near_duplicates(docs, **options).where("kept").select(F.col("row_key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", _row_key()).join(kept, "__key")
    return keyed.dropDuplicates(["__key"]).select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 9 * k >= 4 * (x.n + y.n)),
walk AS (SELECT a, b FROM e UNION SELECT walk.a, e.b FROM walk JOIN e ON walk.b = e.a),
cls AS (SELECT a AS r, min(doc_id) AS m FROM walk JOIN d ON d.r = walk.b GROUP BY a),
deg AS (SELECT a AS r, count(*) AS k FROM e GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(m, doc_id)) AS class_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN cls USING (r) LEFT JOIN deg USING (r)
"""
