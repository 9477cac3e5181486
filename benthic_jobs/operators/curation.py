"""Manifests and reviews: what is missing, broken, dropped, replaced, allocated and still wanted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matching import seeded
from .ranks import numbered

HABITATS = ["coral", "seagrass", "mangrove"]


def review_filter(samples: DataFrame, decisions: DataFrame, which: str, key: str = "location_id") -> DataFrame:
    """all, unreviewed, flagged or kept samples."""
    rows = samples.join(decisions.select(key, "action"), key, "left")
    keep = {"all": F.lit(True), "unreviewed": F.col("action").isNull(), "flagged": F.col("action") != "keep", "kept": F.col("action") == "keep"}
    return rows.where(keep[which])


def missing_samples(manifest: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return manifest.join(found.select(key), key, "left_anti")


def drop_listed(samples: DataFrame, listed: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped, listed ids that no sample has)."""
    ids = listed.select(key).distinct()
    return samples.join(ids, key, "left_anti"), samples.join(ids, key, "left_semi"), ids.join(samples, key, "left_anti")


def still_to_do(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without a result. Results count only if every one of their keys is among the rows (else they are stale)."""
    mine, theirs = rows.select(*keys).distinct(), done.select(*keys).distinct()
    stale = theirs.join(mine, keys, "left_anti").limit(1).agg(F.count("*").alias("__stale"))
    usable = theirs.crossJoin(F.broadcast(stale)).where("__stale = 0").drop("__stale")
    return rows.join(usable, keys, "left_anti")


def sample_state(manifest: DataFrame, folders: DataFrame, checkpoints: DataFrame, key: str) -> DataFrame:
    """ok, broken (a folder without its checkpoint) or untouched."""
    f = folders.select(key).distinct().withColumn("__f", F.lit(True))
    c = checkpoints.select(key).distinct().withColumn("__c", F.lit(True))
    rows = manifest.select(key).distinct().join(f, key, "full").join(c, key, "left")
    state = F.when(F.col("__f") & F.col("__c"), "ok").when(F.col("__f"), "broken").otherwise("untouched")
    return rows.select(key, state.alias("state"))


def apply_decisions(files: DataFrame, decisions: DataFrame, key: str = "location_id") -> DataFrame:
    """What becomes of each file: remove or stay.

    ``files``: key, file, role (lr or hr). ``decisions``: key, action, files. delete and replace_both take the whole sample,
    replace_hr its high-resolution files, replace_lr the files named, or all low-resolution ones if none is.
    """
    d = decisions.select(key, "action", F.col("files").alias("named"))
    rows = files.join(d, key, "left")
    listed = F.when(F.coalesce(F.size("named"), F.lit(0)) > 0, F.array_contains("named", F.col("file"))).otherwise(F.lit(True))
    gone = F.col("action").isin("delete", "replace_both")
    gone = gone | ((F.col("action") == "replace_hr") & (F.col("role") == "hr"))
    gone = gone | ((F.col("action") == "replace_lr") & (F.col("role") == "lr") & listed)
    return rows.select(key, "file", "role", F.coalesce(gone, F.lit(False)).alias("removed"))


def decisions_left(decisions: DataFrame) -> DataFrame:
    """Processed entries leave; keeps, and actions that are unknown, stay."""
    return decisions.where(~F.col("action").isin("delete", "replace_both", "replace_hr", "replace_lr"))


def legacy_split(samples: DataFrame, habitat: str) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): samples of other habitats, or none, go and free their ids."""
    known = F.coalesce(F.col(habitat).isin(HABITATS), F.lit(False))
    return samples.where(known), samples.where(~known)


def equal_split(strata: DataFrame, key: str, total: int, seed: int) -> DataFrame:
    """``total`` shared out evenly over the strata (one row each); the remainder goes to strata in seeded order."""
    n = strata.agg(F.count("*").alias("__n"))
    rows = numbered(strata.select(key, seeded(F.col(key), seed).alias("__s")), ["__s", key], "__r").crossJoin(F.broadcast(n))
    share = F.expr(f"{total} div __n") + F.when(F.col("__r") <= F.lit(total) % F.col("__n"), 1).otherwise(0)
    return rows.select(key, share.cast("int").alias("quota"))


def allocate_ids(new: DataFrame, freed: DataFrame, used: DataFrame, order: list, key: str) -> DataFrame:
    """Ids for new rows: freed ones that are not in use, ascending, then the largest of all plus 1, 2, ..."""
    free = numbered(freed.select(key).distinct().join(used.select(key), key, "left_anti"), [key], "__i")
    top = used.select(key).union(freed.select(key)).agg(F.coalesce(F.max(key), F.lit(-1)).alias("__top"))
    n_free = free.agg(F.count("*").alias("__free"))
    rows = numbered(new, order, "__i").join(free, "__i", "left").crossJoin(F.broadcast(top)).crossJoin(F.broadcast(n_free))
    allotted = F.coalesce(F.col(key), F.col("__top") + F.col("__i") - F.col("__free"))
    return rows.withColumn(key, allotted.cast("long")).drop("__i", "__top", "__free")


def remaining_quota(targets: DataFrame, existing: DataFrame, stratum: str, target: str = "target") -> DataFrame:
    have = existing.groupBy(stratum).agg(F.count("*").alias("existing"))
    rows = targets.join(have, stratum, "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
    return rows.withColumn("remaining", F.greatest(F.lit(0), F.col(target) - F.col("existing")))


def issue_report(issues: DataFrame) -> DataFrame:
    """Issues and distinct samples by section and code."""
    return issues.groupBy("section", "code").agg(F.count("*").alias("n"), F.count_distinct("sample").alias("n_samples"))


def review_progress(samples: DataFrame, decisions: DataFrame, key: str = "location_id") -> DataFrame:
    """How many samples have each action; NULL: not reviewed."""
    rows = samples.select(key).join(decisions.select(key, "action"), key, "left")
    return rows.groupBy("action").agg(F.count("*").alias("n"))
