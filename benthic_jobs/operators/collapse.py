"""Field records to sites: plots, percent cover, diversity, dates, extents, stratified caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exact
from ..storage import stored
from .matching import seeded, top_k_dealt
from .ranks import quantiles

LAT_M, LON_M = 110540.0, 111320.0


def first_known(c: str, order: str) -> Column:
    """The first value that is not NULL in a stated order."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)


def plots(trees: DataFrame, keys: list[str], order: str, firsts: list[str]) -> DataFrame:
    """Trees to plots; a tree without a comment counts as live."""
    live = F.lower(F.coalesce("comment", F.lit("Live"))) == "live"
    return trees.groupBy(*keys).agg(
        *(first_known(c, order) for c in firsts), F.count("tree_no").alias("n_trees"), exact.mean("dbh_cm").alias("mean_dbh_cm"),
        F.max("dbh_cm").alias("max_dbh_cm"), exact.mean("height_m").alias("mean_height_m"), F.count_distinct("species").alias("n_species"),
        F.mode("species", True).alias("dominant_species"), F.avg(live.cast("double")).alias("live_fraction"),
    )


def sites(points: DataFrame, site: str, order: str, firsts: list[str], benthic: Column) -> DataFrame:
    return points.groupBy(site).agg(
        *(first_known(c, order) for c in firsts), F.count_distinct("image").alias("n_images"), F.count_distinct("analyst").alias("n_analysts"),
        F.count("*").alias("n_points"), F.count_if(benthic).alias("n_benthic"), F.mode("analyst", True).alias("primary_analyst"),
    )


def is_benthic(category: Column, other: list[str]) -> Column:
    """An unknown category counts as benthic."""
    return F.coalesce(~category.isin(other), F.lit(True))


def cover_long(points: DataFrame, site: str, label: str, keep: list[str], benthic: Column) -> DataFrame:
    """Percent of a site's benthic points with each label of ``keep``: 0 where it has none.

    The denominator includes points without a label. A site without any labelled benthic point has NULL covers.
    """
    own = points.where(benthic)
    counts = own.where(F.col(label).isNotNull()).groupBy(site, label).agg(F.count("*").alias("n"))
    totals = own.groupBy(site).agg(F.count("*").alias("total"), F.count(label).alias("labelled"))
    every = points.select(site).distinct().withColumn(label, F.explode(F.array(*map(F.lit, keep))))
    joined = every.join(totals, site, "left").join(counts, [site, label], "left")
    cover = F.when(F.col("labelled") > 0, F.coalesce("n", F.lit(0)) * 100.0 / F.col("total"))
    return joined.select(site, label, cover.alias("cover"))


def cover_wide(long: DataFrame, site: str, label: str, keep: dict[str, str]) -> DataFrame:
    """One column for each label of a fixed list (label: column)."""
    return long.groupBy(site).agg(*(F.max(F.when(F.col(label) == k, F.col("cover"))).alias(c) for k, c in keep.items()))


def category_share(points: DataFrame, site: str, category: str, names: dict[str, str]) -> DataFrame:
    """Percent of all points of a site."""
    return points.groupBy(site).agg(*(
        (F.count_if(F.col(category) == k) * 100.0 / F.count("*")).alias(c) for k, c in names.items()
    ))


def common_labels(points: DataFrame, label: str, share: float) -> DataFrame:
    """Labels with at least ``share`` of all rows; rows without a label count in the total."""
    counts = points.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col(label).isNotNull() & (F.col("n") >= share * F.col("total"))).select(label, "n")


def richness(points: DataFrame, site: str, columns: list[str]) -> DataFrame:
    """Distinct labels, and the most frequent one (ties: the smallest), of each column."""
    return points.groupBy(site).agg(
        *(F.count_distinct(c).alias(f"n_{c}") for c in columns), *(F.mode(c, True).alias(f"top_{c}") for c in columns)
    )


def shannon(points: DataFrame, site: str, label: str) -> DataFrame:
    return shannon_of_counts(points.groupBy(site, label).agg(F.count("*").alias("n")), site, label, "n")


def shannon_of_counts(counts: DataFrame, site: str, label: str, n: str) -> DataFrame:
    """Diversity from counts of (site, label), whose rows may be parts: ``log t - sum(n log n) / t``, so a site is summed up once."""
    known = counts.groupBy(site, label).agg(F.sum(n).alias("__n")).withColumn("__n", F.when(F.col(label).isNotNull(), F.col("__n")))
    sums = known.groupBy(site).agg(F.sum("__n").alias("t"), exact.mean(F.col("__n") * F.log("__n")).alias("m"), F.count("__n").alias("k"))
    return sums.select(site, (F.log("t") - F.col("m") * F.col("k") / F.col("t")).alias("shannon"))


def date_spread(rows: DataFrame, key: str, day: str, lon: str, lat: str) -> DataFrame:
    """Distinct dates and rows of each month, with the first and last date and the bounding box of the coordinates."""
    month = F.trunc(day, "month").alias("month")
    box = {"south": F.min(lat), "west": F.min(lon), "north": F.max(lat), "east": F.max(lon)}
    return rows.groupBy(key, month).agg(
        F.count_distinct(day).alias("n_dates"), F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        *(c.alias(k) for k, c in box.items()),
    )


def merged_windows(rows: DataFrame, keys: list[str], day: str, days: int) -> DataFrame:
    """Windows of ``days`` round the distinct dates, merged where they touch or overlap."""
    w = rows.where(F.col(day).isNotNull()).select(*keys, day).distinct()
    w = w.withColumns({"s": F.date_sub(day, days), "e": F.date_add(day, days)})
    order = Window.partitionBy(*keys).orderBy(day)
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    w = w.withColumn("new", F.when(before.isNull() | (F.col("s") > before), 1).otherwise(0))
    w = w.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return w.groupBy(*keys, "island").agg(F.min("s").alias("window_start"), F.max("e").alias("window_end"), F.count("*").alias("n_dates")).drop("island")


def outlier_flags(rows: DataFrame, cluster: str, lon: str, lat: str, limit_m: float = 2000) -> DataFrame:
    """Metres from the cluster's median position, and whether it is over the limit."""
    return _flagged(rows, _centres(rows, cluster, lon, lat), cluster, lon, lat, limit_m)


def _centres(rows: DataFrame, cluster: str, lon: str, lat: str) -> DataFrame:
    middle = lambda c, name: quantiles(rows, [cluster], c, {name: 0.5})
    return middle(lon, "__lon").join(middle(lat, "__lat"), cluster)


def _flagged(rows: DataFrame, centre: DataFrame, cluster: str, lon: str, lat: str, limit_m: float) -> DataFrame:
    dx = (F.col(lon) - F.col("__lon")) * LON_M * F.cos(F.radians("__lat"))
    dist = F.hypot(dx, (F.col(lat) - F.col("__lat")) * LAT_M)
    return rows.join(centre, cluster).withColumns({"dist_m": dist, "outlier": dist > limit_m}).drop("__lon", "__lat")


def extents(rows: DataFrame, cluster: str, lon: str, lat: str, pad: float, *, limit_m: float = 2000) -> DataFrame:
    """Padded bounding box, centroid and radius of each cluster, over the rows that ``outlier_flags`` does not flag.

    Rows of one place are counted before they meet their cluster, so few and large clusters are no hot keys with all rows.
    """
    rows = rows.select(cluster, lon, lat)
    places = stored(rows.groupBy(cluster, lon, lat).agg(F.count("*").alias("__n")), "places")
    rows = _flagged(places, _centres(rows, cluster, lon, lat), cluster, lon, lat, limit_m).where("NOT outlier").select(cluster, lon, lat, "__n")
    box = exact.counted(rows, "__n").groupBy(cluster).agg(
        (F.min(lon) - pad).alias("west"), (F.min(lat) - pad).alias("south"), (F.max(lon) + pad).alias("east"), (F.max(lat) + pad).alias("north"),
        exact.mean(lon, "__n").alias("lon"), exact.mean(lat, "__n").alias("lat"),
    )
    far = rows.select(cluster, F.col(lon).alias("__x"), F.col(lat).alias("__y")).join(box.select(cluster, "lon", "lat"), cluster)
    dx = (F.col("__x") - F.col("lon")) * LON_M * F.cos(F.radians("lat"))
    far = far.groupBy(cluster).agg(F.max(F.hypot(dx, (F.col("__y") - F.col("lat")) * LAT_M)).alias("radius_m"))
    return box.join(far, cluster)


def stratified_cap(rows: DataFrame, strata: list[str], key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows: a rounded quota of each stratum (at least 1) in seeded order, then a seeded cut.

    With no more than ``most`` rows, all stay. The total is one aggregated row, joined back.
    """
    total = rows.agg(F.count("*").alias("__total"))
    per = rows.groupBy(*strata).agg(F.count("*").alias("__n"))
    quota = F.greatest(F.lit(1), F.bround(F.lit(float(most)) * F.col("__n") / F.col("__total")))
    per = per.crossJoin(F.broadcast(total)).withColumn("__quota", F.when(F.col("__total") <= most, F.col("__n")).otherwise(quota))
    per = per.select(*(F.col(c).alias(f"__{c}") for c in strata), "__quota")
    named = rows.select(*strata, key, seeded(F.col(key), seed).alias("__h"), F.struct(*rows.columns).alias("__row"))
    first = top_k_dealt(named, strata, ["__h", key], most, F.col("__h"))  # no quota is over ``most``
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    kept = first.join(per, same).where("rank <= __quota").orderBy("__h", key).limit(most)
    return kept.select("__row.*")
