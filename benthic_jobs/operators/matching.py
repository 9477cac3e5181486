"""Joins of observations with scenes: nearest in time, tiered by clarity, by place, and low with high resolution.

Pairs are never listed. What is asked for and what is found are reduced to days first, so that a key has a row for each
calendar day at most, whatever its number of observations and scenes; each asked day looks back and ahead in the order of
days, and the answers go to the observations by a join on key and day. Ties go to the scene acquired first, then the
smaller id.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import stored


def day_of(c: str) -> Column:
    """Whole days: a scene twelve hours before a date is a day before it, one twelve hours after is of the same day."""
    return F.unix_date(F.col(c).cast("date"))


def first_by(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__r", rank).where("__r = 1").drop("__r")


def neighbours(asked: DataFrame, found: DataFrame, keys: list[str], sides: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Of each asked (keys, ``__d``), for each column of ``sides`` the last day up to it and the first one from it on with a value.

    They are structs ``<side>_a`` and ``<side>_z`` of ``__d`` and ``s``. ``found`` has a row for each key and day; ``extra``
    are columns over all rows of a key. Both directions share one order and cost a step for each row: the first day from a
    row on is its own, else the next one with a value.
    """
    more = [c for c in found.columns if c not in (*keys, "__d")]
    both = asked.select(*keys, "__d").withColumn("__ask", F.lit(True)).unionByName(found, allowMissingColumns=True).dropna(subset=[*keys, "__d"])
    both = both.groupBy(*keys, "__d").agg(F.max("__ask").alias("__ask"), *(F.min(c).alias(c) for c in more))
    both = both.withColumns({f"__{c}": F.when(F.col(c).isNotNull(), F.struct("__d", F.col(c).alias("s"))) for c in sides})
    order, looks = Window.partitionBy(*keys).orderBy("__d"), {}
    parts = ", ".join(f"`{k}`" for k in keys)
    for c in sides:
        looks[f"{c}_a"] = F.last(f"__{c}", ignorenulls=True).over(order)
        looks[f"{c}_z"] = F.coalesce(f"__{c}", F.expr(f"lead(`__{c}`) IGNORE NULLS OVER (PARTITION BY {parts} ORDER BY __d)"))
    return both.withColumns(looks | (extra or {})).where("__ask").drop("__ask", *more, *(f"__{c}" for c in sides))


def _answered(obs: DataFrame, obs_date: str, keys: list[str], best: DataFrame) -> DataFrame:
    """``obs`` with what is known of its key and day; all of them stay."""
    return obs.withColumn("__d", day_of(obs_date)).join(best, [*keys, "__d"], "left")


def nearest_scene(obs: DataFrame, scenes: DataFrame, keys: list[str], obs_date: str, acquired: str, scene_id: str, days: int) -> DataFrame:
    """Each observation's nearest scene (``scene_id``, ``dist``) within ``days``, or NULLs."""
    first = F.min(F.struct(F.col(acquired).alias("t"), F.col(scene_id).alias("s"))).alias("first")
    found = scenes.groupBy(*keys, day_of(acquired).alias("__d")).agg(first)
    near = neighbours(obs.select(*keys, day_of(obs_date).alias("__d")).distinct(), found, keys, ["first"])
    choice = lambda c: F.when(F.col(f"{c}.__d").isNotNull(), F.struct(F.abs(F.col(f"{c}.__d") - F.col("__d")).alias("dist"), F.col(f"{c}.s").alias("s")))
    best = near.select(*keys, "__d", F.least(choice("first_a"), choice("first_z")).alias("__best")).where(F.col("__best.dist") <= days)
    out = _answered(obs, obs_date, keys, best)
    return out.select(*obs.columns, F.col("__best.s.s").alias(scene_id), F.col("__best.dist").alias("dist"))


def clarity_tier(score: Column) -> Column:
    return F.when(score >= 0.75, 0).when(score >= 0.6, 1).when(score >= 0.4, 2).when(score.isNotNull(), 3).otherwise(4)


def clearest_scene(obs: DataFrame, scenes: DataFrame, keys: list[str], obs_date: str, acquired: str, scene_id: str, score: str, days: int) -> DataFrame:
    """The nearest scene of the best clarity tier that has any; without any score the first scene. The last day is open."""
    scene, tier = F.struct(F.col(acquired).alias("t"), F.col(scene_id).alias("s")), clarity_tier(F.col(score))
    firsts = [F.min(F.when(tier == k, scene)).alias(f"t{k}") for k in range(5)]
    found = scenes.groupBy(*keys, day_of(acquired).alias("__d")).agg(*firsts)
    unscored = F.when(F.col("t4").isNotNull(), F.struct(F.col("t4").alias("s"), "__d"))
    first = F.min(unscored).over(Window.partitionBy(*keys).orderBy("__d").rangeBetween(-days, days - 1))  # 2 * days rows at most
    near = neighbours(obs.select(*keys, day_of(obs_date).alias("__d")).distinct(), found, keys, [f"t{k}" for k in range(4)], {"first": first})

    def choice(c: str, tier: int, rank: bool) -> Column:
        gap = F.col(f"{c}.__d") - F.col("__d")
        place = F.abs(gap) if rank else F.lit(None).cast("int")
        one = F.struct(F.lit(tier).alias("tier"), place.alias("place"), F.col(f"{c}.s").alias("s"), F.abs(gap).alias("dist"))
        return F.when(gap.between(-days, days - 1), one)

    ends = [choice(f"t{k}_{side}", k, True) for k in range(4) for side in "az"]
    best = near.select(*keys, "__d", F.least(*ends, choice("first", 4, False)).alias("__best"))
    names = {scene_id: "__best.s.s", "dist": "__best.dist", "tier": "__best.tier"}
    return _answered(obs, obs_date, keys, best).select(*obs.columns, *(F.col(c).alias(n) for n, c in names.items()))


def same_day_else_nearest(obs: DataFrame, files: DataFrame, keys: list[str], obs_date: str, file_date: str, file: str) -> DataFrame:
    """A site's raster of the same day, else the nearest in time, else (date unknown) the first file."""
    found = files.groupBy(*keys, day_of(file_date).alias("__d")).agg(F.min(file).alias("f"))
    any_file = files.groupBy(*keys).agg(F.min(file).alias("__any"))
    near = neighbours(obs.select(*keys, day_of(obs_date).alias("__d")).distinct(), found, keys, ["f"])
    choice = lambda c: F.when(F.col(f"{c}.__d").isNotNull(), F.struct(F.abs(F.col(f"{c}.__d") - F.col("__d")).alias("dist"), F.col(f"{c}.s").alias("f")))
    best = near.select(*keys, "__d", F.least(choice("f_a"), choice("f_z")).alias("__best"))
    out = _answered(obs, obs_date, keys, best).join(any_file, keys, "left")
    return out.select(*obs.columns, F.coalesce("__best.f", "__any").alias(file), F.col("__best.dist").alias("dist"))


def ring_area(ring: Column) -> Column:
    """The area of a ring of [x, y] with a sign, positive if it runs counter-clockwise."""
    after = lambda i: ring[(i + 1) % F.size(ring)]
    turns = F.transform(ring, lambda p, i: p[0] * after(i)[1] - after(i)[0] * p[1])
    return F.aggregate(turns, F.lit(0.0), lambda total, x: total + x) / 2


def clipped(ring: Column, window: Column) -> Column:
    """A ring cut to a convex window, edge by edge; empty where they don't meet. The ring may be concave: parts of it may then be
    joined by lines along the window, which have no area."""
    way = F.signum(ring_area(window))

    def cut(held: Column, i: Column) -> Column:
        a, b = window[i], window[(i + 1) % F.size(window)]
        side = lambda p: way * ((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))

        def step(p: Column, k: Column) -> Column:
            q = held[(k + F.size(held) - 1) % F.size(held)]
            t = side(q) / (side(q) - side(p))
            met = F.array(q[0] + t * (p[0] - q[0]), q[1] + t * (p[1] - q[1]))
            none = F.array().cast("array<array<double>>")
            entered = F.when(side(q) < 0, F.array(met, p)).otherwise(F.array(p))
            return F.when(side(p) >= 0, entered).otherwise(F.when(side(q) >= 0, F.array(met)).otherwise(none))

        return F.flatten(F.transform(held, step))

    return F.aggregate(F.sequence(F.lit(0), F.size(window) - 1), ring, cut)


def _area(ring: list) -> float:
    total = 0.0
    for (x, y), (u, v) in zip(ring, [*ring[1:], *ring[:1]]):
        total += x * v - u * y
    return total / 2


def _share(ring: list, window: list) -> float | None:
    """``clipped`` for two rings in plain numbers: the percentage of the ring's area in the convex window, null without an area."""
    whole, way, held = _area(ring), 1.0 if _area(window) > 0 else -1.0, ring
    for (ax, ay), (bx, by) in zip(window, [*window[1:], *window[:1]]):
        sides, kept = [way * ((bx - ax) * (y - ay) - (by - ay) * (x - ax)) for x, y in held], []
        for k, p in enumerate(held):
            q, sp, sq = held[k - 1], sides[k], sides[k - 1]
            if (sp >= 0) != (sq >= 0):
                t = sq / (sq - sp)
                kept.append((q[0] + t * (p[0] - q[0]), q[1] + t * (p[1] - q[1])))
            if sp >= 0:
                kept.append(p)
        held = kept
    return abs(_area(held)) / abs(whole) * 100 if whole else None


def covered_pct(ring: Column | str, window: Column | str) -> Column:
    """How much of a ring a convex outline covers, in percent; NULL for a ring without an area."""
    points = lambda value: [(float(p[0]), float(p[1])) for p in value]

    @F.pandas_udf("double")
    def run(rings: pd.Series, windows: pd.Series) -> pd.Series:
        return pd.Series([_share(points(r), points(w)) for r, w in zip(rings, windows)], dtype="float64")

    return run(ring, window)


def catalogue_search(
    aois: DataFrame, scenes: DataFrame, aoi_id: str, *, cell: float, cloud: float = 20, nodata: float = 5, coverage: float = 0, overlap: float = 0, top: int = 8
) -> DataFrame:
    """Scenes whose footprint shares an area with the one asked for, in its dates, by cloud; ``share_pct`` is how much of it they cover.

    ``aois`` have ``ring`` (an outline of [x, y]), ``first_day`` and ``last_day``; ``scenes`` scene_id, ``footprint`` (a convex
    outline), acquired, cloud_cover, nodata_pct, coverage_pct. At least ``overlap`` percent must be covered.

    Equal outlines are one on either side, so two outlines are clipped once, however many ask for the one and were taken of the other. Their
    boxes meet in the cells of a grid, and the cell with the south-west corner of what two boxes share reports the pair. Of an outline's scenes
    only the first ``top`` in the dates asked for can be among those of an answer, and what is asked for alike is answered once.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("long")

    def cells(rows: DataFrame, ring: str, own: str) -> DataFrame:
        side = lambda i: F.transform(ring, lambda p: p[i])
        boxed = rows.withColumns({f"{own}west": F.array_min(side(0)), f"{own}east": F.array_max(side(0)), f"{own}south": F.array_min(side(1)), f"{own}north": F.array_max(side(1))})
        boxed = boxed.withColumn("cx", F.explode(F.sequence(at(f"{own}west"), at(f"{own}east"))))
        return boxed.withColumn("cy", F.explode(F.sequence(at(f"{own}south"), at(f"{own}north"))))

    name, order = lambda ring: F.md5(F.to_json(ring)), ["cloud_cover", "acquired", "scene_id"]
    good = scenes.where((F.col("cloud_cover") < cloud) & (F.col("nodata_pct") <= nodata) & (F.col("coverage_pct") >= coverage))
    good, asked = good.withColumn("__shape", name("footprint")), aois.withColumn("__ask", name("ring"))
    left = cells(asked.select("__ask", "ring").dropDuplicates(["__ask"]), "ring", "")
    right = cells(good.select("__shape", "footprint").dropDuplicates(["__shape"]), "footprint", "s_")
    meets = (F.col("west") <= F.col("s_east")) & (F.col("s_west") <= F.col("east")) & (F.col("south") <= F.col("s_north")) & (F.col("s_south") <= F.col("north"))
    owner = (F.col("cx") == F.floor(F.greatest("west", "s_west") / cell)) & (F.col("cy") == F.floor(F.greatest("south", "s_south") / cell))
    pairs = left.join(right, ["cx", "cy"]).where(meets & owner).select("__ask", "__shape", covered_pct("ring", "footprint").alias("share_pct"))
    pairs = stored(pairs, "shares").where((F.col("share_pct") > 0) & (F.col("share_pct") >= overlap))  # stored, so that a share is computed once
    days = ["first_day", "last_day"]
    asks = pairs.join(asked.select("__ask", *days).distinct(), "__ask")
    windows = asks.select("__shape", *days).distinct()
    taken = windows.join(good.select("__shape", *order), "__shape").where(F.col("acquired").between(F.col("first_day"), F.col("last_day")))
    first = top_k(taken, ["__shape", *days], order, top).drop("rank")
    best = top_k(asks.join(first, ["__shape", *days]), ["__ask", *days], order, top)
    found = asked.select(aoi_id, "__ask", *days).join(best.drop("rank", "__shape"), ["__ask", *days])
    return top_k(found.select(aoi_id, "scene_id", "cloud_cover", "acquired", "share_pct"), [aoi_id], order, top)


def top_k(rows: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each key, with ``rank``."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def top_k_dealt(rows: DataFrame, keys: list[str], order: list, k: int, by: Column, groups: int = 64) -> DataFrame:
    """As ``top_k``, for few and large keys: the first k of each of ``groups`` parts come first, then those of the key."""
    parts = rows.withColumn("__part", F.pmod(F.xxhash64(by), F.lit(groups)))
    return top_k(top_k(parts, [*keys, "__part"], order, k).drop("__part"), keys, order, k)


def quality_order(cloud: Column, key: Column, seed: int) -> list[Column]:
    """Least cloud first, ties by a seeded hash, so that no year is favoured."""
    return [cloud.asc_nulls_last(), seeded(key, seed)]


def seeded(key: Column, seed: int) -> Column:
    """A pseudo-random text that both engines compute alike."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def counts_within(asked: DataFrame, found: DataFrame, keys: list[str], days: int) -> DataFrame:
    """Of each asked (keys, ``__d``) how many rows of ``found`` (keys, ``__d``) lie within ``days``, as ``n``."""
    daily = found.groupBy(*keys, "__d").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy("__d")
    upto = F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, days))
    before = F.coalesce(F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, -days - 1)), F.lit(0))
    out = neighbours(asked.distinct(), daily, keys, [], {"__n": F.coalesce(upto, F.lit(0)) - before})
    return out.withColumnRenamed("__n", "n")


def pair_resolutions(high: DataFrame, low: DataFrame, *, keys: list[str], days: int = 90, least: int = 6, most: int = 8, cloud: float = 20) -> DataFrame:
    """For each location the first high-resolution scene in rank order that passes QA with enough low ones.

    ``high``: location_id, keys, hr_id, hr_date, rank, qa_ok. ``low``: keys, lr_id, lr_date, cloud_cover. A location is given
    up at its first scene with fewer than ``least`` low ones, whatever comes after it. Low ones are counted for each key and
    day, not for each location.
    """
    good = low.where(F.col("cloud_cover") < cloud).select(*keys, day_of("lr_date").alias("__d"))
    counts = counts_within(high.select(*keys, day_of("hr_date").alias("__d")), good, keys, days)
    rows = high.withColumn("__d", day_of("hr_date")).join(counts, [*keys, "__d"], "left")
    n_low = F.least(F.coalesce("n", F.lit(0)), F.lit(most)).cast("int")
    rows = rows.select(*high.columns, n_low.alias("n_low"))
    so_far = Window.partitionBy("location_id").orderBy("rank", "hr_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("short", F.sum((F.col("n_low") < least).cast("int")).over(so_far)).where("short = 0 AND qa_ok")
    return first_by(rows, ["location_id"], ["rank", "hr_id"]).drop("short")


def fuzzy_names(left: DataFrame, right: DataFrame, left_key: str, right_key: str, files: str) -> DataFrame:
    """Names that are equal, else of which one begins with the other: least difference in length, fewest files.

    Of the names that begin alike a shorter one would choose the same, whatever it is: for each prefix of the right names the
    best row is found first, by a partial aggregate, so a left name meets one row and not all that begin with it. In the other
    direction a left name asks for each of its own prefixes. Rows are in proportion to names and their lengths.
    """
    prefixes = lambda rows, c: rows.withColumn("__p", F.explode(F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda i: F.substring(F.col(c), F.lit(1), i))))
    best = F.min(F.struct(F.char_length(right_key).alias("n"), F.col(files), F.col(right_key))).alias("__r")
    winners = prefixes(right.where(F.char_length(right_key) > 0), right_key).groupBy("__p").agg(best)
    exact = right.withColumn("__p", F.col(right_key)).groupBy("__p").agg(best)
    names = left.select(left_key).distinct()
    longer = names.withColumn("__p", F.col(left_key)).join(winners, "__p")
    shorter = prefixes(names.where(F.char_length(left_key) > 0), left_key).join(exact, "__p")
    both = longer.select(left_key, "__r").unionByName(shorter.select(left_key, "__r"))
    gap = F.abs(F.char_length(left_key) - F.col("__r.n"))
    first = both.groupBy(left_key).agg(F.min(F.struct(gap.alias("gap"), F.col(f"__r.{files}"), F.col(f"__r.{right_key}"))).alias("__b"))
    return first.select(left_key, F.col(f"__b.{right_key}"), F.col(f"__b.{files}"), "__b.gap")


def primary_else_fallback(base: DataFrame, primary: DataFrame, fallback: DataFrame, key: str, band_cols: list[str], source: str = "source") -> DataFrame:
    """The first source's bands if any is not NULL, else the second's; ``source`` says which."""
    p = primary.select(key, *(F.col(b).alias(f"p_{b}") for b in band_cols))
    f = fallback.select(key, *(F.col(b).alias(f"f_{b}") for b in band_cols))
    rows = base.join(p, key, "left").join(f, key, "left")
    some = lambda side: F.coalesce(*(F.col(f"{side}_{b}") for b in band_cols)).isNotNull()
    out = {b: F.when(some("p"), F.col(f"p_{b}")).otherwise(F.col(f"f_{b}")) for b in band_cols}
    out[source] = F.when(some("p"), "primary").when(some("f"), "fallback")
    return rows.withColumns(out).drop(*(f"{s}_{b}" for s in "pf" for b in band_cols))


def onto_children(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Parents' columns that the children don't have yet, on each child."""
    new = [c for c in parents.columns if c not in children.columns]
    return children.join(parents.select(*keys, *new), keys, "left")
