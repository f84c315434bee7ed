"""Exact quantiles of groups of any size, by counted values and narrowing mergeable summaries.

Every group's values are counted first, map-side, in the one pass over the rows; all that follows looks at distinct values and how often they
occur. Groups of few distinct values are sorted as they are. One of many is searched: an approximate summary of its distinct values gives cuts,
and exact counts between and at the cuts add up map-side; where a wanted rank falls, there the search goes on, until a range holds few values or
one. The cuts themselves leave the range, so it always shrinks, by about their number. No task holds a group, and every pass looks only at
values inside some range that is still open. Groups with more than ``few`` distinct values number at most the rows by ``few``.
spark.checkpoint.dir must name a folder, which the counted values and what the rounds find go to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact(rows: DataFrame, keys: list[str], value: str, shares: list[float], few: int = 1_000_000, cuts: int = 64, broadcast_rows: int = 100_000) -> DataFrame:
    """(KEYS..., n, q): n values that are neither null nor NaN, and the array of their quantiles, interpolated between the two nearest
    ranks; null without values."""
    x = F.col(value).cast("double")
    held = rows.select(*keys, F.when(~F.isnan(x), x).alias("_x")).groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_w")).checkpoint()
    there = F.when(F.col("_x").isNotNull(), F.col("_w"))
    sizes = held.groupBy(*keys).agg(F.coalesce(F.sum(there), F.lit(0)).alias("n"), F.count("_x").alias("_m"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    large = sizes.where(F.col("_m") > few).checkpoint()
    n, q = F.coalesce(F.sum(there), F.lit(0)).alias("n"), F.percentile("_x", F.array(*map(F.lit, shares)), F.col("_w")).alias("q")
    if large.isEmpty():
        return held.groupBy(*keys).agg(n, q)
    small = _met(held, large.select(*keys), keys, "left_anti", broadcast_rows).groupBy(*keys).agg(n, q)
    return small.unionByName(_large(held, large, keys, shares, few, cuts, broadcast_rows))


def any_large(rows: DataFrame, keys: list[str], few: int = 1_000_000) -> bool:
    """Whether a group has more rows than a task should sort."""
    return not rows.groupBy(*keys).count().where(F.col("count") > few).isEmpty()


def _met(rows: DataFrame, of: DataFrame, keys: list[str], how: str, most: int) -> DataFrame:
    """rows with a table of one row for each large group, broadcast up to a checked size."""
    named = of.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(c for c in of.columns if c not in keys))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    out = rows.join(F.broadcast(named) if of.count() <= most else named, same, how)
    return out.drop(*(f"_k{i}" for i in range(len(keys))))


def _large(held: DataFrame, sizes: DataFrame, keys: list[str], shares: list[float], few: int, cuts: int, most: int) -> DataFrame:
    at = [F.lit(s) * (F.col("n") - 1) for s in shares]
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(p).cast("long"), F.ceil(p).cast("long")) for p in at))))
    # a target: a rank of a group, and the range it lies in, below which so many values are, and which has so many distinct ones
    todo = sizes.select(*keys, F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_below"), "_lo", "_hi", "_m")
    done = None
    while True:
        ready = F.col("_lo") == F.col("_hi")
        found = todo.where(ready).select(*keys, "_rank", F.col("_lo").alias("_v"))
        todo = todo.where(~ready)
        last = todo.where(F.col("_m") <= few)
        ranges = last.select(*keys, "_rank", "_below", "_lo", "_hi")
        in_order = Window.partitionBy(*keys, "_rank").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
        pick = _inside(held, ranges, keys, most).withColumn("_through", F.col("_below") + F.sum("_w").over(in_order))
        found = found.unionByName(pick.where((F.col("_rank") < F.col("_through")) & (F.col("_rank") >= F.col("_through") - F.col("_w"))).select(*keys, "_rank", F.col("_x").alias("_v")))
        done = (found if done is None else done.unionByName(found)).checkpoint()
        todo = todo.where(F.col("_m") > few)
        if todo.isEmpty():
            break
        at_cuts = F.percentile_approx("_x", [k / cuts for k in range(cuts + 1)], 20 * cuts).alias("_cuts")
        open_now = _inside(held, todo.select(*keys, "_rank", "_below", "_lo", "_hi"), keys, most).groupBy(*keys, "_rank", "_below", "_lo", "_hi").agg(at_cuts).checkpoint()
        place = F.size(F.filter("_cuts", lambda c: c < F.col("_x"))) * 2 + F.array_contains("_cuts", F.col("_x")).cast("int")  # odd: at a cut
        cut = _inside(held, open_now, keys, most).select(*keys, "_rank", "_below", "_x", "_w", place.alias("_bin"))
        sums = cut.groupBy(*keys, "_rank", "_below", "_bin").agg(F.sum("_w").alias("_n"), F.count("_x").alias("_m"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        before = F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")  # over twice as many rows as cuts
        todo = sums.withColumn("_below", F.col("_below") + before).where((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + F.col("_n"))).select(*keys, "_rank", "_below", "_lo", "_hi", "_m").checkpoint()
    known = done.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_known"))
    of = sizes.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "n")
    out = of.join(known, [F.col(f"_k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)])
    a, b = (lambda p: F.col("_known")[F.floor(p).cast("long")]), (lambda p: F.col("_known")[F.ceil(p).cast("long")])
    q = [F.when(F.floor(p) == F.ceil(p), a(p)).otherwise((F.ceil(p) - p) * a(p) + (p - F.floor(p)) * b(p)) for p in at]
    return out.select(*keys, "n", F.array(*q).alias("q"))


def _inside(held: DataFrame, ranges: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Values that lie in an open range of their group, once for each such range; all of a group's ranges meet a row at once."""
    of = ranges.groupBy(*keys).agg(F.collect_list(F.struct(*(c for c in ranges.columns if c not in keys))).alias("_of"))
    j = _met(held, of, keys, "inner", most).withColumn("_of", F.filter("_of", lambda r: (F.col("_x") >= r["_lo"]) & (F.col("_x") <= r["_hi"])))
    return j.select(*keys, "_x", "_w", F.explode("_of").alias("_r")).select(*keys, "_x", "_w", "_r.*")
