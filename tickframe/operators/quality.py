"""Quality evidence, verdict ladders and schema drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators import quantiles


def quote_order(rows: DataFrame, keys: list[str], limit: float = 0.05) -> DataFrame:
    """Share of rows that aren't bid <= mark <= ask, nulls included, and its verdict."""
    ordered = F.coalesce((F.col("bid") <= F.col("mark")) & (F.col("mark") <= F.col("ask")), F.lit(False))
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~ordered).alias("unordered"))
    rate = F.col("unordered") / F.col("rows")
    return g.withColumn("verdict", F.when(rate > limit, "quarantined").otherwise("clean"))


def entitlement(rows: DataFrame, keys: list[str], stale_seconds: int = 60, few: int = 1_000_000) -> DataFrame:
    """Flag violations over all rows, the exact median staleness over session rows, and the verdict ladder."""
    counts = F.count_if(F.coalesce("is_delayed", F.lit(True))).alias("violations"), F.count_if(F.col("in_session")).alias("session_rows")
    if quantiles.any_large(rows, keys, few):
        q = quantiles.exact(rows.select(*(F.col(k).alias(f"_{k}") for k in keys), F.when(F.col("in_session"), F.col("staleness")).alias("_s")), [f"_{k}" for k in keys], "_s", [0.5], few)
        g = rows.groupBy(*keys).agg(*counts).join(q, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).select(*keys, "violations", "session_rows", F.get("q", F.lit(0)).alias("median_staleness"))
    else:
        g = rows.groupBy(*keys).agg(*counts, F.median(F.when(F.col("in_session"), F.col("staleness"))).alias("median_staleness"))
    verdict = F.when(F.col("violations") > 0, "quarantined").when(F.col("session_rows") == 0, "out_of_scope").when(F.col("median_staleness").isNull() | (F.abs("median_staleness") > stale_seconds), "quarantined").otherwise("clean")
    reason = F.when(F.col("violations") > 0, "delayed").when(F.col("session_rows") == 0, "no_session_rows").when(F.col("median_staleness").isNull(), "no_median").when(F.abs("median_staleness") > stale_seconds, "stale")
    return g.withColumn("verdict", verdict).withColumn("reason", reason)


def snapshot_counts(rows: DataFrame, keys: list[str], snap: str) -> DataFrame:
    """Data rows of each snapshot, and whether it carries an absence marker."""
    return rows.groupBy(*keys, snap).agg(F.count_if(F.col("row_kind") == "data").alias("rows"), F.bool_or(F.col("marker")).alias("marked"))


def trailing_medians(days: DataFrame, medians: DataFrame, keys: list[str], sessions: int = 20) -> DataFrame:
    """Median of the session medians of the sessions before each.

    days is dense in sessions, so an empty one takes its place in the frame and adds nothing.
    """
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(-sessions, -1)
    dense = days.join(medians, [*keys, "day"], "left")
    return dense.select(*keys, "day", "m", F.percentile("m", F.lit(0.5)).over(w).alias("usual"), F.count("m").over(w).alias("known"))


def row_count_band(counts: DataFrame, usual: DataFrame, keys: list[str], band: float = 0.3, least: int = 5) -> DataFrame:
    """Snapshots without a marker against the trailing median (Q3): the worst one decides."""
    free = counts.where("not marked")
    j = counts.select(*keys, "day").distinct().join(free.groupBy(*keys, "day").agg(F.count(F.lit(1)).alias("snapshots"), F.collect_list("rows").alias("_r")), [*keys, "day"], "left").join(usual.select(*keys, "day", "usual", "known"), [*keys, "day"], "left")
    far = F.transform("_r", lambda r: F.struct(F.abs(r - F.col("usual")).alias("d"), r.alias("rows")))
    worst = F.array_max(far)
    verdict = F.when(F.col("snapshots").isNull(), "out_of_scope").when(F.coalesce("known", F.lit(0)) < least, "insufficient_history").when(worst["d"] > band * F.col("usual"), "quarantined").otherwise("clean")
    return j.select(*keys, "day", F.coalesce("snapshots", F.lit(0)).alias("snapshots"), "usual", worst["rows"].alias("worst_rows"), verdict.alias("verdict"))


def window_profile(rows: DataFrame, keys: list[str], cycle: str, window: list[str]) -> DataFrame:
    """Most data rows of a fetch window in any cycle, and whether it ever failed; a null end is its own window."""
    c = rows.groupBy(*keys, cycle, *window).agg(F.count_if(F.col("row_kind") == "data").alias("c"), F.count_if(F.col("row_kind") == "gap").alias("g"))
    return c.groupBy(*keys, *window).agg(F.max("c").alias("peak"), (F.sum("g") > 0).alias("failed"))


def null_profile(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per key and column: rows and rows that have it (D25); one aggregation, then unpivoted."""
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *(F.count(c).alias(c) for c in columns))
    return g.unpivot([*keys, "rows"], columns, "field", "present")


def newly_absent(today: DataFrame, before: DataFrame, retyped: DataFrame | None = None) -> DataFrame:
    """Fields absent today for every ticker that both days have, and not absent for all of them before.

    Both have ticker, field, absent.
    """
    shared = today.select("ticker").distinct().join(before.select("ticker").distinct(), "ticker")
    n = shared.agg(F.count(F.lit(1)).alias("_n"))
    all_absent = lambda df: df.where("absent").join(shared, "ticker").groupBy("field").agg(F.countDistinct("ticker").alias("_c")).join(F.broadcast(n)).where("_c = _n").select("field")
    out = all_absent(today).join(all_absent(before), "field", "left_anti")
    return out if retyped is None else out.join(retyped.select("field"), "field", "left_anti")


def fingerprint_diff(derived: DataFrame, recorded: DataFrame) -> DataFrame:
    """dropped, added and retyped columns of two (surface, column, type) frames."""
    j = recorded.withColumnRenamed("type", "recorded").join(derived.withColumnRenamed("type", "derived"), ["surface", "column"], "full_outer")
    state = F.when(F.col("derived").isNull(), "dropped").when(F.col("recorded").isNull(), "added").when(F.col("recorded") != F.col("derived"), "retyped")
    return j.withColumn("state", state).where("state is not null")


def drift(profile: DataFrame, keys: list[str]) -> DataFrame:
    """Fields that a key had on the day before it recorded and wholly lacks on this one (Q7)."""
    w = Window.partitionBy(*keys, "field").orderBy("day")
    p = profile.withColumn("_was", F.lag("present").over(w))
    return p.where("present = 0 and _was > 0").select(*keys, "day", "field")


def lossless(df: DataFrame, column: str, wider: str) -> Column:
    """Count of values that don't survive a cast and a cast back (A15): zero allows the widening."""
    kind = df.schema[column].dataType.simpleString()
    return F.count_if(~F.expr(f"try_cast(try_cast(`{column}` as {wider}) as {kind})").eqNullSafe(F.col(column)))


def worst_of(verdicts: list[DataFrame], keys: list[str]) -> DataFrame:
    """All checks of a battery as rows (Q6), and per key whether any quarantines."""
    every = verdicts[0]
    for v in verdicts[1:]:
        every = every.unionByName(v)
    return every.groupBy(*keys).agg(F.count(F.lit(1)).alias("checks"), F.bool_or(F.col("verdict") == "quarantined").alias("withheld"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("verdict") == "quarantined", F.col("check_name")))), ",").alias("failed"))
