"""Slots, spans and snapshot reads.

A calendar is a frame with day, open_at, close_at, idx; spans are half-open intervals per ticker; both are inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators import scans


def instant(stamp: Column) -> Column:
    """An ISO stamp with an offset as an instant; anything else, offset-less stamps too, is null (K6)."""
    return F.when(stamp.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(stamp))


def slots_of(calendar: DataFrame, minutes: int = 1, through: str = "close_at") -> DataFrame:
    """Every slot of every session, both ends included (K1)."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    return calendar.select("day", F.explode(F.sequence("open_at", through, step)).alias("slot"))


def phase(slot: Column, open_at: Column, close_at: Column, option_close_at: Column) -> Column:
    """Session phase of a slot minute (K4); a day off the calendar has no bounds."""
    return F.when(open_at.isNull(), "non_session").when(slot < open_at, "pre_open").when(slot <= close_at, "open").when(slot <= option_close_at, "post_equity_close").otherwise("closed")


def close_tag(slot: Column, close_at: Column, option_close_at: Column) -> Column:
    """Which close a slot is the record of (K5)."""
    return F.when(slot == close_at, "spot_close").when(slot == option_close_at, "option_close")


def covers(at: Column, start: Column, end: Column, options: Column | None = None) -> Column:
    """Membership of a half-open span (B9); chains are owed only where options are."""
    inside = (at >= start) & (end.isNull() | (at < end))
    return inside if options is None else inside & options


def at_minute(rows: DataFrame, day: str, minute: str, stamp: str = "snap_ts", zone: str = "America/New_York") -> DataFrame:
    """Rows of one wall minute, however the stamps spell it (B1). A malformed minute raises."""
    import re

    if not re.fullmatch(r"([01]\d|2[0-3]):[0-5]\d", minute) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", day):
        raise ValueError(f"not a day and minute: {day} {minute}")
    want = F.to_utc_timestamp(F.lit(f"{day} {minute}:00").cast("timestamp"), zone)
    return rows.where(F.col(stamp) == want)


def data_rows(rows: DataFrame, kind: str = "row_kind") -> tuple[DataFrame, DataFrame]:
    """Data rows, and the rows without a kind that refuse a read."""
    return rows.where(F.col(kind) == "data"), rows.where(F.col(kind).isNull())


def closes_of_record(rows: DataFrame, tag: str, keys: list[str], stamp: str = "snap_ts") -> tuple[DataFrame, DataFrame]:
    """Rows with the close tag, and the keys that have none or more than one instant of it (B2)."""
    tagged = F.col("close_tag") == tag
    seen = rows.groupBy(*keys).agg(F.countDistinct(F.when(tagged, F.col(stamp))).alias("instants"), F.count_if(tagged & F.col(stamp).isNull()).alias("unreadable"))
    bad = seen.where("instants <> 1 or unreadable > 0")
    return rows.where(tagged).join(bad.select(*keys), keys, "left_anti"), bad


def within_sessions(rows: DataFrame, calendar: DataFrame, stamp: str = "snap_ts") -> DataFrame:
    """Rows inside their session's bounds."""
    return rows.join(calendar.select("day", "open_at", "close_at"), "day").where(F.col(stamp).between(F.col("open_at"), F.col("close_at"))).drop("open_at", "close_at")


def between_days(rows: DataFrame, start: str | None, end: str | None, day: str = "day") -> DataFrame:
    """A range of sessions with open ends (B8); on a table partitioned by day only its folders are read."""
    if start:
        rows = rows.where(F.col(day) >= F.lit(start).cast("date"))
    return rows.where(F.col(day) <= F.lit(end).cast("date")) if end else rows


def slot_aggregate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per slot: data, gap and other rows, suspects and error classes."""
    kind = F.col("row_kind")
    return rows.groupBy(*keys).agg(
        F.count_if(kind == "data").alias("data_rows"),
        F.count_if(kind == "gap").alias("gap_rows"),
        F.count_if(kind.isNull() | ~kind.isin("data", "gap")).alias("other_rows"),
        F.bool_or(F.coalesce("suspect", F.lit(False))).alias("suspect"),
        F.array_sort(F.collect_set("error_class")).alias("errors"),
    )


def every_ticker(slots: DataFrame, spans: DataFrame) -> DataFrame:
    """Every slot with every ticker: the tickers travel as one row, and each slot gives a row for each."""
    names = spans.agg(F.collect_set("ticker").alias("_t"))
    return slots.join(F.broadcast(names)).select(F.explode("_t").alias("ticker"), "day", "slot")


def span_days(spans: DataFrame, until: DataFrame, at: str) -> DataFrame:
    """A row for each day that a span touches, through the last one of `until` where the span is open; days meet slots and sessions by equality."""
    last = until.agg(F.max(F.to_date(at)).alias("_last"))
    stop = F.least(F.coalesce(F.to_date("span_end"), F.col("_last")), F.col("_last"))
    days = F.when(stop >= F.to_date("span_start"), F.sequence(F.to_date("span_start"), stop))
    return spans.join(F.broadcast(last)).select(*spans.columns, F.explode(days).alias("_day"))


def spans_of_sessions(spans: DataFrame, calendar: DataFrame) -> DataFrame:
    """ticker and day of the sessions that a span overlaps."""
    overlap = (F.col("span_start") <= F.col("close_at")) & (F.col("span_end").isNull() | (F.col("span_end") > F.col("open_at")))
    bounds = calendar.select("day", "open_at", "close_at", F.explode(F.sequence(F.to_date("open_at"), F.to_date("close_at"))).alias("_day"))
    return span_days(spans, calendar, "close_at").join(bounds, "_day").where(overlap).select("ticker", "day").distinct()


def slot_status(slots: DataFrame, spans: DataFrame, aggregate: DataFrame, now: Column, grace_minutes: int = 2) -> DataFrame:
    """Every slot of every ticker with its status (D2): captured, suspect, out_of_scope, gap, pending or missing.

    A ticker may have several spans; a slot is in scope if any covers it.
    """
    grid = every_ticker(slots, spans).join(owed_slots(slots, spans).withColumn("_in", F.lit(True)), ["ticker", "day", "slot"], "left")
    j = grid.withColumn("in_scope", F.coalesce("_in", F.lit(False))).join(aggregate, ["ticker", "slot"], "left")
    pending = F.col("slot") > now - F.make_dt_interval(mins=F.lit(grace_minutes))
    status = F.when(F.col("data_rows") > 0, F.when(F.col("suspect"), "suspect").otherwise("captured")).when(~F.col("in_scope"), "out_of_scope").when(F.col("data_rows").isNotNull(), "gap").when(pending, "pending").otherwise("missing")
    return j.select("ticker", "day", "slot", status.alias("status"))


def history(status: DataFrame) -> DataFrame:
    """Statuses per ticker and day; the share captured of judged slots, null where none is judged (D3)."""
    names = ("captured", "suspect", "gap", "missing", "pending", "out_of_scope")
    c = status.groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("slots"), *(F.count_if(F.col("status") == n).alias(n) for n in names))
    judged = F.col("slots") - F.col("out_of_scope") - F.col("pending")
    return c.withColumn("judged", judged).withColumn("captured_percent", F.when(judged > 0, F.round(100 * (F.col("captured") + F.col("suspect")) / judged, 1)))


def latest_cycle(rows: DataFrame, calendar: DataFrame, now: Column, sessions: int = 10, stale_minutes: int = 3) -> DataFrame:
    """The newest slot with data per ticker within the last sessions, its age, and whether it is stale."""
    last = calendar.agg(F.max("idx").alias("_m"))
    recent = calendar.join(F.broadcast(last)).where(F.col("idx") > F.col("_m") - sessions).select("day")
    newest = rows.where("row_kind = 'data'").join(recent, "day", "left_semi").groupBy("ticker").agg(F.max("slot").alias("newest"))
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp("newest")) / 60)
    return newest.select("ticker", "newest", age.cast("long").alias("minutes"), (age > stale_minutes).alias("stale"))


def owed_slots(slots: DataFrame, spans: DataFrame, chains: bool = False) -> DataFrame:
    """Slots that some span of a ticker covers (C4)."""
    s = spans.where("options") if chains else spans
    met = slots.withColumn("_day", F.to_date("slot")).join(span_days(s, slots, "slot").select("ticker", "span_start", "span_end", "_day"), "_day")
    return met.where(covers(F.col("slot"), F.col("span_start"), F.col("span_end"))).select("ticker", "day", "slot").distinct()


def missing_slots(owed: DataFrame, recorded: DataFrame, calendar: DataFrame | None = None, cap: int = 90) -> DataFrame:
    """Owed slots without a row of any kind.

    With a calendar the walk back ends at the last complete day of a ticker, and after cap sessions.
    """
    miss = owed.join(recorded.select("ticker", "slot").distinct(), ["ticker", "slot"], "left_anti")
    if calendar is None:
        return miss
    days = owed.groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("owed"))
    bad = miss.groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("missing"))
    complete = days.join(bad, ["ticker", "day"], "left").where("missing is null").groupBy("ticker").agg(F.max("day").alias("_complete"))
    last = calendar.agg(F.max("idx").alias("_m"))
    recent = calendar.join(F.broadcast(last)).where(F.col("idx") > F.col("_m") - cap).select("day")
    return miss.join(recent, "day", "left_semi").join(complete, "ticker", "left").where("_complete is null or day > _complete").select("ticker", "day", "slot")


def gap_rows(missing: DataFrame, error_class: str = "missed_slot") -> DataFrame:
    """A recorded absence for each missing slot: only its key, kind and error are set."""
    return missing.select("ticker", F.col("slot").alias("snap_ts"), "slot", "day", F.lit("gap").alias("row_kind"), F.lit(error_class).alias("error_class"))


def with_gaps(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """Data and markers in one snapshot, by name (T5)."""
    return rows.unionByName(gaps, allowMissingColumns=True)


def gap_counts(days: DataFrame, rows: DataFrame) -> DataFrame:
    """Gap rows of each day; null, not zero, where nothing was recorded at all."""
    c = rows.groupBy("day").agg(F.count_if(F.col("row_kind") == "gap").alias("gaps"))
    return days.select("day").join(c, "day", "left")


def cycles(rows: DataFrame, zone: str = "America/New_York") -> DataFrame:
    """Distinct wall minutes with data, on the session's own date."""
    local = F.from_utc_timestamp("snap_ts", zone)
    return rows.where((F.col("row_kind") == "data") & (F.to_date(local) == F.col("day"))).select("ticker", "day", F.date_format(local, "HH:mm").alias("minute")).distinct()


def skipped(ticks: DataFrame, slots: DataFrame, key: str = "ticker", minutes: int = 1) -> DataFrame:
    """Slots strictly between two neighbouring ticks of a key (K2).

    The minutes of each hole are spelt out and met with the calendar's slots on equality, so no tick meets them all.
    """
    step = F.make_dt_interval(mins=F.lit(minutes))
    w = Window.partitionBy(key).orderBy("tick")
    holes = ticks.select(key, "tick", F.lead("tick").over(w).alias("next")).where(F.col("next") > F.col("tick") + step)
    spelt = holes.select(key, "tick", F.explode(F.sequence(F.col("tick") + step, F.col("next") - step, step)).alias("slot"))
    return spelt.join(slots.select("slot").distinct(), "slot", "left_semi").select(key, "tick", "slot")


def next_session(days: DataFrame, calendar: DataFrame, guard: int = 30) -> DataFrame:
    """The first session strictly after each day, within a guard (C8); days need not be sessions.

    The guard bounds the days to look at, so it is an equi join and no ordering of all days.
    """
    d = days.select("day").distinct()
    ahead = d.select("day", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", guard))).alias("next"))
    found = ahead.join(calendar.select(F.col("day").alias("next")), "next", "left_semi").groupBy("day").agg(F.min("next").alias("next_session"))
    return d.join(found, "day", "left")


def window_edge(calendar: DataFrame, day: str, sessions: int) -> DataFrame:
    """The session so many back from a day, that day first if it is one."""
    return calendar.where(F.col("day") <= F.lit(day).cast("date")).orderBy(F.desc("day")).limit(sessions).agg(F.min("day").alias("edge"))


def failures(rows: DataFrame, key: list[str], order: str = "snap_ts", threshold: int = 3) -> DataFrame:
    """Rows with the number of consecutive failures up to them, and whether this one reaches the threshold."""
    good = F.col("row_kind") == "data"
    bad = F.when(good, 0).otherwise(1)
    return scans.since_reset(rows, key, order, bad, good, "failures").withColumn("pages", F.col("failures") == threshold)


def coverage(spans: DataFrame, calendar: DataFrame, present: DataFrame, on_purpose: DataFrame | None = None) -> DataFrame:
    """Sessions that a span overlaps and nothing records, but for absences on purpose."""
    out = spans_of_sessions(spans, calendar).join(present.select("ticker", "day"), ["ticker", "day"], "left_anti")
    return out if on_purpose is None else out.join(on_purpose.select("ticker", "day"), ["ticker", "day"], "left_anti")
