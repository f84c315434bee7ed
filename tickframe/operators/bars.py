"""Bars: session dates, split and total-return views, as-of closes, gates and cross-checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def session_of(stamp: Column, daily: bool = True) -> Column:
    """Session date of a bar's instant (B13): a daily stamp at or past 18:00 in New York names the next date."""
    local = F.from_utc_timestamp(stamp, NEW_YORK)
    return F.to_date(local + F.expr("interval 6 hours")) if daily else F.to_date(local)


def number(c: Column) -> Column:
    """Finite or null (K9)."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def cents(c: Column) -> Column:
    """Whole cents, or null if the value isn't within a millionth of one or leaves 64 bits (K8). Halves go to even."""
    scaled = number(c) * 100
    whole = F.bround(scaled)
    return F.when((F.abs(scaled - whole) <= 1e-6) & (F.abs(whole) < 9e18), whole.cast("long"))


def carried(rows: DataFrame, key: str, day: str, order: list[str], value: str, backward: bool = False) -> DataFrame:
    """rows with `carried`: the last value that isn't null, at or before each row of its key in the given order (backward: at or after it, the next).

    A key's rows are ordered within a year of the day only; a year without a value on that side of a row takes the edge of
    the years beyond, so a hot key is spread over its years. order begins with the day.
    """
    part, turned = F.coalesce(F.year(day), F.lit(-1)), F.desc if backward else F.asc
    own = Window.partitionBy(key, "_part").orderBy(*map(turned, order)).rowsBetween(Window.unboundedPreceding, 0)
    dealt = rows.withColumn("_part", part)
    edge_of = F.min_by if backward else F.max_by
    years = dealt.groupBy(F.col(key).alias("_ek"), F.col("_part").alias("_ep")).agg(edge_of(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    beyond = Window.partitionBy("_ek").orderBy(turned("_ep")).rowsBetween(Window.unboundedPreceding, -1)
    years = years.select("_ek", "_ep", F.last("_end", ignorenulls=True).over(beyond).alias("_edge"))
    local = dealt.withColumn("_own", F.last(value, ignorenulls=True).over(own))
    j = local.join(years, (F.col(key) == F.col("_ek")) & (F.col("_part") == F.col("_ep")), "left")
    return j.withColumn("carried", F.coalesce("_own", "_edge")).drop("_part", "_own", "_ek", "_ep", "_edge")


def next_event(days: DataFrame, events: DataFrame, key: str, day: str, ex: str, values: list[str]) -> DataFrame:
    """Each key and day with the values of the first event strictly after the day, for days that have one. events: one row for each key and ex."""
    e = events.select(F.col(key).alias("_k"), F.col(ex).alias("_d"), F.lit(0).alias("_o"), F.struct(*values).alias("_v"))
    d = days.select(F.col(key).alias("_k"), F.col(day).alias("_d")).distinct().select("_k", "_d", F.lit(1).alias("_o"), F.lit(None).cast(e.schema["_v"].dataType).alias("_v"))
    met = carried(e.unionByName(d), "_k", "_d", ["_d", "_o"], "_v", backward=True).where("_o = 1 and carried is not null")
    return met.select(F.col("_k").alias(key), F.col("_d").alias(day), "carried.*")


def factors(sessions: DataFrame, events: DataFrame, value: Column | str, key: str = "instrument_id", day: str = "session", ex: str = "ex_date", bad: str | None = None) -> DataFrame:
    """key, day and the product of value over events strictly after the day (C15), for days with any; with bad, that column's sum too.

    A key's events get their running products, from the last one backwards; a day takes that of the first event after it,
    so there is a row for each event and each day, and none for each pair of the two.
    """
    v = F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(1.0))
    e = events.groupBy(key, ex).agg(F.product(v).alias("_f"), F.sum((F.col(bad) if bad else F.lit(0)).cast("long")).alias("_b"))
    later = Window.partitionBy(key).orderBy(F.desc(ex)).rowsBetween(Window.unboundedPreceding, 0)
    e = e.select(key, ex, F.product("_f").over(later).alias("factor"), F.sum("_b").over(later).alias("bad"))
    return next_event(sessions, e, key, day, ex, ["factor", "bad"] if bad else ["factor"])


def split_adjusted(bars: DataFrame, splits: DataFrame, key: str = "instrument_id", day: str = "session") -> DataFrame:
    """Prices over, volume times, the ratios of all later splits; strict ex-dates; volumes round halves away from zero (H1)."""
    f = factors(bars, splits, "split_ratio", key, day)
    by = F.coalesce(F.col("factor"), F.lit(1.0))
    out = bars.join(f, [key, day], "left")
    return out.withColumns({**{c: F.col(c) / by for c in ("open", "high", "low", "close")}, "volume": F.round(F.col("volume") * by).cast("long"), "view": F.lit("split")}).drop("factor")


def prior_close(events: DataFrame, bars: DataFrame, key: str = "instrument_id", ex: str = "ex_date") -> DataFrame:
    """Each event with the last positive finite close strictly before its ex-date, and the session it is of.

    Both sides are laid in one order and the last close is carried forward, so no range join multiplies rows.
    """
    ok = bars.where(number(F.col("close")) > 0).select(F.col(key).alias("_k"), F.col("session").alias("_d"), F.struct("close", "session").alias("_c"), F.lit(1).alias("_o"))
    days = events.select(F.col(key).alias("_k"), F.col(ex).alias("_d")).distinct().select("_k", "_d", F.lit(None).cast(ok.schema["_c"].dataType).alias("_c"), F.lit(0).alias("_o"))
    found = carried(ok.unionByName(days), "_k", "_d", ["_d", "_o"], "_c").where("_o = 0").select("_k", "_d", F.col("carried.close").alias("prior_close"), F.col("carried.session").alias("priced_on"))
    return events.join(found, (F.col(key) == F.col("_k")) & (F.col(ex) == F.col("_d")), "left").drop("_k", "_d")


def total_return(bars: DataFrame, splits: DataFrame, dividends: DataFrame, key: str = "instrument_id", day: str = "session") -> DataFrame:
    """Split view, and prices times the product of 1 - A/C over later dividends (H2).

    C is the prior close carried through splits after the session it is of and up to the dividend's ex-date. A dividend
    without a prior close, or not below it, is refused: it has no factor, and its bars say so in `refused`.
    """
    priced = prior_close(dividends, bars, key)
    asked = priced.select(key, "ex_date", "priced_on").distinct()
    days = asked.where("priced_on < ex_date").select(F.col(key).alias("_k"), "ex_date", F.explode(F.sequence(F.date_add("priced_on", 1), "ex_date")).alias("_x"))  # days from one close to the next event: an equality instead of a range
    of_day = splits.groupBy(F.col(key).alias("_k"), F.col("ex_date").alias("_x")).agg(F.product("split_ratio").alias("_r"))
    carry = days.join(of_day, ["_k", "_x"]).groupBy(F.col("_k").alias(key), "ex_date").agg(F.product("_r").alias("_carry"))
    priced = priced.join(carry, [key, "ex_date"], "left").withColumn("_c", F.col("prior_close") / F.coalesce("_carry", F.lit(1.0)))
    ok = F.coalesce(F.col("cash_amount") < F.col("_c"), F.lit(False))
    paid = priced.select(key, "ex_date", F.when(ok, 1 - F.col("cash_amount") / F.col("_c")).otherwise(1.0).alias("_f"), F.when(ok, 0).otherwise(1).alias("_bad"))
    f = factors(bars, paid, "_f", key, day, bad="_bad").withColumnsRenamed({"factor": "_t", "bad": "refused"})
    out = split_adjusted(bars, splits, key, day).join(f, [key, day], "left")
    by = F.coalesce(F.col("_t"), F.lit(1.0))
    return out.withColumns({**{c: F.col(c) * by for c in ("open", "high", "low", "close")}, "refused": F.coalesce("refused", F.lit(0)), "view": F.lit("total")}).drop("_t")


def last_close(rows: DataFrame, keys: list[str], instant: str, close: str = "close") -> DataFrame:
    """The close of the last bar by instant, not by text."""
    return rows.groupBy(*keys).agg(F.max_by(close, instant).alias("close"), F.max(instant).alias("at"))


def span_gate(bars: DataFrame, calendar: DataFrame, keys: list[str], instant: str = "bar_ts", minutes: int = 1) -> DataFrame:
    """Whether a session's minute bars reach from open to the last minute before close, and none lies outside."""
    j = bars.join(calendar.select("day", "open_at", "close_at"), "day")
    last = F.col("close_at") - F.make_dt_interval(mins=F.lit(minutes))
    outside = (F.col(instant) < F.col("open_at")) | (F.col(instant) >= F.col("close_at"))
    g = j.groupBy(*keys, "day").agg(F.min(instant).alias("first"), F.max(instant).alias("last"), F.count_if(outside).alias("outside"), F.count(F.lit(1)).alias("bars"), F.any_value("open_at").alias("_o"), F.any_value(last).alias("_c"))
    reason = F.when(F.col("outside") > 0, "outside_session").when(F.col("first") > F.col("_o"), "late_start").when(F.col("last") < F.col("_c"), "early_end")
    return g.select(*keys, "day", "bars", "outside", F.coalesce(reason, F.lit("complete")).alias("reason"))


def close_cross(bars: DataFrame, quotes: DataFrame, keys: list[str], tolerance: float = 5e-4) -> DataFrame:
    """Daily close against the captured close: they agree within a relative tolerance; a missing one never agrees; zero only with zero."""
    j = bars.join(quotes, keys, "full_outer")
    a, b = F.col("bar_close"), F.col("quote_close")
    agree = F.when(a.isNull() | b.isNull(), False).when(b == 0, a == 0).otherwise(F.abs(a - b) / F.abs(b) <= tolerance)
    return j.select(*keys, "bar_close", "quote_close", agree.alias("agree"))
