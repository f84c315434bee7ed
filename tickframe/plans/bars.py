"""Bars and the actions ledger over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import bars as B
from tickframe.operators import ledger as L
from tickframe.plans.registry import query
from tickframe.sources.adapters import Tables

KEY = ["instrument_id", "ex_date", "type"]

_LATEST = """led AS (SELECT instrument_id, ex_date, type, arg_max(split_ratio, seq) AS split_ratio, arg_max(cash_amount, seq) AS cash_amount,
             max(seq) AS seq FROM actions GROUP BY 1, 2, 3)"""
_SPLIT = """adj AS (SELECT b.instrument_id, b.session, coalesce(product(a.split_ratio), 1) AS f, any_value(b.open) AS open, any_value(b.high) AS high,
             any_value(b.low) AS low, any_value(b.close) AS close, any_value(b.volume) AS volume
             FROM bars b LEFT JOIN led a ON a.instrument_id = b.instrument_id AND a.ex_date > b.session AND a.type = 'split' GROUP BY 1, 2)"""


def splits_and_dividends(t: Tables, day: str | None = None):
    led = L.as_of(t.actions(), KEY, day) if day else L.latest(t.actions(), KEY)
    return led.where("type = 'split'"), led.where("type = 'dividend'")


@query("adjusted_bars_split", f"WITH {_LATEST}, {_SPLIT} SELECT instrument_id, session, open / f AS open, high / f AS high, low / f AS low, close / f AS close, CAST(round(volume * f) AS BIGINT) AS volume FROM adj", dates="session")
def adjusted_bars_split(t: Tables):
    s, _ = splits_and_dividends(t)
    return B.split_adjusted(t.bars(), s).select("instrument_id", "session", "open", "high", "low", "close", "volume")


@query("adjusted_bars_as_of", f"WITH {_LATEST.replace('FROM actions', "FROM actions WHERE recorded_on <= DATE '1998-06-30'")}, {_SPLIT} SELECT instrument_id, session, close / f AS close, CAST(round(volume * f) AS BIGINT) AS volume FROM adj", dates="session")
def adjusted_bars_as_of(t: Tables):
    s, _ = splits_and_dividends(t, "1998-06-30")
    return B.split_adjusted(t.bars(), s).select("instrument_id", "session", "close", "volume")


@query("ledger_latest", "SELECT instrument_id, ex_date, type, arg_max(split_ratio, seq) AS split_ratio, arg_max(cash_amount, seq) AS cash_amount, max(seq) AS seq FROM actions GROUP BY 1, 2, 3", dates="ex_date")
def ledger_latest(t: Tables):
    return L.latest(t.actions(), KEY).select(*KEY, "split_ratio", "cash_amount", "seq")


@query("ledger_as_of", "SELECT instrument_id, ex_date, type, arg_max(cash_amount, seq) AS cash_amount, max(seq) AS seq FROM actions WHERE recorded_on <= DATE '1997-03-15' GROUP BY 1, 2, 3", dates="ex_date")
def ledger_as_of(t: Tables):
    return L.as_of(t.actions(), KEY, "1997-03-15").select(*KEY, "cash_amount", "seq")


_PRIOR = f"""{_LATEST}, prior AS (SELECT a.instrument_id, a.ex_date, any_value(a.cash_amount) AS cash_amount, max(b.session) AS priced_on, arg_max(b.close, b.session) AS prior_close
             FROM led a LEFT JOIN bars b ON b.instrument_id = a.instrument_id AND b.session < a.ex_date AND b.close > 0 WHERE a.type = 'dividend' GROUP BY 1, 2)"""


@query("prior_close", f"WITH {_PRIOR} SELECT instrument_id, ex_date, cash_amount, priced_on, prior_close FROM prior", dates="ex_date priced_on")
def prior_close(t: Tables):
    _, d = splits_and_dividends(t)
    return B.prior_close(d, t.bars()).select("instrument_id", "ex_date", "cash_amount", "priced_on", "prior_close")


@query(
    "total_return_bars",
    f"""WITH {_PRIOR}, {_SPLIT},
    carry AS (SELECT p.instrument_id, p.ex_date, any_value(p.cash_amount) AS a, any_value(p.prior_close) / coalesce(product(s.split_ratio), 1) AS c
              FROM prior p LEFT JOIN led s ON s.type = 'split' AND s.instrument_id = p.instrument_id AND s.ex_date > p.priced_on AND s.ex_date <= p.ex_date GROUP BY 1, 2),
    paid AS (SELECT instrument_id, ex_date, CASE WHEN a < c THEN 1 - a / c ELSE 1 END AS f, CASE WHEN a < c THEN 0 ELSE 1 END AS bad FROM carry),
    tot AS (SELECT b.instrument_id, b.session, product(p.f) AS f, sum(p.bad) AS bad FROM bars b JOIN paid p ON p.instrument_id = b.instrument_id AND p.ex_date > b.session GROUP BY 1, 2)
    SELECT x.instrument_id, x.session, CAST(floor(x.close / x.f * coalesce(t.f, 1) * 1000 + 0.37) AS BIGINT) AS close_mills, CAST(round(x.volume * x.f) AS BIGINT) AS volume, CAST(coalesce(t.bad, 0) AS BIGINT) AS refused
    FROM adj x LEFT JOIN tot t USING (instrument_id, session)""", dates="session")
def total_return_bars(t: Tables):
    s, d = splits_and_dividends(t)
    return B.total_return(t.bars(), s, d).select("instrument_id", "session", F.floor(F.col("close") * 1000 + 0.37).alias("close_mills"), "volume", "refused")


@query("bar_session_dates", "SELECT event_id, CAST(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' + INTERVAL 6 HOUR AS DATE) AS VARCHAR) AS daily, CAST(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS VARCHAR) AS minute FROM events")
def bar_session_dates(t: Tables):
    ts = F.col("ts").cast("timestamp")
    return t.table("events").select("event_id", B.session_of(ts).cast("string").alias("daily"), B.session_of(ts, daily=False).cast("string").alias("minute"))


@query("last_close_by_instant", "SELECT ticker, day, arg_max(value, snap_ts) AS close, strftime(max(snap_ts), '%Y-%m-%d %H:%M:%S') AS at FROM slots GROUP BY 1, 2", dates="day")
def last_close_by_instant(t: Tables):
    return B.last_close(t.slots(), ["ticker", "day"], "snap_ts", "value").select("ticker", "day", "close", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "bar_span_gate",
    """SELECT s.ticker, s.day, count(*) AS bars, count(*) FILTER (WHERE s.slot < c.open_at OR s.slot >= c.close_at) AS outside,
       CASE WHEN count(*) FILTER (WHERE s.slot < c.open_at OR s.slot >= c.close_at) > 0 THEN 'outside_session' WHEN min(s.slot) > any_value(c.open_at) THEN 'late_start'
            WHEN max(s.slot) < any_value(c.close_at) - INTERVAL 60 MINUTE THEN 'early_end' ELSE 'complete' END AS reason
       FROM slots s JOIN calendar c USING (day) GROUP BY 1, 2""", dates="day")
def bar_span_gate(t: Tables):
    return B.span_gate(t.slots(), t.calendar(), ["ticker"], "slot", 60)


@query(
    "close_cross_check",
    """WITH q AS (SELECT instrument_id, session, CASE WHEN instrument_id % 3 = 0 THEN close * 1.01::DOUBLE ELSE close * 1.0001::DOUBLE END AS quote_close FROM bars WHERE instrument_id % 5 <> 0)
       SELECT b.instrument_id, b.session, b.close AS bar_close, q.quote_close, coalesce(abs(b.close - q.quote_close) / abs(q.quote_close) <= 5e-4, false) AS agree
       FROM bars b LEFT JOIN q USING (instrument_id, session)""", dates="session")
def close_cross_check(t: Tables):
    b = t.bars().select("instrument_id", "session", F.col("close").alias("bar_close"))
    q = b.where("instrument_id % 5 <> 0").select("instrument_id", "session", (F.col("bar_close") * F.when(F.col("instrument_id") % 3 == 0, 1.01).otherwise(1.0001)).alias("quote_close"))
    return B.close_cross(b, q, ["instrument_id", "session"]).select("instrument_id", "session", "bar_close", "quote_close", "agree")
