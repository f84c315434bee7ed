"""Streams with timers over the events, taken up again from their checkpoints several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.plans.registry import query
from tickframe.plans.running import scratch
from tickframe.sources.adapters import Tables, text
from tickframe.streaming import timers as V


def in_lots(rows: DataFrame, operator: Callable[[DataFrame], DataFrame], lots: int = 3) -> DataFrame:
    """rows (with ``at``) land in so many lots, one after another in time; after each the stream goes on from its checkpoint and stops."""
    session, path = V.stateful(rows.sparkSession), scratch(rows.sparkSession)
    first, last = rows.agg(F.unix_micros(F.min("at")), F.unix_micros(F.max("at"))).first()
    lot = (F.unix_micros("at") - F.lit(first)) * lots / F.lit(last - first + 1)
    out, schema = None, rows.schema
    for k in range(lots):
        rows.where(F.floor(lot) == k).write.mode("append").parquet(f"{path}/in")
        out = operator(session.readStream.schema(schema).parquet(f"{path}/in"))
        sink = lambda batch, _: batch.write.mode("append").parquet(f"{path}/out")
        out.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    return rows.sparkSession.read.schema(out.schema).parquet(f"{path}/out")


def each_ticker(t: Tables, days: DataFrame) -> DataFrame:
    """Days of each ticker that has a span."""
    return days.join(F.broadcast(t.spans().agg(F.collect_list("ticker").alias("_t")))).select("*", F.explode("_t").alias("ticker")).drop("_t")


def slot_rows(t: Tables) -> DataFrame:
    days = each_ticker(t, t.calendar())
    owed = days.select("ticker", "day", (F.col("open_at") - F.expr("interval 1 hour")).alias("at"), F.lit("owed").alias("kind"), F.col("open_at").alias("slot"), F.col("close_at").alias("until"))
    kind = F.when(F.col("row_kind") == "data", "row").otherwise("clock")
    return owed.unionByName(t.slots().select("ticker", "day", F.col("snap_ts").alias("at"), kind.alias("kind"), "slot", F.lit(None).cast("timestamp").alias("until")))


@query(
    "timed_gaps",
    """WITH h AS (SELECT day, unnest(generate_series(open_at, close_at, INTERVAL 1 HOUR)) AS slot FROM calendar), o AS (SELECT p.ticker, h.day, h.slot FROM h, spans p)
       SELECT ticker, day, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, 'gap' AS row_kind FROM o
       WHERE slot + INTERVAL 3 HOUR <= (SELECT max(snap_ts) FROM slots) - INTERVAL 1 MINUTE AND NOT EXISTS (SELECT 1 FROM slots s WHERE s.ticker = o.ticker AND s.slot = o.slot AND s.row_kind = 'data')""",
    dates="day",
)
def timed_gaps(t: Tables):
    """Hours without a data row, told two hours after their end."""
    return in_lots(slot_rows(t), lambda x: V.missed_slots(x, 60, "2 hours")).select("ticker", "day", text("slot").alias("slot"), "row_kind")


def close_rows(t: Tables) -> DataFrame:
    """A ticker owes the closes that its span covers, the option close only where options are captured. Rows of the hour of the close are captures of one
    of the two, which arrive up to eight minutes after it."""
    after = lambda c, m: F.col(c) + F.make_dt_interval(mins=m)
    closes = t.calendar().select("day", "open_at", F.explode(F.array(*(F.struct(F.lit(tag).alias("close_tag"), after("close_at", F.lit(m)).alias("close_at")) for tag, m in (("spot_close", 0), ("option_close", 15))))).alias("x")).select("day", "open_at", "x.*")
    spans = t.spans()
    owed = each_ticker(t, closes).join(F.broadcast(spans), "ticker").where((F.col("close_at") >= F.col("span_start")) & (F.col("span_end").isNull() | (F.col("close_at") < F.col("span_end"))) & (F.col("options") | (F.col("close_tag") == "spot_close")))
    none = lambda kind: F.lit(None).cast(kind)
    owed = owed.select("ticker", "day", F.col("open_at").alias("at"), F.lit("owed").alias("kind"), "close_tag", "close_at", none("long").alias("row_id"))
    tag = F.when(F.col("event_id") % 2 == 0, "spot_close").otherwise("option_close")
    s = t.slots().select("ticker", "day", "event_id", "slot", "snap_ts", tag.alias("close_tag"))
    j = s.join(F.broadcast(closes.drop("open_at")), ["day", "close_tag"]).where(F.col("slot") == F.date_trunc("hour", "close_at"))
    rows = j.select("ticker", "day", after("close_at", (F.col("event_id") % 9).cast("int")).alias("at"), F.lit("row").alias("kind"), "close_tag", "close_at", F.col("event_id").alias("row_id"))
    clock = s.select("ticker", "day", F.col("snap_ts").alias("at"), F.lit("clock").alias("kind"), none("string").alias("close_tag"), none("timestamp").alias("close_at"), none("long").alias("row_id"))
    return owed.unionByName(rows).unionByName(clock)


@query(
    "timed_closes",
    """WITH k AS (SELECT day, 'spot_close' AS close_tag, close_at FROM calendar UNION ALL SELECT day, 'option_close', close_at + INTERVAL 15 MINUTE FROM calendar),
       owed AS (SELECT p.ticker, k.* FROM k, spans p WHERE k.close_at >= p.span_start AND (p.span_end IS NULL OR k.close_at < p.span_end) AND (p.options OR k.close_tag = 'spot_close')),
       r AS (SELECT s.ticker, s.day, k.close_tag, s.event_id AS row_id, k.close_at, k.close_at + to_minutes(CAST(s.event_id % 9 AS INTEGER)) AS moment FROM slots s JOIN k ON k.day = s.day AND k.close_tag = CASE WHEN s.event_id % 2 = 0 THEN 'spot_close' ELSE 'option_close' END AND s.slot = date_trunc('hour', k.close_at)),
       j AS (SELECT r.*, CASE WHEN o.ticker IS NULL THEN 'not_owed' WHEN r.moment > r.close_at + INTERVAL 5 MINUTE THEN 'refused' ELSE 'accepted' END AS outcome FROM r LEFT JOIN owed o ON o.ticker = r.ticker AND o.day = r.day AND o.close_tag = r.close_tag),
       w AS (SELECT max(moment) - INTERVAL 1 MINUTE AS w FROM (SELECT moment FROM r UNION ALL SELECT snap_ts FROM slots))
       SELECT ticker, day, close_tag, row_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS at, outcome FROM j
       UNION ALL SELECT ticker, day, close_tag, NULL, strftime(close_at + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S'), 'missing' FROM owed o, w
       WHERE o.close_at + INTERVAL 5 MINUTE <= w.w AND NOT EXISTS (SELECT 1 FROM j WHERE j.ticker = o.ticker AND j.day = o.day AND j.close_tag = o.close_tag AND j.outcome = 'accepted')""",
    dates="day",
)
def timed_closes(t: Tables):
    return in_lots(close_rows(t), V.guarded_closes).withColumn("at", text("at"))


def ping_rows(t: Tables) -> DataFrame:
    days = each_ticker(t, t.calendar())
    bound = lambda c, kind: days.select(F.col("ticker").alias("key"), F.col(c).alias("at"), F.lit(kind).alias("kind"))
    ping = (F.col("row_kind") == "data") & (F.col("event_id") % 3 == 0)
    return bound("open_at", "open").unionByName(bound("close_at", "close")).unionByName(t.slots().select(F.col("ticker").alias("key"), F.col("snap_ts").alias("at"), F.when(ping, "ping").otherwise("clock").alias("kind")))


@query(
    "timed_dead_man",
    """WITH x AS (SELECT ticker AS key, open_at AS moment, 0 AS r FROM calendar, spans UNION ALL SELECT ticker, close_at, 2 FROM calendar, spans
                  UNION ALL SELECT ticker, date_trunc('milliseconds', snap_ts), 1 FROM slots WHERE row_kind = 'data' AND event_id % 3 = 0),
       w AS (SELECT max(moment) - INTERVAL 1 MINUTE AS w FROM (SELECT moment FROM x UNION ALL SELECT snap_ts FROM slots)),
       o AS (SELECT *, lead(moment) OVER k AS next, lag(moment) OVER k AS prev, lag(r) OVER k AS prev_r FROM x WINDOW k AS (PARTITION BY key ORDER BY moment, r))
       SELECT key, strftime(moment + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') AS at, 'starved' AS event FROM o, w WHERE r < 2 AND coalesce(next > moment + INTERVAL 4 HOUR, moment + INTERVAL 4 HOUR < w.w)
       UNION ALL SELECT key, strftime(moment, '%Y-%m-%d %H:%M:%S'), 'recovered' FROM o WHERE r = 1 AND prev_r < 2 AND moment > prev + INTERVAL 4 HOUR""",
)
def timed_dead_man(t: Tables):
    return in_lots(ping_rows(t), lambda x: V.dead_man(x, "4 hours")).withColumn("at", text("at"))
