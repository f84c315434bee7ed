"""Payloads and streams over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.operators import payload as P
from tickframe.plans.registry import query
from tickframe.plans.running import event_rows, event_stream, run_in_lots, run_once, scratch
from tickframe.sources.adapters import Tables, text
from tickframe.streaming import live as V


@query("live_slots", "SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, ticker, count(*) FILTER (WHERE row_kind = 'data') AS data_rows, count(*) FILTER (WHERE row_kind = 'gap') AS gap_rows, bool_or(suspect) AS suspect FROM slots GROUP BY slots.slot, ticker")
def live_slots(t: Tables):
    return run_once(V.live_slots(event_stream(t), ["ticker"], 60), "complete").withColumn("slot", text("slot"))


@query(
    "live_watchdog",
    """WITH o AS (SELECT *, CASE WHEN row_kind = 'data' THEN 1 ELSE 0 END AS ok FROM slots), i AS (SELECT *, sum(ok) OVER (PARTITION BY ticker ORDER BY snap_ts, event_id) AS isl FROM o),
       r AS (SELECT *, sum(1 - ok) OVER (PARTITION BY ticker, isl ORDER BY snap_ts, event_id) AS n FROM i), b AS (SELECT *, lag(n) OVER (PARTITION BY ticker ORDER BY snap_ts, event_id) AS before FROM r)
       SELECT ticker, strftime(snap_ts, '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN ok = 0 THEN 'failing' ELSE 'recovered' END AS event, CAST(CASE WHEN ok = 0 THEN n ELSE before END AS BIGINT) AS failures FROM b WHERE n = 2 AND ok = 0 OR ok = 1 AND before >= 2""",
)
def live_watchdog(t: Tables):
    order = ["snap_ts", "event_id"]
    rows = event_rows(t.table("events")).select("ticker", *order, "row_kind")
    pages = run_in_lots(rows, lambda x: V.watchdog(x, threshold=2, order=tuple(order)), order)
    return pages.select("ticker", text("at").alias("at"), "event", F.col("failures").cast("long").alias("failures"))


@query(
    "live_drift_pages",
    """WITH d AS (SELECT ticker, event_id, snap_ts, CASE WHEN row_kind = 'data' THEN event_id % 5 = 0 END AS x FROM slots), k AS (SELECT *, row_number() OVER (ORDER BY snap_ts, event_id) AS i FROM d WHERE x IS NOT NULL),
       e AS (SELECT i, ticker, snap_ts, x, lag(x) OVER (PARTITION BY ticker ORDER BY i) AS was FROM k), h AS (SELECT *, sum(CASE WHEN x AND NOT coalesce(was, false) THEN 1 WHEN NOT x AND was THEN -1 ELSE 0 END) OVER (ORDER BY i) AS held FROM e)
       SELECT ticker, strftime(snap_ts, '%Y-%m-%d %H:%M:%S') AS at FROM h WHERE x AND NOT coalesce(was, false) AND held = 1""",
)
def live_drift_pages(t: Tables):
    order = ["snap_ts", "event_id"]
    rows = event_rows(t.table("events")).select(F.lit("chains").alias("surface"), F.lit("bid").alias("column"), "ticker", *order, F.when(F.col("row_kind") == "data", F.col("event_id") % 5 == 0).alias("drifts"))
    return run_in_lots(rows, lambda x: V.drift_pages(x, tuple(order)), order).select("ticker", text("at").alias("at"))


@query("dead_man", "SELECT ticker AS key, max(epoch(snap_ts)) - max(epoch(snap_ts)) FILTER (WHERE row_kind = 'data' AND event_id % 50 = 0) > 36000 AS starved FROM slots GROUP BY 1")
def dead_man(t: Tables):
    pings = event_stream(t).select(F.col("ticker").alias("key"), F.col("snap_ts").alias("owed_at"), F.when((F.col("row_kind") == "data") & (F.col("event_id") % 50 == 0), F.col("snap_ts")).alias("ping_at"))
    return run_once(V.freshness(pings, 600), "complete").select("key", "starved")


@query(
    "folded_pages",
    """WITH g AS (SELECT slot, error_class AS cause, string_agg(DISTINCT ticker, ',' ORDER BY ticker) AS keys, count(DISTINCT ticker) AS c FROM slots WHERE row_kind = 'gap' GROUP BY 1, 2)
       SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS at, cause, keys, CASE WHEN c = (SELECT count(DISTINCT ticker) FROM slots) THEN 'all' ELSE 'some' END AS scope FROM g""",
)
def folded_pages(t: Tables):
    pages = event_stream(t).where("row_kind = 'gap'").select("ticker", F.col("snap_ts").alias("at"), F.col("error_class").alias("cause"))
    return run_once(V.fold_pages(pages, t.spans(), 60), "complete").withColumns({"at": text("at"), "keys": F.array_join("keys", ",")})


@query("late_rows", "SELECT event_id, day > DATE '2024-01-20' AS open_day FROM slots")
def late_rows(t: Tables):
    ok, late = (run_once(x, "append") for x in V.split_late(event_stream(t).withColumn("day", F.to_date("snap_ts")), "2024-01-20"))
    return ok.select("event_id", F.lit(True).alias("open_day")).unionByName(late.select("event_id", F.lit(False).alias("open_day")))


@query("landed_segments", "SELECT event_id, event_type || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS segment, value FROM events")
def landed_segments(t: Tables):
    """The stream is run twice from its start, as after a crash; every segment lands once."""
    path = scratch(t.spark)
    rows = event_stream(t).select("event_id", F.concat_ws("-", "ticker", F.to_date("snap_ts").cast("string")).alias("segment"), "value")
    sink = lambda batch, _: V.land_once(batch, f"{path}/rows", f"{path}/manifest")
    for run in range(2):
        rows.writeStream.option("checkpointLocation", f"{path}/checkpoint-{run}").trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    return V.landed(t.spark, f"{path}/rows", f"{path}/manifest").select("event_id", F.col("segment").cast("string").alias("segment"), "value")


def bodies(t: Tables, *parts) -> DataFrame:
    return t.table("events").select("event_id", F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("snap_ts"), F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)).alias("body"))


@query(
    "chain_payloads",
    """SELECT event_type AS ticker, x.put_call, DATE '2024-02-01' AS expiration, 10.0::DOUBLE AS strike, x.s || event_id AS symbol, CASE WHEN x.s = 'c' THEN event_id / 4.0::DOUBLE END AS bid, count(*) OVER (PARTITION BY event_type, ts) AS number_of_contracts, event_id % 2 = 0 AS is_chain_truncated,
       CASE WHEN x.s = 'c' THEN '{"odd":"1","zed":"2"}' END AS extra FROM events, (VALUES ('CALL', 'c'), ('PUT', 'p')) AS x(put_call, s)""",
    dates="expiration",
)
def chain_payloads(t: Tables):
    i = F.col("event_id")
    b = bodies(t, '{"symbol":"s","isTruncated":', (i % 2 == 0), ',"callExpDateMap":{"2024-02-01:5":{"10.0":[{"symbol":"c', i, '","bidPrice":', (i / 4), ',"zed":2,"odd":1}]}},"putExpDateMap":{"2024-02-01:5":{"10.0":[{"symbol":"p', i, '","bidPrice":null}]}}}')
    rows = P.chains(b, {"symbol": "string", "bidPrice": "double"})
    return rows.select("ticker", "put_call", "expiration", "strike", "symbol", F.col("bid_price").alias("bid"), "number_of_contracts", "is_chain_truncated", "extra")


@query("quote_payloads", "SELECT 'S' || event_id AS ticker, value AS bid_price, CASE WHEN event_id % 3 = 0 THEN 'r' ELSE 'f' END || event_id AS cusip, user_id::DOUBLE AS fundamental_div_amount, '{\"extended.spread\":\"7\"}' AS extra FROM events")
def quote_payloads(t: Tables):
    i = F.col("event_id")
    ref = F.when(i % 3 == 0, F.concat(F.lit(',"reference":{"cusip":"r'), i, F.lit('"}'))).otherwise("")
    b = bodies(t, '{"S', i, '":{"quote":{"bidPrice":', F.col("value"), '},"fundamental":{"divAmount":', F.col("user_id"), ',"cusip":"f', i, '"},"extended":{"spread":7}', ref, "}}")
    rows = P.quotes(b, {"quote": {"bidPrice": "double"}, "fundamental": {"divAmount": "double"}})
    return rows.select("ticker", "bid_price", "cusip", "fundamental_div_amount", "extra")


@query("candle_payloads", "SELECT event_type AS ticker, (epoch_us(ts) // 1000)::BIGINT AS ms, value AS close, user_id AS volume, '{\"note\":\"candle\",\"page\":\"3\"}' AS extra FROM events")
def candle_payloads(t: Tables):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    b = bodies(t, '{"symbol":"x","empty":false,"page":3,"note":"body","candles":[{"datetime":', ms, ',"close":', F.col("value"), ',"volume":', F.col("user_id"), ',"note":"candle"},{"datetime":null,"close":1},{"datetime":"soon","close":1}]}')
    return P.candles(b).select("ticker", F.unix_millis("bar_ts").alias("ms"), "close", "volume", "extra")


@query(
    "retype_routing",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_id END AS size, CASE WHEN event_id % 4 <> 3 THEN value END AS bid,
       CASE WHEN event_id % 7 = 0 OR event_id % 97 = 0 THEN NULL WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN '{"size":"1.5"}' WHEN event_id % 4 = 2 THEN '{"size":"true"}' ELSE '{"bid":"false","size":"\\"9\\""}' END AS extra FROM events""",
)
def retype_routing(t: Tables):
    i = F.col("event_id")
    size = F.when(i % 4 == 0, i.cast("string")).when(i % 4 == 1, F.lit("1.5")).when(i % 4 == 2, F.lit("true")).otherwise('"9"')
    bid = F.when(i % 4 == 3, F.lit("false")).otherwise(F.col("value").cast("string"))
    kind = F.when(i % 7 == 0, "gap").when(i % 97 == 0, None).otherwise("data")
    rows = bodies(t, '{"size":', size, ',"bid":', bid, "}").withColumn("row_kind", kind)
    return P.routed(rows, "body", {"size": "bigint", "bid": "double"}).select("event_id", "size", "bid", "extra")


@query("routed_columns", "SELECT event_type AS ticker, 'bid,size' AS routed FROM events GROUP BY 1")
def routed_columns(t: Tables):
    rows = bodies(t, F.when(F.col("event_id") % 2 == 0, '{"size":"x","odd":1}').otherwise('{"bid":true}'))
    return P.routed_columns(rows, ["ticker"], ["bid", "size", "ask"], "body").withColumn("routed", F.array_join("routed", ","))


@query("overflow_projection", "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE CASE WHEN event_id % 3 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END END AS k FROM events")
def overflow_projection(t: Tables):
    rows = t.table("events").select("event_id", (F.col("event_id") % 3).cast("int").alias("schema_version"), F.lit(None).cast("long").alias("k"), F.col("props").alias("extra"))
    versions = t.table("region").where("r_regionkey < 2").select(F.col("r_regionkey").alias("schema_version"), F.when(F.col("r_regionkey") == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("k"))).alias("columns"))
    return P.project_versions(rows, versions, {"k": "bigint"})[0].select("event_id", "k")


@query("overflow_report", "SELECT (event_id % 3)::INTEGER AS schema_version, 'k' AS field, CASE event_id % 3 WHEN 1 THEN 'routed' ELSE 'unrecorded_version' END AS state, count(*) AS rows FROM events WHERE event_id % 3 > 0 GROUP BY 1, 2, 3")
def overflow_report(t: Tables):
    rows = t.table("events").select("event_id", (F.col("event_id") % 3).cast("int").alias("schema_version"), F.lit(None).cast("long").alias("k"), F.col("props").alias("extra"))
    versions = t.table("region").where("r_regionkey < 2").select(F.col("r_regionkey").alias("schema_version"), F.when(F.col("r_regionkey") == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("k"))).alias("columns"))
    return P.project_versions(rows, versions, {"k": "bigint"})[1]
