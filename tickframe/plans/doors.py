"""The reading surface over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import lake as K
from tickframe.operators import market as M
from tickframe.operators import payload as P
from tickframe.operators import views as V
from tickframe.plans.market import symbols
from tickframe.plans.operations import files
from tickframe.plans.registry import query
from tickframe.plans.running import event_stream, run_once
from tickframe.sources import sealed
from tickframe.sources.adapters import Tables, text
from tickframe.streaming import live


@query("named_today", "SELECT strftime(slot, '%H:%M') AS slot, count(*) FILTER (WHERE row_kind = 'data') AS data_rows, count(*) FILTER (WHERE row_kind = 'gap') AS gap_rows FROM slots WHERE ticker = 'click' AND day = DATE '2024-01-09' GROUP BY slots.slot")
def named_today(t: Tables):
    return V.NAMED["today"].run(t.spark, {"slots": t.slots()}, ticker="click", day="2024-01-09").withColumn("slot", text("slot", "HH:mm"))


@query("named_now", "SELECT ticker, strftime(max(slot), '%Y-%m-%d %H:%M:%S') AS newest FROM slots WHERE row_kind = 'data' GROUP BY ticker")
def named_now(t: Tables):
    return V.NAMED["now"].run(t.spark, {"slots": t.slots()}).withColumn("newest", text("newest"))


@query("named_history", "SELECT ticker, day, count(*) FILTER (WHERE row_kind = 'data') AS data_rows, count(*) FILTER (WHERE row_kind = 'gap') AS gap_rows FROM slots GROUP BY 1, 2", dates="day")
def named_history(t: Tables):
    return V.NAMED["history"].run(t.spark, {"slots": t.slots()})


@query("named_lake", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS files, CAST(sum(o_orderkey + 1) AS BIGINT) AS bytes FROM orders GROUP BY 1", dates="day")
def named_lake(t: Tables):
    return V.NAMED["lake"].run(t.spark, {"files": files(t)})


@query("named_cost", "SELECT day, product, CAST(sum(cents) AS BIGINT) AS cents FROM costs GROUP BY 1, 2", dates="day")
def named_cost(t: Tables):
    return V.NAMED["cost"].run(t.spark, {"costs": t.costs()})


@query("load_bars_split", "WITH led AS (SELECT instrument_id, ex_date, arg_max(split_ratio, seq) AS r FROM actions WHERE type = 'split' AND recorded_on <= DATE '1999-01-31' GROUP BY 1, 2) SELECT b.instrument_id, b.session, any_value(b.close) / coalesce(product(l.r), 1) AS close FROM bars b LEFT JOIN led l ON l.instrument_id = b.instrument_id AND l.ex_date > b.session WHERE b.session BETWEEN DATE '1998-02-01' AND DATE '1998-03-15' GROUP BY 1, 2", dates="session")
def load_bars_split(t: Tables):
    return V.load_bars(V.Store(bars=t.bars(), actions=t.actions()), "1998-02-01", "1998-03-15", adjust="split", as_of="1999-01-31").select("instrument_id", "session", "close")


@query("contract_life", "SELECT symbol, day FROM (SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'A' || (l_suppkey % 7) ELSE 'B' || l_suppkey END AS symbol, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '1996-06-01') WHERE symbol IN (SELECT id_value FROM master WHERE instrument_id IN (SELECT instrument_id FROM master WHERE id_value = 'A3'))", dates="day")
def contract_life(t: Tables):
    return V.contract_life(symbols(t), t.master(), "A3", "1996-06-01").select("symbol", "day")


@query(
    "continuity_view",
    """WITH led AS (SELECT instrument_id, ex_date, arg_max(split_ratio, seq) AS r FROM actions WHERE type = 'split' AND seq % 3 = 0 GROUP BY 1, 2),
       m AS (SELECT DISTINCT instrument_id, ex_date AS day, CASE WHEN instrument_id % 2 = 0 THEN 'non_scalar' ELSE 'indeterminate' END AS mark FROM actions WHERE type = 'split' AND instrument_id % 5 = 1 AND ex_date < DATE '1997-01-01'),
       f AS (SELECT b.instrument_id, b.session, product(l.r) AS f FROM bars b JOIN led l ON l.instrument_id = b.instrument_id AND l.ex_date > b.session GROUP BY 1, 2),
       j AS (SELECT b.instrument_id, b.session AS day, day(b.session) % 4 <> 0 AS seen, CASE WHEN day(b.session) % 4 <> 0 AND b.volume % 11 <> 0 THEN b.open END AS strike, CASE WHEN b.volume % 13 <> 0 THEN b.close END AS close, coalesce(f.f, 1) AS f,
             (SELECT CASE WHEN bool_or(mark = 'non_scalar') THEN 'non_scalar' ELSE min(mark) END FROM m WHERE m.instrument_id = b.instrument_id AND m.day > b.session) AS standing FROM bars b LEFT JOIN f USING (instrument_id, session)),
       r AS (SELECT *, CASE WHEN NOT seen THEN 'no_close_of_record' WHEN strike IS NULL THEN 'terms_unreadable' WHEN close IS NULL THEN 'close_unreadable' WHEN standing = 'non_scalar' THEN 'deliverable_not_scalar' WHEN standing IS NOT NULL THEN 'boundary_unreadable' END AS reason FROM j)
       SELECT instrument_id, day, CASE WHEN reason IS NULL THEN 'settled' WHEN reason = 'boundary_unreadable' THEN 'indeterminate' ELSE 'absent' END AS verdict, reason, CASE WHEN reason IS NULL THEN strike / f END AS adjusted_strike FROM r""",
    dates="day",
)
def continuity_view(t: Tables):
    b = t.bars().withColumnRenamed("session", "day")
    seen = b.where(F.day("day") % 4 != 0).select("instrument_id", "day", F.when(F.col("volume") % 11 != 0, F.col("open")).alias("strike"), F.lit(1.0).alias("mark"), F.lit(100.0).alias("multiplier"))
    closes = b.where("volume % 13 <> 0").select("instrument_id", "day", "close")
    s = t.actions().where("type = 'split'")
    splits = s.where("seq % 3 = 0").groupBy("instrument_id", "ex_date").agg(F.max_by("split_ratio", "seq").alias("split_ratio"))
    marks = s.where((F.col("instrument_id") % 5 == 1) & (F.col("ex_date") < F.lit("1997-01-01").cast("date"))).select("instrument_id", F.col("ex_date").alias("day"), F.when(F.col("instrument_id") % 2 == 0, "non_scalar").otherwise("indeterminate").alias("mark")).distinct()
    return V.continuity(seen, b.select("instrument_id", "day"), closes, splits, marks).select("instrument_id", "day", "verdict", "reason", "adjusted_strike")


@query("instant_order", "SELECT event_type AS ticker, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id % 2 DESC, event_id) AS place FROM events")
def instant_order(t: Tables):
    """Stamps of two spellings, ordered by what they mean; of one instant, those of the eastern spelling first, each by their ids."""
    ts = F.col("ts").cast("timestamp")
    utc, east = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.concat(F.date_format(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    rows = t.table("events").select(F.col("event_type").alias("ticker"), "event_id", F.when(F.col("event_id") % 2 == 0, utc).otherwise(east).alias("stamp"))
    return V.in_order(rows, "stamp", ["ticker"], [F.col("stamp").endswith("Z"), F.col("event_id")])[0].select("ticker", "event_id", F.col("place").cast("long").alias("place"))


@query("held_findings", "SELECT DISTINCT event_type AS symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS observed_on, 'gap' AS event FROM events WHERE event_id % 7 = 0")
def held_findings(t: Tables):
    f = t.slots().where("row_kind = 'gap'").select(F.col("ticker").alias("symbol"), F.col("day").alias("observed_on"), F.lit("gap").alias("event"))
    return V.findings([f, f]).select("symbol", "observed_on", "event")


@query("expiry_coding", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_shipdate AS DATE) END AS expiry FROM lineitem", dates="expiry")
def expiry_coding(t: Tables):
    code = F.when(F.col("l_linenumber") % 2 == 0, F.date_format("l_shipdate", "yyMMdd")).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    s = F.concat(F.lit("SPY   "), code, F.lit("C00650000"))
    return t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", M.occ_expiry(s).alias("expiry"))


@query("strict_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders", dates="day")
def strict_dates(t: Tables):
    ts = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 2).cast("int"))
    return t.table("orders").select("o_orderkey", P.strict_date(ts).cast("date").alias("day"))


@query("close_guard", "SELECT s.event_id, s.event_id % 8 <> 0 AS in_time FROM slots s JOIN calendar c USING (day) WHERE s.slot = c.close_at")
def close_guard(t: Tables):
    s = event_stream(t).select("event_id", F.to_date("snap_ts").alias("day"), F.date_trunc("hour", "snap_ts").alias("slot"))
    j = s.join(t.calendar().select("day", "close_at"), "day").where("slot = close_at")
    rows = j.select("day", "event_id", F.lit("spot_close").alias("close_tag"), (F.col("close_at") + F.make_dt_interval(mins=F.when(F.col("event_id") % 8 == 0, 6).otherwise(5))).alias("fetched_at"))
    ok, late = (run_once(x, "append") for x in live.close_guard(rows, t.calendar()))
    return ok.select("event_id", F.lit(True).alias("in_time")).unionByName(late.select("event_id", F.lit(False).alias("in_time")))


@query(
    "missed_minutes",
    """WITH h AS (SELECT day, unnest(generate_series(open_at, close_at, INTERVAL 1 HOUR)) AS slot FROM calendar), o AS (SELECT t.ticker, h.slot FROM h, (SELECT DISTINCT ticker FROM slots) t)
       SELECT ticker, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, 'gap' AS row_kind FROM o WHERE slot <= TIMESTAMP '2024-01-20 00:00:00' AND NOT EXISTS (SELECT 1 FROM slots s WHERE s.ticker = o.ticker AND s.slot = o.slot)""",
)
def missed_minutes(t: Tables):
    hours = t.calendar().select("day", F.explode(F.sequence("open_at", "close_at", F.expr("interval 1 hour"))).alias("slot"))
    names = t.slots().agg(F.collect_set("ticker").alias("_t"))
    owed = hours.join(F.broadcast(names)).select("slot", F.explode("_t").alias("ticker"))
    rows = run_once(event_stream(t).select("ticker", F.date_trunc("hour", "snap_ts").alias("slot")), "append")
    return live.missed_minutes(rows, owed, "2024-01-20 00:00:00").select("ticker", text("slot").alias("slot"), "row_kind")


@query("import_window", "SELECT ticker, day FROM (SELECT s.ticker, c.day, row_number() OVER (PARTITION BY s.ticker ORDER BY c.day DESC) AS r FROM (SELECT ticker, DATE '2024-01-10' + CAST(length(ticker) AS INTEGER) AS d FROM spans) s JOIN calendar c ON c.day < s.d) WHERE r <= 7", dates="day")
def import_window(t: Tables):
    first = t.spans().select("ticker", F.date_add(F.lit("2024-01-10").cast("date"), F.length("ticker")).alias("day"))
    return sealed.sessions_before(t.calendar(), first, 7)


@query("drifted_union", "SELECT event_id::DOUBLE AS x, CASE WHEN event_id % 2 = 0 THEN 1 END AS y FROM events")
def drifted_union(t: Tables):
    e = t.table("events")
    a = e.where("event_id % 2 = 0").select(F.col("event_id").cast("int").alias("x"), F.lit(1).alias("y"))
    b = e.where("event_id % 2 = 1").select(F.col("event_id").cast("double").alias("x"))
    return sealed.union_by_name([a, b]).select("x", "y")


@query("upload_lags", "SELECT count(*) AS segments, max(event_id % 200) AS largest, count(*) FILTER (WHERE event_id % 200 > 90) AS over FROM events")
def upload_lags(t: Tables):
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    e = t.table("events").select(F.concat(F.lit("seg-"), F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit(".parquet")).alias("key"), (ts + F.make_dt_interval(secs=(F.col("event_id") % 200).cast("decimal(18,6)"))).alias("modified"))
    return K.upload_lag(e)


@query(
    "retuned_plan",
    """SELECT * FROM (WITH RECURSIVE c AS (SELECT ticker, CAST(day(day) // 8 * 8 AS INT) AS lo, count(*) AS n FROM slots WHERE row_kind = 'data' GROUP BY 1, 2),
       p AS (SELECT ticker, lo, CAST(lo + 3 AS INT) AS hi, (n + 1) // 2 AS n FROM c WHERE n > 400 UNION ALL SELECT ticker, CAST(lo + 4 AS INT), CAST(lo + 7 AS INT), n // 2 FROM c WHERE n > 400
       UNION ALL SELECT ticker, lo, CAST(lo + 7 AS INT), n FROM c WHERE n <= 400),
       o AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY lo) AS i FROM p),
       f AS (SELECT ticker, i, 0 AS "at", lo, hi, n FROM o WHERE i = 1
       UNION ALL SELECT o.ticker, o.i, CASE WHEN f.n < 150 AND f.n + o.n <= 400 THEN f."at" ELSE f."at" + 1 END, CASE WHEN f.n < 150 AND f.n + o.n <= 400 THEN f.lo ELSE o.lo END, o.hi, CASE WHEN f.n < 150 AND f.n + o.n <= 400 THEN f.n + o.n ELSE o.n END
       FROM f JOIN o ON o.ticker = f.ticker AND o.i = f.i + 1)
       SELECT ticker, "at", arg_max(lo, i) AS lo, arg_max(hi, i) AS hi, arg_max(n, i) AS n FROM f GROUP BY 1, 2)""",
)
def retuned_plan(t: Tables):
    """Fetch windows of eight days by their rows; the fold is a recursion in SQL."""
    lo = (F.floor(F.day("day") / 8) * 8).cast("int")
    counts = t.slots().where("row_kind = 'data'").groupBy("ticker", lo.alias("lo")).agg(F.count(F.lit(1)).alias("n"))
    return K.retune(counts.select("ticker", "lo", (F.col("lo") + 7).alias("hi"), "n"), ["ticker"], most=400, least=150)
