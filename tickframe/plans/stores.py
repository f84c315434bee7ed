"""Sources under their oracles: the star-schema tables are written in a source's layout to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe.operators import lake as K
from tickframe.operators import views as V
from tickframe.plans.registry import query
from tickframe.plans.running import scratch
from tickframe.sources import calendar, sealed, two_pass, versions
from tickframe.sources.adapters import Tables, text


def named_by_date(t: Tables, rows: DataFrame, path: str) -> None:
    """ticker=T/date=D.parquet: one file for each ticker and day, moved to the name it has in that layout."""
    rows.repartition("ticker", "day").write.partitionBy("ticker", "day").parquet(f"{path}/folders")
    jvm = t.spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/folders")
    fs = at.getFileSystem(t.spark._jsc.hadoopConfiguration())
    for ticker in (x.getPath() for x in fs.listStatus(at) if x.isDirectory()):
        to = jvm.org.apache.hadoop.fs.Path(f"{path}/named/{ticker.getName()}")
        fs.mkdirs(to)
        for day in (x.getPath() for x in fs.listStatus(ticker) if x.isDirectory()):
            for part in (x.getPath() for x in fs.listStatus(day) if x.getPath().getName().startswith("part-")):
                fs.rename(part, jvm.org.apache.hadoop.fs.Path(to, day.getName().replace("day=", "date=") + ".parquet"))


@query("sealed_scan", "SELECT event_id, ticker, day AS date, value FROM slots", dates="date")
def sealed_scan(t: Tables):
    path = scratch(t.spark)
    named_by_date(t, t.slots().select("event_id", "ticker", "day", "value"), path)
    return sealed.read_legacy(t.spark, f"{path}/named", "event_id long, value double").select("event_id", "ticker", "date", "value")


@query("landing_scan", "SELECT event_id, ticker, value FROM slots")
def landing_scan(t: Tables):
    """A day's segments as they land, one file for each ticker and hour or more."""
    path = scratch(t.spark)
    t.slots().select("event_id", "ticker", "value", "slot").repartition("ticker", F.hour("slot")).drop("slot").write.parquet(path)
    rows, bad = sealed.read_landing(t.spark, path, "event_id long, ticker string, value double")
    return rows.unionByName(bad.select(F.lit(-1).cast("long").alias("event_id"), F.col("unreadable").alias("ticker"), F.lit(None).cast("double").alias("value")))


SEALED = T.StructType([T.StructField(n, k) for n, k in (("event_id", T.LongType()), ("row_kind", T.StringType()), ("value", T.DoubleType()), ("ticker", T.StringType()), ("date", T.DateType()))])


@query("seal_round_trip", "SELECT event_id, ticker, day AS date, row_kind, value FROM slots", dates="date")
def seal_round_trip(t: Tables):
    """Sealed in two commits; the second replaces the last week that the first had sealed a part of."""
    store, rows = versions.Store(t.spark, scratch(t.spark), SEALED), t.slots().withColumnRenamed("day", "date")
    week = F.col("date") > F.lit("2024-01-23").cast("date")
    store.seal(rows.where(~week | (F.col("event_id") % 2 == 0)))
    store.seal(rows.where(week))
    return store.read().select("event_id", "ticker", "date", "row_kind", "value")


@query(
    "sealed_and_late",
    """SELECT event_id, ticker, day AS date, CASE WHEN event_id % 17 > 0 THEN 'sealed' WHEN length(ticker) % 2 = 0 THEN 'reopened' ELSE 'quarantined' END AS state FROM slots""",
    dates="date",
)
def sealed_and_late(t: Tables):
    """Every seventeenth row comes after its day was sealed, in two batches, the first of them twice; tickers of even length are reopened for them. A
    crash between write and publish, of a version that would double the rows, shows in nothing."""
    store, rows = versions.Store(t.spark, scratch(t.spark), SEALED), t.slots().withColumnRenamed("day", "date").select(*SEALED.names)
    late = F.col("event_id") % 17 == 0
    store.seal(rows.where(~late))
    for batch in (0, 0, 1):
        store.land(rows.where(late & (F.col("event_id") % 2 == batch)), batch)
    store.write(rows.unionByName(rows))
    before = store.read()
    store.reopen(store.manifest().where(F.length("ticker") % 2 == 0).select("ticker", "date"))
    was = before.select(F.col("event_id").alias("_id"))  # a reader that began before the commit
    now = store.read().join(was, F.col("event_id") == F.col("_id"), "left").select("event_id", "ticker", "date", F.when(F.col("_id").isNull(), "reopened").otherwise("sealed").alias("state"))
    return now.unionByName(store.quarantined().select("event_id", "ticker", "date", F.lit("quarantined").alias("state")))


@query(
    "two_pass_closes",
    """WITH c AS (SELECT s.*, CASE WHEN s.slot = c.close_at THEN 'spot_close' END AS close_tag FROM slots s JOIN calendar c ON c.day = s.day), ok AS (SELECT ticker, day FROM c GROUP BY 1, 2 HAVING count(DISTINCT CASE WHEN close_tag = 'spot_close' THEN slot END) = 1)
       SELECT c.event_id, c.ticker, c.day, c.value FROM c JOIN ok USING (ticker, day) WHERE close_tag = 'spot_close'""",
    dates="day",
)
def two_pass_closes(t: Tables):
    """The slots laid out by instant; the closes of record by the row groups that hold them."""
    path = scratch(t.spark)
    rows = t.slots().join(t.calendar().select("day", "close_at"), "day").select("event_id", "slot", "value", F.when(F.col("slot") == F.col("close_at"), "spot_close").alias("close_tag"), "ticker", "day")
    two_pass.write_sorted(rows, path, "slot")
    return two_pass.closes_of_record(two_pass.read(t.spark, path, rows.schema), "spot_close", "slot")[0].select("event_id", "ticker", "day", "value")


@query(
    "two_pass_cycles",
    """WITH n AS (SELECT ticker, day, max(snap_ts) AS at_ts FROM slots WHERE hour(snap_ts) * 60 + minute(snap_ts) <= 870 GROUP BY 1, 2)
       SELECT s.event_id, s.ticker, s.day, s.value FROM slots s JOIN n ON n.ticker = s.ticker AND n.day = s.day AND n.at_ts = s.snap_ts""",
    dates="day",
)
def two_pass_cycles(t: Tables):
    path = scratch(t.spark)
    rows = t.slots().select("event_id", "snap_ts", "value", "ticker", "day")
    two_pass.write_sorted(rows, path)
    return two_pass.cycles_before(two_pass.read(t.spark, path, rows.schema), 870).select("event_id", "ticker", "day", "value")


@query("ledger_scan", "SELECT event_id, event_type AS ticker, value FROM events e WHERE event_id < coalesce((SELECT min(event_id) FROM events b WHERE b.event_type = e.event_type AND b.event_id % 500 = 7), event_id + 1)")
def ledger_scan(t: Tables):
    """A ledger for each ticker; a line in five hundred is broken, and what stands behind the first is not read."""
    path = scratch(t.spark)
    line = F.when(F.col("event_id") % 500 == 7, F.lit('{"event_id": ')).otherwise(F.to_json(F.struct("event_id", "ticker", "value")))
    t.slots().select("event_id", "ticker", "value").repartition("ticker").sortWithinPartitions("ticker", "event_id").select(F.col("ticker").alias("ledger"), line.alias("value")).write.partitionBy("ledger").text(path)
    return K.jsonl(t.spark, path, "event_id long, ticker string, value double").select("event_id", "ticker", "value")


@query(
    "cost_export",
    """SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day, l_returnflag AS product_code, CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE CAST(l_linenumber AS VARCHAR) END AS usage_type,
       CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_extendedprice END AS unblended_cost, l_quantity::DOUBLE AS usage_amount FROM lineitem""",
    dates="day",
)
def cost_export(t: Tables):
    li = t.table("lineitem")
    null = lambda c, where: F.when(~where, F.col(c))
    out = li.select(
        F.col("l_shipdate").cast("timestamp").alias("line_item_usage_start_date"),
        F.col("l_returnflag").alias("line_item_product_code"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber").cast("string")).alias("line_item_usage_type"),
        F.col("l_orderkey").cast("string").alias("line_item_resource_id"),
        F.lit("Usage").alias("line_item_line_item_type"),
        null("l_extendedprice", F.col("l_partkey") % 5 == 0).cast("double").alias("line_item_unblended_cost"),
        F.col("l_quantity").cast("double").alias("line_item_usage_amount"),
        F.lit("USD").alias("line_item_currency_code"),
        F.lit("000000000000").alias("line_item_usage_account_id"),
    )
    path = scratch(t.spark)
    out.write.parquet(path)
    out.limit(0).coalesce(1).write.mode("append").parquet(path)  # a file without rows
    return K.cost_export(t.spark, path).select(F.col("resource_id").cast("long").alias("l_orderkey"), "day", "product_code", "usage_type", "unblended_cost", "usage_amount")


@query("reference_scan", "SELECT instrument_id, id_value, valid_from, valid_to FROM master", dates="valid_from valid_to")
def reference_scan(t: Tables):
    path = scratch(t.spark)
    rows = t.master().select(F.col("instrument_id").cast("long"), "id_value", "valid_from", "valid_to", F.lit(1).alias("schema_version"))
    rows.write.parquet(path)
    schema = T.StructType([T.StructField(n, k) for n, k in (("instrument_id", T.LongType()), ("id_value", T.StringType()), ("valid_from", T.DateType()), ("valid_to", T.DateType()), ("schema_version", T.IntegerType()))])
    return sealed.read_reference(t.spark, path, schema, [1]).drop("schema_version")


@query("file_inventory", "SELECT day, count(DISTINCT ticker) AS files FROM slots GROUP BY 1", dates="day")
def file_inventory(t: Tables):
    path = scratch(t.spark)
    named_by_date(t, t.slots().select("event_id", "ticker", "day", "value"), path)
    return K.inventory(t.spark, f"{path}/named", "*.parquet").where("length > 0").groupBy("day").agg(F.count(F.lit(1)).alias("files"))


@query("timing_log", "SELECT CASE WHEN event_id % 4 = 0 THEN 'cycle' ELSE 'request' END AS kind, event_id AS bytes, value AS body FROM events")
def timing_log(t: Tables):
    path = scratch(t.spark)
    e = t.table("events")
    kind = F.when(F.col("event_id") % 4 == 0, "cycle").otherwise("request")
    e.select(F.to_json(F.struct(kind.alias("kind"), F.col("value").alias("body"), F.col("event_id").alias("bytes"))).alias("value")).write.text(path)
    requests, cycles = sealed.timings(t.spark, path)
    return requests.unionByName(cycles).select("kind", "bytes", "body")


@query(
    "daily_import",
    """WITH d AS (SELECT session, CASE WHEN day(session) % 6 = 0 THEN NULL ELSE round(max(high)) END AS h, CAST(sum(volume) AS BIGINT) AS volume FROM bars GROUP BY 1)
       SELECT session AS day, h AS high, volume, CASE WHEN day(session) % 9 = 0 THEN 'not_a_session' WHEN h IS NULL THEN 'not_finite' END AS reason FROM d""",
    dates="day",
)
def daily_import(t: Tables):
    """A vendor's file of daily bars with its three header rows; some days are off the calendar, some numbers are none."""
    path = scratch(t.spark)
    d = t.bars().groupBy("session").agg(F.round(F.max("high")).alias("h"), F.sum("volume").alias("v"))
    high = F.when(F.day("session") % 6 == 0, "NaN").otherwise(F.col("h").cast("string"))
    d.select(F.concat_ws(",", F.col("session").cast("string"), F.lit("1"), high, F.lit("1"), F.lit("1"), F.col("v").cast("string")).alias("value")).write.text(path)
    calendar = d.select(F.col("session").alias("day")).where("day(day) % 9 <> 0")
    ok, refused = sealed.daily_csv(t.spark, path, calendar, "vendor")
    high = F.when(~F.isnan("high"), F.col("high")).alias("high")
    return ok.select("day", high, "volume", F.lit(None).cast("string").alias("reason")).unionByName(refused.select("day", high, "volume", "reason"))


@query(
    "provenance_read",
    """WITH f AS (SELECT DISTINCT ticker AS file, CASE length(ticker) % 3 WHEN 0 THEN 'imported' WHEN 1 THEN 'captured' ELSE 'other' END AS origin FROM slots)
       SELECT s.event_id, s.ticker AS file, CASE WHEN f.origin <> 'other' THEN f.origin END AS origin, CASE WHEN f.origin = 'imported' THEN 'vendor' END AS source FROM slots s JOIN f ON f.file = s.ticker""",
)
def provenance_read(t: Tables):
    origin = F.when(F.length("file") % 3 == 0, "imported").when(F.length("file") % 3 == 1, "captured").otherwise("other")
    files = t.slots().select(F.col("ticker").alias("file")).distinct().select("file", origin.alias("origin"), F.lit("raw").alias("basis"), F.when(origin == "imported", "vendor").alias("source"), F.lit(None).cast("date").alias("source_as_of"))
    return V.with_provenance(t.slots().select("event_id", F.col("ticker").alias("file")), files)[0].select("event_id", "file", "origin", "source")


@query(
    "split_resume",
    """WITH s AS (SELECT ticker, day, count(*) AS n FROM slots GROUP BY 1, 2)
       SELECT ticker, day, n FROM s WHERE day > DATE '2024-01-15' OR day = (SELECT max(day) FROM s x WHERE x.ticker = s.ticker AND x.day <= DATE '2024-01-15')""",
    dates="day",
)
def split_resume(t: Tables):
    sessions = t.slots().groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("n"))
    state = sessions.where("day <= date '2024-01-15'").groupBy("ticker").agg(F.max_by(F.struct("day", "n"), "day").alias("x")).select("ticker", "x.day", "x.n")
    return V.resumed(state, sessions, "2024-01-15")


@query(
    "load_snapshot",
    """SELECT event_id, value FROM slots WHERE ticker = 'view' AND row_kind = 'data' AND strftime((snap_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d %H') = '2024-01-09 10' AND day = DATE '2024-01-09'
       AND strftime((slot AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%H:%M') = '10:00'""",
)
def load_snapshot(t: Tables):
    rows = t.slots().withColumn("snap_ts", F.col("slot"))
    return V.load_snapshot(V.Store(quotes=rows), "quotes", "view", "2024-01-09", "10:00").select("event_id", "value")


@query("list_cycles", "SELECT DISTINCT strftime((snap_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%H:%M') AS minute FROM slots WHERE ticker = 'view' AND day = DATE '2024-01-09' AND row_kind = 'data' AND CAST((snap_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) = day")
def list_cycles(t: Tables):
    return V.list_cycles(V.Store(chains=t.slots()), "view", "2024-01-09").select("minute")


_WALL = "strftime((CAST(day || ' {}' AS TIMESTAMP) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')"


@query(
    "calendar_sessions",
    f"""WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders), d AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b),
        k AS (SELECT day FROM d WHERE isodow(day) < 6 AND day NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) = 13)), e AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE day(o_orderdate) = 24)
        SELECT day, {_WALL.format("09:30:00")} AS open_at, CASE WHEN day IN (SELECT day FROM e) THEN {_WALL.format("13:00:00")} ELSE {_WALL.format("16:00:00")} END AS close_at, CASE WHEN day IN (SELECT day FROM e) THEN {_WALL.format("13:15:00")} ELSE {_WALL.format("16:15:00")} END AS option_close_at,
        day IN (SELECT day FROM e) AS early, row_number() OVER (ORDER BY day) AS idx FROM k""",
    dates="day",
)
def calendar_sessions(t: Tables):
    """Weekdays between the first and the last order; the 13th is a holiday and the 24th ends early where there are orders."""
    day = F.to_date("o_orderdate")
    o = t.table("orders").select(day.alias("day"))
    bounds = o.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    c = calendar.sessions(bounds, o.where("day(day) = 13"), o.where("day(day) = 24"))
    return c.withColumns({x: text(x) for x in ("open_at", "close_at", "option_close_at")})
