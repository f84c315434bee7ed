"""Lake operations over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import lake as K
from tickframe.plans.registry import query
from tickframe.sources.adapters import Tables


@query(
    "latency_percentiles",
    """WITH x AS (SELECT s.*, c.open_at, c.close_at, (epoch_us(fetch_ts) - epoch_us(snap_ts)) // 1000 AS dispatch, (epoch_us(fetch_end_ts) - epoch_us(fetch_ts)) // 1000 AS trip FROM slots s JOIN calendar c ON c.day = s.day)
       SELECT ticker, round(quantile_cont(dispatch, 0.5)::DOUBLE, 6) AS dispatch_p50, round(quantile_cont(dispatch, 0.99)::DOUBLE, 6) AS dispatch_p99, round(quantile_cont(trip, 0.5)::DOUBLE, 6) AS trip_p50, round(quantile_cont(trip, 0.99)::DOUBLE, 6) AS trip_p99,
       round((quantile_cont(trip, 0.5) FILTER (WHERE snap_ts < open_at + INTERVAL 1 HOUR))::DOUBLE, 6) AS open_trip_p50, round((quantile_cont(trip, 0.99) FILTER (WHERE snap_ts < open_at + INTERVAL 1 HOUR))::DOUBLE, 6) AS open_trip_p99,
       round((quantile_cont(trip, 0.5) FILTER (WHERE snap_ts >= close_at - INTERVAL 60 MINUTE AND snap_ts <= close_at))::DOUBLE, 6) AS close_trip_p50,
       round((quantile_cont(trip, 0.99) FILTER (WHERE snap_ts >= close_at - INTERVAL 60 MINUTE AND snap_ts <= close_at))::DOUBLE, 6) AS close_trip_p99,
       count(*) FILTER (WHERE fetch_end_ts IS NULL) AS skipped FROM x GROUP BY 1""",
)
def latency_percentiles(t: Tables):
    got = K.latency(t.slots(), t.calendar(), ["ticker"])
    return got.withColumns({c: F.round(c, 6) for c in got.columns if c.endswith(("p50", "p99"))})


@query("cycle_sizes", "WITH c AS (SELECT ticker, day, slot, count(*) AS c FROM slots GROUP BY 1, 2, 3) SELECT ticker, day, count(*) AS cycles, CAST(sum(c) AS BIGINT) AS rows, min(c) AS least, quantile_cont(c, 0.5)::DOUBLE AS p50, round(quantile_cont(c, 0.99)::DOUBLE, 6) AS p99, max(c) AS most FROM c GROUP BY 1, 2", dates="day")
def cycle_sizes(t: Tables):
    return K.cycle_sizes(t.slots(), ["ticker", "day"], "slot").withColumn("p99", F.round("p99", 6))


@query(
    "cost_groupings",
    """WITH c AS (SELECT *, CAST(line_type = 'Usage' AS INTEGER) AS is_usage FROM costs) SELECT CAST(grouping(product, is_usage, line_type, usage_type, resource) AS BIGINT) AS grouping, product, is_usage, line_type, usage_type, resource, CAST(sum(cents) AS BIGINT) AS cents
       FROM c GROUP BY GROUPING SETS ((product, is_usage), (line_type), (product, usage_type), (resource))""",
)
def cost_groupings(t: Tables):
    return K.grouped_costs(t.costs())


@query("daily_costs", "SELECT day, product, CAST(coalesce(sum(cents) FILTER (WHERE line_type = 'Usage'), 0) AS BIGINT) AS usage_cents, CAST(coalesce(sum(cents) FILTER (WHERE line_type <> 'Usage'), 0) AS BIGINT) AS other_cents FROM costs GROUP BY 1, 2", dates="day")
def daily_costs(t: Tables):
    return K.daily_costs(t.costs())


@query(
    "cost_projection",
    """WITH d AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, day, CAST(coalesce(sum(cents) FILTER (WHERE line_type = 'Usage'), 0) AS BIGINT) AS u, CAST(coalesce(sum(cents) FILTER (WHERE line_type <> 'Usage'), 0) AS BIGINT) AS o FROM costs GROUP BY 1, 2),
       n AS (SELECT month, max(day) AS newest FROM d GROUP BY 1),
       g AS (SELECT d.month, any_value(newest) AS newest, CAST(sum(CASE WHEN day < newest THEN u ELSE 0 END) AS BIGINT) AS usage_cents, CAST(sum(o) AS BIGINT) AS other_cents FROM d JOIN n USING (month) GROUP BY 1)
       SELECT month, CAST(day(newest) - 1 AS BIGINT) AS complete_days, usage_cents, other_cents,
       CASE WHEN day(newest) > 1 THEN CAST(floor(usage_cents * day(last_day(month)) / (day(newest) - 1) + other_cents) AS BIGINT) END AS month_end_cents, CASE WHEN day(newest) > 1 THEN 'projected' ELSE 'too_early' END AS status FROM g""",
    dates="month",
)
def cost_projection(t: Tables):
    return K.projection(t.costs())


@query(
    "cost_per_session",
    """WITH u AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(cents) AS BIGINT) AS usage_cents FROM costs WHERE line_type = 'Usage' GROUP BY 1),
       s AS (SELECT CAST(date_trunc('month', cycle) AS DATE) AS month, count(DISTINCT CASE WHEN month(cycle) <> 3 THEN cycle END) AS sessions FROM chains GROUP BY 1)
       SELECT month, usage_cents, coalesce(sessions, 0) AS sessions, CASE WHEN sessions > 0 THEN CAST(floor(usage_cents / sessions) AS BIGINT) END AS cents_per_session, CASE WHEN sessions > 0 THEN 'ok' ELSE 'no_sessions' END AS status FROM u LEFT JOIN s USING (month)""",
    dates="month",
)
def cost_per_session(t: Tables):
    """Cycles of March have no day of their own here, so that month has no sessions."""
    return K.per_session(t.costs(), t.chains().select(F.when(F.month("cycle") != 3, F.col("cycle")).alias("day")))


@query(
    "cost_trend",
    """WITH d AS (SELECT day, CAST(sum(cents) AS BIGINT) AS cents FROM costs WHERE line_type = 'Usage' GROUP BY 1), e AS (SELECT max(day) AS e FROM d)
       SELECT x.day, d.cents, x.day = x.e AS partial FROM (SELECT CAST(unnest(generate_series(e - 29, e, INTERVAL 1 DAY)) AS DATE) AS day, e FROM e) x LEFT JOIN d ON d.day = x.day""",
    dates="day",
)
def cost_trend(t: Tables):
    return K.trend(t.costs())


@query("bucket_growth", "WITH d AS (SELECT resource, day, CAST(sum(cents) AS BIGINT) AS v FROM costs GROUP BY 1, 2) SELECT resource, arg_min(v, day) AS first, arg_max(v, day) AS last, min(day) AS since, arg_max(v, day) - arg_min(v, day) AS growth FROM d GROUP BY 1", dates="since")
def bucket_growth(t: Tables):
    return K.sizes(t.costs())


_FILES = "d AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(o_orderkey + 1) AS BIGINT) AS bytes FROM orders GROUP BY 1)"


def files(t: Tables):
    return t.table("orders").select(F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") + 1).alias("length"))


@query("storage_growth", f"WITH {_FILES} SELECT day, bytes, max(bytes) OVER w AS peak, CAST(sum(bytes) OVER w AS BIGINT) AS in_window, count(*) OVER w AS grown_days FROM d WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)", dates="day")
def storage_growth(t: Tables):
    return K.storage_growth(files(t))


@query("runway", f"WITH {_FILES}, g AS (SELECT day, bytes, max(bytes) OVER (ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS peak FROM d) SELECT max(bytes) AS busiest, arg_max(peak, day) AS peak, CAST(greatest(0, floor((100000000 - 13 * max(bytes)) / arg_max(peak, day))) AS BIGINT) AS days FROM g")
def runway(t: Tables):
    return K.runway(K.storage_growth(files(t)), 100_000_000)


@query(
    "finding_runs",
    """WITH nights AS (SELECT night, row_number() OVER (ORDER BY night) AS i FROM (SELECT DISTINCT night FROM findings)),
       j AS (SELECT f.*, i, i - row_number() OVER (PARTITION BY key ORDER BY i) AS g FROM findings f JOIN nights USING (night))
       SELECT key, min(night) AS start, max(night) AS end, count(*) AS nights, arg_max(n, i) AS latest, max(i) = (SELECT max(i) FROM nights) AS open FROM j GROUP BY key, g""",
    dates='start "end"',
)
def finding_runs(t: Tables):
    f = t.findings()
    return K.runs(f, f.select("night"))


@query(
    "finding_changes",
    """WITH a AS (SELECT key, n FROM findings WHERE night = DATE '2024-01-20'), b AS (SELECT key, n FROM findings WHERE night = DATE '2024-01-19')
       SELECT coalesce(a.key, b.key) AS key, a.n AS now, b.n AS was, CASE WHEN b.n IS NULL THEN 'new' WHEN a.n IS NULL THEN 'gone' WHEN a.n <> b.n THEN 'recounted' ELSE 'unchanged' END AS change FROM a FULL JOIN b ON a.key = b.key""",
)
def finding_changes(t: Tables):
    f = t.findings()
    return K.changes(f.where("night = date '2024-01-20'"), f.where("night = date '2024-01-19'"))


@query("nightly_digest", "SELECT night, substring(string_agg(key || '=' || n, ' ' ORDER BY key || '=' || n), 1, 200) AS body FROM findings GROUP BY 1", dates="night")
def nightly_digest(t: Tables):
    return K.digest(t.findings().select("night", F.col("key").alias("name"), "n"), 200)


@query(
    "restore_rotation",
    """WITH p AS (SELECT p_partkey, CAST(('0x' || substring(sha256('part/' || p_partkey), 1, 16))::UBIGINT % 52 AS INTEGER) AS slot FROM part), f AS (SELECT *, ((slot - 17) % 52 + 52) % 52 AS far FROM p)
       SELECT p_partkey, slot FROM f WHERE far = (SELECT min(far) FROM f)""",
)
def restore_rotation(t: Tables):
    pairs = t.table("part").select("p_partkey", F.concat(F.lit("part/"), "p_partkey").alias("path"))
    return K.rotation(pairs, 17).select("p_partkey", "slot")


@query("masked_resources", "SELECT s_suppkey, 'arn:aws:s3:r:************:b/***' || replace(right(s_name, 6), '777', '***') AS resource FROM supplier")
def masked_resources(t: Tables):
    arn = F.concat(F.lit("arn:aws:s3:r:"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0"), F.lit(":b/777"), F.right("s_name", F.lit(6)))
    return t.table("supplier").select("s_suppkey", K.masked(arn, ["777"]).alias("resource"))


@query("usage_classes", "SELECT CASE WHEN p_type LIKE 'ECO%' THEN 'storage' WHEN p_type LIKE 'STAN%' THEN 'requests' ELSE 'other' END AS label, count(*) AS n FROM part GROUP BY 1")
def usage_classes(t: Tables):
    return t.table("part").groupBy(K.usage_class(F.concat(F.lit("EUW1-"), "p_type"), {"ECO": "storage", "STAN": "requests"}).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "lost_segments",
    """WITH m AS (SELECT event_id, event_type AS ticker, date_trunc('minute', ts) AS slot FROM events)
       SELECT DISTINCT ticker, strftime(slot, '%Y-%m-%d %H:%M') AS slot, 'segment_lost' AS error_class FROM m WHERE event_id % 10 = 3
       AND NOT EXISTS (SELECT 1 FROM m x WHERE x.event_id % 10 <> 3 AND x.ticker = m.ticker AND x.slot = m.slot)""",
)
def lost_segments(t: Tables):
    e = t.table("events").select(F.col("event_id").alias("partition"), F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("fetched_at"))
    here = e.where("partition % 10 <> 3")
    return K.lost_minutes(e, here, here.select("ticker", F.date_trunc("minute", "fetched_at").alias("slot"))).withColumn("slot", F.date_format("slot", "yyyy-MM-dd HH:mm"))


@query(
    "retention_candidates",
    """SELECT event_id AS partition, surface, ticker, day FROM (SELECT *, CASE event_id % 2 WHEN 0 THEN 'quotes' ELSE 'chains' END AS surface FROM slots) s
       WHERE day <= CASE surface WHEN 'quotes' THEN DATE '2024-01-10' ELSE DATE '2024-01-05' END AND event_id < 5000 AND event_id % 17 <> 0 AND event_id % 19 <> 0
       AND (surface <> 'quotes' OR EXISTS (SELECT 1 FROM slots d WHERE d.ticker = s.ticker AND d.day = s.day AND d.event_id % 23 = 0))""",
    dates="day",
)
def retention_candidates(t: Tables):
    m = t.slots().select(F.col("event_id").alias("partition"), F.when(F.col("event_id") % 2 == 0, "quotes").otherwise("chains").alias("surface"), "ticker", "day", F.col("event_id").alias("seq"))
    edges = t.table("region").select(F.when(F.col("r_regionkey") == 0, "quotes").otherwise("chains").alias("surface"), F.when(F.col("r_regionkey") == 0, F.lit("2024-01-10")).otherwise(F.lit("2024-01-05")).cast("date").alias("edge")).distinct()
    some = lambda k: m.where(f"partition % {k} = 0")
    return K.retention(m, edges, 5000, some(17), some(19), some(23)).drop("seq")
