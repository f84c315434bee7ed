"""Completeness and snapshot reads over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import snapshots as S
from tickframe.plans.registry import query
from tickframe.sources.adapters import Tables, text

NOW = "2024-01-30 12:00:00"
_HOURS = "hours AS (SELECT day, unnest(generate_series(open_at, close_at, INTERVAL 1 HOUR)) AS slot FROM calendar)"
_AGG = """agg AS (SELECT ticker, slot, count(*) FILTER (WHERE row_kind = 'data') AS data_rows, count(*) FILTER (WHERE row_kind = 'gap') AS gap_rows,
          count(*) FILTER (WHERE row_kind IS NULL) AS other_rows, bool_or(suspect) AS suspect,
          coalesce(array_to_string(list_sort(list(DISTINCT error_class) FILTER (WHERE error_class IS NOT NULL)), ','), '') AS errors FROM slots GROUP BY 1, 2)"""
_STATUS = f"""{_HOURS}, {_AGG}, status AS (SELECT s.ticker, h.day, h.slot, CASE WHEN a.data_rows > 0 THEN CASE WHEN a.suspect THEN 'suspect' ELSE 'captured' END
             WHEN NOT (h.slot >= s.span_start AND (s.span_end IS NULL OR h.slot < s.span_end)) THEN 'out_of_scope' WHEN a.data_rows IS NOT NULL THEN 'gap'
             WHEN h.slot > TIMESTAMP '{NOW}' - INTERVAL 2 MINUTE THEN 'pending' ELSE 'missing' END AS status
             FROM hours h CROSS JOIN spans s LEFT JOIN agg a ON a.ticker = s.ticker AND a.slot = h.slot)"""
_MISSING = f"""{_HOURS}, owed AS (SELECT DISTINCT s.ticker, h.day, h.slot FROM hours h JOIN spans s ON h.slot >= s.span_start AND (s.span_end IS NULL OR h.slot < s.span_end)),
              missing AS (SELECT * FROM owed o WHERE NOT EXISTS (SELECT 1 FROM slots x WHERE x.ticker = o.ticker AND x.slot = o.slot))"""


def _now():
    return F.lit(NOW).cast("timestamp")


def hours(t: Tables):
    return S.slots_of(t.calendar(), 60)


@query("slot_health", f"WITH {_AGG} SELECT ticker, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, data_rows, gap_rows, other_rows, suspect, errors FROM agg")
def slot_health(t: Tables):
    return S.slot_aggregate(t.slots(), ["ticker", "slot"]).withColumns({"slot": text("slot"), "errors": F.array_join("errors", ",")})


def status(t: Tables):
    return S.slot_status(hours(t), t.spans(), S.slot_aggregate(t.slots(), ["ticker", "slot"]), _now())


@query("slot_status", f"WITH {_STATUS} SELECT ticker, day, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot, status FROM status", dates="day")
def slot_status(t: Tables):
    return status(t).withColumn("slot", text("slot"))


@query(
    "history_heatmap",
    f"""WITH {_STATUS}, c AS (SELECT ticker, day, count(*) AS slots, count(*) FILTER (WHERE status = 'captured') AS captured, count(*) FILTER (WHERE status = 'suspect') AS suspect,
        count(*) FILTER (WHERE status = 'gap') AS gap, count(*) FILTER (WHERE status = 'missing') AS missing, count(*) FILTER (WHERE status = 'pending') AS pending,
        count(*) FILTER (WHERE status = 'out_of_scope') AS out_of_scope FROM status GROUP BY 1, 2)
        SELECT *, slots - out_of_scope - pending AS judged, CASE WHEN slots - out_of_scope - pending > 0 THEN round(100 * (captured + suspect) / (slots - out_of_scope - pending), 1) END AS captured_percent FROM c""",
    dates="day",
)
def history_heatmap(t: Tables):
    return S.history(status(t))


@query(
    "latest_cycle",
    f"""SELECT ticker, strftime(max(slot), '%Y-%m-%d %H:%M:%S') AS newest, CAST((epoch(TIMESTAMP '{NOW}') - epoch(max(slot))) // 60 AS BIGINT) AS minutes,
        (epoch(TIMESTAMP '{NOW}') - epoch(max(slot))) // 60 > 3 AS stale
        FROM slots WHERE row_kind = 'data' AND day IN (SELECT day FROM calendar WHERE idx > (SELECT max(idx) FROM calendar) - 10) GROUP BY 1""",
)
def latest_cycle(t: Tables):
    return S.latest_cycle(t.slots(), t.calendar(), _now()).withColumn("newest", text("newest"))


@query("missing_slots", f"WITH {_MISSING} SELECT ticker, day, strftime(slot, '%Y-%m-%d %H:%M:%S') AS slot FROM missing", dates="day")
def missing_slots(t: Tables):
    return S.missing_slots(S.owed_slots(hours(t), t.spans()), t.slots()).withColumn("slot", text("slot"))


@query(
    "missing_slots_since_complete",
    f"""WITH {_MISSING}, complete AS (SELECT ticker, max(day) AS d FROM (SELECT DISTINCT ticker, day FROM owed) o WHERE NOT EXISTS (SELECT 1 FROM missing m WHERE m.ticker = o.ticker AND m.day = o.day) GROUP BY 1)
        SELECT m.ticker, m.day, strftime(m.slot, '%Y-%m-%d %H:%M:%S') AS slot FROM missing m LEFT JOIN complete c ON c.ticker = m.ticker
        WHERE (c.d IS NULL OR m.day > c.d) AND m.day IN (SELECT day FROM calendar WHERE idx > (SELECT max(idx) FROM calendar) - 20)""",
    dates="day",
)
def missing_slots_since_complete(t: Tables):
    return S.missing_slots(S.owed_slots(hours(t), t.spans()), t.slots(), t.calendar(), cap=20).withColumn("slot", text("slot"))


@query("gap_rows_union", f"WITH {_MISSING}, both_kinds AS (SELECT ticker, row_kind, error_class FROM slots UNION ALL SELECT ticker, 'gap', 'missed_slot' FROM missing) SELECT ticker, row_kind, error_class, count(*) AS n FROM both_kinds GROUP BY 1, 2, 3")
def gap_rows_union(t: Tables):
    made = S.gap_rows(S.missing_slots(S.owed_slots(hours(t), t.spans()), t.slots()))
    return S.with_gaps(t.slots(), made).groupBy("ticker", "row_kind", "error_class").agg(F.count(F.lit(1)).alias("n"))


@query("gap_counts", "SELECT c.day, g.gaps FROM calendar c LEFT JOIN (SELECT CASE WHEN day(day) % 5 <> 0 THEN day END AS day, count(*) FILTER (WHERE row_kind = 'gap') AS gaps FROM slots GROUP BY 1) g ON g.day = c.day", dates="day")
def gap_counts(t: Tables):
    return S.gap_counts(t.calendar(), t.slots().withColumn("day", F.when(F.day("day") % 5 != 0, F.col("day"))))


@query("cycle_listing", "SELECT DISTINCT ticker, day, strftime((snap_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%H:%M') AS minute FROM slots WHERE row_kind = 'data' AND CAST((snap_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) = day", dates="day")
def cycle_listing(t: Tables):
    return S.cycles(t.slots())


@query("session_slots", f"WITH {_HOURS} SELECT day, count(*) AS slots, strftime(min(slot), '%H:%M') AS first_slot, strftime(max(slot), '%H:%M') AS last_slot FROM hours GROUP BY 1", dates="day")
def session_slots(t: Tables):
    return hours(t).groupBy("day").agg(F.count(F.lit(1)).alias("slots"), F.date_format(F.min("slot"), "HH:mm").alias("first_slot"), F.date_format(F.max("slot"), "HH:mm").alias("last_slot"))


@query(
    "session_phases",
    """SELECT CASE WHEN c.open_at IS NULL THEN 'non_session' WHEN s.slot < c.open_at THEN 'pre_open' WHEN s.slot <= c.close_at THEN 'open' WHEN s.slot <= c.close_at + INTERVAL 2 HOUR THEN 'post_equity_close' ELSE 'closed' END AS phase,
       CASE WHEN s.slot = c.close_at THEN 'spot_close' WHEN s.slot = c.close_at + INTERVAL 2 HOUR THEN 'option_close' END AS close_tag, count(*) AS n
       FROM slots s LEFT JOIN (SELECT * FROM calendar WHERE idx % 6 <> 0) c ON c.day = s.day GROUP BY 1, 2""",
)
def session_phases(t: Tables):
    j = t.slots().join(t.calendar().where("idx % 6 <> 0"), "day", "left")
    late = F.col("close_at") + F.expr("interval 2 hours")
    return j.groupBy(S.phase(F.col("slot"), F.col("open_at"), F.col("close_at"), late).alias("phase"), S.close_tag(F.col("slot"), F.col("close_at"), late).alias("close_tag")).agg(F.count(F.lit(1)).alias("n"))


@query("session_bounds_filter", "SELECT s.ticker, s.day, count(*) AS n FROM slots s JOIN calendar c ON c.day = s.day AND s.snap_ts BETWEEN c.open_at AND c.close_at GROUP BY 1, 2", dates="day")
def session_bounds_filter(t: Tables):
    return S.within_sessions(t.slots(), t.calendar()).groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("n"))


@query("range_read", "SELECT event_id, ticker, day FROM slots WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' AND row_kind = 'data'", dates="day")
def range_read(t: Tables):
    data, _ = S.data_rows(S.between_days(t.slots(), "2024-01-05", "2024-01-09"))
    return data.select("event_id", "ticker", "day")


@query("minute_snapshot", "SELECT event_id, ticker, value FROM slots WHERE date_trunc('hour', snap_ts) = (TIMESTAMP '2024-01-10 09:00:00' AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC'")
def minute_snapshot(t: Tables):
    return S.at_minute(t.slots(), "2024-01-10", "09:00", stamp="slot").select("event_id", "ticker", "value")


_TAGGED = "tagged AS (SELECT s.*, CASE WHEN s.slot = c.close_at THEN 'spot_close' END AS close_tag FROM slots s JOIN calendar c ON c.day = s.day)"


def tagged(t: Tables):
    return t.slots().join(t.calendar().select("day", "close_at"), "day").withColumn("close_tag", S.close_tag(F.col("slot"), F.col("close_at"), F.lit(None).cast("timestamp")))


@query("close_of_record", f"WITH {_TAGGED}, ok AS (SELECT ticker, day FROM tagged GROUP BY 1, 2 HAVING count(DISTINCT CASE WHEN close_tag = 'spot_close' THEN slot END) = 1) SELECT x.event_id, x.ticker, x.day, x.value FROM tagged x JOIN ok USING (ticker, day) WHERE close_tag = 'spot_close'", dates="day")
def close_of_record(t: Tables):
    rows, _ = S.closes_of_record(tagged(t), "spot_close", ["ticker", "day"], "slot")
    return rows.select("event_id", "ticker", "day", "value")


@query("close_violations", f"WITH {_TAGGED} SELECT ticker, day, count(DISTINCT CASE WHEN close_tag = 'spot_close' THEN snap_ts END) AS instants FROM tagged GROUP BY 1, 2 HAVING instants <> 1", dates="day")
def close_violations(t: Tables):
    _, bad = S.closes_of_record(tagged(t), "spot_close", ["ticker", "day"])
    return bad.select("ticker", "day", "instants")


@query("span_coverage", "SELECT s.ticker, count(*) AS events, count(*) FILTER (WHERE e.ts >= s.span_start AND (s.span_end IS NULL OR e.ts < s.span_end)) AS covered, count(*) FILTER (WHERE e.ts >= s.span_start AND (s.span_end IS NULL OR e.ts < s.span_end) AND s.options) AS chains_owed FROM events e JOIN spans s ON s.ticker = e.event_type GROUP BY 1")
def span_coverage(t: Tables):
    j = t.slots().join(t.spans(), "ticker")
    at = F.col("snap_ts"), F.col("span_start"), F.col("span_end")
    return j.groupBy("ticker").agg(F.count(F.lit(1)).alias("events"), F.count_if(S.covers(*at)).alias("covered"), F.count_if(S.covers(*at, F.col("options"))).alias("chains_owed"))


@query(
    "owed_coverage",
    """WITH present AS (SELECT DISTINCT ticker, day FROM slots WHERE (length(ticker) + day(day)) % 4 <> 0), gone AS (SELECT DISTINCT ticker, day FROM slots WHERE day(day) % 8 = 0)
       SELECT DISTINCT s.ticker, c.day FROM spans s JOIN calendar c ON s.span_start <= c.close_at AND (s.span_end IS NULL OR s.span_end > c.open_at)
       WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.ticker = s.ticker AND p.day = c.day) AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.ticker = s.ticker AND g.day = c.day)""",
    dates="day",
)
def owed_coverage(t: Tables):
    seen = t.slots().select("ticker", "day").distinct()
    return S.coverage(t.spans(), t.calendar(), seen.where((F.length("ticker") + F.day("day")) % 4 != 0), seen.where(F.day("day") % 8 == 0))


@query(
    "skipped_slots",
    f"""WITH {_HOURS}, ticks AS (SELECT DISTINCT ticker, slot AS tick FROM slots WHERE row_kind = 'data'), pairs AS (SELECT ticker, tick, lead(tick) OVER (PARTITION BY ticker ORDER BY tick) AS nxt FROM ticks)
        SELECT p.ticker, strftime(p.tick, '%Y-%m-%d %H:%M:%S') AS tick, count(*) AS skipped FROM pairs p JOIN hours h ON h.slot > p.tick AND h.slot < p.nxt GROUP BY 1, 2""",
)
def skipped_slots(t: Tables):
    ticks = t.slots().where("row_kind = 'data'").select("ticker", F.col("slot").alias("tick")).distinct()
    return S.skipped(ticks, hours(t), minutes=60).groupBy("ticker", text("tick").alias("tick")).agg(F.count(F.lit(1)).alias("skipped"))


@query("next_session", "SELECT DISTINCT o.ex_date AS day, (SELECT min(s.session) FROM (SELECT DISTINCT session FROM bars WHERE instrument_id = 7) s WHERE s.session > o.ex_date AND s.session <= o.ex_date + 30) AS next_session FROM actions o", dates="day next_session")
def next_session(t: Tables):
    days = t.actions().select(F.col("ex_date").alias("day")).distinct()
    return S.next_session(days, t.bars().where("instrument_id = 7").select(F.col("session").alias("day")).distinct())


@query("window_edge", "SELECT min(day) AS edge FROM (SELECT day FROM calendar WHERE day <= DATE '2024-01-25' ORDER BY day DESC LIMIT 10)", dates="edge")
def window_edge(t: Tables):
    return S.window_edge(t.calendar(), "2024-01-25", 10)


@query(
    "failure_runs",
    """WITH o AS (SELECT *, CASE WHEN row_kind = 'data' THEN 1 ELSE 0 END AS ok FROM slots), i AS (SELECT *, sum(ok) OVER (PARTITION BY ticker ORDER BY event_id) AS isl FROM o),
       r AS (SELECT *, sum(1 - ok) OVER (PARTITION BY ticker, isl ORDER BY event_id) AS failures FROM i) SELECT ticker, event_id, CAST(failures AS BIGINT) AS failures, failures = 2 AS pages FROM r WHERE failures > 0""",
)
def failure_runs(t: Tables):
    return S.failures(t.slots(), ["ticker"], "event_id", threshold=2).where("failures > 0").select("ticker", "event_id", "failures", "pages")
