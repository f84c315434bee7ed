"""Quality verdicts over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import quality as Q
from tickframe.plans.registry import query
from tickframe.sources.adapters import Tables

_ORDER = """qo AS (SELECT ticker, day, count(*) AS rows, count(*) FILTER (WHERE NOT coalesce(bid <= mark AND mark <= ask, false)) AS unordered FROM quotes GROUP BY 1, 2)"""
_ENT = """en AS (SELECT s.ticker, s.day, count(*) FILTER (WHERE event_id % 501 = 0) AS violations, count(*) FILTER (WHERE snap_ts BETWEEN open_at AND close_at) AS session_rows,
          (median(value) FILTER (WHERE snap_ts BETWEEN open_at AND close_at))::DOUBLE AS m FROM slots s JOIN calendar c ON c.day = s.day GROUP BY 1, 2)"""
_BAND = """cnt AS (SELECT ticker, day, slot, count(*) FILTER (WHERE row_kind = 'data') AS rows, bool_or(event_id % 37 = 0) AS marked FROM slots GROUP BY 1, 2, 3),
           med AS (SELECT ticker, day, median(rows)::DOUBLE AS m FROM cnt WHERE NOT marked GROUP BY 1, 2),
           dense AS (SELECT s.ticker, c.day, m FROM (SELECT DISTINCT ticker FROM slots) s CROSS JOIN calendar c LEFT JOIN med ON med.ticker = s.ticker AND med.day = c.day),
           trail AS (SELECT ticker, day, (quantile_cont(m, 0.5) OVER w)::DOUBLE AS usual, count(m) OVER w AS known FROM dense WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))"""


def order(t: Tables):
    return Q.quote_order(t.quotes(), ["ticker", "day"])


@query("quote_order_rate", f"WITH {_ORDER} SELECT *, CASE WHEN unordered / rows > 0.05 THEN 'quarantined' ELSE 'clean' END AS verdict FROM qo", dates="day")
def quote_order_rate(t: Tables):
    return order(t)


def ent(t: Tables):
    j = t.slots().join(t.calendar(), "day")
    rows = j.select("ticker", "day", (F.col("event_id") % 501 == 0).alias("is_delayed"), F.col("snap_ts").between(F.col("open_at"), F.col("close_at")).alias("in_session"), F.col("value").alias("staleness"))
    return Q.entitlement(rows, ["ticker", "day"], 40)


@query(
    "entitlement",
    f"""WITH {_ENT} SELECT ticker, day, violations, session_rows, round(m, 6) AS median_staleness, CASE WHEN violations > 0 THEN 'quarantined' WHEN session_rows = 0 THEN 'out_of_scope' WHEN m IS NULL OR abs(m) > 40 THEN 'quarantined' ELSE 'clean' END AS verdict,
        CASE WHEN violations > 0 THEN 'delayed' WHEN session_rows = 0 THEN 'no_session_rows' WHEN m IS NULL THEN 'no_median' WHEN abs(m) > 40 THEN 'stale' END AS reason FROM en""",
    dates="day",
)
def entitlement(t: Tables):
    return ent(t).withColumn("median_staleness", F.round("median_staleness", 6))


def counts(t: Tables):
    return Q.snapshot_counts(t.slots().withColumn("marker", F.col("event_id") % 37 == 0), ["ticker", "day"], "slot")


def usual(t: Tables):
    c = counts(t)
    med = c.where("not marked").groupBy("ticker", "day").agg(F.median("rows").alias("m"))
    days = t.calendar().select("day").join(c.select("ticker").distinct())
    return Q.trailing_medians(days, med, ["ticker"])


@query("snapshot_row_counts", f"WITH {_BAND} SELECT ticker, day, strftime(slot, '%H') AS hour, rows, marked FROM cnt", dates="day")
def snapshot_row_counts(t: Tables):
    return counts(t).select("ticker", "day", F.date_format("slot", "HH").alias("hour"), "rows", "marked")


@query("trailing_medians", f"WITH {_BAND} SELECT ticker, day, round(usual, 6) AS usual, known FROM trail", dates="day")
def trailing_medians(t: Tables):
    return usual(t).select("ticker", "day", F.round("usual", 6).alias("usual"), "known")


@query(
    "row_count_band",
    f"""WITH {_BAND}, far AS (SELECT c.ticker, c.day, count(*) AS snapshots, max((abs(rows - usual), rows)) AS w FROM cnt c LEFT JOIN trail USING (ticker, day) WHERE NOT marked GROUP BY 1, 2),
        keys AS (SELECT DISTINCT ticker, day FROM cnt)
        SELECT k.ticker, k.day, coalesce(snapshots, 0) AS snapshots, CASE WHEN snapshots IS NULL THEN 'out_of_scope' WHEN coalesce(known, 0) < 5 THEN 'insufficient_history'
        WHEN struct_extract(w, 1) > 0.3 * usual THEN 'quarantined' ELSE 'clean' END AS verdict FROM keys k LEFT JOIN far f ON f.ticker = k.ticker AND f.day = k.day LEFT JOIN trail t ON t.ticker = k.ticker AND t.day = k.day""",
    dates="day",
)
def row_count_band(t: Tables):
    return Q.row_count_band(counts(t), usual(t), ["ticker"]).select("ticker", "day", "snapshots", "verdict")


@query(
    "battery_run",
    f"""WITH {_ENT}, {_ORDER.replace('FROM quotes', "FROM (SELECT ticker, day, CASE WHEN event_id % 14 = 0 THEN value + 1 ELSE value - 1 END AS bid, value AS mark, value + 2 AS ask FROM slots)")},
        v AS (SELECT ticker, day, 'order' AS c, CASE WHEN unordered / rows > 0.05 THEN 'quarantined' ELSE 'clean' END AS verdict FROM qo
              UNION ALL SELECT ticker, day, 'entitlement', CASE WHEN violations > 0 THEN 'quarantined' WHEN session_rows = 0 THEN 'out_of_scope' WHEN m IS NULL OR abs(m) > 40 THEN 'quarantined' ELSE 'clean' END FROM en)
        SELECT ticker, day, count(*) AS checks, bool_or(verdict = 'quarantined') AS withheld, coalesce(string_agg(DISTINCT c, ',' ORDER BY c) FILTER (WHERE verdict = 'quarantined'), '') AS failed FROM v GROUP BY 1, 2""",
    dates="day",
)
def battery_run(t: Tables):
    q = t.slots().select("ticker", "day", F.when(F.col("event_id") % 14 == 0, F.col("value") + 1).otherwise(F.col("value") - 1).alias("bid"), F.col("value").alias("mark"), (F.col("value") + 2).alias("ask"))
    named = lambda df, n: df.select("ticker", "day", F.lit(n).alias("check_name"), "verdict")
    return Q.worst_of([named(Q.quote_order(q, ["ticker", "day"]), "order"), named(ent(t), "entitlement")], ["ticker", "day"])


@query(
    "window_profile",
    """WITH c AS (SELECT ticker, day, hour(slot) // 6 AS w, slot, count(*) FILTER (WHERE row_kind = 'data') AS c, count(*) FILTER (WHERE row_kind = 'gap') AS g FROM slots GROUP BY 1, 2, 3, 4)
       SELECT ticker, day, CAST(w AS INTEGER) AS w, max(c) AS peak, sum(g) > 0 AS failed FROM c GROUP BY 1, 2, 3""",
    dates="day",
)
def window_profile(t: Tables):
    return Q.window_profile(t.slots().withColumn("w", F.floor(F.hour("slot") / 6).cast("int")), ["ticker", "day"], "slot", ["w"])


_FIELDS = "error_class fetch_end_ts row_kind value".split()
_PROFILE = "prof AS (SELECT ticker, day, count(*) AS rows, 'error_class' AS field, count(error_class) AS present FROM slots GROUP BY 1, 2" + "".join(f" UNION ALL SELECT ticker, day, count(*), '{f}', count({f}) FROM slots GROUP BY 1, 2" for f in _FIELDS[1:]) + ")"


def patchy(t: Tables):
    """All slots, each field empty on one day in five, another for each ticker and field."""
    empty = lambda i: (F.day("day") + F.length("ticker") + i) % 5 == 0
    return t.slots().withColumns({f: F.when(~empty(i), F.col(f)) for i, f in enumerate(_FIELDS)})


@query("null_profile", f"WITH {_PROFILE} SELECT * FROM prof", dates="day")
def null_profile(t: Tables):
    return Q.null_profile(t.slots(), ["ticker", "day"], _FIELDS)


_PATCHY = "patchy AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN (day(day) + length(ticker) + {i}) % 5 <> 0 THEN {f} END AS {f}" for i, f in enumerate(_FIELDS)) + ") FROM slots), " + _PROFILE.replace("FROM slots", "FROM patchy")


@query("field_drift", f"WITH {_PATCHY}, l AS (SELECT *, lag(present) OVER (PARTITION BY ticker, field ORDER BY day) AS was FROM prof) SELECT ticker, day, field FROM l WHERE present = 0 AND was > 0", dates="day")
def field_drift(t: Tables):
    return Q.drift(Q.null_profile(patchy(t), ["ticker", "day"], _FIELDS), ["ticker"])


@query(
    "newly_absent",
    """WITH a AS (SELECT user_id % 50 AS u, event_type AS f, bool_and(event_id % 3 <> 0) AS absent, CAST(ts AS DATE) < DATE '2024-01-15' AS early FROM events WHERE event_type <> 'view' OR CAST(ts AS DATE) < DATE '2024-01-15' GROUP BY 1, 2, 4),
       x AS (SELECT u % 2 AS ticker, f AS field, bool_or(NOT absent) = false OR f = 'error' AND NOT early AS absent, early FROM a GROUP BY u % 2, f, early)
       SELECT field FROM x WHERE NOT early AND absent GROUP BY field HAVING count(*) = 2 EXCEPT SELECT field FROM x WHERE early AND absent GROUP BY field HAVING count(*) = 2""",
)
def newly_absent(t: Tables):
    e = t.table("events").where("event_type <> 'view' or to_date(ts) < date '2024-01-15'")
    early = F.to_date("ts") < F.lit("2024-01-15").cast("date")
    a = e.groupBy((F.col("user_id") % 50 % 2).alias("ticker"), F.col("event_type").alias("field"), early.alias("early")).agg((F.bool_or(F.col("event_id") % 3 == 0) == F.lit(False)).alias("x"))
    a = a.select("ticker", "field", "early", (F.col("x") | ((F.col("field") == "error") & ~F.col("early"))).alias("absent"))
    return Q.newly_absent(a.where("not early"), a.where("early"))


@query(
    "fingerprint_diff",
    """WITH a AS (SELECT 's' || (p_partkey % 3) AS surface, p_name AS col, min(p_type) AS type FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2), b AS (SELECT 's' || (p_partkey % 3) AS surface, p_name AS col, min(p_type) AS type FROM part WHERE p_partkey % 5 <> 0 GROUP BY 1, 2)
       SELECT coalesce(a.surface, b.surface) AS surface, coalesce(a.col, b.col) AS column_name, b.type AS recorded, a.type AS derived, CASE WHEN a.type IS NULL THEN 'dropped' WHEN b.type IS NULL THEN 'added' ELSE 'retyped' END AS state
       FROM a FULL JOIN b ON a.surface = b.surface AND a.col = b.col WHERE a.type IS DISTINCT FROM b.type""",
)
def fingerprint_diff(t: Tables):
    p = t.table("part").select("p_partkey", F.concat(F.lit("s"), F.col("p_partkey") % 3).alias("surface"), F.col("p_name").alias("column"), "p_type")
    one = lambda where: p.where(where).groupBy("surface", "column").agg(F.min("p_type").alias("type"))
    return Q.fingerprint_diff(one("p_partkey % 2 = 0"), one("p_partkey % 5 <> 0")).withColumnRenamed("column", "column_name")


@query("lossless_widening", "SELECT l_suppkey, count(*) FILTER (WHERE l_quantity <> floor(l_quantity)) AS quantity_lost, count(*) FILTER (WHERE l_extendedprice <> floor(l_extendedprice)) AS price_lost FROM lineitem GROUP BY 1")
def lossless_widening(t: Tables):
    li = t.table("lineitem")
    return li.groupBy("l_suppkey").agg(Q.lossless(li, "l_quantity", "bigint").alias("quantity_lost"), Q.lossless(li, "l_extendedprice", "bigint").alias("price_lost"))
