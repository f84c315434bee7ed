"""Market views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import ledger as L
from tickframe.operators import market as M
from tickframe.plans.registry import query
from tickframe.sources.adapters import Tables

_SYM = "sym AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS day, CASE WHEN l_linenumber % 2 = 0 THEN 'A' || (l_suppkey % 7) ELSE 'B' || l_suppkey END AS symbol FROM lineitem)"


def symbols(t: Tables):
    s = F.col("l_suppkey")
    return t.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("day"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("A"), s % 7)).otherwise(F.concat(F.lit("B"), s)).alias("symbol"))


_RES = f"{_SYM}, r AS (SELECT s.symbol, s.day, count(DISTINCT m.instrument_id) AS instruments, min(m.instrument_id) AS instrument_id FROM (SELECT DISTINCT symbol, day FROM sym) s JOIN master m ON m.id_value = s.symbol AND s.day >= m.valid_from AND (m.valid_to IS NULL OR s.day < m.valid_to) GROUP BY 1, 2)"


@query("symbol_as_of", f"WITH {_RES} SELECT s.symbol, year(s.day) AS y, CASE WHEN r.instruments = 1 THEN r.instrument_id END AS instrument_id, count(*) AS n FROM sym s LEFT JOIN r ON r.symbol = s.symbol AND r.day = s.day GROUP BY 1, 2, 3")
def symbol_as_of(t: Tables):
    rows, _ = M.resolve(symbols(t), t.master(), "symbol", "day")
    return rows.groupBy("symbol", F.year("day").cast("long").alias("y"), "instrument_id").agg(F.count(F.lit(1)).alias("n"))


@query("symbol_ambiguities", f"WITH {_RES} SELECT symbol, day, instruments FROM r WHERE instruments > 1", dates="day")
def symbol_ambiguities(t: Tables):
    return M.resolve(symbols(t), t.master(), "symbol", "day")[1]


@query("symbol_at", "SELECT m.id_value, count(*) AS n FROM lineitem l LEFT JOIN master m ON m.instrument_id = l.l_suppkey AND CAST(l.l_shipdate AS DATE) >= m.valid_from AND (m.valid_to IS NULL OR CAST(l.l_shipdate AS DATE) < m.valid_to) GROUP BY 1")
def symbol_at(t: Tables):
    rows = symbols(t).withColumnRenamed("l_suppkey", "instrument_id")
    return M.symbol_at(rows, t.master(), "day").groupBy("id_value").agg(F.count(F.lit(1)).alias("n"))


@query("instruments_named", "SELECT id_value, string_agg(CAST(instrument_id AS VARCHAR), ',' ORDER BY instrument_id) AS instruments FROM (SELECT DISTINCT id_value, instrument_id FROM master) GROUP BY 1")
def instruments_named(t: Tables):
    return M.instruments_named(t.master()).withColumn("instruments", F.array_join(F.transform("instruments", lambda x: x.cast("string")), ","))


@query("symbol_spellings", "SELECT DISTINCT id_value FROM master WHERE instrument_id IN (SELECT instrument_id FROM master WHERE id_value = 'A3')")
def symbol_spellings(t: Tables):
    return M.spellings(t.master(), "A3")


@query("symbol_mappings", "SELECT p_size AS instrument_id, p_brand AS symbol, k AS valid_from, lead(k) OVER (PARTITION BY p_size ORDER BY k) AS valid_to FROM (SELECT p_size, p_brand, min(p_partkey) AS k FROM part GROUP BY 1, 2)")
def symbol_mappings(t: Tables):
    starts = t.table("part").groupBy(F.col("p_size").alias("instrument_id"), F.col("p_brand").alias("symbol")).agg(F.min("p_partkey").alias("effective"))
    return M.mappings(starts)


@query("symbol_registration", "SELECT count(*) AS n, min(x) AS first_id, max(x) AS last_id FROM (SELECT (SELECT max(instrument_id) FROM master) + row_number() OVER (ORDER BY p_name || p_brand) AS x FROM (SELECT DISTINCT p_name, p_brand FROM part))")
def symbol_registration(t: Tables):
    new = M.register(t.master(), t.table("part").select(F.concat("p_name", "p_brand").alias("id_value")), "2002-01-01")
    return new.agg(F.count(F.lit(1)).alias("n"), F.min("instrument_id").alias("first_id"), F.max("instrument_id").alias("last_id"))


_TERMS = """terms AS (SELECT c.ticker, c.session, c.contract, c.strike, c.put_call,
            CASE contract % 11 WHEN 0 THEN NULL WHEN 1 THEN 'A' ELSE 'P' END AS settlement_type, CASE WHEN contract % 23 = 5 THEN NULL ELSE 100.0 END AS multiplier,
            contract % 7 = 3 AS non_standard, CASE WHEN contract % 7 = 3 OR contract % 13 = 4 THEN 150 ELSE 100 END AS units FROM (SELECT DISTINCT ticker, session, contract, strike, put_call FROM chains WHERE expiration = session) c),
            close AS (SELECT ticker, session, round(avg(strike) * 4) / 4 AS close FROM chains GROUP BY 1, 2)"""


@query(
    "settlement_view",
    f"""WITH {_TERMS}, j AS (SELECT t.*, round(c.close * 100)::BIGINT AS cc, CASE WHEN abs(strike * 100 - round_even(strike * 100, 0)) <= 1e-6 THEN round_even(strike * 100, 0)::BIGINT END AS sc FROM terms t JOIN close c USING (ticker, session)),
        r AS (SELECT *, CASE WHEN settlement_type IS NULL THEN 'terms_unreadable' WHEN settlement_type <> 'P' THEN 'am_settled' WHEN multiplier IS NULL THEN 'terms_unreadable' WHEN non_standard AND units <> 100 THEN 'non_standard'
              WHEN non_standard <> (units <> 100) THEN 'deliverable_disagrees' WHEN sc IS NULL THEN 'strike_not_in_cents' END AS reason FROM j)
        SELECT ticker, session, contract, CASE WHEN reason IS NULL THEN 'settled' ELSE 'absent' END AS verdict, reason, CASE WHEN reason IS NULL THEN greatest(0, CASE put_call WHEN 'CALL' THEN cc - sc ELSE sc - cc END) END AS intrinsic_cents,
        CASE WHEN reason IS NULL THEN CAST(greatest(0, CASE put_call WHEN 'CALL' THEN cc - sc ELSE sc - cc END) >= 1 AS INTEGER) END AS exercised FROM r""",
    dates="session",
)
def settlement_view(t: Tables):
    c = F.col("contract")
    units = F.when((c % 7 == 3) | (c % 13 == 4), 150).otherwise(100)
    item = F.concat(F.lit('[{"assetType":"STOCK","currencyType":null,"deliverableUnits":'), units.cast("string"), F.lit('.0,"symbol":"'), F.col("ticker"), F.lit('"}]'))
    terms = t.chains().where("expiration = session").select("ticker", "session", "contract", "strike", "put_call").distinct()
    terms = terms.withColumns({"settlement_type": F.when(c % 11 == 0, None).when(c % 11 == 1, "A").otherwise("P"), "multiplier": F.when(c % 23 == 5, None).otherwise(100.0), "non_standard": c % 7 == 3, "deliverables": item, "underlying": F.col("ticker")})
    close = t.chains().groupBy("ticker", "session").agg((F.round(F.avg("strike") * 4) / 4).alias("close"))
    out = M.settlement(terms, close, ["ticker", "session"])
    return out.select("ticker", "session", "contract", "verdict", "reason", "intrinsic_cents", F.col("exercised").cast("int").alias("exercised"))


_OI = """ros AS (SELECT 'T' || (l_suppkey % 5) AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS session, l_partkey % 400 AS contract, CAST(max(l_quantity) AS BIGINT) AS open_interest, CAST(sum(l_quantity) AS BIGINT) AS volume,
         CAST(date_trunc('month', l_shipdate) AS DATE) + 7 * CAST(l_partkey % 400 % 8 AS INTEGER) AS expiration FROM lineitem GROUP BY 1, 2, 3, 6),
         lat AS (SELECT 'T' || (l_suppkey % 5) AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS session, cy AS cycle, l_partkey % 400 AS contract, CAST(max(l_quantity + CASE WHEN cy >= 2 OR l_partkey % 10 < 2 THEN 1 ELSE 0 END) AS BIGINT) AS open_interest
         FROM lineitem, (SELECT unnest([1, 2, 3]) AS cy) WHERE month(l_shipdate) <> 6 GROUP BY 1, 2, 3, 4)"""


@query(
    "oi_view",
    f"""WITH {_OI}, vo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, session ORDER BY volume DESC, contract) AS r FROM ros WHERE expiration > session) WHERE r <= 60),
        v AS (SELECT l.*, vo.open_interest AS base, lead(l.cycle) OVER w AS nc, lead(l.open_interest) OVER w AS noi FROM lat l JOIN vo USING (ticker, session, contract) WINDOW w AS (PARTITION BY l.ticker, l.session, l.contract ORDER BY l.cycle)),
        per AS (SELECT ticker, session, cycle, count(*) AS voters, count(*) FILTER (WHERE open_interest <> base) AS changed, bool_and(coalesce(nc = cycle + 1 AND noi = open_interest, false)) AS held FROM v GROUP BY 1, 2, 3),
        pas AS (SELECT ticker, session, min(cycle) AS source_cycle FROM per WHERE voters >= 20 AND changed >= 0.5 * voters AND held GROUP BY 1, 2),
        mx AS (SELECT ticker, session, max(voters) AS most FROM per GROUP BY 1, 2), ls AS (SELECT DISTINCT ticker, session, 1 AS later FROM lat),
        j AS (SELECT r.*, p.source_cycle, m.most, ls.later, l.open_interest AS oi FROM ros r LEFT JOIN ls USING (ticker, session) LEFT JOIN mx m USING (ticker, session) LEFT JOIN pas p USING (ticker, session) LEFT JOIN lat l ON l.ticker = r.ticker AND l.session = r.session AND l.cycle = p.source_cycle AND l.contract = r.contract),
        x AS (SELECT *, CASE WHEN later IS NULL THEN 'not_yet_captured' WHEN source_cycle IS NULL AND coalesce(most, 0) < 20 THEN 'set_under_floor' WHEN source_cycle IS NULL THEN 'no_cycle_passed' WHEN expiration <= session THEN 'expired_out' WHEN oi IS NULL THEN 'no_value_in_cycle' END AS reason FROM j)
        SELECT ticker, session, contract, CASE WHEN reason IS NULL THEN 'settled' WHEN reason = 'not_yet_captured' THEN 'pending' WHEN reason = 'set_under_floor' THEN 'indeterminate' ELSE 'absent' END AS verdict, reason, CASE WHEN reason IS NULL THEN oi END AS settled_interest, source_cycle FROM x""",
    dates="session",
)
def oi_view(t: Tables):
    li = t.table("lineitem").select(F.concat(F.lit("T"), F.col("l_suppkey") % 5).alias("ticker"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("session"), (F.col("l_partkey") % 400).alias("contract"), "l_partkey", "l_quantity")
    roster = li.groupBy("ticker", "session", "contract").agg(F.max("l_quantity").cast("long").alias("open_interest"), F.sum("l_quantity").cast("long").alias("volume")).withColumn("expiration", F.date_add("session", (7 * (F.col("contract") % 8)).cast("int")))
    later = li.where(F.month("session") != 6).select("*", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("cycle"))
    later = later.groupBy("ticker", "session", "cycle", "contract").agg(F.max(F.col("l_quantity") + F.when((F.col("cycle") >= 2) | (F.col("l_partkey") % 10 < 2), 1).otherwise(0)).cast("long").alias("open_interest"))
    return M.open_interest(roster, later, ["ticker", "session"], size=60)


@query("comparable_set", "SELECT ticker, session, cycle, contract FROM (SELECT *, row_number() OVER (PARTITION BY ticker, session, cycle ORDER BY volume DESC, contract) AS r FROM chains WHERE expiration > session) WHERE r <= 3", dates="session cycle")
def comparable_set(t: Tables):
    return M.comparable(t.chains(), ["ticker", "session", "cycle"], 3).select("ticker", "session", "cycle", "contract")


@query(
    "oi_refresh",
    """WITH c AS (SELECT ticker, CAST(date_trunc('quarter', cycle) AS DATE) AS session, cycle, contract % 40 AS contract, max(open_interest) AS oi FROM chains GROUP BY 1, 2, 3, 4), e AS (SELECT ticker, session, min(cycle) AS f, max(cycle) AS l FROM c GROUP BY 1, 2),
       j AS (SELECT c.*, a.oi AS ao, z.oi AS zo FROM c JOIN e USING (ticker, session) JOIN c a ON a.ticker = c.ticker AND a.session = c.session AND a.cycle = e.f AND a.contract = c.contract LEFT JOIN c z ON z.ticker = c.ticker AND z.session = c.session AND z.cycle = e.l AND z.contract = c.contract),
       p AS (SELECT ticker, session, cycle, count(*) FILTER (WHERE oi IS DISTINCT FROM ao) AS changed, coalesce(bool_and(oi IS NOT DISTINCT FROM zo) FILTER (WHERE zo IS NOT NULL), true) AS atomic FROM j GROUP BY 1, 2, 3)
       SELECT ticker, session, min(cycle) AS refreshed, arg_min(changed, cycle) AS changed, arg_min(atomic, cycle) AS atomic FROM p WHERE changed > 0 GROUP BY 1, 2""",
    dates="session refreshed",
)
def oi_refresh(t: Tables):
    c = t.chains().groupBy("ticker", F.to_date(F.date_trunc("quarter", "cycle")).alias("session"), "cycle", (F.col("contract") % 40).alias("contract")).agg(F.max("open_interest").alias("open_interest"))
    return M.refresh_moment(c, ["ticker", "session"])


@query("same_day_expiries", "SELECT c.ticker, c.session, count(*) FILTER (WHERE expiration = c.session) AS expiring, count(*) AS contracts FROM chains c JOIN (SELECT ticker, session, max(cycle) AS l FROM chains GROUP BY 1, 2) x ON x.ticker = c.ticker AND x.session = c.session AND c.cycle = x.l GROUP BY 1, 2", dates="session")
def same_day_expiries(t: Tables):
    return M.same_day_expiries(t.chains(), ["ticker", "session"])


@query(
    "latest_expirations",
    """WITH p AS (SELECT ticker, cycle, string_agg(DISTINCT CAST(expiration AS VARCHAR), ',' ORDER BY CAST(expiration AS VARCHAR)) AS e FROM chains WHERE day(cycle) % 3 <> 0 GROUP BY 1, 2)
       SELECT ticker, arg_max(e, cycle) AS expirations, max(cycle) AS cycle FROM p GROUP BY 1""",
    dates="cycle",
)
def latest_expirations(t: Tables):
    c = t.chains().withColumn("expiration", F.when(F.day("cycle") % 3 != 0, F.col("expiration")))
    return M.latest_expirations(c, ["ticker"]).withColumn("expirations", F.array_join(F.transform("expirations", lambda x: x.cast("string")), ","))


@query(
    "absent_series",
    """SELECT DISTINCT ticker, session, expiration FROM chains c WHERE NOT EXISTS (SELECT 1 FROM chains x WHERE x.ticker = c.ticker AND x.session = c.session AND x.expiration = c.expiration AND x.contract % 3 = 0)
       AND NOT (ticker = 'T1' AND expiration BETWEEN DATE '1997-01-01' AND DATE '1998-12-31')""",
    dates="session expiration",
)
def absent_series(t: Tables):
    failed = t.chains().where("ticker = 'T1'").select("ticker", "session", F.lit("1997-01-01").cast("date").alias("lo"), F.lit("1998-12-31").cast("date").alias("hi")).distinct()
    return M.absent_series(t.chains(), t.chains().where("contract % 3 = 0"), failed, ["ticker", "session"])


@query(
    "missing_close",
    """WITH o AS (SELECT s.ticker, c.day FROM spans s CROSS JOIN calendar c), x AS (SELECT s.ticker, s.day, count(*) FILTER (WHERE row_kind = 'data' AND slot = close_at AND event_id % 3 = 0) AS d, count(*) FILTER (WHERE row_kind = 'gap' AND slot = close_at AND event_id % 3 = 0) AS g FROM slots s JOIN calendar c USING (day) GROUP BY 1, 2)
       SELECT o.ticker, o.day, CASE WHEN coalesce(g, 0) > 0 THEN 'failed' ELSE 'never_ran' END AS state FROM o LEFT JOIN x USING (ticker, day) WHERE coalesce(d, 0) = 0""",
    dates="day",
)
def missing_close(t: Tables):
    rows = t.slots().join(t.calendar(), "day").withColumn("close_tag", F.when((F.col("slot") == F.col("close_at")) & (F.col("event_id") % 3 == 0), "spot_close"))
    names = t.spans().agg(F.collect_set("ticker").alias("_t"))
    owed = t.calendar().join(F.broadcast(names)).select("day", F.explode("_t").alias("ticker"))
    return M.missing_close(owed, rows, ["ticker", "day"])


_STRIKES = """ses AS (SELECT 'T' || (l_suppkey % 5) AS ticker, CAST(date_trunc('week', l_shipdate) AS DATE) AS day, floor((epoch(date_trunc('week', l_shipdate)) / 604800))::BIGINT AS idx,
              CASE WHEN month(date_trunc('week', l_shipdate)) % 2 = 0 THEN 50.0 ELSE 100.0 END AS spot, list_sort(coalesce(list(DISTINCT (l_partkey % 40) * CASE WHEN month(date_trunc('week', l_shipdate)) % 2 = 0 THEN 2.5::DOUBLE ELSE 5.0::DOUBLE END) FILTER (WHERE l_linenumber <> 3), [])) AS strikes FROM lineitem GROUP BY 1, 2, 3, 4)"""


@query(
    "strike_scale",
    f"""WITH {_STRIKES}, l AS (SELECT *, lag(spot) OVER w AS ps, lag(strikes) OVER w AS pk, idx - lag(idx) OVER w - 1 AS unread_since FROM ses WINDOW w AS (PARTITION BY ticker ORDER BY day)),
        r AS (SELECT *, CASE WHEN ps / spot >= 1.5 THEN round(ps / spot) WHEN ps / spot <= 1 / 1.5 THEN 1 / round(spot / ps) END AS ratio FROM l WHERE ps IS NOT NULL)
        SELECT ticker, day, ratio::DOUBLE AS ratio, unread_since, len(list_intersect(list_transform(pk, lambda x: x / ratio), strikes)) / nullif(len(pk), 0) AS confirmed, coalesce(len(list_intersect(list_transform(pk, lambda x: x / ratio), strikes)) / nullif(len(pk), 0) >= 0.5, false) AS trips FROM r WHERE ratio IS NOT NULL""",
    dates="day",
)
def strike_scale(t: Tables):
    week = F.date_trunc("week", "l_shipdate")
    even = F.month("day") % 2 == 0
    li = t.table("lineitem").select(F.concat(F.lit("T"), F.col("l_suppkey") % 5).alias("ticker"), F.to_date(week).alias("day"), "l_partkey", "l_linenumber")
    k = F.when(F.col("l_linenumber") != 3, F.col("l_partkey") % 40 * F.when(even, 2.5).otherwise(5.0))  # some rows have no strike
    idx = F.floor(F.unix_timestamp(F.col("day").cast("timestamp")) / 604800)
    s = li.groupBy("ticker", "day").agg(F.array_sort(F.collect_set(k)).alias("strikes")).select("ticker", "day", idx.alias("idx"), F.when(even, 50.0).otherwise(100.0).alias("spot"), "strikes")
    return M.strike_scale(s)


_ROOTS = """roots AS (SELECT 'T' || (p_size % 10) AS ticker, p_size AS idx, DATE '2000-01-01' + p_size AS day, 'R' || (p_size % 10) || (p_size // 17) || CASE WHEN p_brand = 'Brand#7' THEN 'X' ELSE '' END AS root, p_brand = 'Brand#7' AS non_standard,
            CASE WHEN p_brand = 'Brand#7' THEN 200.0 ELSE 100.0 END AS units FROM part GROUP BY ALL)"""


@query(
    "split_detection",
    f"""WITH {_ROOTS}, s AS (SELECT ticker, day, lag(day) OVER w AS pd, idx - lag(idx) OVER w - 10 AS unread FROM (SELECT DISTINCT ticker, day, idx FROM roots) WINDOW w AS (PARTITION BY ticker ORDER BY day)),
        f AS (SELECT ticker, root, min(day) AS day FROM roots GROUP BY 1, 2)
        SELECT r.ticker, r.day AS ex_date, r.root, CASE WHEN s.unread > 0 THEN 'sessions_unread' WHEN p.units IS NULL THEN 'no_prior' ELSE 'landed' END AS outcome, CASE WHEN p.units IS NOT NULL THEN r.units / p.units END AS split_ratio
        FROM roots r JOIN f ON f.ticker = r.ticker AND f.root = r.root AND f.day = r.day JOIN s ON s.ticker = r.ticker AND s.day = r.day LEFT JOIN roots p ON p.ticker = r.ticker AND p.day = s.pd AND NOT p.non_standard WHERE r.non_standard AND s.pd IS NOT NULL""",
    dates="ex_date",
)
def split_detection(t: Tables):
    odd = F.col("p_brand") == "Brand#7"
    p = t.table("part")
    ticker = F.concat(F.lit("T"), F.col("p_size") % 10)
    root = F.concat(F.lit("R"), F.col("p_size") % 10, F.floor(F.col("p_size") / 17), F.when(odd, "X").otherwise(""))
    units = F.when(odd, 200.0).otherwise(100.0)
    r = p.select(ticker.alias("ticker"), F.col("p_size").alias("idx"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("p_size")).alias("day"), root.alias("root"), odd.alias("non_standard"), units.alias("units"), F.lit(100.0).alias("multiplier"), F.lit(False).alias("cash"), F.lit(1).alias("entries"), ticker.alias("symbol"), units.alias("note_units")).distinct()
    sessions = r.select("ticker", "day", ((F.col("idx") - F.col("idx") % 10) / 10).cast("int").alias("idx")).distinct()
    landed, held = M.detect_splits(sessions, r)
    return landed.withColumn("outcome", F.lit("landed")).unionByName(held.withColumnRenamed("held", "outcome")).select("ticker", "ex_date", "root", "outcome", "split_ratio")


@query(
    "contract_pairings",
    """WITH o AS (SELECT p_size AS b, p_partkey AS ssid, p_name || p_partkey AS os FROM part WHERE p_partkey % 29 <> 0), n AS (SELECT p_size AS b, p_partkey AS ssid, CASE WHEN p_partkey % 3 = 0 THEN p_name || p_partkey ELSE p_type || p_partkey END AS ns FROM part WHERE p_partkey % 31 <> 0),
       j AS (SELECT coalesce(o.b, n.b) AS b, coalesce(o.ssid, n.ssid) AS ssid, os, ns FROM o FULL JOIN n ON o.b = n.b AND o.ssid = n.ssid), bad AS (SELECT b FROM j WHERE os IS NULL OR ns IS NULL)
       SELECT b, ssid, os AS old_symbol, ns AS new_symbol FROM j WHERE b NOT IN (SELECT b FROM bad) AND os <> ns""",
)
def contract_pairings(t: Tables):
    p, k = t.table("part"), F.col("p_partkey")
    old = p.where("p_partkey % 29 <> 0").select(F.col("p_size").alias("b"), k.alias("ssid"), F.concat("p_name", k).alias("symbol"), k.alias("valid_from"))
    new = p.where("p_partkey % 31 <> 0").select(F.col("p_size").alias("b"), k.alias("ssid"), F.when(k % 3 == 0, F.concat("p_name", k)).otherwise(F.concat("p_type", k)).alias("symbol"))
    return M.pairings(old, new, ["b"])[0].select("b", "ssid", "old_symbol", "new_symbol")


@query(
    "symbol_starts",
    """WITH d AS (SELECT l_suppkey AS ssid, CAST(l_shipdate AS DATE) AS day, min(l_returnflag) AS symbol FROM lineitem GROUP BY 1, 2), c AS (SELECT *, CASE WHEN symbol <> lag(symbol) OVER w THEN 1 ELSE 0 END AS ch FROM d WINDOW w AS (PARTITION BY ssid ORDER BY day)),
       i AS (SELECT *, sum(ch) OVER (PARTITION BY ssid ORDER BY day) AS isl FROM c) SELECT ssid, symbol, min(day) AS valid_from, max(day) AS last_seen FROM i GROUP BY ssid, isl, symbol""",
    dates="valid_from last_seen",
)
def symbol_starts(t: Tables):
    d = t.table("lineitem").groupBy(F.col("l_suppkey").alias("ssid"), F.to_date("l_shipdate").alias("day")).agg(F.min("l_returnflag").alias("symbol"))
    return M.symbol_starts(d)


@query(
    "standing_marks",
    """WITH m AS (SELECT instrument_id, ex_date AS day, CASE WHEN instrument_id % 5 = 0 AND ex_date < DATE '1998-01-01' THEN 'non_scalar' ELSE 'indeterminate' END AS mark FROM (SELECT DISTINCT instrument_id, ex_date FROM actions WHERE type = 'split' AND seq % 40 = 0))
       SELECT b.instrument_id, b.session AS day, CASE WHEN (SELECT count(*) FROM m WHERE m.instrument_id = b.instrument_id AND m.day > b.session AND mark = 'non_scalar') > 0 THEN 'non_scalar' ELSE (SELECT arg_min(mark, day) FROM m WHERE m.instrument_id = b.instrument_id AND m.day > b.session) END AS standing FROM bars b""",
    dates="day",
)
def standing_marks(t: Tables):
    marks = t.actions().where("type = 'split' and seq % 40 = 0").select("instrument_id", F.col("ex_date").alias("day")).distinct()
    marks = marks.withColumn("mark", F.when((F.col("instrument_id") % 5 == 0) & (F.col("day") < F.lit("1998-01-01").cast("date")), "non_scalar").otherwise("indeterminate"))
    return M.standing_marks(t.bars().select("instrument_id", F.col("session").alias("day")), marks, "instrument_id")


@query(
    "dividend_extraction",
    """WITH q AS (SELECT DISTINCT o_custkey % 25 AS instrument_id, CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('quarter', o_orderdate) AS DATE) + 90 AS ex_date, 4 AS f, (o_custkey % 25 + 1) / 16.0::DOUBLE AS pay, (o_custkey % 25 + 1) / 4.0::DOUBLE + CASE WHEN o_custkey % 25 % 6 = 0 THEN 1 ELSE 0 END AS annual FROM orders),
       s AS (SELECT instrument_id, ex_date, pay, annual, f, min(day) AS observed_on FROM q GROUP BY ALL)
       SELECT instrument_id, ex_date, pay AS cash_amount, observed_on FROM s WHERE abs(f * pay - annual) <= 3e-6 * abs(annual) AND NOT (instrument_id % 4 = 1)""",
    dates="ex_date observed_on",
)
def dividend_extraction(t: Tables):
    i = F.col("o_custkey") % 25
    q = t.table("orders").select(i.alias("instrument_id"), F.to_date("o_orderdate").alias("day"), F.date_add(F.to_date(F.date_trunc("quarter", "o_orderdate")), 90).alias("ex_date"), F.lit(4).alias("div_freq"), ((i + 1) / 16).alias("div_pay_amount"), ((i + 1) / 4 + F.when(i % 6 == 0, 1).otherwise(0)).alias("div_amount"))
    known = q.where("instrument_id % 4 = 1").select("instrument_id", "ex_date", F.col("div_pay_amount").alias("cash_amount")).distinct()
    return M.extract_dividends(q, known)[0]


@query(
    "backfill_census",
    """WITH o AS (SELECT DISTINCT s.ticker, c.day, f.freq FROM spans s JOIN calendar c ON s.span_start <= c.close_at AND (s.span_end IS NULL OR s.span_end > c.open_at) CROSS JOIN (SELECT unnest(['1d', '1m']) AS freq) f)
       SELECT ticker, day, freq FROM o WHERE NOT EXISTS (SELECT 1 FROM slots x WHERE x.event_id % 40 = 0 AND x.ticker = o.ticker AND x.day = o.day AND o.freq = '1d') ORDER BY day DESC, ticker, freq <> '1m', freq LIMIT 100""",
    dates="day",
)
def backfill_census(t: Tables):
    landed = t.slots().where("event_id % 40 = 0").select("ticker", "day", F.lit("1d").alias("freq")).distinct()
    return M.census(t.spans(), t.calendar(), landed, ["1d", "1m"])


@query("latest_action_view", "SELECT instrument_id, ex_date, type, max(seq) AS seq, arg_max(CASE type WHEN 'split' THEN split_ratio ELSE cash_amount END, seq) AS amount FROM actions GROUP BY 1, 2, 3", dates="ex_date")
def latest_action_view(t: Tables):
    led = L.latest(t.actions(), ["instrument_id", "ex_date", "type"])
    return led.select("instrument_id", "ex_date", "type", "seq", F.when(F.col("type") == "split", F.col("split_ratio")).otherwise(F.col("cash_amount")).alias("amount"))
