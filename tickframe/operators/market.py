"""Market views and event detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.operators import scans
from tickframe.operators.bars import cents, next_event, number
from tickframe.operators.snapshots import spans_of_sessions

DELIVERABLES = "array<struct<assetType:string,currencyType:string,deliverableUnits:double,symbol:string>>"


def occ_root(symbol: Column, option_root: Column | None = None) -> Column:
    """Root of an option symbol: the vendor's own, or the first six characters (K7)."""
    own = F.trim(F.substring(symbol, 1, 6))
    return own if option_root is None else F.coalesce(option_root, own)


def occ_expiry(symbol: Column) -> Column:
    """Expiration coded in an option symbol, null where it has another shape (K7); years from 69 on are of the last century."""
    day = F.to_date(F.when(symbol.rlike(r"^.{6}\d{6}[CP]\d{8}$"), F.try_to_timestamp(F.substring(symbol, 7, 6), F.lit("yyMMdd"))))
    return F.when(F.year(day) > 2068, F.add_months(day, -1200)).otherwise(day)


def resolve(rows: DataFrame, master: DataFrame, symbol: str, day: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the instrument that bore their symbol on their day, null if none did; and the ambiguous ones.

    A symbol's history is laid out by days: an entry adds its instrument where it begins and takes it away where it ends, so a running count
    says how many bear the symbol and, where it is one, the running exclusive-or of their ids says which. Distinct (symbol, day) stand in the
    same order, so no row is made for a pair of a day and an entry, and a symbol never has more rows than there are days.
    """
    move = lambda at, n: F.struct(F.col(at).alias("_d"), F.lit(n).alias("_n"), F.col("instrument_id").cast("long").alias("_i"))
    moves = _spells(master).select("_s", F.explode(F.array(move("_from", 1), move("_to", -1))).alias("_m")).select("_s", "_m.*", F.lit(False).alias("_asked")).where("_d is not null")
    asked = rows.select(F.col(symbol).alias("_s"), F.col(day).alias("_d"), F.lit(0).alias("_n"), F.lit(0).cast("long").alias("_i"), F.lit(True).alias("_asked")).where("_s is not null and _d is not null")
    days = asked.unionByName(moves).groupBy("_s", "_d").agg(F.sum("_n").alias("_n"), F.bit_xor("_i").alias("_i"), F.bool_or("_asked").alias("_asked"))
    so_far = Window.partitionBy("_s").orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    held = days.select("_s", "_d", "_asked", F.sum("_n").over(so_far).alias("instruments"), F.bit_xor("_i").over(so_far).alias("instrument_id")).where("_asked and instruments > 0")
    one = held.where("instruments = 1").select("_s", "_d", "instrument_id")
    out = rows.join(one, (F.col(symbol) == F.col("_s")) & (F.col(day) == F.col("_d")), "left").drop("_s", "_d")
    return out, held.where("instruments > 1").select(F.col("_s").alias(symbol), F.col("_d").alias(day), "instruments")


def _spells(master: DataFrame) -> DataFrame:
    """(_s, instrument_id, _from, _to): an instrument's entries for one symbol, those that overlap or touch as one; _to is null if open."""
    m = master.select("instrument_id", F.col("id_value").alias("_s"), "valid_from", "valid_to").where("instrument_id is not null and _s is not null and valid_from is not null and (valid_to is null or valid_from < valid_to)")
    before = Window.partitionBy("_s", "instrument_id").orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    begins = ~F.coalesce(F.bool_or(F.col("valid_to").isNull()).over(before), F.lit(False)) & F.coalesce(F.max("valid_to").over(before) < F.col("valid_from"), F.lit(True))
    m = m.withColumn("_new", begins.cast("int")).withColumn("_k", F.sum("_new").over(Window.partitionBy("_s", "instrument_id").orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, 0)))
    return m.groupBy("_s", "instrument_id", "_k").agg(F.min("valid_from").alias("_from"), F.when(~F.bool_or(F.col("valid_to").isNull()), F.max("valid_to")).alias("_to")).drop("_k")


def symbol_at(rows: DataFrame, master: DataFrame, day: str) -> DataFrame:
    """Rows with the symbol their instrument bore on their day."""
    m = master.select(F.col("instrument_id").alias("_i"), "id_value", "valid_from", "valid_to")
    on = (F.col("instrument_id") == F.col("_i")) & (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    return rows.join(m, on, "left").drop("_i", "valid_from", "valid_to")


def instruments_named(master: DataFrame) -> DataFrame:
    """All instruments that ever bore a spelling."""
    return master.groupBy("id_value").agg(F.array_sort(F.collect_set("instrument_id")).alias("instruments"))


def mappings(starts: DataFrame, key: str = "instrument_id") -> DataFrame:
    """SCD-2 rows from (key, symbol, effective): each ends where the next begins."""
    w = Window.partitionBy(key).orderBy("effective")
    return starts.select(key, "symbol", F.col("effective").alias("valid_from"), F.lead("effective").over(w).alias("valid_to"))


def register(known: DataFrame, symbols: DataFrame, day: str) -> DataFrame:
    """Master rows for symbols that have none, with ids after the largest (H15): ids follow the symbols' order by counting, not by one sorted task."""
    new = symbols.select("id_value").distinct().join(known.select("id_value"), "id_value", "left_anti").withColumn("_b", F.pmod(F.xxhash64("id_value"), F.lit(64)))
    top = known.agg(F.coalesce(F.max("instrument_id"), F.lit(0)).alias("_top"))
    sizes = new.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    before = sizes.alias("x").join(sizes.alias("y"), F.col("y._b") < F.col("x._b"), "left").groupBy("x._b").agg(F.coalesce(F.sum("y._c"), F.lit(0)).alias("_before"))
    n = F.row_number().over(Window.partitionBy("_b").orderBy("id_value"))
    return new.join(before, "_b").join(F.broadcast(top)).select((F.col("_top") + F.col("_before") + n).alias("instrument_id"), "id_value", F.lit(day).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))


def deliverable(items: Column) -> Column:
    """What a contract delivers, from the vendor's JSON list (H10): entries, symbol, units, cash; null if it can't be read.

    It is readable with exactly one stock item of finite positive units.
    """
    parsed = F.from_json(items, DELIVERABLES)
    stock = F.filter(parsed, lambda x: x["assetType"] == "STOCK")
    units = number(F.get(stock, F.lit(0))["deliverableUnits"])
    ok = (F.size(stock) == 1) & (units > 0)
    return F.when(ok, F.struct(F.size(parsed).alias("entries"), F.get(stock, F.lit(0))["symbol"].alias("symbol"), units.alias("units"), F.exists(parsed, lambda x: x["currencyType"].isNotNull()).alias("cash")))


def settlement(contracts: DataFrame, closes: DataFrame, keys: list[str]) -> DataFrame:
    """Each contract that expires on its session, settled at the close's whole cents or absent with a reason (H3).

    contracts: settlement_type, put_call, strike, multiplier, non_standard, deliverables, underlying; closes: keys and close.
    """
    c = contracts.join(closes.select(*keys, cents(F.col("close")).alias("close_cents")), keys, "left").withColumn("_d", deliverable(F.col("deliverables")))
    flag = ~F.col("non_standard")
    plain = (F.col("_d.entries") == 1) & ~F.col("_d.cash") & (F.col("_d.symbol") == F.col("underlying")) & (F.col("_d.units") == F.col("multiplier"))
    unreadable = ~F.coalesce(F.col("put_call").isin("CALL", "PUT"), F.lit(False)) | number(F.col("strike")).isNull() | number(F.col("multiplier")).isNull() | F.col("_d").isNull() | flag.isNull()
    strike = cents(F.col("strike"))
    reason = (
        F.when(F.col("settlement_type").isNull(), "terms_unreadable")
        .when(F.col("settlement_type") != "P", "am_settled")
        .when(unreadable, "terms_unreadable")
        .when(~flag & ~plain, "non_standard")
        .when(flag != plain, "deliverable_disagrees")
        .when(strike.isNull(), "strike_not_in_cents")
        .when(F.col("close_cents").isNull(), "close_not_in_cents")
    )
    signed = F.when(F.col("put_call") == "CALL", F.col("close_cents") - strike).otherwise(strike - F.col("close_cents"))
    value = F.when(reason.isNull(), F.greatest(F.lit(0), signed))
    return c.select(*contracts.columns, F.when(reason.isNull(), "settled").otherwise("absent").alias("verdict"), reason.alias("reason"), value.alias("intrinsic_cents"), (value >= 1).alias("exercised"))


def comparable(roster: DataFrame, keys: list[str], size: int = 200) -> DataFrame:
    """Contracts that live past their session, the most traded first."""
    w = Window.partitionBy(*keys).orderBy(F.desc("volume"), "contract")
    return roster.where(F.col("expiration") > F.col("session")).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= size).drop("_r")


def open_interest(roster: DataFrame, later: DataFrame, keys: list[str], size: int = 200, floor: int = 20, quorum: float = 0.5, plateau: int = 1) -> DataFrame:
    """Settled open interest of each roster contract, read from the first later cycle that passes.

    roster: keys, session, contract, open_interest (baseline), volume, expiration. later: keys, cycle, contract, open_interest.
    A cycle passes if at least floor comparable contracts vote, a quorum of the votes differs from the baseline, and all
    voters keep their value over the next ``plateau`` cycles. Nulls don't vote.
    """
    voters = comparable(roster, keys, size).select(*keys, "contract", F.col("open_interest").alias("_base"))
    cyc = later.select(*keys, "cycle").distinct().withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy("cycle")))
    votes = later.where("open_interest is not null").join(voters, [*keys, "contract"]).join(cyc, [*keys, "cycle"])
    w = Window.partitionBy(*keys, "contract").orderBy("_i")
    holds = F.lit(True)
    for j in range(1, plateau + 1):
        holds = holds & F.coalesce((F.lead("_i", j).over(w) == F.col("_i") + j) & (F.lead("open_interest", j).over(w) == F.col("open_interest")), F.lit(False))
    per = votes.withColumn("_h", holds).groupBy(*keys, "cycle", "_i").agg(F.count(F.lit(1)).alias("voters"), F.count_if(F.col("open_interest") != F.col("_base")).alias("changed"), F.bool_and("_h").alias("held"))
    passed = per.where((F.col("voters") >= floor) & (F.col("changed") >= quorum * F.col("voters")) & F.col("held")).groupBy(*keys).agg(F.min("cycle").alias("source_cycle"))
    most = per.groupBy(*keys).agg(F.max("voters").alias("_most"))
    sessions = roster.select(*keys).distinct().join(later.select(*keys).distinct().withColumn("_later", F.lit(True)), keys, "left").join(most, keys, "left").join(passed, keys, "left")
    at = later.withColumnRenamed("cycle", "source_cycle").withColumnRenamed("open_interest", "_oi")
    j = roster.join(sessions, keys, "left").join(at.select(*keys, "source_cycle", "contract", "_oi"), [*keys, "source_cycle", "contract"], "left")
    reason = (
        F.when(F.col("_later").isNull(), "not_yet_captured")
        .when(F.col("source_cycle").isNull() & (F.coalesce("_most", F.lit(0)) < floor), "set_under_floor")
        .when(F.col("source_cycle").isNull(), "no_cycle_passed")
        .when(F.col("expiration") <= F.col("session"), "expired_out")
        .when(F.col("_oi").isNull(), "no_value_in_cycle")
    )
    verdict = F.when(reason.isNull(), "settled").when(reason == "not_yet_captured", "pending").when(reason == "set_under_floor", "indeterminate").otherwise("absent")
    return j.select(*keys, "contract", verdict.alias("verdict"), reason.alias("reason"), F.when(reason.isNull(), F.col("_oi")).alias("settled_interest"), "source_cycle")


def refresh_moment(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First cycle whose open interest differs from the first cycle's on shared contracts, and whether it is the last one's already."""
    ends = rows.groupBy(*keys).agg(F.min("cycle").alias("_first"), F.max("cycle").alias("_last"))
    r = rows.join(ends, keys)
    part = lambda c, n: r.where(F.col("cycle") == F.col(c)).select(*keys, "contract", F.col("open_interest").alias(n))
    j = r.join(part("_first", "_a"), [*keys, "contract"]).join(part("_last", "_z"), [*keys, "contract"], "left")
    oi = F.col("open_interest")
    per = j.groupBy(*keys, "cycle").agg(F.count_if(~oi.eqNullSafe(F.col("_a"))).alias("changed"), F.coalesce(F.bool_and(F.when(F.col("_z").isNotNull(), oi.eqNullSafe(F.col("_z")))), F.lit(True)).alias("atomic"))
    moved = per.where("changed > 0")
    return moved.groupBy(*keys).agg(F.min("cycle").alias("refreshed"), F.min_by("changed", "cycle").alias("changed"), F.min_by("atomic", "cycle").alias("atomic"))


def same_day_expiries(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Contracts of the last cycle that expire on its session."""
    last = rows.groupBy(*keys).agg(F.max("cycle").alias("_l"))
    return rows.join(last, keys).where("cycle = _l").groupBy(*keys).agg(F.count_if(F.col("expiration") == F.col("session")).alias("expiring"), F.count(F.lit(1)).alias("contracts"))


def latest_expirations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted distinct expirations of the newest batch that names any."""
    per = rows.groupBy(*keys, "cycle").agg(F.array_sort(F.collect_set("expiration")).alias("e"))
    return per.where(F.size("e") > 0).groupBy(*keys).agg(F.max_by("e", "cycle").alias("expirations"), F.max("cycle").alias("cycle"))


def absent_series(intraday: DataFrame, close: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """Expirations seen intraday, missing at the close, and outside every failed fetch window (C17)."""
    gone = intraday.select(*keys, "expiration").distinct().join(close.select(*keys, "expiration"), [*keys, "expiration"], "left_anti")
    f = failed.select(*(F.col(k).alias(f"_{k}") for k in keys), "lo", "hi")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return gone.join(f, on & F.col("expiration").between(F.col("lo"), F.col("hi")), "left_anti")


def missing_close(owed: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Owed keys without a close row: never ran, or ran and failed."""
    tagged = F.col("close_tag").isNotNull()
    seen = rows.groupBy(*keys).agg(F.count_if(tagged & (F.col("row_kind") == "data")).alias("_d"), F.count_if(tagged & (F.col("row_kind") == "gap")).alias("_g"))
    j = owed.join(seen, keys, "left").where("coalesce(_d, 0) = 0")
    return j.select(*keys, F.when(F.coalesce("_g", F.lit(0)) > 0, "failed").otherwise("never_ran").alias("state"))


def strike_scale(sessions: DataFrame, key: str = "ticker", step: float = 1.5, within: float = 0.05, trip: float = 0.5) -> DataFrame:
    """Whole-number split check between neighbouring sessions.

    sessions: key, day, idx (of the calendar), spot, strikes (distinct). The share of yesterday's strikes that stand
    today at strike / ratio, to three places, confirms; unread_since counts sessions between that nobody read.
    """
    w = Window.partitionBy(key).orderBy("day")
    s = sessions.withColumns({"_spot": F.lag("spot").over(w), "_strikes": F.lag("strikes").over(w), "unread_since": F.col("idx") - F.lag("idx").over(w) - 1})
    r = F.col("_spot") / F.col("spot")
    up = F.round(r)
    ratio = F.when((r >= step) & (F.abs(r - up) <= within * up), up).when((r <= 1 / step) & (F.abs(1 / r - F.round(1 / r)) <= within * F.round(1 / r)), 1 / F.round(1 / r))
    moved = F.array_distinct(F.transform("_strikes", lambda x: F.bround(x / F.col("ratio"), 3)))
    today = F.transform("strikes", lambda x: F.bround(x, 3))
    out = s.where("_spot is not null").withColumn("ratio", ratio).where("ratio is not null")
    share = F.try_divide(F.size(F.array_intersect(moved, today)), F.size("_strikes"))  # without strikes yesterday nothing confirms
    return out.select(key, "day", "ratio", "unread_since", share.alias("confirmed"), F.coalesce(share >= trip, F.lit(False)).alias("trips"))


def split_consistent(units_ratio: Column, note_ratio: Column) -> Column:
    """Deliverable units and note name the same ratio within 1e-9; an unusable note disagrees."""
    return F.coalesce(F.abs(units_ratio - note_ratio) <= 1e-9 * F.abs(units_ratio), F.lit(False))


def scalar_adjustment(prior: str, new: str) -> Column:
    """No cash, one entry each, the same security and multiplier; nulls refuse."""
    p, n = (lambda f: F.col(f"{prior}.{f}")), (lambda f: F.col(f"{new}.{f}"))
    ok = ~p("cash") & ~n("cash") & (p("entries") == 1) & (n("entries") == 1) & (p("symbol") == n("symbol")) & (p("multiplier") == n("multiplier"))
    return F.coalesce(ok, F.lit(False))


def detect_splits(sessions: DataFrame, roots: DataFrame, key: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """Split candidates from re-symboling, landed and held.

    roots: key, day, root, non_standard, units, multiplier, cash, entries, symbol, note_units - a session's evidence of one root.
    sessions: key, day, idx of all read sessions. A root that its key never had, on a session next to one that was read,
    with non-standard contracts, is a candidate; its ratio is new units over the prior standard root's.
    """
    w = Window.partitionBy(key).orderBy("day")
    s = sessions.select(key, "day", F.lag("day").over(w).alias("prior_day"), (F.col("idx") - F.lag("idx").over(w) - 1).alias("unread_since"))
    first = roots.withColumn("_first", F.min("day").over(Window.partitionBy(key, "root"))).where("day = _first and non_standard")
    info = lambda a: F.struct("units", "multiplier", "cash", "entries", "symbol", "note_units").alias(a)
    prior = roots.where("not non_standard").select(F.col(key).alias("_k"), F.col("day").alias("_d"), info("prior"))
    j = first.select(key, "day", "root", info("new")).join(s, [key, "day"]).where("prior_day is not null").join(prior, (F.col(key) == F.col("_k")) & (F.col("prior_day") == F.col("_d")), "left")
    ratio = F.col("new.units") / F.col("prior.units")
    held = F.when(F.col("unread_since") > 0, "sessions_unread").when(F.col("prior").isNull(), "no_prior").when(~scalar_adjustment("prior", "new"), "not_scalar").when(~split_consistent(ratio, F.col("new.note_units") / F.col("prior.note_units")), "note_disagrees")
    out = j.select(key, F.col("day").alias("ex_date"), "root", ratio.alias("split_ratio"), held.alias("held"))
    return out.where("held is null").drop("held"), out.where("held is not null")


def pairings(old: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Contracts matched across a re-symboling on the vendor's id; a boundary with any row unplaced is refused as a whole."""
    o = old.select(*keys, "ssid", F.col("symbol").alias("old_symbol"), "valid_from")
    j = o.join(new.select(*keys, "ssid", F.col("symbol").alias("new_symbol")), [*keys, "ssid"], "full_outer")
    bad = j.groupBy(*keys).agg(F.count_if(F.col("old_symbol").isNull() | F.col("new_symbol").isNull()).alias("unplaced")).where("unplaced > 0")
    return j.join(bad, keys, "left_anti").where("old_symbol <> new_symbol"), bad


def symbol_starts(rows: DataFrame, key: str = "ssid") -> DataFrame:
    """First session on which each key carried each spell of a symbol."""
    r = scans.changes(rows, [key], "day", "symbol", "_i")
    return r.groupBy(key, "_i", "symbol").agg(F.min("day").alias("valid_from"), F.max("day").alias("last_seen")).drop("_i")


def spellings(master: DataFrame, symbol: str) -> DataFrame:
    """Every spelling that the instruments of one spelling ever had."""
    ids = master.where(F.col("id_value") == symbol).select("instrument_id").distinct()
    return master.join(ids, "instrument_id", "left_semi").select("id_value").distinct()


def standing_marks(rows: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Each row with the mark of the boundaries after it (H6, W6): non-scalar beats indeterminate, else the earliest.

    A key's marks get what holds from each of them on; a row takes that of the first mark after it.
    """
    m = marks.groupBy(key, F.col("day").alias("_at")).agg(F.bool_or(F.col("mark") == "non_scalar").alias("_non"), F.min("mark").alias("_mark"))
    later = Window.partitionBy(key).orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, 0)
    m = m.select(key, "_at", F.bool_or("_non").over(later).alias("_non"), "_mark")
    found = next_event(rows, m, key, "day", "_at", ["_non", "_mark"])
    standing = found.select(key, "day", F.when(F.coalesce("_non", F.lit(False)), "non_scalar").otherwise(F.col("_mark")).alias("standing"))
    return rows.join(standing, [key, "day"], "left")


def dividend_consistent(freq: Column, pay: Column, annual: Column) -> Column:
    """Frequency times payment is the annual amount within 3e-6; zero only with zero."""
    return F.coalesce(F.when(freq <= 0, False).when(annual == 0, pay == 0).otherwise(F.abs(freq * pay - annual) <= 3e-6 * F.abs(annual)), F.lit(False))


def extract_dividends(quotes: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dividend candidates from closes of record: what to append, and what is held.

    quotes: instrument_id, day, ex_date, div_freq, div_pay_amount, div_amount. The first observation of a (instrument,
    ex_date, amount) counts; one identical to the ledger's latest adds nothing.
    """
    seen = quotes.where("ex_date is not null").groupBy("instrument_id", "ex_date", "div_freq", "div_pay_amount", "div_amount").agg(F.min("day").alias("observed_on"))
    ok = dividend_consistent(F.col("div_freq"), F.col("div_pay_amount"), F.col("div_amount"))
    last = seen.where(ok).groupBy("instrument_id", "ex_date").agg(F.max_by(F.struct("div_pay_amount", "observed_on"), "observed_on").alias("_c"))
    now = current.select(F.col("instrument_id").alias("_i"), F.col("ex_date").alias("_x"), F.col("cash_amount").alias("_a"))
    j = last.join(now, (F.col("instrument_id") == F.col("_i")) & (F.col("ex_date") == F.col("_x")), "left").where(~F.col("_c.div_pay_amount").eqNullSafe(F.col("_a")))
    return j.select("instrument_id", "ex_date", F.col("_c.div_pay_amount").alias("cash_amount"), F.col("_c.observed_on").alias("observed_on")), seen.where(~ok).select("instrument_id", "ex_date", "observed_on", F.lit("inconsistent").alias("check_name"))


def census(spans: DataFrame, calendar: DataFrame, landed: DataFrame, freqs: list[str], budget: int = 100) -> DataFrame:
    """What a backfill would ask for, newest first, minutes before days, up to the request budget."""
    owed = spans_of_sessions(spans, calendar).select("*", F.explode(F.array(*map(F.lit, freqs))).alias("freq"))
    return owed.join(landed, ["ticker", "day", "freq"], "left_anti").orderBy(F.desc("day"), "ticker", F.col("freq") != "1m", "freq").limit(budget)
