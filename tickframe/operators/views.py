"""The reading surface (A23, B5, B8, H6, H7, H9, Q12, S1, U1-U3): doors over a snapshot store, contract views, named queries.

Every door returns a lazy frame; what a read would refuse comes as a companion frame of violations, or raises if strict.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.operators import bars as B
from tickframe.operators import ledger as L
from tickframe.operators import market as M
from tickframe.operators import snapshots as S


def in_order(rows: DataFrame, stamp: str, keys: list[str], ties: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their place by instant within a key (S1), and the rows whose stamp can't be read.

    Rows of one instant stand by ties, which must tell them apart; without any, by the text of their stamp.
    """
    from pyspark.sql import Window

    at = rows.withColumn("_at", S.instant(F.col(stamp)))
    good = at.where("_at is not null").withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy("_at", *(ties or [F.col(stamp)]))))
    return good.drop("_at"), at.where("_at is null").drop("_at")


def contract_life(rows: DataFrame, master: DataFrame, symbol: str, start: str | None = None, end: str | None = None, day: str = "day") -> DataFrame:
    """All rows of the instruments behind a symbol, under every spelling they ever had."""
    return S.between_days(rows, start, end, day).join(M.spellings(master, symbol), F.col("symbol") == F.col("id_value"), "left_semi")


def continuity(observed: DataFrame, sessions: DataFrame, closes: DataFrame, splits: DataFrame, marks: DataFrame, key: str = "instrument_id") -> DataFrame:
    """One scale for a contract across its symbols (H6).

    observed: key, day, strike, mark, multiplier. sessions: key, day of the whole span, so a session without a close of
    record is a row. closes: key, day, close. splits: key, ex_date, split_ratio. marks: key, day, mark of boundaries that
    no scalar explains. Checks run from the session to the boundaries after it; only settled rows are scaled.
    """
    ratio = B.factors(sessions.select(key, "day"), splits, "split_ratio", key, "day").withColumnRenamed("factor", "_ratio")
    j = sessions.select(key, "day").join(observed.withColumn("_seen", F.lit(True)), [key, "day"], "left")
    j = j.join(closes.select(key, "day", B.number(F.col("close")).alias("underlying_close")), [key, "day"], "left").join(ratio, [key, "day"], "left")
    j = M.standing_marks(j, marks, key)
    by = F.coalesce("_ratio", F.lit(1.0))
    terms = B.number(F.col("strike")).isNotNull() & B.number(F.col("mark")).isNotNull() & B.number(F.col("multiplier")).isNotNull()
    reason = (
        F.when(F.col("_seen").isNull(), "no_close_of_record")
        .when(~terms, "terms_unreadable")
        .when(F.col("underlying_close").isNull(), "close_unreadable")
        .when(F.col("standing") == "non_scalar", "deliverable_not_scalar")
        .when(F.col("standing").isNotNull(), "boundary_unreadable")
    )
    ok = reason.isNull()
    verdict = F.when(ok, "settled").when(reason == "boundary_unreadable", "indeterminate").otherwise("absent")
    return j.select(key, "day", "strike", "mark", "underlying_close", verdict.alias("verdict"), reason.alias("reason"), F.when(ok, by).alias("split_ratio"), F.when(ok, F.col("strike") / by).alias("adjusted_strike"), F.when(ok, F.col("underlying_close") / by).alias("adjusted_close"))


def resumed(state: DataFrame, sessions: DataFrame, cutoff: str, key: str = "ticker") -> DataFrame:
    """Sessions after a cutoff with each key's checkpointed last session before them, so a walk goes on where it ended (H9)."""
    after = sessions.where(F.col("day") > F.lit(cutoff).cast("date"))
    return after.unionByName(state.select(*after.columns))


def findings(frames: list[DataFrame]) -> DataFrame:
    """Held candidates of all walks, each once (Q12): symbol, observed_on, event, check_name, computed, against."""
    columns = ["symbol", "observed_on", "event", "check_name", "computed", "against"]
    out = None
    for f in frames:
        f = f.select(*(F.col(c).cast("string").alias(c) if c in f.columns else F.lit(None).cast("string").alias(c) for c in columns))
        out = f if out is None else out.unionByName(f)
    return out.dropDuplicates(columns)


def with_provenance(rows: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars with origin, basis and source of the file they came from (A23), and files whose provenance is malformed.

    rows must carry `file` (from _metadata.file_path); files: file, origin, basis, source, source_as_of.
    """
    ok = F.coalesce(F.col("origin").isin("captured", "imported") & ((F.col("origin") == "captured") | F.col("source").isNotNull()), F.lit(False))
    return rows.join(files.where(ok), "file", "left"), files.where(~ok)


@dataclass(frozen=True)
class Store:
    """Frames of one store. Doors below take what they need from it."""

    chains: DataFrame | None = None
    quotes: DataFrame | None = None
    bars: DataFrame | None = None
    actions: DataFrame | None = None
    master: DataFrame | None = None
    calendar: DataFrame | None = None
    withheld: DataFrame | None = None
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def _clear(self, rows: DataFrame, include_quarantined: bool) -> DataFrame:
        return rows if include_quarantined or self.withheld is None else L.clear_of_quarantine(rows, self.withheld)


def load_snapshot(store: Store, surface: str, ticker: str, day: str, minute: str | None = None, include_quarantined: bool = False) -> DataFrame:
    """A ticker's rows of a wall minute, or of the close of record."""
    rows = store._clear(getattr(store, surface), include_quarantined).where((F.col("ticker") == ticker) & (F.col("day") == F.lit(day).cast("date")))
    if minute is None:
        rows, _ = S.closes_of_record(rows, "option_close" if surface == "chains" else "spot_close", ["ticker", "day"])
    else:
        rows = S.at_minute(rows, day, minute)
    return S.data_rows(rows)[0]


def load_bars(store: Store, start: str | None = None, end: str | None = None, adjust: str | None = None, as_of: str | None = None, include_quarantined: bool = False) -> DataFrame:
    """Bars of a range, raw, split-adjusted or total-return, by the ledger as it was known on a day."""
    if adjust not in (None, "split", "total"):
        raise ValueError(f"no such view: {adjust}")
    bars = store._clear(store.bars, include_quarantined)
    if adjust is None:
        return S.between_days(bars, start, end, "session")
    keys = ["instrument_id", "ex_date", "type"]
    led = L.as_of(store.actions, keys, as_of) if as_of else L.latest(store.actions, keys)
    splits, dividends = led.where("type = 'split'"), led.where("type = 'dividend'")
    out = B.split_adjusted(bars, splits) if adjust == "split" else B.total_return(bars, splits, dividends)
    return S.between_days(out, start, end, "session")


def list_cycles(store: Store, ticker: str, day: str) -> DataFrame:
    """Wall minutes with data."""
    return S.cycles(store.chains.where((F.col("ticker") == ticker) & (F.col("day") == F.lit(day).cast("date"))))


@dataclass(frozen=True)
class NamedQuery:
    """A fixed query with checked parameters; values are bound, never spliced."""

    sql: str
    parameters: dict[str, Callable[[str], Column | str]]

    def run(self, spark: SparkSession, frames: dict[str, DataFrame], **given: str) -> DataFrame:
        if set(given) != set(self.parameters):
            raise ValueError(f"parameters are {sorted(self.parameters)}")
        return spark.sql(self.sql, args={k: self.parameters[k](v) for k, v in given.items()}, **frames)


def ticker_parameter(value: str) -> str:
    if not re.fullmatch(r"[A-Za-z.^$]{1,12}", value):
        raise ValueError("not a ticker")
    return value


def day_parameter(value: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
        raise ValueError("not a day")
    return value


NAMED: dict[str, NamedQuery] = {
    "today": NamedQuery(
        "SELECT slot, count_if(row_kind = 'data') AS data_rows, count_if(row_kind = 'gap') AS gap_rows FROM {slots} WHERE ticker = :ticker AND day = to_date(:day) GROUP BY slot",
        {"ticker": ticker_parameter, "day": day_parameter},
    ),
    "history": NamedQuery("SELECT ticker, day, count_if(row_kind = 'data') AS data_rows, count_if(row_kind = 'gap') AS gap_rows FROM {slots} GROUP BY ticker, day", {}),
    "now": NamedQuery("SELECT ticker, max(slot) AS newest FROM {slots} WHERE row_kind = 'data' GROUP BY ticker", {}),
    "lake": NamedQuery("SELECT day, count(*) AS files, sum(length) AS bytes FROM {files} GROUP BY day", {}),
    "cost": NamedQuery("SELECT day, product, sum(cents) AS cents FROM {costs} GROUP BY day, product", {}),
}
