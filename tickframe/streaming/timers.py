"""Streams that speak up when nothing comes (ST3, ST4, ST7): keyed state with event-time timers.

What is owed comes in the same stream as what arrives, as control rows, so a key that sends nothing has state and a timer
too. Time is the watermark of the whole stream: any key's rows, or a clock's, make every key's timers due. State lives in
the checkpoint; a stream that stops and goes on from there gives what it would have given without the stop.

The session needs the RocksDB state store (``stateful``). Event time is when a row arrives, which does not run backwards;
a row behind the watermark is one that the source held back longer than ``delay``, and Spark leaves it out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

NEVER = np.iinfo(np.int64).max


def stateful(spark: SparkSession) -> SparkSession:
    """A session of its own on the same cluster, with the state store that timers need; the caller's settings stay as they are."""
    out = spark.newSession()
    for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        out.conf.set(k, spark.conf.get(k))
    out.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return out


def millis(x: pd.Series) -> np.ndarray:
    return x.to_numpy().astype("datetime64[ms]").astype(np.int64)


def stamps(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.int64).astype("datetime64[ms]").astype("datetime64[ns]")


class Timed(StatefulProcessor):
    """One state value, and one timer that stands where the state says."""

    state = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.state)

    def keep(self, value: tuple | None, due: int | None) -> None:
        """The new state, and the only timer left."""
        there = list(self.handle.listTimers())
        for x in there:
            if x != due:
                self.handle.deleteTimer(x)
        if due is not None and due not in there:
            self.handle.registerTimer(due)
        if value is None:
            self.held.clear()
        else:
            self.held.update(value)

    def close(self) -> None:
        pass


class Missed(Timed):
    """State of a key: the next slot that is not settled, the last one, and which later ones have come."""

    state = "next long, last long, seen array<long>"

    def __init__(self, keys: list[str], minutes: int, grace_ms: int):
        self.keys, self.step, self.grace = keys, minutes * 60_000, grace_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        at, last, seen = self.held.get() if self.held.exists() else (NEVER, -1, [])
        for f in rows:
            slot, owed = millis(f.slot), (f.kind == "owed").to_numpy()
            if owed.any():
                at, last = min(at, int(slot[owed].min())), max(last, int(millis(f.until)[owed].max()))
            seen = np.union1d(seen, slot[(f.kind == "row").to_numpy()]).astype(np.int64)
        seen = [int(x) for x in seen if x >= at or at == NEVER]
        self.keep((at, last, seen), at + self.step + self.grace if at <= last else None)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, last, seen = self.held.get()
        due = np.arange(at, min(last, timerValues.getCurrentWatermarkInMs() - self.step - self.grace) + 1, self.step)
        gaps = np.setdiff1d(due, seen)
        at = int(due[-1]) + self.step if len(due) else at
        if at > last:
            self.keep(None, None)
        else:
            self.keep((at, last, [int(x) for x in seen if x >= at]), at + self.step + self.grace)
        if len(gaps):
            yield pd.DataFrame({**{k: [v] * len(gaps) for k, v in zip(self.keys, key, strict=True)}, "slot": stamps(gaps), "row_kind": "gap"})


def missed_slots(rows: DataFrame, minutes: int = 1, grace: str = "2 minutes", delay: str = "1 minute") -> DataFrame:
    """Gap rows (ticker, day, slot, row_kind) for slots that nothing came for, given once a slot's end and the grace have passed (ST3).

    rows: ticker, day, at (arrival), kind, slot, until. ``owed`` rows announce a ticker's slots of a day from ``slot`` to
    ``until``, both included; ``row`` rows are captures; other kinds only move time on. A row that comes after its gap changes
    nothing. A day's state goes when its last slot is settled.
    """
    grace_ms = int(pd.Timedelta(grace).total_seconds() * 1000)
    kinds = {k: rows.schema[k].dataType.simpleString() for k in ("ticker", "day")}
    keyed = rows.withWatermark("at", delay).groupBy("ticker", "day")
    return keyed.transformWithStateInPandas(Missed(["ticker", "day"], minutes, grace_ms), f"ticker {kinds['ticker']}, day {kinds['day']}, slot timestamp, row_kind string", "append", "eventTime")


class Closes(Timed):
    """State of a ticker's day: the close of each tag that is owed, the tags that have come in time, and those that are settled."""

    state = "tags array<string>, closes array<long>, landed array<string>, settled array<string>"

    def __init__(self, guard_ms: int):
        self.guard = guard_ms

    def put(self, owed: dict[str, int], landed: set[str], settled: set[str]) -> None:
        due = min((c + self.guard for t, c in owed.items() if t not in settled), default=None)
        self.keep((list(owed), [int(x) for x in owed.values()], sorted(landed), sorted(settled)), due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tags, closes, landed, settled = self.held.get() if self.held.exists() else ([], [], [], [])
        owed, landed, waiting = dict(zip(tags, closes, strict=True)), set(landed), []
        for f in rows:
            new = f[f.kind == "owed"]
            owed |= {t: int(c) for t, c in zip(new.close_tag, millis(new.close_at), strict=True)}
            waiting.append(f[f.kind == "row"])
        f = pd.concat(waiting)
        if len(f):
            limit = f.close_tag.map(owed).astype("Int64")  # null: not owed, so nothing to be late for
            late = (pd.Series(millis(f["at"]), f.index) > limit + self.guard).fillna(False).to_numpy(bool)
            landed |= set(f.close_tag[~late])
            yield pd.DataFrame({"ticker": key[0], "day": key[1], "close_tag": f.close_tag, "row_id": f.row_id, "at": f["at"], "outcome": np.where(limit.isna(), "not_owed", np.where(late, "refused", "accepted"))})
        self.put(owed, landed, set(settled))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tags, closes, landed, settled = self.held.get()
        now = timerValues.getCurrentWatermarkInMs()
        due = {t: c + self.guard for t, c in zip(tags, closes, strict=True) if c + self.guard <= now and t not in settled}
        self.put(dict(zip(tags, closes, strict=True)), set(landed), {*settled, *due})
        gone = [t for t in due if t not in landed]
        if gone:
            yield pd.DataFrame({"ticker": key[0], "day": key[1], "close_tag": gone, "row_id": pd.array([None] * len(gone), "Int64"), "at": stamps([due[t] for t in gone]), "outcome": "missing"})


def guarded_closes(rows: DataFrame, minutes: int = 5, delay: str = "1 minute") -> DataFrame:
    """(ticker, day, close_tag, row_id, at, outcome): a close row is accepted up to its close and the guard and refused after it; a
    close that is owed and has no accepted row then is missing (ST4).

    rows: ticker, day, at (arrival), kind, close_tag, close_at, row_id. ``owed`` rows announce a close before it comes, ``row``
    rows are captured closes, other kinds only move time on. What a ticker does not owe is told as such. ``split_closes`` parts the results.
    """
    kinds = {k: rows.schema[k].dataType.simpleString() for k in ("ticker", "day")}
    keyed = rows.withWatermark("at", delay).groupBy("ticker", "day")
    return keyed.transformWithStateInPandas(Closes(minutes * 60_000), f"ticker {kinds['ticker']}, day {kinds['day']}, close_tag string, row_id long, at timestamp, outcome string", "append", "eventTime")


def split_closes(batch: DataFrame, accepted: str, refused: str) -> None:
    """For foreachBatch: accepted and missing closes to one table, refused ones and those not owed to another."""
    bad = F.col("outcome").isin("refused", "not_owed")
    batch.where(~bad).write.mode("append").parquet(accepted)
    batch.where(bad).write.mode("append").parquet(refused)


class Freshness(Timed):
    """State of a key: when it was last fresh (-1: nothing is owed), and whether it has been called starved since."""

    state = "fresh long, starved boolean"

    def __init__(self, grace_ms: int):
        self.grace = grace_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh, starved = self.held.get() if self.held.exists() else (-1, False)
        f = pd.concat(list(rows))
        f = f[f.kind.isin(["open", "ping", "close"])]
        order = {"open": 0, "ping": 1, "close": 2}
        f = f.assign(ms=millis(f["at"]), rank=f.kind.map(order)).sort_values(["ms", "rank"], kind="stable")
        at, kind = f.ms.to_numpy(), f.kind.to_numpy(str)
        before = np.where(np.append(["x"], kind[:-1]) == "close", -1, np.append([0], at[:-1]))  # when it was last fresh
        if len(at):
            before[0] = fresh
        gap = (before >= 0) & (at - before > self.grace)
        first = np.arange(len(at)) == 0
        called = gap & ~(first & starved)  # else its timer has told already
        back = gap & (kind == "ping")
        if len(at):
            fresh, starved = (-1 if kind[-1] == "close" else int(at[-1])), False
        self.keep((fresh, bool(starved)), fresh + self.grace + 1 if fresh >= 0 and not starved else None)
        if gap.any():
            told = pd.DataFrame({"at": np.concatenate([before[called] + self.grace, at[back]]), "event": ["starved"] * int(called.sum()) + ["recovered"] * int(back.sum())}).sort_values("at", kind="stable")
            yield pd.DataFrame({"key": key[0], "at": stamps(told["at"].to_numpy()), "event": told.event.to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fresh, _ = self.held.get()
        self.keep((fresh, True), None)
        yield pd.DataFrame({"key": key[0], "at": stamps([fresh + self.grace]), "event": ["starved"]})


def dead_man(rows: DataFrame, grace: str = "10 minutes", delay: str = "1 minute") -> DataFrame:
    """(key, at, event): ``starved`` once a key that owes pings has sent none for longer than the grace, at the moment that it ran
    out, and ``recovered`` with the next ping, which arms it again (ST7).

    rows: key, at, kind. ``open`` and ``close`` rows say from when to when a key owes pings, ``ping`` rows are pings (one after a
    close opens again), other kinds only move time on. At one instant, open comes before ping and close.
    """
    grace_ms = int(pd.Timedelta(grace).total_seconds() * 1000)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.withWatermark("at", delay).groupBy("key").transformWithStateInPandas(Freshness(grace_ms), f"key {kind}, at timestamp, event string", "append", "eventTime")
