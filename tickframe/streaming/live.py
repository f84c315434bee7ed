"""Structured Streaming operators (ST1-ST8). State is keyed by ticker or (surface, column), never by time alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def live_slots(rows: DataFrame, keys: list[str], minutes: int = 1, grace: str = "2 minutes") -> DataFrame:
    """Slot aggregates of a stream (ST1); a slot is final once the watermark has passed it by the grace."""
    kind = F.col("row_kind")
    w = rows.withWatermark("snap_ts", grace).groupBy(F.window("snap_ts", f"{minutes} minutes"), *keys)
    g = w.agg(F.count_if(kind == "data").alias("data_rows"), F.count_if(kind == "gap").alias("gap_rows"), F.bool_or(F.coalesce("suspect", F.lit(False))).alias("suspect"))
    return g.select(F.col("window.start").alias("slot"), *keys, "data_rows", "gap_rows", "suspect")


def watchdog(rows: DataFrame, key: str = "ticker", threshold: int = 3, order: tuple[str, ...] = ("snap_ts",)) -> DataFrame:
    """One page when a key has failed so often in a row, one when it recovers (ST2). rows: key, snap_ts, row_kind.

    The counter is the state; a batch's rows of a key are put in order first, by their instants and what else ``order`` names. A key's rows of one
    batch are held in memory, so the source bounds a batch.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (held,) = state.get if state.exists else (0,)
        f = pd.concat(list(frames)).sort_values(list(order), kind="stable")
        good = (f.row_kind == "data").to_numpy()
        block = good.cumsum()  # failures after each good row; those before the first go on from the state
        n = pd.Series(~good).groupby(block).cumsum().to_numpy() + (block == 0) * held
        before = np.concatenate(([held], n[:-1]))
        failing, recovered = ~good & (n == threshold), good & (before >= threshold)
        at = failing | recovered
        state.update((int(n[-1]),))
        yield pd.DataFrame({key: k[0], "at": f.snap_ts.to_numpy()[at], "event": np.where(failing, "failing", "recovered")[at], "failures": np.where(failing, n, before)[at].astype(np.int32)})

    return rows.groupBy(key).applyInPandasWithState(step, f"{key} string, at timestamp, event string, failures int", "n int", "append", GroupStateTimeout.NoTimeout)


def drift_pages(rows: DataFrame, order: tuple[str, ...] = ("snap_ts",)) -> DataFrame:
    """A page when a (surface, column) begins to drift; it may page again only after every ticker that drifted has landed clean (ST5, Q8).

    rows: surface, column, ticker, snap_ts, drifts (null: a gap row, which proves nothing). Order and batches are as in ``watchdog``.
    """

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = set(state.get[0]) if state.exists else set()
        f = pd.concat(list(frames)).dropna(subset=["drifts"]).sort_values(list(order), kind="stable")
        drifts = f.drifts.astype(bool)
        was = drifts.groupby(f.ticker).shift().astype("boolean").fillna(f.ticker.isin(held).astype("boolean")).astype(bool)
        change = (drifts & ~was).astype(int) - (~drifts & was).astype(int)  # a ticker begins or ends to drift
        page = (change == 1) & (change.cumsum() + len(held) == 1)
        last = drifts.groupby(f.ticker).last()
        state.update((sorted((held - set(last.index)) | set(last.index[last])),))
        out = f[page]
        yield pd.DataFrame({"surface": k[0], "column": k[1], "ticker": out.ticker, "at": out.snap_ts})

    return rows.groupBy("surface", "column").applyInPandasWithState(step, "surface string, column string, ticker string, at timestamp", "held array<string>", "append", GroupStateTimeout.NoTimeout)


def freshness(pings: DataFrame, grace_minutes: int = 10) -> DataFrame:
    """Keys whose last ping lies more than the grace before the last minute one was owed (ST7). pings: key, owed_at, ping_at (null: none)."""
    g = pings.groupBy("key").agg(F.max("owed_at").alias("owed"), F.max("ping_at").alias("ping"))
    late = F.unix_timestamp("owed") - F.unix_timestamp("ping") > 60 * grace_minutes
    return g.select("key", "owed", "ping", F.when(F.col("owed").isNull(), False).when(F.col("ping").isNull(), True).otherwise(late).alias("starved"))


def land_once(batch: DataFrame, target: str, manifest: str, key: str = "segment") -> None:
    """A foreachBatch sink that lands a segment once however often it comes (ST6).

    A segment comes as a whole. It is written to a folder of its own, over whatever a broken try left there, and counts as
    landed once the manifest has it: what is in the manifest is left out, what is only in the folder is written again.
    Equal rows of a segment all stay.
    """
    from pyspark.errors import AnalysisException

    spark = batch.sparkSession
    try:
        new = batch.join(spark.read.parquet(manifest).select(key), key, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        new = batch
    new = new.persist()
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(target)
    new.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(manifest)
    new.unpersist()


def landed(spark, target: str, manifest: str, key: str = "segment") -> DataFrame:
    """The rows of the segments that the manifest has; a folder without an entry is a broken try."""
    return spark.read.parquet(target).join(spark.read.parquet(manifest).select(key).distinct(), key, "left_semi")


def split_late(batch: DataFrame, sealed_through: str, day: str = "day") -> tuple[DataFrame, DataFrame]:
    """Rows of open days, and those of days already sealed, which go to quarantine and never vanish (ST8)."""
    limit = F.lit(sealed_through).cast("date")
    return batch.where(F.col(day) > limit), batch.where(F.col(day) <= limit)


def close_guard(rows: DataFrame, calendar: DataFrame, minutes: int = 5) -> tuple[DataFrame, DataFrame]:
    """Close rows that came in time, and those past the guard, which are refused (ST4). rows: day, close_tag, fetched_at."""
    j = rows.where("close_tag is not null").join(calendar.select("day", "close_at"), "day")
    ok = F.col("fetched_at") <= F.col("close_at") + F.make_dt_interval(mins=F.lit(minutes))
    return j.where(ok).drop("close_at"), j.where(~ok).drop("close_at")


def missed_minutes(batch: DataFrame, owed: DataFrame, through: str) -> DataFrame:
    """Gap rows for owed slots up to a watermark that the rows so far don't have (ST3), for foreachBatch over all rows landed."""
    due = owed.where(F.col("slot") <= F.lit(through).cast("timestamp"))
    return due.join(batch.select("ticker", "slot").distinct(), ["ticker", "slot"], "left_anti").withColumn("row_kind", F.lit("gap"))


def fold_pages(pages: DataFrame, roster: DataFrame, minutes: int = 1, key: str = "ticker") -> DataFrame:
    """Pages of one cause in one stretch of time as one page (ST2): scope is `all` when every key of the roster has it.

    pages: key, at, cause. On a stream it is the second grouping, under a watermark on at.
    """
    n = roster.select(key).distinct().agg(F.count(F.lit(1)).alias("_n"))
    g = pages.groupBy(F.window("at", f"{minutes} minutes").alias("w"), "cause").agg(F.array_sort(F.collect_set(key)).alias("keys"))
    return g.join(F.broadcast(n)).select(F.col("w.start").alias("at"), "cause", "keys", F.when(F.size("keys") == F.col("_n"), "all").otherwise("some").alias("scope"))
