"""Streams with timers on hand-made rows: silent keys, late rows, ties, and stops in the middle."""

import datetime as dt

import pytest

from tickframe.plans.timed import in_lots
from tickframe.streaming import timers

DAY = dt.date(2024, 3, 4)


def at(minute, second=0):
    return dt.datetime(2024, 3, 4, 9, 30) + dt.timedelta(minutes=minute, seconds=second)


@pytest.mark.parametrize("lots", [1, 3])
def test_a_silent_ticker_gets_its_gaps(spark, lots):
    rows = [(t, DAY, at(-30), "owed", at(0), at(5)) for t in ("A", "SILENT")]
    rows += [("A", DAY, at(m, 5), "row", at(m), None) for m in (0, 1, 3, 5)]
    rows += [("A", DAY, at(119), "row", at(2), None)]  # comes after its gap was told
    rows += [("CLOCK", DAY, at(m), "clock", None, None) for m in (15, 120)]
    frame = spark.createDataFrame(rows, "ticker string, day date, at timestamp, kind string, slot timestamp, until timestamp")
    got = sorted((r.ticker, (r.slot - at(0)).seconds // 60, r.row_kind) for r in in_lots(frame, timers.missed_slots, lots).collect())
    late = [("A", 2, "gap")] if lots > 1 else []  # in one batch, the late row is there before its timer
    assert got == [*late, ("A", 4, "gap"), *(("SILENT", m, "gap") for m in range(6))]


@pytest.mark.parametrize("lots", [1, 3])
def test_closes_by_their_guard(spark, lots):
    rows = [(t, DAY, at(0), "owed", tag, at(390 + m), None) for t in ("A", "B") for tag, m in (("spot_close", 0), ("option_close", 15))]
    rows += [("A", DAY, at(395), "row", "spot_close", None, 1), ("A", DAY, at(420, 1), "row", "option_close", None, 2), ("B", DAY, at(391), "row", "other", None, 3)]
    rows += [("CLOCK", DAY, at(500), "clock", None, None, None)]
    frame = spark.createDataFrame(rows, "ticker string, day date, at timestamp, kind string, close_tag string, close_at timestamp, row_id long")
    got = sorted((r.ticker, r.close_tag, r.outcome) for r in in_lots(frame, timers.guarded_closes, lots).collect())
    assert got == [("A", "option_close", "missing"), ("A", "option_close", "refused"), ("A", "spot_close", "accepted"), ("B", "option_close", "missing"), ("B", "other", "not_owed"), ("B", "spot_close", "missing")]


def test_refused_closes_have_a_table_of_their_own(spark, tmp_path):
    rows = spark.createDataFrame([("A", "accepted"), ("A", "missing"), ("B", "refused"), ("B", "not_owed")], "ticker string, outcome string")
    timers.split_closes(rows, f"{tmp_path}/good", f"{tmp_path}/bad")
    assert {r.outcome for r in spark.read.parquet(f"{tmp_path}/good").collect()} == {"accepted", "missing"}
    assert {r.outcome for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {"refused", "not_owed"}


@pytest.mark.parametrize("lots", [1, 4])
def test_starved_and_recovered(spark, lots):
    rows = [(k, at(0), "open") for k in ("A", "B", "C")] + [("A", at(m), "ping") for m in (5, 15, 30, 41)] + [("B", at(10), "ping"), ("C", at(4), "close"), ("A", at(45), "close"), ("CLOCK", at(90), "clock")]
    frame = spark.createDataFrame(rows, "key string, at timestamp, kind string")
    got = sorted((r.key, (r["at"] - at(0)).seconds // 60, r.event) for r in in_lots(frame, timers.dead_man, lots).collect())
    assert got == [("A", 25, "starved"), ("A", 30, "recovered"), ("A", 40, "starved"), ("A", 41, "recovered"), ("B", 20, "starved")]


def test_the_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    timers.stateful(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
