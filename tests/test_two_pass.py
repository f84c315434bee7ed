"""Two-pass reads: the same rows as a plain filter, for a share of the bytes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickframe.sources import two_pass

COLUMNS = "snap_ts timestamp, close_tag string, wide string, n long, ticker string, day date"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Six days of three tickers, a cycle a minute for ten hours, forty rows a cycle; wide does not compress."""
    path = f"{tmp_path_factory.mktemp('two-pass')}/t"
    n = spark.range(6 * 3 * 600 * 40).withColumnRenamed("id", "n")
    minute, key = F.expr("n div 40 % 600"), F.expr("n div 24000")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.expr("cast(n div 24000 % 6 as int)"))
    at = F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + 36_000 + minute * 60)
    tag = F.when(minute == F.when(key % 6 == 5, 200).otherwise(590), "spot_close").when((minute == 595) & (key % 3 > 0), "option_close")
    rows = n.select(at.alias("snap_ts"), tag.alias("close_tag"), F.concat(*(F.sha2(F.concat_ws("-", "n", F.lit(i)), 256) for i in range(4))).alias("wide"), "n", F.concat(F.lit("T"), F.expr("n div 144000")).alias("ticker"), day.alias("day"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.hadoop.vectored.io.enabled", "false")  # reads of other threads are not counted
    conf.set("io.file.buffer.size", "4096")  # a narrow column of a small group is some hundred bytes
    conf.set("fs.file.impl.disable.cache", "true")
    two_pass.write_sorted(rows.repartition(4), path, group_bytes=256 << 10)
    schema = spark.createDataFrame([], COLUMNS).schema
    yield two_pass.read(spark, path, schema)
    for k in ("parquet.hadoop.vectored.io.enabled", "io.file.buffer.size", "fs.file.impl.disable.cache"):
        conf.unset(k)


def cost(spark, read):
    """Rows of what read() gives, and the bytes that all its tasks took in."""
    sc = spark.sparkContext

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        of = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return {of.apply(i).stageId(): of.apply(i).inputBytes() for i in range(of.size())}

    before = stages()
    rows = read().collect()
    return rows, sum(v for k, v in stages().items() if k not in before)


def test_closes_read_what_they_answer(spark, table):
    want = sorted(r.n for r in table.where("close_tag = 'spot_close'").collect())
    whole, all_bytes = cost(spark, lambda: table.select("n", "wide"))
    got, narrow_bytes = cost(spark, lambda: two_pass.closes_of_record(table, "spot_close")[0])
    _, bad = two_pass.closes_of_record(table, "spot_close")
    assert sorted(r.n for r in got) == want and len(want) == 18 * 40 and bad.count() == 0
    assert all(len(r.wide) == 256 for r in got)
    assert narrow_bytes < all_bytes / 5, (narrow_bytes, all_bytes)  # two of 27 row groups of each file, and what stands at their edges


def test_keys_without_a_single_close_are_told(spark, table):
    rows, bad = two_pass.closes_of_record(table, "option_close")
    none = sorted((r.ticker, r.day) for r in bad.where("instants = 0").collect())
    assert len(none) == 6 and rows.count() == 12 * 40
    assert not {(r.ticker, r.day) for r in rows.select("ticker", "day").distinct().collect()} & set(none)


@pytest.mark.parametrize("minute", [599, 600, 777, 1439])
def test_newest_cycle_before_a_minute(spark, table, minute):
    got, read = cost(spark, lambda: two_pass.cycles_before(table, minute).select("n", "wide", "snap_ts"))
    assert len(got) == (18 * 40 if minute >= 600 else 0)
    assert {r.snap_ts.hour * 60 + r.snap_ts.minute for r in got} <= {min(minute, 1199)}
    assert read < cost(spark, lambda: table.select("n", "wide"))[1] / 5


def test_null_and_repeated_instants(spark, tmp_path):
    d, at = dt.date(2024, 1, 1), lambda m: dt.datetime(2024, 1, 1, 16, m)
    rows = [(at(0), "spot_close", "a", 1, "A", d), (at(0), "spot_close", "a", 1, "A", d), (None, "spot_close", "b", 2, "B", d), (at(1), "spot_close", "b", 3, "B", d), (at(1), "spot_close", "c", 4, "C", d), (at(2), "spot_close", "c", 5, "C", d), (at(2), None, "e", 6, "E", d)]
    frame = spark.createDataFrame(rows, COLUMNS)
    two_pass.write_sorted(frame, str(tmp_path / "t"))
    got, bad = two_pass.closes_of_record(two_pass.read(spark, str(tmp_path / "t"), frame.schema), "spot_close")
    assert [r.n for r in got.collect()] == [1, 1]
    assert sorted((r.ticker, r.instants, r.unreadable) for r in bad.collect()) == [("B", 1, 1), ("C", 2, 0), ("E", 0, 0)]


def test_runs_of_minutes():
    assert two_pass.runs_of([5, 1, 2, 9], 8) == [(1, 2), (5, 5), (9, 9)]
    for most in (1, 2, 3, 5):
        minutes = random.Random(most).sample(range(1440), 40)
        runs = two_pass.runs_of(minutes, most)
        assert len(runs) <= most and all(any(a <= m <= b for a, b in runs) for m in minutes)
    assert two_pass.runs_of([], 3) == []
