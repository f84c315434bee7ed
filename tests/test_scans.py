"""Scans in blocks and quantiles by histograms, against plain Python, with hot keys, nulls, ties and empty tables."""

import datetime as dt
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe.operators import market, quantiles, scans, snapshots


def test_runs_of_failures_over_blocks(spark):
    rng = random.Random(4)
    rows = [(k, i, rng.choice(["data", "gap", "gap", None]) if k != "DARK" else "gap") for k in ("HOT", "B", None, "DARK") for i in (range(300) if k == "HOT" else range(0, 300, 7))]
    frame = spark.createDataFrame(rows, "ticker string, n long, row_kind string")
    want, held = set(), {}
    for k, i, kind in rows:
        held[k] = 0 if kind == "data" else held.get(k, 0) + 1
        want.add((k, i, held[k]))
    for size in (1, 9, 1000):
        got = scans.since_reset(frame, ["ticker"], "n", F.when(F.col("row_kind") == "data", 0).otherwise(1), F.col("row_kind") == "data", "failures", F.floor(F.col("n") / size))
        assert {(r.ticker, r.n, r.failures) for r in got.collect()} == want
    assert {(r.ticker, r.n) for r in snapshots.failures(frame, ["ticker"], "n", 2).where("pages").collect()} == {(k, i) for k, i, n in want if n == 2}
    assert snapshots.failures(frame.limit(0), ["ticker"], "n").count() == 0


def test_spells_over_years(spark):
    rng = random.Random(5)
    first = dt.date(2019, 11, 1)
    rows = [(k, first + dt.timedelta(days=9 * i), rng.choice(["A", "A", "A", "B", None])) for k in (1, 2) for i in range(120)]
    want, last = {}, {}
    for k, day, symbol in rows:
        n, was = last.get(k, (0, symbol))
        n += symbol is not None and was is not None and symbol != was
        last[k] = (n, symbol)
        a, _ = want.get((k, n, symbol), (day, day))
        want[(k, n, symbol)] = (a, day)
    got = market.symbol_starts(spark.createDataFrame(rows, "ssid long, day date, symbol string"))
    assert sorted(((r.ssid, r.symbol, r.valid_from, r.last_seen) for r in got.collect()), key=str) == sorted(((k, s, a, b) for (k, _, s), (a, b) in want.items()), key=str)


def quantile(values, p):
    x, at = sorted(values), p * (len(values) - 1)
    lo, hi = int(np.floor(at)), int(np.ceil(at))
    return x[lo] if lo == hi else (hi - at) * x[lo] + (at - lo) * x[hi]


@pytest.mark.parametrize("few,cuts", [(40, 8), (10_000, 64)])
def test_quantiles_of_any_size(spark, few, cuts):
    rng = random.Random(few)
    groups = {
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(400)],
        "ties": [float(rng.choice([1, 1, 1, 2, 3])) for _ in range(401)],
        "same": [7.0] * 300,
        "two": [1.0, 2.0],
        "one": [5.0],
        None: [rng.gauss(0, 1) for _ in range(333)],
        "ends": [float("inf"), -1.7976931348623157e308, 0.0, 1.0, 1.5],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("none", None), ("one", None), ("one", float("nan"))]
    rng.shuffle(rows)
    shares = [0.5, 0.98, 0.0, 1.0]
    got = {r.k: (r.n, r.q) for r in quantiles.exact(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", shares, few, cuts).collect()}
    assert got.pop("none") == (0, None)
    assert got == {k: (len(v), [quantile(v, p) for p in shares]) for k, v in groups.items()}


def test_a_hot_group_is_spread(spark):
    n = 1_000_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    (r,) = quantiles.exact(rows, ["k"], "v", [0.5, 0.99], few=5000).collect()
    assert r.n == n and r.q == [float(Fraction(n - 1, 2)), pytest.approx(0.99 * (n - 1), abs=1e-6)]


def test_many_rows_of_few_values_are_counted_not_searched(spark, monkeypatch):
    n = 100_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 500 - 3).alias("v"))
    monkeypatch.setattr(quantiles, "_large", lambda *_: pytest.fail("rounds over all rows"))
    (r,) = quantiles.exact(rows, ["k"], "v", [0.5, 0.99], few=5000).collect()
    values = [i * 7919 % 500 - 3 for i in range(n)]
    assert r.n == n and r.q == [quantile(values, p) for p in (0.5, 0.99)]


def test_evidence_of_large_groups_is_that_of_small_ones(spark):
    from tickframe.operators import lake, quality

    t0 = dt.datetime(2024, 1, 2, 9)
    rows = [(k, dt.date(2024, 1, 2), t0 + dt.timedelta(minutes=i), t0 + dt.timedelta(minutes=i, milliseconds=37 * i % 1000), None if i % 7 == 0 else t0 + dt.timedelta(minutes=i, milliseconds=37 * i % 1000 + i * i % 400), i % 3 == 0, float(i * 31 % 97)) for k in ("A", "B", None) for i in range(150 if k == "A" else 4)]
    frame = spark.createDataFrame(rows, "ticker string, day date, snap_ts timestamp, fetch_ts timestamp, fetch_end_ts timestamp, in_session boolean, staleness double").withColumn("is_delayed", F.lit(False))
    days = spark.createDataFrame([(dt.date(2024, 1, 2), t0, t0 + dt.timedelta(hours=3))], "day date, open_at timestamp, close_at timestamp")
    for f in (lambda few: lake.latency(frame, days, ["ticker"], few=few), lambda few: quality.entitlement(frame, ["ticker"], few=few)):
        small, large = f(1000), f(20)
        assert small.columns == large.columns
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_symbols_by_sweeps(spark):
    """Random histories with gaps, repeats, overlaps, empty and open entries against plain loops, and no more rows than days for a hot symbol."""
    rng, base = random.Random(5), dt.date(2024, 1, 1)
    day = lambda i: base + dt.timedelta(days=i)
    master = [(rng.choice([1, 2, 3, -7, 2**62]), rng.choice("xyz"), rng.choice([None, *map(day, range(30))]), rng.choice([None, *map(day, range(30))])) for _ in range(60)]
    master += [(None, "x", day(0), None), (9, None, day(0), None)]
    rows = [(i, rng.choice(["x", "y", "z", "unknown", None]), rng.choice([None, *map(day, range(-2, 33))])) for i in range(400)]
    bore = lambda s, d: {i for i, v, a, b in master if None not in (i, v, a, s, d) and v == s and a <= d and (b is None or d < b)}
    out, many = market.resolve(spark.createDataFrame(rows, "id long, symbol string, day date"), spark.createDataFrame(master, "instrument_id long, id_value string, valid_from date, valid_to date"), "symbol", "day")
    assert {r.id: r.instrument_id for r in out.collect()} == {i: min(b) if len(b := bore(s, d)) == 1 else None for i, s, d in rows}
    assert {(r.symbol, r.day): r.instruments for r in many.collect()} == {(s, d): len(bore(s, d)) for _, s, d in rows if len(bore(s, d)) > 1}
    n, days = 20_000, 200  # four million pairs of a day and an entry, were they made
    hot = spark.range(n).select(F.col("id").alias("instrument_id"), F.lit("x").alias("id_value"), F.lit(base).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    _, many = market.resolve(spark.range(days).select(F.lit("x").alias("symbol"), F.date_add(F.lit(base), F.col("id").cast("int")).alias("day")), hot, "symbol", "day")
    assert most_rows(spark, lambda: [r.instruments for r in many.collect()] == [n] * days) < 10 * n


def most_rows(spark, run):
    """The most rows that an operator of run()'s plans gave; run() must hold."""
    tracker = spark._jsparkSession.sharedState().statusStore()
    seen = tracker.executionsCount()
    assert run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    done = tracker.executionsList()
    most = 0
    for k in range(seen, done.size()):
        ids = {m.accumulatorId() for m in _each(done.apply(k).metrics()) if m.name() == "number of output rows"}
        values = tracker.executionMetrics(done.apply(k).executionId())
        most = max([most, *(int(values.apply(i).replace(",", "")) for i in ids if values.contains(i))])
    return most


def _each(seq):
    return (seq.apply(i) for i in range(seq.size()))
