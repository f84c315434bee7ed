"""Small hand-made frames for the branches that tables don't reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickframe.operators import bars as B
from tickframe.operators import lake as K
from tickframe.operators import ledger as L
from tickframe.operators import market as M
from tickframe.operators import quality as Q
from tickframe.operators import snapshots as S

D = dt.date


def test_split_is_strict_and_volume_rounds_half_up(spark):
    bars = spark.createDataFrame([(1, D(2024, 1, 1), 10.0, 10.0, 10.0, 10.0, 5), (1, D(2024, 1, 2), 10.0, 10.0, 10.0, 10.0, 5)], "instrument_id long, session date, open double, high double, low double, close double, volume long")
    splits = spark.createDataFrame([(1, D(2024, 1, 2), 0.5)], "instrument_id long, ex_date date, split_ratio double")
    got = {r.session.day: (r.close, r.volume) for r in B.split_adjusted(bars, splits).collect()}
    assert got == {1: (20.0, 3), 2: (10.0, 5)}  # 2.5 rounds to 3, the ex-date itself stays


def test_total_return_refuses_a_dividend_above_its_close(spark):
    bars = spark.createDataFrame([(1, D(2024, 1, d), 10.0, 10.0, 10.0, 10.0, 1) for d in (1, 2, 3)], "instrument_id long, session date, open double, high double, low double, close double, volume long")
    none = spark.createDataFrame([], "instrument_id long, ex_date date, split_ratio double")
    div = spark.createDataFrame([(1, D(2024, 1, 2), 1.0), (1, D(2024, 1, 3), 20.0)], "instrument_id long, ex_date date, cash_amount double")
    got = {r.session.day: (round(r.close, 9), r.refused) for r in B.total_return(bars, none, div).collect()}
    assert got == {1: (9.0, 1), 2: (10.0, 1), 3: (10.0, 0)}


def test_carried_values_cross_the_years(spark):
    rows = [(k, D(y, m, 1), v) for k, y, m, v in (("a", 2020, 1, None), ("a", 2020, 5, 1), ("a", 2020, 7, 2), ("a", 2021, 1, None), ("a", 2023, 1, None), ("a", 2023, 2, 3), ("a", 2024, 1, None), ("b", 2024, 1, None))]
    got = B.carried(spark.createDataFrame(rows, "k string, d date, v int"), "k", "d", ["d"], "v").orderBy("k", "d").collect()
    assert [r.carried for r in got] == [None, 1, 2, 2, 2, 3, 3, None]
    got = B.carried(spark.createDataFrame(rows, "k string, d date, v int"), "k", "d", ["d"], "v", backward=True).orderBy("k", "d").collect()
    assert [r.carried for r in got] == [1, 1, 2, 3, 3, 3, None, None]


def test_factors_by_brute_force(spark):
    import random

    rng = random.Random(7)
    day = lambda: D(rng.choice((2019, 2020, 2021, 2024)), rng.randrange(1, 13), rng.randrange(1, 28))
    events = [(rng.choice("ab"), day(), rng.choice((0.5, 2.0, 4.0, None)), rng.randrange(2)) for _ in range(30)]
    days = [(rng.choice("abc"), day()) for _ in range(80)] + [(k, x) for k, x, *_ in events]
    got = {(r.k, r.d): (r.factor, r.bad) for r in B.factors(spark.createDataFrame(days, "k string, d date"), spark.createDataFrame(events, "k string, x date, v double, b int"), "v", "k", "d", "x", bad="b").collect()}
    want = {}
    for k, d in days:
        later = [(v or 1.0, b) for j, x, v, b in events if j == k and x > d]
        if later:
            f = 1.0
            for v, _ in later:
                f *= v
            want[k, d] = (f, sum(b for _, b in later))
    assert got == want


def test_cents_and_numbers(spark):
    df = spark.createDataFrame([(0.07,), (1.15,), (1.005,), (float("nan"),), (float("inf"),), (None,), (1e17,)], "x double")
    assert [r[0] for r in df.select(B.cents(F.col("x"))).collect()] == [7, 115, None, None, None, None, None]


def test_daily_bar_rolls_over_at_six_on_both_sides_of_dst(spark):
    df = spark.createDataFrame([("2024-01-10 22:59:59",), ("2024-01-10 23:00:00",), ("2024-07-10 21:59:59",), ("2024-07-10 22:00:00",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    assert [r[0].day for r in df.select(B.session_of(F.col("t"))).collect()] == [10, 11, 10, 11]


def test_instants_need_an_offset(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T02:00:00+02:00",), ("2024-01-01T00:00:00",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(S.instant(F.col("s"))).collect()]
    assert got[0] == got[1] is not None and got[2:] == [None, None, None]


def test_malformed_minute_raises(spark):
    with pytest.raises(ValueError):
        S.at_minute(spark.range(1), "2024-01-10", "9:61")


def test_unknown_verdict_withholds(spark):
    led = spark.createDataFrame([("p", "a", "clean", 1), ("p", "b", None, 2), ("q", "a", "quarantined", 3), ("q", "a", "clean", 4)], "partition string, check_name string, verdict string, seq long")
    got = {r.partition: (r.withheld, r.deciding_seq) for r in L.quarantine_fold(led).collect()}
    assert got == {"p": (True, 2), "q": (False, 4)}


def test_a_persons_sign_off_stands(spark):
    now = spark.createDataFrame([("p", "clean", "person"), ("q", "clean", "battery")], "k string, verdict string, provenance string")
    new = spark.createDataFrame([("p", "quarantined"), ("q", "quarantined"), ("r", "clean")], "k string, verdict string")
    assert [r.k for r in L.transitions(now, new, ["k"]).collect()] == ["q"]


def test_deliverables(spark):
    good = '[{"assetType":"STOCK","currencyType":null,"deliverableUnits":100.0,"symbol":"A"}]'
    two = '[{"assetType":"STOCK","currencyType":null,"deliverableUnits":100.0,"symbol":"A"},{"assetType":"CURRENCY","currencyType":"USD","deliverableUnits":5.0,"symbol":"USD"}]'
    df = spark.createDataFrame([(good,), (two,), ("[]",), ("no json",), (None,)], "j string").select(M.deliverable(F.col("j")).alias("d"))
    got = [r.d for r in df.collect()]
    assert got[0].entries == 1 and not got[0].cash and got[1].cash and got[2:] == [None, None, None]


def test_occ_symbols(spark):
    df = spark.createDataFrame([("SPY   260918C00650000",), ("SPY   20260918C0065000",), (None,)], "s string")
    got = df.select(M.occ_root(F.col("s")), M.occ_expiry(F.col("s"))).collect()
    assert got[0][0] == "SPY" and got[0][1] == D(2026, 9, 18) and got[1][1] is None and got[2][0] is None


def test_dividend_gate(spark):
    df = spark.createDataFrame([(4, 0.25, 1.0), (4, 0.3, 1.0), (0, 0.0, 0.0), (4, 0.0, 0.0), (4, None, 1.0)], "f int, p double, a double")
    assert [r[0] for r in df.select(M.dividend_consistent(F.col("f"), F.col("p"), F.col("a"))).collect()] == [True, False, False, True, False]


def test_retune_splits_and_merges(spark):
    df = spark.createDataFrame([("a", 0, 9, 100), ("a", 10, 19, 5), ("a", 20, 29, 4), ("a", 30, 39, None), ("a", 40, 49, 3)], "k string, lo int, hi int, n long")
    got = [(r.lo, r.hi, r.n) for r in K.retune(df, ["k"], most=60, least=8).orderBy("at").collect()]
    assert got == [(0, 4, 50), (5, 9, 50), (10, 29, 9), (30, 39, None), (40, 49, 3)]


def test_ledger_file_ends_at_damage(spark, tmp_path):
    f = tmp_path / "l.jsonl"
    f.write_text('{"a": 1}\n{"a": 2}\n{"a": \n{"a": 4}\n')
    assert [r.a for r in K.jsonl(spark, str(f), "a long").orderBy("seq").collect()] == [1, 2]
    with pytest.raises(ValueError):
        K.jsonl(spark, str(f), "a long", strict=True)


def test_upload_lag(spark):
    df = spark.createDataFrame([("x/seg-20240101T000000-1.parquet", "2024-01-01 00:01:00"), ("x/seg-20240101T000000-2.parquet", "2024-01-01 00:02:00")], "key string, m string").select("key", F.col("m").cast("timestamp").alias("modified"))
    r = K.upload_lag(df).first()
    assert (r.segments, r.largest, r.over) == (2, 120, 1)


def test_consistency_of_scalar_adjustments(spark):
    one = "struct<cash:boolean,entries:int,symbol:string,multiplier:double>"
    df = spark.createDataFrame([((False, 1, "A", 100.0), (False, 1, "A", 100.0)), ((False, 1, "A", 100.0), (True, 1, "A", 100.0)), ((False, 1, None, 100.0), (False, 1, "A", 100.0))], f"p {one}, n {one}")
    assert [r[0] for r in df.select(M.scalar_adjustment("p", "n")).collect()] == [True, False, False]


def test_lossless_cast(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (None,)], "x double")
    assert df.agg(Q.lossless(df, "x", "bigint")).first()[0] == 1


def test_named_queries_check_their_parameters(spark):
    from tickframe.operators import views as V

    with pytest.raises(ValueError):
        V.NAMED["today"].run(spark, {}, ticker="x'; drop", day="2024-01-01")
    with pytest.raises(ValueError):
        V.NAMED["today"].run(spark, {}, ticker="SPY")
    with pytest.raises(ValueError):
        V.load_bars(V.Store(), adjust="other")


def test_legacy_reads(spark, tmp_path):
    from tickframe.sources import sealed

    part = tmp_path / "old/ticker=A/freq=1d"
    part.mkdir(parents=True)
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name in ("date=2024-01-05.parquet", "date=2024-1-6.parquet"):
        pq.write_table(pa.table({"x": [1, 2]}), part / name)
    got = sealed.read_legacy(spark, str(tmp_path / "old"), "x long").collect()
    assert [(r.ticker, r.freq, r.date, r.x) for r in got] == [("A", "1d", D(2024, 1, 5), 1), ("A", "1d", D(2024, 1, 5), 2)]


def test_unreadable_segments_are_listed(spark, tmp_path):
    from tickframe.sources import sealed
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"x": [1, 2]}), tmp_path / "a.parquet")
    (tmp_path / "b.parquet").write_bytes(b"not parquet")
    (tmp_path / "c.parquet").write_bytes(b"")
    rows, bad = sealed.read_landing(spark, str(tmp_path), "x long")
    assert rows.count() == 2 and [r.unreadable.rsplit("/", 1)[1] for r in bad.collect()] == ["b.parquet"]


def test_a_file_without_rows_is_sound_and_one_damaged_half_way_is_not(spark, tmp_path):
    from tickframe.sources import sealed
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"x": pa.array([], pa.int64())}), tmp_path / "none.parquet")
    pq.write_table(pa.table({"x": list(range(100_000))}), tmp_path / "half.parquet", row_group_size=10_000, write_page_checksum=True)
    whole = bytearray((tmp_path / "half.parquet").read_bytes())
    at = len(whole) // 2
    whole[at : at + 2000] = bytes(2000)  # later row groups can't be read; the footer and the first ones can
    (tmp_path / "half.parquet").write_bytes(whole)
    spark.createDataFrame([(1,)], "x long").repartition(2).write.parquet(str(tmp_path / "spark"))
    rows, bad = sealed.read_landing(spark, str(tmp_path), "x long")
    assert [r.x for r in rows.collect()] == [1]
    assert [r.unreadable.rsplit("/", 1)[1] for r in bad.collect()] == ["half.parquet"]


def test_ledgers_of_a_folder_end_each_at_their_own_damage(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    (tmp_path / "b.jsonl").write_text('{"a": 3}\n{"a": \n')
    (tmp_path / "c.jsonl").write_text("")
    assert sorted(r.a for r in K.jsonl(spark, str(tmp_path), "a long", strict=True).collect()) == [1, 2, 3]


def test_cost_export_refuses_and_fills(spark, tmp_path):
    whole = {c: None for c in K.COST_COLUMNS}
    schema = ", ".join(f"{c} {k}" for c, k in K.COST_COLUMNS.items())
    spark.createDataFrame([tuple(whole.values())], schema).write.parquet(str(tmp_path / "a"))
    r = K.cost_export(spark, str(tmp_path / "a")).first()
    assert (r.day, r.product_code, r.unblended_cost) == (None, "", 0.0)
    spark.range(1).write.parquet(str(tmp_path / "b"))
    with pytest.raises(ValueError, match="without"):
        K.cost_export(spark, str(tmp_path / "b"))


def test_digest_is_cut_at_bytes(spark):
    rows = spark.createDataFrame([(1, "aé中😀", 1)], "night int, name string, n int")
    whole = "aé中😀=1".encode()
    for most in range(1, 14):
        assert K.digest(rows, most).first().body == whole[:most].decode(errors="ignore")


def test_streams_go_on_from_their_state():
    """The steps of the two stateful operators against plain loops, over batches of any size."""
    import random

    import pandas as pd

    from tickframe.streaming import live

    class State:
        exists, value = False, None

        @property
        def get(self):
            return self.value

        def update(self, v):
            self.exists, self.value = True, v

    class Rows:
        def groupBy(self, *_):  # noqa: N802
            return self

        def applyInPandasWithState(self, step, *_):  # noqa: N802
            return step

    rng = random.Random(1)
    watch, drift = live.watchdog(Rows(), threshold=2), live.drift_pages(Rows())
    for _ in range(200):
        rows = [(i, rng.choice(["data", "gap", None]), rng.choice("ab"), rng.choice([True, False, None])) for i in range(rng.randrange(1, 25))]
        want, n, held, pages = [], 0, set(), []
        for at, kind, ticker, x in rows:
            if kind == "data":
                want += [(at, "recovered", n)] * (n >= 2)
                n = 0
            else:
                n += 1
                want += [(at, "failing", n)] * (n == 2)
            if x:
                pages += [(ticker, at)] * (not held)
                held.add(ticker)
            elif x is False:
                held.discard(ticker)
        got, found, a, b = [], [], State(), State()
        while rows:
            k = rng.randrange(1, len(rows) + 1)
            batch, rows = rows[:k], rows[k:]
            f = pd.DataFrame(batch, columns=["snap_ts", "row_kind", "ticker", "drifts"]).astype({"drifts": object})
            got += [tuple(r)[1:] for out in watch(("t",), iter([f]), a) for r in out.itertuples(index=False)]
            found += [tuple(r)[2:] for out in drift(("s", "c"), iter([f]), b) for r in out.itertuples(index=False)]
        assert got == want and found == pages


def test_retuned_windows_of_a_whole_table(spark):
    """The fold of fetch windows against a plain loop over all of a table's days."""
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet").groupBy("event_type", (F.floor(F.day("ts") / 4) * 4).cast("int").alias("lo")).agg(F.count(F.lit(1)).alias("n")).collect()
    most, least = 30, 20
    df = spark.createDataFrame([(r.event_type, r.lo, r.lo + 3, r.n) for r in rows], "k string, lo int, hi int, n long")
    got = {}
    for r in K.retune(df, ["k"], most=most, least=least).orderBy("k", "at").collect():
        got.setdefault(r.k, []).append((r.lo, r.hi, r.n))
    for k in {r.event_type for r in rows}:
        parts = []
        for lo, hi, n in sorted((r.lo, r.lo + 3, r.n) for r in rows if r.event_type == k):
            if n > most:
                mid = (lo + hi) // 2
                parts += [(lo, mid, -(-n // 2)), (mid + 1, hi, n // 2)]
            else:
                parts.append((lo, hi, n))
        out = []
        for p in parts:
            if out and out[-1][2] < least and out[-1][2] + p[2] <= most:
                out[-1] = (out[-1][0], p[1], out[-1][2] + p[2])
            else:
                out.append(p)
        assert [(a, b) for a, b, _ in got[k]] == [(a, b) for a, b, _ in out]


def test_reference_tables_refuse(spark, tmp_path):
    from pyspark.sql import types as T

    from tickframe.sources import sealed

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("schema_version", T.IntegerType())])
    p = str(tmp_path / "r")
    spark.createDataFrame([(1, 1)], schema).write.parquet(p)
    assert sealed.read_reference(spark, p, schema, [1]).count() == 1
    with pytest.raises(ValueError):
        sealed.read_reference(spark, p, schema, [2])
    with pytest.raises(ValueError):
        sealed.read_reference(spark, p, T.StructType([T.StructField("a", T.StringType())]), [1])


def test_a_segment_lands_once_even_after_a_crash(spark, tmp_path):
    from tickframe.streaming import live

    target, manifest = str(tmp_path / "t"), str(tmp_path / "m")
    batch = spark.createDataFrame([("s1", 1), ("s1", 2), ("s1", 2), ("s2", 3)], "segment string, x int")
    batch.where("segment = 's1'").write.mode("append").partitionBy("segment").parquet(target)  # written, but the manifest was not
    for _ in range(3):
        live.land_once(batch, target, manifest)
    assert sorted((r.segment, r.x) for r in live.landed(spark, target, manifest).collect()) == [("s1", 1), ("s1", 2), ("s1", 2), ("s2", 3)]
    assert {r.segment: r.rows for r in spark.read.parquet(manifest).collect()} == {"s1": 3, "s2": 1}
    live.land_once(spark.createDataFrame([("s3", 4)], batch.schema), target, manifest)
    assert live.landed(spark, target, manifest).count() == 5


def test_daily_csv_refuses_what_it_must(spark, tmp_path):
    from tickframe.sources import sealed

    f = tmp_path / "d.csv"
    f.write_text("Price,Close,High,Low,Open,Volume\nTicker,X,X,X,X,X\nDate,,,,,\n2024-01-02,1,2,0.5,1,10\n2024-01-03,NaN,2,1,1,5\n2024-01-04,1,1,1,1,1\n2024-01-04,1,1,1,1,1\n2024-01-06,1,1,1,1,1\n")
    cal = spark.createDataFrame([(D(2024, 1, d),) for d in (2, 3, 4, 5)], "day date")
    ok, bad = sealed.daily_csv(spark, str(f), cal, "x")
    assert [(r.day, str(r.bar_ts)) for r in ok.collect()] == [(D(2024, 1, 2), "2024-01-02 05:00:00")]
    assert sorted(r.reason for r in bad.collect()) == ["not_a_session", "not_finite", "repeated_date", "repeated_date"]
