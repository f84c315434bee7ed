"""Every registered query of the reference's operators against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tickframe.plans import registry, running, streams
from tickframe.streaming import live

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return None
        return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)

    return sorted((tuple(map(plain, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_columns(spark):
    for f in registry.QUERIES.values():
        assert f(spark, SF).columns


def in_duck(folder, tables, name):
    """The SQL of a query over tables of a folder."""
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in tables:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c.sql(registry.ORACLES[name]).df()


def test_a_known_account_is_masked_wherever_it_stands(spark, tmp_path):
    pd.DataFrame({"s_suppkey": [1, 777, 2], "s_name": ["Supplier#000000001", "Supplier#000000777", "Supplier#007777770"]}).to_parquet(f"{tmp_path}/supplier.parquet")
    got = registry.QUERIES["masked_resources"](spark, str(tmp_path)).toPandas()
    assert sorted(got.resource.str[-9:]) == ["******770", "***000***", "***000001"]
    assert rows(got) == rows(in_duck(tmp_path, ["supplier"], "masked_resources"))


@pytest.fixture
def shared_instants(tmp_path):
    """Events of which many have the same type and instant, with odd and even ids, not in the order of their ids."""
    n = 600
    ids = [i * 7 % n for i in range(n)]
    at = pd.Timestamp("2024-01-03") + pd.to_timedelta([i // 40 for i in ids], unit="min")
    pd.DataFrame({"event_id": ids, "ts": at.astype("datetime64[us]"), "user_id": ids, "event_type": [("view", "click")[i % 3 % 2] for i in ids], "value": [i / 8 for i in ids], "props": ["{}"] * n}).to_parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["chain_payloads", "instant_order", "live_watchdog", "live_drift_pages"])
def test_events_that_share_an_instant(spark, shared_instants, name):
    got = registry.QUERIES[name](spark, shared_instants).toPandas()
    assert rows(got) == rows(in_duck(shared_instants, ["events"], name))


def test_no_step_of_a_stream_sees_more_than_a_lot(spark, shared_instants, monkeypatch):
    seen = []
    lots = lambda rows, operator, order: running.run_in_lots(rows, lambda x: seen.append(1) or operator(x), order, 100)
    monkeypatch.setattr(streams, "run_in_lots", lots)
    for name in ("live_watchdog", "live_drift_pages"):
        seen.clear()
        got = registry.QUERIES[name](spark, shared_instants).toPandas()
        assert len(seen) == 6 and rows(got) == rows(in_duck(shared_instants, ["events"], name))


def test_lots_of_nothing(spark):
    none = spark.createDataFrame([], "ticker string, snap_ts timestamp, row_kind string")
    assert running.run_in_lots(none, live.watchdog, ["snap_ts"]).count() == 0
