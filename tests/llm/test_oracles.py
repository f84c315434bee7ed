"""Corpus queries against their SQL in DuckDB."""

import duckdb
import pytest

from tickframe.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = c.sql(queries.ORACLES[name])
    assert sorted(want.columns) == columns
    rows = lambda x: sorted(map(str, x))
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(c.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall())
