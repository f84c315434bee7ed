"""Name -> query, and name -> SQL, of everything but the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.sources.adapters import CTES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: str = "") -> Callable:
    """Registers a function of Tables; sql may use the adapters' names as tables. Dates leave either engine as text."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(Tables(spark, sf_dir))
            return df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "date"})

        QUERIES[name] = run
        if sql:
            body = sql.strip()
            if dates:
                replaced = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split())
                at = _main_select(body)
                body = f"{body[:at]}SELECT * REPLACE ({replaced}) FROM ({body[at:]})"
            head = ", ".join(f"{k} AS ({v.strip()})" for k, v in CTES.items())
            ORACLES[name] = f"WITH {head}, {body[4:].strip()}" if body[:5].upper() == "WITH " else f"WITH {head} {body}"
        return f

    return put


def _main_select(sql: str) -> int:
    """Where the select after the common table expressions begins."""
    depth, at = 0, 0
    if not sql.upper().startswith("WITH"):
        return 0
    for i, c in enumerate(sql):
        depth += (c == "(") - (c == ")")
        if depth == 0 and sql[i : i + 7].upper() == "SELECT ":
            at = i
            break
    return at


from tickframe.plans import bars, doors, ledgers, market, operations, quality, snapshots, stores, streams, timed  # noqa: E402,F401
