"""Snapshot reads in two passes (A1, B1, B2): the wanted instants from two narrow columns, then only the row groups that hold them.

A table is laid out in folders of its keys, rows of a file in order of their instants, with ``minute`` (of the UTC day) beside
them. Sorted, the narrow columns take next to no room, so the first pass is cheap. A close or a cycle falls on few minutes of
a day whatever the number of days and tickers, so the second pass can hand the scan a list of minutes, which row groups are
skipped by; a join then keeps the exact instants. A list has at most ``most`` runs of minutes: nearer ones are put together, which reads more
and changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEYS = ("ticker", "day")
MINUTE = "minute"


def minute_of(instant: Column) -> Column:
    return F.floor(F.pmod(F.unix_seconds(instant), F.lit(86_400)) / 60).cast("int")


def write_sorted(rows: DataFrame, path: str, instant: str = "snap_ts", keys: tuple[str, ...] = KEYS, group_bytes: int = 16 << 20) -> None:
    """Lays rows out for these reads. A hot key is cut into ranges of instants, a file each, so no task holds a key. A null instant has no minute; such
    rows stand first and every read of closes looks at them."""
    parts = rows.withColumn(MINUTE, minute_of(F.col(instant))).repartitionByRange(*keys, F.col(instant)).sortWithinPartitions(*keys, instant)
    parts.write.option("parquet.block.size", group_bytes).option("parquet.page.row.count.limit", 20_000).partitionBy(*keys).parquet(path)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The whole table; columns and minutes prune."""
    return spark.read.schema(StructType([*schema.fields]).add(MINUTE, "integer")).parquet(path)


def runs_of(minutes: list[int], most: int) -> list[tuple[int, int]]:
    """Sorted minutes as runs, the nearest ones joined until there are at most so many."""
    runs = [[m, m] for m in sorted(set(minutes))]
    gaps = sorted(range(1, len(runs)), key=lambda i: (runs[i][0] - runs[i - 1][1], i))
    joined = {i for i in gaps if runs[i][0] - runs[i - 1][1] == 1} | set(gaps[: max(0, len(runs) - most)])
    out: list[list[int]] = []
    for i, r in enumerate(runs):
        if i in joined:
            out[-1][1] = r[1]
        else:
            out.append(r)
    return [(a, b) for a, b in out]


def within(runs: list[tuple[int, int]]) -> Column:
    """A filter that Parquet's scan takes as it is."""
    m = F.col(MINUTE)
    return reduce(lambda x, y: x | y, ((m == a) if a == b else (m >= a) & (m <= b) for a, b in runs), F.lit(False))


def fetch(table: DataFrame, wanted: DataFrame, instant: str, keys: tuple[str, ...] = KEYS, most: int = 32, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows of the wanted (KEYS..., instant), by a second pass over the row groups of their minutes. Wanted instants are few next to the rows; up to
    ``broadcast_rows`` of them are broadcast."""
    minutes = wanted.select(minute_of(F.col(instant)).alias("m")).groupBy("m").count().collect()  # 1440 at most
    if not minutes:
        return table.drop(MINUTE).where(F.lit(False))
    of = wanted.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(instant).alias("_at"))
    few = sum(r["count"] for r in minutes) <= broadcast_rows
    same = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col(instant) == F.col("_at")]
    return table.where(within(runs_of([r.m for r in minutes], most))).join(F.broadcast(of) if few else of, same, "left_semi").drop(MINUTE)


def closes_of_record(table: DataFrame, tag: str, instant: str = "snap_ts", keys: tuple[str, ...] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Rows of each key's close of that tag, and the keys that have no instant of it, more than one, or an unreadable one (B2). Pass one reads the keys,
    the tags and the instants."""
    tagged = F.col("close_tag") == tag
    seen = table.groupBy(*keys).agg(F.min(F.when(tagged, F.col(instant))).alias("_a"), F.max(F.when(tagged, F.col(instant))).alias("_b"), F.count_if(tagged & F.col(instant).isNull()).alias("unreadable"))
    seen = seen.persist()  # both results come from it: a row a key
    good = F.col("_a").isNotNull() & (F.col("_a") == F.col("_b")) & (F.col("unreadable") == 0)
    rows = fetch(table, seen.where(good).select(*keys, F.col("_a").alias(instant)), instant, keys).where(tagged)
    return rows, seen.where(~good).select(*keys, F.when(F.col("_a").isNull(), 0).when(F.col("_a") == F.col("_b"), 1).otherwise(2).alias("instants"), "unreadable")


def cycles_before(table: DataFrame, minute: int, instant: str = "snap_ts", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Rows of each key's newest cycle at or before a minute of the UTC day (B1, D4); a key that has none yet has no rows. Pass one reads the
    keys and the instants up to that minute."""
    newest = table.where(F.col(MINUTE) <= minute).groupBy(*keys).agg(F.max(instant).alias(instant))
    return fetch(table, newest, instant, keys)
