"""Sealed partitions, landing segments and reference tables (A1-A3, A15, A17, A18, A20, A22, A23, ST6)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_legacy(spark: SparkSession, root: str, schema: StructType | str) -> DataFrame:
    """surface/ticker=T/[freq=F/]date=D.parquet (A1): the date is the file's name, so it comes from the path.

    Only strictly spelled dates count. Tables that this engine writes have date folders, which prune.
    """
    at = F.col("_metadata.file_path")
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "date=*.parquet").parquet(root)
    part = lambda name: F.nullif(F.regexp_extract(at, rf"/{name}=([^/]+)/", 1), F.lit(""))
    day = F.regexp_extract(at, r"/date=(\d{4}-\d{2}-\d{2})\.parquet$", 1)
    return df.select("*", part("ticker").alias("ticker"), part("freq").alias("freq"), F.to_date(F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))).alias("date")).where("date is not null")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Sessions of different columns in one (A3): nulls for what is missing, numbers widened to double where they disagree."""
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for c, t in f.dtypes:
            kinds.setdefault(c, set()).add(t)
    wide = {c: "double" if t <= {"int", "bigint", "float", "double"} else "string" for c, t in kinds.items() if len(t) > 1}
    out = None
    for f in frames:
        f = f.withColumns({c: F.col(c).cast(t) for c, t in wide.items() if c in f.columns})
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def read_landing(spark: SparkSession, root: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """A day's segments, and the files that can't be read to their end (A2); such a file never counts as some rows or none.

    Segments are small, so a task reads each as a whole to see whether it is sound; a sound file may have no rows. Files of
    no bytes are absent. Rows are then read from the sound ones only.
    """

    def sound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow as pa
        import pyarrow.parquet as pq

        for f in frames:
            ok = []
            for content in f.content:
                try:
                    with pq.ParquetFile(pa.BufferReader(content), page_checksum_verification=True) as p:
                        ok.append(p.metadata.num_rows == sum(p.read_row_group(i).num_rows for i in range(p.num_row_groups)))
                except Exception:  # whatever a damaged file makes the reader say
                    ok.append(False)
            yield pd.DataFrame({"_path": f.path, "_sound": ok})

    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root).where("length > 0").select("path", "content")
    judged = there.mapInPandas(sound, "_path string, _sound boolean").withColumn("_path", plain("_path"))
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)
    rows = rows.withColumn("_file", plain(F.col("_metadata.file_path")))
    good = rows.join(judged.where("_sound").select(F.col("_path").alias("_p")), F.col("_file") == F.col("_p"), "left_semi")
    return good.drop("_file"), judged.where(~F.col("_sound")).select(F.col("_path").alias("unreadable"))


def read_reference(spark: SparkSession, path: str, schema: StructType, versions: list[int]) -> DataFrame:
    """A reference table of a pinned schema; another schema or an unknown version refuses."""
    have = {f.name: f.dataType for f in spark.read.parquet(path).schema}
    want = {f.name: f.dataType for f in schema}
    if have != want:
        raise ValueError(f"foreign schema in {path}: {sorted(set(have) ^ set(want)) or 'types'}")
    df = spark.read.schema(schema).parquet(path)
    if not df.where(~F.col("schema_version").isin(versions) | F.col("schema_version").isNull()).isEmpty():
        raise ValueError(f"unknown schema_version in {path}")
    return df


def daily_csv(spark: SparkSession, path: str, calendar: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Daily bars of a vendor's file with three header rows (A17), and what is refused: repeated dates, days off the calendar, bad numbers."""
    raw = spark.read.schema("day string, close string, high string, low string, open string, volume string").csv(path)
    rows = raw.where(F.col("day").rlike(r"^\d{4}-\d{2}-\d{2}")).select(F.to_date(F.substring("day", 1, 10)).alias("day"), *(F.col(c).try_cast("double").alias(c) for c in ("open", "high", "low", "close")), F.col("volume").try_cast("long").alias("volume"))
    n = rows.groupBy("day").agg(F.count(F.lit(1)).alias("_n"))
    on = calendar.select("day").distinct().withColumn("_on", F.lit(True))
    bad = F.lit(False)
    for c in ("open", "high", "low", "close"):
        bad = bad | F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    j = rows.join(n, "day").join(on, "day", "left").withColumn("reason", F.when(F.col("_n") > 1, "repeated_date").when(F.col("_on").isNull(), "not_a_session").when(bad, "not_finite"))
    stamp = F.to_utc_timestamp(F.col("day").cast("timestamp"), "America/New_York")
    ok = j.where("reason is null").select(stamp.alias("bar_ts"), *rows.columns, F.lit("imported").alias("origin"), F.lit(source).alias("source"))
    return ok, j.where("reason is not null").select(*rows.columns, "reason")


def sessions_before(calendar: DataFrame, first: DataFrame, n: int = 40) -> DataFrame:
    """The n sessions before each ticker's first one (A18). first: ticker, day."""
    days = calendar.agg(F.array_sort(F.collect_set("day"), lambda a, b: F.datediff(b, a)).alias("_d"))  # newest first; a calendar has a day for each day there is
    before = F.slice(F.filter("_d", lambda d: d < F.col("day")), 1, n)
    return first.select("ticker", "day").join(F.broadcast(days)).select("ticker", F.explode(before).alias("day"))


def timings(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Request and cycle lines of a timing log."""
    df = spark.read.schema("kind string, snap_ts string, start double, sent double, connected double, headers double, body double, `end` double, status int, bytes long, error string, load1 double").json(path)
    return df.where("kind = 'request'"), df.where("kind = 'cycle'")
