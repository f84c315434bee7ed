"""Scratch folders, and streams that run over what is there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.sources.adapters import Tables

_LOCAL: dict[str, str] = {}  # of local sessions that name no folder


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share; only a local session may go without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        base = _LOCAL.get(app) or tempfile.mkdtemp(prefix="spark-")
        _LOCAL[app] = base
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def run_once(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over what is there and gives back what its sink holds."""
    path = scratch(stream.sparkSession)
    sink = lambda batch, _: batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{path}/out")
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(sink).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def run_in_lots(rows: DataFrame, operator: Callable[[DataFrame], DataFrame], order: list[str], most: int = 1_000_000) -> DataFrame:
    """What a stream gives (append) whose rows land in lots of about ``most``, in order; after each it goes on from its checkpoint and stops.

    However many rows a key has, a step of its state sees at most a lot of them. The rows are dealt out once.
    """
    spark, path = rows.sparkSession, scratch(rows.sparkSession)
    lots = max(1, -(-rows.count() // most))
    rows.repartitionByRange(lots, *order).withColumn("_lot", F.spark_partition_id()).write.partitionBy("_lot").parquet(f"{path}/dealt")
    dealt = spark.read.schema(rows.withColumn("_lot", F.lit(0)).schema).parquet(f"{path}/dealt")
    sink = lambda batch, _: batch.write.mode("append").parquet(f"{path}/out")
    for k in sorted(r._lot for r in dealt.select("_lot").distinct().collect()) or [0]:
        dealt.where(F.col("_lot") == k).drop("_lot").write.mode("append").parquet(f"{path}/in")
        out = operator(spark.readStream.schema(rows.schema).parquet(f"{path}/in"))
        out.writeStream.outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out")


def event_stream(t: Tables) -> DataFrame:
    return event_rows(t.spark.readStream.schema(t.table("events").schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir))


def event_rows(e: DataFrame) -> DataFrame:
    i = F.col("event_id")
    kind = F.when(i % 7 == 0, "gap").when(i % 97 == 0, None).otherwise("data")
    error = F.when(i % 7 == 0, F.when(i % 3 == 0, "timeout").when(i % 3 == 1, "rate_limited").otherwise("vendor_error"))
    return e.select("event_id", F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("snap_ts"), kind.alias("row_kind"), (i % 11 == 0).alias("suspect"), error.alias("error_class"), "user_id", "value")
