"""Running counts over a key's rows in blocks, so a hot key is spread.

Each block of a key is scanned by itself and summed up as one element of a monoid: how many hits stand after its last reset, and whether
it has one. Scanning those elements, one for each block, gives what is carried into a block. Blocks are ranges of the order column: days of
instants, years of dates, spans of 2^20 of numbers. Rows without an order stand in a block of their own, before the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def block_of(rows: DataFrame, order: str, size: int = 1 << 20) -> Column:
    kind = rows.schema[order].dataType.simpleString()
    if kind.startswith("timestamp"):
        return F.unix_date(F.to_date(order)).cast("long")
    return F.year(order).cast("long") if kind == "date" else F.floor(F.col(order) / size).cast("long")


def since_reset(rows: DataFrame, keys: list[str], order: str, hit: Column, reset: Column, name: str, block: Column | None = None) -> DataFrame:
    """rows with the number of hits since the last reset of their key, up to and with each row; a row that resets begins at its own hit."""
    hit, reset = (F.coalesce(c.cast("long"), F.lit(0)) for c in (hit, reset))
    dealt = rows.withColumns({"_b": block_of(rows, order) if block is None else block, "_h": hit, "_r": reset})
    before = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumn("_g", F.sum("_r").over(before))
    run = Window.partitionBy(*keys, "_b", "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumn("_n", F.sum("_h").over(run))
    # of a block: its hits after its last reset, and whether it has a reset
    sums = local.groupBy(*keys, "_b").agg(F.max("_r").alias("_any"), F.max_by("_n", F.struct("_g", "_n")).alias("_tail"))
    blocks = Window.partitionBy(*keys).orderBy("_b")
    sums = sums.withColumn("_s", F.sum("_any").over(blocks.rowsBetween(Window.unboundedPreceding, 0)))
    sums = sums.withColumn("_after", F.sum("_tail").over(Window.partitionBy(*keys, "_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
    sums = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_kb"), F.coalesce(F.lag("_after").over(blocks), F.lit(0)).alias("_carry"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b").eqNullSafe(F.col("_kb"))]
    out = local.join(sums, same)
    return out.withColumn(name, F.col("_n") + F.when(F.col("_g") == 0, F.col("_carry")).otherwise(0)).select(*rows.columns, name)


def changes(rows: DataFrame, keys: list[str], order: str, value: str, name: str, block: Column | None = None) -> DataFrame:
    """rows with how often their key's value has changed up to each row: rows of one spell of a value have one number. A null is no change."""
    dealt = rows.withColumn("_b", block_of(rows, order) if block is None else block)
    own, blocks = Window.partitionBy(*keys, "_b").orderBy(order), Window.partitionBy(*keys).orderBy("_b")
    named = lambda df, c, alias: df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_kb"), c.alias(alias))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b").eqNullSafe(F.col("_kb"))]
    ends = dealt.groupBy(*keys, "_b").agg(F.max_by(value, order).alias("_last"))
    prior = named(ends, F.lag("_last").over(blocks), "_prior")
    local = dealt.withColumns({"_first": F.row_number().over(own) == 1, "_lag": F.lag(value).over(own)}).join(prior, same)
    local = local.withColumn("_c", F.coalesce((F.col(value) != F.when(F.col("_first"), F.col("_prior")).otherwise(F.col("_lag"))).cast("long"), F.lit(0))).select(*rows.columns, "_b", "_c")
    sums = local.groupBy(*keys, "_b").agg(F.sum("_c").alias("_t"))
    carry = named(sums, F.coalesce(F.sum("_t").over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_carry")
    return local.withColumn("_n", F.sum("_c").over(own.rowsBetween(Window.unboundedPreceding, 0))).join(carry, same).withColumn(name, F.col("_n") + F.col("_carry")).select(*rows.columns, name)
