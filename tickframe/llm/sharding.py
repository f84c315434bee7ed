"""Sharding by a two-pass external shuffle: seeded hashes scatter whole records into memory-sized buckets, each bucket
gets a Fisher-Yates shuffle and is written; the buckets one after another are one random order, cut into equal shards.

The law is ``rows``: sizes in rows differ by one at most. The scatter is the only shuffle of texts. A bucket is bucket_bytes
large on average, so a task holds about that much and the number of buckets, not their size, grows with the input. With
ids that are unique the order depends on seed, ids and the number of buckets; where the rows of one id would overfill a
bucket, rows are told apart by their place in the input as well, which must then be a table that reads alike each time.

Edges: a null text has size 16 and the CRC of no bytes; null, repeated or equal ids and equal texts are rows of their own;
a very long text makes its bucket longer by itself; an empty table gives no rows; columns of any name and type travel
inside ``row``; more shards than rows leave some shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickframe.llm.common import full_text, new_path, stored

OVERHEAD = 16  #: bytes a record takes besides its text


def shuffled(docs: DataFrame, seed: int = 20_241, bucket_bytes: int = 16 << 20) -> DataFrame:
    """(bucket, place, size, text_crc32, row): the written buckets; place is a row's place in its bucket, from 0."""
    size = F.octet_length(full_text()).cast("long") + OVERHEAD
    of_id = docs.select("doc_id", size.alias("size")).groupBy("doc_id").agg(F.sum("size").alias("size"))
    total, largest = of_id.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    longest = docs.agg(F.max(size)).first()[0] if largest > bucket_bytes else 0
    buckets = max(1, -(-total // bucket_bytes))
    apart = [F.monotonically_increasing_id()] if largest > max(bucket_bytes, longest) else []
    rows = docs.select(F.xxhash64(F.lit(seed), "doc_id", *apart).alias("h"), size.alias("size"), F.crc32(full_text()).alias("text_crc32"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    dealt = rows.withColumn("bucket", F.pmod(F.shiftright("h", 16), F.lit(buckets)).cast("int")).repartition(buckets, "bucket").sortWithinPartitions("bucket", "h")
    held = dealt.groupBy("bucket").agg(F.collect_list(F.struct("size", "text_crc32", "row")).alias("rows"))
    drawn = held.select("bucket", F.shuffle("rows", seed).alias("rows"))  # Spark draws by Fisher-Yates
    return stored(drawn.select("bucket", F.posexplode("rows").alias("place", "x")).select("bucket", "place", "x.*"), "buckets")


def placed(buckets: DataFrame, n_shards: int, most: int = 1 << 20) -> DataFrame:
    """Written buckets -> (shard, slot, size, text_crc32, row). Their sizes are one row each; up to ``most`` are broadcast, more are joined."""
    if n_shards < 1:
        raise ValueError("a record needs a shard to lie in")
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n"))
    sizes = stored(sizes.select("bucket", "n", (F.sum("n").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before")), "sizes")
    count, total = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    at = buckets.join(F.broadcast(sizes) if count <= most else sizes, "bucket").withColumn("at", F.col("before") + F.col("place"))
    at = at.withColumn("shard", F.expr(f"at * {n_shards} div {max(total, 1)}").cast("int"))
    first = F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")
    return at.select("shard", (F.col("at") - first).alias("slot"), "size", "text_crc32", "row")


def shards(docs: DataFrame, n_shards: int, seed: int = 20_241, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Every record of docs with its shard and its slot there, gapless from 0: (shard, slot, size, text_crc32, row)."""
    return placed(shuffled(docs, seed, bucket_bytes), n_shards)


def write_shards(placed_rows: DataFrame, path: str | None = None) -> str:
    """Writes a folder for each shard, records in the order of their slots within a file; returns the path. A bucket lies in
    one shard or two, so there are about as many files as buckets."""
    path = path or new_path(placed_rows.sparkSession, "shards")
    placed_rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return path
