"""The data model's frames, derived from the star-schema tables, and the same definitions as SQL for the checks.

Every method is a plain projection or one aggregation; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CTES = {
    "slots": """
        SELECT event_id, event_type AS ticker, ts AS snap_ts, date_trunc('hour', ts) AS slot, CAST(ts AS DATE) AS day,
               CASE WHEN event_id % 7 = 0 THEN 'gap' WHEN event_id % 97 = 0 THEN NULL ELSE 'data' END AS row_kind,
               event_id % 11 = 0 AS suspect,
               CASE WHEN event_id % 7 = 0 THEN CASE event_id % 3 WHEN 0 THEN 'timeout' WHEN 1 THEN 'rate_limited' ELSE 'vendor_error' END END AS error_class,
               ts + to_milliseconds(event_id % 1000) AS fetch_ts,
               CASE WHEN event_id % 13 <> 0 THEN ts + to_milliseconds(event_id % 1000 + event_id % 500) END AS fetch_end_ts,
               value, user_id, props
        FROM events""",
    "calendar": """
        SELECT CAST(d AS DATE) AS day, d AS open_at, d + CASE WHEN day(d) % 7 = 0 THEN INTERVAL 12 HOUR ELSE INTERVAL 23 HOUR END AS close_at,
               day(d) % 7 = 0 AS early, row_number() OVER (ORDER BY d) AS idx
        FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS d FROM events)""",
    "spans": """
        SELECT event_type AS ticker, date_trunc('day', min(ts)) + to_hours(length(event_type)) AS span_start,
               CASE WHEN event_type = 'signup' THEN TIMESTAMP '2024-01-20 00:00:00' END AS span_end, event_type <> 'error' AS options
        FROM events GROUP BY event_type""",
    "bars": """
        SELECT l_partkey % 25 AS instrument_id, CAST(l_shipdate AS DATE) AS session,
               arg_min(p, k) AS open, arg_max(p, k) AS close, max(p) AS high, min(p) AS low, CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM (SELECT *, l_extendedprice / l_quantity AS p, (l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem)
        GROUP BY 1, 2""",
    "actions": """
        SELECT o_custkey % 25 AS instrument_id, o_orderkey AS seq, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS ex_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS recorded_on,
               CASE o_orderstatus WHEN 'F' THEN 'split' ELSE 'dividend' END AS type,
               CASE WHEN o_orderkey % 2 = 0 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS split_ratio, (o_orderkey % 50) / 100.0::DOUBLE AS cash_amount
        FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "master": """
        SELECT s_suppkey AS instrument_id, 'A' || (s_suppkey % 7) AS id_value, DATE '1995-01-01' AS valid_from, DATE '1998-01-01' + CAST(s_suppkey AS INTEGER) AS valid_to FROM supplier
        UNION ALL SELECT s_suppkey, 'B' || s_suppkey, DATE '1998-01-01' + CAST(s_suppkey AS INTEGER), NULL FROM supplier""",
    "chains": """
        SELECT 'T' || (l_suppkey % 5) AS ticker, CAST(date_trunc('week', l_shipdate) AS DATE) AS session, CAST(l_shipdate AS DATE) AS cycle, l_partkey AS contract,
               CAST(max(l_quantity) AS BIGINT) AS open_interest, CAST(sum(l_quantity) AS BIGINT) AS volume,
               CAST(date_trunc('week', l_shipdate) AS DATE) + 7 * CAST(l_partkey % 8 AS INTEGER) AS expiration,
               any_value(p_retailprice * (1 + (l_partkey % 5) / 10.0::DOUBLE)) AS strike, CASE WHEN l_partkey % 2 = 0 THEN 'PUT' ELSE 'CALL' END AS put_call
        FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3, 4, 7, 9""",
    "quotes": """
        SELECT 'T' || (l_suppkey % 5) AS ticker, CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, l_partkey, mark,
               CASE WHEN l_linenumber % 13 = 0 OR l_partkey % 13 = 0 THEN mark * (1 + l_tax) ELSE mark * (1 - l_discount) END AS bid,
               CASE WHEN l_linenumber % 13 = 0 OR l_partkey % 13 = 0 THEN mark * (1 - l_discount) ELSE mark * (1 + l_tax) END AS ask,
               l_orderkey % 501 = 0 AS is_delayed
        FROM (SELECT *, l_extendedprice / l_quantity AS mark FROM lineitem)""",
    "ledger": """
        SELECT event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS partition, 'c' || (user_id % 3) AS check_name,
               CASE WHEN value > 10 THEN 'clean' ELSE 'quarantined' END AS verdict, event_id AS seq FROM events""",
    "manifest": "SELECT doc_id AS partition, sha256(text) AS sha256, n_chars AS n FROM documents",
    "inventory": "SELECT doc_id AS partition, sha256(CASE WHEN doc_id % 19 = 0 THEN text || '!' ELSE text END) AS sha256 FROM documents WHERE doc_id % 17 <> 0",
    "costs": """
        SELECT l_returnflag AS product, CASE WHEN l_linestatus = 'O' THEN 'Usage' ELSE 'Credit' END AS line_type, CAST(l_linenumber AS VARCHAR) AS usage_type,
               l_suppkey AS resource, CAST(round(l_extendedprice * l_discount * 100) AS BIGINT) AS cents, CAST(l_shipdate AS DATE) AS day FROM lineitem""",
    "findings": "SELECT event_type || (user_id % 10) AS key, CAST(ts AS DATE) AS night, count(*) FILTER (WHERE value < 4) AS n FROM events GROUP BY 1, 2 HAVING count(*) FILTER (WHERE value < 4) > 0",
}


class Tables:
    """Tables of a folder, and the frames made of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def slots(self) -> DataFrame:
        i, ts = F.col("event_id"), F.col("ts").cast("timestamp")
        plus = lambda ms: ts + F.make_dt_interval(secs=(ms / 1000).cast("decimal(18,6)"))
        kind = F.when(i % 7 == 0, "gap").when(i % 97 == 0, None).otherwise("data")
        error = F.when(i % 7 == 0, F.when(i % 3 == 0, "timeout").when(i % 3 == 1, "rate_limited").otherwise("vendor_error"))
        return self.table("events").select(
            "event_id",
            F.col("event_type").alias("ticker"),
            ts.alias("snap_ts"),
            F.date_trunc("hour", ts).alias("slot"),
            F.to_date(ts).alias("day"),
            kind.alias("row_kind"),
            (i % 11 == 0).alias("suspect"),
            error.alias("error_class"),
            plus(i % 1000).alias("fetch_ts"),
            F.when(i % 13 != 0, plus(i % 1000 + i % 500)).alias("fetch_end_ts"),
            "value",
            "user_id",
            "props",
        )

    def calendar(self) -> DataFrame:
        """Sessions are an input of the engine; here every day of the events is one."""
        ts = F.col("ts").cast("timestamp")
        days = self.table("events").agg(F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b"))
        day = days.select(F.posexplode(F.sequence("a", "b")).alias("at", "day"))
        early = F.day("day") % 7 == 0
        at = F.col("day").cast("timestamp")
        return day.select("day", at.alias("open_at"), (at + F.make_dt_interval(hours=F.when(early, 12).otherwise(23))).alias("close_at"), early.alias("early"), (F.col("at") + 1).cast("long").alias("idx"))

    def spans(self) -> DataFrame:
        ts = F.col("ts").cast("timestamp")
        first = self.table("events").groupBy(F.col("event_type").alias("ticker")).agg(F.date_trunc("day", F.min(ts)).alias("d"))
        return first.select("ticker", (F.col("d") + F.make_dt_interval(hours=F.length("ticker"))).alias("span_start"), F.when(F.col("ticker") == "signup", F.lit("2024-01-20 00:00:00").cast("timestamp")).alias("span_end"), (F.col("ticker") != "error").alias("options"))

    def bars(self) -> DataFrame:
        p, k = F.col("l_extendedprice") / F.col("l_quantity"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        one = self.table("lineitem").select((F.col("l_partkey") % 25).alias("instrument_id"), F.to_date("l_shipdate").alias("session"), p.alias("p"), k.alias("k"), "l_quantity")
        return one.groupBy("instrument_id", "session").agg(F.min_by("p", "k").alias("open"), F.max_by("p", "k").alias("close"), F.max("p").alias("high"), F.min("p").alias("low"), F.sum("l_quantity").cast("long").alias("volume"))

    def actions(self) -> DataFrame:
        o = self.table("orders").where(F.col("o_orderstatus").isin("F", "O"))
        k = F.col("o_orderkey")
        return o.select(
            (F.col("o_custkey") % 25).alias("instrument_id"),
            k.alias("seq"),
            F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("ex_date"),
            F.date_add(F.to_date("o_orderdate"), (k % 30).cast("int")).alias("recorded_on"),
            F.when(F.col("o_orderstatus") == "F", "split").otherwise("dividend").alias("type"),
            F.when(k % 2 == 0, 2.0).otherwise(0.5).alias("split_ratio"),
            ((k % 50) / 100).alias("cash_amount"),
        )

    def master(self) -> DataFrame:
        turn = F.date_add(F.lit("1998-01-01").cast("date"), F.col("s_suppkey").cast("int"))
        s = self.table("supplier")
        first = s.select(F.col("s_suppkey").alias("instrument_id"), F.concat(F.lit("A"), F.col("s_suppkey") % 7).alias("id_value"), F.lit("1995-01-01").cast("date").alias("valid_from"), turn.alias("valid_to"))
        return first.unionByName(s.select(F.col("s_suppkey").alias("instrument_id"), F.concat(F.lit("B"), F.col("s_suppkey")).alias("id_value"), turn.alias("valid_from"), F.lit(None).cast("date").alias("valid_to")))

    def chains(self) -> DataFrame:
        week = F.to_date(F.date_trunc("week", "l_shipdate"))
        li = self.table("lineitem").select(F.concat(F.lit("T"), F.col("l_suppkey") % 5).alias("ticker"), week.alias("session"), F.to_date("l_shipdate").alias("cycle"), F.col("l_partkey").alias("contract"), "l_quantity")
        one = li.groupBy("ticker", "session", "cycle", "contract").agg(F.max("l_quantity").cast("long").alias("open_interest"), F.sum("l_quantity").cast("long").alias("volume"))
        price = self.table("part").select(F.col("p_partkey").alias("contract"), (F.col("p_retailprice") * (1 + (F.col("p_partkey") % 5) / 10)).alias("strike"))
        c = F.col("contract")
        return one.join(price, "contract").select("ticker", "session", "cycle", "contract", "open_interest", "volume", F.date_add("session", (7 * (c % 8)).cast("int")).alias("expiration"), "strike", F.when(c % 2 == 0, "PUT").otherwise("CALL").alias("put_call"))

    def quotes(self) -> DataFrame:
        mark = F.col("l_extendedprice") / F.col("l_quantity")
        low, high = mark * (1 - F.col("l_discount")), mark * (1 + F.col("l_tax"))
        swapped = (F.col("l_linenumber") % 13 == 0) | (F.col("l_partkey") % 13 == 0)
        return self.table("lineitem").select(F.concat(F.lit("T"), F.col("l_suppkey") % 5).alias("ticker"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_partkey", mark.alias("mark"), F.when(swapped, high).otherwise(low).alias("bid"), F.when(swapped, low).otherwise(high).alias("ask"), (F.col("l_orderkey") % 501 == 0).alias("is_delayed"))

    def ledger(self) -> DataFrame:
        return self.table("events").select(F.concat_ws("/", "event_type", F.to_date("ts").cast("string")).alias("partition"), F.concat(F.lit("c"), F.col("user_id") % 3).alias("check_name"), F.when(F.col("value") > 10, "clean").otherwise("quarantined").alias("verdict"), F.col("event_id").alias("seq"))

    def manifest(self) -> DataFrame:
        return self.table("documents").select(F.col("doc_id").alias("partition"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.col("n_chars").alias("n"))

    def inventory(self) -> DataFrame:
        text = F.when(F.col("doc_id") % 19 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
        return self.table("documents").where("doc_id % 17 <> 0").select(F.col("doc_id").alias("partition"), F.sha2(text.cast("binary"), 256).alias("sha256"))

    def costs(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_returnflag").alias("product"), F.when(F.col("l_linestatus") == "O", "Usage").otherwise("Credit").alias("line_type"), F.col("l_linenumber").cast("string").alias("usage_type"), F.col("l_suppkey").alias("resource"), F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("long").alias("cents"), F.to_date("l_shipdate").alias("day"))

    def findings(self) -> DataFrame:
        return self.table("events").groupBy(F.concat("event_type", F.col("user_id") % 10).alias("key"), F.to_date("ts").alias("night")).agg(F.count_if(F.col("value") < 4).alias("n")).where("n > 0")


def text(c: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Instants leave the engine as text in results, so two engines can be held against each other."""
    return F.date_format(c, pattern)
