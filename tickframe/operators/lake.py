"""Lake operations as data: inventories, costs, growth, findings, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.operators import quantiles


def inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Path, bytes and day of every file under a root (A21); contents are never read, for only these columns are asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", F.to_date(F.nullif(F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})", 1), F.lit(""))).alias("day"))


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """Lines of a ledger file, or of a folder of them, each in file order up to its first damaged one.

    `seq` is a line's place: its block and its number after it; `file` names the ledger. strict raises if a good line stands
    behind damage in any file. Files are read in splits and meet the place of their damage by a join on the file.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("seq"), F.col("value").alias("line")).where("trim(line) <> ''")
    parsed = lines.select("file", "seq", F.from_json("line", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e"))
    bad = F.col("e._bad").isNotNull()
    damage = parsed.groupBy("file").agg(F.min(F.when(bad, F.col("seq"))).alias("_first"), F.max(F.when(~bad, F.col("seq"))).alias("_last")).where("_first is not null").withColumnRenamed("file", "_file")
    if strict and not damage.where("_last > _first").isEmpty():
        raise ValueError(f"whole lines behind damage in {path}")
    j = parsed.join(damage, F.col("file") == F.col("_file"), "left")
    return j.where("_first is null or seq < _first").select("file", "seq", "e.*").drop("_bad")


#: The columns of a billing export that figures are made of, with their kinds; fixed names.
COST_COLUMNS = {
    "line_item_usage_start_date": "timestamp",
    "line_item_product_code": "string",
    "line_item_usage_type": "string",
    "line_item_resource_id": "string",
    "line_item_line_item_type": "string",
    "line_item_unblended_cost": "double",
    "line_item_usage_amount": "double",
    "line_item_currency_code": "string",
    "line_item_usage_account_id": "string",
}


def cost_export(spark: SparkSession, root: str) -> DataFrame:
    """Lines of a billing export (A19): the nine columns, the day in UTC, empty texts for null ones, zero for null numbers.

    A file without rows adds none; an export that lacks a column, or holds one as another kind, refuses.
    """
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("mergeSchema", "true").parquet(root)
    have = dict(df.dtypes)
    missing = [c for c in COST_COLUMNS if c not in have]
    if missing:
        raise ValueError(f"cost export without {', '.join(missing)}")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    start = F.col("line_item_usage_start_date")
    return df.select(
        F.to_date(F.to_utc_timestamp(start.cast("timestamp"), F.current_timezone())).alias("day"),
        *(text(c).alias(c.removeprefix("line_item_")) for c, kind in COST_COLUMNS.items() if kind == "string"),
        *(number(c).alias(c.removeprefix("line_item_")) for c, kind in COST_COLUMNS.items() if kind == "double"),
    )


def percentiles(x: Column, keep: Column | None = None) -> Column:
    """Exact median and 99th percentile, interpolated."""
    return F.percentile(x if keep is None else F.when(keep, x), F.array(F.lit(0.5), F.lit(0.99)))


def latency(rows: DataFrame, calendar: DataFrame, keys: list[str], last_minutes: int = 60, few: int = 1_000_000) -> DataFrame:
    """Dispatch and round trip in milliseconds: over all cycles, at the open, in the last minutes; and what has no end (D10). A group of more than
    ``few`` rows is not sorted in one task."""
    j = rows.join(calendar.select("day", "open_at", "close_at"), "day")
    ms = lambda a, b: F.timestamp_diff("MILLISECOND", F.col(a), F.col(b))
    dispatch, trip = ms("snap_ts", "fetch_ts"), ms("fetch_ts", "fetch_end_ts")
    opening = F.col("snap_ts") < F.col("open_at") + F.expr("interval 1 hour")
    closing = (F.col("snap_ts") >= F.col("close_at") - F.make_dt_interval(mins=F.lit(last_minutes))) & (F.col("snap_ts") <= F.col("close_at"))
    named = {"dispatch": (dispatch, None), "trip": (trip, None), "open_trip": (trip, opening), "close_trip": (trip, closing)}
    skipped = F.count_if(F.col("fetch_end_ts").isNull()).alias("skipped")
    if quantiles.any_large(j, keys, few):
        each = F.array(*(F.struct(F.lit(k).alias("_name"), (x if keep is None else F.when(keep, x)).alias("_ms")) for k, (x, keep) in named.items()))
        q = quantiles.exact(j.select(*keys, F.explode(each).alias("_x")).select(*keys, "_x.*"), [*keys, "_name"], "_ms", [0.5, 0.99], few)
        q = q.groupBy(*keys).agg(*(F.max(F.when(F.col("_name") == k, F.col("q"))).alias(k) for k in named))
        g = j.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(skipped).join(q, [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in keys])
    else:
        g = j.groupBy(*keys).agg(*(percentiles(x, keep).alias(k) for k, (x, keep) in named.items()), skipped)
    return g.select(*keys, *(c for k in named for c in (F.get(k, F.lit(0)).alias(f"{k}_p50"), F.get(k, F.lit(1)).alias(f"{k}_p99"))), "skipped")


def cycle_sizes(rows: DataFrame, keys: list[str], cycle: str) -> DataFrame:
    """Rows per cycle: least, median, 99th percentile and most."""
    c = rows.groupBy(*keys, cycle).agg(F.count(F.lit(1)).alias("c"))
    return c.groupBy(*keys).agg(F.count(F.lit(1)).alias("cycles"), F.sum("c").alias("rows"), F.min("c").alias("least"), F.percentile("c", F.lit(0.5)).alias("p50"), F.percentile("c", F.lit(0.99)).alias("p99"), F.max("c").alias("most"))


def grouped_costs(costs: DataFrame) -> DataFrame:
    """Totals by product and usage, by line type, by product and usage type, by resource, in one pass."""
    c = costs.withColumn("is_usage", (F.col("line_type") == "Usage").cast("int"))
    sets = [[F.col("product"), F.col("is_usage")], [F.col("line_type")], [F.col("product"), F.col("usage_type")], [F.col("resource")]]
    by = ["product", "is_usage", "line_type", "usage_type", "resource"]
    return c.groupingSets(sets, *by).agg(F.sum("cents").alias("cents"), F.grouping_id().alias("grouping")).select("grouping", *by, "cents")


def daily_costs(costs: DataFrame) -> DataFrame:
    """Usage and other cents by day and product."""
    usage = F.col("line_type") == "Usage"
    return costs.groupBy("day", "product").agg(F.coalesce(F.sum(F.when(usage, F.col("cents"))), F.lit(0)).alias("usage_cents"), F.coalesce(F.sum(F.when(~usage, F.col("cents"))), F.lit(0)).alias("other_cents"))


def projection(costs: DataFrame) -> DataFrame:
    """Per month: complete days (the newest is partial), usage so far, and the month's end at that rate."""
    usage = F.col("line_type") == "Usage"
    month = F.to_date(F.date_trunc("month", "day"))
    days = costs.groupBy(month.alias("month"), "day").agg(F.coalesce(F.sum(F.when(usage, F.col("cents"))), F.lit(0)).alias("u"), F.coalesce(F.sum(F.when(~usage, F.col("cents"))), F.lit(0)).alias("o"))
    newest = days.groupBy("month").agg(F.max("day").alias("newest"))
    j = days.join(newest, "month")
    g = j.groupBy("month").agg(F.any_value("newest").alias("newest"), F.sum(F.when(F.col("day") < F.col("newest"), F.col("u")).otherwise(0)).alias("usage_cents"), F.sum("o").alias("other_cents"))
    complete, length = F.day("newest") - 1, F.day(F.last_day("month"))
    return g.select("month", complete.cast("long").alias("complete_days"), "usage_cents", "other_cents", F.when(complete > 0, F.floor(F.col("usage_cents") * length / complete + F.col("other_cents"))).alias("month_end_cents"), F.when(complete > 0, "projected").otherwise("too_early").alias("status"))


def per_session(costs: DataFrame, sessions: DataFrame) -> DataFrame:
    """Usage per month over that month's distinct sessions."""
    month = lambda c: F.to_date(F.date_trunc("month", c))
    u = costs.where("line_type = 'Usage'").groupBy(month("day").alias("month")).agg(F.sum("cents").alias("usage_cents"))
    s = sessions.select("day").distinct().groupBy(month("day").alias("month")).agg(F.count(F.lit(1)).alias("sessions"))
    return u.join(s, "month", "left").select("month", "usage_cents", F.coalesce("sessions", F.lit(0)).alias("sessions"), F.when(F.col("sessions") > 0, F.floor(F.col("usage_cents") / F.col("sessions"))).alias("cents_per_session"), F.when(F.col("sessions") > 0, "ok").otherwise("no_sessions").alias("status"))


def trend(costs: DataFrame, days: int = 30) -> DataFrame:
    """A dense series of days ending at the newest usage day; days without cost are null, the newest is partial."""
    daily = costs.where("line_type = 'Usage'").groupBy("day").agg(F.sum("cents").alias("cents"))
    end = daily.agg(F.max("day").alias("e"))
    dense = end.select("e", F.explode(F.sequence(F.date_sub("e", days - 1), "e")).alias("day"))
    return dense.join(daily, "day", "left").select("day", "cents", (F.col("day") == F.col("e")).alias("partial"))


def sizes(costs: DataFrame, key: str = "resource") -> DataFrame:
    """First and last day's figure of each key and the growth between them."""
    d = costs.groupBy(key, "day").agg(F.sum("cents").alias("v"))
    g = d.groupBy(key).agg(F.min_by("v", "day").alias("first"), F.max_by("v", "day").alias("last"), F.min("day").alias("since"))
    return g.withColumn("growth", F.col("last") - F.col("first"))


def storage_growth(files: DataFrame, window_days: int = 30) -> DataFrame:
    """Bytes per day with the window's peak and mean so far."""
    d = files.groupBy("day").agg(F.sum("length").alias("bytes"))
    # days are met with the days of their window: a join on the day, not one ordered partition
    near = d.select("bytes", F.explode(F.sequence("day", F.date_add("day", window_days - 1))).alias("day"))
    g = near.groupBy("day").agg(F.max("bytes").alias("peak"), F.sum("bytes").alias("in_window"), F.count(F.lit(1)).alias("grown_days"))
    return d.join(g, "day").select("day", "bytes", "peak", "in_window", "grown_days")


def runway(growth: DataFrame, free: int, reserve: int = 13) -> DataFrame:
    """Whole days until free bytes, less a reserve of the busiest day, are used at the peak rate; never below zero."""
    g = growth.agg(F.max("bytes").alias("busiest"), F.max_by("peak", "day").alias("peak"))
    return g.select("busiest", "peak", F.greatest(F.lit(0), F.floor((F.lit(free) - reserve * F.col("busiest")) / F.col("peak"))).cast("long").alias("days"))


def upload_lag(listing: DataFrame, limit_seconds: int = 90) -> DataFrame:
    """Lag between a segment's start, which its key names, and its upload."""
    start = F.to_timestamp(F.regexp_extract("key", r"seg-(\d{8}T\d{6})", 1), "yyyyMMdd'T'HHmmss")
    lag = F.unix_timestamp("modified") - F.unix_timestamp(start)
    return listing.agg(F.count(F.lit(1)).alias("segments"), F.max(lag).alias("largest"), F.count_if(lag > limit_seconds).alias("over"))


def runs(findings: DataFrame, nights: DataFrame, key: str = "key", night: str = "night", n: str = "n") -> DataFrame:
    """Runs of nights on which a key was found; nights nobody observed neither extend nor end one.

    The observed nights, one for each day there is, are numbered as one sorted array.
    """
    idx = nights.agg(F.array_sort(F.collect_set(night)).alias("_a")).select(F.posexplode("_a").alias("_p", "_n")).select("_n", (F.col("_p") + 1).cast("long").alias("_i"))
    last = idx.agg(F.max("_i").alias("_last"))
    w = Window.partitionBy(key).orderBy("_i")
    j = findings.join(idx, F.col(night) == F.col("_n")).withColumn("_g", F.col("_i") - F.row_number().over(w))
    g = j.groupBy(key, "_g").agg(F.min(night).alias("start"), F.max(night).alias("end"), F.count(F.lit(1)).alias("nights"), F.max("_i").alias("_e"), F.max_by(n, "_i").alias("latest"))
    return g.join(F.broadcast(last)).select(key, "start", "end", "nights", "latest", (F.col("_e") == F.col("_last")).alias("open"))


def changes(today: DataFrame, before: DataFrame, key: str = "key", n: str = "n") -> DataFrame:
    """new, gone, recounted or unchanged for each key of two nights."""
    j = today.select(key, F.col(n).alias("now")).join(before.select(key, F.col(n).alias("was")), key, "full_outer")
    return j.withColumn("change", F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "gone").when(F.col("was") != F.col("now"), "recounted").otherwise("unchanged"))


def rotation(pairs: DataFrame, week: int, weeks: int = 52, path: str = "path") -> DataFrame:
    """What one week restores: files whose path hashes to the week's slot, or to the next slot that has any (S3)."""
    slot = F.pmod(F.conv(F.substring(F.sha2(F.col(path).cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(weeks)).cast("int")
    p = pairs.withColumn("slot", slot).withColumn("_far", F.pmod(F.col("slot") - week, F.lit(weeks)))
    least = p.agg(F.min("_far").alias("_least"))
    return p.join(F.broadcast(least)).where("_far = _least").drop("_far", "_least")


def masked(resource: Column, accounts: list[str]) -> Column:
    """An ARN's account field and any known account id, masked."""
    out = F.regexp_replace(resource, r"^(arn:[^:]*:[^:]*:[^:]*:)\d{12}(:|$)", "$1************$2")
    for a in accounts:
        out = F.replace(out, F.lit(a), F.lit("*" * len(a)))
    return out


def usage_class(usage_type: Column, labels: dict[str, str]) -> Column:
    """Label of a usage type without its region prefix."""
    plain = F.regexp_replace(usage_type, r"^[A-Z]{2,4}\d?-", "")
    out = F.lit("other")
    for prefix, label in sorted(labels.items(), key=lambda x: len(x[0])):
        out = F.when(plain.startswith(prefix), label).otherwise(out)
    return out


def lost_minutes(manifest: DataFrame, files: DataFrame, recorded: DataFrame) -> DataFrame:
    """Minutes of manifested segments that are gone from disk, unless another row records them."""
    gone = manifest.join(files.select("partition"), "partition", "left_anti").select("ticker", F.date_trunc("minute", "fetched_at").alias("slot")).distinct()
    return gone.join(recorded.select("ticker", "slot"), ["ticker", "slot"], "left_anti").withColumn("error_class", F.lit("segment_lost"))


def retention(manifest: DataFrame, edges: DataFrame, mark: int, withheld: DataFrame, restored: DataFrame, daily: DataFrame) -> DataFrame:
    """Partitions that may go: at or before their surface's edge, uploaded, not withheld or restored later, quotes only with a daily bar."""
    m = manifest.join(edges, "surface").where((F.col("day") <= F.col("edge")) & (F.col("seq") < mark))
    m = m.join(withheld.select("partition"), "partition", "left_anti").join(restored.select("partition"), "partition", "left_anti")
    landed = daily.select("ticker", "day").distinct().withColumn("_bar", F.lit(True))
    return m.join(landed, ["ticker", "day"], "left").where((F.col("surface") != "quotes") | F.col("_bar")).select(*manifest.columns)


def retune(counts: DataFrame, keys: list[str], most: int, least: int) -> DataFrame:
    """Fetch windows (lo, hi, n) of each key, wide ones split at the middle, neighbours merged while the sum stays below least.

    A key's plan is a handful of windows, so the fold runs over its array. Windows of unknown size (null n) never merge.
    """
    win = "array<struct<lo:int,hi:int,n:bigint>>"
    mid = lambda w: (w["lo"] + w["hi"]) / 2
    piece = lambda lo, hi, n: F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"), n.cast("bigint").alias("n"))
    split = lambda w: F.when((w["n"] > most) & (w["hi"] > w["lo"]), F.array(piece(w["lo"], F.floor(mid(w)), F.ceil(w["n"] / 2)), piece(F.floor(mid(w)) + 1, w["hi"], F.floor(w["n"] / 2)))).otherwise(F.array(piece(w["lo"], w["hi"], w["n"])))
    plan = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "n"))).alias("w"))
    parts = F.flatten(F.transform(F.col("w").cast(win), split))
    last = lambda acc: F.element_at(acc, -1)
    fold = F.aggregate(
        parts,
        F.array().cast(win),
        lambda acc, w: F.when(
            (F.size(acc) > 0) & (last(acc)["n"] < least) & w["n"].isNotNull() & last(acc)["n"].isNotNull() & (last(acc)["n"] + w["n"] <= most),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(piece(last(acc)["lo"], w["hi"], last(acc)["n"] + w["n"]))),
        ).otherwise(F.concat(acc, F.array(w))),
    )
    return plan.select(*keys, F.posexplode(fold).alias("at", "x")).select(*keys, "at", "x.lo", "x.hi", "x.n")


def digest(lines: DataFrame, most: int = 1000) -> DataFrame:
    """A night's counts as one text of at most so many bytes of UTF-8, cut between characters."""
    body = lines.groupBy("night").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", "n"))), " ").alias("x"))
    cut = F.substring(F.col("x").cast("binary"), 1, most)
    # what is left of a character at the end: at most three bytes, which no longer decode
    whole = F.coalesce(*(F.try_validate_utf8(F.substring(cut, F.lit(1), F.length(cut) - k).cast("string")) for k in range(4)))
    return body.select("night", whole.alias("body"))
