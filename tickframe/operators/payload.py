"""Vendor payloads to rows: flattening, overflow, retype routing, version projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = "map<string,string>"
CHAIN = f"struct<symbol:string,isTruncated:boolean,callExpDateMap:map<string,map<string,array<{FIELDS}>>>,putExpDateMap:map<string,map<string,array<{FIELDS}>>>>"
BLOCKS = ("quote", "fundamental", "regular", "extended")


def snake(name: str) -> str:
    import re

    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def overflow(fields: Column, known: list[str]) -> Column:
    """Unknown fields as JSON with sorted keys, null if there are none."""
    left = F.map_filter(fields, lambda k, v: ~k.isin(*known)) if known else fields
    return F.when(F.size(left) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(left)))))


def chains(bodies: DataFrame, fields: dict[str, str], markers: Column | None = None) -> DataFrame:
    """One row per contract of each body (A4): ticker, snap_ts, the fields cast, the rest in extra.

    bodies: ticker, snap_ts, body. number_of_contracts counts captured rows of the snapshot; a chain is truncated if the
    vendor says so or any absence marker is set.
    """
    b = bodies.select("ticker", "snap_ts", F.from_json("body", CHAIN).alias("b"), F.coalesce(markers, F.lit(False)).alias("_m") if markers is not None else F.lit(False).alias("_m"))
    sides = F.array(F.struct(F.lit("CALL").alias("put_call"), F.col("b.callExpDateMap").alias("m")), F.struct(F.lit("PUT").alias("put_call"), F.col("b.putExpDateMap").alias("m")))
    e = b.select("ticker", "snap_ts", "b", "_m", F.explode(sides).alias("s"))
    e = e.select("ticker", "snap_ts", "b", "_m", "s.put_call", F.explode("s.m").alias("expiration_key", "strikes"))
    e = e.select("ticker", "snap_ts", "b", "_m", "put_call", "expiration_key", F.explode("strikes").alias("strike_key", "list"))
    e = e.select("ticker", "snap_ts", "b", "_m", "put_call", "expiration_key", "strike_key", F.explode("list").alias("c"))
    counts = e.groupBy("ticker", "snap_ts").agg(F.count(F.lit(1)).alias("number_of_contracts"))
    cast = [F.col("c")[k].try_cast(t).alias(snake(k)) for k, t in fields.items()]
    return e.join(counts, ["ticker", "snap_ts"]).select("ticker", "snap_ts", "put_call", F.to_date(F.substring("expiration_key", 1, 10)).alias("expiration"), F.col("strike_key").try_cast("double").alias("strike"), *cast, "number_of_contracts", (F.coalesce("b.isTruncated", F.lit(False)) | F.col("_m")).alias("is_chain_truncated"), overflow(F.col("c"), list(fields)).alias("extra"))


def _block_rest(block: str, known: list[str]) -> Column:
    """A block's unknown fields under prefixed names."""
    left = F.map_filter(F.col(f"q.{block}"), lambda k, v: ~k.isin(*known))
    return F.coalesce(F.transform_keys(left, lambda k, v: F.concat(F.lit(f"{block}."), k)), F.create_map().cast(FIELDS))


def quotes(bodies: DataFrame, fields: dict[str, dict[str, str]]) -> DataFrame:
    """One row per symbol of a batched body (A5): blocks become prefixed columns, the CUSIP comes from either of two places."""
    kind = "map<string,struct<" + ",".join(f"{b}:{FIELDS}" for b in (*BLOCKS, "reference")) + ">>"
    e = bodies.select("snap_ts", F.explode(F.from_json("body", kind)).alias("symbol", "q"))
    own = [F.col(f"q.{b}")[k].try_cast(t).alias(snake(k) if b == "quote" else f"{b}_{snake(k)}") for b, f in fields.items() for k, t in f.items()]
    rest = F.map_concat(*(_block_rest(b, [*fields.get(b, {}), "cusip"]) for b in BLOCKS))
    return e.select("snap_ts", F.col("symbol").alias("ticker"), *own, F.coalesce(F.col("q.reference")["cusip"], F.col("q.fundamental")["cusip"]).alias("cusip"), overflow(rest, []).alias("extra"))


def candles(bodies: DataFrame) -> DataFrame:
    """One row per bar (A6); bars without a fit stamp are dropped; unknown fields of body and candle overflow, the candle's win."""
    known = ["datetime", "open", "high", "low", "close", "volume"]
    b = bodies.select("ticker", F.from_json("body", FIELDS).alias("b"))
    e = b.select("ticker", F.map_filter("b", lambda k, v: ~k.isin("candles", "symbol", "empty")).alias("o"), F.explode(F.from_json(F.col("b")["candles"], f"array<{FIELDS}>")).alias("c"))
    mine = F.map_filter("c", lambda k, v: ~k.isin(*known))
    body = F.map_filter("o", lambda k, v: ~F.map_contains_key(mine, k))
    return e.select("ticker", epoch_ms(F.col("c")["datetime"]).alias("bar_ts"), *(F.col("c")[k].try_cast("double").alias(k) for k in known[1:5]), F.col("c")["volume"].try_cast("long").alias("volume"), overflow(F.map_concat(body, mine), []).alias("extra")).where("bar_ts is not null")


def epoch_ms(value: Column) -> Column:
    """Milliseconds as an instant; words, not-a-number and what leaves the calendar are null (A10)."""
    ms = value.try_cast("double")
    return F.when(ms.isNotNull() & ~F.isnan(ms) & (F.abs(ms) < 253402300800000), F.timestamp_micros(F.round(ms * 1000).cast("long")))


def fits(v: Column, kind: str) -> Column:
    """Whether a variant is a value of a column's type (A8): bigint refuses fractions and booleans, double refuses booleans."""
    s = F.schema_of_variant(v)
    number = s.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)")
    whole = F.try_variant_get(v, "$", "double")
    return {"string": s == "STRING", "boolean": s == "BOOLEAN", "double": number, "bigint": number & (whole == F.floor(whole)) & (F.abs(whole) < 9.2e18)}[kind]


def routed(rows: DataFrame, body: str, fields: dict[str, str], kind: str = "row_kind") -> DataFrame:
    """Values that don't fit their column are null there and stand in extra under their path, on data rows only.

    The gate is the variant's own kind, for casts are lenient.
    """
    v = rows.withColumn("_v", F.try_parse_json(body))
    at = {k: F.try_variant_get("_v", f"$.{k}", "variant") for k in fields}
    ok = {k: F.coalesce(fits(at[k], t), F.lit(False)) for k, t in fields.items()}
    filled = {k: at[k].isNotNull() & ~F.is_variant_null(at[k]) for k in fields}
    out = [F.when(ok[k], F.try_variant_get("_v", f"$.{k}", t)).alias(k) for k, t in fields.items()]
    odd = F.filter(F.array(*(F.struct(F.lit(k).alias("key"), F.when(filled[k] & ~ok[k], F.to_json(at[k])).alias("value")) for k in sorted(fields))), lambda x: x["value"].isNotNull())
    extra = F.when((F.col(kind) == "data") & (F.size(odd) > 0), F.to_json(F.map_from_entries(odd)))
    return v.select(*(c for c in rows.columns if c != body), *out, extra.alias("extra"))


def routed_columns(rows: DataFrame, keys: list[str], known: list[str], extra: str = "extra") -> DataFrame:
    """Known fields that extra names: a batch's routed columns."""
    e = rows.where(F.col(extra).isNotNull()).select(*keys, F.explode(F.map_keys(F.from_json(extra, FIELDS))).alias("field"))
    return e.where(F.col("field").isin(*known)).groupBy(*keys).agg(F.array_sort(F.collect_set("field")).alias("routed"))


def project_versions(rows: DataFrame, versions: DataFrame, fields: dict[str, str], extra: str = "extra") -> tuple[DataFrame, DataFrame]:
    """Fields that a row's version lacked, lifted out of extra; and the report.

    versions: schema_version, columns (array). A value in extra of a version that had the column is a retype: reported,
    not lifted. Versions that nobody recorded are reported.
    """
    v = versions.select(F.col("schema_version").alias("_ver"), F.col("columns").alias("_cols"))
    j = rows.join(v, F.col("schema_version") == F.col("_ver"), "left").withColumn("_x", F.from_json(extra, FIELDS))
    has = {f: F.array_contains("_cols", f) for f in fields}
    lifted = {f: F.when(~has[f], F.coalesce(F.col(f), F.col("_x")[f].try_cast(t))).otherwise(F.col(f)) for f, t in fields.items()}
    out = j.withColumns(lifted).select(*rows.columns)
    state = lambda f: F.when(F.col("_ver").isNull(), "unrecorded_version").when(has[f] & F.col("_x")[f].isNotNull(), "routed").when(~has[f] & F.col("_x")[f].isNotNull() & F.col("_x")[f].try_cast(fields[f]).isNull(), "refused")
    report = j.select("schema_version", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), state(f).alias("state")) for f in fields))).alias("r")).where("r.state is not null")
    return out, report.groupBy("schema_version", "r.field", "r.state").agg(F.count(F.lit(1)).alias("rows"))


def strict_date(ts: Column) -> Column:
    """A midnight as its date; other times of day are refused."""
    return F.when(F.date_format(ts, "HH:mm:ss.SSSSSS") == "00:00:00.000000", F.to_date(ts))
