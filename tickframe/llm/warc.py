"""A content-addressed archive of WARC records.

Every page becomes a record. Its exact header block (WARC headers, blank line, HTTP headers of the response) is kept in
one table, its payload in another, once for all records with equal bytes, under SHA-256. Reading joins them back:
header + payload + two line ends are the record's bytes. Payloads are verified when written (digest and length stand in
each header), and the catalogue digests what it cuts out of records that were put together by the join.

Of records with equal payloads of at least ``least`` bytes the one with the largest page_id is the response; the others
revisit it. Shorter payloads are responses each. A record's id is made from its page, target, payload and place among
equal rows, so it is unique, and the same if a task runs again; its date is the archive's, given or the time of writing.

Edges: a null html is an empty payload; a null url is an empty target; a null page_id can only be a response or, if it
shares a payload, a revisit; equal rows with the largest page_id are both responses, under ids of their own; an empty
table gives empty archives; other columns are ignored.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickframe.llm.common import dropped, new_path, stored

CRLF = "\r\n"
HTTP = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digest: Column) -> Column:
    """RFC 4648 base32 of a hexadecimal digest of a multiple of 40 bits: ten digits are eight letters."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, i, 10), 16, 32), 8, "0") for i in range(1, 40, 10)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_uri(page_id: Column, url: Column, digest: Column, copy: Column) -> Column:
    """A name-based UUID of what tells a record from all others."""
    name = F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), F.hex(digest), copy.cast("string"))
    h = F.md5(name.cast("binary"))
    parts = (F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def header(row: dict[str, Column], captured: str) -> Column:
    """The exact header block of a record, up to where its payload begins. row: kind, id, page_id, url, sha1, size, and of what it revisits: to_id, to_page, to_url."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    text = lambda c: F.coalesce(row[c].cast("string"), F.lit(""))
    revisit = row["kind"] == "revisit"
    block = F.lit(len(HTTP)) + F.when(revisit, F.lit(0)).otherwise(row["size"])
    points = F.concat(
        line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", text("to_id")), line("WARC-Refers-To-Target-URI", text("to_url")), line("WARC-Refers-To-Date", F.lit(captured)), line("X-Refers-To-Page", text("to_page"))
    )
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", row["kind"]),
        line("WARC-Record-ID", row["id"]),
        line("WARC-Date", F.lit(captured)),
        line("WARC-Target-URI", text("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), row["sha1"])),
        line("X-Payload-Length", text("size")),
        line("X-Page", text("page_id")),
        F.when(revisit, points).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        line("Content-Length", block.cast("string")),
        F.lit(CRLF + HTTP),
    )


def write(pages: DataFrame, path: str, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None) -> None:
    """Writes records and payloads under path. captured: the records' date in UTC, ISO 8601.

    Two passes: digests decide what is response and what revisits it; then payloads of chosen rows are stored. Payload
    bytes never travel but from the row that is kept.
    """
    captured = captured or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.regexp_replace(F.col(url).cast("string"), "[\r\n]", "%0A").alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.unhex(F.sha2("payload", 256)), "sha1": base32(F.sha1("payload")), "size": F.octet_length("payload").cast("long")})
    equal = Window.partitionBy("page_id", "url", "digest").orderBy("size")
    plain = stored(rows.select("page_id", "url", "digest", "sha1", "size").withColumn("copy", F.row_number().over(equal)), "pages")
    shared = plain.where(F.col("size") >= least).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("to"), F.count(F.lit(1)).alias("c"))
    shared = stored(shared.where("c > 1").select(F.col("digest").alias("d"), F.col("to.page_id").alias("to_page"), F.col("to.url").alias("to_url")), "shared")
    judged = plain.join(shared.hint("merge"), F.col("digest") == F.col("d"), "left")
    kind = F.when(F.col("d").isNull() | F.col("page_id").eqNullSafe(F.col("to_page")), F.lit("response")).otherwise(F.lit("revisit"))
    judged = judged.withColumns({"kind": kind, "id": record_uri(F.col("page_id"), F.col("url"), F.col("digest"), F.col("copy")), "to_id": record_uri(F.col("to_page"), F.col("to_url"), F.col("digest"), F.lit(1))})
    judged.select("page_id", "digest", header({c: F.col(c) for c in judged.columns}, captured).alias("header")).write.option("compression", "zstd").parquet(f"{path}/records")
    # each digest's bytes once, from one response; the join is by page, so common payloads gather nowhere, and its key is
    # never null, so that what drops ties finds the rows dealt as it needs them
    pk = F.coalesce("page_id", F.lit(-(1 << 63))).alias("pk")
    keep = judged.where("kind = 'response'").select(pk, "digest").groupBy("digest").agg(F.max("pk").alias("pk"))
    chosen = rows.select(pk, "digest", "payload").join(keep.hint("merge"), ["pk", "digest"], "left_semi")
    chosen.dropDuplicates(["pk", "digest"]).select("digest", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    dropped(plain, shared)


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records (page_id, digest, header) and payloads (digest, payload)."""
    records = spark.read.schema("page_id long, digest binary, header string").parquet(f"{path}/records")
    return records, spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")


def field(header: Column, name: str) -> Column:
    """A header's value, null if it isn't there."""
    got = F.regexp_extract(header, rf"\n{name}: ([^\r\n]*)", 1)
    return F.when(got != "", got)


def reconstruct(spark: SparkSession, path: str, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The columns to keep, and record: the exact bytes of every record. Responses meet their payloads in a join; revisits have none."""
    records, payloads = read(spark, path)
    end, own = F.lit(CRLF + CRLF).cast("binary"), F.col("header").cast("binary")
    response = field(F.col("header"), "WARC-Type") == "response"
    full = records.where(response).join(payloads.hint("merge"), "digest", "left").select(*keep, F.concat(own, F.col("payload"), end).alias("record"))
    return full.unionByName(records.where(~response).select(*keep, F.concat(own, end).alias("record")))


def export(spark: SparkSession, path: str, target: str) -> None:
    """Plain WARC files: a record's end is the writer's line separator. Payloads are UTF-8, so text is exact."""
    records, payloads = read(spark, path)
    body = F.when(field(F.col("header"), "WARC-Type") == "response", F.col("payload").cast("string")).otherwise(F.lit(""))
    records.join(payloads, "digest").select(F.concat("header", body).alias("value")).write.option("lineSep", CRLF + CRLF).text(target)


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """What the archives say of every page, by records that were put together again.

    A response's payload is what its record's bytes hold between the header block and the two line ends; its digests and
    length are taken from there and held against the header. A revisit takes them from the response with its payload.
    A record that doesn't agree fails the job.
    """
    h = F.col("header")
    whole = reconstruct(spark, path, ("page_id", "digest", "header"))
    body = F.substring("record", F.octet_length("header") + 1, F.greatest(F.octet_length("record") - F.octet_length("header") - 4, F.lit(0)))
    response = field(h, "WARC-Type") == "response"
    named = whole.select("page_id", "digest", field(h, "WARC-Type").alias("record_type"), field(h, "X-Refers-To-Page").alias("to"), field(h, "WARC-Payload-Digest").alias("said"), field(h, "X-Payload-Length").cast("long").alias("long"), F.col("record").isNull().alias("lost"), F.when(response, body).alias("body"))
    sha256, sha1 = F.unhex(F.sha2("body", 256)), base32(F.sha1("body"))
    read_back = stored(named.select("page_id", "digest", "record_type", "to", "said", "long", "lost", sha256.alias("sha256"), sha1.alias("sha1"), F.octet_length("body").cast("long").alias("bytes")), "records-read")
    facts = read_back.where("record_type = 'response' and not lost").select(F.col("digest").alias("d"), F.col("sha256").alias("_sha256"), F.col("sha1").alias("payload_digest"), F.col("bytes").alias("payload_bytes")).dropDuplicates(["d"])
    revisits = read_back.where("record_type = 'revisit'").join(facts.hint("merge"), F.col("digest") == F.col("d"), "left").drop("d")
    responses = read_back.where("record_type = 'response'").withColumns({"_sha256": F.col("sha256"), "payload_digest": F.col("sha1"), "payload_bytes": F.col("bytes")})
    columns = ["page_id", "digest", "record_type", "to", "said", "long", "_sha256", "payload_digest", "payload_bytes"]
    every = responses.select(*columns).unionByName(revisits.select(*columns))
    agrees = (F.col("_sha256") == F.col("digest")) & (F.col("said") == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (F.col("long") == F.col("payload_bytes"))
    checked = F.when(F.coalesce(agrees, F.lit(False)), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("payload and header disagree: "), F.coalesce("said", F.lit("no header")))).cast("long"))
    return every.select("page_id", checked.alias("payload_bytes"), "payload_digest", "record_type", F.col("to").cast("long").alias("refers_to"))


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes the pages' archives to the shared folder and reads them back."""
    spark, path = pages.sparkSession, new_path(pages.sparkSession, "warc")
    write(pages, path, least)
    return catalogue(spark, path)
