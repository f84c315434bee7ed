"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Base spans are every match of three fixed patterns. Candidates are the values in them (what stands behind a key, an access
key, a run of hex digits) and values of further forms: other keys, URLs with a password, private key blocks, long mixed
tokens. Every candidate's value is hashed and counted over the corpus by distinct repositories and owners. A value that
more than ``max_owners`` owners or ``max_repos`` repositories hold is a widely copied example. One that is specific to its
owners and looks alive (long enough, letters and digits, or of a form that says so) is added as a `live` span over the
value. Base spans always stay.

An owner is the `source` of a document; a repository is a source's documents in one language. Over the given documents
nine of ten values have one owner, nearly all others two, and the rest form a tail up to every owner there is; hence the
bounds of two.

Matches become rows before they are placed: a running sum of lengths over a document's matches gives positions, so a text
of many matches costs no more for each of them.

Edges: null and empty texts have no spans; rows equal in doc_id and text get equal results (each row's owner counts),
other rows of a doc_id are kept apart; a null doc_id is a document; null sources and languages are one owner; equal spans
of several forms are listed once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import dropped, full_text, stored

#: Patterns, the part that must be long enough (0: the match), and its least length; fixed values, in the order of kinds.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),  # a longest run fails or passes as a whole: the same as `+` and dropping
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
NEXT = "(?=@)"  # what follows a match and is no part of it
#: Forms of further candidates: pattern, the part that is the value (it ends the match), its least length.
FORMS = {
    "named": (r"""(?i)\b(?:pwd|passphrase|credentials?|bearer|(?:private|access|account)_?key|auth(?:orization)?)["']?\x20*[:=]?\x20*["']?([A-Za-z0-9+/_.=-]{8,})""", 1, 8),
    "url": (r"[A-Za-z][A-Za-z0-9+.-]{0,20}://[^\s/:@]{1,200}:([^\s/@]{6,200})" + NEXT, 1, 6),
    "block": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]+", 0, 64),
    "mixed": (r"[A-Za-z0-9+/_=-]{24,}", 0, 24),
}
#: Forms that need no look at their letters.
SURE = ("url", "block", "access")
#: A cheap necessary condition for any base span or candidate.
MAYBE = r"""(?i:pass|pwd|secret|token|key|credential|bearer|auth)|AKIA|://|-----BEGIN|[A-Za-z0-9+/_=-]{24}"""
KEY = ["doc_id", "_hash"]


def _found(text: Column, pattern: str) -> Column:
    """Matches of a pattern, each with the length of what lies before it (split() leaves that between matches)."""
    hits, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    return F.when(F.size(hits) > 0, F.arrays_zip(F.transform(F.slice(between, F.lit(1), F.size(hits)), lambda x: F.length(x)).alias("gap"), hits.alias("hit"))).otherwise(F.array().cast("array<struct<gap:int,hit:string>>"))


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, _hash, owner, repo, text) -> a row for each match of a kind or form: key, owner, repo, form, start and stop of the match, its value."""
    forms = KINDS | FORMS
    each = [F.struct(F.lit(k).alias("form"), _found(F.col("text"), p).alias("found")) for k, (p, _, _) in forms.items()]
    rows = docs.where(F.col("text").rlike(MAYBE)).select(*KEY, "owner", "repo", F.explode(F.array(*each)).alias("_e"))
    rows = rows.select(*KEY, "owner", "repo", F.col("_e.form").alias("form"), F.posexplode("_e.found").alias("_i", "_m")).select(*KEY, "owner", "repo", "form", "_i", "_m.gap", "_m.hit")
    rows = rows.dropDuplicates([*KEY, "owner", "repo", "form", "_i"])  # rows that are the same document
    before = Window.partitionBy(*KEY, "owner", "repo", "form").orderBy("_i")
    value, enough = F.lit(None).cast("string"), F.lit(False)
    for k, (p, group, least) in forms.items():
        got = F.regexp_extract("hit", p.removesuffix(NEXT), group) if group else F.col("hit")
        value, enough = F.when(F.col("form") == k, got).otherwise(value), F.when(F.col("form") == k, F.length("value") >= least).otherwise(enough)
    return rows.select(*KEY, "owner", "repo", "form", F.sum(F.col("gap") + F.length("hit")).over(before).cast("int").alias("stop"), "hit", value.alias("value")).where(enough).select(*KEY, "owner", "repo", "form", (F.col("stop") - F.length("hit")).alias("start"), "stop", "value")


def ownership(values: DataFrame) -> DataFrame:
    """(value, owner, repo) -> owners and repositories that hold each value; a repository belongs to one owner."""
    each = values.select("value", "owner", "repo").distinct().groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return each.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "lang", max_owners: int = 2, max_repos: int = 2, min_live: int = 16) -> DataFrame:
    """Base counts and digests, all spans, and the ownership verdicts, of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repo"), full_text(text).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    v = F.col("value")
    lively = F.col("form").isin(*SURE) | ((F.length(v) >= min_live) & v.rlike("[0-9]") & v.rlike("[A-Za-z]"))
    mixed = (F.col("form") != "mixed") | (v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]"))
    each = matches(rows).where(mixed).withColumns({"lively": lively, "size": F.length(v), "value": F.unhex(F.sha2(v.cast("binary"), 256))})
    each = stored(each, "values")
    # only examples are looked up: what is missing here is specific to its owners
    copied = stored(ownership(each).where((F.col("owners") > max_owners) | (F.col("repos") > max_repos)).select(F.col("value").alias("v")), "examples")
    judged = each.join(copied.hint("merge"), v == F.col("v"), "left").withColumn("example", F.col("v").isNotNull())
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("form")).cast("int")
    base = F.collect_set(F.when(rank > 0, F.struct("start", rank.alias("rank"), F.col("form").alias("kind"), "stop"))).alias("base")
    live = F.struct((F.col("stop") - F.col("size")).alias("start"), F.lit(len(KINDS) + 1).alias("rank"), F.lit("live").alias("kind"), "stop")
    per_doc = judged.groupBy(*KEY).agg(base, F.collect_set(F.when(F.col("lively") & ~F.col("example"), live)).alias("live"), F.collect_set(F.when(F.col("example"), live)).alias("examples"))
    listed = lambda spans: F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    per_doc = stored(per_doc.select(F.col("doc_id").alias("_d"), F.col("_hash").alias("_h"), *(of(k) for k in KINDS), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.concat("base", "live")).alias("spans"), F.size("live").cast("long").alias("n_live"), F.size("examples").cast("long").alias("n_example")), "judged")
    dropped(each, copied)
    out = rows.select(*KEY).join(per_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")), "left")
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", *(none(f"n_{k}") for k in KINDS), F.coalesce("base_sha256", F.sha2(F.lit(b""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), none("n_live"), none("n_example"))
