"""Benchmark decontamination by winnowing, in DataFrame operations only.

A window is ``window`` consecutive words. Its fingerprint is the least hash of the ``gram``-word runs in it, the last of
equal ones, so equal windows have equal fingerprints and every shared span of at least ``window`` words is met.
Neighbouring windows whose least run is the same one are one place with one fingerprint. Places of documents are joined
with the benchmark's fingerprints first; only the windows of places that meet one are then compared, by a 128-bit digest
of all their words, and hits are extended to every word that a matching window covers. An item with fewer words is one
shorter window, looked up at its own length in the same pass.

The benchmark's fingerprints are broadcast only if they are at most ``most`` rows. More are joined by shuffle: a place
then travels as its key, start and fingerprint, and those that meet go back to their documents.
Documents with the same set of matching windows have the same items, which are listed once for each such set.

Edges: null and empty texts have no words and no hits; repeated rows get equal results, rows with one doc_id and
different texts are kept apart; null ids stay null (a null item_id takes part in hits, but not in the list of items);
empty tables give no hits; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import dropped, full_text, lowered, stored

#: Words: digits, letters of either case and everything beyond ASCII; they are lower-cased one by one. What is no part of
#: a word is listed character by character, which the pattern engine looks up in one table, unlike ranges.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
KEY = ["doc_id", "_text_hash"]


def words(text: Column) -> Column:
    """The words as they are written, but all lower case in texts that are ASCII throughout."""
    return F.regexp_extract_all(F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(text), F.lit(WORD), F.lit(0))


def _hashes(text: Column) -> Column:
    """A hash of every lower-cased word of `words`."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.transform("words", lambda w: F.xxhash64(w))).otherwise(F.transform("words", lambda w: F.xxhash64(lowered(w))))


def _split(df: DataFrame, keep: list[str], text: Column) -> DataFrame:
    return df.select(*keep, words(text).alias("words"), text.alias("_t")).select(*keep, "words", _hashes(F.col("_t")).alias("_h"))


def _run(start: Column, n: int) -> Column:
    """One number for n words from start: their hashes, each shifted by its place."""
    return reduce(lambda x, y: x.bitwiseXOR(y), (F.shiftleft(F.get("_h", start + i), i) if i else F.get("_h", start) for i in range(n)))


def places(split: DataFrame, keep: list[str], size: int, gram: int, shorter: list[int], mark: bool = False) -> DataFrame:
    """(keep, words, _h) -> keep, words, start, size and fingerprint of each place: the first window of those that share a least run.

    shorter: lengths of shorter windows, each a place of its own at every word. mark: one more row for each row, at -1.
    """
    gram, n, start = min(gram, size), F.size("words"), F.col("start")
    # the hashes of all runs once a row; what is evaluated for each place then stays small enough to be compiled
    runs = F.when(n >= gram, F.transform(F.sequence(F.lit(0), n - gram), lambda i: _run(i, gram))).otherwise(F.array().cast("array<long>"))
    # one generator for all lengths: only what passes the filter is ever put together as a row
    kinds = 1 + len(shorter)
    at = split.select(*keep, "words", "_h", runs.alias("_g")).select("*", F.explode(F.sequence(F.lit(-1), n * kinds - 1)).alias("_e"))
    kind = F.pmod("_e", F.lit(kinds)) if shorter else F.lit(0)
    at = at.select(*keep, "words", "_h", "_g", F.floor(F.col("_e") / kinds).cast("int").alias("start") if shorter else F.col("_e").alias("start"), F.when(F.col("_e") < 0, 0).otherwise(kind).alias("_kind"))
    own = [F.get("_g", start + j) for j in range(size - gram + 1)]
    least = F.least(*own) if len(own) > 1 else own[0]
    first = F.lit(True)
    if len(own) > 1:  # the least run is the newest one, or the one before has just left
        rest = F.least(*own[:-1]) if len(own) > 2 else own[0]
        first = (start == 0) | (own[-1] <= rest) | (F.get("_g", start - 1) < rest)
    some, length, value = (F.col("_kind") == 0) & (start >= 0) & (start + size <= n) & first, F.lit(size), least
    for i, k in enumerate(shorter, 1):
        own = F.col("_kind") == i
        some = some | (own & (start + k <= n))
        length, value = F.when(own, k).otherwise(length), F.when(own, _run(start, k)).otherwise(value)
    if mark:
        some = some | (start < 0)
    return at.where(some).select(*keep, "words", "start", length.alias("size"), F.when(start >= 0, value).alias("fingerprint"))


def _digest(start: Column, size: Column) -> Column:
    return F.unhex(F.md5(lowered(F.array_join(F.slice("words", start + 1, size), " ")).cast("binary")))


def _items(benchmark: DataFrame, item_id: str, text: str, window: int, gram: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """Every window's digest with its item; the fingerprints of their places; the lengths below the window's."""
    split = stored(_split(benchmark, [item_id], full_text(text)).withColumnRenamed(item_id, "item_id").where(F.size("words") > 0), "items")
    size = F.least(F.size("words"), F.lit(window))
    at = split.select("item_id", "words", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
    digests = stored(at.select("item_id", _digest(F.col("start"), F.col("size")).alias("digest")).distinct(), "item-windows")
    shorter = sorted(r[0] for r in split.where(F.size("words") < window).select(F.size("words")).distinct().collect())  # fewer than `window` numbers
    prints = places(split, ["item_id"], window, gram, []).select("size", "fingerprint")
    for k in shorter:
        prints = prints.unionByName(split.where(F.size("words") == k).select(F.lit(k).alias("size"), _run(F.lit(0), k).alias("fingerprint")))
    prints = stored(prints.distinct(), "prints")
    dropped(split)
    return digests, prints, shorter


def candidates(docs: DataFrame, prints: DataFrame, shorter: list[int], window: int, gram: int, most: int, mark: bool) -> DataFrame:
    """(doc_id, text) -> key, start, size and digest of every window whose place has a fingerprint of the benchmark; with mark, and n_words of each row at start -1."""
    split = _split(docs.withColumn("_text_hash", F.xxhash64("text")), KEY, F.col("text"))
    gram = min(gram, window)
    wanted = prints.select(F.col("size").alias("_s"), F.col("fingerprint").alias("_f"))
    met = (F.col("fingerprint") == F.col("_f")) & (F.col("size") == F.col("_s"))
    if prints.count() <= most:
        found = places(split, KEY, window, gram, shorter, mark).join(F.broadcast(wanted), met, "left").where(F.col("_f").isNotNull() | (F.col("start") < 0))
    else:
        small = places(split, KEY, window, gram, shorter).select(*KEY, "start", "size", "fingerprint")
        some = small.join(wanted.hint("merge"), met, "left_semi").groupBy(*KEY).agg(F.collect_set(F.struct("start", "size")).alias("at"))
        found = _same(split.select(*KEY, "words"), some, KEY, "left" if mark else "inner")
        at = F.coalesce("at", F.array().cast("array<struct<start:int,size:int>>"))
        if mark:
            at = F.concat(at, F.array(F.struct(F.lit(-1).alias("start"), F.lit(window).alias("size"))))
        found = found.select(*KEY, "words", F.explode(at).alias("_at")).select(*KEY, "words", "_at.start", "_at.size")
    # of a place: its windows, as many as can share its least run
    span = F.when(F.col("size") == window, F.least(F.lit(window - gram), F.size("words") - window - F.col("start"))).otherwise(0)
    offsets = F.when(F.col("start") < 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), span))
    each = found.select(*KEY, "words", "start", "size", F.explode(offsets).alias("_o"))
    at = F.col("start") + F.col("_o")
    n_words = F.when(F.col("start") < 0, F.size("words").cast("long")).alias("n_words")
    return each.select(*KEY, at.alias("start"), "size", F.when(at >= 0, _digest(at, F.col("size"))).alias("digest"), n_words)


def _hits(found: DataFrame, digests: DataFrame) -> DataFrame:
    """Windows that an item has, one row each."""
    known = digests.select(F.col("digest").alias("_d")).distinct()
    return found.where("start >= 0").select(*KEY, "start", "size", "digest").distinct().join(known.hint("merge"), F.col("digest") == F.col("_d"), "left_semi")


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", window: int = 10, gram: int = 5, most: int = 500_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and _text_hash to tell rows of one doc_id apart."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), full_text(text).alias("text"))
    digests, prints, shorter = _items(benchmark, item_id, text, window, gram)
    found = stored(candidates(rows, prints, shorter, window, gram, most, mark=True), "found")
    hits = stored(_hits(found, digests), "hits")
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("size") - 1))))
    windows = F.array_sort(F.collect_set("digest"))
    per_doc = stored(hits.groupBy(*KEY).agg(F.size(covered).cast("long").alias("n_hit"), windows.alias("windows")).withColumn("set", F.sha2(F.array_join(F.transform("windows", lambda d: F.hex(d)), "").cast("binary"), 256)), "per-doc")
    sets = per_doc.groupBy("set").agg(F.first("windows").alias("windows")).select("set", F.explode("windows").alias("w"))
    named = sets.join(digests.hint("merge"), F.col("w") == F.col("digest"))
    listed = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    named = named.groupBy("set").agg(F.countDistinct("item_id").alias("n_items"), F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256")).withColumnRenamed("set", "_set")
    marks = stored(per_doc.join(named.hint("merge"), F.col("set") == F.col("_set")).select(*KEY, "n_hit", "n_items", "items_sha256"), "marks")
    dropped(digests, prints, hits, per_doc)
    out = _same(found.where("start < 0").select(*KEY, "n_words"), marks, KEY, "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(b""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), "_text_hash")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5, most: int = 500_000) -> DataFrame:
    """The rows without a window of the benchmark, with all their columns."""
    digests, prints, shorter = _items(benchmark, "item_id", "text", window, gram)
    found = stored(candidates(docs.select("doc_id", full_text().alias("text")), prints, shorter, window, gram, most, mark=False), "found")
    gone = stored(_hits(found, digests).select(F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h")).distinct(), "contaminated")
    dropped(digests, prints, found)
    return docs.join(gone.hint("merge"), docs["doc_id"].eqNullSafe(gone["_d"]) & (F.xxhash64(full_text()) == gone["_h"]), "left_anti")


def _same(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """A join on keys that may be null."""
    r = right.select(*(F.col(c).alias(f"_r_{c}") if c in key else F.col(c) for c in right.columns))
    on = None
    for k in key:
        one = left[k].eqNullSafe(r[f"_r_{k}"])
        on = one if on is None else on & one
    return left.join(r, on, how).drop(*(f"_r_{k}" for k in key))
