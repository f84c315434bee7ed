"""Line deduplication by overlapping three-line windows, in DataFrame operations only.

Windows are ``size`` consecutive lines that are not blank. Of equal windows in the whole table the first, by doc_id,
text hash and position, is kept; all lines that later ones cover are removed, overlapping ones merged. Each removed line
has an earlier equal line, so every line stays somewhere. Blank lines and shorter texts stay as they are.

Edges: a null text has no lines and stays null; rows equal in doc_id and text are one document and get one result;
a null doc_id comes first in the order; an empty table gives an empty result; all other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import dropped, stored


def _line_windows(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """doc, text hash, start (among lines that aren't blank), places of the window's lines in the text, digest of the lines."""
    placed = F.transform(F.split(F.col(text), "\n"), lambda x, i: F.struct(i.alias("at"), x.alias("line")))
    lines = F.filter(placed, lambda x: F.trim(x["line"]) != "")
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_hash"), lines.alias("_lines"))
    starts = F.when(F.size("_lines") >= size, F.sequence(F.lit(0), F.size("_lines") - size)).otherwise(F.array().cast("array<int>"))
    at = rows.select("_doc", "_hash", "_lines", F.explode(starts).alias("_start"))
    line = [F.get("_lines", F.col("_start") + j) for j in range(size)]
    digest = F.unhex(F.md5(F.concat_ws("\n", *(x["line"] for x in line)).cast("binary")))
    return at.select("_doc", "_hash", "_start", F.array(*(x["at"] for x in line)).alias("_at"), digest.alias("_digest"))


def later_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Per document with any: the places of its lines that later windows cover, in order."""
    all_windows = stored(_line_windows(docs, doc_id, text, size), "windows")
    place = F.struct("_doc", "_hash", "_start")
    first = all_windows.groupBy("_digest").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    first = stored(first.where("_first <> _last").select(F.col("_digest").alias("_d"), "_first"), "first")
    later = all_windows.join(first.hint("merge"), F.col("_digest") == F.col("_d")).where(~place.eqNullSafe(F.col("_first")))
    spans = later.groupBy("_doc", "_hash").agg(F.collect_set("_at").alias("_all"))
    out = stored(spans.select("_doc", "_hash", F.array_sort(F.array_distinct(F.flatten("_all"))).alias("_gone")), "covered")
    dropped(all_windows, first)
    return out


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """All columns, the text without lines of later windows, and n_lines and n_removed."""
    covered = later_lines(docs, doc_id, text, size)
    keyed = docs.withColumn("_key", F.xxhash64(text))
    joined = keyed.join(covered.hint("merge"), keyed[doc_id].eqNullSafe(covered["_doc"]) & (F.col("_key") == F.col("_hash")), "left")
    # what is kept lies between neighbouring removed lines; the array of lines is made once a row, ahead of the lambdas
    once = F.explode(F.array(F.struct(F.split(F.col(text), "\n").alias("lines"), F.col("_gone").alias("gone"))))
    cut = joined.select(*(joined[c] for c in docs.columns), "_gone", once.alias("_z")).select("*", F.col("_z.lines").alias("_all"))
    before = lambda i: F.coalesce(F.get("_z.gone", i - 1), F.lit(-1))
    after = lambda i: F.coalesce(F.get("_z.gone", i), F.size("_z.lines"))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_z.gone")), lambda i: F.slice("_z.lines", before(i) + 2, after(i) - before(i) - 1)))
    new = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return cut.withColumns({text: new, "n_lines": F.when(F.col("_all").isNull(), 0).otherwise(F.size("_all")).cast("long"), "n_removed": F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("long")}).select(*docs.columns, "n_lines", "n_removed")
