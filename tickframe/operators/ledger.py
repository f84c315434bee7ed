"""Append-only ledgers: latest entry wins, by sequence, now or as of a day; verdict folds; guards; scrubs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(entries: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The last written entry of each key (D5). One aggregation with map-side combining; no sort, no window."""
    rest = [c for c in entries.columns if c not in keys]
    return entries.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_e")).select(*keys, "_e.*")


def as_of(entries: DataFrame, keys: list[str], day: Column | str, recorded: str = "recorded_on", seq: str = "seq") -> DataFrame:
    """The ledger as it was known on a day: only entries recorded by then."""
    limit = F.lit(day).cast("date") if isinstance(day, str) else day
    return latest(entries.where(F.col(recorded) <= limit), keys, seq)


def quarantine_fold(entries: DataFrame, key: str = "partition", check: str = "check_name", verdict: str = "verdict", seq: str = "seq") -> DataFrame:
    """Per partition: withheld if any check's latest verdict isn't clean, unknown ones included.

    The deciding entry is the first withholding one by position, or else the last written.
    """
    now = latest(entries.select(key, check, verdict, seq), [key, check], seq)
    bad = F.coalesce(F.col(verdict) != "clean", F.lit(True))
    entry = F.struct(seq, check, verdict)
    return now.groupBy(key).agg(F.bool_or(bad).alias("withheld"), F.count(F.lit(1)).alias("checks"), F.coalesce(F.min(F.when(bad, entry)), F.max(entry)).alias("_e")).select(key, "withheld", "checks", F.col(f"_e.{seq}").alias("deciding_seq"), F.col(f"_e.{check}").alias("deciding_check"))


def clear_of_quarantine(rows: DataFrame, fold: DataFrame, key: str = "partition", include_quarantined: bool = False) -> DataFrame:
    """Rows of partitions that are not withheld."""
    return rows if include_quarantined else rows.join(fold.where("withheld").select(key), key, "left_anti")


def guarded_append(current: DataFrame, batch: DataFrame, key: str = "partition", rows: str = "n") -> tuple[DataFrame, DataFrame]:
    """What of a batch may be appended, and what would record fewer rows than the current entry and is refused."""
    prev = current.select(F.col(key).alias("_k"), F.col(rows).alias("_n"))
    judged = batch.join(prev, F.col(key) == F.col("_k"), "left").withColumn("refused", F.coalesce(F.col(rows) < F.col("_n"), F.lit(False)))
    return judged.where("not refused").select(*batch.columns), judged.where("refused").select(*batch.columns, F.col("_n").alias("recorded"))


def transitions(current: DataFrame, findings: DataFrame, keys: list[str], verdict: str = "verdict", person: str = "person") -> DataFrame:
    """Findings that change their check's state; a person's sign-off stands against the battery (Q4).

    current has keys, verdict, provenance; the first finding of a check counts as a change only if it isn't clean.
    """
    now = current.select(*keys, F.col(verdict).alias("_was"), F.col("provenance").alias("_by"))
    joined = findings.join(now, keys, "left")
    change = F.when(F.col("_was").isNull(), F.col(verdict) != "clean").otherwise((F.col(verdict) != F.col("_was")) & (F.col("_by") != person))
    return joined.where(change).select(*findings.columns, F.col("_was").alias("was"))


def sign_off(current: DataFrame, decisions: DataFrame, keys: list[str], verdict: str = "verdict", revoke: bool = False) -> tuple[DataFrame, DataFrame]:
    """A batch of decisions to append, and those that match no open entry (Q5)."""
    open_ = current.where(F.col(verdict) == "clean" if revoke else F.coalesce(F.col(verdict) != "clean", F.lit(True))).select(*keys)
    made = decisions.join(open_, keys, "left_semi").withColumns({verdict: F.lit("quarantined" if revoke else "clean"), "provenance": F.lit("person")})
    return made, decisions.join(open_, keys, "left_anti")


def designed_absences(manifest: DataFrame, trimmed: DataFrame, key: str = "partition") -> DataFrame:
    """Partitions that are gone on purpose: the latest trim line carries the latest manifest digest (C14)."""
    gone = latest(trimmed, [key]).where("kind = 'trim'").select(key, F.col("sha256").alias("_s"))
    return latest(manifest, [key]).join(gone, key).where("sha256 = _s").select(key)


def scrub(manifest: DataFrame, files: DataFrame, absent: DataFrame | None = None, key: str = "partition") -> DataFrame:
    """missing, differs or orphan for whatever of manifest and files doesn't agree."""
    want, have = manifest.select(key, F.col("sha256").alias("recorded")), files.select(key, F.col("sha256").alias("found"))
    both = want.join(have, key, "full_outer")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("recorded").isNull(), "orphan").when(F.col("recorded") != F.col("found"), "differs")
    out = both.withColumn("state", state).where("state is not null")
    if absent is not None:
        out = out.join(absent.select(F.col(key).alias("_k")).withColumn("_gone", F.lit(True)), F.col(key) == F.col("_k"), "left").where("state <> 'missing' or _gone is null").drop("_k", "_gone")
    return out


def divergence(left: DataFrame, right: DataFrame, key: str = "partition", seq: str = "seq") -> DataFrame:
    """One row: the common prefix of two ledgers, entries past it on either side, and foreign partitions of the left tail."""
    l, r = left.select(seq, F.struct(key, "sha256").alias("a")), right.select(seq, F.struct(key, "sha256").alias("b"))
    apart = l.join(r, seq, "full_outer").agg(F.min(F.when(~F.col("a").eqNullSafe(F.col("b")), F.col(seq))).alias("first"), F.max(seq).alias("last"))
    first = F.coalesce(F.col("first"), F.col("last") + 1)
    counts = lambda df, name: df.join(F.broadcast(apart), F.col(seq) >= first).agg(F.count(F.lit(1)).alias(name))
    tail = left.join(F.broadcast(apart), F.col(seq) >= first).select(key, "sha256", seq)
    foreign = latest(tail, [key], seq).join(right.select(key, "sha256"), [key, "sha256"], "left_anti").agg(F.count(F.lit(1)).alias("foreign_partitions"))
    return apart.select(first.alias("prefix_end")).join(counts(left, "left_past")).join(counts(right, "right_past")).join(foreign)


def upload_owed(manifest: DataFrame, mark: int, key: str = "partition", seq: str = "seq") -> DataFrame:
    """Entries at or past the watermark; a segment whose partition has an entry of its own is superseded."""
    whole = manifest.where("kind = 'partition'").select(F.col(key).alias("_p"))
    seg = manifest.where((F.col("kind") == "segment") & (F.col(seq) >= mark)).join(whole, F.col("parent") == F.col("_p"), "left_anti")
    return manifest.where((F.col("kind") == "partition") & (F.col(seq) >= mark)).unionByName(seg)
