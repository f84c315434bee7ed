"""Quality rules with host verdicts.

Each document gets counts and a base verdict from its whole text. Failures are summed by host, and each host's rate is
shrunk with a beta prior fitted to all hosts. Two bounds come from the posterior, `sigmas` deviations below the shrunk rate:

- above the prior's mean, the host is suspect: worse than hosts are, beyond chance. Its documents must meet the rules with
  a margin (``strict`` times the least words, no more than that part of the repeats, few symbols and repeated lines).
- above ``reject_rate``, most of what it has fails: none of its documents is kept.

Edges: null or empty texts have no words and fail the base rule; a null host is a host of its own; equal rows get equal
results; one host, or hosts that all fail or all pass, differ from no prior and get no verdict but by ``reject_rate``;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Bytes, chunks, dropped, full_text, ready, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """A number for each different combination of the keys, by pairing them exactly one after another."""
    out = np.unique(keys[0], return_inverse=True)[1]
    for k in keys[1:]:
        k = np.unique(k, return_inverse=True)[1]
        out = np.unique(out * (k.max(initial=0) + 1) + k, return_inverse=True)[1]
    return out


def _same_runs(words: np.ndarray, k: int) -> np.ndarray:
    """A number for each run of k words, the same for equal runs only: runs of 1, 2, 4 ... words are paired to longer ones."""
    out, size = words, 1
    while size < k:
        step = min(size, k - size)
        out = _numbered(out[: len(out) - step], out[step:])
        size += step
    return out


def text_counts(b: Bytes, window: int = 8) -> dict[str, np.ndarray]:
    """The five counts of each document in b."""
    docs = len(b.offsets) - 1
    per_doc = lambda at, weights=None: np.bincount(at, weights, docs).astype(np.int64)
    inside = ~b.spaces()
    s, e, doc = b.spans(inside)
    starts = np.concatenate(([0], np.cumsum((b.buf & 0xC0) != 0x80)))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[b.buf])))
    # lines that hold a word
    ls, le, ldoc = b.spans(b.buf != 10)
    words_before = np.concatenate(([0], np.cumsum(inside)))
    full = words_before[le] > words_before[ls]
    ls, le, ldoc = ls[full], le[full], ldoc[full]
    first = np.unique(_numbered(b.distinct(ls, le)[1], ldoc), return_index=True)[1]
    # words inside repeated windows
    covered = np.zeros(len(s) + 1, np.int64)
    if len(s) >= window:
        same = doc[: len(s) - window + 1] == doc[window - 1 :]
        at = np.flatnonzero(same)
        run = _numbered(_same_runs(b.distinct(s, e)[1], window)[at], doc[at])
        again = at[np.bincount(run)[run] > 1] if len(at) else at
        np.add.at(covered, again, 1)
        np.add.at(covered, again + window, -1)
    hit = np.cumsum(covered)[:-1] > 0
    return {
        "n_words": per_doc(doc),
        "word_chars": per_doc(doc, starts[e] - starts[s]),
        "n_symbols": symbols[b.offsets[1:]] - symbols[b.offsets[:-1]],
        "n_dup_lines": per_doc(ldoc) - per_doc(ldoc[first]),
        "n_repeat_words": per_doc(doc[hit]),
    }


def with_counts(docs: DataFrame, window: int = 8) -> DataFrame:
    """doc_id and host of every row, with the counts of its whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, b in chunks(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, text_counts(b, window).values())], ["doc_id", "host", *COUNTS])

    ready(docs.sparkSession)
    return docs.mapInArrow(count, "doc_id long, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed(min_words: int = 20, repeat_percent: int = 30) -> F.Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def strict_failed(strict: float = 2.0, min_words: int = 20, repeat_percent: int = 30) -> F.Column:
    """What a document of a suspect host must not show: few words, repeats or repeated lines within a margin of the base rule, a symbol for every eighth letter."""
    return (F.col("n_words") < strict * min_words) | (100 * strict * F.col("n_repeat_words") > repeat_percent * F.col("n_words")) | (8 * F.col("n_symbols") > F.col("word_chars")) | (100 * F.col("n_dup_lines") > repeat_percent * F.col("n_words"))


def host_verdicts(judged: DataFrame, host: str = "host", failed: str = "base_failed", reject_rate: float = 0.5, sigmas: float = 2.0) -> DataFrame:
    """One row per host: failures, documents, the shrunk rate, and whether it is suspect or rejected.

    The prior's mean is the share of failures over all documents, its weight comes from the spread of the hosts' rates
    beyond what chance gives (method of moments). The sums it needs are one row.
    """
    hosts = stored(judged.groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"), F.sum(F.col(failed).cast("long")).alias("host_failed")), "hosts")
    rate = F.col("host_failed") / F.col("host_docs")
    k, n, f, rates, squares, noise = hosts.agg(F.count(F.lit(1)), F.sum("host_docs"), F.sum("host_failed"), F.sum(rate), F.sum(rate * rate), F.sum(1 / F.col("host_docs"))).first()
    mean = (f / n) if n else 0.0
    spread = (squares / k - (rates / k) ** 2) - mean * (1 - mean) * noise / k if k else 0.0
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
    a, b = F.col("host_failed") + mean * weight, F.col("host_docs") + weight
    shrunk = a / b
    low = shrunk - sigmas * F.sqrt(shrunk * (1 - shrunk) / (b + 1))
    out = stored(hosts.select(host, "host_docs", "host_failed", shrunk.alias("host_rate"), (low > mean).alias("host_suspect"), (low > reject_rate).alias("host_rejected")), "verdicts")
    dropped(hosts)
    return out


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", reject_rate: float = 0.5, sigmas: float = 2.0) -> DataFrame:
    """Counts, base verdict, host rate and final verdict of every document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), full_text(text).alias("text"))
    counted = stored(with_counts(rows).withColumn("base_failed", base_failed()), "quality")
    v = host_verdicts(counted, reject_rate=reject_rate, sigmas=sigmas).withColumnRenamed("host", "_host")
    joined = counted.join(v, counted.host.eqNullSafe(v["_host"]), "left")
    kept = ~F.col("base_failed") & ~F.col("host_rejected") & ~(F.col("host_suspect") & strict_failed())
    return joined.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "host", F.round("host_rate", 9).alias("host_rate"), "host_suspect")
