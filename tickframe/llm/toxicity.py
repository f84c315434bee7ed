"""Toxicity by class-conditional Kneser-Ney models.

Two models of the bytes of words, each byte after the five before it in the word, one of toxic and one of ordinary
labelled texts, are counted over all training rows, every occurrence. A class's own discounted counts back off to counts
shared by both classes, so rare expressions favour neither class.
An expression's log ratio is weighed by its own uncertainty: by ``1 - doubt / h``, where h is the G statistic of the
*texts* of both classes that hold it (texts are independent of each other, occurrences in one are not), and by nothing
where h is smaller, where the texts and the occurrences point to different classes, or where the two probabilities differ
by less than a factor of ``least_ratio``. So the weight comes in gradually as evidence does, in small tables as in large.
A text's evidence is the sum of the weighed differences divided by its length. A logistic curve turns it into a score.
It is cross-fitted: each of the three training folds gets its evidence from models of the other two; the models that score
count all three. The backoff does not see classes and is shared by all of them.

How the two settings were chosen without the held-out rows is in the README, with figures.

Every counted expression takes part: counts, contexts and log ratios stay in stored tables. Of the expressions that
differ, the most frequent, at most ``front`` of them, are broadcast; the others meet the texts in a join. ``front``
decides only which way a value takes, not whether it counts.

Edges: null and empty texts have no evidence and get the score of evidence 0; rows without a label only get scores;
several labels of one doc_id count as the highest; without labels of both classes every score is 0; equal rows get equal
scores; an empty table gives an empty result; other columns never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tickframe.llm.common import U64, Bytes, chunks, dropped, full_text, ready, stored

ORDER = 6
SLOTS = 67_108_859  # a prime, so that numpy and Spark find the same slot by a remainder
PARTS = (0, 1, 3)  # the folds that are counted
ALL = len(PARTS)  # the model of all of them; model k leaves out PARTS[k]
GROUPS = [f"{kind}{c}_{k}" for kind in "nq" for k in range(ALL) for c in (0, 1)]  # occurrences and texts of a class in a part


def _plain() -> np.ndarray:
    """Letters in lower case, every digit as 0, other ASCII as a space, other bytes as they are."""
    t = np.arange(256, dtype=np.uint8)
    t[:128] = 32
    t[48:58] = 48
    t[97:123] = np.arange(97, 123)
    t[65:91] = np.arange(97, 123)
    return t


def grams(b: Bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, itself and the five before it in its word as one number (first byte highest), and its document."""
    sizes = np.diff(b.offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    pad = ORDER - 1
    row = np.full(len(b.buf) + pad * (len(sizes) + 1), 32, np.uint8)
    at = np.arange(len(b.buf)) + pad * (doc + 1)
    row[at] = _plain()[b.buf]
    gap = np.maximum.accumulate(np.where(row == 32, np.arange(len(row)), 0))
    before = gap[at - 1]  # the space in front of the word that holds or ends before this byte
    key = np.zeros(len(at), U64)
    for j in range(pad, -1, -1):
        key = (key << U64(8)) | np.where(at - j >= before, row[at - j], np.uint8(32))
    return key, doc


def _counts(rows: DataFrame, most: int = 1 << 19) -> DataFrame:
    """(part int, toxic int, text) -> 6-gram, its occurrences and the texts that hold it by part and class, gram 0 for all bytes and texts; summed within a task as far as memory allows."""
    wide = len(GROUPS) // 2

    def batch_of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        key = np.concatenate([k for k, _ in parts])
        order = np.argsort(key, kind="stable")
        key, n = key[order], np.concatenate([c for _, c in parts])[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, n = key[first], np.add.reduceat(n, first, dtype=np.int64)
        for i in range(0, len(key), 1 << 15):
            cut = slice(i, i + (1 << 15))
            yield pa.RecordBatch.from_arrays([pa.array(key[cut].astype(np.int64)), *(pa.array(n[cut, j]) for j in range(2 * wide))], ["gram", *GROUPS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            part, toxic = (np.asarray(batch.column(j).to_numpy(zero_copy_only=False), np.int64) for j in (0, 1))
            for lo, hi, b in chunks(batch.column(2)):
                group = (2 * part + toxic)[lo:hi]
                key, doc = grams(b)
                key, at = np.unique(key, return_inverse=True)
                held = np.unique(at * (hi - lo) + doc)
                n = np.bincount(at * wide + group[doc], minlength=len(key) * wide).reshape(-1, wide)
                q = np.bincount(held // (hi - lo) * wide + group[held % (hi - lo)], minlength=len(key) * wide).reshape(-1, wide)
                whole = np.concatenate([np.bincount(group[doc], minlength=wide), np.bincount(group, minlength=wide)])
                parts.append((np.append(key, U64(0)), np.vstack([np.hstack([n, q]), whole]).astype(np.int32)))
                size += len(key) + 1
                if size > most:
                    yield from batch_of(parts)
                    parts, size = [], 0
        if parts:
            yield from batch_of(parts)

    got = rows.select("part", "toxic", "text").mapInArrow(run, ", ".join(["gram long", *(f"{g} long" for g in GROUPS)]))
    return got.groupBy("gram").agg(*(F.sum(g).alias(g) for g in GROUPS))


def _tail(k: int) -> Column:
    """The last k bytes of a gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1).cast("long"))


def _context() -> Window:
    """Expressions that differ in their last byte only, 256 at most."""
    return Window.partitionBy(F.shiftright("gram", 8))


def _shared(grams: DataFrame, discount: float) -> tuple[DataFrame, list[DataFrame]]:
    """(gram, shared): probability of the last of five bytes, from discounted counts of distinct bytes to the left, interpolated downwards; and the tables it is read from."""
    levels = [grams]
    for k in range(ORDER - 1, 0, -1):
        levels.append(stored(levels[-1].groupBy(_tail(k).alias("gram")).agg(F.count(F.lit(1)).alias("left")), "suffixes"))
    low = None
    for k, level in enumerate(levels[:0:-1], 1):
        total, followers = F.sum("left").over(_context()), F.count(F.lit(1)).over(_context())
        level = level.select("gram", (F.greatest(F.col("left") - discount, F.lit(0.0)) / total).alias("own"), (discount * followers / total).alias("back"))
        if low is None:
            level = level.withColumn("below", F.lit(1 / 256))
        else:  # a suffix has at most 256 longer ones
            level = level.join(low.select(F.col("gram").alias("suffix"), F.col("shared").alias("below")).hint("merge"), _tail(k - 1) == F.col("suffix"))
        low = level.select("gram", (F.col("own") + F.col("back") * F.col("below")).alias("shared"))
    return low, levels[1:]


def _of(kind: str, c: int, model: int) -> Column:
    """Counts of a class in the parts that a model is made of."""
    return sum((F.col(f"{kind}{c}_{k}") for k in range(ALL) if k != model), F.lit(0)).cast("double")


def log_ratios(counts: DataFrame, totals: Row, discount: float = 0.75, doubt: float = 6.0, least_ratio: float = 2.0) -> DataFrame:
    """Expressions that say something of the class in any of the models, all their occurrences, and for each model the weighed log P(byte | context, toxic) - log P(byte | context, ordinary)."""
    sums, own, found = [], [], []
    for m in range(ALL + 1):
        for c in (0, 1):
            n, total, followers = _of("n", c, m), F.greatest(F.col(f"total{c}_{m}"), F.lit(1.0)), F.col(f"followers{c}_{m}")
            sums += [F.sum(n).alias(f"total{c}_{m}"), F.sum((n > 0).cast("int")).alias(f"followers{c}_{m}")]
            own += [(F.greatest(n - discount, F.lit(0.0)) / total).alias(f"own{c}_{m}"), F.when(followers > 0, discount * followers / total).otherwise(1.0).alias(f"back{c}_{m}")]
        texts = [float(sum(totals[f"q{c}_{k}"] for k in range(ALL) if k != m)) for c in (0, 1)]
        q = [_of("q", c, m) for c in (0, 1)]
        g = 2 * sum(F.when(x > 0, x * F.log(x / ((q[0] + q[1]) * (t / sum(texts))))).otherwise(0.0) for x, t in zip(q, texts, strict=True)) if all(texts) else F.lit(0.0)
        found += [g.alias(f"h_{m}"), (q[1] * texts[0] > q[0] * texts[1]).alias(f"up_{m}")]
    grams = counts.where("gram <> 0")
    shared, read = _shared(grams.select("gram"), discount)
    seen = sum((F.col(f"n{c}_{k}") for c in (0, 1) for k in range(ALL)), F.lit(0)).alias("n")
    some = grams.select("*", *found).where(F.greatest(*(F.col(f"h_{m}") for m in range(ALL + 1))) > doubt).withColumn("context", F.shiftright("gram", 8))
    contexts = grams.groupBy(F.shiftright("gram", 8).alias("context")).agg(*sums)
    differ = some.join(contexts.hint("merge"), "context").select("gram", seen, *(f"{x}_{m}" for x in ("h", "up") for m in range(ALL + 1)), *own)
    both = differ.join(shared.select(F.col("gram").alias("suffix"), "shared").hint("merge"), _tail(ORDER - 1) == F.col("suffix"))
    ratios = []
    for m in range(ALL + 1):
        p = [F.col(f"own{c}_{m}") + F.col(f"back{c}_{m}") * F.col("shared") for c in (0, 1)]
        r, h = F.log(p[1] / p[0]), F.col(f"h_{m}")
        ratios.append(F.when((h > doubt) & (F.abs(r) > float(np.log(least_ratio))) & ((r > 0) == F.col(f"up_{m}")), r * (1 - doubt / h)).otherwise(0.0).cast("float"))
    out = stored(both.select("gram", "n", F.array(*ratios).alias("ratio")).where(F.exists("ratio", lambda x: x != 0)), "ratios")
    dropped(*read)
    return out


class Lookup:
    """Values by 64-bit key: two hashed places for each, the few that fit in neither in order at the side."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(max(len(keys), 1)).bit_length() + 1)
        self.shift = U64(64 - bits)
        self.keys, self.values = np.full(1 << bits, ~U64(0)), np.zeros(1 << bits, values.dtype)
        rest = np.arange(len(keys))
        for salt in (0, 1):
            place = self._place(keys[rest], salt)
            free = np.flatnonzero(self.keys[place] == ~U64(0))
            _, one = np.unique(place[free], return_index=True)
            put = free[one]
            self.keys[place[put]], self.values[place[put]] = keys[rest[put]], values[rest[put]]
            rest = np.delete(rest, put)
        rest = rest[np.argsort(keys[rest])]
        self.more_keys, self.more = keys[rest], values[rest]

    def _place(self, keys: np.ndarray, salt: int) -> np.ndarray:
        return (keys * U64((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)[salt]) ^ (keys >> U64(23))) * U64(0xC2B2AE3D27D4EB4F) >> self.shift

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, 0 for unknown keys."""
        place = self._place(keys, 0)
        out = np.where(self.keys[place] == keys, self.values[place], self.values.dtype.type(0))
        miss = np.flatnonzero(self.keys[place] != keys)
        place = self._place(keys[miss], 1)
        out[miss] = np.where(self.keys[place] == keys[miss], self.values[place], self.values.dtype.type(0))
        if len(self.more_keys):
            i = np.minimum(np.searchsorted(self.more_keys, keys[miss]), len(self.more_keys) - 1)
            found = self.more_keys[i] == keys[miss]
            out[miss[found]] = self.more[i[found]]
        return out


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; 2 is held out, the others are counted. Null ids have none."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def _part() -> Column:
    """The place of a row's fold in PARTS, null for held-out rows and null ids."""
    return F.coalesce(*(F.when(fold_of() == f, k) for k, f in enumerate(PARTS)))


class Model(NamedTuple):
    """Weighed log ratios by key, one for each model: the front in arrays; the rest, if any, as a table, with a bit for each slot that one of its keys is in."""

    keys: np.ndarray
    values: np.ndarray
    rest: DataFrame | None = None
    slots: np.ndarray | None = None


def _split(ratios: DataFrame, front: int) -> Model:
    """The most frequent expressions, at most so many, in front; equal counts (in steps of a sixteenth of a doubling) go one way together."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = sorted(((r[0], r[1]) for r in ratios.groupBy(step).count().collect()), reverse=True)  # some hundreds of rows
    cut, size = None, 0
    for s, n in steps:
        size += n
        if size > front:
            break
        cut = s
    near = ratios.limit(0) if cut is None else ratios.where(step >= cut)
    got = near.select("gram", "ratio").toArrow()
    keys, values = got["gram"].to_numpy().astype(U64), got["ratio"].combine_chunks().flatten().to_numpy().astype(np.float32).reshape(-1, ALL + 1)
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    if size <= front:
        return Model(keys, values)
    rest = stored((ratios if cut is None else ratios.where(step < cut)).select("gram", "ratio"), "rest")
    return Model(keys, values, rest, _slots(rest, F.col("gram")))


def _slots(rows: DataFrame, key: Column) -> np.ndarray:
    """A bit for each slot that a key (not negative) is in, 8 MB for any number of keys."""
    words = rows.select((key % SLOTS).alias("slot")).select(F.floor(F.col("slot") / 64).alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # a million rows at most
    slots = np.zeros(SLOTS // 64 + 1, U64)
    slots[got["word"].to_numpy()] = got["bits"].to_numpy().view(U64)
    return slots


def _in(slots: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (slots[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) == 1


def _key() -> Column:
    """The slot of a row's id."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))


def _training(docs: DataFrame) -> DataFrame:
    """(_slot, doc_id, part, text) of training rows, with a label or not."""
    return docs.select(_key().alias("_slot"), "doc_id", _part().alias("part"), "text").where("part is not null")


def _among(batch: pa.RecordBatch, slots: np.ndarray, at: int) -> pa.RecordBatch:
    """The rows whose slot, in column ``at``, is in."""
    return batch.filter(pa.array(_in(slots, batch.column(at).to_numpy().astype(U64))))


def _labelled(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, part, text) of training rows, without most of those that have no label: so only texts with a label travel to meet theirs."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(_slots(marks, _key()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _among(batch, sent.value, 0).select(["doc_id", "part", "text"])

    return _training(docs).mapInArrow(run, "doc_id long, part int, text string")


def fit(docs: DataFrame, labels: DataFrame, front: int = 1 << 20) -> Model:
    """The weighed log ratios of the models, counted over every labelled row (labels: doc_id once, toxic) outside fold 2."""
    rows = _labelled(docs, labels).join(labels.hint("merge"), "doc_id")  # labels grow with documents: the same plan at every size
    counts = stored(_counts(rows), "grams")
    totals = counts.where("gram = 0").first()
    if not totals or not all(sum(totals[f"q{c}_{k}"] for k in range(ALL)) for c in (0, 1)):
        dropped(counts)
        return Model(np.zeros(0, U64), np.zeros((0, ALL + 1), np.float32))
    ratios = log_ratios(counts, totals)
    model = _split(ratios, front)
    dropped(counts, ratios)
    return model


def _joined(docs: DataFrame, model: Model, text: str, only: np.ndarray | None = None) -> DataFrame:
    """Per digest of a text and model: what the expressions outside the front add to its evidence. Slots rule most others out before they travel."""
    sent = docs.sparkSession.sparkContext.broadcast((model.keys, model.slots, only))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, slots, only = sent.value
        for batch in batches:
            batch = batch if only is None else _among(batch, only, 3)
            for lo, hi, b in chunks(batch.column(2)):
                key, doc = grams(b)
                maybe = np.flatnonzero(_in(slots, key % U64(SLOTS)))
                if len(keys):
                    i = np.minimum(np.searchsorted(keys, key[maybe]), len(keys) - 1)
                    maybe = maybe[keys[i] != key[maybe]]
                once, n = np.unique((key[maybe] << U64(16)) | doc[maybe].astype(U64), return_counts=True)
                at = (once & U64(0xFFFF)).astype(np.int64)
                share = n / np.maximum(np.diff(b.offsets), 1)[at]
                of = [batch.column(j).slice(lo, hi - lo).take(pa.array(at)) for j in (0, 1)]
                yield pa.RecordBatch.from_arrays([*of, pa.array((once >> U64(16)).astype(np.int64)), pa.array(share)], ["_digest", "_model", "gram", "share"])

    pieces = docs.select(_digest(text).alias("_digest"), "_model", full_text(text).alias("_whole"), *_slot_of(only)).mapInArrow(run, "_digest binary, _model int, gram long, share double")
    pieces = stored(pieces.groupBy("_digest", "_model", "gram").agg(F.max("share").alias("share")), "pieces")  # equal texts have equal shares
    value = F.col("share") * F.get("ratio", F.col("_model"))
    out = stored(pieces.join(model.rest.hint("merge"), "gram").groupBy("_digest", "_model").agg(F.sum(value).alias("_more")), "more")
    dropped(pieces)
    return out


def _digest(text: str) -> Column:
    return F.unhex(F.md5(full_text(text).cast("binary")))


def _slot_of(only: np.ndarray | None) -> list[str]:
    return [] if only is None else ["_slot"]


def evidence(docs: DataFrame, model: Model, keep: list[str], text: str = "text", part: str | None = None, only: np.ndarray | None = None) -> DataFrame:
    """The columns to keep, and the length-normalised difference of the two log-likelihoods, for every row; if ``part`` is named, by the model without the row's part.

    With ``only``, a bit for each slot, rows whose ``_slot`` is not in are left out. That is done in the same pass: one of
    its own would take a second Python worker for each task, and Spark keeps as many for all that follows.
    """
    spark = ready(docs.sparkSession)
    sent = spark.sparkContext.broadcast((model.keys, model.values if part else np.ascontiguousarray(model.values[:, ALL]), only))
    named = [*keep, "_digest"] if model.rest is not None else keep
    at = keep.index(text) if text in keep else len(named) + 1  # a text that is kept travels once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, only = sent.value
        if part:
            table, values = Lookup(keys, np.arange(1, len(keys) + 1, dtype=np.int32)), np.vstack([np.zeros((1, ALL + 1), np.float32), values])
        else:  # one model for all rows: its values themselves
            table = Lookup(keys, values)
        for batch in batches:
            batch = batch if only is None else _among(batch, only, batch.num_columns - 1)
            which = batch.column(len(named)).to_numpy()
            for lo, hi, b in chunks(pc.fill_null(batch.column(at), ""), 1 << 18):
                key, doc = grams(b)
                ratio = values[table.get(key), which[lo:hi][doc]] if part else table.get(key)
                z = np.bincount(doc, ratio, hi - lo) / np.maximum(np.diff(b.offsets), 1)
                cut = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*cut.columns[: len(named) + 1], pa.array(z)], [*named, "_model", "evidence"])

    rows = docs.withColumn("_model", (F.col(part) if part else F.lit(ALL)).cast("int"))
    rows = rows if model.rest is None else rows.withColumn("_digest", _digest(text))
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in named), "_model int, evidence double"])
    whole = [] if text in keep else [full_text(text).alias("_whole")]
    out = rows.select(*named, "_model", *whole, *_slot_of(only)).mapInArrow(run, schema)
    if model.rest is None:
        return out.drop("_model")
    more = _joined(rows, model, text, only)
    return out.join(more.hint("merge"), ["_digest", "_model"], "left").select(*keep, (F.col("evidence") + F.coalesce("_more", F.lit(0.0))).alias("evidence"))


def curve(seen: DataFrame) -> tuple[float, float] | None:
    """Logistic curve through (evidence, toxic) by Newton's method, from counts in at most 40,001 bins for each class."""
    bins = seen.groupBy(F.round(F.greatest(F.lit(-2.0), F.least(F.lit(2.0), F.col("evidence"))), 4).alias("z"), "toxic").count().toPandas()
    if bins.toxic.nunique() < 2:
        return None
    n, y = bins["count"].to_numpy(float), bins.toxic.to_numpy(float)
    spread = max(float(np.sqrt(np.average((bins.z - np.average(bins.z, weights=n)) ** 2, weights=n))), 1e-3)
    x = np.stack([np.ones(len(bins)), bins.z.to_numpy() / spread], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.05]), x.T @ (n * (y - p)) - np.array([0, 0.05]) * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1] / spread)


def scored(docs: DataFrame, labels: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", front: int = 1 << 20) -> DataFrame:
    """The columns to keep, evidence and score of every row. The text is read for the counts, the curve and the scores, and never moved but for the counts, and for values outside the front."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), full_text(text).alias("text"))
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    model = fit(rows, marks, front)

    seen = stored(evidence(_training(rows), model, ["doc_id"], part="part", only=_slots(marks, _key())), "evidence")
    line = curve(seen.join(marks.hint("merge"), "doc_id"))
    dropped(seen)
    value = 1 / (1 + F.exp(-(F.lit(line[0]) + line[1] * F.col("evidence")))) if line else F.lit(0.0)
    return evidence(docs, model, keep, text).withColumn("score", value)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, front: int = 1 << 20) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every row."""
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = scored(named, labels, ["doc_id"], front=front)
    return out.select("doc_id", F.coalesce(fold_of() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows that are not scored as toxic, with all their columns."""
    return scored(docs, labels, docs.columns).where(F.col("score") < threshold).select(*docs.columns)
