"""Phrase collocations by Toivonen's mining: a sample of the texts proposes frequent phrases; a pass over all texts counts
these and their negative border; where the border fails, that is where a phrase turns out frequent that the sample did not
propose, the next pass counts every extension of such phrases as well, which closes the result.

A word's id is a 64-bit hash of its bytes and its language. The words of all texts are counted first, as text, and other
hashes are taken if two of them share an id. A word is proposed if it is frequent. A longer phrase is in the border if its two
parts that are one word shorter are proposed and it is not. The pass over phrases and border sums by a hash of the ids, which
can only make a sum too large; the last pass counts, as tuples of ids and so exactly, what may be frequent by that.

What is proposed travels as a sieve: a bitmap of at most 2^sieve_bits bits at any input size. A phrase that it lets through
by chance is counted besides those that must be; none that must be counted is left out.

Why one further pass is enough: take a frequent phrase that was not counted, and of its parts that are not proposed a
shortest. Its own parts are proposed, so it was in the border, was counted, and is frequent as the whole phrase is: it is one of
the border's failures. The last pass counts all phrases of frequent words with such a failure inside.

Edges: null and empty texts have no words, a null lang is ``und``; repeated rows count again; a very long text is a slice of
its own; equal scores go by count and then by the phrase's bytes; an empty table gives no rows; other columns are left out,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickframe.llm.common import U64, Bytes, _powers, chunks, dropped, full_text, mix, ready, stored

LONGEST = 4
CUT, BLANK = np.zeros(256, bool), np.zeros(256, bool)
CUT[[*b".,;:!?", *range(10, 14)]] = True
BLANK[[32, 9]] = True
COLUMNS = [f"w{i}" for i in range(1, LONGEST + 1)]


def word_hashes(b: Bytes, s: np.ndarray, e: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hashes of the spans, of another kind for each salt; equal bytes give equal hashes wherever they stand."""
    of_byte = mix(np.arange(1, 257, dtype=U64) * U64(2 * salt + 1) * U64(0x9E3779B97F4A7C15))
    up, back = _powers(len(b.buf) + 1)
    sums = np.zeros(len(b.buf) + 1, U64)
    np.cumsum(of_byte[b.buf] * up[: len(b.buf)], out=sums[1:])
    return mix((sums[e] - sums[s]) * back[s] + (e - s).astype(U64))


def words_of(b: Bytes, langs: list[str], salt: int) -> tuple[Bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: the folded bytes, each word's start, end, document and id, and whether another one of its piece follows."""
    b = b.fold_case()
    cut = CUT[b.buf]
    s, e, doc = b.spans(~(cut | BLANK[b.buf]))
    names = sorted(set(langs))
    marks = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in names}
    lang = np.array([marks[x] for x in langs], U64)
    ids = mix(word_hashes(b, s, e, salt) + lang[doc])
    stops = np.cumsum(cut)
    linked = np.zeros(len(s), bool)
    linked[:-1] = (doc[1:] == doc[:-1]) & (stops[s[1:]] == stops[e[:-1] - 1])
    return b, s, e, doc, ids, linked


def hashed(ids: list[np.ndarray]) -> np.ndarray:
    """One hash of each phrase, by its words' ids; the two lowest bits are its length less one."""
    g = np.full(len(ids[0]), len(ids), U64)
    for x in ids:
        g = mix(g * U64(0xC2B2AE3D27D4EB4F) + x)
    return g & ~U64(3) | U64(len(ids) - 1)


class Sieve:
    """Two bits of a bitmap for each phrase it was built from."""

    def __init__(self, cells: bytes, bits: int):
        self.cells, self.bits = np.frombuffer(cells, np.uint8), bits

    @staticmethod
    def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        return (h >> U64(64 - bits)).astype(np.int64), (mix(h ^ U64(0x5851F42D4C957F2D)) >> U64(64 - bits)).astype(np.int64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.places(h, self.bits):
            out &= (self.cells[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out


def sieve(hashes: DataFrame, most_bits: int = 28, block_bits: int = 20):
    """hashes (h) of phrases -> broadcast Sieve of about 16 bits a phrase, at most 2^most_bits in all."""
    spark, n = hashes.sparkSession, hashes.count()
    bits = min(max(13, (16 * n).bit_length()), most_bits)
    block = min(block_bits, bits)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in Sieve.places(np.asarray(batch.column(0)).view(U64), bits):
                yield pa.RecordBatch.from_arrays([pa.array((p >> block).astype(np.int32)), pa.array((p & ((1 << block) - 1)).astype(np.int32))], ["block", "at"])

    def packed(table: pa.Table) -> pa.Table:
        cell = np.zeros(1 << block, np.uint8)
        cell[table["at"].to_numpy()] = 1
        return pa.table({"block": table["block"].slice(0, 1), "cell": pa.array([np.packbits(cell, bitorder="little").tobytes()], pa.binary())})

    cells = np.zeros(1 << (bits - 3), np.uint8)
    for r in hashes.select("h").mapInArrow(places, "block int, at int").distinct().groupBy("block").applyInArrow(packed, "block int, cell binary").collect():  # at most 2^(most_bits - block_bits) blocks
        cells[r.block << (block - 3) : (r.block + 1) << (block - 3)] = np.frombuffer(r.cell, np.uint8)
    return spark.sparkContext.broadcast(Sieve(cells.tobytes(), bits))


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(full_text().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def slices(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[tuple]:
    for batch in batches:
        for lo, hi, b in chunks(batch.column(0), 1 << 20):
            langs = batch.column(1).slice(lo, hi - lo).to_pylist()
            yield langs, *words_of(b, langs, salt)


def strings(b: Bytes, s: np.ndarray, e: np.ndarray) -> pa.Array:
    n = e - s
    offsets = np.append(0, np.cumsum(n)).astype(np.int64)
    at = np.arange(offsets[-1]) + np.repeat(s - offsets[:-1], n)
    return pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(offsets), pa.py_buffer(b.buf[at])).cast(pa.string())


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """Stored (lang, word, id, h, n) of all words, and the salt by which no two of them share an id."""
    for salt in range(1, 9):

        def count(batches: Iterator[pa.RecordBatch], salt=salt) -> Iterator[pa.RecordBatch]:
            for langs, b, s, e, doc, ids, _ in slices(batches, salt):
                names = sorted(set(langs))
                lang = np.array([names.index(x) for x in langs], np.int64)
                _, which = b.distinct(s, e)  # by bytes
                _, first, n = np.unique(which * len(names) + lang[doc], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(lang[doc[first]])), strings(b, s[first], e[first]), pa.array(ids[first].view(np.int64)), pa.array(hashed([ids[first]]).view(np.int64)), pa.array(n)], ["lang", "word", "id", "h", "n"])

        words = texts_of(docs).mapInArrow(count, "lang string, word string, id long, h long, n long").groupBy("lang", "word", "id", "h").agg(F.sum("n").alias("n"))
        words = stored(words, "words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return words, salt
        dropped(words)
    raise RuntimeError("two words share an id under every salt")


class Level:
    """The k-word phrases at some positions of a slice of text: numbers of distinct ones, and their ids."""

    def __init__(self, at: np.ndarray, key: np.ndarray, which: np.ndarray, ids: np.ndarray, k: int):
        self.at = at
        _, first, self.number, self.n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        self.ids = [ids[which[at[first] + j]] for j in range(k)]
        self.h = hashed(self.ids)

    def spread(self, flags: np.ndarray, n: int) -> np.ndarray:
        """flags of distinct phrases at all positions of the slice"""
        out = np.zeros(n, bool)
        out[self.at] = flags[self.number]
        return out

    def sums(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.h.view(np.int64)), pa.array(self.n)], ["h", "n"])

    def rows(self, of: np.ndarray | slice = slice(None)) -> pa.RecordBatch:
        n = self.n[of]
        return pa.RecordBatch.from_arrays([*(pa.array(x[of].view(np.int64)) for x in self.ids), *[pa.nulls(len(n), pa.int64())] * (LONGEST - len(self.ids)), pa.array(n)], [*COLUMNS, "n"])


def ahead(flags: np.ndarray, by: int) -> np.ndarray:
    """flags of the position that is ``by`` further on"""
    out = np.zeros(len(flags), bool)
    out[: max(len(flags) - by, 0)] = flags[by:]
    return out


def levels(which: np.ndarray, ids: np.ndarray, linked: np.ndarray, proposed: Sieve, tested: int) -> Iterator[tuple[int, Level, np.ndarray, np.ndarray, np.ndarray]]:
    """A slice's phrases whose parts that are one word shorter are proposed, by their length; parts of more than ``tested`` words pass
    untested. With each length: where these phrases stand, where words stand that are all proposed, and where a piece goes on so far."""
    n = len(which)
    chain = proposed.holds(hashed([ids]))[which]
    whole = good = chain
    tied, number = np.ones(n, bool), which.astype(np.int64)
    for k in range(2, LONGEST + 1):
        tied = tied & ahead(linked, k - 2)
        whole = whole & ahead(chain, k - 1) & tied
        can = good & ahead(good, 1) & tied
        at = np.flatnonzero(can)
        level = Level(at, number[at] * len(ids) + which[at + k - 1], which, ids, k)
        yield k, level, can, whole, tied
        number = np.zeros(n, np.int64)
        number[at] = level.number
        good = level.spread(proposed.holds(level.h), n) if k <= tested else can


def summed(docs: DataFrame, salt: int, proposed, tested: int, sizes: tuple[int, ...]) -> DataFrame:
    """(h, n): sums over equal hashes of the phrases that ``levels`` finds, of these sizes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, ids, linked in slices(batches, salt):
            ids, which = np.unique(ids, return_inverse=True)
            for k, level, *_ in levels(which, ids, linked, proposed.value, tested):
                if k in sizes and len(level.n):
                    yield level.sums()

    return texts_of(docs).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def counted(docs: DataFrame, salt: int, proposed, often, failed) -> DataFrame:
    """(w1..w4, n): exact counts of the phrases of ``levels`` that may be frequent, and of those that levels leaves out though all their
    words are proposed and a failed phrase is inside."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *_, ids, linked in slices(batches, salt):
            ids, which = np.unique(ids, return_inverse=True)
            holds = np.zeros(len(which), bool)
            for k, level, can, whole, tied in levels(which, ids, linked, proposed.value, LONGEST - 1):
                if len(level.n):
                    yield level.rows(np.flatnonzero(often.value.holds(level.h)))
                holds = (holds | ahead(holds, 1)) & tied  # a failed phrase inside
                more = np.flatnonzero(whole & holds & ~can)
                if len(more):
                    yield Level(more, unique_rows([which[more + j] for j in range(k)], len(ids)), which, ids, k).rows()
                holds |= level.spread(failed.value.holds(level.h), len(which))

    return texts_of(docs).mapInArrow(count, ", ".join(f"{c} long" for c in [*COLUMNS, "n"])).groupBy(*COLUMNS).agg(F.sum("n").alias("n"))


def unique_rows(columns: list[np.ndarray], base: int) -> np.ndarray:
    """A number for each row of columns, equal for equal rows."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = np.unique(key, return_inverse=True)[1] * base + c
    return key


def frequent_phrases(docs: DataFrame, least: int, share: float, slack: float, seed: int, sieve_bits: int) -> tuple[DataFrame, DataFrame]:
    """Stored words (lang, word, id, n), all of them, and stored (w1..w4, n) of each phrase of 2 to 4 words with n >= least."""
    words, salt = vocabulary(docs)
    one = words.where(F.col("n") >= least).select("h")
    cut = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample, enough = docs.where(cut), F.col("n") >= max(1, int(slack * share * least))
    known = sieve(one, sieve_bits)
    two = stored(summed(sample, salt, known, 1, (2,)).where(enough).select("h"), "proposed")
    both = sieve(one.unionByName(two), sieve_bits)
    more = stored(summed(sample, salt, both, 2, (3, 4)).where(enough).select("h"), "proposed")
    proposed = two.unionByName(more)
    whole = sieve(one.unionByName(proposed), sieve_bits)
    often = stored(summed(docs, salt, whole, LONGEST - 1, (2, 3, 4)).where(F.col("n") >= least).select("h"), "often")
    maybe, failed = sieve(often, sieve_bits), sieve(often.join(proposed, "h", "left_anti"), sieve_bits)
    found = stored(counted(docs, salt, whole, maybe, failed).where(F.col("n") >= least), "phrases")
    dropped(two, more, often)
    for x in (known, both, whole, maybe, failed):
        x.unpersist()
    return words, found


def whole_part(a: Column, b: Column, times: int) -> Column:
    """floor(times * a / b) of positive longs, in decimals of 38 digits."""
    return F.call_function("div", a.cast("decimal(38,0)") * F.lit(times).cast("decimal(10,0)"), b.cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, share: float = 0.25, slack: float = 0.67, seed: int = 77, sieve_bits: int = 28) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to 4 words: (lang, rank, phrase, a, l, r, n, score).

    A phrase that occurs ``least`` times is cut where its score, two million times its count over the sum of its parts' counts, is
    lowest; one that lies inside a longer one with four fifths of its count goes. ``share`` of the texts is the sample, in which ``slack``
    times the expected least count proposes a phrase; neither changes the result.
    """
    ready(docs.sparkSession)
    words, found = frequent_phrases(docs, least, share, slack, seed, sieve_bits)
    phrases = found.select(F.array_compact(F.array(*COLUMNS)).alias("w"), F.col("n").alias("a"))
    known = words.where(F.col("n") >= least).select("lang", "word", "id", "n")
    parts = phrases.select("w", F.col("a").alias("n")).unionByName(known.select(F.array("id").alias("w"), "n"))
    cuts = phrases.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")).select("w", "a", "cut", F.slice("w", F.lit(1), F.col("cut")).alias("head"), F.slice("w", F.col("cut") + 1, F.size("w") - F.col("cut")).alias("tail"))
    cuts = cuts.join(parts.select(F.col("w").alias("head"), F.col("n").alias("l")), "head").join(parts.select(F.col("w").alias("tail"), F.col("n").alias("r")), "tail")
    best = cuts.groupBy("w").agg(F.min(F.struct(whole_part(F.col("a"), F.col("l") + F.col("r"), 2_000_000).alias("score"), "cut", "l", "r", "a")).alias("x")).select("w", "x.score", "x.l", "x.r", "x.a")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.slice("w", i, k))))
    above = phrases.where(F.size("w") > 2).select(F.explode(inner).alias("w"), "a").groupBy("w").agg(F.max("a").alias("f"))
    kept = best.join(above, "w", "left").where(F.col("f").isNull() | (F.col("f") < F.col("a") - F.expr("a div 5")))  # 100 f < 80 a
    kept = kept.join(known.select(F.col("id").alias("first"), "lang"), F.col("w")[0] == F.col("first"))
    rank = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    kept = stored(kept.withColumn("place", F.rank().over(rank)).where(F.col("place") <= top).select("lang", "w", "a", "l", "r", "score"), "kept")  # ties at the end stay for now
    spelled = kept.select("lang", "w", F.posexplode("w").alias("i", "id")).join(known.select("id", "word"), "id").groupBy("lang", "w").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    rank = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = kept.join(spelled, ["lang", "w"]).withColumn("rank", F.row_number().over(rank).cast("long")).where(F.col("rank") <= top)
    return out.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
