"""Set-similarity join on word shingles that skips by the relations between sets.

1. Equal sets become one class; a class's answer holds for all its copies.
2. Classes that share a min-hash anchor are compared with the smallest class of that anchor only. A set found similar
   there takes that set's answers over: both belong to one group, and no comparison inside a group is made again.
3. What is left goes through an inverted index of prefixes. A group has one entry for each shingle and set size, that of
   the best position. Lists are kept in order of size; a block of partners that an entry's position cannot reach is
   skipped as a whole. A list yields pairs of groups, each with one pair of members, not the pairs of members.
4. That pair is held against bitmaps (bits in which two bitmaps differ are never more than the shingles in which the sets
   differ) and then compared exactly. Groups of several members whose pair fails are looked at once more: their leaders'
   difference, less each member's difference from its leader, rules most members out; the others meet by bitmap.

Any order of shingles gives right prefixes. Here all shingles of all texts are counted, and those held three times or more,
of which the ``heavy`` most frequent are known, come last: what many texts share hardly ever opens a list. The bound limits
what is broadcast, and only orders: it drops nothing.

Words are told apart by their bytes, and known across texts by 64 bits of BLAKE2b; a shingle is the mixed sum of its five.

Edges: texts without words have empty sets, link with nothing and are their own component; rows of one doc_id count as
one document; a null doc_id takes the component of its exact copies, or null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import U64, Bytes, chunks, dropped, full_text, mix, ready, runs_of, stored
from tickframe.llm.components import components

ANCHORS = 4


def shingle_sets(b: Bytes, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles in ascending order, and where each document's begin (one more at the end)."""
    f = b.fold_case()
    docs = len(f.offsets) - 1
    s, e, doc = f.spans(~f.spaces())
    words = f.strong(s, e)
    runs = runs_of(words, k)
    same = doc[: len(runs)] == doc[len(words) - len(runs) :] if len(runs) else np.zeros(0, bool)
    h, d = runs[same], doc[: len(runs)][same]
    first = np.searchsorted(doc, np.arange(docs + 1))
    for i in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < k)):
        g = U64(0x51ED270B)
        for w in words[first[i] : first[i + 1]]:
            g = mix(np.array([g], U64) * U64(0xC2B2AE3D27D4EB4F) + w)[0]
        h, d = np.append(h, g), np.append(d, i)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[new], np.searchsorted(d[new], np.arange(docs + 1))


def needed(n, percent: int):
    """Least size of a partner of a set of n, which is also the least overlap."""
    return -(-percent * n // 100)


def heavy_shingles(rows: DataFrame, k: int, heavy: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Counts every shingle over all rows: a shift, and the most frequent shifted shingles with a step of their count each.

    Shingles travel as packed remainders of a bucket; a bucket holds about 2^21 of them at any input size.
    """
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(10, int(size // 6 >> 21).bit_length())  # about a shingle for 6 bytes of text; enough buckets to lie evenly on tasks
    shift = U64(32 - bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
            h = np.sort(np.concatenate(parts) >> shift)
            bucket = (h >> U64(32)).astype(np.int64)
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            rest, cut = h.astype(np.uint32), np.append(first, len(h))
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array([rest[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["bucket", "cell"])

        parts, held = [], 0
        for batch in batches:
            for _, _, b in chunks(batch.column(0)):
                h, _ = shingle_sets(b, k)
                parts.append(h)
                held += len(h)
                if held > 1 << 21:
                    yield packed(parts)
                    parts, held = [], 0
        if held:
            yield packed(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often(bucket: int, cells: list[bytes]) -> Iterator[pa.RecordBatch]:
            rest = np.sort(np.frombuffer(b"".join(cells), np.uint32))
            first = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
            n = np.diff(np.append(first, len(rest)))
            first, n = first[n > 2], n[n > 2]
            yield pa.RecordBatch.from_arrays([pa.array(rest[first].astype(np.int64) + (bucket << 32)), pa.array((2 * np.log2(n)).astype(np.int32))], ["h", "step"])

        at, cells = None, []
        for batch in batches:
            for bucket, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != at and cells:
                    yield from often(at, cells)
                    cells = []
                at = bucket
                cells.append(cell)
        if cells:
            yield from often(at, cells)

    dealt = rows.select("text").mapInArrow(deal, "bucket long, cell binary").repartition("bucket").sortWithinPartitions("bucket")
    counted = stored(dealt.mapInArrow(count, "h long, step int"), "often")
    cut, total = None, 0
    for step, n in sorted(((r[0], r[1]) for r in counted.groupBy("step").count().collect()), reverse=True):  # some dozens of rows
        total += n
        if total > heavy:
            break
        cut = step
    top = (counted.limit(0) if cut is None else counted.where(F.col("step") >= cut)).toArrow()
    dropped(counted)
    keys, steps = top["h"].to_numpy().view(U64), top["step"].to_numpy()
    order = np.argsort(keys)
    return int(shift), keys[order], steps[order].astype(np.uint8)


def bitmap(h: np.ndarray) -> bytes:
    """The parity of hashes in each of 2 to 4 times as many places (a power of two)."""
    bits = 1 << max(6, int(2 * len(h) - 1).bit_length())
    return np.packbits(np.bincount((h & U64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, the longer one folded: at most the size of the sets' symmetric difference."""
    p, q = np.frombuffer(x, U64), np.frombuffer(y, U64)
    while len(p) > len(q):
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    while len(q) > len(p):
        q = q[: len(q) // 2] ^ q[len(q) // 2 :]
    return int(np.bitwise_count(p ^ q).sum())


def may_link(na: int, nb: int, differ: int, percent: int) -> bool:
    return percent * max(na, nb) <= 100 * min(na, nb) and (100 + percent) * differ <= (100 - percent) * (na + nb)


def _with_bits(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs, each side's set size and bitmap after all other columns."""
    side = lambda c: own.select(F.col("node").alias(f"_{c}"), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"bits{c}")).hint("merge")
    both = pairs.join(side("a"), F.col("a") == F.col("_a")).join(side("b"), F.col("b") == F.col("_b"))
    return both.select(*pairs.columns, "na", "nb", "bitsa", "bitsb")


def plausible(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their bitmaps don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [may_link(na, nb, apart(x, y), percent) for na, nb, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), strict=True)]
            kept = batch.filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return _with_bits(pairs.select("a", "b"), own).mapInArrow(run, "a long, b long").distinct()


def _sets(rows: DataFrame, k: int, percent: int, often: tuple[int, np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, set size, digest of the set, min-hash anchors, bitmap, and the prefix in corpus order."""
    sent = rows.sparkSession.sparkContext.broadcast(often)
    salts = mix(np.arange(1, ANCHORS + 1, dtype=U64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift, keys, steps = sent.value
        some = np.zeros(1 << 23, bool)  # rules most other shingles out without a search
        some[(keys & U64(len(some) - 1)).astype(np.int64)] = True
        for batch in batches:
            for lo, hi, b in chunks(batch.column(1)):
                h, first = shingle_sets(b, k)
                n = np.diff(first)
                full = np.flatnonzero(n)
                digest, bits = [None] * (hi - lo), [b""] * (hi - lo)
                for i in full:
                    own = h[first[i] : first[i + 1]]
                    digest[i], bits[i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest(), bitmap(own)
                anchors = np.zeros((hi - lo, ANCHORS), np.int64)
                for j, salt in enumerate(salts):
                    if len(full):
                        anchors[full, j] = np.minimum.reduceat(mix(h ^ salt), first[full]).view(np.int64)
                place = np.zeros(len(h), np.int64)
                if len(keys) and len(h):
                    cut = h >> U64(shift)
                    maybe = np.flatnonzero(some[(cut & U64(len(some) - 1)).astype(np.int64)])
                    at = np.minimum(np.searchsorted(keys, cut[maybe]), len(keys) - 1)
                    known = keys[at] == cut[maybe]
                    place[maybe[known]] = 1 + steps[at[known]].astype(np.int64)
                ordered = h[np.argsort(np.repeat(np.arange(hi - lo) << 8, n) + place, kind="stable")]
                prefix = [ordered[x : x + m].tobytes() for x, m in zip(first[:-1].tolist(), np.where(n > 0, n - needed(n, percent) + 1, 0).tolist(), strict=True)]
                flat = pa.array(anchors.reshape(-1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(digest, pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * ANCHORS, ANCHORS, dtype=np.int32)), flat), pa.array(bits, pa.binary()), pa.array(prefix, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "anchors", "bits", "prefix"],
                )

    return rows.mapInArrow(run, "doc_id long, n_shingles long, digest binary, anchors array<long>, bits binary, prefix binary")


def linked(pairs: DataFrame, rows: DataFrame, k: int, percent: int, most: int = 16) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets are similar enough, compared exactly, and in how many shingles they differ at most.

    Pairs meet where the smallest neighbours of their two sides lie, so a family of texts travels once and not with each
    pair. A place with more than ``most`` pairs is cut into a grid by both sides, ``most`` texts or so of either in a cell.
    """
    pairs = stored(pairs, "pairs")
    least = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("m"))
    least = stored(least.select(F.col("a").alias("x"), F.least("a", "m").alias("m")), "least")
    side = lambda c: least.select(F.col("x").alias(f"x{c}"), F.col("m").alias(f"m{c}"))
    placed = pairs.join(side("a"), F.col("a") == F.col("xa")).join(side("b"), F.col("b") == F.col("xb")).select("a", "b", F.least("ma", "mb").alias("place"))
    placed = stored(placed, "placed")
    large = placed.groupBy("place").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > most).select("place")
    sides = placed.join(large, "place", "left_semi").groupBy("place").agg(*(F.ceil(F.countDistinct(c) / most).alias(f"grid_{c}") for c in "ab")).withColumnRenamed("place", "p")
    cell = lambda c: F.coalesce(F.pmod(F.xxhash64(c), F.col(f"grid_{c}")), F.lit(0))
    cells = stored(sides, "sides")
    dealt = placed.join(cells, F.col("place") == F.col("p"), "left").select("a", "b", "place", cell("a").alias("i"), cell("b").alias("j"))
    dealt = stored(dealt, "dealt")
    wanted = dealt.select("place", "i", "j", F.explode(F.array("a", "b")).alias("w")).distinct()
    texts = rows.join(wanted.hint("merge"), F.col("doc_id") == F.col("w")).select("place", "i", "j", F.col("w").alias("a"), F.lit(None).cast("long").alias("b"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets = None, {}
        for batch in batches:
            place = list(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True))
            a, b = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            found = []
            for lo, hi, data in chunks(batch.column(5)):
                h, first = shingle_sets(data, k)
                for r in range(lo, hi):
                    if place[r] != at:
                        at, sets = place[r], {}
                    if b[r] is None:
                        sets.setdefault(a[r], []).append(h[first[r - lo] : first[r - lo + 1]].copy())
                    else:
                        both = [(len(x) + len(y), shared(x, y)) for x in sets.get(a[r], ()) for y in sets.get(b[r], ())]
                        if any(alike(m, n, percent) for m, n in both):
                            found.append((a[r], b[r], max(m - 2 * n for m, n in both)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["a", "b", "differ"])

    every = texts.unionByName(dealt.withColumn("text", F.lit("")))
    met = every.repartition("place", "i", "j").sortWithinPartitions("place", "i", "j", F.col("b").asc_nulls_first()).select("place", "i", "j", "a", "b", "text")
    out = stored(met.mapInArrow(run, "a long, b long, differ long").groupBy("a", "b").agg(F.max("differ").alias("differ")), "links")
    dropped(pairs, least, placed, cells, dealt)
    return out


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sets, as sorted arrays."""
    if not len(x) or not len(y):
        return 0
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def alike(sizes: int, both: int, percent: int) -> bool:
    """Whether two sets of so many shingles together, and so many in common, reach the similarity."""
    return both > 0 and 100 * both >= percent * (sizes - both)


_ENTRY = [("token", np.uint32), ("node", np.int64), ("group", np.int64), ("n", np.uint32), ("at", np.uint32)]


def best_entries(token: np.ndarray, node: np.ndarray, group: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the entries of one group with the same shingle and set size, the one with the best position, in order of shingle and size.

    What the others could link, this one can, and one pair of members stands for a pair of groups.
    """
    order = np.lexsort((at, group, n, token))
    t, g, m = token[order], group[order], n[order]
    return order[np.append(True, (t[1:] != t[:-1]) | (g[1:] != g[:-1]) | (m[1:] != m[:-1]))] if len(order) else order


def list_pairs(token: np.ndarray, node: np.ndarray, group: np.ndarray, n: np.ndarray, at: np.ndarray, percent: int, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups and members (ga, gb, a, b) that meet in a list and can be similar; at: position of the token in its set's order.

    An entry's position limits its partners' sizes: what follows it in the set must hold the needed overlap. So for each
    entry, as the smaller set, its partners are one block of the list; most blocks are empty and never looked at.
    """
    order = best_entries(token, node, group, n, at)
    token, node, group, n, at = (x[order].astype(np.int64) for x in (token, node, group, n, at))
    if not len(token):
        return
    reach = (100 + percent) * (n - at) // percent - n  # the largest partner
    wide = int(n.max()) * 2 + 2
    place = (np.cumsum(np.append(False, token[1:] != token[:-1])) * wide) + n
    last = np.searchsorted(place, place - n + np.minimum(np.minimum(reach, 100 * n // percent), wide - 1), side="right")
    i = np.flatnonzero(last > np.arange(len(n)) + 1)
    begin, count = i + 1, (last - np.arange(len(n)) - 1)[i]
    while len(i):
        some = max(1, int(np.searchsorted(np.cumsum(count), most, side="right")))
        x, c, first = i[:some], np.minimum(count[:some], most), begin[:some]
        left = np.repeat(x, c)
        right = np.arange(c.sum()) + np.repeat(first - (np.cumsum(c) - c), c)
        ok = (reach[right] >= n[left]) & (group[left] != group[right]) & (node[left] != node[right])
        left, right = left[ok], right[ok]
        swap = group[left] > group[right]
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        yield group[left], group[right], node[left], node[right]
        if some == 1 and count[0] > most:  # a block larger than a step
            begin[0] += most
            count[0] -= most
        else:
            i, begin, count = i[some:], begin[some:], count[some:]


def candidates(classes: DataFrame, percent: int, total: int) -> DataFrame:
    """classes (node, group, n, prefix) -> distinct pairs of groups (ga < gb) of which members a and b share a prefix shingle and may be similar.

    total: prefix entries of all classes, which sets the number of buckets.
    """
    spark = classes.sparkSession
    bits = min(24, max(8, int(total / (1 << 17)).bit_length()))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
            tokens, rest = np.concatenate([x for x, _ in parts]), np.concatenate([y for _, y in parts])
            bucket = ((tokens >> U64(40)) & U64((1 << bits) - 1)).astype(np.int64)
            group = np.where(rest["group"] == 0, -1 - rest["node"], rest["group"])
            order = best_entries(tokens, rest["node"], group, rest["n"], rest["at"])  # a large group sends one entry for each size
            order = order[np.argsort(bucket[order], kind="stable")]
            bucket, rest = bucket[order], rest[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            cut = np.append(first, len(bucket))
            cells = [b"".join(np.ascontiguousarray(rest[name][x:y]).tobytes() for name, _ in _ENTRY) for x, y in zip(cut[:-1], cut[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array(cells, pa.binary())], ["bucket", "cells"])

        parts, size = [], 0
        for batch in batches:
            node, group, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for i, raw in enumerate(batch.column(3).to_pylist()):
                tokens = np.frombuffer(raw, U64)
                one = np.empty(len(tokens), _ENTRY)
                one["token"] = (tokens >> U64(8)).astype(np.uint32)
                one["node"], one["n"], one["at"] = node[i], n[i], np.arange(len(tokens))
                one["group"] = 0 if group[i] == node[i] else group[i] + 1  # zeros pack well
                parts.append((tokens, one))
                size += len(tokens)
                if size > 1 << 20:
                    yield packed(parts)
                    parts, size = [], 0
        if size:
            yield packed(parts)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cells(raw: list[bytes]) -> list[np.ndarray]:
            width = sum(np.dtype(t).itemsize for _, t in _ENTRY)
            out: list[list[np.ndarray]] = [[] for _ in _ENTRY]
            for x in raw:
                m, pos = len(x) // width, 0
                for k, (_, t) in enumerate(_ENTRY):
                    out[k].append(np.frombuffer(x, t, m, pos))
                    pos += m * np.dtype(t).itemsize
            return [np.concatenate(c) for c in out]

        def answer(raw: list[bytes]) -> Iterator[pa.RecordBatch]:
            token, node, group, n, at = cells(raw)
            group = np.where(group == 0, node, group - 1)
            held, size = [], 0

            def flush() -> pa.RecordBatch:
                four = np.concatenate(held)
                order = np.lexsort(four.T[::-1])
                four = four[order]
                four = four[np.append(True, (four[1:, 0] != four[:-1, 0]) | (four[1:, 1] != four[:-1, 1]))]
                return pa.RecordBatch.from_arrays([pa.array(four[:, i]) for i in range(4)], ["ga", "gb", "a", "b"])

            for four in list_pairs(token, node, group, n, at, percent):
                if len(four[0]):
                    held.append(np.stack(four, 1))
                    size += len(four[0])
                    if size > 1 << 18:
                        yield flush()
                        held, size = [], 0
            if held:
                yield flush()

        at, raw = None, []
        for batch in batches:
            for bucket, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if bucket != at and raw:
                    yield from answer(raw)
                    raw = []
                at = bucket
                raw.append(cell)
        if raw:
            yield from answer(raw)

    ready(spark)
    dealt = classes.select("node", "group", "n", "prefix").mapInArrow(entries, "bucket long, cells binary").repartition("bucket").sortWithinPartitions("bucket")
    met = dealt.mapInArrow(lists, "ga long, gb long, a long, b long")
    return met.groupBy("ga", "gb").agg(F.min(F.struct("a", "b")).alias("x")).select("ga", "gb", "x.a", "x.b")


def wider_pairs(undecided: DataFrame, members: DataFrame, own: DataFrame, percent: int, most: int = 256) -> DataFrame:
    """Pairs of groups (ga, gb) -> the pairs (a, b) of their members that may be similar. members: node, group, n, differ from the leader (null: unknown), bits.

    Two members differ in no fewer shingles than their leaders do, less what each differs from its leader. A member that
    this rules out against every one of the other group never travels; the others meet in cells of ``most`` of either side.
    """
    spare = (100 - percent) / (100 + percent)  # of two sets' sizes, what they may differ in
    members = members.select("node", "group", "n", "bits", (F.coalesce("differ", F.lit(1 << 40)) + F.col("n") * spare).alias("room"))
    far = members.groupBy("group").agg(F.max("room").alias("far"))
    side = lambda t, c: t.select(*(F.col(x).alias(f"{x}_{c}") for x in t.columns)).hint("merge")
    leaders = _with_bits(undecided.select(F.col("ga").alias("a"), F.col("gb").alias("b")), own)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = [apart(x, y) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(d, pa.int64())], ["ga", "gb", "d"])

    led = leaders.mapInArrow(differ, "ga long, gb long, d long").groupBy("ga", "gb").agg(F.min("d").alias("d"))
    led = led.join(side(far, "a"), F.col("ga") == F.col("group_a")).join(side(far, "b"), F.col("gb") == F.col("group_b")).select("ga", "gb", "d", "far_a", "far_b")
    pick = lambda c, o: led.join(side(members, c), F.col(f"g{c}") == F.col(f"group_{c}")).where(F.col(f"room_{c}") + F.col(f"far_{o}") + 1e-6 >= F.col("d")).select("ga", "gb", F.lit("ab".index(c)).alias("side"), F.col(f"node_{c}").alias("node"), F.col(f"n_{c}").alias("n"), F.col(f"bits_{c}").alias("bits"))
    both = stored(pick("a", "b").unionByName(pick("b", "a")), "met")
    grid = both.groupBy("ga", "gb").agg(*(F.ceil(F.sum((F.col("side") == i).cast("int")) / most).cast("int").alias(f"g{i}") for i in (0, 1))).select(F.col("ga").alias("xa"), F.col("gb").alias("xb"), "g0", "g1").where("g0 > 0 and g1 > 0")
    rows = both.join(grid.hint("merge"), (F.col("ga") == F.col("xa")) & (F.col("gb") == F.col("xb")))
    mine = F.when(F.col("side") == 0, F.col("g0")).otherwise(F.col("g1"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), mine).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("g1")).otherwise(F.col("g0")) - 1)))
    i, j = F.when(F.col("side") == 0, F.col("mine")).otherwise(F.col("other")), F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("mine"))
    dealt = rows.select("ga", "gb", i.alias("i"), j.alias("j"), "side", "node", "n", "bits").repartition("ga", "gb", "i", "j").sortWithinPartitions("ga", "gb", "i", "j", "side")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, []
        for batch in batches:
            found = []
            for *cell, second, node, n, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if cell != at:
                    at, left = cell, []
                if second:
                    found += [(x, node) for x, m, y in left if may_link(m, n, 0, percent) and may_link(m, n, apart(y, bits), percent)]
                else:
                    left.append((node, n, bits))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    out = stored(dealt.mapInArrow(meet, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "wider")
    dropped(both)
    return out


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, heavy: int = 1 << 20) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable over links) of every row."""
    ready(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), full_text(text).alias("text"))
    sets = stored(_sets(rows, k, percent, heavy_shingles(rows, k, heavy)), "sets")
    copies = stored(sets.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    mine = (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("node"))
    first = copies.select(F.col("digest").alias("d"), "node")
    own = stored(sets.select("doc_id", "digest", "n_shingles", "anchors", "bits").join(first.hint("merge"), mine).select("node", "d", F.col("n_shingles").alias("n"), "anchors", "bits").dropDuplicates(["node", "d"]), "own")
    anchors = own.select("node", F.posexplode("anchors").alias("j", "anchor"))
    least = stored(anchors.groupBy("j", "anchor").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"), "anchors")
    stars = anchors.join(least.hint("merge"), ["j", "anchor"]).where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    near = linked(plausible(stars, own, percent), rows, k, percent)
    groups = components(near)
    grouped = own.join(groups.withColumnRenamed("node", "g"), F.col("node") == F.col("g"), "left").select("node", "d", F.coalesce("component", "node").alias("group"), "n", "bits")
    total = own.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    prefixes = sets.select("doc_id", "digest", "prefix").join(grouped.drop("bits").hint("merge"), mine).dropDuplicates(["node", "d"])
    met = stored(candidates(prefixes, percent, int(total)), "met")
    linked_pairs = linked(plausible(met, own, percent), rows, k, percent)
    # groups of several members, one pair of which does not link: the other members
    several = stored(groups.groupBy("component").agg(F.count(F.lit(1)).alias("c")).select(F.col("component").alias("g")), "several")
    links = linked_pairs.select(F.col("a").alias("la"), F.col("b").alias("lb"))
    undecided = met.join(links.hint("merge"), (F.least("a", "b") == F.least("la", "lb")) & (F.greatest("a", "b") == F.greatest("la", "lb")), "left_anti")
    undecided = undecided.join(several.select(F.col("g").alias("x")).hint("merge"), F.col("ga") == F.col("x"), "left").join(several.select(F.col("g").alias("y")).hint("merge"), F.col("gb") == F.col("y"), "left")
    undecided = stored(undecided.where("x is not null or y is not null").select("ga", "gb"), "undecided")
    more, rest = linked_pairs, ()
    if not undecided.isEmpty():
        led = near.select(F.greatest("a", "b").alias("m"), F.least("a", "b").alias("l"), "differ")
        members = grouped.join(led.hint("merge"), (F.col("node") == F.col("m")) & (F.col("group") == F.col("l")), "left")
        members = members.select("node", "group", "n", "bits", F.when(F.col("node") == F.col("group"), 0).otherwise(F.col("differ")).alias("differ"))
        wide = wider_pairs(undecided, members, own, percent)
        rest = (wide, linked(plausible(wide, own, percent), rows, k, percent))
        more = linked_pairs.unionByName(rest[1])
    named = lambda side: groups.select(F.col("node").alias(f"{side}_"), F.col("component").alias(f"{side}_group"))
    across = more.join(named("a"), F.col("a") == F.col("a_"), "left").join(named("b"), F.col("b") == F.col("b_"), "left")
    wider = components(across.select(F.coalesce("a_group", "a").alias("a"), F.coalesce("b_group", "b").alias("b")))
    both = own.select("node").distinct().join(groups.withColumnRenamed("node", "g"), F.col("node") == F.col("g"), "left").select("node", F.coalesce("component", "node").alias("near"))
    both = both.join(wider.withColumnRenamed("node", "w"), F.col("near") == F.col("w"), "left").select("node", F.coalesce("component", "near").alias("component_id"))
    names = stored(copies.join(both, "node", "left").select(F.col("digest").alias("d"), "component_id"), "named")
    dropped(copies, own, least, near, groups, met, linked_pairs, several, undecided, *rest, wider)
    members = sets.select("doc_id", "n_shingles", "digest").join(names, F.col("digest") == F.col("d"), "left")
    out = members.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out.read_from = (sets, names)
    return out


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows whose doc_id is the smallest of its component, with all their columns; rows without a doc_id stay."""
    found = similar(docs, k=k, percent=percent)
    gone = stored(found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    dropped(*found.read_from)
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["_gone"], "left_anti")
