"""Spelling variants by a frequency-vector trie: words of a text collection that are one inserted, deleted or replaced code
point apart, and the form that each of them goes back to.

A word is a vector of letter-group counts. One edit adds one to a group at most (a surplus) and takes one from a group at
most (a deficit). Words lie in a trie whose levels are the counts of successive groups; a depth-first search follows each
word's own counts and spends a budget of one surplus and one deficit; what it reaches is compared letter by letter.

The trie is dealt out by its upper levels: a word goes to the branch of its own counts, and as a query to each branch that
its budgets reach. The upper part has as many levels as it takes for the largest branch to hold ``limit`` words; a branch that is
larger even so is searched in blocks of words and blocks of queries, so no task holds more. Of each pair only the shorter
word, or of two equally long ones that of the smaller vector, looks for the other; so a deficit comes after a surplus.

Edges: null and empty texts have no words; a null doc_id hashes as no digits; repeated rows count again; words of any
length are compared whole; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import Bytes, chunks, dropped, full_text, ready, stored

LETTERS = "eaisnrtoludcmpghbfvyqkwxjz"  # levels of the trie, frequent letters first
OTHERS = 6  # groups of all other code points
GROUPS = len(LETTERS) + OTHERS
UPPER = (4, 6, 8, 10, 12)  # levels that the dealing out may use
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
GROUP_OF = {ord(c): i for i, c in enumerate(LETTERS)}


def runs(b: Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of letters A-Z, a-z and U+00C0 to U+00FF, and their documents."""
    inside, lead = LETTER[b.buf], b.buf == 0xC3  # U+00C0 to U+00FF are 0xC3 and one byte more
    inside[lead] = True
    inside[1:][lead[:-1]] = True
    return b.spans(inside)


def counted(batches: Iterator[pa.RecordBatch], every: int, least: int) -> Iterator[pa.RecordBatch]:
    """(doc_id as text, text) -> words of at least ``least`` code points, with their counts in a slice of rows."""
    for batch in batches:
        for lo, hi, b in chunks(batch.column(1), 1 << 22):
            b = b.fold_case()
            s, e, doc = runs(b)
            where, which = b.distinct(s, e)
            data = b.buf.tobytes()
            words = [data[x:y] for x, y in zip(s[where].tolist(), e[where].tolist(), strict=True)]
            total = np.bincount(which, minlength=len(words))
            pair, n = np.unique(doc * len(words) + which, return_counts=True)
            seeds = [zlib.crc32(f"{x}:".encode()) for x in batch.column(0).slice(lo, hi - lo).to_pylist()]
            hashes = np.fromiter((zlib.crc32(words[w], seeds[d]) for d, w in zip((pair // max(len(words), 1)).tolist(), (pair % max(len(words), 1)).tolist(), strict=True)), np.int64, len(pair))
            out: Counter[str] = Counter()
            for k in np.flatnonzero(hashes % every == 0).tolist():
                w = int(pair[k] % len(words))
                total[w] -= n[k]
                word = words[w].decode()
                at = int(hashes[k]) % len(word)
                out[word[:at] + word[at + 1 :]] += int(n[k])
            for w in np.flatnonzero(total).tolist():
                out[words[w].decode()] += int(total[w])
            kept = [(w, k) for w, k in out.items() if len(w) >= least]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([k for _, k in kept], pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, every: int = 97, least: int = 5, least_n: int = 3) -> DataFrame:
    """(word, n) of the words of all texts; where ``every`` divides the CRC of document and word, one letter is dropped first."""
    ready(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), full_text().alias("text"))
    counts = rows.mapInArrow(lambda x: counted(x, every, least), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def vectors(words: list[str]) -> np.ndarray:
    """Counts of the letter groups of each word, a row a word."""
    n = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    known, where = np.unique(points, return_inverse=True)
    group = np.array([GROUP_OF.get(c, len(LETTERS) + c % OTHERS) for c in known.tolist()], np.int64)
    row = np.repeat(np.arange(len(words)), n)
    return np.bincount(row * GROUPS + group[where], minlength=len(words) * GROUPS).reshape(len(words), GROUPS).astype(np.int32) if len(points) else np.zeros((len(words), GROUPS), np.int32)


def branches(v: np.ndarray) -> list[str]:
    return [",".join(map(str, x)) for x in v.tolist()]


def upper_levels(words: DataFrame, limit: int) -> tuple[int, DataFrame]:
    """How many levels deal the trie out, and the stored sizes of the branches: (branch, blocks)."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = vectors(batch.column(0).to_pylist())
            for k in UPPER:
                found, n = np.unique(v[:, :k], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k, np.int32)), pa.array(branches(found), pa.string()), pa.array(n)], ["levels", "branch", "n"])

    every = stored(words.select("word").mapInArrow(sizes, "levels int, branch string, n long").groupBy("levels", "branch").agg(F.sum("n").alias("n")), "branches")
    largest = dict(every.groupBy("levels").agg(F.max("n")).collect())  # a row for each number of levels
    levels = next((k for k in UPPER if largest.get(k, 0) <= limit), UPPER[-1])
    out = stored(every.where(F.col("levels") == levels).select("branch", F.expr(f"cast((n + {limit - 1}) div {limit} as int)").alias("blocks")), "branches")
    dropped(every)
    return levels, out


def dealt(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """A row for each word in its own branch and for each query in each branch that it can reach: (branch, surplus, deficit, word);
    surplus and deficit are what is left of the budgets, null for the words themselves."""
    for batch in batches:
        words, out = batch.column(0).to_pylist(), []
        v = vectors(words)[:, :levels]
        all_rows = np.arange(len(words))

        def put(rows: np.ndarray, vec: np.ndarray, surplus: int | None, deficit: int | None, out=out, words=words) -> None:
            if len(rows):
                out.append(pa.RecordBatch.from_arrays([pa.array(branches(vec), pa.string()), pa.array([surplus] * len(rows), pa.int8()), pa.array([deficit] * len(rows), pa.int8()), pa.array([words[i] for i in rows.tolist()], pa.string())], ["branch", "surplus", "deficit", "word"]))

        put(all_rows, v, None, None)
        put(all_rows, v, 1, 1)
        for i in range(levels):
            more = v.copy()
            more[:, i] += 1
            put(all_rows, more, 0, 1)
            for j in range(i + 1, levels):
                has = np.flatnonzero(v[:, j] > 0)
                both = more[has]
                both[:, j] -= 1
                put(has, both, 0, 0)
        yield from out


def one_edit(a: str, b: str) -> bool:
    """a is not longer than b: one code point replaced, or one more in b."""
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :] and a != b


def halves(words: list[str], less: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and the second half of a partner that is ``less`` shorter, as they would stand at a word's two ends. One
    edit leaves one half as it is."""
    cut = [(max(len(w) - less, 0) // 2, max(len(w) - less, 0)) for w in words]
    first = np.fromiter((hash(w[:h]) for w, (h, _) in zip(words, cut, strict=True)), np.int64, len(words))
    return first, np.fromiter((hash(w[len(w) - (n - h) :]) for w, (h, n) in zip(words, cut, strict=True)), np.int64, len(words))


def search(words: list[str], queries: list[str], surplus: np.ndarray, deficit: np.ndarray, levels: int, step: int = 1 << 19) -> Iterator[tuple[str, str]]:
    """Pairs (query, word) one edit apart, the query shorter, or as long and of the smaller vector, or else the smaller. Words in
    the order of their vectors are the trie; a node is a range of them, known by its first. A range of few words is compared at
    once, others are split by the next group's count."""
    v = vectors(words)
    order = np.lexsort(v.T[::-1])
    v, words = v[order], [words[i] for i in order.tolist()]
    q, n = vectors(queries), np.fromiter(map(len, words), np.int64, len(words))
    nq = np.fromiter(map(len, queries), np.int64, len(queries))
    heads, tails = (np.stack(x) for x in zip(halves(words, 0), halves(words, 1), strict=True))
    head, tail = halves(queries, 0)
    changes = [np.zeros(0, np.int64)] * (GROUPS + 1)  # where a node of that depth ends
    edge = np.zeros(max(len(words) - 1, 0), bool)
    for depth in range(1, GROUPS + 1):
        edge |= v[1:, depth - 1] != v[:-1, depth - 1]
        changes[depth] = np.append(np.flatnonzero(edge) + 1, len(words))
    base = int(max(v.max(initial=0), q.max(initial=0))) + 2
    # a child is found by its parent's first word and its count
    child = [np.zeros(0, np.int64)] * GROUPS
    starts = [np.append(0, c[:-1]) for c in changes[1:]]
    for depth in range(GROUPS):
        parent = np.zeros(len(starts[depth]), np.int64) if depth == 0 else starts[depth - 1][np.searchsorted(starts[depth - 1], starts[depth], side="right") - 1]
        child[depth] = parent * base + v[starts[depth], depth]
    rows = np.arange(len(queries))
    todo = [(levels, rows, np.zeros(len(rows), np.int64), np.full(len(rows), len(words)), surplus.astype(np.int64), deficit.astype(np.int64))]
    while todo:
        depth, who, lo, hi, more, less = todo.pop()
        if len(who) > step:  # depth first: a part at a time, so the front stays small
            half = len(who) // 2
            todo += [(depth, *(x[half:] for x in (who, lo, hi, more, less))), (depth, *(x[:half] for x in (who, lo, hi, more, less)))]
            continue
        small = (hi - lo <= 16) | (depth == GROUPS)
        if small.any():
            size = (hi - lo)[small]
            for x, y in parted(who[small], lo[small], size, step):
                longer = n[y] - nq[x]
                fit = np.flatnonzero((longer == 0) | (longer == 1))
                x, y, longer = x[fit], y[fit], longer[fit]
                fit = np.flatnonzero((heads[longer, y] == head[x]) | (tails[longer, y] == tail[x]))
                x, y, longer = x[fit], y[fit], longer[fit] == 1
                gap = v[y] - q[x]
                up, down = np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1)
                alike = (up == 0) & (down == 0)
                near = (up <= 1) & (down <= 1) & (longer | alike | ((gap > 0).argmax(1) < (gap < 0).argmax(1)))
                for i, j, tie in zip(x[near].tolist(), y[near].tolist(), alike[near].tolist(), strict=True):
                    a, b = queries[i], words[j]
                    if (not tie or a < b) and one_edit(a, b):
                        yield a, b
        keep = ~small
        who, lo, more, less = who[keep], lo[keep], more[keep], less[keep]
        if not len(who):
            continue
        own = q[who, depth]
        for by, may in ((0, lo >= 0), (1, more > 0), (-1, (less > 0) & (own > 0) & (more == 0))):
            can = np.flatnonzero(may)
            key = lo[can] * base + own[can] + by
            at = np.searchsorted(child[depth], key)
            hit = at < len(child[depth])
            hit[hit] = child[depth][at[hit]] == key[hit]
            can, at = can[hit], at[hit]
            if len(can):
                todo.append((depth + 1, who[can], starts[depth][at], changes[depth + 1][at], more[can] - (by > 0), less[can] - (by < 0)))


def parted(who: np.ndarray, lo: np.ndarray, size: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (query, word) of some queries' ranges, about ``step`` at a time; a long range is cut."""
    total = np.append(0, np.cumsum(size))
    for at in range(0, int(total[-1]), step):
        flat = np.arange(at, min(at + step, int(total[-1])))
        row = np.searchsorted(total, flat, side="right") - 1
        yield who[row], lo[row] + flat - total[row]


def near_pairs(words: DataFrame, limit: int = 20_000, most: int = 200_000) -> DataFrame:
    """(word, ...) -> (a, b): every pair of different words one edit apart, once. Up to ``most`` sizes of branches are broadcast."""
    ready(words.sparkSession)
    levels, branch = upper_levels(words, limit)
    rows = words.select("word").mapInArrow(lambda x: dealt(x, levels), "branch string, surplus byte, deficit byte, word string")
    rows = rows.join(F.broadcast(branch) if branch.count() <= most else branch, "branch")  # branches without words have no queries
    one, every = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own, of = F.col("surplus").isNull(), ["branch", "surplus", "deficit", "word"]
    single = rows.where("blocks = 1").select(*of, F.lit(0).alias("x"), F.lit(0).alias("y"))
    split = rows.where("blocks > 1")  # each block of words meets each block of queries
    split = split.where(own).select(*of, one.alias("x"), every.alias("y")).unionByName(split.where(~own).select(*of, every.alias("x"), one.alias("y")))

    def pairs(table: pa.Table) -> pa.Table:
        surplus = table["surplus"].to_numpy()
        word, is_word = table["word"].to_pylist(), np.isnan(surplus)
        ask = np.flatnonzero(~is_word)
        found = list(search([word[i] for i in np.flatnonzero(is_word).tolist()], [word[i] for i in ask.tolist()], surplus[ask], table["deficit"].to_numpy()[ask], levels)) if is_word.any() and len(ask) else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.string()), "b": pa.array([b for _, b in found], pa.string())})

    return single.unionByName(split).groupBy("branch", "x", "y").applyInArrow(pairs, "a string, b string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, by doubling; counts at least double at each step, so a chain has at most 63."""
    out = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(out.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        dropped(out)
        out, moved = after.select("word", "root"), not after.where("moved").isEmpty()
        out.stored_at = after.stored_at
        if not moved:
            return out


def variants(words: DataFrame, limit: int = 20_000) -> DataFrame:
    """(word, n) -> (word, form, root, n, n_near, form_n). The form of a word is its near word of largest n (ties: the smallest),
    if that is at least twice its own."""
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_pairs(words, limit), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    of = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("bn")), "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("bn")).alias("less"), "b")).alias("best"))
    near = words.join(of.withColumnRenamed("a", "word"), "word", "left").withColumn("is", F.col("n") * 2 <= -F.col("best.less"))
    near = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is"), F.col("best.b")).alias("form"), F.when(F.col("is"), -F.col("best.less")).alias("form_n")), "near")
    dropped(pairs, words)
    last = roots(near.where("form is not null"))
    return near.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """All words of docs with their variants' forms: (word, form, root, n, n_near, form_n)."""
    return variants(vocabulary(docs))
