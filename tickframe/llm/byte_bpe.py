"""Byte-level BPE, encoding and decoding.

Pre-tokens are found without a regular expression: every code point gets a class from a table, and the running maximum
(an associative scan of "keep" and "set" functions) tells each position where its run of one class began. Boundaries
follow from the runs. Each different slice of a chunk (told apart by its bytes) is merged once and kept in a per-process
cache. Every id keeps its byte offset; decoding writes each id's bytes at its offset, all ids of a chunk at once.

Edges: null and empty texts have no tokens; characters outside the vocabulary's merges fall back to bytes; equal rows
get equal results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm.common import Bytes, chunks, full_text, ready

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Code points of Unicode's White_Space property; fixed values.
WHITE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
#: Ends of English contractions that are tokens of their own; fixed values.
SHORT = ("s", "t", "re", "ve", "m", "ll", "d")
_TABLE: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The class of every code point; made once in a process."""
    if not _TABLE:
        t = np.full(0x110000, OTHER, np.uint8)
        kinds = {"L": LETTER, "N": NUMBER}
        t[:] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)]
        t[WHITE] = SPACE
        _TABLE.append(t)
    return _TABLE[0]


def boundaries(cp: np.ndarray, doc_start: np.ndarray) -> np.ndarray:
    """True where a pre-token begins. cp: code points of documents end to end; doc_start: True at each one's first."""
    n = len(cp)
    if not n:
        return np.zeros(0, bool)
    kind = class_table()[cp]
    new = doc_start.copy()
    new[0] = True
    new[1:] |= kind[1:] != kind[:-1]
    at = np.arange(n)
    run = np.maximum.accumulate(np.where(new, at, 0))  # where this position's run began
    space = kind == SPACE
    begin = new & ~space
    # a run of white space gives its last character away if something follows in the document
    last = np.zeros(n, bool)  # last of a run
    last[:-1] = new[1:]
    last[-1] = True
    follows = np.zeros(n, bool)
    follows[:-1] = ~doc_start[1:]
    begin |= new & space
    tail = last & space & follows
    begin |= tail
    joins = np.flatnonzero(tail & (cp == 32))  # a plain space belongs to the token after it
    begin[joins + 1] = False
    # contractions: an apostrophe that begins a token, and a letter run after it
    quote = np.flatnonzero((cp == 39) & begin & new)
    quote = quote[quote + 1 < n]
    quote = quote[~doc_start[quote + 1]]
    for end in SHORT:
        fits = quote
        for j, c in enumerate(end, 1):
            fits = fits[fits + j < n]
            fits = fits[(cp[fits + j] == ord(c)) & ((run[fits + j] == fits + 1))]
        begin[fits + 1] = False
        nxt = fits + 1 + len(end)
        begin[nxt[nxt < n]] = True
    return begin


class Encoder:
    """Pair merging by rank over bytes, with a cache of slices."""

    def __init__(self, ranks: dict[bytes, int], most: int = 1 << 18):
        self.ranks, self.most = ranks, most
        self.cache: dict[bytes, np.ndarray] = {}
        self.words = [b""] * (max(ranks.values(), default=-1) + 1)
        for w, r in ranks.items():
            self.words[r] = w
        self.sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.bytes = np.frombuffer(b"".join(self.words), np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes

    def merge(self, piece: bytes) -> np.ndarray:
        got = self.cache.get(piece)
        if got is None:
            if len(self.cache) >= self.most:  # bounded memory; dropped slices are merged anew
                self.cache.clear()
            whole = self.ranks.get(piece)
            got = self.cache[piece] = np.array(self._pairs(piece) if whole is None else [whole], np.uint32)
        return got

    def _pairs(self, piece: bytes) -> list[int]:
        import heapq

        ranks, n = self.ranks, len(piece)
        if n > 64:  # a heap of pairs keeps long runs near-linear
            right, left, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
            end = list(range(1, n + 1))
            heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
            heapq.heapify(heap)
            while heap:
                _, i, stop = heapq.heappop(heap)
                j = right[i] if alive[i] else n
                if not alive[i] or j >= n or end[j] != stop:
                    continue
                alive[j] = False
                end[i], right[i] = end[j], right[j]
                if right[i] < n:
                    left[right[i]] = i
                    if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                        heapq.heappush(heap, (r, i, end[right[i]]))
                if (h := left[i]) >= 0 and (r := ranks.get(piece[h : end[i]])) is not None:
                    heapq.heappush(heap, (r, h, end[i]))
            return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]
        parts = [piece[i : i + 1] for i in range(n)]
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, where = r, i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return [ranks[p] for p in parts]

    def encode(self, b: Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all documents end to end, each document's first id (one more at the end), and each id's byte offset in b."""
        docs = len(b.offsets) - 1
        data = b.buf.tobytes()
        cp = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((b.buf & 0xC0) != 0x80)
        starts = np.zeros(len(cp) + 1, bool)
        first = np.searchsorted(lead, b.offsets)  # documents' first code points
        starts[first] = True
        s = np.flatnonzero(boundaries(cp, starts[:-1]))
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(docs + 1, np.int64), np.zeros(0, np.int64)
        s = lead[s]
        e = np.append(s[1:], len(data))
        where, which = b.distinct(s, e)
        pieces = [self.merge(data[x:y]) for x, y in zip(s[where].tolist(), e[where].tolist(), strict=True)]
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat, base = np.concatenate(pieces), np.concatenate(([0], np.cumsum(size)))
        count = size[which]
        total = np.concatenate(([0], np.cumsum(count)))
        pick = np.arange(total[-1]) - np.repeat(total[:-1] - base[which], count)
        ids = flat[pick]
        token_doc = np.searchsorted(s, b.offsets)  # documents' first slices
        return ids, total[token_doc], self.offsets(ids)

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes:
        """The bytes of the ids, each at its offset; without offsets, one after another."""
        if not len(ids):
            return b""
        if offsets is None:
            offsets = self.offsets(ids)
        sizes = self.sizes[ids]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out = np.zeros(int((offsets + sizes).max()), np.uint8)
        out[place + np.repeat(offsets, sizes)] = self.bytes[place + np.repeat(self.first[ids], sizes)]
        return out.tobytes()


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes, a space, the rank. It is of fixed size; the tokenizer's, not the data's."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str, ranks) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(ranks.value)
    return _ENCODERS[path]


def encode(docs: DataFrame, rank_path: str, text: str = "text", with_offsets: bool = False) -> DataFrame:
    """All columns, with n_tokens and ids (and byte offsets of the ids); ids are the tokenizer library's, without special tokens."""
    spark = ready(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(spark, rank_path))
    rows = docs.withColumn("_whole", full_text(text))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(rank_path, ranks)
        for batch in batches:
            for lo, hi, b in chunks(batch.column(len(names))):
                part = batch.slice(lo, hi - lo)
                ids, first, offsets = enc.encode(b)
                arrays = [part.column(i) for i in range(len(names))]
                arrays += [pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32)))]
                if with_offsets:
                    doc = np.repeat(b.offsets[:-1], np.diff(first))
                    arrays.append(pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(offsets - doc)))
                yield pa.RecordBatch.from_arrays(arrays, [*names, "n_tokens", "ids", *["offsets"] * with_offsets])

    extra = ["n_tokens long", "ids array<int>"] + ["offsets array<long>"] * with_offsets
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), *extra])
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_path: str, ids: str = "ids") -> DataFrame:
    """All columns, with the bytes that the ids stand for."""
    spark = ready(encoded.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(spark, rank_path))

    @F.pandas_udf("binary")
    def to_bytes(column):
        enc = _encoder(rank_path, ranks)
        return column.map(lambda x: None if x is None else enc.decode(np.asarray(x)))

    return encoded.withColumn("decoded", to_bytes(ids))


def digests(docs: DataFrame, rank_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids (little-endian, 32 bits) and of the bytes decoded from them."""
    spark = ready(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(spark, rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(rank_path, ranks)
        for batch in batches:
            for lo, hi, b in chunks(batch.column(1)):
                ids, first, offsets = enc.encode(b)
                text = memoryview(enc.decode(ids, offsets))
                ends = np.append(offsets, len(text))[first].tolist()  # a document's bytes end where its next one's first id stands
                each = [ids[x:y] for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                coded = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]
                plain = [hashlib.sha256(text[x:y]).hexdigest() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(coded), pa.array(plain)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), full_text(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
