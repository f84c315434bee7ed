"""What the corpus operators share: row keys, scratch tables, and hashing of whole Arrow text columns with numpy.

Tables that cut lineage go to the folder in ``spark.checkpoint.dir``, which driver and executors share.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
U64 = np.uint64
_LOCAL: dict[str, str] = {}  # folders of local sessions that name none


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers of a local session import this package; clusters ship it with their own settings."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it. Only a local session, whose threads share the
    machine, gets a temporary one if it names none; on a cluster the setting is asked for."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        base = _LOCAL.get(app) or tempfile.mkdtemp(prefix="spark-")
        _LOCAL[app] = base
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage is cut and the size is known to the planner."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables that stored() wrote and nothing will read again."""
    for t in tables:
        spark = t.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def lowered(text: Column) -> Column:
    """A-Z only, unlike lower(), which changes other scripts too; plain ASCII texts take the fast way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def full_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x9FB21C651E98DF25)
    x = x ^ (x >> U64(28))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_STEP = U64(0x2545F4914F6CDD1D)
_BACK = U64(pow(int(_STEP), -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x632BE59BD9B4E019))
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        m = max(n, 1 << 20)
        for k, base in enumerate((_STEP, _BACK)):
            p = np.full(m, base, U64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


_STRONG: dict[bytes, int] = {}


class Bytes:
    """Some documents' UTF-8 bytes end to end; hashes of any span by differences of one running sum.

    These hashes only sort spans into groups; ``distinct`` holds every span's bytes against its group's first.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets = buf, offsets
        self._sums: np.ndarray | None = None

    def fold_case(self) -> Bytes:
        up = (self.buf >= 65) & (self.buf <= 90)
        return Bytes(self.buf + (up.view(np.uint8) << 5), self.offsets)

    def spaces(self) -> np.ndarray:
        return (self.buf == 32) | ((self.buf >= 9) & (self.buf <= 13))

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and document of each longest run of True within one document."""
        n = len(inside)
        if not n:
            e = np.zeros(0, np.int64)
            return e, e, e
        edge = np.zeros(n + 1, bool)
        edge[self.offsets[:-1]] = True
        edge[n] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        return s, e, np.searchsorted(self.offsets, s, side="right") - 1

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """64-bit hashes of the spans; equal bytes give equal hashes wherever they stand."""
        if self._sums is None:
            p, _ = _powers(len(self.buf) + 1)
            self._sums = np.zeros(len(self.buf) + 1, U64)
            np.cumsum(_BYTE[self.buf] * p[: len(self.buf)], out=self._sums[1:])
        back = _powers(len(self.buf) + 1)[1]
        return mix((self._sums[e] - self._sums[s]) * back[s] + (e - s).astype(U64))


    def distinct(self, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One span of each different content, and for every span the number of its content. Equal means equal bytes."""
        _, where, which = np.unique(self.hashes(s, e), return_index=True, return_inverse=True)
        if not len(s):
            return where, which
        n, first = e - s, where[which]
        odd = n != n[first]
        at = np.arange(n.sum()) + np.repeat(s - (np.cumsum(n) - n), n)
        apart = self.buf[at] != self.buf[at + np.repeat(np.where(odd, 0, s[first] - s), n)]
        if apart.any():
            odd[np.repeat(np.arange(len(s)), n)[apart]] = True
        if odd.any():  # equal hashes of different bytes
            data, more, new = self.buf.tobytes(), {}, []
            for i in np.flatnonzero(odd).tolist():
                key = data[s[i] : e[i]]
                if key not in more:
                    more[key] = len(where) + len(new)
                    new.append(i)
                which[i] = more[key]
            where = np.append(where, new)
        return where, which

    def strong(self, s: np.ndarray, e: np.ndarray, most: int = 1 << 18) -> np.ndarray:
        """64 bits of BLAKE2b of each span; computed once for each different content, and kept for later ones."""
        where, which = self.distinct(s, e)
        data, out = self.buf.tobytes(), []
        if len(_STRONG) > most:  # bounded memory
            _STRONG.clear()
        for x, y in zip(s[where].tolist(), e[where].tolist(), strict=True):
            key = data[x:y]
            got = _STRONG.get(key)
            if got is None:
                got = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")
                if y - x <= 64:
                    _STRONG[key] = got
            out.append(got)
        return np.array(out, U64)[which] if out else np.zeros(0, U64)


def chunks(column, limit: int = 1 << 19) -> Iterator[tuple[int, int, Bytes]]:
    """Slices of an Arrow string column of about ``limit`` bytes (a longer text is a slice of its own): first row, end row, bytes."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = min(lo + (1 << 15), max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1))
        yield lo, hi, Bytes(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        lo = hi


def runs_of(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive words, by their hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    g = words[:n].copy()
    for j in range(1, k):
        g = g * U64(0xC2B2AE3D27D4EB4F) + words[j : j + n]
    return mix(g)
