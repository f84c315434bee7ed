"""Sealed partitions that are published at once (A14, ST8): versions side by side, and one list of what is visible.

    root/data/version=V/KEYS.../part-*   written once, never again
    root/manifests/V                     (KEYS..., version, rows, late_through), one row for each sealed partition
    root/commits/00000007                the name V of the manifest that holds since commit 7
    root/late/batch=B/KEYS.../part-*     rows that came after their partition was sealed

A commit is one file that is renamed to a name that must not be there yet. What stands before it, a crashed write or a
manifest that lost the race, is never read; a reader keeps the files it began with, whatever is published meanwhile.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEYS = ("ticker", "date")


class Superseded(Exception):
    """Another commit has changed what a version was made from."""


class Store:
    """A folder of sealed partitions. ``schema`` has the keys' columns too."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: tuple[str, ...] = KEYS):
        self.spark, self.root, self.keys, self.schema = spark, root.rstrip("/"), list(keys), schema
        self.jvm = spark._jvm
        self.fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list:
        at = self._path(f"{self.root}/{folder}")
        return sorted(self.fs.listStatus(at), key=lambda x: x.getPath().getName()) if self.fs.exists(at) else []

    def commits(self) -> list[int]:
        return [int(n) for n in (x.getPath().getName() for x in self._names("commits")) if n.isdigit()]

    def manifest(self, commit: int | None = None) -> DataFrame:
        """The partitions that are visible since a commit, by default the last one; none before the first."""
        kinds = ", ".join(f"{k} {self.schema[k].dataType.simpleString()}" for k in self.keys)
        kinds = f"{kinds}, version string, rows long, late_through long"
        there = self.commits()
        if not there and commit is None:
            return self.spark.createDataFrame([], kinds)
        at = self._path(f"{self.root}/commits/{there[-1] if commit is None else commit:08}")
        stream = self.fs.open(at)
        try:
            name = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return self.spark.read.schema(kinds).parquet(f"{self.root}/manifests/{name}")

    def read(self, commit: int | None = None) -> DataFrame:
        """The visible rows. Versions that nothing of is visible any more are not listed for the scan, and partition columns prune the rest."""
        live = self.manifest(commit)
        names = [r.version for r in live.select("version").distinct().collect()]  # as many as seals that still show
        if not names:
            return self.spark.createDataFrame([], self.schema)
        fields = StructType([*self.schema.fields]).add("version", "string")
        rows = self.spark.read.schema(fields).option("basePath", f"{self.root}/data").parquet(*(f"{self.root}/data/version={n}" for n in names))
        same = [rows[k].eqNullSafe(live[k]) for k in [*self.keys, "version"]]
        return rows.join(live, same, "left_semi").select(*self.schema.names)

    def write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Writes a version, visible to nobody, and counts what has arrived in each partition: its name and (KEYS..., rows). Spark cuts a hot partition into several files."""
        name, seen = uuid.uuid4().hex, Observation()
        out = rows.select(*self.schema.names)
        out.observe(seen, F.count(F.lit(1)).alias("n")).hint("rebalance", *self.keys).write.partitionBy(*self.keys).parquet(f"{self.root}/data/version={name}")
        there = self.spark.read.schema(self.schema).parquet(f"{self.root}/data/version={name}").groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows"))
        got = there.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
        if got != seen.get["n"]:
            raise ValueError(f"sealed {got} rows of {seen.get['n']}")
        return name, there

    def publish(self, name: str, counts: DataFrame, late_through: int = -1, based_on: int | None = None, tries: int = 20) -> int:
        """Makes a written version's partitions visible in one commit, in place of what they held. If another commit comes first, its list is
        taken up and the next number tried; but what is ``based_on`` a commit fails with Superseded if one of its partitions has changed since."""
        new = counts.select(*self.keys, F.lit(name).alias("version"), "rows", F.lit(late_through).cast("long").alias("late_through"))
        for _ in range(tries):
            there = self.commits()
            number, at = there[-1] + 1 if there else 0, f"{name}-{uuid.uuid4().hex[:8]}"
            old = self.manifest(there[-1]) if there else self.manifest()
            if based_on is not None and there[-1] != based_on and not self._since(based_on, old).join(new.select(*self.keys), self.keys, "left_semi").isEmpty():
                raise Superseded(f"a partition has changed since commit {based_on}")
            o, n = old.alias("o"), new.alias("n")
            both = o.join(n, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys], "full")
            is_new = F.col("n.version").isNotNull()
            put = lambda c, is_new=is_new: F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
            both.select(*(put(c) for c in [*self.keys, "version", "rows"]), F.greatest("n.late_through", "o.late_through").alias("late_through")).write.parquet(f"{self.root}/manifests/{at}")
            if self._commit(number, at):
                return number
        raise RuntimeError(f"{tries} other commits came first")

    def _since(self, commit: int, now: DataFrame) -> DataFrame:
        """Partitions that another version holds now than at a commit."""
        was = self.manifest(commit)
        return now.join(was, [now[k].eqNullSafe(was[k]) for k in self.keys] + [now["version"] == was["version"]], "left_anti")

    def _commit(self, number: int, manifest: str) -> bool:
        self.fs.mkdirs(self._path(f"{self.root}/commits"))
        draft = self._path(f"{self.root}/commits/_{manifest}")
        stream = self.fs.create(draft, True)
        try:
            stream.write(bytearray(manifest.encode()))
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, self._path(f"{self.root}/commits/{number:08}"), options)
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            self.fs.delete(draft, False)
            return False
        return True

    def seal(self, rows: DataFrame) -> int:
        """Writes and publishes the partitions of rows; returns the commit's number."""
        return self.publish(*self.write(rows))

    def land(self, batch: DataFrame, number: int) -> DataFrame:
        """Of a stream's batch: rows of open partitions, which are returned; those of sealed ones go to quarantine (ST8). The same batch again
        puts the same rows in the same place."""
        live = self.manifest()
        same = [batch[k].eqNullSafe(live[k]) for k in self.keys]
        late = batch.join(live, same, "left_semi").select(*self.schema.names)
        late.write.mode("overwrite").partitionBy(*self.keys).parquet(f"{self.root}/late/batch={number}")
        return batch.join(live, same, "left_anti")

    def quarantined(self, commit: int | None = None) -> DataFrame:
        """Late rows, with their batch, that no version has taken up."""
        fields = StructType([*self.schema.fields]).add("batch", "long")
        if not self._names("late"):
            return self.spark.createDataFrame([], fields)
        late = self.spark.read.schema(fields).option("basePath", f"{self.root}/late").parquet(f"{self.root}/late")
        live = self.manifest(commit)
        taken = [*(late[k].eqNullSafe(live[k]) for k in self.keys), late["batch"] <= live["late_through"]]
        return late.join(live, taken, "left_anti")

    def reopen(self, partitions: DataFrame, tries: int = 5) -> int:
        """Merges the late rows of these partitions (KEYS...) into a new version. The commit that shows them also says how far quarantine is
        taken up, so a row is in one of the two at any time."""
        keys = partitions.select(*(F.col(k).alias(f"_{k}") for k in self.keys)).distinct()
        of = lambda df: df.join(keys, [df[k].eqNullSafe(F.col(f"_{k}")) for k in self.keys], "left_semi").select(*self.schema.names)
        for _ in range(tries):
            commit = self.commits()[-1]
            through = max((int(x.getPath().getName().partition("=")[2]) for x in self._names("late")), default=-1)
            late = self.quarantined(commit).where(F.col("batch") <= through)
            name, counts = self.write(of(self.read(commit)).unionByName(of(late)))
            try:
                return self.publish(name, counts, through, commit)
            except Superseded:
                continue
        raise RuntimeError(f"other commits came first {tries} times")

    def vacuum(self, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
        """Removes data of versions that none of the last ``keep`` commits shows and that nobody can still be writing; returns their names."""
        shown: set[str] = set()
        for c in self.commits()[-keep:]:
            shown |= {r.version for r in self.manifest(c).select("version").distinct().collect()}
        gone, before = [], (dt.datetime.now() - older_than).timestamp() * 1000
        for x in self._names("data"):
            name = x.getPath().getName().partition("=")[2]
            if name and name not in shown and x.getModificationTime() <= before:
                self.fs.delete(x.getPath(), True)
                gone.append(name)
        return gone
