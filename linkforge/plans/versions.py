"""Versions of a folder of tables.

Data of a table never changes in place. A write goes to folders of its own,
``<table>/linkforge_commit=<token>`` (below each partition where the table is
partitioned), which nobody reads yet. ``commit`` then adds one entry to the
log, which names the folders that make up each table from now on. An entry is
written aside and moved to its number; the move fails where that number is
taken. So

* several tables change together or not at all, and a write that fails half-way
  or a job that dies leaves the last version readable;
* a reader that has resolved a table keeps reading that version;
* of two writers that start from one version the second is refused, with
  ``CommitConflict``.

A partitioned table replaces only the partitions it has written; an entry lists
one folder for each partition. ``facts`` of an entry are small values that
belong to the version. ``clean_up`` deletes what the last ``keep`` versions don't
name. The store must have an atomic move that doesn't overwrite (HDFS has; on
object stores that needs a committer with that property).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_versions"
COMMIT_COLUMN = "linkforge_commit"


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the log."""


class TableVersions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    # ------------------------------------------------------------ reading
    def numbers(self) -> list[int]:
        folder = self._path(LOG)
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def head(self) -> dict:
        """The last entry: version, tables (name -> folders) and facts."""
        numbers = self.numbers()
        return self.entry(numbers[-1]) if numbers else {"version": 0, "tables": {}, "facts": {}}

    def entry(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{LOG}/{number:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return name in self.head()["tables"]

    def read(self, name: str, entry: dict | None = None) -> DataFrame:
        """A table as of ``entry`` (the last by default)."""
        folders = (entry or self.head())["tables"].get(name)
        if folders is None:
            raise FileNotFoundError(f"no table {name!r} in {self.root}")
        return self.read_folders(name, folders)

    def read_folders(self, name: str, folders: list[str]) -> DataFrame:
        found = self.spark.read.option("basePath", f"{self.root}/{name}").parquet(*(f"{self.root}/{f}" for f in folders))
        return found.drop(COMMIT_COLUMN)

    # ------------------------------------------------------------ writing
    def write(self, df: DataFrame, name: str, sort_by: str | None = None,
              options: dict[str, str] | None = None) -> list[str]:
        """Stores a whole table; returns its folders, for ``commit``. With
        ``sort_by`` rows are range-partitioned and sorted, so that a lookup by
        that column reads few row groups."""
        if sort_by:
            df = df.repartitionByRange(sort_by).sortWithinPartitions(sort_by)
        folder = f"{name}/{COMMIT_COLUMN}={uuid.uuid4().hex}"
        df.write.options(**(options or {})).parquet(f"{self.root}/{folder}")
        return [folder]

    def write_partitions(self, df: DataFrame, name: str, partition_col: str, kept: list[str]) -> list[str]:
        """Stores the partitions that ``df`` has rows of; returns the folders
        of the table: these, and of ``kept`` those of other partitions."""
        token = uuid.uuid4().hex
        (df.withColumn(COMMIT_COLUMN, F.lit(token)).write.mode("append")
           .partitionBy(partition_col, COMMIT_COLUMN).parquet(f"{self.root}/{name}"))
        found = self._fs.globStatus(self._path(f"{name}/*/{COMMIT_COLUMN}={token}"))
        new = {s.getPath().getParent().getName() for s in found}
        stay = [f for f in kept if f.split("/")[-2] not in new]
        return sorted(stay + [f"{name}/{part}/{COMMIT_COLUMN}={token}" for part in new])

    def commit(self, base: dict, tables: dict[str, list[str] | None], facts: dict | None = None) -> dict:
        """The version after ``base`` with some tables changed (None: dropped)."""
        named = {k: v for k, v in {**base["tables"], **tables}.items() if v is not None}
        entry = {"version": base["version"] + 1, "tables": named, "facts": {**base["facts"], **(facts or {})}}
        aside, place = self._path(f"{LOG}/_{uuid.uuid4().hex}"), self._path(f"{LOG}/{entry['version']:010d}.json")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(entry), "utf-8"))
        out.close()
        options = self._jvm.org.apache.hadoop.fs.Options
        plain = self.spark.sparkContext._gateway.new_array(options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(place), plain)
        except Exception as refused:
            self._fs.delete(aside, False)
            if self._fs.exists(place):
                raise CommitConflict(f"version {entry['version']} of {self.root} is taken") from refused
            raise
        return entry

    def clean_up(self, keep: int = 2) -> int:
        """Deletes entries and folders that the last ``keep`` versions don't
        need; returns how many folders went. Not while another writer is at
        work: what it hasn't committed yet is named by no version."""
        numbers = self.numbers()
        entries = [self.entry(n) for n in numbers[-keep:]]
        needed = {f for e in entries for folders in e["tables"].values() for f in folders}
        gone = 0
        for depth in ("*", "*/*"):
            for status in self._fs.globStatus(self._path(f"{depth}/{COMMIT_COLUMN}=*")) or []:
                parts = status.getPath().toString().split("/")
                folder = "/".join(parts[-(depth.count("*") + 1):])
                if folder not in needed:
                    self._fs.delete(status.getPath(), True)
                    gone += 1
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{LOG}/{n:010d}.json"), False)
        return gone
