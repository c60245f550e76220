"""Tables that are replaced and appended to in one step, with their older versions.

A version is a small numbered commit file that names the folders its rows lie
in. Rows are written first, to a folder of their own; the commit file is written
beside the others under another name and renamed last, which fails if the number
is taken. So a reader sees the old rows or the new ones, a write that dies leaves
the table as it was, and of two writers that start from one version the second
notices. Folders are removed only by ``vacuum``.

    <path>/_commits/00000000000000000007.json   {"folders": [...], "batches": [...]}
    <path>/data-<unique>/...                    rows, in any file format
    <path>/parts-<unique>/...                   rows in directories by the values of a column
"""

from __future__ import annotations

import json
import posixpath
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnrisk.sources.tables import FILE_FORMATS, Table, unsorted_writes

COMMITS = "_commits"
PLAIN, PARTED = "data-", "parts-"
#: Attempts of an append against other writers.
TRIES = 20
#: Folders younger than this may belong to a write that has not been committed yet.
GRACE_SECONDS = 24 * 3600
VERSION = "version"


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was to become."""


class _Store:
    """The few calls of Hadoop's file system that commits need, made on the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def names(self, folder: str) -> dict[str, float]:
        """What lies in a folder, with times of change in seconds; nothing if it is not there."""
        system, place = self._at(folder)
        if not system.exists(place):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in system.listStatus(place)}

    def text(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, path: str, text: str) -> None:
        """A whole file under a name that nobody has yet, or ``Conflict``."""
        folder, name = posixpath.split(path)
        other = posixpath.join(folder, f".{name}-{uuid.uuid4().hex}")
        system, place = self._at(other)
        stream = system.create(place, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), self._conf)
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            files.rename(place, target, self._gateway.new_array(kind, 0))
        except Py4JJavaError as error:
            system.delete(place, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(path) from None
            raise

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)


@dataclass(frozen=True)
class Commit:
    """One version: its folders, and the batches that have been appended since it was replaced."""

    number: int
    folders: tuple[str, ...] = ()
    batches: tuple[str, ...] = ()


@dataclass(frozen=True)
class Versioned(Table):
    """A table of files at ``path`` with versions. Same use as ``Table``."""

    def __post_init__(self):
        if not self.path or self.name or self.bucket_by or self.format not in FILE_FORMATS:
            raise ValueError("versions need a path and a file format")

    def folders(self, spark: SparkSession) -> list[str]:
        """The folders that hold the latest version's rows."""
        found = self.commit(spark)
        return [posixpath.join(self.path, f) for f in found.folders] if found else []

    def _file(self, number: int) -> str:
        return posixpath.join(self.path, COMMITS, f"{number:020}.json")

    def numbers(self, spark: SparkSession) -> list[int]:
        """The versions there are, the oldest first."""
        names = _Store(spark).names(posixpath.join(self.path, COMMITS))
        return sorted(int(n.removesuffix(".json")) for n in names if n[0] != "." and n.endswith(".json"))

    def commit(self, spark: SparkSession, number: int | None = None) -> Commit | None:
        """A version, by default the latest; None if there is none."""
        numbers = self.numbers(spark)
        if number is None:
            number = numbers[-1] if numbers else 0
        if number not in numbers:
            return None
        kept = json.loads(_Store(spark).text(self._file(number)))
        return Commit(number, tuple(kept["folders"]), tuple(kept["batches"]))

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.numbers(spark))

    def read(
        self, spark: SparkSession, schema: StructType | None = None, number: int | None = None
    ) -> DataFrame:
        """The rows of a version, by default the latest. Later commits do not change the frame."""
        found = self.commit(spark, number)
        if found is None:
            raise FileNotFoundError(f"{self.path} has no version {'' if number is None else number}")
        return self._load(spark, found.folders, schema)

    def _load(self, spark: SparkSession, folders: tuple[str, ...], schema: StructType | None) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if schema is not None:
            reader = reader.schema(schema)
        # A folder with directories inside is a table of its own for Spark; the others are one.
        parted = [[f] for f in folders if f.startswith(PARTED)]
        plain = [f for f in folders if not f.startswith(PARTED)]
        frames = [
            reader.load([posixpath.join(self.path, f) for f in group]) for group in [*parted, plain] if group
        ]
        return reduce(DataFrame.unionByName, frames)

    def _put(self, df: DataFrame, partition_by: str | None = None) -> str:
        """Rows in a folder of their own, which no version names yet."""
        folder = f"{PARTED if partition_by else PLAIN}{uuid.uuid4().hex}"
        writer = df.write.format(self.format).options(**self.options)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with unsorted_writes(df.sparkSession):
            writer.save(posixpath.join(self.path, folder))
        return folder

    def _switch(self, spark: SparkSession, new: Commit) -> None:
        text = json.dumps({"folders": new.folders, "batches": new.batches})
        _Store(spark).put_new(self._file(new.number), text)

    def replace(self, df: DataFrame, partition_by: str | None = None) -> None:
        """The frame as the whole table. It may read this table itself."""
        self._replace(df, partition_by, keep_batches=False)

    def _replace(self, df: DataFrame, partition_by: str | None, keep_batches: bool) -> None:
        spark, folder = df.sparkSession, self._put(df, partition_by)
        for _ in range(TRIES):
            last = self.commit(spark) or Commit(0)
            batches = last.batches if keep_batches else ()
            try:
                return self._switch(spark, Commit(last.number + 1, (folder,), batches))
            except Conflict:
                # Whoever replaces last wins, whatever came in between.
                continue
        raise Conflict(f"{self.path}: {TRIES} times another writer was faster")

    def append(self, df: DataFrame, batch: str | None = None) -> None:
        """Add the frame's rows to whatever the latest version is; a batch that is in it adds nothing."""
        spark = df.sparkSession
        if self._has(spark, batch):
            return
        folder = self._put(df)
        for _ in range(TRIES):
            last = self.commit(spark) or Commit(0)
            if batch is not None and batch in last.batches:
                return
            if self._added(spark, last, folder, batch):
                return
        raise Conflict(f"{self.path}: {TRIES} times another writer was faster")

    def append_checked(
        self, make: Callable[[DataFrame | None], DataFrame], schema: StructType, batch: str | None = None
    ) -> None:
        """Append what ``make`` makes of the present rows, and only to these rows.

        If another writer commits meanwhile, the rows are made anew from what is
        there then. So two runs at once cannot both add a row that either of
        them would have left out.
        """
        spark = SparkSession.active()
        for _ in range(TRIES):
            last = self.commit(spark) or Commit(0)
            if batch is not None and batch in last.batches:
                return
            present = self._load(spark, last.folders, schema) if last.folders else None
            if self._added(spark, last, self._put(make(present)), batch):
                return
        raise Conflict(f"{self.path}: {TRIES} times another writer was faster")

    def _has(self, spark: SparkSession, batch: str | None) -> bool:
        last = self.commit(spark)
        return bool(batch is not None and last and batch in last.batches)

    def _added(self, spark: SparkSession, last: Commit, folder: str, batch: str | None) -> bool:
        batches = last.batches if batch is None else (*last.batches, batch)
        try:
            self._switch(spark, Commit(last.number + 1, (*last.folders, folder), batches))
        except Conflict:
            return False
        return True

    def compact(self, spark: SparkSession, schema: StructType | None = None) -> None:
        """The same rows in one folder, for a table of many small appends.

        Appends that are committed meanwhile are a conflict: nothing changes then.
        """
        last = self.commit(spark)
        if last is None or len(last.folders) < 2:
            return
        folder = self._put(self._load(spark, last.folders, schema).hint("rebalance"))
        self._switch(spark, Commit(last.number + 1, (folder,), last.batches))

    def vacuum(
        self, spark: SparkSession, keep: int = 2, grace_seconds: float = GRACE_SECONDS
    ) -> list[str]:
        """Remove all versions but the latest ``keep``, and folders that none of these names.

        Young folders stay: their writers may not have committed yet. Gives the
        folders that are gone.
        """
        if keep < 1:
            raise ValueError("the latest version stays")
        store, numbers = _Store(spark), self.numbers(spark)
        kept = [self.commit(spark, n) for n in numbers[-keep:]]
        named = {folder for commit in kept for folder in commit.folders}
        for number in numbers[:-keep]:
            store.delete(self._file(number))
        oldest = time.time() - grace_seconds
        gone = [
            name
            for name, changed in store.names(self.path).items()
            if name.startswith((PLAIN, PARTED)) and name not in named and changed <= oldest
        ]
        for name in gone:
            store.delete(posixpath.join(self.path, name))
        return sorted(gone)

    def history(self, spark: SparkSession, schema: StructType | None = None) -> DataFrame:
        """All rows of all versions there are, with the version's number as ``version``."""
        frames = [
            self.read(spark, schema, n).withColumn(VERSION, F.lit(n).cast("long"))
            for n in self.numbers(spark)
        ]
        return reduce(DataFrame.unionByName, frames)
