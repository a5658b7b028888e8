"""Zone tables as Parquet folders, and warehouse tables over JDBC."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


#: What the folders of a reload are named, and the mark of those with all their rows.
NEW, COMPLETE = ".new-", "_COMPLETE"


def folder(root: str, zone: str, table: str) -> str:
    return f"{root.rstrip('/')}/{zone}/{table}"


def located(spark: SparkSession, path: str) -> tuple:
    """The path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = located(spark, path)
    return fs.exists(p)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at `path`, or an empty one of the same schema before its first write."""
    found = standing(spark, path)
    if found is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(found)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


@dataclass(frozen=True)
class FolderTable:
    """A published table kept as a folder of Parquet files."""

    path: str

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        return read_table(spark, self.path, schema)

    def append(self, df: DataFrame) -> None:
        append(df, self.path)

    def as_stored(self, spark: SparkSession) -> DataFrame | None:
        """The table with the columns its files have; None before its first write."""
        return spark.read.parquet(self.path) if exists(spark, self.path) else None


@dataclass(frozen=True)
class BucketedTable:
    """A published table of the session's catalogue, bucketed by its key.

    Looking up keys then shuffles the new batch only, never the rows published
    in all the time before. Each append adds one file per bucket.
    """

    name: str
    key: str
    buckets: int

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        if spark.catalog.tableExists(self.name):
            return spark.table(self.name)
        return spark.createDataFrame([], schema)

    def append(self, df: DataFrame) -> None:
        rows = df.repartition(self.buckets, self.key)
        writer = rows.write.mode("append").format("parquet")
        writer.bucketBy(self.buckets, self.key).saveAsTable(self.name)

    def as_stored(self, spark: SparkSession) -> DataFrame | None:
        return spark.table(self.name) if spark.catalog.tableExists(self.name) else None


@dataclass(frozen=True)
class SnapshotTable:
    """A table of which only the newest snapshot may exist: an older one is deleted, not kept.

    Each write goes to a numbered folder below `path`; when it is complete, all others are
    deleted. Complete is a snapshot with the marker that is put there after its rows, whatever
    the committer does. A reader sees the highest complete number, so a failed write changes
    nothing, and frames over an earlier snapshot cannot be read after `replace`. Deletion bypasses
    the trash; an object store must keep no versions of this folder.
    """

    path: str
    MARK: ClassVar[str] = COMPLETE

    def _folders(self, spark: SparkSession) -> tuple[list[int], list[int]]:
        """Numbers of all snapshot folders and of the complete ones."""
        root, fs = located(spark, self.path)
        if not fs.exists(root):
            return [], []
        names = [f.getPath().getName() for f in fs.listStatus(root)]
        numbers = sorted(int(n.removeprefix("snapshot-")) for n in names if n.startswith("snapshot-"))
        marks = (self.MARK, "_SUCCESS")  # the second: snapshots of earlier versions
        complete = [n for n in numbers if any(exists(spark, f"{self._folder(n)}/{m}") for m in marks)]
        return numbers, complete

    def _folder(self, number: int) -> str:
        return f"{self.path.rstrip('/')}/snapshot-{number}"

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        numbers, complete = self._folders(spark)
        if not complete:
            if len(numbers) > 1:
                raise RuntimeError(f"{self.path} has snapshots, but none that is complete")
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._folder(complete[-1]))

    def replace(self, df: DataFrame) -> None:
        spark = df.sparkSession
        numbers, _ = self._folders(spark)
        number = numbers[-1] + 1 if numbers else 1
        df.write.parquet(self._folder(number))
        mark, fs = located(spark, f"{self._folder(number)}/{self.MARK}")
        fs.create(mark, False).close()
        self.remove_older(spark)

    def remove_older(self, spark: SparkSession) -> None:
        """Delete all but the newest complete snapshot, also what an interrupted run left."""
        numbers, complete = self._folders(spark)
        for n in numbers:
            if n != complete[-1]:
                old, fs = located(spark, self._folder(n))
                if not fs.delete(old, True):
                    raise OSError(f"could not delete {old}")


def _waiting(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Complete and incomplete folders beside `path` that were written to take its place."""
    target, fs = located(spark, path.rstrip("/"))
    if not fs.exists(target.getParent()):
        return [], []
    prefix = f"{target.getName()}{NEW}"
    found = [f.getPath().toString() for f in fs.listStatus(target.getParent()) if f.getPath().getName().startswith(prefix)]
    complete = [f for f in found if exists(spark, f"{f}/{COMPLETE}")]
    return complete, [f for f in found if f not in complete]


def standing(spark: SparkSession, path: str) -> str | None:
    """Where the rows of the table at `path` lie, None before its first write.

    Between the deletion of the old rows and the renaming of the new ones that is the
    folder of the new ones, also if the writer was lost there.
    """
    if exists(spark, path):
        return path
    complete, _ = _waiting(spark, path)
    return complete[0] if complete else None


def replace(df: DataFrame, path: str) -> None:
    """Truncate and reload: a rerun of the same input leaves the same table.

    The rows are written beside the table and take its place when they are complete, so a
    failed write leaves the old table, and readers by `read_table` find old or new rows at
    any moment. What an earlier writer left is put in place or removed first: a table has
    one writer at a time. `path` may not be read by `df` after that.
    """
    spark = df.sparkSession
    old, fs = located(spark, path)
    fresh, _ = located(spark, f"{path.rstrip('/')}{NEW}{uuid.uuid4().hex}")
    complete, lost = _waiting(spark, path)
    try:
        df.write.parquet(fresh.toString())
        fs.create(located(spark, f"{fresh.toString()}/{COMPLETE}")[0], False).close()
    except Exception:
        fs.delete(fresh, True)
        raise
    if fs.exists(old) and not fs.delete(old, True):
        raise OSError(f"could not delete {old}")
    if not fs.rename(fresh, old):
        raise OSError(f"could not rename {fresh} to {old}")
    for left in (*complete, *lost):
        fs.delete(located(spark, left)[0], True)
    spark.catalog.refreshByPath(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    one_task: bool = False,
) -> DataFrame:
    """A warehouse table, read in parallel ranges of a numeric `column`.

    Without `bounds` the warehouse is asked for the least and the greatest value. Reading
    it all in one task must be asked for.
    """
    if column is None:
        if not one_task:
            raise ValueError("name a numeric column to read by, or set one_task")
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        ends = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) ends"
        bounds = spark.read.jdbc(url, ends, properties=properties).first()
        if bounds[0] is None:
            bounds = (0, 0)
    low, high = bounds
    return spark.read.jdbc(url, table, column, low, high, partitions, properties=properties)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties)


def load_masking_rules(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)
