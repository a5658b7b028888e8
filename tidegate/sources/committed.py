"""Tables that change in one step: data folders, a numbered commit file, and an index of keys.

A write goes to a folder of its own. The table changes when a commit file, which names all
folders it consists of, is renamed into its place; until then readers see the table as it
was, and what a crash left is no part of it. A commit carries the id of the run that made
it, so a run that is repeated writes nothing twice. Old commits stay readable until
`vacuum`.

With a `key`, the rows of each write lie in buckets by the key's hash, and beside them one
Bloom filter per bucket, stored in slices of bounded size. Looking up the keys of a batch
reads the filters first, slice by slice with the keys that fall into it, and then the key
column only of those buckets that a key may lie in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..runtime import ship_package, stage
from .tables import exists, located

#: Folders of a write and, below them, of a bucket: partition columns to Spark.
WRITE, BUCKET = "_write", "_bucket"
#: Number of a filter's slice in the index, and of the part of a bucket's keys that is probed at once.
SLICE, PART = "_slice", "_part"
INDEX = "_index-"
#: A bucket of more rows than this in one write is dealt over several files, each by a task of its own.
FILE_ROWS = 1 << 18
#: How rows are stored with their keys, which are often digests in text: these take half the space so.
COMPACT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: A commit is tried anew so often when others commit at the same time.
TRIES = 50


class CommitConflict(RuntimeError):
    """Others replaced the table while this write was under way."""


@dataclass(frozen=True)
class Commit:
    number: int
    run_id: str
    folders: tuple[str, ...]
    runs: tuple[str, ...]


@dataclass(frozen=True)
class CommittedTable:
    """A table at `path`; `key` and `buckets` add the index, `bits_per_key` sets its precision.

    Every write of an indexed table must have the same number of buckets. With 24 bits a key,
    rounded up to a power of two for the bucket, one of 24,000 absent keys or fewer pass.
    """

    path: str
    key: str | None = None
    buckets: int = 64
    bits_per_key: int = 24

    # --- commits ------------------------------------------------------------

    def _at(self, *parts: str) -> str:
        return "/".join([self.path.rstrip("/"), *parts])

    def commits(self, spark: SparkSession) -> list[int]:
        """Numbers of the commits that stand, ascending."""
        folder, fs = located(spark, self._at("_commits"))
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def commit(self, spark: SparkSession, number: int | None = None) -> Commit:
        """The newest commit, or the one of that number; number 0 before the first write."""
        if number is None:
            number = max(self.commits(spark), default=0)
        if not number:
            return Commit(0, "", (), ())
        path, fs = located(spark, self._at("_commits", f"{number:020d}.json"))
        stream = fs.open(path)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Commit(number, found["run_id"], tuple(found["folders"]), tuple(found["runs"]))

    def _put(self, spark: SparkSession, commit: Commit) -> bool:
        """Write the commit file beside its place and rename it; False if the number is taken."""
        jvm = spark.sparkContext._jvm
        text = json.dumps({"run_id": commit.run_id, "folders": commit.folders, "runs": commit.runs})
        draft, fs = located(spark, self._at("_commits", f".{uuid.uuid4().hex}.draft"))
        final, _ = located(spark, self._at("_commits", f"{commit.number:020d}.json"))
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf)
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 0)
        try:
            context.rename(draft, final, options)  # refuses to overwrite
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            fs.delete(draft, False)
            return False
        return True

    def _change(
        self, spark: SparkSession, run_id: str, folder: str, keep: bool, seen: int, keep_runs: bool = False
    ) -> bool:
        for _ in range(TRIES):
            now = self.commit(spark)
            if run_id in now.runs:
                return False
            if not keep and now.number != seen:
                raise CommitConflict(f"{self.path} went from commit {seen} to {now.number}")
            folders = (*now.folders, folder) if keep else (folder,)
            runs = (*now.runs, run_id) if keep or keep_runs else (run_id,)
            if self._put(spark, Commit(now.number + 1, run_id, folders, runs)):
                return True
        raise CommitConflict(f"{self.path}: no commit within {TRIES} tries")

    # --- writing ------------------------------------------------------------

    def append(self, df: DataFrame, run_id: str | None = None) -> bool:
        """Add the rows; False, and nothing changes, if the run has added its rows before."""
        return self._write(df, run_id or uuid.uuid4().hex, keep=True)

    def replace(self, df: DataFrame, run_id: str | None = None, keep_runs: bool = False) -> bool:
        """Make these rows the table, which `df` may read; the former rows stay until `vacuum`.

        The runs before are forgotten with their rows, unless the new rows hold what they
        wrote (`keep_runs`). A commit of others in between is a conflict.
        """
        return self._write(df, run_id or uuid.uuid4().hex, False, keep_runs)

    def _write(self, df: DataFrame, run_id: str, keep: bool, keep_runs: bool = False) -> bool:
        spark = df.sparkSession
        seen = self.commit(spark)
        if run_id in seen.runs:
            return False
        folder = _write_folder(seen)
        self._put_rows(df, folder)
        if self.key is not None:
            self._write_index(spark, folder)
        return self._change(spark, run_id, folder, keep, seen.number, keep_runs)

    @contextmanager
    def appending(self, spark: SparkSession, run_id: str | None = None) -> Iterator[Callable[[DataFrame, int], None]]:
        """Add rows in several writes that appear in one commit when all are done.

        Gives a function that takes rows and about how many of them a bucket gets. Nothing is
        written if the run has added its rows before, and nothing is committed without rows.
        """
        run_id = run_id or uuid.uuid4().hex
        seen = self.commit(spark)
        folder, written = _write_folder(seen), []

        def add(df: DataFrame, bucket_rows: int = 0) -> None:
            if run_id not in seen.runs:
                self._put_rows(df, folder, bucket_rows)
                written.append(bucket_rows)

        yield add
        if written:
            if self.key is not None:
                self._write_index(spark, folder)
            self._change(spark, run_id, folder, True, seen.number)

    def _put_rows(self, df: DataFrame, folder: str, bucket_rows: int = 0) -> None:
        """Write rows to a folder beside those that are there; tasks take buckets or, of large ones, a share."""
        if self.key is None:
            df.write.mode("append").parquet(self._at(folder))
            return
        rows = df.withColumn(BUCKET, bucket_of(F.col(self.key), self.buckets))
        shares = max(1, -(-bucket_rows // FILE_ROWS))
        share = [F.pmod(F.xxhash64(F.lit("file"), F.col(self.key)), F.lit(shares))] if shares > 1 else []
        rows = rows.repartition(self.buckets * shares, BUCKET, *share)
        rows.write.options(**COMPACT).mode("append").partitionBy(BUCKET).parquet(self._at(folder))

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Delete all folders that the newest commit does not name; no write may be under way."""
        wanted = set(self.commit(spark).folders)
        root, fs = located(spark, self.path)
        gone = []
        for status in fs.listStatus(root) if fs.exists(root) else []:
            name = status.getPath().getName()
            if name.startswith((f"{WRITE}=", INDEX)) and name.replace(INDEX, f"{WRITE}=", 1) not in wanted:
                fs.delete(status.getPath(), True)
                gone.append(name)
        return sorted(gone)

    # --- reading ------------------------------------------------------------

    def read(self, spark: SparkSession, schema: StructType, commit: int | None = None) -> DataFrame:
        """The rows of the newest commit, or of an earlier one."""
        paths = [self._at(f) for f in self.commit(spark, commit).folders]
        if not paths:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return rows.select(schema.names)

    def as_stored(self, spark: SparkSession) -> DataFrame | None:
        """The table with the columns its files have; None before its first write."""
        folders = self.commit(spark).folders
        if not folders:
            return None
        reader = spark.read.option("mergeSchema", True).option("basePath", self.path)
        return reader.parquet(*[self._at(f) for f in folders]).drop(WRITE, BUCKET)

    # --- the index ----------------------------------------------------------

    def _write_index(self, spark: SparkSession, folder: str) -> None:
        """One filter per bucket of the folder, sized by the bucket's counted keys.

        Each slice is made from its own keys, which meet as hashes: a task that filled filters of
        whole buckets would send all of them, and tasks and filters both grow with the table.
        """
        ship_package(spark)
        path = self._at(folder)
        if not _has_parts(spark, path):
            return
        keys = spark.read.parquet(path).select(BUCKET, F.xxhash64(self.key).alias("hash"))
        sizes = {r[0]: r[1] for r in keys.groupBy(BUCKET).count().collect()}  # one line a bucket
        bits = {b: filter_bits(n, self.bits_per_key) for b, n in sizes.items()}
        slices = {b: max(1, n // SLICE_BITS) for b, n in bits.items()}

        def build(keys: pd.DataFrame) -> pd.DataFrame:
            bucket, number = int(keys[BUCKET].iloc[0]), int(keys[SLICE].iloc[0])
            made = np.zeros(bits[bucket] // slices[bucket] // 8, np.uint8)
            set_bits(made, keys["hash"].to_numpy(), slices[bucket])
            return pd.DataFrame({BUCKET: [bucket], SLICE: [number], "filter": [made.tobytes()]})

        of_bucket = lambda known: F.create_map(*[F.lit(x) for at in known.items() for x in at])[F.col(BUCKET)]
        low = of_bucket({b: 64 - (n.bit_length() - 1) for b, n in slices.items()})
        number = F.when(low < 64, F.call_function("shiftrightunsigned", F.col("hash"), low)).otherwise(0)
        parted = keys.withColumn(SLICE, number.cast("int")).repartition(BUCKET, SLICE).distinct()
        made = parted.groupBy(BUCKET, SLICE).applyInPandas(build, f"{BUCKET} int, {SLICE} int, filter binary")
        made.select("*", of_bucket(slices).alias("slices"), F.lit(folder).alias("folder")).write.parquet(
            self._at(_index(folder))
        )

    def _filters(self, spark: SparkSession, folders: tuple[str, ...]) -> DataFrame:
        found = [self._at(_index(f)) for f in folders if exists(spark, self._at(_index(f)))]
        schema = f"{BUCKET} int, {SLICE} int, filter binary, slices int, folder string"
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)

    def candidates(self, keys: DataFrame, commit: int | None = None) -> DataFrame:
        """`folder, _bucket, <key>`: where a key of `keys` (unique) may lie, by the filters alone."""
        spark = keys.sparkSession
        filters = self._filters(spark, self.commit(spark, commit).folders)
        bucket = bucket_of(F.col(self.key), self.buckets)
        sizes = {r[0]: r[1] for r in keys.groupBy(bucket).count().collect()}  # one line a bucket
        asked = F.col(BUCKET).isin(list(sizes))
        most, unsliced = filters.agg(
            F.max(F.when(asked, F.col("slices"))), F.count_if(F.col("slices").isNull())
        ).first()
        if unsliced:
            raise ValueError(f"{self.path} has an index of an earlier form: write the table anew")
        # A power of two, as the numbers of slices are: a part lies in one slice of any filter.
        crowd = -(-max(sizes.values(), default=0) // PART_KEYS)
        n_parts = max(most or 1, 1 << max(0, crowd - 1).bit_length())
        low = 64 - (n_parts.bit_length() - 1)
        hashed = F.xxhash64(self.key)
        part = F.shiftrightunsigned(hashed, low).cast("int") if n_parts > 1 else F.lit(0)
        wanted = keys.select(
            self.key,
            hashed.alias("hash"),
            bucket.alias(BUCKET),
            part.alias(PART),
        )
        name = self.key
        kind = keys.schema[name].dataType.simpleString()

        def probe(own: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            found = []
            hashes = own["hash"].to_numpy()
            for folder, filter_, slices in zip(filters["folder"], filters["filter"], filters["slices"]):
                hit = own[has_bits(np.frombuffer(filter_, np.uint8), hashes, int(slices))]
                found.append(hit[[BUCKET, name]].assign(folder=folder))
            empty = own[[BUCKET, name]].iloc[:0].assign(folder="")
            return pd.concat([empty, *found])[["folder", BUCKET, name]]

        each = (F.lit(n_parts) / F.col("slices")).cast("int")
        first = F.col(SLICE) * each
        spread = filters.where(asked).select("*", F.explode(F.sequence(first, first + each - 1)).alias(PART))
        return (
            wanted.groupBy(BUCKET, PART)
            .cogroup(spread.groupBy(BUCKET, PART))
            .applyInPandas(probe, f"folder string, {BUCKET} int, `{name}` {kind}")
        )

    def known_keys(self, keys: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """Keys of `keys` (unique) that the table holds, and how many buckets were read for it.

        The same keys as a semi join with the whole table; buckets whose filter no key
        passes are not opened. At most one line per stored bucket reaches the driver.
        """
        spark = keys.sparkSession
        folders = self.commit(spark).folders
        total = self._filters(spark, folders).select("folder", BUCKET).distinct().count()
        if not total:
            return keys.select(self.key).where("false"), {"buckets": 0, "buckets_read": 0}
        hits = stage(self.candidates(keys), "key-candidates", COMPACT)
        places = [tuple(r) for r in hits.select("folder", BUCKET).distinct().collect()]
        numbers = {"buckets": total, "buckets_read": len(places)}
        if not places:
            return keys.select(self.key).where("false"), numbers
        paths = sorted(self._at(folder, f"{BUCKET}={bucket}") for folder, bucket in places)
        stored = spark.read.schema(keys.select(self.key).schema).parquet(*paths)
        wanted = hits.select(self.key).distinct()
        return wanted.join(stored, self.key, "left_semi"), numbers


def _write_folder(seen: Commit) -> str:
    return f"{WRITE}={seen.number + 1}-{uuid.uuid4().hex}"


def _index(folder: str) -> str:
    return folder.replace(f"{WRITE}=", INDEX, 1)


def _has_parts(spark: SparkSession, path: str) -> bool:
    folder, fs = located(spark, path)
    return any(s.getPath().getName().startswith(BUCKET) for s in fs.listStatus(folder))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), key), F.lit(buckets)).cast("int")


# --- Bloom filters over 64-bit hashes ---------------------------------------

#: Bits a key sets; best for 24 bits a key would be 17, 8 cost half the time.
PROBES = 8
#: A larger filter is cut into slices of so many bits: all bits of a key lie in one of them.
SLICE_BITS = 1 << 20
#: Keys of a batch that are probed at once, about; a slice holds no more at 24 bits a key.
PART_KEYS = 1 << 15


def filter_bits(n_keys: int, bits_per_key: int) -> int:
    """A power of two of at least `bits_per_key` bits a key."""
    return 1 << max(6, (max(1, n_keys) * bits_per_key - 1).bit_length())


def _positions(hashes: np.ndarray, n_bits: int, slices: int) -> np.ndarray:
    """`PROBES` bit numbers per hash in its slice of `n_bits`: a walk whose step is drawn from the hash again.

    The leading bits number the slice, so the walk begins with those after them.
    """
    h = hashes.astype(np.int64).view(np.uint64)
    step = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    start = h << np.uint64(slices.bit_length() - 1)
    k = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((start + k * step) >> np.uint64(64 - (n_bits.bit_length() - 1))).astype(np.int64)


def set_bits(filter_: np.ndarray, hashes: np.ndarray, slices: int | None = None) -> None:
    """Fill a whole filter; with `slices`, a filter of so many, of which `filter_` is that of all the hashes."""
    at = (_in_whole(filter_, hashes) if slices is None else _positions(hashes, 8 * len(filter_), slices)).ravel()
    np.bitwise_or.at(filter_, at >> 3, (1 << (at & 7)).astype(np.uint8))


def _in_whole(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slices = max(1, 8 * len(filter_) // SLICE_BITS)
    at = _positions(hashes, 8 * len(filter_) // slices, slices)
    if slices == 1:
        return at
    h = hashes.astype(np.int64).view(np.uint64)
    return at + (h >> np.uint64(64 - (slices.bit_length() - 1))).astype(np.int64) * SLICE_BITS


def has_bits(filter_: np.ndarray, hashes: np.ndarray, slices: int | None = None) -> np.ndarray:
    """Which hashes a whole filter may hold; with `slices`, a filter of so many, of which `filter_` is theirs."""
    at = _in_whole(filter_, hashes) if slices is None else _positions(hashes, 8 * len(filter_), slices)
    return (filter_[at >> 3] >> (at & 7) & 1).all(axis=0)
