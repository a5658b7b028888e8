"""Left joins and groupings that survive one key holding a large share of all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import stage

# What a broadcast side may hold at most: rows of fixed-width columns, and bytes of text keys.
BROADCAST_ROWS = 100_000
BROADCAST_KEY_BYTES = 16 * 1024 * 1024


@dataclass(frozen=True)
class Lookup:
    """A staged table, unique by `key`, with its measured size.

    `heavy` says, as `heavy_keys` does, into how many slices the rows of a key are cut
    that the table was made from; None if nothing is known of them.
    """

    table: DataFrame
    key: str
    n_rows: int
    key_bytes: int
    heavy: DataFrame | None

    def fits_broadcast(self, max_rows: int | None = None) -> bool:
        max_rows = BROADCAST_ROWS if max_rows is None else max_rows
        return self.n_rows <= max_rows and self.key_bytes <= BROADCAST_KEY_BYTES


def measure(table: DataFrame, key: str, rows: str | None = None) -> Lookup:
    """Size of a staged table and, by the row counts in column `rows`, its heavy keys."""
    n, key_bytes, total = table.agg(
        F.count(F.lit(1)),
        F.sum(F.octet_length(F.col(key).cast("string"))),
        F.sum(rows) if rows else F.lit(0),
    ).first()
    heavy = _sliced(table, key, rows, total or 0) if rows else None
    return Lookup(table, key, n, key_bytes or 0, heavy)


def _sliced(counts: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """Slices per hashed key, for keys above a quarter of a task's even share of `total` rows.

    There are fewer than four such keys per task, whatever the data, and a line is 12 bytes;
    all slices together are fewer than eight per task.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, total // (4 * tasks))
    hashed = F.xxhash64(F.col(key)).alias("_hash")
    return (
        counts.where(F.col(rows) > share)
        .groupBy(hashed)
        .agg(F.ceil(F.sum(rows) / F.lit(share)).cast("int").alias("_slices"))
    )


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """Slices of heavy keys, counted from the rows themselves and combined before the shuffle."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
    return measure(stage(counts, "key-counts"), key, "key_rows").heavy


def _with_slices(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Add `_slices`, the number of slices of the row's key."""
    hashed = df.withColumn("_hash", F.xxhash64(F.col(key)))
    joined = hashed.join(F.broadcast(heavy), "_hash", "left").drop("_hash")
    return joined.withColumn("_slices", F.coalesce("_slices", F.lit(1)))


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, heavy: DataFrame | None, spread: Column
) -> DataFrame:
    """Left join on `key`, `right` unique by `key`.

    Rows of heavy keys, NULL among them, are dealt by a hash of `spread` over as many
    slices as their number asks for, and the key's line of `right` is repeated per slice.
    Without counts this is the plain join.
    """
    if heavy is None:
        return left.join(right, key, "left")
    columns = [*left.columns, *(c for c in right.columns if c != key)]
    slice_of = F.pmod(F.xxhash64(spread), F.col("_slices")).cast("int")
    left = _with_slices(left, key, heavy).withColumn("_slice", slice_of)
    right = _with_slices(right.where(F.col(key).isNotNull()), key, heavy)
    copies = F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))
    right = right.withColumn("_slice", copies).drop("_slices")
    return left.join(right, [key, "_slice"], "left").select(columns)


def attach(
    left: DataFrame, lookup: Lookup, spread: Column, max_rows: int | None = None
) -> DataFrame:
    """Left-join a lookup table.

    Broadcast when its measured size allows; otherwise a shuffle join with the
    heavy keys of `left` spread over all tasks.
    """
    if lookup.fits_broadcast(max_rows):
        return left.join(F.broadcast(lookup.table), lookup.key, "left")
    return salted_left_join(left, lookup.table, lookup.key, lookup.heavy, spread)


def latest_per_key(df: DataFrame, key: list[str], newest: list[str]) -> DataFrame:
    """One row per key: the greatest by `newest`, then by all other columns.

    A grouped maximum of whole rows, so copies collapse before the shuffle; a
    window would gather every copy of a key in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in newest]
    row = F.max(F.struct(*newest, *rest)).alias("_row")
    best = df.groupBy(*key).agg(row)
    return best.select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def known_keys(batch: Lookup, published: DataFrame) -> DataFrame:
    """Keys of the staged `batch` that `published` already holds.

    The published keys grow for ever. A batch of checked, small size is broadcast
    against them, which leaves a scan without a shuffle; a larger one is joined
    by shuffle, where both sides are unique by key and hence even.
    """
    wanted = batch.table.select(batch.key)
    if batch.fits_broadcast():
        wanted = F.broadcast(wanted)
    return published.select(batch.key).join(wanted, batch.key, "left_semi").distinct()
