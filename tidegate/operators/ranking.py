"""Row numbers and tiles over a whole table or over groups of any size.

An unpartitioned window, or a window over a hot group, runs in one task. Here the
rows are range-partitioned, sorted, and numbered within their partition; what earlier
partitions hold is added from a table of one line per partition. Small and large
tables take the same way.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import stage


def _in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows in range partitions of `order`, with their partition and their place in it."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        # low 33 bits: place of the row within its partition
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )


def with_position(df: DataFrame, order: list[Column], alias: str) -> tuple[DataFrame, int]:
    """Add the 1-based position in the total order `order`, and count the rows.

    The sorted rows are staged with their partition and their place in it, so the
    sampled range bounds are drawn once. Only one count per partition comes to
    the driver.
    """
    ordered = stage(_in_ranges(df, order), "ordered")
    sizes = sorted((r[0], r[1]) for r in ordered.groupBy("_part").count().collect())
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, before)], "_part int, _before long"
    )
    position = F.col("_before") + F.col("_place") + F.lit(1)
    placed = ordered.join(F.broadcast(offsets), "_part").withColumn(alias, position)
    return placed.select(*df.columns, alias), before[-1]


def tile_of(position: Column, n_rows: int, tiles: int) -> Column:
    """NTILE from a position: the first n_rows % tiles tiles hold one row more."""
    small, larger = divmod(n_rows, tiles)
    edge = larger * (small + 1)
    in_large = F.floor((position - 1) / F.lit(small + 1)) + F.lit(1)
    in_small = F.lit(larger + 1) + F.floor((position - 1 - edge) / F.lit(max(small, 1)))
    return F.when(position <= edge, in_large).otherwise(in_small).cast("int")


def with_tile(df: DataFrame, order: list[Column], tiles: int, alias: str) -> DataFrame:
    """Add NTILE(tiles) over `order`, which must be total."""
    placed, n = with_position(df, order, "_position")
    return placed.withColumn(alias, tile_of(F.col("_position"), n, tiles)).drop("_position")


def with_group_sequence(df: DataFrame, key: str, order: list[Column], alias: str) -> DataFrame:
    """Add ROW_NUMBER() OVER (PARTITION BY key ORDER BY order); `order` must be total.

    The rows lie in ranges of (key, order), so a group of any size is cut into pieces of
    at most one range. Rows are numbered within their piece; only the first key of a range
    can continue the range before, so one line per range says by how much.
    """
    piece = Window.partitionBy("_part", key).orderBy("_place")
    ranges = _in_ranges(df, [F.col(key).asc_nulls_first(), *order])
    numbered = stage(ranges.withColumn("_piece", F.row_number().over(piece)), "pieces")
    edges = numbered.groupBy("_part").agg(
        F.min_by(F.struct(key), "_place").alias("first"),
        F.max_by(F.struct(F.col(key), F.col("_piece")), "_place").alias("last"),
    )
    carried, open_key, so_far = [], None, 0
    for part, first, last in sorted(edges.collect(), key=lambda r: r[0]):
        carry = so_far if open_key is not None and first[0] == open_key[0] else 0
        if carry:
            carried.append((part, first[0], carry))
        so_far = last[1] + (carry if last[0] == first[0] else 0)
        open_key = (last[0],)
    key_type = df.schema[key].dataType.simpleString()
    carries = df.sparkSession.createDataFrame(
        carried, f"_range int, _open {key_type}, _carry long"
    )
    continues = (F.col("_part") == F.col("_range")) & F.col(key).eqNullSafe(F.col("_open"))
    joined = numbered.join(F.broadcast(carries), continues, "left")
    number = (F.col("_piece") + F.coalesce("_carry", F.lit(0))).cast("int")
    return joined.withColumn(alias, number).select(*df.columns, alias)
