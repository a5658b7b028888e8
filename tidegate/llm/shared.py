"""Staged tables of iterative jobs and connected components over a link table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import BROADCAST_ROWS
from ..runtime import shared_folder, stage


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


#: A table written once and read back: the lineage ends here. It goes with its `staged_run`.
staged = stage


def drop(df: DataFrame) -> None:
    """Delete a staged table that nobody reads any more."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sized(df: DataFrame, n_rows: int) -> DataFrame:
    """`df` for a join, by its counted rows: many are shuffled whatever size Spark takes them for.

    Spark goes by the bytes of the files below and counts neither what `explode` makes of a
    row nor what encoding saves, so that it would hand gigabytes through the driver.
    """
    return df.hint("merge") if n_rows > BROADCAST_ROWS else df


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table.

    `links` has columns `a` and `b` (long). Returns `node` and `component`, the
    smallest node that can be reached, for every node that occurs in a link to
    another node. Large-star and small-star steps alternate until nothing
    changes: each star is a grouped minimum and a join, so no component is ever
    gathered in one place. Nulls and links of a node to itself say nothing.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("hi") != F.col("lo")))
        .distinct(),
        "links",
    )
    before, n = None, edges.count()
    for _ in range(rounds):
        after = staged(_small_star(_large_star(edges, n), n), "stars")
        drop(edges)
        edges = after
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before, n = now, now[0]
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Link each node's larger neighbours to the smallest node around it."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = both.where("v > u").join(sized(least, n_edges), "u")
    return joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(sized(least, n_edges), "hi").where("lo != m").select(F.col("lo").alias("hi"), "m")
    return moved.unionByName(least).select("hi", F.col("m").alias("lo")).distinct()


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, lengthened until no column of `df` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


Step = Callable[[SparkSession, DataFrame, str], DataFrame]
