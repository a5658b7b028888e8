"""Exact count, mean, spread and median of an amount per group.

Amounts have two decimals, so they are whole cents. They are first counted per
(group, value), which combines equal values before the shuffle. The median is
then found by radix selection: sums per block of 2**17 neighbouring values locate
the block with the middle rank, and only that block is read value by value. Both
steps are bounded for any group: DECIMAL(10,2) spans at most 152,588 blocks, and a
block at most 131,072 values. No task ever holds a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 17
WIDE = "decimal(38,0)"


def value_counts(df: DataFrame, key: str, amount: str) -> DataFrame:
    """How often each key has each amount, as `key, cents, n`; NULL amounts left out."""
    cents = (F.col(amount) * 100).cast("long").alias("cents")
    return df.where(F.col(amount).isNotNull()).groupBy(key, cents).agg(F.count(F.lit(1)).alias("n"))


def amount_profile(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Per key: min, max, sample standard deviation and median of `amount`, NULLs left out.

    The key must not be NULL; wrap a nullable one in a struct, whose equality and
    hash partitioning hold for NULL fields too.
    """
    return profile_of_counts(value_counts(df, key, amount), key)


def profile_of_counts(counts: DataFrame, key: str) -> DataFrame:
    """`amount_profile` from `value_counts`, which may be stored and added up."""
    values = (
        counts.withColumn("block", F.shiftright("cents", BLOCK_BITS))
        # the join below implies this filter; stated here, both readers share one exchange
        .where(F.col("block").isNotNull())
        # blocks are summed, and the middle ones read, where this puts them
        .repartition(key, "block")
    )
    cents, n = F.col("cents").cast("decimal(12,0)"), F.col("n").cast("decimal(13,0)")
    blocks = values.groupBy(key, "block").agg(
        F.sum("n").alias("n"),
        F.sum((cents * n).cast(WIDE)).cast(WIDE).alias("s1"),
        F.sum((cents * cents * n).cast(WIDE)).cast(WIDE).alias("s2"),
        F.min("cents").alias("low"),
        F.max("cents").alias("high"),
    )
    whole = Window.partitionBy(key)
    upto = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = blocks.select(
        key,
        "block",
        (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.sum("n").over(upto).alias("reached"),
        F.sum("n").over(whole).alias("total"),
        F.sum("s1").over(whole).cast(WIDE).alias("s1"),
        F.sum("s2").over(whole).cast(WIDE).alias("s2"),
        F.min("low").over(whole).alias("low"),
        F.max("high").over(whole).alias("high"),
    )
    # ranks of the one or two middle values
    lower, upper = F.expr("(total + 1) div 2"), F.expr("(total + 2) div 2")
    middle = ranked.where((F.col("before") < upper) & (F.col("reached") >= lower)).select(
        F.col(key).alias("_key"),
        F.col("block").alias("_block"),
        "before", "total", "s1", "s2", "low", "high",
    )
    near = values.join(
        middle, (values[key] == F.col("_key")) & (F.col("block") == F.col("_block"))
    )
    rank = F.col("before") + F.sum("n").over(
        Window.partitionBy("_key", "_block")
        .orderBy("cents")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    picked = (
        near.withColumn("rank", rank)
        .groupBy("_key")
        .agg(
            F.min(F.when(F.col("rank") >= lower, F.col("cents"))).alias("mid_lower"),
            F.min(F.when(F.col("rank") >= upper, F.col("cents"))).alias("mid_upper"),
            *[F.max(c).alias(c) for c in ("total", "s1", "s2", "low", "high")],
        )
    )
    # sum of squared deviations: s2 - s1^2/total, with s1 = q*total + r, so that the
    # large terms cancel in whole numbers and nothing is lost to rounding
    parts = picked.withColumn("q", F.expr("s1 div total").cast("decimal(12,0)")).withColumn(
        "r", (F.col("s1") - F.col("q") * F.col("total").cast("decimal(13,0)")).cast("decimal(14,0)")
    )
    q, r = F.col("q"), F.col("r")
    whole_part = (
        F.col("s2")
        - (q * q * F.col("total").cast("decimal(13,0)")).cast(WIDE)
        - (q * r * F.lit(2).cast("decimal(1,0)")).cast(WIDE)
    ).cast("double")
    squares = whole_part - r.cast("double") * r.cast("double") / F.col("total")
    spread = F.when(
        F.col("total") > 1,
        F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.col("total") - 1)) / 100,
    )
    money = lambda c: (F.col(c).cast("decimal(12,0)") / 100).cast("decimal(10,2)")
    return parts.select(
        F.col("_key").alias(key),
        money("low").alias("min_amount"),
        money("high").alias("max_amount"),
        spread.alias("stddev_amount"),
        ((F.col("mid_lower") + F.col("mid_upper")) / F.lit(200.0)).alias("median_amount"),
    )
