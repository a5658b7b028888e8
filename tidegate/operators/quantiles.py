"""Approximate quantiles from sketches that merge, beside the exact ones of `moments`.

A KLL sketch keeps a few hundred values of each group, whatever its size. Sketches of cells
merge to the sketch of their union, so they can be stored per cell and advanced batch by
batch, where exact quantiles need every distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values a sketch keeps at its widest level; more means finer ranks.
DEFAULT_K = 400


def rank_error(k: int = DEFAULT_K) -> float:
    """Largest error of a rank, as a share of the rows, that 99 of 100 answers keep.

    Published constants of the KLL sketch. Three times this is beyond seven standard
    deviations.
    """
    return 2.296 / k**0.9021


def sketched(df: DataFrame, by: list[str], amount: str, k: int = DEFAULT_K) -> DataFrame:
    """`by` and the `sketch` of the amounts in cents; NULLs left out, groups without values too.

    Sketches are built per task and merged after, so a hot group is no burden.
    """
    cents = (F.col(amount) * 100).cast("long")
    known = df.where(F.col(amount).isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_bigint(cents, F.lit(k)).alias("sketch"))


def merged(cells: DataFrame, by: list[str], k: int = DEFAULT_K) -> DataFrame:
    """The sketches of `cells` added up to fewer groups."""
    return cells.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))


def quantile(sketch: str, share: float) -> Column:
    """The value in money below or at which about `share` of the group lies."""
    cents = F.kll_sketch_get_quantile_bigint(F.col(sketch), F.lit(float(share)))
    return (cents.cast("decimal(12,0)") / 100).cast("decimal(10,2)")


def sketch_size(sketch: str) -> Column:
    return F.kll_sketch_get_n_bigint(F.col(sketch))
