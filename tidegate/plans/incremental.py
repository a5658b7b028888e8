"""Metrics per user, category and day that a batch advances without rereading history.

What all metrics are sums of is kept: cells per (user, day), per (user, category), and per
(user, amount), the last for exact medians and spreads. A batch adds its own cells in one
commit, so a batch that is repeated, or lost before its commit, counts once. Cells of many
batches add up when they are read; `compact` adds them up for good.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.moments import value_counts
from ..runtime import stage
from ..schemas import METRIC_CELLS as STATE
from ..sources.committed import CommittedTable
from . import intermediate

DAY, CATEGORY, AMOUNT = "day", "category", "amount"
KEYS = ["cells", "user_id", "transaction_day", "product_category", "cents"]


def _all_cells(stg: DataFrame) -> DataFrame:
    """The three kinds of cells of staged transactions, under one schema."""
    done = stg.where(intermediate.completed())
    kinds = {
        DAY: intermediate.day_cells(stg),
        CATEGORY: intermediate.category_cells(stg),
        AMOUNT: value_counts(done, "user_id", "amount"),
    }
    out = None
    for kind, found in kinds.items():
        own = found.withColumn("cells", F.lit(kind)).select(
            *[
                (F.col(f.name) if f.name in found.columns or f.name == "cells" else F.lit(None))
                .cast(f.dataType).alias(f.name)
                for f in STATE.fields
            ]
        )
        out = own if out is None else out.unionByName(own)
    return out


def _added_up(cells: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("cell_rows", "n", "n_amount")]
    return cells.groupBy(*KEYS).agg(
        *sums,
        F.sum("total").cast("decimal(38,2)").alias("total"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


@dataclass(frozen=True)
class MetricState:
    """Stored cells of all batches so far, at `path`.

    Null users, days, categories and amounts are cells of their own, as in the full run.
    Before the first batch there are no metrics.
    """

    path: str

    @property
    def table(self) -> CommittedTable:
        return CommittedTable(self.path)

    def advance(self, batch: DataFrame, run_id: str) -> bool:
        """Add the cells of a batch of staged transactions; False if the run had added them."""
        if run_id in self.table.commit(batch.sparkSession).runs:
            return False
        return self.table.append(_all_cells(batch), run_id)

    def compact(self, spark: SparkSession) -> None:
        """One cell per key in place of one per key and batch; batches stay known by their runs."""
        seen = self.table.commit(spark)
        if len(seen.folders) > 1:
            rows = _added_up(self.table.read(spark, STATE, seen.number))
            self.table.replace(rows, f"compacted-{seen.number}", keep_runs=True)

    def _cells(self, spark: SparkSession, kind: str) -> DataFrame:
        found = self.table.read(spark, STATE).where(F.col("cells") == kind)
        return _added_up(found)

    def day_cells(self, spark: SparkSession) -> DataFrame:
        return self._cells(spark, DAY).drop("cells", "product_category", "cents")

    def category_cells(self, spark: SparkSession) -> DataFrame:
        rows = self._cells(spark, CATEGORY)
        return rows.drop("cells", "transaction_day", "cents", "first_at", "last_at")

    def user_metrics(self, spark: SparkSession) -> DataFrame:
        counts = self._cells(spark, AMOUNT).select(F.struct("user_id").alias("user"), "cents", "n")
        base = intermediate.user_base_of_cells(
            stage(self.day_cells(spark), "day-cells"), self.category_cells(spark), counts
        )
        return base.where("total_transactions > 0").drop("key_rows", "n_amount")

    def category_metrics(self, spark: SparkSession) -> DataFrame:
        base = intermediate.category_base(self.category_cells(spark))
        return base.where("category_total_transactions > 0").drop("key_rows", "category_n_amount")

    def daily_metrics(self, spark: SparkSession) -> DataFrame:
        base = intermediate.daily_base(self.day_cells(spark))
        return base.where("daily_transaction_count > 0").drop("key_rows", "daily_n_amount")
