"""Metrics per user, category and day, and the rows enriched with them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, replace
from datetime import datetime
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import scalars as S
from ..operators.moments import profile_of_counts, value_counts
from ..operators.ranking import with_group_sequence, with_tile
from ..operators.skew import Lookup, attach, heavy_keys, measure, salted_left_join
from ..runtime import stage

def completed() -> Column:
    return F.col("status") == "COMPLETED"


def _money(total: str) -> Column:
    return F.sum(total).cast("decimal(20,2)")


def _cells(stg: DataFrame, by: str) -> DataFrame:
    """Completed transactions counted per (user, `by`).

    What is counted distinct later is one line here, so that all metrics are sums
    over cells. `cell_rows` counts every status, to know the hot keys of all rows.
    """
    done = completed()
    amount = F.when(done, F.col("amount"))
    moment = F.when(done, F.col("transaction_date"))
    return stg.groupBy("user_id", by).agg(
        F.count(F.lit(1)).alias("cell_rows"),
        F.count_if(done).alias("n"),
        F.count(amount).alias("n_amount"),
        F.sum(amount).alias("total"),
        F.min(moment).alias("first_at"),
        F.max(moment).alias("last_at"),
    )


def day_cells(stg: DataFrame) -> DataFrame:
    return _cells(stg, "transaction_day")


def category_cells(stg: DataFrame) -> DataFrame:
    return _cells(stg, "product_category").drop("first_at", "last_at")


def _active(column: str) -> Column:
    """Number of cells of a group with completed rows, those without a value of `column` apart."""
    return F.count_if((F.col("n") > 0) & F.col(column).isNotNull())


def user_base(days: DataFrame, categories: DataFrame, stg: DataFrame) -> DataFrame:
    """Metrics per user without the quartiles; all zero for users without completed rows."""
    done = stg.where(completed()).select(F.struct("user_id").alias("user"), "amount")
    return user_base_of_cells(days, categories, value_counts(done, "user", "amount"))


def user_base_of_cells(days: DataFrame, categories: DataFrame, amounts: DataFrame) -> DataFrame:
    """`user_base` from cells alone; `amounts` counts each `user` struct's cents.

    All three parts are grouped by the user wrapped in a struct, which also
    matches a NULL user, so they are joined where they lie.
    """
    user = F.struct("user_id").alias("user")
    counts = days.groupBy(user).agg(
        F.sum("cell_rows").alias("key_rows"),
        F.sum("n").alias("total_transactions"),
        _active("transaction_day").alias("active_days"),
        _money("total").alias("total_amount"),
        F.sum("n_amount").alias("n_amount"),
        F.min("first_at").alias("first_transaction_date"),
        F.max("last_at").alias("last_transaction_date"),
    )
    kinds = categories.groupBy(user).agg(_active("product_category").alias("unique_categories"))
    profile = profile_of_counts(amounts, "user")
    return (
        counts.join(kinds, "user", "left")
        .join(profile, "user", "left")
        .select(
            "user.user_id", "key_rows", "total_transactions", "active_days", "unique_categories",
            "total_amount", "n_amount",
            S.average(F.col("total_amount"), F.col("n_amount")).alias("avg_transaction_amount"),
            F.col("min_amount").alias("min_transaction_amount"),
            F.col("max_amount").alias("max_transaction_amount"),
            F.col("median_amount").alias("median_transaction_amount"),
            F.col("stddev_amount").alias("stddev_transaction_amount"),
            "first_transaction_date", "last_transaction_date",
        )
    )


def user_metrics(stg: DataFrame) -> DataFrame:
    base = user_base(day_cells(stg), category_cells(stg), stg)
    return base.where("total_transactions > 0").drop("key_rows", "n_amount")


def with_user_quartiles(base: DataFrame, value: bool = True, frequency: bool = True) -> DataFrame:
    """Add the quartiles by total and by number of transactions to a user table."""
    out = base
    if value:
        order = [F.col("total_amount").desc_nulls_first(), F.col("user_id").asc_nulls_last()]
        out = with_tile(out, order, 4, "user_value_quartile")
    if frequency:
        order = [F.col("total_transactions").desc(), F.col("user_id").asc_nulls_last()]
        out = with_tile(out, order, 4, "user_frequency_quartile")
    return out


def category_base(categories: DataFrame) -> DataFrame:
    base = categories.groupBy("product_category").agg(
        F.sum("cell_rows").alias("key_rows"),
        F.sum("n").alias("category_total_transactions"),
        _money("total").alias("category_total_amount"),
        F.sum("n_amount").alias("category_n_amount"),
        _active("user_id").alias("category_unique_users"),
    )
    mean = S.average(F.col("category_total_amount"), F.col("category_n_amount"))
    return base.withColumn("category_avg_amount", mean)


def category_metrics(stg: DataFrame) -> DataFrame:
    base = category_base(category_cells(stg)).where("category_total_transactions > 0")
    return base.drop("key_rows", "category_n_amount")


def daily_base(cells: DataFrame) -> DataFrame:
    """Metrics per day. The moving average covers the last seven days that have completed rows.

    Its window takes one line per calendar day, those without completed rows
    apart, so it is small.
    """
    days = cells.groupBy("transaction_day").agg(
        F.sum("cell_rows").alias("key_rows"),
        F.sum("n").alias("daily_transaction_count"),
        _money("total").alias("daily_total_amount"),
        F.sum("n_amount").alias("daily_n_amount"),
        _active("user_id").alias("daily_unique_users"),
    )
    week = (
        Window.partitionBy(F.col("daily_transaction_count") > 0)
        .orderBy(F.col("transaction_day").asc_nulls_last())
        .rowsBetween(-6, 0)
    )
    total = F.col("daily_total_amount")
    return days.withColumns(
        {
            "daily_avg_amount": S.average(total, F.col("daily_n_amount")),
            "daily_amount_7day_moving_avg": S.average(
                F.sum(total).over(week), F.count(total).over(week)
            ),
        }
    )


def daily_metrics(stg: DataFrame) -> DataFrame:
    base = daily_base(day_cells(stg)).where("daily_transaction_count > 0")
    return base.drop("key_rows", "daily_n_amount")


def _together(spark: SparkSession, *jobs: Callable) -> list:
    """Results of independent Spark jobs, submitted at the same time."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        # threads take over the caller's context and, by Spark's wrapper, its job properties
        running = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(job)) for job in jobs
        ]
        return [job.result() for job in running]


@dataclass(frozen=True)
class TransactionMetrics:
    """Staged metrics, and which keys are heavy in the transactions."""

    users: Lookup
    categories: Lookup
    days: Lookup


def transaction_metrics(stg: DataFrame, by_day: DataFrame | None = None) -> TransactionMetrics:
    """All metrics of the transactions, computed once; `by_day` are their staged day cells, if at hand.

    The staged tables also list keys without completed rows, since those may be
    the heavy ones of the join; only then they are left out.
    """

    def staged(df: DataFrame, key: str, n: str) -> Lookup:
        found = measure(stage(df, f"{key}-metrics"), key, "key_rows")
        return replace(found, table=found.table.where(F.col(n) > 0).drop("key_rows"))

    by_day, by_category = _together(
        stg.sparkSession,
        lambda: by_day or stage(day_cells(stg), "day-cells"),
        lambda: stage(category_cells(stg), "category-cells"),
    )
    users, categories, days = _together(
        stg.sparkSession,
        lambda: staged(user_base(by_day, by_category, stg), "user_id", "total_transactions"),
        lambda: staged(
            category_base(by_category), "product_category", "category_total_transactions"
        ),
        lambda: staged(daily_base(by_day), "transaction_day", "daily_transaction_count"),
    )
    return TransactionMetrics(
        replace(users, table=with_user_quartiles(users.table)), categories, days
    )


def int_transactions(
    stg: DataFrame,
    metrics: TransactionMetrics | None = None,
    max_broadcast: int | None = None,
) -> DataFrame:
    """Every staged transaction with the metrics of its user, category and day."""
    m = metrics or transaction_metrics(stg)
    users = m.users.table.select(
        "user_id",
        F.col("total_transactions").alias("user_total_transactions"),
        F.col("active_days").alias("user_active_days"),
        F.col("unique_categories").alias("user_unique_categories"),
        F.col("total_amount").alias("user_total_amount"),
        F.col("n_amount").alias("_user_n"),
        F.col("avg_transaction_amount").alias("user_avg_transaction_amount"),
        F.col("median_transaction_amount").alias("user_median_transaction_amount"),
        F.col("stddev_transaction_amount").alias("user_stddev_transaction_amount"),
        "user_value_quartile", "user_frequency_quartile",
    )
    categories = m.categories.table.withColumnRenamed("category_n_amount", "_category_n")
    days = m.days.table.withColumnRenamed("daily_n_amount", "_day_n")
    spread = F.col("transaction_id")
    out = stg
    for lookup, table in ((m.users, users), (m.categories, categories), (m.days, days)):
        out = attach(out, replace(lookup, table=table), spread, max_broadcast)

    amount = F.col("amount")
    # compared as amount * n > total, exact where a rounded mean is not
    above_category = amount * F.col("_category_n") > F.col("category_total_amount")
    weight = lambda test: F.when(test, F.lit(Decimal("0.3"))).otherwise(F.lit(Decimal("0.1")))
    reliability = (
        F.col("data_quality_score") * F.lit(Decimal("0.4"))
        + weight(F.col("user_total_transactions") > 10)
        + weight(above_category)
    )
    return out.select(
        *[F.col(c) for c in stg.columns],
        "user_total_transactions", "user_active_days", "user_unique_categories",
        "user_total_amount", "user_avg_transaction_amount", "user_median_transaction_amount",
        "user_stddev_transaction_amount", "user_value_quartile", "user_frequency_quartile",
        "category_total_transactions", "category_total_amount", "category_avg_amount",
        "category_unique_users",
        "daily_transaction_count", "daily_total_amount", "daily_avg_amount",
        "daily_unique_users", "daily_amount_7day_moving_avg",
        S.percent_above(amount, F.col("user_total_amount"), F.col("_user_n")).alias(
            "deviation_from_user_avg_pct"
        ),
        S.percent_above(amount, F.col("daily_total_amount"), F.col("_day_n")).alias(
            "deviation_from_daily_avg_pct"
        ),
        F.round(reliability, 2).cast("decimal(4,2)").alias("composite_reliability_score"),
    )


def activity_base(days: DataFrame) -> DataFrame:
    """Completed transactions per user from the day cells, with the number of known amounts."""
    found = days.where("n > 0").groupBy("user_id").agg(
        F.sum("n").alias("total_transactions"),
        _active("transaction_day").alias("active_days"),
        _money("total").alias("total_transaction_value"),
        F.sum("n_amount").alias("amount_count"),
        F.max("last_at").alias("last_transaction_date"),
    )
    return found.select(
        "user_id", "total_transactions", "active_days", "total_transaction_value", "amount_count",
        S.average(F.col("total_transaction_value"), F.col("amount_count")).alias(
            "avg_transaction_amount"
        ),
        "last_transaction_date",
        L.activity_segment(F.col("total_transactions")).alias("user_activity_segment"),
    )


def user_activity(stg: DataFrame) -> DataFrame:
    """Completed transactions per user with the activity segment."""
    return activity_base(day_cells(stg)).drop("amount_count")


def int_users(users: DataFrame, activity: DataFrame, as_of: datetime) -> DataFrame:
    """Staged users with their `activity_base`. Both sides have one row per user."""
    a = F.col("user_activity_segment")
    mean = S.average(F.col("total_transaction_value"), F.col("amount_count"), 2)
    days = F.datediff(F.lit(as_of.date()), F.col("registration_date"))
    enriched = users.join(activity, "user_id", "left").select(
        "user_id", "first_name", "last_name", "full_name", "email", "ip_address",
        F.col("email").isNull().alias("has_missing_email"),
        "country", "registration_date", "registration_year", "registration_month",
        F.coalesce("total_transactions", F.lit(0)).alias("total_transactions"),
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        F.coalesce("total_transaction_value", F.lit(0)).cast("decimal(15,2)").alias(
            "total_lifetime_value"
        ),
        F.coalesce(mean, F.lit(0)).cast("decimal(10,2)").alias("avg_transaction_amount"),
        "last_transaction_date",
        F.coalesce(a, F.lit("no_activity")).alias("user_activity_segment"),
        "data_quality_score", "data_quality_tier", "completeness_flag",
        "processed_at", "dbt_transformed_at",
        S.moment(as_of).alias("dbt_enriched_at"),
    )
    return enriched.withColumns(
        {
            "user_trust_level": L.trust_level(
                F.col("data_quality_score"), F.col("completeness_flag")
            ),
            "days_since_registration": days,
            "user_age_segment": L.age_segment(days),
        }
    )


def status_counts(stg: DataFrame) -> DataFrame:
    """Transactions per user and status."""
    count = lambda s: F.count_if(F.col("status") == s)
    return stg.groupBy("user_id").agg(
        count("COMPLETED").alias("completed_transactions"),
        count("FAILED").alias("failed_transactions"),
        count("PENDING").alias("pending_transactions"),
    )


def spending_base(stg: DataFrame) -> DataFrame:
    """Number, sum and last arrival of a user's distinct transactions."""
    return stg.groupBy("user_id").agg(
        F.count_distinct("transaction_id").alias("transaction_count"),
        _money("amount").alias("total_spent"),
        F.max("ingested_at").alias("last_transaction_date"),
    )


def transaction_sequence(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions with the user's country and their running number by arrival."""
    order = [F.col("ingested_at").asc_nulls_last(), F.col("transaction_id").asc_nulls_last()]
    rows = transactions.select("transaction_id", "user_id", "amount", "currency", "ingested_at")
    numbered = with_group_sequence(rows, "user_id", order, "txn_seq")
    countries = users.select("user_id", F.col("country").alias("user_country"))
    heavy = heavy_keys(transactions, "user_id")
    return salted_left_join(
        numbered, countries, "user_id", heavy, F.col("transaction_id")
    ).select("transaction_id", "user_id", "amount", "currency", "user_country", "txn_seq")
