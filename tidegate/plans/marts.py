"""Facts, the user dimension, and the pseudonymised views for analysts."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import masking as M
from ..functions import scalars as S

MIN_SCORE = Decimal("0.7")


def fct_transactions(enriched: DataFrame) -> DataFrame:
    """Completed, positive transactions of sufficient quality with calendar names.

    Newest first is an order for reading; sort the result where it is shown.
    """
    month, dow = F.col("transaction_month"), F.col("transaction_day_of_week")
    extra = [c for c in ("transaction_key",) if c in enriched.columns]
    return enriched.where(
        (F.col("data_quality_score") >= F.lit(MIN_SCORE))
        & (F.col("status") == "COMPLETED")
        & (F.col("amount") > 0)
    ).select(
        "transaction_id", "user_id", "product_category", "currency", "status",
        "transaction_value_tier", "data_quality_tier",
        "transaction_date", "transaction_day", "transaction_day_of_week",
        L.day_name(dow).alias("transaction_day_name"),
        "transaction_month", "transaction_year",
        L.quarter_label(month).alias("transaction_quarter"),
        L.semester_label(month).alias("transaction_semester"),
        L.day_kind(dow).alias("day_type"),
        "amount", "data_quality_score", "composite_reliability_score",
        "user_total_transactions", "user_total_amount", "user_avg_transaction_amount",
        "user_active_days", "user_value_quartile", "user_frequency_quartile",
        "category_avg_amount", "daily_transaction_count", "daily_total_amount",
        "daily_amount_7day_moving_avg", "is_anomaly", "is_weekend", "dbt_transformed_at",
        *extra,
    )


def dim_users(users: DataFrame, as_of: datetime) -> DataFrame:
    """Users with segment, churn risk and engagement.

    The segments are plain columns of the same row, so no self-join is needed.
    """
    activity = F.col("user_activity_segment")
    return (
        users.where((F.col("data_quality_score") >= F.lit(MIN_SCORE)) & F.col("user_id").isNotNull())
        .withColumns(
            {
                "customer_segment": L.customer_segment(
                    F.col("total_transactions"), F.col("total_lifetime_value")
                ),
                "churn_risk_level": L.churn_risk(F.col("days_since_registration"), activity),
            }
        )
        .select(
            "user_id", "first_name", "last_name", "full_name", "country",
            "registration_date", "registration_year", "registration_month",
            "total_transactions", "active_days",
            F.col("total_lifetime_value").alias("lifetime_value"),
            "avg_transaction_amount", "last_transaction_date", "user_activity_segment",
            activity.isin("high_activity", "medium_activity").alias("is_active_user"),
            (F.col("churn_risk_level") == "high_churn_risk").alias("is_churned_user"),
            "customer_segment", "churn_risk_level",
            L.engagement(F.col("data_quality_tier"), F.col("completeness_flag")).alias(
                "engagement_score"
            ),
            L.segment_score(F.col("customer_segment")).alias("rfm_score"),
            "data_quality_score", "data_quality_tier", "completeness_flag",
            "has_missing_email", "user_trust_level",
            "days_since_registration", "user_age_segment", "processed_at",
            S.moment(as_of).alias("dbt_processed_at"),
        )
    )


def fct_users(users: DataFrame) -> DataFrame:
    return users.where(F.col("user_trust_level").isin("trusted", "acceptable")).select(
        "user_id", "first_name", "last_name", "full_name", "email", "ip_address", "country",
        "registration_date", "registration_year", "registration_month",
        "total_transactions", "active_days", "total_lifetime_value", "avg_transaction_amount",
        "last_transaction_date", "user_activity_segment", "user_age_segment", "user_trust_level",
        "data_quality_score", "data_quality_tier", "processed_at",
        F.col("dbt_enriched_at").alias("transformed_at"),
    )


def analytics_transactions(fact: DataFrame, salt: str) -> DataFrame:
    return fact.select(
        "transaction_id",
        M.pseudonym_sha(F.col("user_id"), salt).alias("user_pseudo_id"),
        "product_category", "amount", "currency", "transaction_date", "status",
        "data_quality_score", "transaction_day", "transaction_quarter",
        "user_value_quartile", "user_frequency_quartile",
    )


def analytics_users(fact: DataFrame, salt: str) -> DataFrame:
    initial = F.concat(F.left("full_name", F.lit(1)), F.lit("****"))
    return fact.select(
        "user_id",
        F.when(F.length("full_name") > 2, initial).otherwise("****").alias("user_display_name"),
        M.pseudonym_sha(F.col("email"), salt).alias("pseudo_email"),
        M.pseudonym_sha(F.col("ip_address"), salt).alias("pseudo_ip_address"),
        "country", "user_age_segment", "user_activity_segment", "user_trust_level",
        "total_transactions", "total_lifetime_value", "avg_transaction_amount", "active_days",
        F.trunc("registration_date", "month").alias("cohort_month"),
        "last_transaction_date",
    )


def segment_rollup(users: DataFrame) -> DataFrame:
    """Users per segment and churn risk, largest group first."""
    return (
        users.groupBy("customer_segment", "churn_risk_level")
        .agg(F.count(F.lit(1)).alias("users"))
        .orderBy(F.col("users").desc(), "customer_segment", "churn_risk_level")
    )


def simple_segments(users: DataFrame, spending: DataFrame) -> DataFrame:
    """Users with the three-step segment by what they spent; both sides unique by user."""
    return users.join(spending, "user_id", "left").select(
        "user_id", "first_name", "last_name",
        L.simple_segment(F.col("total_spent")).alias("segment"),
    )
