"""Staging models: typed, normalised rows of the published tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import masking as M
from ..functions import scalars as S

# What the declared models say about a user's id.
USER_ID_METADATA = {
    "pii": True,
    "pii_category": "direct_identifier",
    "pii_sensitivity": "high",
    "access_restrictions": "production_only",
    "retention_days": 365,
}
TRANSACTION_SOURCE = [
    "transaction_id", "user_id", "product_category", "amount", "currency",
    "transaction_date", "status", "processed_at", "data_quality_score",
]


def stg_transactions(source: DataFrame, as_of: datetime) -> DataFrame:
    """One row per published transaction. A `transaction_key` of the source is kept."""
    extra = [c for c in ("transaction_key",) if c in source.columns]
    when = F.col("transaction_date").cast("timestamp_ntz")
    day_number = S.day_of_week(when)
    amount = F.round(F.col("amount").cast("decimal(10,2)"), 2).cast("decimal(10,2)")
    score = F.round(F.col("data_quality_score").cast("decimal(3,2)"), 2).cast("decimal(3,2)")
    return source.select(
        F.left(F.col("transaction_id").cast("string"), F.lit(50)).alias("transaction_id"),
        F.col("user_id").cast("int").alias("user_id", metadata=USER_ID_METADATA),
        F.lower("product_category").alias("product_category"),
        F.left("currency", F.lit(3)).alias("currency"),
        amount.alias("amount"),
        when.alias("transaction_date"),
        F.to_date(when).cast("timestamp_ntz").alias("transaction_day"),
        F.year(when).alias("transaction_year"),
        F.month(when).alias("transaction_month"),
        F.dayofmonth(when).alias("transaction_day_of_month"),
        day_number.alias("transaction_day_of_week"),
        F.hour(when).alias("transaction_hour"),
        F.left(F.upper("status"), F.lit(20)).alias("status"),
        F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
        score.alias("data_quality_score"),
        L.quality_tier(F.col("data_quality_score")).alias("data_quality_tier"),
        L.value_tier(F.col("amount")).alias("transaction_value_tier"),
        S.moment(as_of).alias("dbt_transformed_at"),
        F.coalesce(amount < 0, F.lit(False)).alias("is_anomaly"),
        F.coalesce(day_number.isin(0, 6), F.lit(False)).alias("is_weekend"),
        *extra,
    )


def stg_transactions_minimal(source: DataFrame) -> DataFrame:
    """The plain projection that earlier builds of the staging model used."""
    return source.select(*TRANSACTION_SOURCE)


def stg_users(source: DataFrame, as_of: datetime) -> DataFrame:
    registered = F.col("registration_date").cast("date")
    score = F.round(F.col("data_quality_score").cast("decimal(3,2)"), 2).cast("decimal(3,2)")
    name = lambda c: F.left(S.capitalise_words(F.lower(c)), F.lit(100))
    typed = source.select(
        F.col("user_id").cast("int").alias("user_id"),
        name("first_name").alias("first_name"),
        name("last_name").alias("last_name"),
        F.left(F.lower("email"), F.lit(255)).alias("email"),
        F.left("ip_address", F.lit(39)).alias("ip_address"),
        F.left("country", F.lit(30)).alias("country"),
        registered.alias("registration_date"),
        F.year(registered).alias("registration_year"),
        F.month(registered).alias("registration_month"),
        score.alias("data_quality_score"),
        L.quality_tier(F.col("data_quality_score")).alias("data_quality_tier"),
        L.completeness(F.col("email")).alias("completeness_flag"),
        F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
        S.moment(as_of).alias("dbt_transformed_at"),
    )
    return typed.withColumns(
        {
            "full_name": S.concat_text(F.col("first_name"), F.lit(" "), F.col("last_name")),
            "is_complete": F.when(F.col("completeness_flag") == L.COMPLETE, 1).otherwise(0),
        }
    )


def stg_masked_transactions(stg: DataFrame) -> DataFrame:
    return stg.select(
        "transaction_id",
        M.mask_id(F.col("user_id")).alias("user_id_masked"),
        "product_category", "amount", "currency", "transaction_date", "status",
    )


def stg_masked_users(stg: DataFrame, strict: bool = True) -> DataFrame:
    """Masks of raw e-mails and addresses; feed it users that are not masked yet."""
    return stg.select(
        "user_id", "first_name", "last_name",
        M.mask_email(F.left("email", F.lit(255)), strict).alias("email_masked"),
        M.mask_ip(F.left("ip_address", F.lit(39))).alias("ip_address_masked"),
        "country", "registration_date", "processed_at",
    )
