"""Masked and pseudonymised views for developers, business analysts and analysts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masking import pseudonym_sha
from ..functions.scalars import concat_text


def _md5(value: Column, size: int = 32) -> Column:
    digest = F.md5(value.cast("string"))
    return digest if size == 32 else F.left(digest, F.lit(size))


def dev_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id",
        concat_text(F.lit("user_"), _md5(F.col("user_id"))).alias("user_id_masked"),
        "product_category", "amount", "currency", "transaction_date", "status",
    )


def dev_users(raw: DataFrame) -> DataFrame:
    email = F.coalesce(F.col("email"), F.lit("NULL"))
    hidden = lambda prefix, c, alias: concat_text(F.lit(prefix), _md5(c)).alias(alias)
    return raw.select(
        "user_id",
        hidden("dev_", F.col("first_name"), "first_name_masked"),
        hidden("dev_", F.col("last_name"), "last_name_masked"),
        hidden("user_", email, "email_masked"),
        hidden("ip_", F.col("ip_address"), "ip_address_masked"),
        "country", "registration_date",
    )


def prod_users(published: DataFrame) -> DataFrame:
    short = lambda c, alias: concat_text(F.lit("U"), _md5(F.col(c), 8)).alias(alias)
    return published.select(
        "user_id",
        short("first_name", "first_name_short"),
        short("last_name", "last_name_short"),
        "email", "ip_address", "country", "registration_date", "data_quality_score",
    )


def prod_transactions(published: DataFrame) -> DataFrame:
    return published.select(
        "transaction_id",
        concat_text(F.lit("U"), _md5(F.col("user_id"), 8)).alias("user_short_id"),
        "product_category", "amount", "currency",
        F.to_date("transaction_date").cast("timestamp_ntz").alias("transaction_day"),
        "status",
    )


def analyst_transactions(published: DataFrame, salt: str) -> DataFrame:
    return published.select(
        "transaction_id",
        pseudonym_sha(F.col("user_id"), salt).alias("user_pseudo_id"),
        "product_category", "amount", "currency", "transaction_date", "status",
        "data_quality_score",
    )


def analyst_users(published: DataFrame, salt: str) -> DataFrame:
    return published.select(
        "user_id", "first_name", "last_name",
        pseudonym_sha(F.col("email"), salt).alias("pseudo_email"),
        pseudonym_sha(F.col("ip_address"), salt).alias("pseudo_ip_address"),
        "registration_date", "country", "data_quality_score",
    )
