"""Declared tests on models: unique, not null, accepted values, accepted range."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ModelTest:
    model: str
    column: str
    kind: str  # unique | not_null | accepted_values | accepted_range
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True


def _fails(t: ModelTest):
    """Whether a row breaks a row-wise test; NULL breaks `not_null` only."""
    c = F.col(t.column)
    if t.kind == "not_null":
        return c.isNull()
    if t.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(*t.values)
    if t.kind == "accepted_range":
        bad = F.lit(False)
        if t.low is not None:
            bad = bad | (c < t.low if t.inclusive else c <= t.low)
        if t.high is not None:
            bad = bad | (c > t.high if t.inclusive else c >= t.high)
        return c.isNotNull() & bad
    raise ValueError(f"unknown test {t.kind}")


def _line(t: ModelTest, failures):
    return F.struct(
        F.lit(t.model).alias("model"),
        F.lit(t.column).alias("column_name"),
        F.lit(t.kind).alias("test"),
        failures.cast("long").alias("failures"),
    )


def run_tests(models: dict[str, DataFrame], tests: list[ModelTest]) -> DataFrame:
    """One line per test with its failures: rows, or repeated values for `unique`.

    Row-wise tests of a model share one scan; `unique` counts per value.
    """
    frames = []
    for model, df in models.items():
        mine = [t for t in tests if t.model == model and t.column in df.columns]
        rowwise = [t for t in mine if t.kind != "unique"]
        if rowwise:
            row = df.agg(*[F.count_if(_fails(t)).alias(f"f{i}") for i, t in enumerate(rowwise)])
            lines = [_line(t, F.col(f"f{i}")) for i, t in enumerate(rowwise)]
            frames.append(row.select(F.inline(F.array(*lines))))
        for t in mine:
            if t.kind == "unique":
                groups = df.groupBy(F.col(t.column).alias("value")).agg(
                    F.count(F.lit(1)).alias("n")
                )
                repeated = F.col("value").isNotNull() & (F.col("n") > 1)
                row = groups.agg(F.count_if(repeated).alias("f"))
                frames.append(row.select(F.inline(F.array(_line(t, F.col("f"))))))
    return reduce(DataFrame.unionByName, frames).withColumn("passed", F.col("failures") == 0)


def check(model: str, column: str, *kinds: str, **kw) -> list[ModelTest]:
    return [ModelTest(model, column, k, **kw) for k in kinds]


# The tests declared for the models and their sources.
DECLARED = [
    *check("stg_raw_transactions", "transaction_id", "unique", "not_null"),
    *check("stg_raw_transactions", "user_id", "not_null"),
    *check("stg_raw_transactions", "product_category", "not_null"),
    *check("stg_raw_transactions", "amount", "not_null"),
    *check("stg_raw_transactions", "amount", "accepted_range", low=0, inclusive=False),
    *check("stg_raw_transactions", "currency", "accepted_values", values=("USD", "EUR", "GBP")),
    *check(
        "stg_raw_transactions", "status", "accepted_values",
        values=("COMPLETED", "PENDING", "FAILED"),
    ),
    *check("stg_raw_transactions", "data_quality_score", "accepted_range", low=0, high=1),
    *check(
        "stg_raw_transactions", "data_quality_tier", "accepted_values",
        values=("high", "medium", "low"),
    ),
    *check(
        "stg_raw_transactions", "transaction_value_tier", "accepted_values",
        values=("high_value", "medium_value", "low_value"),
    ),
    *check("int_transactions_enriched", "transaction_id", "unique", "not_null"),
    *check(
        "int_transactions_enriched", "composite_reliability_score", "accepted_range",
        low=0, high=1,
    ),
    *check("fct_transactions", "transaction_id", "unique", "not_null"),
    *check("fct_transactions", "amount", "not_null"),
    *check("fct_transactions", "amount", "accepted_range", low=0),
    *check("fct_transactions", "data_quality_score", "accepted_range", low=0.7),
    *check("fct_transactions", "is_anomaly", "accepted_values", values=(True, False)),
    *check("dim_users", "user_id", "unique", "not_null"),
    *check("dim_users", "lifetime_value", "not_null"),
    *check("dim_users", "is_active_user", "accepted_values", values=(True, False)),
    *check("dim_users", "is_churned_user", "accepted_values", values=(True, False)),
    *check("dim_users", "rfm_score", "accepted_range", low=1, high=5),
    *check("prod.raw_transactions", "transaction_id", "unique", "not_null"),
    *check("prod.raw_transactions", "user_id", "not_null"),
    *check("prod.raw_transactions", "amount", "not_null"),
    *check("prod.raw_users", "user_id", "unique", "not_null"),
    *check("prod.raw_users", "registration_date", "not_null"),
]
