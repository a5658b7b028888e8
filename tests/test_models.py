"""Models on hand-written rows: NULL keys, hot keys, users without completed rows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.plans import intermediate as I
from tidegate.plans import marts, staging

AS_OF = datetime(2024, 2, 1)
SCHEMA = (
    "transaction_id string, user_id int, product_category string, amount decimal(10,2), "
    "currency string, transaction_date timestamp_ntz, status string, "
    "processed_at timestamp_ntz, data_quality_score decimal(3,2), ingested_at timestamp_ntz"
)


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def row(i, user=1, category="BOOKS", amount="10", day=1, status="completed", score="1.0"):
    at = None if day is None else datetime(2024, 1, day, 12)
    return (
        f"t{i}", user, category, None if amount is None else D(amount), "USDX", at, status,
        AS_OF, None if score is None else D(score), at,
    )


@pytest.fixture(scope="module")
def mixed(spark):
    """User 0 holds a third of all rows, all failed; another third has no user."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        kind = i % 3
        user = 0 if kind == 0 else None if kind == 1 else rng.randint(1, 25)
        status = "FAILED" if kind == 0 else rng.choice(["COMPLETED", "COMPLETED", "PENDING"])
        rows.append(
            row(
                i, user, rng.choice(["a", "b", None]),
                rng.choice([None, "5.01", "5.01", "700", "-3", "0"]),
                rng.choice([None, *range(1, 20)]), status, rng.choice(["1.0", "0.7", "0.65", None]),
            )
        )
    return make(spark, rows)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_staging_types_and_flags(spark):
    df = staging.stg_transactions(
        make(spark, [row(1, amount="-0.01", day=7), row(2, amount=None, day=None, score=None)]), AS_OF
    )
    assert len(df.columns) == 20
    assert df.schema["user_id"].metadata["pii_sensitivity"] == "high"
    a, b = df.orderBy("transaction_id").collect()
    assert (a["product_category"], a["currency"], a["status"]) == ("books", "USD", "COMPLETED")
    assert (a["transaction_day_of_week"], a["is_weekend"], a["is_anomaly"]) == (0, True, True)
    assert (a["transaction_day"], a["transaction_hour"]) == (datetime(2024, 1, 7), 12)
    assert (b["is_weekend"], b["is_anomaly"]) == (False, False)
    assert (b["data_quality_tier"], b["transaction_value_tier"]) == ("low", "low_value")


def test_tier_uses_the_score_before_rounding(spark):
    df = make(spark, [row(1)]).withColumn("data_quality_score", F.lit(D("0.8999")))
    r = staging.stg_transactions(df, AS_OF).first()
    assert (r["data_quality_score"], r["data_quality_tier"]) == (D("0.90"), "medium")


def test_minimal_staging(spark):
    assert len(staging.stg_transactions_minimal(make(spark, [row(1)])).columns) == 9


PLAIN = """
SELECT user_id, count(*) AS total_transactions, count(DISTINCT transaction_day) AS active_days,
  count(DISTINCT product_category) AS unique_categories,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount, min(amount) AS min_transaction_amount,
  max(amount) AS max_transaction_amount,
  round(percentile(CAST(amount AS DOUBLE), 0.5), 6) AS median_transaction_amount,
  round(stddev_samp(CAST(amount AS DOUBLE)), 6) AS stddev_transaction_amount,
  min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
FROM {stg} WHERE status = 'COMPLETED' GROUP BY user_id"""


def test_user_metrics_equal_the_plain_aggregate(spark, mixed):
    stg = staging.stg_transactions(mixed, AS_OF)
    want = spark.sql(PLAIN, stg=stg)
    got = I.user_metrics(stg)
    for c in ("median_transaction_amount", "stddev_transaction_amount"):
        got = got.withColumn(c, F.round(c, 6))
    assert got.where("user_id = 0").count() == 0
    assert rows_of(got.select(want.columns)) == rows_of(want)


def test_moving_average_skips_days_without_completed_rows(spark):
    rows = [row(d, amount=str(d), day=d) for d in range(1, 10)]
    rows.append(row(99, amount="1000", day=20, status="FAILED"))
    days = I.daily_metrics(staging.stg_transactions(make(spark, rows), AS_OF))
    got = {r["transaction_day"].day: r["daily_amount_7day_moving_avg"] for r in days.collect()}
    assert 20 not in got
    assert got[1] == D("1") and got[7] == D("4") and got[9] == D("6")


def test_enriched_rows_are_the_same_by_broadcast_and_by_shuffle(spark, mixed):
    stg = staging.stg_transactions(mixed, AS_OF)
    plain = I.int_transactions(stg)
    assert len(plain.columns) == 41
    assert plain.count() == 900
    metrics = I.transaction_metrics(stg)
    assert metrics.users.heavy.count() >= 2
    spread = I.int_transactions(stg, metrics, max_broadcast=-1)
    assert rows_of(spread) == rows_of(plain)


def test_hot_rows_are_salted_and_the_rest_is_joined_by_key(spark, mixed, plan_of):
    stg = staging.stg_transactions(mixed, AS_OF)
    metrics = I.transaction_metrics(stg)
    plan = plan_of(I.int_transactions(stg, metrics, max_broadcast=-1))
    assert "_slice" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_reliability_and_deviation(spark):
    rows = [row(i, user=1, amount="10") for i in range(11)]
    rows += [row(50, user=2, category="TOYS", amount="20"), row(51, user=2, category="TOYS", amount="10")]
    rows += [row(60, user=3, category=None, amount="5", score="0.5", status="PENDING")]
    df = I.int_transactions(staging.stg_transactions(make(spark, rows), AS_OF))
    r = {x["transaction_id"]: x for x in df.collect()}
    assert r["t0"]["composite_reliability_score"] == D("0.80")  # 0.4 + 0.3 + 0.1
    assert r["t50"]["composite_reliability_score"] == D("0.80")  # 0.4 + 0.1 + 0.3
    assert r["t51"]["composite_reliability_score"] == D("0.60")
    assert r["t60"]["composite_reliability_score"] == D("0.40")  # 0.2 + 0.1 + 0.1
    assert r["t50"]["deviation_from_user_avg_pct"] == D("33.33")
    assert r["t60"]["deviation_from_user_avg_pct"] is None
    assert r["t60"]["user_total_transactions"] is None


def test_no_deviation_from_a_mean_that_is_not_positive(spark):
    rows = [row(1, amount="-4"), row(2, amount="4"), row(3, user=2, amount="-1")]
    df = I.int_transactions(staging.stg_transactions(make(spark, rows), AS_OF))
    assert [x["deviation_from_user_avg_pct"] for x in df.collect()] == [None] * 3


def test_sequence_and_country(spark, mixed):
    users = spark.createDataFrame([(0, "EC"), (3, "PE")], "user_id int, country string")
    spread = I.transaction_sequence(mixed, users)
    by_arrival = Window.partitionBy("user_id").orderBy(
        F.col("ingested_at").asc_nulls_last(), F.col("transaction_id").asc_nulls_last()
    )
    plain = mixed.withColumn("txn_seq", F.row_number().over(by_arrival)).join(
        users.withColumnRenamed("country", "user_country"), "user_id", "left"
    )
    assert rows_of(plain.select(spread.columns)) == rows_of(spread)
    top = {r["user_id"]: r["m"] for r in spread.groupBy("user_id").agg(F.max("txn_seq").alias("m")).collect()}
    assert top[0] == 300 and top[None] == 300


USERS = (
    "user_id int, first_name string, last_name string, email string, ip_address string, "
    "country string, registration_date date, processed_at timestamp_ntz, "
    "data_quality_score decimal(3,2)"
)


@pytest.fixture(scope="module")
def people(spark):
    day = AS_OF.date()
    rows = [
        (1, "ANA", "o'neil", "Ana@X.org", "10.0.0.1", "Ecuador", day - timedelta(30), AS_OF, D("1.0")),
        (2, None, "li", None, "10.0.0.2", "Peru", day - timedelta(31), AS_OF, D("0.95")),
        (3, "b", "c", "b@x.org", "10.0.0.3", "Peru", day - timedelta(200), AS_OF, D("0.7")),
        (4, "d", "e", "d@x.org", "10.0.0.4", "Peru", None, AS_OF, D("0.5")),
        (5, "f", "g", "f@x.org", "10.0.0.5", "Peru", day, AS_OF, None),
    ]
    rows = spark.createDataFrame(rows, USERS)
    sales = [row(i, user=1, amount="100") for i in range(50)] + [row(90 + i, user=3) for i in range(4)]
    stg = staging.stg_transactions(make(spark, sales), AS_OF)
    return I.int_users(staging.stg_users(rows, AS_OF), I.activity_base(I.day_cells(stg)), AS_OF)


def test_users_get_defaults_without_activity(people):
    r = {x["user_id"]: x for x in people.collect()}
    assert (r[2]["total_transactions"], r[2]["total_lifetime_value"]) == (0, D("0.00"))
    assert (r[2]["user_activity_segment"], r[2]["last_transaction_date"]) == ("no_activity", None)
    assert (r[2]["full_name"], r[2]["has_missing_email"]) == (" Li", True)
    assert (r[1]["first_name"], r[1]["last_name"], r[1]["email"]) == ("Ana", "O'Neil", "ana@x.org")
    assert [r[i]["user_trust_level"] for i in (1, 2, 3, 4, 5)] == [
        "trusted", "acceptable", "acceptable", "needs_review", "needs_review",
    ]
    assert [r[i]["user_age_segment"] for i in (1, 2, 3, 4)] == [
        "new_user", "recent_user", "established_user", "established_user",
    ]


def test_dimension_segments(people):
    r = {x["user_id"]: x for x in marts.dim_users(people, AS_OF).collect()}
    assert set(r) == {1, 2, 3}
    assert (r[1]["customer_segment"], r[1]["rfm_score"], r[1]["is_active_user"]) == ("VIP_Customer", 5, True)
    assert (r[2]["customer_segment"], r[2]["churn_risk_level"]) == ("No_Activity", "high_churn_risk")
    assert (r[3]["customer_segment"], r[3]["rfm_score"], r[3]["is_churned_user"]) == ("One_Time_Buyer", 2, True)
    assert r[2]["engagement_score"] == 25


def test_dimension_has_no_join_on_itself(people, plan_of):
    plan = plan_of(marts.dim_users(people, AS_OF))
    assert plan.split("(1)")[0].count("Join") == 1  # users with their activity


def test_analyst_views_hide_people(people):
    fact = marts.fct_users(people)
    assert {x["user_id"] for x in fact.collect()} == {1, 2, 3}
    r = {x["user_id"]: x for x in marts.analytics_users(fact, "s").collect()}
    assert r[1]["user_display_name"] == "A****" and r[2]["pseudo_email"] is None
    assert len(r[1]["pseudo_ip_address"]) == 64
    assert r[3]["cohort_month"].day == 1


def test_short_names_are_hidden_wholly(spark, people):
    fact = marts.fct_users(people).withColumn("full_name", F.lit(" x"))
    assert {r["user_display_name"] for r in marts.analytics_users(fact, "s").collect()} == {"****"}


def test_fact_filter_does_not_reach_the_metrics(spark):
    rows = [row(1, amount="10"), row(2, amount="30", score="0.5"), row(3, amount="-10")]
    fact = marts.fct_transactions(I.int_transactions(staging.stg_transactions(make(spark, rows), AS_OF)))
    (only,) = fact.collect()
    assert len(fact.columns) == 32
    assert (only["user_total_transactions"], only["user_total_amount"]) == (3, D("30.00"))
    assert (only["transaction_day_name"], only["day_type"]) == ("Lunes", "Dia Laboral")
