"""Truth tables at and around every bound, NULL included."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidegate.functions import labels as L
from tidegate.functions import scalars as S


def results(spark, schema, rows, column):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in df.select(column.alias("out"), "i").orderBy("i").collect()]


def test_quality_tier(spark):
    rows = [(D("0.9"),), (D("0.8999"),), (D("0.7"),), (D("0.6999"),), (None,)]
    got = results(spark, "x decimal(5,4)", rows, L.quality_tier(F.col("x")))
    assert got == ["high", "medium", "medium", "low", "low"]


def test_value_tier(spark):
    rows = [(D(x),) for x in ("1000", "999.99", "100", "99.99", "0", "-0.01")] + [(None,)]
    got = results(spark, "x decimal(10,2)", rows, L.value_tier(F.col("x")))
    assert got == ["high_value", "medium_value", "medium_value"] + ["low_value"] * 4


def test_activity_segment(spark):
    got = results(
        spark, "n bigint", [(n,) for n in (0, 9, 10, 49, 50)], L.activity_segment(F.col("n"))
    )
    assert got == ["low_activity"] * 2 + ["medium_activity"] * 2 + ["high_activity"]


def test_customer_segment_and_score(spark):
    rows = [
        (50, D("5000")), (50, D("4999.99")), (49, D("9999")), (20, D("1000")), (20, D("999.99")),
        (19, D("9999")), (5, D("0")), (4, D("9999")), (1, D("0")), (0, D("0")),
    ]
    segment = L.customer_segment(F.col("n"), F.col("v"))
    got = results(spark, "n bigint, v decimal(15,2)", rows, segment)
    assert got == [
        "VIP_Customer", "Premium_Customer", "Premium_Customer", "Premium_Customer",
        "Regular_Customer", "Regular_Customer", "Regular_Customer", "One_Time_Buyer",
        "One_Time_Buyer", "No_Activity",
    ]
    score = results(spark, "n bigint, v decimal(15,2)", rows, L.segment_score(segment))
    assert score == [5, 4, 4, 4, 3, 3, 3, 2, 2, 1]


def test_age_trust_churn_engagement(spark):
    ages = results(
        spark, "d int", [(d,) for d in (30, 31, 180, 181, None)], L.age_segment(F.col("d"))
    )
    assert ages == ["new_user", "recent_user", "recent_user", "established_user", "established_user"]
    rows = [(D("0.9"), "complete"), (D("0.9"), "missing_email"), (D("0.7"), "complete"),
            (D("0.69"), "complete"), (None, "complete")]
    trust = results(
        spark, "s decimal(3,2), c string", rows, L.trust_level(F.col("s"), F.col("c"))
    )
    assert trust == ["trusted", "acceptable", "acceptable", "needs_review", "needs_review"]
    rows = [(None, "high_activity"), (1, "high_activity"), (1, "medium_activity"), (1, "no_activity")]
    churn = results(spark, "d int, a string", rows, L.churn_risk(F.col("d"), F.col("a")))
    assert churn == ["unknown", "low_churn_risk", "medium_churn_risk", "high_churn_risk"]
    rows = [("high", "complete"), ("medium", "complete"), ("low", "complete"), ("high", "missing_email")]
    points = results(spark, "t string, c string", rows, L.engagement(F.col("t"), F.col("c")))
    assert points == [100, 75, 50, 25]


def test_calendar_names(spark):
    months = [(m,) for m in (1, 3, 4, 6, 7, 9, 10, 12, None)]
    assert results(spark, "m int", months, L.quarter_label(F.col("m"))) == [
        "Q1", "Q1", "Q2", "Q2", "Q3", "Q3", "Q4", "Q4", "Q4",
    ]
    assert results(spark, "m int", months, L.semester_label(F.col("m"))) == ["H1"] * 4 + ["H2"] * 5
    days = [(d,) for d in (0, 1, 6, None)]
    assert results(spark, "d int", days, L.day_name(F.col("d"))) == [
        "Domingo", "Lunes", "Sabado", None,
    ]
    kinds = results(spark, "d int", days, L.day_kind(F.col("d")))
    assert kinds == ["Fin de Semana", "Dia Laboral", "Fin de Semana", "Dia Laboral"]


def test_freshness_bounds(spark):
    rows = [(7199,), (7200,), (21599,), (21600,), (None,)]
    got = results(spark, "s int", rows, L.freshness(F.col("s")))
    assert got == ["FRESH", "STALE", "STALE", "MISSING", "MISSING"]


def test_simple_segment(spark):
    rows = [(D("5000.01"),), (D("5000"),), (D("1000"),), (None,)]
    got = results(spark, "x decimal(10,2)", rows, L.simple_segment(F.col("x")))
    assert got == ["VIP", "Premium", "Standard", "Standard"]


@pytest.mark.parametrize(
    "text, words",
    [
        ("o'neil ana-maria", "O'Neil Ana-Maria"),
        ("JOSÉ ángel", "José Ángel"),
        ("mary  ann", "Mary  Ann"),
        ("3com 2nd", "3com 2nd"),
        ("a.b_c/d", "A.B_C/D"),
        ("", ""),
        (None, None),
    ],
)
def test_capitalise_words(spark, text, words):
    assert results(spark, "x string", [(text,)], S.capitalise_words(F.col("x"))) == [words]


def test_concat_and_average(spark):
    both = S.concat_text(F.col("a"), F.lit(" "), F.col("b"))
    assert results(spark, "a string, b string", [("x", None), (None, None)], both) == ["x ", " "]
    mean = S.average(F.col("t"), F.col("n"))
    got = results(spark, "t decimal(20,2), n bigint", [(D("10"), 4), (None, 0)], mean)
    assert got == [D("2.500000"), None]
    # the exact mean 1.00499999... must not become 1.005 on its way to two decimals
    cases = [(D("1004999.99"), 10**6), (D("-0.05"), 10), (D("0.05"), 10), (D("0.04"), 10)]
    got = results(spark, "t decimal(20,2), n bigint", cases, S.average(F.col("t"), F.col("n"), 2))
    assert got == [D("1.00"), D("-0.01"), D("0.01"), D("0.00")]


def test_day_of_week_starts_on_sunday(spark):
    from datetime import datetime

    rows = [(datetime(2024, 1, 7),), (datetime(2024, 1, 13),), (None,)]
    assert results(spark, "t timestamp_ntz", rows, S.day_of_week(F.col("t"))) == [0, 6, None]
