"""Tiers, segments and calendar names.

Bounds and label texts are fixed values that reports depend on.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ladder

# Lower bound, label; the last text is what remains.
QUALITY_TIERS = ([(Decimal("0.9"), "high"), (Decimal("0.7"), "medium")], "low")
VALUE_TIERS = ([(1000, "high_value"), (100, "medium_value")], "low_value")
ACTIVITY_SEGMENTS = ([(50, "high_activity"), (10, "medium_activity")], "low_activity")
# Minimum transactions, minimum lifetime value, segment, score.
CUSTOMER_SEGMENTS = [
    (50, 5000, "VIP_Customer", 5),
    (20, 1000, "Premium_Customer", 4),
    (5, None, "Regular_Customer", 3),
    (1, None, "One_Time_Buyer", 2),
]
NO_SEGMENT = ("No_Activity", 1)
# Names of the days, Sunday first, and kinds of day.
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado"]
WEEKEND, WORKDAY = "Fin de Semana", "Dia Laboral"

COMPLETE, MISSING_EMAIL = "complete", "missing_email"


def quality_tier(score: Column) -> Column:
    return ladder(score, *QUALITY_TIERS)


def value_tier(amount: Column) -> Column:
    return ladder(amount, *VALUE_TIERS)


def activity_segment(n: Column) -> Column:
    return ladder(n, *ACTIVITY_SEGMENTS)


def completeness(email: Column) -> Column:
    return F.when(email.isNull(), F.lit(MISSING_EMAIL)).otherwise(F.lit(COMPLETE))


def trust_level(score: Column, complete_flag: Column) -> Column:
    return (
        F.when((score >= F.lit(Decimal("0.9"))) & (complete_flag == COMPLETE), F.lit("trusted"))
        .when(score >= F.lit(Decimal("0.7")), F.lit("acceptable"))
        .otherwise(F.lit("needs_review"))
    )


def age_segment(days: Column) -> Column:
    return (
        F.when(days <= 30, F.lit("new_user"))
        .when(days <= 180, F.lit("recent_user"))
        .otherwise(F.lit("established_user"))
    )


def customer_segment(n: Column, lifetime_value: Column) -> Column:
    out = None
    for min_n, min_value, label, _ in CUSTOMER_SEGMENTS:
        test = n >= min_n if min_value is None else (n >= min_n) & (lifetime_value >= min_value)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(NO_SEGMENT[0]))


def segment_score(segment: Column) -> Column:
    out = None
    for _, _, label, score in CUSTOMER_SEGMENTS:
        test = segment == label
        out = F.when(test, F.lit(score)) if out is None else out.when(test, F.lit(score))
    return out.otherwise(F.lit(NO_SEGMENT[1]))


def churn_risk(days: Column, segment: Column) -> Column:
    return (
        F.when(days.isNull(), F.lit("unknown"))
        .when(segment == "high_activity", F.lit("low_churn_risk"))
        .when(segment == "medium_activity", F.lit("medium_churn_risk"))
        .otherwise(F.lit("high_churn_risk"))
    )


def engagement(tier: Column, complete_flag: Column) -> Column:
    points = F.when(tier == "high", 100).when(tier == "medium", 75).otherwise(50)
    return F.when(complete_flag == COMPLETE, points).otherwise(25)


def simple_segment(total: Column) -> Column:
    return F.when(total > 5000, F.lit("VIP")).when(total > 1000, F.lit("Premium")).otherwise(
        F.lit("Standard")
    )


def quarter_label(month: Column) -> Column:
    return F.concat(F.lit("Q"), F.coalesce(F.ceil(month / F.lit(3)), F.lit(4)).cast("string"))


def semester_label(month: Column) -> Column:
    return F.when(month <= 6, F.lit("H1")).otherwise(F.lit("H2"))


def day_name(dow: Column) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.get(names, dow)


def day_kind(dow: Column) -> Column:
    return F.when(dow.isin(0, 6), F.lit(WEEKEND)).otherwise(F.lit(WORKDAY))


def freshness(age_seconds: Column, fresh_hours: int = 2, stale_hours: int = 6) -> Column:
    return (
        F.when(age_seconds < fresh_hours * 3600, F.lit("FRESH"))
        .when(age_seconds < stale_hours * 3600, F.lit("STALE"))
        .otherwise(F.lit("MISSING"))
    )
