"""Text, calendar and ratio expressions with PostgreSQL's results."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AVERAGE_TYPE = "decimal(28,6)"


def concat_text(*parts: Column) -> Column:
    """CONCAT that reads NULL as the empty string."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def capitalise_words(text: Column) -> Column:
    """INITCAP with a new word after any character that is no letter or digit.

    Spark's `initcap` knows spaces only.
    """
    pieces = F.regexp_extract_all(
        F.lower(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1)
    )
    return F.array_join(
        F.transform(
            pieces,
            lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w))),
        ),
        "",
    )


def day_of_week(moment: Column) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return (F.dayofweek(moment) - F.lit(1)).cast("int")


def _rounded_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom of whole numbers, bottom positive, as a whole number; half away from zero."""
    doubled = (F.abs(top) * F.lit(2)).cast("decimal(38,0)") + bottom
    whole = F.call_function(
        "div", doubled.cast("decimal(38,0)"), (bottom * F.lit(2)).cast("decimal(38,0)")
    )
    return F.signum(top).cast("int") * whole


def average(total: Column, n: Column, places: int = 6) -> Column:
    """total / n of an amount in cents, NULL for n = 0, rounded once to `places` decimals."""
    count = F.nullif(n, F.lit(0)).cast("decimal(18,0)")
    steps = (total.cast("decimal(30,2)") * F.lit(10**places)).cast("decimal(38,0)")
    nearest = _rounded_ratio(steps, count).cast("decimal(28,0)")
    return (nearest * F.lit(Decimal(1).scaleb(-places))).cast(AVERAGE_TYPE)


def percent_above(value: Column, base_total: Column, base_n: Column) -> Column:
    """How far `value` lies above the mean total/n, in percent; NULL unless the mean is positive.

    Computed in whole cents and rounded once, half away from zero, so a mean that no
    binary fraction holds cannot tip the last digit.
    """
    cents = F.round(value.cast("decimal(26,2)") * F.lit(100)).cast("decimal(18,0)")
    total = F.round(base_total.cast("decimal(26,2)") * F.lit(100)).cast("decimal(28,0)")
    above = (cents * base_n.cast("decimal(15,0)") - total).cast("decimal(33,0)")
    steps = _rounded_ratio((above * F.lit(10_000)).cast("decimal(38,0)"), total)
    pct = steps.cast("decimal(20,0)") * F.lit(Decimal("0.01"))
    return F.when(base_total > 0, pct.cast("decimal(28,2)"))


def moment(as_of: datetime) -> Column:
    """A run's fixed point in time, as timestamp without time zone."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def ladder(value: Column, steps: list[tuple[float | int | str, str]], below: str) -> Column:
    """First label whose lower bound `value` reaches; NULL falls to `below`."""
    (bound, label), *rest = steps
    out = F.when(value >= F.lit(bound), F.lit(label))
    for bound, label in rest:
        out = out.when(value >= F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(below))
