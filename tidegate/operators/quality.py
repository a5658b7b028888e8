"""Expectation suites compiled to one aggregate over the table.

All row-wise expectations of a suite share a single scan; each column that must
be unique adds one grouped count. The outcome is a small frame with one line per
expectation.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASSED, FAILED, ERROR = "passed", "failed", "error"
NO_DATA = "Sin datos"  # fixed value: the message for an empty table

ROW_COUNT = "expect_table_row_count_to_be_between"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
REGEX = "expect_column_values_to_match_regex"
BETWEEN = "expect_column_values_to_be_between"
LENGTH = "expect_column_value_lengths_to_be_between"


@dataclass(frozen=True)
class Expectation:
    kind: str
    kwargs: dict
    description: str = ""
    severity: str = "?"

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")

    @property
    def mostly(self) -> float:
        return float(self.kwargs.get("mostly", 1.0))


@dataclass(frozen=True)
class Suite:
    name: str
    expectations: list[Expectation] = field(default_factory=list)


class MissingSuite(LookupError):
    pass


def suite_from_json(text: str) -> Suite:
    raw = json.loads(text)
    items = [
        Expectation(
            e["expectation_type"],
            e.get("kwargs") or {},
            e.get("meta", {}).get("description", e["expectation_type"]),
            e.get("meta", {}).get("severity", "?"),
        )
        for e in raw.get("expectations", [])
    ]
    return Suite(raw["expectation_suite_name"], items)


def load_suite(path: str) -> Suite:
    try:
        with open(path, encoding="utf-8") as f:
            return suite_from_json(f.read())
    except FileNotFoundError as e:
        raise MissingSuite(path) from e


def _in_range(value: Column, kwargs: dict) -> Column:
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    ok = F.lit(True)
    if low is not None:
        ok = ok & (value > F.lit(low) if kwargs.get("strict_min") else value >= F.lit(low))
    if high is not None:
        ok = ok & (value < F.lit(high) if kwargs.get("strict_max") else value <= F.lit(high))
    return ok


# What a non-null cell must satisfy.
CELL_CHECKS: dict[str, Callable[[Column, dict], Column]] = {
    IN_SET: lambda c, kw: c.isin(list(kw["value_set"])),
    REGEX: lambda c, kw: c.cast("string").rlike(kw["regex"]),
    BETWEEN: _in_range,
    LENGTH: lambda c, kw: _in_range(F.length(c), kw),
}
SUPPORTED = {ROW_COUNT, NOT_NULL, UNIQUE, *CELL_CHECKS}

RESULT_COLUMNS = [
    "expectation_no", "expectation_type", "column_name", "severity", "description",
    "element_count", "evaluated_count", "unexpected_count", "status",
]


def _compiles(exp: Expectation, df: DataFrame) -> bool:
    """Whether an expectation can be evaluated on `df`; one that cannot is reported as an error."""
    if exp.kind not in SUPPORTED:
        return False
    bounds = [exp.kwargs.get(k) for k in ("min_value", "max_value")]
    numeric = all(b is None or (isinstance(b, int | float | Decimal)) for b in bounds)
    if exp.kind == ROW_COUNT:
        return numeric
    if exp.column not in df.columns:
        return False
    kind = df.schema[exp.column].dataType
    if exp.kind == IN_SET:
        return isinstance(exp.kwargs.get("value_set"), list | tuple | set)
    if exp.kind == REGEX:
        return isinstance(exp.kwargs.get("regex"), str) and _is_pattern(df, exp.kwargs["regex"])
    if exp.kind == LENGTH:
        return numeric and isinstance(kind, T.StringType | T.BinaryType)
    if exp.kind == BETWEEN:
        return numeric and isinstance(kind, T.NumericType)
    return True


def _is_pattern(df: DataFrame, regex: str) -> bool:
    try:
        df.sparkSession.sparkContext._jvm.java.util.regex.Pattern.compile(regex)
    except IllegalArgumentException:
        return False
    return True


def _line(no: int, exp: Expectation, total: Column, seen: Column, bad: Column, ok: Column) -> Column:
    """One result as a struct over the columns of a one-line aggregate."""
    status = F.when(total == 0, F.lit(FAILED)).when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED))
    return F.struct(
        F.lit(no).alias("expectation_no"),
        F.lit(exp.kind).alias("expectation_type"),
        F.lit(exp.column).cast("string").alias("column_name"),
        F.lit(exp.severity).alias("severity"),
        F.lit(exp.description).alias("description"),
        total.cast("long").alias("element_count"),
        seen.cast("long").alias("evaluated_count"),
        bad.cast("long").alias("unexpected_count"),
        status.alias("status"),
    )


def _share_ok(seen: Column, bad: Column, mostly: float) -> Column:
    return (seen == 0) | ((seen - bad).cast("double") / F.nullif(seen, F.lit(0)) >= F.lit(mostly))


def _exploded(aggregate: DataFrame, lines: list[Column]) -> DataFrame:
    return aggregate.select(F.inline(F.array(*lines)))


#: Gives the result of a suite without expectations its columns.
_NOTHING = Expectation(ROW_COUNT, {})


@dataclass
class Compiled:
    """A suite over the columns of a table: one row of aggregates, and what to make of it."""

    aggregates: dict[str, Column]
    lines: list[Column]
    unique: list[tuple[int, Expectation]]

    def results(self, row: DataFrame | None, df: DataFrame) -> DataFrame:
        """One line per expectation; `row` holds the aggregates, `df` the rows themselves.

        `df` is read only for columns that must be unique, with a grouped count each.
        """
        frames = [_unique(df, no, exp) for no, exp in self.unique]
        if self.lines:
            frames.insert(0, _exploded(row, self.lines))
        if not frames:
            nothing = df.select(F.array(_line(0, _NOTHING, *[F.lit(0)] * 3, F.lit(True))).alias("lines"))
            return nothing.where("false").select(F.inline("lines"))
        return reduce(DataFrame.unionByName, frames)


def compile_suite(df: DataFrame, suite: Suite) -> Compiled:
    """The aggregates and result lines of a suite for tables with the columns of `df`."""
    aggregates = {"total": F.count(F.lit(1))}
    lines, unique = [], []
    total = F.col("total")
    for no, exp in enumerate(suite.expectations, start=1):
        if not _compiles(exp, df):
            none = F.lit(None)
            status = F.lit(ERROR)
            line = _line(no, exp, total, none, none, F.lit(False))
            lines.append(line.withField("status", status))
        elif exp.kind == ROW_COUNT:
            ok = _in_range(total, exp.kwargs)
            lines.append(_line(no, exp, total, total, F.when(ok, 0).otherwise(1), ok))
        elif exp.kind == UNIQUE:
            unique.append((no, exp))
        else:
            cell = F.col(exp.column)
            bad, seen = f"bad_{no}", f"seen_{no}"
            if exp.kind == NOT_NULL:
                aggregates[seen] = F.count(F.lit(1))
                aggregates[bad] = F.count_if(cell.isNull())
            else:
                aggregates[seen] = F.count(cell)
                aggregates[bad] = F.count_if(
                    cell.isNotNull() & ~CELL_CHECKS[exp.kind](cell, exp.kwargs)
                )
            ok = _share_ok(F.col(seen), F.col(bad), exp.mostly)
            lines.append(_line(no, exp, total, F.col(seen), F.col(bad), ok))
    return Compiled(aggregates, lines, unique)


def _one_row(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in aggregates.items()])


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One line per expectation, in the order of the suite by `expectation_no`."""
    compiled = compile_suite(df, suite)
    return compiled.results(_one_row(df, compiled.aggregates), df)


class Watched:
    """Audit numbers that are taken while a table is written, without reading it again.

    Write `rows` somewhere; the row count, the NULL counts and all row-wise expectations of
    both suites are then known. Spark counts each written partition once, whichever of its
    attempts succeeds. Columns that must be unique still need their grouped count.
    """

    def __init__(self, df: DataFrame, critical: Suite, warning: Suite, nulls: dict[str, str]):
        self.critical, self.nulls = critical, nulls
        both = Suite("both", [*critical.expectations, *warning.expectations])
        self._compiled = compile_suite(df, both)
        counts = {f"null_{name}": F.count_if(F.col(c).isNull()) for c, name in nulls.items()}
        self._aggregates = {**self._compiled.aggregates, **counts}
        self._seen = Observation()
        self.rows = df.observe(self._seen, *[c.alias(n) for n, c in self._aggregates.items()])

    def counted(self) -> dict[str, int]:
        """The numbers, once `rows` are written; nothing was written counts as no rows."""
        found = self._seen.get
        return {name: found.get(name) or 0 for name in self._aggregates}

    def null_counts(self) -> dict[str, int]:
        """As `null_profile`."""
        found = self.counted()
        return {**{n: found[f"null_{n}"] for n in self.nulls.values()}, "total": found["total"]}

    def lines(self, written: DataFrame) -> DataFrame:
        """As `run_audit` over the written table, which is read only where values must be unique."""
        found = self.counted()
        names = list(self._compiled.aggregates)
        row = written.sparkSession.createDataFrame(
            [tuple(found[n] for n in names)], ", ".join(f"{n} long" for n in names)
        )
        return _with_tier(self._compiled.results(row, written), self.critical)


def _unique(df: DataFrame, no: int, exp: Expectation) -> DataFrame:
    """Every row of a repeated value is unexpected; NULLs are left out."""
    groups = df.groupBy(F.col(exp.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    row = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("seen"),
        F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("bad"),
    )
    ok = _share_ok(F.col("seen"), F.col("bad"), exp.mostly)
    return _exploded(row, [_line(no, exp, F.col("total"), F.col("seen"), F.col("bad"), ok)])


def failure_text() -> Column:
    """The message of a failed line of a result frame."""
    return (
        F.when(F.col("status") == ERROR, F.concat(F.col("expectation_type"), F.lit(" (error)")))
        .when(F.col("element_count") == 0, F.lit(NO_DATA))
        .otherwise(
            F.concat(
                F.lit("["), F.col("severity"), F.lit("] "), F.col("description"), F.lit(": "),
                F.col("unexpected_count").cast("string"), F.lit(" registros"),
            )
        )
    )


def summarise(results: DataFrame, *by: str) -> DataFrame:
    """Counts, success rate and messages per suite. A suite has few lines, so they may be listed."""
    bad = F.col("status") != PASSED
    # failed lines in suite order; an empty table gives its one message
    failed = F.sort_array(
        F.collect_list(F.when(bad, F.struct("expectation_no", failure_text().alias("text"))))
    )
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_expectations"),
        F.count_if(bad).alias("n_failed"),
        F.round(100 * F.count_if(~bad) / F.count(F.lit(1)), 2).alias("success_rate"),
        (F.count_if(bad) == 0).alias("success"),
        F.transform(failed, lambda f: f["text"]).alias("failures"),
    )


def null_profile(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """NULL counts under the given names, and the number of rows, in one scan."""
    counts = [F.count_if(F.col(c).isNull()).alias(name) for c, name in columns.items()]
    return df.agg(*counts, F.count(F.lit(1)).alias("total"))


def run_audit(df: DataFrame, critical: Suite, warning: Suite) -> DataFrame:
    """Both suites in one pass, each line marked with its `tier`."""
    both = Suite("both", [*critical.expectations, *warning.expectations])
    return _with_tier(run_suite(df, both), critical)


def _with_tier(lines: DataFrame, critical: Suite) -> DataFrame:
    is_critical = F.col("expectation_no") <= len(critical.expectations)
    tier = F.when(is_critical, F.lit("critical")).otherwise(F.lit("warning"))
    return lines.withColumn("tier", tier)


def audit_log(lines: DataFrame, table: str, critical_suite: str) -> DataFrame:
    """The log line of a two-tier audit.

    A failed critical suite blocks and is logged alone; otherwise one line sums
    up both suites, with the warnings as messages.
    """
    tiers = summarise(lines, "tier")
    is_critical = F.col("tier") == "critical"
    row = tiers.agg(
        F.sum(F.when(is_critical, F.col("n_expectations"))).alias("critical_n"),
        F.sum(F.when(is_critical, F.col("n_failed"))).alias("critical_bad"),
        F.sum("n_expectations").alias("all_n"),
        F.sum("n_failed").alias("all_bad"),
        F.max(F.when(is_critical, F.col("failures"))).alias("critical_text"),
        F.max(F.when(~is_critical, F.col("failures"))).alias("warning_text"),
    )
    blocked = F.col("critical_bad") > 0
    pick = lambda a, b: F.when(blocked, F.col(a)).otherwise(F.col(b))
    n, bad = pick("critical_n", "all_n"), pick("critical_bad", "all_bad")
    return row.select(
        F.lit(table).alias("table_name"),
        F.when(blocked, F.lit(critical_suite)).otherwise(F.lit("COMBINED_SUITES")).alias(
            "expectation_suite_name"
        ),
        n.alias("n_expectations"),
        bad.alias("n_failed"),
        F.round((n - bad) * 100 / n, 2).cast("decimal(5,2)").alias("success_rate"),
        F.coalesce(pick("critical_text", "warning_text"), F.array().cast("array<string>")).alias(
            "failures"
        ),
        blocked.alias("blocking_triggered"),
    )
