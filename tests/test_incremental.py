"""Metrics advanced by batches, sketches that merge, and audits taken while writing."""

import shutil
from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tidegate.operators import quality, quantiles
from tidegate.plans import intermediate, suites
from tidegate.plans.incremental import MetricState
from tidegate.sources.committed import CommittedTable

AT = datetime(2024, 1, 5, 10)


def staged_rows(spark, rows):
    made = [
        (t, u, c, None if a is None else D(a), s, datetime(2024, 1, d, 10), datetime(2024, 1, d))
        for t, u, c, a, s, d in rows
    ]
    return spark.createDataFrame(
        made,
        "transaction_id string, user_id int, product_category string, amount decimal(10,2), status string, "
        "transaction_date timestamp_ntz, transaction_day timestamp_ntz",
    )


ROWS = [
    ("a", 1, "X", "5", "COMPLETED", 1), ("b", 1, "X", "7", "COMPLETED", 1), ("c", 1, "Y", "9", "COMPLETED", 2),
    ("d", 1, None, None, "COMPLETED", 3), ("e", None, "X", "1", "COMPLETED", 1), ("f", 2, "X", "3", "FAILED", 1),
    ("g", 1, "X", "5", "PENDING", 9), ("h", 3, "Z", "-4.50", "COMPLETED", 2), ("i", 3, "Z", "2.25", "COMPLETED", 2),
]


def lines(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("compacted", [False, True])
def test_batches_add_up_to_the_full_run(spark, tmp_path, compacted):
    state, full = MetricState(str(tmp_path / "s")), staged_rows(spark, ROWS)
    assert state.user_metrics(spark).count() == 0
    for k in range(3):
        assert state.advance(staged_rows(spark, ROWS[3 * k : 3 * k + 3]), f"run-{k}")
        assert not state.advance(staged_rows(spark, ROWS[3 * k : 3 * k + 3]), f"run-{k}")
        if compacted:
            state.compact(spark)
            assert not state.advance(staged_rows(spark, ROWS[:1]), "run-0")
    assert lines(state.user_metrics(spark)) == lines(intermediate.user_metrics(full))
    assert lines(state.category_metrics(spark)) == lines(intermediate.category_metrics(full))
    assert lines(state.daily_metrics(spark)) == lines(intermediate.daily_metrics(full))
    assert len(state.table.commit(spark).folders) == (1 if compacted else 3)


def test_a_batch_lost_before_its_commit_counts_once(spark, tmp_path, monkeypatch):
    state = MetricState(str(tmp_path / "s"))
    state.advance(staged_rows(spark, ROWS[:4]), "one")
    with monkeypatch.context() as m:
        m.setattr(CommittedTable, "_put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            state.advance(staged_rows(spark, ROWS[4:]), "two")
    assert lines(state.user_metrics(spark)) == lines(intermediate.user_metrics(staged_rows(spark, ROWS[:4])))
    assert state.advance(staged_rows(spark, ROWS[4:]), "two")
    assert lines(state.user_metrics(spark)) == lines(intermediate.user_metrics(staged_rows(spark, ROWS)))


def test_a_batch_reads_none_of_the_history(spark, tmp_path):
    state = MetricState(str(tmp_path / "s"))
    state.advance(staged_rows(spark, ROWS[:4]), "one")
    (old,) = state.table.commit(spark).folders
    shutil.move(tmp_path / "s" / old, tmp_path / "away")
    state.advance(staged_rows(spark, ROWS[4:]), "two")
    shutil.move(tmp_path / "away", tmp_path / "s" / old)
    assert lines(state.user_metrics(spark)) == lines(intermediate.user_metrics(staged_rows(spark, ROWS)))


def test_merged_sketches_keep_their_rank_error(spark):
    rows = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("cell"), F.lit("g").alias("g"),
        (F.col("id") / 100).cast("decimal(10,2)").alias("amount"),
    )
    cells = quantiles.sketched(rows, ["g", "cell"], "amount")
    (one,) = quantiles.merged(cells, ["g"]).select(
        quantiles.sketch_size("sketch").alias("n"), *[quantiles.quantile("sketch", q).alias(f"q{q}") for q in (0.1, 0.5, 0.9)]
    ).collect()
    assert one["n"] == 40_000
    for q in (0.1, 0.5, 0.9):
        assert abs(float(one[f"q{q}"]) / 400 - q) < 3 * quantiles.rank_error()


def test_small_groups_are_exact(spark):
    rows = staged_rows(spark, ROWS).where("amount IS NOT NULL")
    got = quantiles.sketched(rows, ["user_id"], "amount").select("user_id", quantiles.quantile("sketch", 0.5).alias("m"))
    assert {r["user_id"]: r["m"] for r in got.collect()} == {1: D("5.00"), None: D("1.00"), 2: D("3.00"), 3: D("-4.50")}
    assert quantiles.sketched(rows.where("false"), ["user_id"], "amount").count() == 0


def _suites():
    exp = quality.Expectation
    critical = quality.Suite("c", [
        exp(quality.ROW_COUNT, {"min_value": 1}, "rows"), exp(quality.NOT_NULL, {"column": "user_id"}, "set"),
        exp(quality.UNIQUE, {"column": "transaction_id"}, "once"), exp("no_such_kind", {}, "odd"),
    ])
    warning = quality.Suite("w", [exp(quality.BETWEEN, {"column": "amount", "min_value": 0, "mostly": 0.5}, "range")])
    return critical, warning


@pytest.mark.parametrize("n", [0, 9])
def test_watched_numbers_are_those_of_a_scan(spark, tmp_path, n):
    rows, path = staged_rows(spark, ROWS[:n]), str(tmp_path / "t")
    watched = quality.Watched(rows, *_suites(), {"user_id": "null_users"})
    watched.rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    assert lines(watched.lines(stored)) == lines(quality.run_audit(stored, *_suites()))
    assert watched.null_counts() == quality.null_profile(stored, {"user_id": "null_users"}).first().asDict()


def test_watched_rows_are_not_read_again(spark, tmp_path):
    rows, path = staged_rows(spark, ROWS), str(tmp_path / "t")
    critical, warning = suites.TRANSACTIONS_CRITICAL, suites.TRANSACTIONS_WARNINGS
    no_unique = lambda s: quality.Suite(s.name, [e for e in s.expectations if e.kind != quality.UNIQUE])
    watched = quality.Watched(rows, no_unique(critical), no_unique(warning), {})
    watched.rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    shutil.rmtree(path)
    assert watched.lines(stored).count() == len(no_unique(critical).expectations) + len(no_unique(warning).expectations)
