import json
from decimal import Decimal as D

import pytest

from tidegate.operators import modeltests as T
from tidegate.operators import quality as Q
from tidegate.plans import suites

ROWS = [
    # id, user, amount, currency
    ("a", 1, D("5"), "USD"),
    ("a", 2, D("0"), "EUR"),
    ("b", None, D("-1"), "XXX"),
    (None, 4, None, None),
    (None, 5, D("100000"), "GBP"),
]
SCHEMA = "id string, user int, amount decimal(10,2), currency string"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def run(df, *expectations):
    return Q.run_suite(df, Q.Suite("s", list(expectations))).orderBy("expectation_no").collect()


def one(df, kind, **kwargs):
    r = run(df, Q.Expectation(kind, kwargs))[0]
    return r["evaluated_count"], r["unexpected_count"], r["status"]


def test_each_expectation_counts_its_faults(df):
    assert one(df, Q.ROW_COUNT, min_value=1) == (5, 0, "passed")
    assert one(df, Q.ROW_COUNT, min_value=6) == (5, 1, "failed")
    assert one(df, Q.NOT_NULL, column="user") == (5, 1, "failed")
    assert one(df, Q.UNIQUE, column="id") == (3, 2, "failed")
    assert one(df, Q.UNIQUE, column="user") == (4, 0, "passed")
    assert one(df, Q.IN_SET, column="currency", value_set=["USD", "EUR", "GBP"]) == (4, 1, "failed")
    assert one(df, Q.REGEX, column="id", regex="^a") == (3, 1, "failed")
    assert one(df, Q.BETWEEN, column="amount", min_value=0.01, max_value=100000) == (4, 2, "failed")
    assert one(df, Q.LENGTH, column="currency", min_value=3, max_value=3) == (4, 0, "passed")


@pytest.mark.parametrize("mostly, status", [(0.7, "passed"), (0.75, "passed"), (0.76, "failed")])
def test_mostly_compares_the_share_of_set_cells(df, mostly, status):
    got = one(df, Q.IN_SET, column="currency", value_set=["USD", "EUR", "GBP"], mostly=mostly)
    assert got == (4, 1, status)


@pytest.mark.parametrize("mostly, status", [(0.8, "passed"), (0.81, "failed")])
def test_mostly_of_not_null_counts_all_rows(df, mostly, status):
    assert one(df, Q.NOT_NULL, column="user", mostly=mostly) == (5, 1, status)


def test_only_nulls_pass_cell_checks(spark):
    empty_cells = spark.createDataFrame([(None,), (None,)], "x string")
    assert one(empty_cells, Q.REGEX, column="x", regex="^z") == (0, 0, "passed")
    assert one(empty_cells, Q.UNIQUE, column="x") == (0, 0, "passed")


def test_empty_table_fails_everything_with_one_message(spark):
    results = Q.run_suite(spark.createDataFrame([], "user_id int, transaction_id string, currency string, status string"), suites.TRANSACTIONS_CRITICAL)
    assert {r["status"] for r in results.collect()} == {"failed"}
    summary = Q.summarise(results.withColumn("suite", Q.F.lit("x")), "suite").first()
    assert summary["n_failed"] == 7 and set(summary["failures"]) == {"Sin datos"}


def test_unknown_type_and_missing_column_are_errors(df):
    rows = run(df, Q.Expectation("expect_magic", {"column": "id"}), Q.Expectation(Q.NOT_NULL, {"column": "zzz"}))
    assert [r["status"] for r in rows] == ["error", "error"]


def test_summary_and_messages(df):
    results = Q.run_suite(
        df,
        Q.Suite("s", [
            Q.Expectation(Q.NOT_NULL, {"column": "user"}, "user set", "CRITICAL"),
            Q.Expectation(Q.ROW_COUNT, {"min_value": 1}, "rows", "CRITICAL"),
            Q.Expectation("expect_magic", {}, "?", "WARNING"),
        ]),
    )
    s = Q.summarise(results.withColumn("suite", Q.F.lit("s")), "suite").first()
    assert (s["n_expectations"], s["n_failed"], s["success_rate"], s["success"]) == (3, 2, 33.33, False)
    assert s["failures"] == ["[CRITICAL] user set: 1 registros", "expect_magic (error)"]


def test_audit_log_blocks_or_combines(df):
    ok = Q.Suite("ok", [Q.Expectation(Q.ROW_COUNT, {"min_value": 1}, "rows", "CRITICAL")])
    bad = Q.Suite("bad", [Q.Expectation(Q.NOT_NULL, {"column": "user"}, "user set", "WARNING")])
    passed = Q.audit_log(Q.run_audit(df, ok, bad), "t", "ok").first()
    assert not passed["blocking_triggered"]
    assert (passed["expectation_suite_name"], passed["n_expectations"], passed["n_failed"]) == (
        "COMBINED_SUITES", 2, 1,
    )
    assert passed["success_rate"] == D("50.00")
    blocked = Q.audit_log(Q.run_audit(df, bad, ok), "t", "bad").first()
    assert blocked["blocking_triggered"]
    assert (blocked["expectation_suite_name"], blocked["n_expectations"]) == ("bad", 1)
    clean = Q.audit_log(Q.run_audit(df, ok, ok), "t", "ok").first()
    assert clean["failures"] == []


def test_suites_load_from_json(tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({
        "expectation_suite_name": "s",
        "expectations": [{"expectation_type": Q.NOT_NULL, "kwargs": {"column": "x"},
                          "meta": {"severity": "WARNING", "description": "d"}}],
    }))
    assert Q.load_suite(str(path)) == Q.Suite("s", [Q.Expectation(Q.NOT_NULL, {"column": "x"}, "d", "WARNING")])
    with pytest.raises(Q.MissingSuite):
        Q.load_suite(str(tmp_path / "none.json"))


def test_shipped_suites():
    assert [len(s.expectations) for s in suites.SUITES.values()] == [7, 2, 10, 5]
    assert suites.suite("transactions_warnings_suite") is suites.TRANSACTIONS_WARNINGS
    with pytest.raises(Q.MissingSuite):
        suites.suite("transactions_quality_suite")


@pytest.mark.parametrize(
    "ip, ok", [("1.2.3.4", True), ("255.255.255.255", True), ("256.1.1.1", False), ("1.2.3", False)]
)
def test_strict_address_pattern(spark, ip, ok):
    df = spark.createDataFrame([(ip,)], "ip string")
    assert (one(df, Q.REGEX, column="ip", regex=suites.IPV4)[2] == "passed") is ok


def test_row_wise_checks_share_one_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    checks = [Q.Expectation(Q.NOT_NULL, {"column": c}) for c in ("id", "user", "amount")]
    plan = plan_of(Q.run_suite(df, Q.Suite("s", checks)))
    assert plan.count("Scan parquet") == 2  # once in the tree, once in the details
    assert "currency" not in plan


def test_null_profile(df):
    assert Q.null_profile(df, {"id": "null_ids", "user": "null_users"}).first() == (2, 1, 5)


def test_model_tests(spark):
    df = spark.createDataFrame(
        [(1, "x", D("0.5")), (1, "y", D("2")), (None, None, None), (None, "x", D("0"))],
        "k int, v string, n decimal(5,2)",
    )
    tests = [
        T.ModelTest("m", "k", "unique"),
        T.ModelTest("m", "k", "not_null"),
        T.ModelTest("m", "v", "accepted_values", values=("x",)),
        T.ModelTest("m", "n", "accepted_range", low=0, high=1),
        T.ModelTest("m", "n", "accepted_range", low=0, inclusive=False),
    ]
    rows = T.run_tests({"m": df}, tests).collect()
    found = sorted((r["test"], r["failures"], r["passed"]) for r in rows)
    assert found == [
        ("accepted_range", 1, False), ("accepted_range", 1, False), ("accepted_values", 1, False),
        ("not_null", 2, False), ("unique", 1, False),
    ]


def test_declared_tests_are_complete():
    assert len(T.DECLARED) == 33


def test_unusable_expectations_are_errors_and_an_empty_suite_has_no_lines(spark):
    from tidegate.operators import quality as Q

    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n int")
    bad = [
        Q.Expectation(Q.IN_SET, {"column": "s"}),
        Q.Expectation(Q.REGEX, {"column": "s", "regex": "("}),
        Q.Expectation(Q.REGEX, {"column": "s"}),
        Q.Expectation(Q.BETWEEN, {"column": "s", "min_value": 1}),
        Q.Expectation(Q.BETWEEN, {"column": "n", "min_value": "x"}),
        Q.Expectation(Q.LENGTH, {"column": "n", "min_value": 1}),
        Q.Expectation(Q.NOT_NULL, {"column": "absent"}),
    ]
    good = Q.Expectation(Q.BETWEEN, {"column": "n", "min_value": 1, "max_value": 2})
    got = Q.run_suite(df, Q.Suite("s", [*bad, good])).orderBy("expectation_no").collect()
    assert [r.status for r in got] == [Q.ERROR] * len(bad) + [Q.PASSED]
    none = Q.run_suite(df, Q.Suite("none", []))
    assert none.columns == Q.RESULT_COLUMNS and none.count() == 0


def test_percent_is_rounded_once(spark):
    from pyspark.sql import functions as F
    from tidegate.functions.scalars import percent_above

    rows = [("10100499.96", "10000000.00", 1), ("9899500.04", "10000000.00", 1), ("5.00", "0.00", 3), ("1.00", "9.00", 3)]
    df = spark.createDataFrame(rows, "a string, t string, n int").select(
        percent_above(F.col("a").cast("decimal(10,2)"), F.col("t").cast("decimal(20,2)"), F.col("n")).alias("p")
    )
    assert [None if r.p is None else str(r.p) for r in df.collect()] == ["1.00", "-1.00", None, "-66.67"]
