from datetime import datetime
from decimal import Decimal as D

import pytest

from tidegate.functions.masking import DEFAULT_RULES
from tidegate.plans import publish as P
from tidegate.sources import tables

AS_OF = datetime(2024, 2, 1)
SCHEMA = (
    "transaction_id string, user_id int, product_category string, amount decimal(10,2), "
    "currency string, transaction_date timestamp_ntz, status string, ingested_at timestamp_ntz"
)


def tx(tid, user=1, amount="5", status="COMPLETED", hour=1):
    at = datetime(2024, 1, 1, hour)
    return (tid, user, "c", None if amount is None else D(amount), "USD", at, status, at)


def run(spark, rows, path, audit={"audit_passed": True}, **kw):
    raw = spark.createDataFrame(rows, SCHEMA)
    return P.publish(
        spark, P.TRANSACTIONS, raw, tables.FolderTable(str(path)), audit, AS_OF, "salt", DEFAULT_RULES, **kw
    )


def read(spark, path):
    return tables.read_table(spark, str(path), P.TRANSACTIONS.schema)


@pytest.mark.parametrize(
    "audit, reason",
    [(None, "audit_result_missing"), ({"audit_passed": False}, "audit_failed"), ({}, "audit_failed"), (False, "audit_failed")],
)
def test_gate(spark, tmp_path, audit, reason):
    got = run(spark, [tx("a")], tmp_path / "p", audit)
    assert got == {"records_published": 0, "reason": reason}
    assert read(spark, tmp_path / "p").count() == 0


def test_ids_that_share_their_visible_end_both_survive(spark, tmp_path):
    got = run(spark, [tx("aaaa-1234"), tx("bbbb-1234")], tmp_path / "p")
    assert got["records_published"] == 2
    rows = read(spark, tmp_path / "p").collect()
    assert {r["transaction_id"] for r in rows} == {"*****1234"}
    assert len({r["transaction_key"] for r in rows}) == 2


def test_second_run_publishes_nothing(spark, tmp_path):
    rows = [tx("a1"), tx("a1", hour=2), tx("b1"), tx("c1", status="FAILED"), tx("d1", amount="0"), tx("e1", user=None)]
    first = run(spark, rows, tmp_path / "p")
    assert first == {
        "records_published": 2, "records_filtered": 4, "duplicate_records": 0,
        "approval_rate": 33.33,
    }
    second = run(spark, rows, tmp_path / "p")
    assert second == {
        "records_published": 0, "records_filtered": 6, "duplicate_records": 2, "approval_rate": 0.0,
    }
    assert read(spark, tmp_path / "p").count() == 2


def test_only_new_keys_are_added(spark, tmp_path):
    run(spark, [tx("a1", amount="1")], tmp_path / "p")
    got = run(spark, [tx("a1", amount="2"), tx("b1")], tmp_path / "p")
    assert (got["records_published"], got["duplicate_records"]) == (1, 1)
    assert got["records_published"] + got["records_filtered"] == 2
    assert sorted(r["amount"] for r in read(spark, tmp_path / "p").collect()) == [D("1.00"), D("5.00")]


def test_the_latest_copy_wins(spark, tmp_path):
    run(spark, [tx("a1", amount="1", hour=1), tx("a1", amount="9", hour=3), tx("a1", amount="4", hour=2)], tmp_path / "p")
    (r,) = read(spark, tmp_path / "p").collect()
    assert (r["amount"], r["data_quality_score"], r["processed_at"]) == (D("9.00"), D("1.00"), AS_OF)


def test_cleaning_reaches_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "raw")
    spark.createDataFrame([tx("a1")], SCHEMA).write.parquet(path)
    plan = plan_of(P.clean_transactions(spark.read.parquet(path)).select("transaction_id"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(status,COMPLETED)" in pushed and "GreaterThan(amount,0.00)" in pushed
    assert "IsNotNull(user_id)" in pushed and "currency" not in plan


def test_empty_batch(spark, tmp_path):
    got = run(spark, [], tmp_path / "p")
    assert got["records_published"] == 0 and got["approval_rate"] == 0.0


def test_users_need_an_email_unless_told_otherwise(spark):
    rows = [(1, "a@x", "n", "l", "c"), (2, None, "n", "l", "c"), (3, "a@x", None, "l", "c")]
    df = spark.createDataFrame(
        rows, "user_id int, email string, first_name string, last_name string, country string"
    )
    assert [r["user_id"] for r in P.clean_users(df).collect()] == [1]
    without = P.clean_users(df, ("user_id", "first_name", "last_name", "country"))
    assert sorted(r["user_id"] for r in without.collect()) == [1, 2]


def test_bucketed_table_is_not_shuffled_for_the_lookup(spark, monkeypatch, plan_of):
    from tidegate.operators import skew
    from tidegate.runtime import stage

    spark.sql("DROP TABLE IF EXISTS published_tx")
    target = tables.BucketedTable("published_tx", "transaction_key", 4)
    raw = spark.createDataFrame([tx("a1"), tx("b1")], SCHEMA)
    args = ({"audit_passed": True}, AS_OF, "salt", DEFAULT_RULES)
    assert P.publish(spark, P.TRANSACTIONS, raw, target, *args)["records_published"] == 2
    more = spark.createDataFrame([tx("a1"), tx("c1")], SCHEMA)
    assert P.publish(spark, P.TRANSACTIONS, more, target, *args)["duplicate_records"] == 1
    assert target.read(spark, P.TRANSACTIONS.schema).count() == 3

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = stage(P.one_per_key(P.TRANSACTIONS, more, AS_OF, "salt"), "b")
        published = target.read(spark, P.TRANSACTIONS.schema)
        known = skew.known_keys(skew.measure(batch, "transaction_key"), published)
        plan = plan_of(known)
        tree = plan.split("\n\n")[0]
        assert known.count() == 2
        assert tree.count("Exchange") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE published_tx")


def test_a_large_batch_meets_the_published_keys_once(spark, tmp_path, monkeypatch):
    from tidegate.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(P, "known_keys", None)  # the keys of a large batch are not shuffled by themselves
    rows = [tx("a1"), tx("a1", hour=2), tx(None), tx("b1", user=None), tx("c1", status="FAILED")]
    first = run(spark, rows, tmp_path / "p")
    assert (first["records_published"], first["records_filtered"], first["duplicate_records"]) == (2, 3, 0)
    more = [tx("a1", amount="7"), tx("d1"), tx("d1", hour=5)]
    second = run(spark, more, tmp_path / "p")
    assert (second["records_published"], second["records_filtered"], second["duplicate_records"]) == (1, 2, 1)
    assert run(spark, more, tmp_path / "p")["records_published"] == 0
    got = read(spark, tmp_path / "p").collect()
    assert [r["amount"] for r in got] == [D("5.00")] * 3
    assert len({r["transaction_key"] for r in got}) == 3 and None in {r["transaction_key"] for r in got}
    assert "_known" not in got[0].asDict()
