"""Tables that change in one step, their index of keys, and what a crash leaves."""

import os
import time
from datetime import datetime
from decimal import Decimal as D

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.functions.masking import DEFAULT_RULES
from tidegate.plans import publish as P
from tidegate.runtime import BRIEF, brief_shuffles, stage
from tidegate.sources import committed
from tidegate.sources.committed import CommitConflict, CommittedTable

SCHEMA = StructType().add("key", "string").add("n", "long")


def rows(spark, low, high):
    return spark.range(low, high).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.col("id").alias("n"))


@pytest.fixture
def table(tmp_path):
    return CommittedTable(str(tmp_path / "t"), "key", buckets=8)


def numbers(spark, table, commit=None):
    return sorted(r["n"] for r in table.read(spark, SCHEMA, commit).collect())


def test_a_run_writes_once(spark, table):
    assert numbers(spark, table) == [] and table.as_stored(spark) is None
    assert table.append(rows(spark, 0, 5), "a")
    assert not table.append(rows(spark, 5, 9), "a")
    assert table.append(rows(spark, 5, 9), "b")
    assert numbers(spark, table) == list(range(9))
    assert numbers(spark, table, commit=1) == list(range(5))
    assert table.read(spark, SCHEMA).columns == ["key", "n"] == table.as_stored(spark).columns


def test_a_write_lost_before_its_commit_is_no_part_of_the_table(spark, table, tmp_path, monkeypatch):
    table.append(rows(spark, 0, 5), "a")
    with monkeypatch.context() as m:
        m.setattr(CommittedTable, "_change", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.append(rows(spark, 5, 9), "b")
        with pytest.raises(OSError):
            table.replace(rows(spark, 50, 90), "c")
    assert numbers(spark, table) == list(range(5))
    assert table.append(rows(spark, 5, 9), "b")  # the same run again
    assert numbers(spark, table) == list(range(9))
    assert len(table.vacuum(spark)) == 4
    assert numbers(spark, table) == list(range(9))
    left = [n[:6] for n in os.listdir(tmp_path / "t")]
    assert sorted(left) == ["_commi", "_index", "_index", "_write", "_write"]


def test_a_draft_of_a_commit_counts_for_nothing(spark, table, tmp_path):
    table.append(rows(spark, 0, 5), "a")
    (tmp_path / "t" / "_commits" / ".half.draft").write_text('{"run_id": "b", "fol')
    assert numbers(spark, table) == list(range(5))
    assert table.append(rows(spark, 5, 6), "b") and table.commits(spark) == [1, 2]


def test_replace_may_read_its_table_and_keeps_the_former_rows_until_vacuum(spark, table):
    table.append(rows(spark, 0, 5), "a")
    table.replace(table.read(spark, SCHEMA).where("n > 2"), "b")
    assert numbers(spark, table) == [3, 4] and numbers(spark, table, commit=1) == list(range(5))
    table.vacuum(spark)
    assert numbers(spark, table) == [3, 4]


def test_two_writers(spark, table):
    table.append(rows(spark, 0, 2), "a")
    put = CommittedTable._put

    def another_first(self, session, commit):
        CommittedTable._put = put
        self.append(rows(spark, 2, 4), "other")
        return put(self, session, commit)

    CommittedTable._put = another_first
    try:
        assert table.append(rows(spark, 4, 6), "mine")
        assert numbers(spark, table) == list(range(6))
        CommittedTable._put = lambda self, s, c: another_first(self, s, c) if c.run_id == "r" else put(self, s, c)
        with pytest.raises(CommitConflict):
            plain = CommittedTable(table.path)
            seen = plain.commit(spark).number
            plain.append(spark.range(1).selectExpr("'x' AS key", "id AS n"), "later")
            plain._change(spark, "r", "data-x", False, seen)
    finally:
        CommittedTable._put = put


@pytest.mark.parametrize("bits", [24, 1])
def test_index_finds_what_a_join_finds(spark, tmp_path, bits):
    """With one bit a key the filters let many absent keys pass; the answer is the same."""
    table = CommittedTable(str(tmp_path / f"t{bits}"), "key", buckets=4, bits_per_key=bits)
    for k in range(3):
        table.append(rows(spark, 1000 * k, 1000 * k + 300), f"run-{k}")
    batch = rows(spark, 250, 1010).unionByName(spark.createDataFrame([(None, 1)], SCHEMA))
    known, _ = table.known_keys(batch)
    want = batch.join(table.read(spark, SCHEMA), "key", "left_semi")
    assert sorted(r[0] for r in known.collect()) == sorted(r["key"] for r in want.collect())
    candidates = table.candidates(batch).count()
    assert candidates >= 60 and (bits == 1 or candidates < 70)


def test_index_skips_files(spark, table):
    for k in range(4):
        table.append(rows(spark, 100 * k, 100 * (k + 1)), f"run-{k}")
    known, read = table.known_keys(rows(spark, 1000, 1400))
    assert known.count() == 0 and read["buckets"] == 32 and read["buckets_read"] <= 2
    known, read = table.known_keys(rows(spark, 42, 43))
    assert [r[0] for r in known.collect()] == [rows(spark, 42, 43).first()["key"]]
    assert read["buckets_read"] == 1
    files = known.inputFiles()
    history = [f for f in files if "/_write=" in f]
    assert len(history) == 1 and "_bucket=" in history[0] and "/_write=1-" in history[0]


def test_no_filter_misses_a_key():
    draw = np.random.default_rng(0)
    inside = draw.integers(-(2**63), 2**63 - 1, 5000)
    outside = draw.integers(-(2**63), 2**63 - 1, 200_000)
    made = np.zeros(committed.filter_bits(len(inside), 24) // 8, np.uint8)
    committed.set_bits(made, inside)
    assert committed.has_bits(made, inside).all()
    assert committed.has_bits(made, outside).mean() < 1e-4


def test_no_slice_of_a_filter_misses_a_key():
    draw = np.random.default_rng(1)
    inside = draw.integers(-(2**63), 2**63 - 1, 150_000)
    outside = draw.integers(-(2**63), 2**63 - 1, 300_000)
    made = np.zeros(committed.filter_bits(len(inside), 24) // 8, np.uint8)
    committed.set_bits(made, inside)
    assert committed.has_bits(made, inside).all() and committed.has_bits(made, outside).mean() < 1e-4
    size = committed.SLICE_BITS // 8
    assert len(made) == 4 * size
    for k in range(4):
        own = inside[inside.view(np.uint64) >> np.uint64(62) == k]
        assert committed.has_bits(made[k * size : (k + 1) * size], own, 4).all()


def test_keys_of_a_bucket_are_probed_in_parts(spark, tmp_path):
    """Large and small filters side by side, and a batch larger than either."""
    table = CommittedTable(str(tmp_path / "t"), "key", buckets=1)
    table.append(rows(spark, 0, 100_000), "large")
    table.append(rows(spark, 200_000, 200_050), "small")
    stored = table._filters(spark, table.commit(spark).folders)
    sizes = [len(r["filter"]) for r in stored.collect()]
    assert len(sizes) == 5 and max(sizes) <= committed.SLICE_BITS // 8
    batch = rows(spark, 90_000, 290_000).unionByName(spark.createDataFrame([(None, 1)], SCHEMA)).persist()
    known, read = table.known_keys(batch)
    want = batch.join(table.read(spark, SCHEMA), "key", "left_semi")
    assert known.count() == 10_050 and known.exceptAll(want.select("key")).count() == 0
    assert read == {"buckets": 2, "buckets_read": 2}
    assert 10_050 <= table.candidates(batch).count() < 10_150
    plan = table.candidates(batch)._jdf.queryExecution().toString()
    assert committed.PART in plan
    batch.unpersist()


def test_publishing_to_a_committed_table(spark, tmp_path):
    at = datetime(2024, 1, 1)
    made = lambda ids: spark.createDataFrame(
        [(i, 1, "c", D("5"), "USD", at, "COMPLETED", at) for i in ids],
        "transaction_id string, user_id int, product_category string, amount decimal(10,2), "
        "currency string, transaction_date timestamp_ntz, status string, ingested_at timestamp_ntz",
    )
    target = CommittedTable(str(tmp_path / "p"), "transaction_key", buckets=4)
    args = ({"audit_passed": True}, datetime(2024, 2, 1), "salt", DEFAULT_RULES)
    first = P.publish(spark, P.TRANSACTIONS, made(["a1", "b1"]), target, *args, run_id="one", n_raw=2)
    assert (first["records_published"], first["approval_rate"]) == (2, 100.0)
    second = P.publish(spark, P.TRANSACTIONS, made(["a1", "c1"]), target, *args, run_id="two")
    assert (second["records_published"], second["duplicate_records"]) == (1, 1)
    again = P.publish(spark, P.TRANSACTIONS, made(["a1", "c1"]), target, *args, run_id="two")
    assert again["records_published"] == 0
    assert target.read(spark, P.TRANSACTIONS.schema).count() == 3


def batch_of(spark, n, *, status="COMPLETED"):
    """Each id twice, the later arrival with the larger amount; two rows without an id."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("turn")).cast("timestamp_ntz")
    turns = spark.range(n).withColumn("turn", F.explode(F.array(F.lit(0), F.lit(1))))
    return turns.select(
        F.when(F.col("id") > 0, F.concat(F.lit("tx-"), F.col("id"))).alias("transaction_id"),
        F.lit(1).alias("user_id"), F.lit("c").alias("product_category"),
        (F.col("turn") + 1).cast("decimal(10,2)").alias("amount"), F.lit("USD").alias("currency"),
        at.alias("transaction_date"), F.lit(status).alias("status"), at.alias("ingested_at"),
    )


def files_below(path, start=""):
    return [os.path.join(d, f) for d, _, found in os.walk(path) for f in found if f.startswith(start)]


def test_a_batch_published_in_rounds_leaves_the_same_table_and_nothing_staged(spark, tmp_path, monkeypatch):
    staged = f"{spark.conf.get('spark.checkpoint.dir')}/staged"
    before = set(files_below(staged))
    args = ({"audit_passed": True}, datetime(2024, 2, 1), "salt", DEFAULT_RULES)
    told, tables = [], []
    for n in (1 << 23, 100, 7):  # one round, three, and one for each bucket
        monkeypatch.setattr(P, "ROUND_ROWS", n)
        target = CommittedTable(str(tmp_path / f"rounds-{n}"), "transaction_key", buckets=6)
        runs = [(batch_of(spark, 90), "one"), (batch_of(spark, 150), "two"), (batch_of(spark, 150), "two"),
                (batch_of(spark, 9, status="FAILED"), "none")]
        told.append([P.publish(spark, P.TRANSACTIONS, raw, target, *args, run_id=run) for raw, run in runs])
        tables.append(sorted(map(str, target.read(spark, P.TRANSACTIONS.schema).collect())))
        assert target.commits(spark) == [1, 2] and target.commit(spark).runs == ("one", "two")
    assert [(m["records_published"], m["duplicate_records"]) for m in told[0]] == [(90, 0), (61, 89), (1, 149), (0, 0)]
    assert told[0] == told[1] == told[2] and tables[0] == tables[1] == tables[2] and len(tables[0]) == 151
    assert set(files_below(staged)) == before


def test_a_round_that_fails_publishes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "ROUND_ROWS", 10)
    target = CommittedTable(str(tmp_path / "t"), "transaction_key", buckets=4)
    args = ({"audit_passed": True}, datetime(2024, 2, 1), "salt", DEFAULT_RULES, True, "one")
    put, seen = CommittedTable._put_rows, []

    def fails_later(self, *a):
        seen.append(a)
        if len(seen) > 2:
            raise OSError("lost")
        return put(self, *a)

    with monkeypatch.context() as m:
        m.setattr(CommittedTable, "_put_rows", fails_later)
        with pytest.raises(OSError):
            P.publish(spark, P.TRANSACTIONS, batch_of(spark, 50), target, *args)
    assert target.commits(spark) == [] and target.read(spark, P.TRANSACTIONS.schema).count() == 0
    assert P.publish(spark, P.TRANSACTIONS, batch_of(spark, 50), target, *args)["records_published"] == 50
    assert target.read(spark, P.TRANSACTIONS.schema).count() == 50


def test_a_staged_batch_of_the_caller_is_kept(spark, tmp_path):
    raw = stage(batch_of(spark, 5), "raw-of-the-caller")
    target = CommittedTable(str(tmp_path / "t"), "transaction_key", buckets=4)
    P.publish(spark, P.TRANSACTIONS, raw, target, {"audit_passed": True}, datetime(2024, 2, 1), "s", DEFAULT_RULES)
    assert raw.count() == 10


def test_shuffle_files_go_with_their_query(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {f for f in map(str, disk.getAllFiles().mkString("\n").split("\n")) if "/shuffle_" in f}
    before = shuffles()
    with brief_shuffles(spark):
        stage(spark.range(1000).groupBy((F.col("id") % 700).alias("k")).count(), "brief")
    late = time.time() + 10
    while shuffles() - before and time.time() < late:
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(BRIEF, None) is None


def test_large_buckets_are_dealt_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(committed, "FILE_ROWS", 100)
    table = CommittedTable(str(tmp_path / "t"), "key", buckets=2)
    with table.appending(spark, "a") as add:
        add(rows(spark, 0, 1000), 500)
        add(rows(spark, 1000, 1100), 50)
        assert table.commits(spark) == []
    assert numbers(spark, table) == list(range(1100)) and table.commits(spark) == [1]
    assert len(files_below(tmp_path / "t", "part-")) > 6
    known, read = table.known_keys(rows(spark, 900, 2000))
    assert known.count() == 200 and read == {"buckets": 2, "buckets_read": 2}
    with table.appending(spark, "a") as add:
        add(rows(spark, 5000, 6000))
    with table.appending(spark, "b"):
        pass
    assert numbers(spark, table) == list(range(1100)) and table.commits(spark) == [1]


def test_slices_made_by_themselves_are_those_of_the_whole_filter(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(committed, "FILE_ROWS", 1000)
    table = CommittedTable(str(tmp_path / "t"), "key", buckets=1)
    with table.appending(spark, "a") as add:
        add(rows(spark, 0, 60_000), 60_000)
    stored = table._filters(spark, table.commit(spark).folders).collect()
    assert sorted(r[committed.SLICE] for r in stored) == [0, 1]
    whole = np.concatenate([np.frombuffer(r["filter"], np.uint8) for r in sorted(stored, key=lambda r: r[committed.SLICE])])
    hashes = rows(spark, 0, 60_000).select(F.xxhash64("key")).toPandas().iloc[:, 0].to_numpy()
    want = np.zeros_like(whole)
    committed.set_bits(want, hashes)
    assert (whole == want).all()


def test_a_key_that_fills_a_bucket_by_itself_is_found(spark, tmp_path):
    """Its bucket's filter has several slices, of which only one has a key."""
    table = CommittedTable(str(tmp_path / "t"), "key", buckets=1)
    for n in range(3):
        same = spark.range(100_000).select(F.sha2(F.lit(f"{n}"), 256).alias("key"), F.col("id").alias("n"))
        table.append(same, f"run-{n}")
    known, read = table.known_keys(rows(spark, 0, 50))
    assert known.count() == 3 and read == {"buckets": 3, "buckets_read": 3}
