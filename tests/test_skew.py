"""Hot keys, hot groups and hot copies: the skew-proof ways give the plain results."""

import random
import statistics
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.operators import ranking, skew
from tidegate.operators.moments import amount_profile
from tidegate.runtime import stage


def skewed(spark, n=3000, seed=1):
    """A third of all rows belongs to key 0, a third to NULL."""
    rng = random.Random(seed)
    rows = [
        (i, rng.choice([0, 0, 0, None, None, None, rng.randint(1, 60)]), rng.randint(0, 40))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "id int, k int, v int")


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_heavy_keys_are_few_and_their_slices_bounded(spark):
    rows, df = skewed(spark)
    heavy = {r["_hash"]: r["_slices"] for r in skew.heavy_keys(df, "k").collect()}
    hashes = df.select("k", F.xxhash64("k").alias("h")).distinct().collect()
    named = {r["k"]: heavy[r["h"]] for r in hashes if r["h"] in heavy}
    share = len(rows) // 16  # four partitions
    for k in (0, None):
        assert named[k] == -(-sum(1 for r in rows if r[1] == k) // share)
    assert len(named) < 16 and sum(named.values()) < 32


def test_no_heavy_key_without_rows(spark):
    empty = spark.createDataFrame([], "id int, k int, v int")
    assert skew.heavy_keys(empty, "k").count() == 0
    right = spark.createDataFrame([(1, "a")], "k int, name string")
    heavy = skew.heavy_keys(empty, "k")
    assert skew.salted_left_join(empty, right, "k", heavy, F.col("id")).count() == 0


def test_salted_join_equals_plain_join(spark):
    _, df = skewed(spark)
    right = spark.createDataFrame([(k, f"n{k}") for k in range(50)], "k int, name string")
    plain = df.join(right, "k", "left")
    salted = skew.salted_left_join(df, right, "k", skew.heavy_keys(df, "k"), F.col("id"))
    assert rows_of(salted.select(plain.columns)) == rows_of(plain)


def test_salted_join_spreads_the_hot_key(spark):
    rows, df = skewed(spark)
    right = spark.createDataFrame([(k, "x") for k in range(50)], "k int, name string")
    heavy = skew.heavy_keys(df, "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_left_join(df, right, "k", heavy, F.col("id"))
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_task) == len(rows)
    assert max(r["count"] for r in per_task) < 0.5 * len(rows)


@pytest.mark.parametrize("max_rows, joined_by", [(None, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_attach_broadcasts_only_a_checked_size(spark, plan_of, max_rows, joined_by):
    _, df = skewed(spark)
    right = stage(spark.createDataFrame([(k, f"n{k}") for k in range(50)], "k int, name string"), "r")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = skew.attach(df, skew.measure(right, "k"), F.col("id"), max_rows)
        assert joined_by in plan_of(out)
        assert rows_of(out.select("id", "k", "name")) == rows_of(
            df.join(right, "k", "left").select("id", "k", "name")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_text_keys_count_against_the_broadcast_bound(spark, monkeypatch):
    table = spark.createDataFrame([("x" * 100,), ("y" * 100,)], "k string")
    assert skew.measure(table, "k").fits_broadcast()
    monkeypatch.setattr(skew, "BROADCAST_KEY_BYTES", 150)
    assert not skew.measure(table, "k").fits_broadcast()


def test_latest_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "n"), ("b", 0, "m"), (None, 1, "q")]
    df = spark.createDataFrame(rows, "k string, at int, v string")
    got = skew.latest_per_key(df, ["k"], ["at"])
    assert got.columns == df.columns
    assert set(map(tuple, got.collect())) == {("a", 3, "z"), ("b", 0, "m"), (None, 1, "q")}


def test_copies_combine_before_the_shuffle(spark, plan_of):
    _, df = skewed(spark)
    plan = plan_of(skew.latest_per_key(df, ["k"], ["v"]))
    assert "Window" not in plan and plan.index("partial_max") > 0


def test_known_keys_both_ways(spark, monkeypatch):
    batch = stage(spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), "b")
    batch = skew.measure(batch, "k")
    published = spark.createDataFrame([("b",), ("c",), ("z",)], "k string")
    assert {r[0] for r in skew.known_keys(batch, published).collect()} == {"b", "c"}
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    assert {r[0] for r in skew.known_keys(batch, published).collect()} == {"b", "c"}


# --- ranking ---------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 10, 1001])
def test_distributed_tiles_equal_ntile(spark, n, plan_of):
    df = spark.range(n).select("id", (F.col("id") % 7).alias("v"))
    order = [F.col("v").desc(), F.col("id").asc()]
    plain = df.withColumn("t", F.ntile(4).over(Window.orderBy(*order)))
    spread = ranking.with_tile(df, order, 4, "t")
    assert "SinglePartition" not in plan_of(spread)
    assert rows_of(spread.select("id", "t")) == rows_of(plain.select("id", "t"))
    sizes = [r["count"] for r in spread.groupBy("t").count().collect()]
    assert not sizes or len(sizes) < 4 or max(sizes) - min(sizes) <= 1


def test_tiles_put_nulls_first_when_descending(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9), (4, 1)], "id int, v int")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc()]
    spread = ranking.with_tile(df, order, 4, "t")
    assert {r["id"]: r["t"] for r in spread.collect()} == {1: 1, 3: 2, 2: 3, 4: 4}


@pytest.mark.parametrize("keys", ["k", "CAST(k AS STRING)", "1", "CAST(NULL AS INT)", "id"])
def test_group_sequence_of_groups_of_any_size(spark, keys):
    _, df = skewed(spark)
    df = df.withColumn("k", F.expr(keys))
    order = [F.col("v").asc(), F.col("id").asc()]
    plain = df.withColumn("s", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    got = ranking.with_group_sequence(df, "k", order, "s")
    assert rows_of(got.select("id", "k", "v", "s")) == rows_of(plain.select("id", "k", "v", "s"))


def test_group_sequence_of_no_rows(spark):
    empty = spark.createDataFrame([], "id int, k int, v int")
    assert ranking.with_group_sequence(empty, "k", [F.col("id").asc()], "s").count() == 0


def test_group_sequence_cuts_a_group_over_tasks(spark, monkeypatch):
    """A key with a third of the rows: no piece exceeds one range."""
    rows, df = skewed(spark, n=6000)
    staged = []
    monkeypatch.setattr(ranking, "stage", lambda d, label: staged.append(stage(d, label)) or staged[-1])
    ranking.with_group_sequence(df, "k", [F.col("id").asc()], "s").count()
    sizes = [r["count"] for r in staged[0].groupBy("_part", "k").count().collect()]
    assert max(sizes) < 0.3 * len(rows)


# --- moments ---------------------------------------------------------------


def brute(values):
    values = sorted(values)
    return (
        values[0],
        values[-1],
        statistics.stdev(values) if len(values) > 1 else None,
        float(statistics.median(values)),
    )


def test_profile_equals_brute_force(spark):
    rng = random.Random(9)
    groups = {
        1: [D(rng.randint(-10**9, 10**9)) / 100 for _ in range(501)],
        2: [D("7.77")] * 400,
        3: [D("1.00")],
        4: [D("99999999.99"), D("-99999999.99")],
        5: [D(rng.randint(0, 300)) / 100 for _ in range(1000)],
        6: [D("1310.71"), D("1310.72")],  # neighbours in different blocks
        7: [D("10000000.00"), D("10000000.01")] * 50,
        None: [D(rng.randint(0, 10**6)) / 100 for _ in range(100)],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [(1, None), (8, None)]
    df = spark.createDataFrame(rows, "k int, amount decimal(10,2)")
    got = {
        r["k"]["k"]: r
        for r in amount_profile(df.select(F.struct("k").alias("k"), "amount"), "k", "amount").collect()
    }
    assert set(got) == set(groups)
    for k, values in groups.items():
        low, high, spread, middle = brute(values)
        r = got[k]
        assert (r["min_amount"], r["max_amount"]) == (low, high)
        assert r["median_amount"] == pytest.approx(middle, rel=1e-15)
        if spread is None:
            assert r["stddev_amount"] is None
        else:
            assert r["stddev_amount"] == pytest.approx(float(spread), rel=1e-12, abs=1e-12)


def test_profile_reads_its_input_once(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, D("1.00"))], "k int, amount decimal(10,2)").write.parquet(path)
    df = spark.read.parquet(path).select(F.struct("k").alias("k"), "amount")
    out = amount_profile(df, "k", "amount")
    out.collect()
    assert "ReusedExchange" in plan_of(out).split("Initial Plan")[0]
