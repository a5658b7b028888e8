import pathlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.plans import governance as G
from tidegate.plans import shredding as S
from tidegate.runtime import stage
from tidegate.sources.tables import SnapshotTable

AS_OF = datetime(2024, 2, 1)


def snapshot(spark, columns, table="t", at=AS_OF):
    rows = [("prod", table, n, t, True, at) for n, t in columns.items()]
    return spark.createDataFrame(rows, G.SCHEMA_HISTORY)


def changes(df):
    return {(r["column_name"], r["change"], r["old_type"], r["new_type"]) for r in df.collect()}


def test_drift(spark):
    before = snapshot(spark, {"a": "int", "b": "string", "c": "int"})
    now = snapshot(spark, {"a": "bigint", "b": "string", "d": "int"})
    assert changes(G.schema_drift(before, now)) == {
        ("a", "type_change", "int", "bigint"),
        ("c", "removed_column", "int", None),
        ("d", "new_column", None, "int"),
    }
    back = changes(G.schema_drift(now, before))
    assert {(c, k) for c, k, _, _ in back} == {
        ("a", "type_change"), ("c", "new_column"), ("d", "removed_column"),
    }
    assert changes(G.schema_drift(before, before)) == set()


def test_first_check_of_a_table_is_no_drift(spark):
    assert changes(G.schema_drift(snapshot(spark, {"a": "int"}), snapshot(spark, {"x": "int"}, "new"))) == {
        ("a", "removed_column", "int", None)
    }


def test_snapshots_of_frames_and_the_latest_of_each_table(spark):
    df = spark.createDataFrame([], "a int, b decimal(10,2)")
    old = G.schema_snapshot(spark, "prod", "t", df.select("a"), AS_OF - timedelta(days=1))
    new = G.schema_snapshot(spark, "prod", "t", df, AS_OF)
    other = G.schema_snapshot(spark, "prod", "u", df.select("b"), AS_OF - timedelta(days=9))
    latest = G.latest_snapshot(old.unionByName(new).unionByName(other))
    assert {(r["table_name"], r["column_name"], r["type"]) for r in latest.collect()} == {
        ("t", "a", "int"), ("t", "b", "decimal(10,2)"), ("u", "b", "decimal(10,2)"),
    }
    assert G.schema_drift(latest, new.unionByName(other)).count() == 0


def test_every_edge_of_the_lineage_joins_once_per_run(spark):
    runs = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "dag_execution_id string")
    log = G.record_lineage(runs, AS_OF)
    assert log.count() == 3 * (13 + 11)
    view = G.lineage_view(log)
    assert {r["count"] for r in view.groupBy("dag_execution_id").count().collect()} == {11}
    sources = {r["source"] for r in view.where("target = 'dim_users'").collect()}
    assert sources == {"int_users_enriched"}


def test_lineage_of_many_runs_is_not_broadcast(spark, plan_of):
    """A run is one short row below, whatever number of lines is made of it."""
    runs = spark.createDataFrame([("r1",), ("r1",), (None,)], "dag_execution_id string")
    view = G.lineage_view(G.record_lineage(runs, AS_OF))
    assert "Broadcast" not in plan_of(view)
    assert view.count() == 8 * 11


def test_catalogue_keeps_what_it_has(spark):
    seed = G.pii_seed(spark)
    assert seed.count() == 9
    mine = seed.limit(1).withColumn("retention_days", F.lit(1))
    merged = G.pii_upsert(mine, seed.unionByName(seed))
    assert merged.count() == 9
    assert merged.where("retention_days = 1").count() == 1
    assert G.pii_upsert(merged, seed).count() == 9
    first = G.pii_view(merged).first()
    assert first["pii_sensitivity"] == "medium"  # text order, descending


@pytest.mark.parametrize(
    "hours, status", [(1.99, "FRESH"), (2, "STALE"), (5.99, "STALE"), (6, "MISSING"), (25, "MISSING")]
)
def test_freshness(spark, hours, status):
    df = spark.createDataFrame([(AS_OF - timedelta(hours=hours),)], "ingested_at timestamp_ntz")
    r = G.freshness_check({"t": df}, AS_OF).first()
    assert r["status"] == status
    assert r["lag_hours"] == (None if hours > 24 else pytest.approx(hours))
    log = df.select(F.lit("t").alias("table_name"), F.col("ingested_at").alias("actual_arrival_time"))
    assert G.freshness_dashboard(log, AS_OF).first()["freshness_status"] == status


def test_dashboards_on_few_rows(spark):
    rows = [(AS_OF, 1, -1.0), (AS_OF, None, 0.0), (AS_OF, 2, None), (None, 1, 1.0)]
    df = spark.createDataFrame(rows, "ingested_at timestamp_ntz, user_id int, amount double")
    r = G.quality_dashboard(df).where("fecha IS NOT NULL").first()
    assert tuple(r)[1:] == (3, 1, 1, 1, 33.33)
    users = spark.createDataFrame([("a",), (None,)], "email string")
    assert tuple(G.email_completeness(users).first()) == (2, 1, 50.0)
    assert tuple(G.email_completeness(users.limit(0)).first()) == (0, 0, None)
    prof = G.column_profile(df, "user_id", "ingested_at").first()
    assert (prof["total_rows"], prof["null_rate"], prof["uniqueness_rate"]) == (4, 0.25, 0.5)


# --- encryption ------------------------------------------------------------


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "a@x"), (2, "b@x"), (3, "c@x"), (4, None), (None, "n@x")], "user_id int, email string"
    )


@pytest.fixture
def table(tmp_path):
    return SnapshotTable(str(tmp_path / "keys"))


@pytest.fixture
def keys(spark, table):
    owners = spark.createDataFrame([(1,), (2,), (4,), (1,), (None,)], "user_id int")
    return S.generate_keys(owners, AS_OF, table)


def test_keys_are_stored_and_distinct(keys):
    first, again = keys.collect(), keys.collect()
    assert sorted(first) == sorted(again)
    assert len({bytes(r["encryption_key"]) for r in first}) == 3
    assert all(len(r["encryption_key"]) == 16 for r in first)


def test_read_back_and_rejects(people, keys):
    sealed, rejected = S.encrypt(people, keys, ["email"])
    assert {r["user_id"] for r in rejected.collect()} == {3, None}
    plain = {1: b"a@x", 2: b"b@x"}
    for r in sealed.collect():
        assert r["email"] is None or bytes(r["email"]) != plain[r["user_id"]]
    opened = S.decrypt(sealed, keys, ["email"])
    assert {(r["user_id"], r["email"]) for r in opened.collect()} == {(1, "a@x"), (2, "b@x"), (4, None)}


def test_hot_users_are_sealed_alike(spark, keys):
    data = spark.range(200).select(F.lit(1).alias("user_id"), "id", F.col("id").cast("string").alias("email"))
    sealed, rejected = S.encrypt(data, keys, ["email"], spread="id")
    opened = S.decrypt(sealed, keys, ["email"], spread="id")
    assert rejected.count() == 0
    assert opened.where("email = CAST(id AS STRING)").count() == 200


def test_newest_of_several_active_keys(spark, people, keys):
    newer = keys.where("user_id = 1").withColumn("key_version", F.lit(2))
    both = keys.unionByName(newer.withColumn("encryption_key", F.lit(b"0123456789abcdef")))
    sealed, _ = S.encrypt(people, both, ["email"])
    assert sealed.count() == 3
    opened = S.decrypt(sealed.where("user_id = 1"), keys, ["email"]).first()
    assert opened["email"] is None  # sealed with version 2
    nothing = S.register_requests(
        spark.createDataFrame([], "request_id string, user_id int, reason string"), AS_OF
    )
    assert S.deletion_status(people, both, nothing).count() == 5


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "user_id int")


def test_a_second_batch_keeps_all_earlier_keys(spark, people, keys, table):
    sealed = stage(S.encrypt(people, keys, ["email"])[0], "sealed")
    first = {r["user_id"]: bytes(r["encryption_key"]) for r in keys.collect()}
    both = S.generate_keys(ids(spark, 2, 3), AS_OF, table).collect()
    assert {r["user_id"]: bytes(r["encryption_key"]) for r in both if r["user_id"] != 3} == first
    assert sorted((r["user_id"], r["key_version"]) for r in both) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    now = table.read(spark, S.ENCRYPTION_KEYS)
    opened = {r["user_id"]: r["email"] for r in S.decrypt(sealed, now, ["email"]).collect()}
    assert opened == {1: "a@x", 2: "b@x", 4: None}


def test_a_user_who_left_and_comes_back_gets_another_version(spark, people, keys, table):
    sealed = stage(S.encrypt(people, keys, ["email"])[0], "sealed")
    asked = spark.createDataFrame([("r1", 1, "left")], "request_id string, user_id int, reason string")
    S.shred(table, S.register_requests(asked, AS_OF), AS_OF)
    now = S.generate_keys(ids(spark, 1, 2), AS_OF, table)
    mine = sorted((r["key_version"], r["is_active"]) for r in now.where("user_id = 1").collect())
    assert mine == [(1, False), (2, True)]
    opened = {r["user_id"]: r["email"] for r in S.decrypt(sealed, now, ["email"]).collect()}
    assert opened == {1: None, 2: "b@x", 4: None}
    again, _ = S.encrypt(people, now, ["email"])
    assert {r["user_id"]: r["key_version"] for r in again.collect()} == {1: 2, 2: 1, 4: 1}


def test_rotation(spark, people, keys, table):
    sealed = stage(S.encrypt(people, keys, ["email"])[0], "sealed")
    now = S.rotate_keys(ids(spark, 1, 3, 1), AS_OF, table)  # 3 has no key and gets none
    assert sorted((r["user_id"], r["key_version"], r["is_active"]) for r in now.collect()) == [
        (1, 1, False), (1, 2, True), (2, 1, True), (4, 1, True),
    ]
    plain = {1: "a@x", 2: "b@x", 4: None}
    assert {r["user_id"]: r["email"] for r in S.decrypt(sealed, now, ["email"]).collect()} == plain
    moved = stage(S.reseal(sealed, now, ["email"]), "resealed")
    assert moved.columns == sealed.columns
    assert {r["user_id"]: r["key_version"] for r in moved.collect()} == {1: 2, 2: 1, 4: 1}
    kept = S.drop_unused(table, sealed)
    assert kept.where("encryption_key IS NULL").count() == 0
    after = S.drop_unused(table, moved)
    assert [(r["user_id"], r["key_version"]) for r in after.where("encryption_key IS NULL").collect()] == [(1, 1)]
    assert {r["user_id"]: r["email"] for r in S.decrypt(moved, after, ["email"]).collect()} == plain
    assert {r["user_id"]: r["email"] for r in S.decrypt(sealed, after, ["email"]).collect()} == {**plain, 1: None}


def test_a_request_destroys_all_versions(spark, people, keys, table):
    sealed = stage(S.encrypt(people, keys, ["email"])[0], "sealed")
    S.rotate_keys(ids(spark, 1), AS_OF, table)
    asked = spark.createDataFrame([("r1", 1, "left")], "request_id string, user_id int, reason string")
    after, _ = S.shred(table, S.register_requests(asked, AS_OF), AS_OF)
    assert after.where("user_id = 1 AND encryption_key IS NOT NULL").count() == 0
    assert {r["user_id"]: r["email"] for r in S.decrypt(sealed, after, ["email"]).collect()}[1] is None


def test_sealed_values_are_bound_to_their_place(spark, people, keys):
    sealed = stage(S.encrypt(people.withColumn("name", F.col("email")), keys, ["email", "name"])[0], "sealed")
    swapped = sealed.withColumns({"email": F.col("name"), "name": F.col("email")})
    assert S.decrypt(swapped, keys, ["email", "name"]).where("email IS NOT NULL OR name IS NOT NULL").count() == 0
    one = sealed.where("user_id = 1").select(F.lit(2).alias("user_id"), "email", "key_version")
    assert S.decrypt(one, keys, ["email"]).first()["email"] is None


def test_snapshots_need_no_marker_of_the_committer(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"))
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(name, "false")
    try:
        table.replace(spark.range(3))
        assert table.read(spark, StructType.fromDDL("id long")).count() == 3
    finally:
        conf.unset(name)
    for n in (2, 3):  # lost writes beside no complete snapshot are not read as an empty table
        (tmp_path / "u" / f"snapshot-{n}").mkdir(parents=True)
    with pytest.raises(RuntimeError):
        SnapshotTable(str(tmp_path / "u")).read(spark, StructType.fromDDL("id long"))


def test_no_file_holds_a_shredded_key(spark, people, keys, table, tmp_path):
    drawn = {r["user_id"]: bytes(r["encryption_key"]) for r in keys.collect()}
    asked = spark.createDataFrame([("r1", 1, "left")], "request_id string, user_id int, reason string")
    S.shred(table, S.register_requests(asked, AS_OF), AS_OF)
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    files = [f for root in (tmp_path, shared) for f in root.rglob("*") if f.is_file()]
    assert any(drawn[2] in f.read_bytes() for f in files)
    assert not any(drawn[1] in f.read_bytes() for f in files)


def test_snapshots_survive_an_interrupted_write(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"))
    schema = StructType.fromDDL("id long")
    assert table.read(spark, schema).count() == 0
    table.replace(spark.range(3))
    (tmp_path / "t" / "snapshot-2").mkdir()  # no _SUCCESS: the writer was lost
    assert table.read(spark, schema).count() == 3
    table.replace(spark.range(5))
    assert table.read(spark, schema).count() == 5
    assert [f.name for f in (tmp_path / "t").iterdir()] == ["snapshot-3"]


def test_shredded_users_cannot_be_read(spark, people, keys, table):
    sealed = stage(S.encrypt(people, keys, ["email"])[0], "sealed")
    asked = spark.createDataFrame(
        [("r1", 1, "left"), ("r2", 1, "asked again"), ("r3", 3, "no key")],
        "request_id string, user_id int, reason string",
    )
    requests = S.register_requests(asked, AS_OF)
    assert {r["status"] for r in requests.collect()} == {"processing"}
    after, done = S.shred(table, requests, AS_OF)
    r = {x["user_id"]: x for x in after.collect()}
    assert len(r) == 3
    assert (r[1]["is_active"], r[1]["encryption_key"], r[1]["revoked_at"]) == (False, None, AS_OF)
    assert r[2]["is_active"] and r[2]["encryption_key"] is not None
    assert {x["status"] for x in done.collect()} == {"completed"} and done.count() == 3
    opened = {x["user_id"]: x["email"] for x in S.decrypt(sealed, after, ["email"]).collect()}
    assert opened == {1: None, 2: "b@x", 4: None}
    status = {x["user_id"]: x for x in S.deletion_status(people, after, done).collect()}
    assert (status[1]["found"], status[1]["key_active"], status[1]["deletion_status"]) == (True, False, "completed")
    assert status[1]["notes"] == "asked again"
    assert (status[2]["found"], status[2]["deletion_status"]) == (True, None)
    assert (status[3]["found"], status[3]["deletion_status"], status[3]["notes"]) == (False, None, None)

    again, _ = S.shred(table, requests, AS_OF + timedelta(days=1))
    assert {x["user_id"]: x["revoked_at"] for x in again.collect()}[1] == AS_OF
