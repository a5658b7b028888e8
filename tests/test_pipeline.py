"""Landing and the daily run from page files to marts."""

import json
import os
from datetime import datetime

import pytest

from tidegate import schemas
from tidegate.plans import publish
from tidegate.plans.pipeline import Config, register_views, run_pipeline, watch_schemas
from tidegate.runtime import shared_folder, stage
from tidegate.sources import pages, tables

AS_OF = datetime(2024, 2, 1)


def uuid(i):
    return f"{i:08x}-0000-4000-8000-{i:012x}"


def tx(i, **change):
    return {
        "transaction_id": uuid(i), "user_id": 1 + i % 5, "product_category": "Books",
        "amount": 10 + i, "currency": "USD", "transaction_date": f"2024-01-{1 + i % 28:02d}T10:00:00",
        "status": "COMPLETED", **change,
    }


def user(i, **change):
    return {
        "user_id": i, "first_name": "ana", "last_name": "o'neil", "email": f"u{i}@mail.org",
        "ip_address": f"10.0.0.{i}", "country": "Ecuador", "registration_date": "2024-01-15", **change,
    }


def write_pages(folder, items, size=100, total=None, skip=()):
    folder.mkdir()
    chunks = [items[i : i + size] for i in range(0, len(items), size)]
    for n, chunk in enumerate(chunks, start=1):
        if n not in skip:
            page = {"page": n, "meta": {"total_pages": total or len(chunks)}, "data": chunk}
            (folder / f"{n}.json").write_text(json.dumps(page) + "\n")
    return str(folder)


def checked(spark, path, fields=schemas.TRANSACTION_FIELDS):
    landed = stage(pages.read_pages(spark, path, fields), "pages")
    return landed, pages.checked(pages.records(landed), fields)


def test_gaps_rejects_and_metrics(spark, tmp_path):
    items = [tx(i) for i in range(10)]
    items[0] = tx(0, user_id="x")
    items[1] = tx(1, status="REFUNDED")
    items[2] = tx(2, amount="much")
    items[3] = tx(3, transaction_id=None)
    items[4] = tx(4, currency="A very long currency")
    items[5] = tx(5, amount=None, product_category=None)
    folder = write_pages(tmp_path / "p", items, size=2, total=7, skip=(4,))
    (tmp_path / "p" / "broken.json").write_text('{"page": 6, "meta": {"tot\n')
    landed, rows = checked(spark, folder)
    assert sorted(r["page"] for r in pages.missing_pages(landed).collect()) == [4, 6, 7]
    reasons = sorted(r["reject_reason"] for r in pages.rejected(rows).collect())
    assert reasons == [
        "amount unreadable", "currency too long", "status not allowed", "transaction_id missing",
        "user_id unreadable",
    ]
    lost = pages.rejects(landed, rows).where("page_text IS NOT NULL").collect()
    assert [(r["page_text"], r["reject_reason"]) for r in lost] == [('{"page": 6, "meta": {"tot', "page unreadable")]
    assert pages.rejects(landed, rows).count() == 6
    good = pages.accepted(rows, schemas.TRANSACTION_FIELDS, "transaction_id")
    assert sorted(r["transaction_id"] for r in good.collect()) == [uuid(5), uuid(8), uuid(9)]
    assert [f.dataType for f in good.schema.fields] == [
        f.dataType for f in schemas.RAW_TRANSACTIONS.fields[:7]
    ]
    assert pages.extraction_metrics(landed, rows, good.count()) == {
        "records_inserted": 3, "errors": 5 + 3, "pages_processed": 7,
    }


def test_email_is_optional(spark, tmp_path):
    record = user(1)
    del record["email"]
    _, rows = checked(spark, write_pages(tmp_path / "u", [record]), schemas.USER_FIELDS)
    assert pages.accepted(rows, schemas.USER_FIELDS, "user_id").first()["email"] is None


def test_of_repeated_keys_the_first_record_is_taken(spark, tmp_path):
    items = [tx(2, amount="bad"), tx(1, amount=5), tx(1, amount=1), tx(2, amount=7), tx(1, amount=9)]
    landed, rows = checked(spark, write_pages(tmp_path / "p", items, size=2))
    good = pages.accepted(rows, schemas.TRANSACTION_FIELDS, "transaction_id")
    assert {r["transaction_id"]: float(r["amount"]) for r in good.collect()} == {uuid(1): 5, uuid(2): 7}
    assert pages.extraction_metrics(landed, rows, 2)["errors"] == 3


def read(spark, cfg, zone, table):
    return spark.read.parquet(tables.folder(cfg.root, zone, table))


def staged_folders(spark):
    folder = f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}"
    return set(os.listdir(folder.removeprefix("file:")))


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    """Two runs over the same pages; `kept` was staged before them."""
    tmp = tmp_path_factory.mktemp("daily")
    cfg = Config(
        root=str(tmp / "lake"),
        transaction_pages=write_pages(tmp / "tx", [tx(i) for i in range(250)]),
        user_pages=write_pages(tmp / "users", [user(i) for i in range(1, 6)]),
        salt="s",
    )
    kept = stage(spark.range(3).toDF("n"), "kept")
    before = staged_folders(spark)
    runs = [run_pipeline(spark, cfg, AS_OF, f"run-{n}") for n in (1, 2)]
    return cfg, runs, kept, before


def test_first_run_publishes_and_builds_models(spark, daily):
    cfg, (first, _), _, _ = daily
    assert first["status"] == "completed" and first["blocked"] == {}
    assert first["model_tests"] == []
    m = first["metrics"]
    assert m["land_transactions"] == {"records_inserted": 250, "errors": 0, "pages_processed": 3}
    assert m["publish_transactions"]["records_published"] == 250
    # the shipped warning suite holds one misspelt type
    assert m["audit_transactions"]["warnings"] == ["expect_column_values_to_be_match_regex (error)"]
    assert m["audit_users"]["success_rate"] == 100.0


def test_second_run_adds_nothing_to_the_tables_and_a_line_to_the_logs(spark, daily):
    cfg, (_, second), _, _ = daily
    assert second["metrics"]["publish_transactions"]["records_published"] == 0
    assert second["metrics"]["publish_transactions"]["duplicate_records"] == 250
    assert read(spark, cfg, "analytics", "fct_transactions").count() == 250
    people = {r["user_id"]: r for r in read(spark, cfg, "analytics", "dim_users").collect()}
    assert len(people) == 5 and people[1]["customer_segment"] == "VIP_Customer"
    assert read(spark, cfg, "audit", "gx_validation_logs").count() == 4
    assert read(spark, cfg, "audit", "data_freshness_monitor").count() == 4
    assert read(spark, cfg, "audit", "data_lineage").count() == 2 * 24
    assert read(spark, cfg, "audit", "pipeline_metrics").count() > 20


def test_masks_reach_prod_and_raw_values_do_not(spark, daily):
    cfg, _, _, _ = daily
    prod = read(spark, cfg, "prod", "raw_users").collect()
    assert all(r["email"].startswith("***") and r["ip_address"].startswith("***") for r in prod)
    ids = {r["transaction_id"] for r in read(spark, cfg, "prod", "raw_transactions").collect()}
    assert all(i.startswith("*" * 32) for i in ids)


def test_each_run_logs_a_schema_check_per_table(spark, daily):
    cfg, runs, _, _ = daily
    assert all(r["schema_drift"] == [] for r in runs)
    checks = read(spark, cfg, "audit", "schema_checks")
    assert checks.count() == 2 * 4 and checks.where("drift_detected").count() == 0
    later = datetime(2024, 2, 3)
    changed = {
        ("prod", "raw_users"): read(spark, cfg, "prod", "raw_users").drop("country").withColumnRenamed("email", "mail"),
        ("prod", "new"): spark.range(1),
    }
    root = str(cfg.root) + "-drift"
    same = {k: read(spark, cfg, *k) for k in [("prod", "raw_users")]}
    assert not watch_schemas(spark, root, same, AS_OF).where("drift_detected").count()
    lines = {r["table_name"]: r for r in watch_schemas(spark, root, changed, later).collect()}
    assert json.loads(lines["raw_users"]["changes_json"]) == {
        "new_columns": ["mail"], "removed_columns": ["country", "email"], "type_changes": [],
    }
    assert lines["raw_users"]["drift_detected"] and not lines["new"]["drift_detected"]
    assert json.loads(lines["new"]["schema_json"]) == {"id": {"type": "bigint", "nullable": False}}
    assert not watch_schemas(spark, root, changed, datetime(2024, 2, 4)).where("drift_detected").count()


def test_another_session_reads_every_view(spark, daily):
    cfg, _, _, _ = daily
    other = spark.newSession()
    names = register_views(other, cfg, AS_OF)
    counts = {n: other.table(n).count() for n in names}
    people = {n for n in names if n.endswith("_users") or n == "int_users_enriched"}
    assert len(names) == 19 and {counts.pop(n) for n in people} == {5}
    assert counts.pop("quality_dashboard") == 1 and counts.pop("freshness_dashboard") == 2
    assert set(counts.values()) == {250}
    masked = {r["user_id"]: r["email_masked"] for r in other.table("stg_masked_users").collect()}
    assert masked[1] == "u1***@mail.org"


def test_a_failed_replace_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    with pytest.raises(Exception):
        tables.replace(spark.range(4).selectExpr("raise_error('no') AS id"), path)
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t"]
    tables.replace(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]


def test_a_writer_lost_between_delete_and_rename_leaves_the_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = spark.range(1).schema
    assert tables.read_table(spark, path, schema).count() == 0
    tables.replace(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}.new-half")  # lost before its mark
    assert tables.read_table(spark, path, schema).count() == 3
    os.rename(path, f"{path}.new-whole")
    assert tables.read_table(spark, path, schema).count() == 3
    assert tables.standing(spark, path).endswith("t.new-whole")
    tables.replace(spark.range(5), path)
    assert tables.read_table(spark, path, schema).count() == 5 and os.listdir(tmp_path) == ["t"]


def test_runs_publish_to_committed_tables(spark, tmp_path):
    cfg = Config(
        root=str(tmp_path / "lake"),
        transaction_pages=write_pages(tmp_path / "tx", [tx(i) for i in range(30)]),
        user_pages=write_pages(tmp_path / "users", [user(i) for i in range(1, 6)]),
        salt="s",
        committed=True,
        buckets=4,
        run_model_tests=False,
    )
    first = run_pipeline(spark, cfg, AS_OF, "run-1")
    assert first["status"] == "completed" and first["metrics"]["publish_transactions"]["records_published"] == 30
    again = run_pipeline(spark, cfg, AS_OF, "run-1")
    assert again["metrics"]["publish_transactions"]["records_published"] == 0 and not again["schema_drift"]
    assert register_views(spark.newSession(), cfg, AS_OF)
    target = cfg.published(publish.TRANSACTIONS)
    assert target.read(spark, publish.TRANSACTIONS.schema).count() == 30 and target.commits(spark) == [1]


def test_a_run_removes_its_staged_tables_and_no_others(spark, daily):
    _, _, kept, before = daily
    assert before <= staged_folders(spark) and kept.count() == 3
    assert all(name == "kept" for name in staged_folders(spark))


def test_a_failed_audit_stops_its_table_and_the_models(spark, tmp_path):
    cfg = Config(
        root=str(tmp_path / "lake"),
        transaction_pages=write_pages(tmp_path / "tx", [tx(1, currency="XXX"), tx(2, currency="XXX"), tx(3)]),
        user_pages=write_pages(tmp_path / "users", [user(i) for i in range(1, 6)]),
        salt="s",
    )
    result = run_pipeline(spark, cfg, AS_OF, "run-1")
    assert result["status"] == "blocked"
    assert "currency is known: 2 registros" in result["blocked"]["raw_transactions"]
    assert "publish_transactions" not in result["metrics"]
    assert result["metrics"]["publish_users"]["records_published"] == 5
    assert not tables.exists(spark, tables.folder(cfg.root, "analytics", "dim_users"))
    assert read(spark, cfg, "audit", "gx_validation_logs").where("blocking_triggered").count() == 1
    assert read(spark, cfg, "audit", "data_lineage").count() == 24


def test_an_empty_extract_is_blocked_and_tables_may_be_bucketed(spark, tmp_path):
    cfg = Config(
        root=str(tmp_path / "lake"),
        transaction_pages=write_pages(tmp_path / "tx", [tx(1)]),
        user_pages=write_pages(tmp_path / "users", [user(1, ip_address=None)]),
        salt="s",
        database="default",
        buckets=2,
    )
    try:
        result = run_pipeline(spark, cfg, AS_OF, "run-1")
        assert "Sin datos" in result["blocked"]["raw_users"]
        assert spark.table("default.prod_raw_transactions").count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS default.prod_raw_transactions")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_partitioned_warehouse_read_asks_for_ranges():
    class Reader:
        def jdbc(self, *args, **kw):
            return args, kw

    class Session:
        read = Reader()

    args, kw = tables.read_jdbc(Session(), "url", "t", {"user": "u"}, "id", (0, 100), 8)
    assert args == ("url", "t", "id", 0, 100, 8) and kw == {"properties": {"user": "u"}}
    assert tables.read_jdbc(Session(), "url", "t", {}, one_task=True)[0] == ("url", "t")
    with pytest.raises(ValueError):
        tables.read_jdbc(Session(), "url", "t", {})


def test_masking_rules_load_from_json(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"fields": {}}')
    assert tables.load_masking_rules(str(path)) == {"fields": {}}
