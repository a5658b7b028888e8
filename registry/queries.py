"""One entry per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions import masking as M
from tidegate.functions.scalars import moment
from tidegate.operators import modeltests, quality, quantiles
from tidegate.operators.skew import known_keys, measure
from tidegate.plans import (
    governance, intermediate, marts, publish, shredding, staging, suites, views,
)
from tidegate.plans import column_lineage as CL
from tidegate.plans.incremental import MetricState
from tidegate.runtime import shared_folder, stage
from tidegate.sources import paged, pages, tables
from tidegate.sources.committed import CommittedTable
from tidegate.sources.registry import EvolvingTable, Plan
from tidegate.sources.zones import DailyTable

from .fixtures import AS_OF, FRESH_AS_OF, SALT, fixture

Query = Callable[[SparkSession, str], DataFrame]
PAGE_SIZE = 100

# --- inputs ----------------------------------------------------------------


def _fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/inputs/{label}-{uuid.uuid4().hex}"


def _users(spark, d):
    return fixture(spark, d, "users").withColumns(
        {
            "ingested_at": F.col("registration_date").cast("timestamp_ntz"),
            "processed_at": moment(AS_OF),
        }
    )


def _stg(spark, d):
    return staging.stg_transactions(fixture(spark, d, "tx"), AS_OF)


def _stg_users(spark, d):
    return staging.stg_users(_users(spark, d), AS_OF)


def _int_users(spark, d):
    activity = intermediate.activity_base(intermediate.day_cells(_stg(spark, d)))
    return intermediate.int_users(_stg_users(spark, d), activity, AS_OF)


def _int_transactions(spark, d):
    """Spread rounded, since its last digits depend on the way of computing it."""
    rows = intermediate.int_transactions(_stg(spark, d))
    sd = "user_stddev_transaction_amount"
    return rows.withColumn(sd, F.round(sd, 6))


def _fct_transactions(spark, d):
    return marts.fct_transactions(intermediate.int_transactions(_stg(spark, d)))


def _fct_users(spark, d):
    return marts.fct_users(_int_users(spark, d))


def _dim_users(spark, d):
    return marts.dim_users(_int_users(spark, d), AS_OF)


# --- landing ---------------------------------------------------------------

_WIRE_FIELDS = [f.name for f in schemas.TRANSACTION_FIELDS]


def _page_lines(spark, d) -> DataFrame:
    """Pages of at most PAGE_SIZE records as JSON lines."""
    wire = fixture(spark, d, "wire")
    page = (F.floor(F.col("event_id") / PAGE_SIZE) + 1).cast("long")
    last = wire.agg(F.max(page)).first()[0]
    return (
        wire.groupBy(page.alias("page"))
        .agg(
            F.sort_array(F.collect_list(F.struct("event_id", *_WIRE_FIELDS))).alias("data"),
            F.min_by("product_category", "event_id").alias("opens_with"),
        )
        .select(
            F.to_json(
                F.struct(
                    "page", F.struct(F.lit(last).alias("total_pages")).alias("meta"), "data"
                )
            ).alias("value"),
            "opens_with",
            "page",
        )
    )


def _landed_pages(spark, d, lose_pages: bool = False) -> DataFrame:
    """The pages, written as JSON lines and read back.

    With `lose_pages`, a page whose first record is an error was not delivered,
    and one that starts with a sign-up arrived cut short.
    """
    lines = _page_lines(spark, d)
    if lose_pages:
        cut = F.when(F.col("opens_with") == "SIGNUP", F.substring("value", 1, 40))
        lines = lines.where(F.col("opens_with") != "ERROR").select(
            F.coalesce(cut, F.col("value")).alias("value")
        )
    folder = _fresh_folder(spark, "pages")
    lines.select("value").write.text(folder)
    return pages.read_pages(spark, folder, schemas.TRANSACTION_FIELDS)


def paged_source(spark, d):
    """Pages fetched one by one; those that a first run did not get, a second one does."""
    lines = stage(_page_lines(spark, d), "page-lines").select("page", "value", "opens_with")
    folder, log = _fresh_folder(spark, "paged"), paged.OffsetLog(_fresh_folder(spark, "offsets"))
    late = F.col("opens_with") == "ERROR"
    out = None
    for run_id, delivered in (("run-1", lines.where(~late)), ("run-2", lines.where(late))):
        delivered.select("page", "value").write.mode("append").partitionBy("page").text(folder)
        read = stage(paged.read_source(spark, folder, log, pause=0.01, pages_per_task=16), "fetched")
        log.add(read, run_id)
        records = pages.records(paged.as_pages(read, schemas.TRANSACTION_FIELDS))
        own = records.groupBy("page").agg(F.count("*").alias("records")).withColumn("run_id", F.lit(run_id))
        out = own if out is None else out.unionByName(own)
    return out


def _checked_records(spark, d, lose_pages: bool = False):
    landed = _landed_pages(spark, d, lose_pages)
    return landed, pages.checked(pages.records(landed), schemas.TRANSACTION_FIELDS)


def _accepted(rows: DataFrame) -> DataFrame:
    return pages.accepted(rows, schemas.TRANSACTION_FIELDS, "transaction_id")


def land_pages(spark, d):
    return _accepted(_checked_records(spark, d)[1])


def page_gap_report(spark, d):
    return pages.missing_pages(_landed_pages(spark, d, lose_pages=True))


def corrupt_pages(spark, d):
    return pages.unreadable(stage(_landed_pages(spark, d, lose_pages=True), "pages"))


def reject_split(spark, d):
    rows = pages.rejected(_checked_records(spark, d)[1])
    return rows.select(*_WIRE_FIELDS, "reject_reason")


def extraction_metrics(spark, d):
    landed, rows = _checked_records(spark, d, lose_pages=True)
    numbers = pages.extraction_metrics(landed, rows, _accepted(rows).count())
    return spark.createDataFrame(
        [tuple(numbers.values())], ", ".join(f"{k} bigint" for k in numbers)
    )


# --- publish ---------------------------------------------------------------


def _published_before(spark, d) -> DataFrame:
    """Keys published by an earlier run: what had arrived by mid-1996."""
    earlier = fixture(spark, d, "batch").where("ingested_at < TIMESTAMP_NTZ '1996-07-01 00:00:00'")
    rows = publish.one_per_key(publish.TRANSACTIONS, earlier, AS_OF, SALT)
    return rows.select("transaction_key")


def publish_tx_clean(spark, d):
    return publish.clean_transactions(fixture(spark, d, "dirty"))


def publish_users_clean(spark, d):
    return publish.clean_users(_users(spark, d))


def publish_tx_masked(spark, d):
    return M.apply_rules(fixture(spark, d, "batch"), M.DEFAULT_RULES, strict=False)


def publish_tx_dedup(spark, d):
    rows = publish.one_per_key(publish.TRANSACTIONS, fixture(spark, d, "batch"), AS_OF, SALT)
    return rows.drop("processed_at", "data_quality_score")


def publish_tx_new(spark, d):
    batch = publish.one_per_key(publish.TRANSACTIONS, fixture(spark, d, "batch"), AS_OF, SALT)
    batch = measure(stage(batch, "batch"), "transaction_key")
    known = known_keys(batch, _published_before(spark, d))
    new = publish.not_published(batch.table, known, batch.key)
    return new.select("transaction_id", "transaction_key", "amount", "ingested_at")


def publish_tx_indexed(spark, d):
    """Keys looked up through the index of a committed table, written by two runs before."""
    table = CommittedTable(_fresh_folder(spark, "indexed"), "transaction_key", buckets=16)
    before = stage(_published_before(spark, d), "before")
    half = F.col("transaction_key") < "8"
    table.append(before.where(half), "run-1")
    table.append(before.where(~half), "run-2")
    batch = publish.one_per_key(publish.TRANSACTIONS, fixture(spark, d, "batch"), AS_OF, SALT)
    batch = stage(batch, "batch")
    known, _ = table.known_keys(batch)
    new = publish.not_published(batch, known, "transaction_key")
    return new.select("transaction_id", "transaction_key", "amount", "ingested_at")


def publish_committed(spark, d):
    """Two runs, each repeated, beside a write that was lost before its commit."""
    raw = fixture(spark, d, "batch")
    earlier = raw.where("ingested_at < TIMESTAMP_NTZ '1996-07-01 00:00:00'")
    entity = publish.TRANSACTIONS
    target = CommittedTable(_fresh_folder(spark, "committed"), entity.published_key, buckets=8)
    args = dict(audit={"audit_passed": True}, salt=SALT, rules=M.DEFAULT_RULES)
    for _ in range(2):
        publish.publish(spark, entity, earlier, target, as_of=FRESH_AS_OF, run_id="day-1", **args)
    raw.limit(5).write.parquet(f"{target.path}/_write=2-lost")
    for _ in range(2):
        publish.publish(spark, entity, raw, target, as_of=AS_OF, run_id="day-2", **args)
    return target.read(spark, entity.schema).select(*_PUBLISHED)


def _publish_run(spark, d, entity, raw, earlier=None):
    """Publish an earlier part and then everything; return the last metrics and the table."""
    target = tables.FolderTable(_fresh_folder(spark, "prod"))
    args = dict(audit={"audit_passed": True}, salt=SALT, rules=M.DEFAULT_RULES)
    if earlier is not None:
        publish.publish(spark, entity, earlier, target, as_of=FRESH_AS_OF, **args)
    metrics = publish.publish(spark, entity, raw, target, as_of=AS_OF, **args)
    return metrics, target.read(spark, entity.schema)


def _publish_transactions(spark, d):
    raw = fixture(spark, d, "batch")
    earlier = raw.where("ingested_at < TIMESTAMP_NTZ '1996-07-01 00:00:00'")
    return _publish_run(spark, d, publish.TRANSACTIONS, raw, earlier)


_PUBLISHED = [
    "transaction_id", "transaction_key", "user_id", "product_category", "amount", "currency",
    "transaction_date", "status", "ingested_at", "processed_at", "data_quality_score",
]


def publish_transactions(spark, d):
    return _publish_transactions(spark, d)[1].select(*_PUBLISHED)


def publish_metrics(spark, d):
    m = _publish_transactions(spark, d)[0]
    return spark.createDataFrame(
        [tuple(m.values())],
        "records_published bigint, records_filtered bigint, duplicate_records bigint, "
        "approval_rate double",
    )


def publish_users(spark, d):
    raw = _users(spark, d).drop("processed_at", "data_quality_score")
    _, table = _publish_run(spark, d, publish.USERS, raw)
    return table.drop("source_file", "gx_validation_status", "gx_validation_errors")


# --- expectations and model tests -----------------------------------------


def _one(table: str, kind: str, **kwargs) -> Query:
    suite = quality.Suite("single", [quality.Expectation(kind, kwargs, kind, "CHECK")])
    return lambda spark, d: quality.run_suite(fixture(spark, d, table), suite)


SINGLE_CHECKS = {
    "dq_row_count": ("dirty", quality.ROW_COUNT, dict(min_value=1)),
    "dq_not_null": ("dirty", quality.NOT_NULL, dict(column="user_id", mostly=0.9)),
    "dq_unique": ("dirty", quality.UNIQUE, dict(column="transaction_id")),
    "dq_in_set": ("dirty", quality.IN_SET, dict(column="currency", value_set=suites.CURRENCIES)),
    "dq_regex": ("dirty", quality.REGEX, dict(column="transaction_id", regex=suites.UUID)),
    "dq_between": (
        "dirty", quality.BETWEEN,
        dict(column="amount", min_value=0.01, max_value=100000, mostly=0.99),
    ),
    "dq_length": ("users", quality.LENGTH, dict(column="first_name", min_value=1, max_value=12)),
}


def _suite(table: str, suite: quality.Suite) -> Query:
    return lambda spark, d: quality.run_suite(fixture(spark, d, table), suite)


SUITE_RUNS = {
    "dq_suite_tx_critical": ("dirty", suites.TRANSACTIONS_CRITICAL),
    "dq_suite_tx_warning": ("dirty", suites.TRANSACTIONS_WARNINGS),
    "dq_suite_users_critical": ("users", suites.USERS_CRITICAL),
    "dq_suite_users_warning": ("users", suites.USERS_WARNINGS),
}


BROKEN = quality.Suite(
    "broken",
    [
        quality.Expectation(quality.IN_SET, {"column": "currency"}, "no set", "CHECK"),
        quality.Expectation(quality.REGEX, {"column": "currency", "regex": "("}, "no pattern", "CHECK"),
        quality.Expectation(quality.BETWEEN, {"column": "status", "min_value": 1}, "text in a range", "CHECK"),
        quality.Expectation(quality.NOT_NULL, {"column": "absent"}, "no column", "CHECK"),
        quality.Expectation("expect_magic", {"column": "status"}, "no such type", "CHECK"),
        quality.Expectation(quality.NOT_NULL, {"column": "user_id", "mostly": 0.5}, "half is set", "CHECK"),
    ],
)


def dq_suite_empty(spark, d):
    """A suite without expectations adds no line to those of another over the same rows."""
    rows = fixture(spark, d, "dirty")
    empty = quality.run_suite(rows, quality.Suite("empty", []))
    return quality.run_suite(rows, BROKEN).unionByName(empty)


_SIDES = [
    ("dirty", "audit.raw_transactions", suites.TRANSACTIONS_CRITICAL, suites.TRANSACTIONS_WARNINGS),
    ("users", "audit.raw_users", suites.USERS_CRITICAL, suites.USERS_WARNINGS),
]


def dq_combined_log(spark, d, run=quality.run_audit):
    """The log lines of both audits: a blocked one and one that passes."""
    lines = [
        quality.audit_log(run(fixture(spark, d, table), critical, warning), name, critical.name)
        for table, name, critical, warning in _SIDES
    ]
    return reduce(DataFrame.unionByName, lines).withColumn(
        "failures", F.array_join("failures", "; ")
    )


def dq_combined_log_observed(spark, d):
    """The same lines from numbers taken while the tables are written."""

    def while_written(rows, critical, warning):
        watched = quality.Watched(rows, critical, warning, {})
        return watched.lines(stage(watched.rows, "watched"))

    return dq_combined_log(spark, d, while_written)


def median_sketch_rank(spark, d):
    """Quartiles of sketches merged over users: are their exact ranks as near as promised?"""
    done = _stg(spark, d).where(intermediate.completed())
    cells = stage(quantiles.sketched(done, ["user_id", "product_category"], "amount"), "sketches")
    whole = stage(quantiles.merged(cells, ["product_category"]), "merged")
    shares = (0.25, 0.5, 0.75)
    asked = whole.select(
        F.col("product_category").alias("kind"),
        quantiles.sketch_size("sketch").alias("n"),
        F.inline(F.array(*[
            F.struct(F.lit(q).alias("share"), quantiles.quantile("sketch", q).alias("value")) for q in shares
        ])),
    )
    ranks = done.where("amount IS NOT NULL").join(
        F.broadcast(asked), F.col("product_category").eqNullSafe(F.col("kind"))
    )
    margin = 3 * quantiles.rank_error()
    below, upto = F.count_if(F.col("amount") < F.col("value")), F.count_if(F.col("amount") <= F.col("value"))
    inside = F.col("share").between(below / F.col("n") - margin, upto / F.col("n") + margin)
    return ranks.groupBy("product_category", "share", "n").agg(inside.alias("within_bound"))


def null_profile_users(spark, d):
    return quality.null_profile(
        _users(spark, d),
        {
            "user_id": "null_ids",
            "first_name": "null_first_name",
            "last_name": "null_last_name",
            "ip_address": "null_ips",
            "email": "null_emails",
        },
    )


def null_profile_tx(spark, d):
    return quality.null_profile(
        fixture(spark, d, "dirty"), {"user_id": "null_users", "transaction_id": "null_ids"}
    )


def _model_tests(kind: str) -> Query:
    def run(spark, d):
        tests = [t for t in modeltests.DECLARED if t.kind == kind]
        names = {t.model for t in tests}
        stg = _stg(spark, d)
        enriched = intermediate.int_transactions(stg)
        models = {
            "stg_raw_transactions": stg,
            "int_transactions_enriched": enriched,
            "fct_transactions": marts.fct_transactions(enriched),
            "dim_users": _dim_users(spark, d),
            "prod.raw_transactions": fixture(spark, d, "tx"),
            "prod.raw_users": _users(spark, d),
        }
        return modeltests.run_tests({n: m for n, m in models.items() if n in names}, tests)

    return run


# --- metrics and quartiles -------------------------------------------------


def user_metrics(spark, d):
    sd = "stddev_transaction_amount"
    return intermediate.user_metrics(_stg(spark, d)).withColumn(sd, F.round(sd, 6))


def _user_totals(spark, d):
    return (
        _stg(spark, d)
        .where(intermediate.completed())
        .groupBy("user_id")
        .agg(
            F.sum("amount").cast("decimal(20,2)").alias("total_amount"),
            F.count(F.lit(1)).alias("total_transactions"),
        )
    )


def user_value_quartile(spark, d):
    return intermediate.with_user_quartiles(_user_totals(spark, d), frequency=False)


def user_frequency_quartile(spark, d):
    return intermediate.with_user_quartiles(_user_totals(spark, d), value=False)


def daily_moving_avg(spark, d):
    return intermediate.daily_metrics(_stg(spark, d)).select(
        "transaction_day", "daily_total_amount", "daily_amount_7day_moving_avg"
    )


# --- governance ------------------------------------------------------------


def _catalog(spark, d):
    lines = fixture(spark, d, "catalog_lines")
    listed = lines.where("pii_sensitivity = 'low' OR retention_days > 200").withColumn(
        "protection_method", F.lit("hash_salting")
    )
    incoming = lines.unionByName(governance.pii_seed(spark))
    return governance.pii_upsert(listed, incoming)


def schema_drift(spark, d):
    return governance.schema_drift(
        fixture(spark, d, "schema_before"), fixture(spark, d, "schema_now")
    )


def freshness_check(spark, d):
    raw = {"audit.raw_transactions": fixture(spark, d, "tx"), "audit.raw_users": _users(spark, d)}
    return governance.freshness_check(raw, FRESH_AS_OF)


def freshness_partitioned(spark, d):
    """The same check over tables by day, of which the days that count are opened."""
    since = (FRESH_AS_OF - timedelta(hours=24)).date()
    raw = {}
    for name, rows in (("raw_transactions", fixture(spark, d, "tx")), ("raw_users", _users(spark, d))):
        # users registered over years: only those of the newest months lie by day here
        rows = rows.where("ingested_at >= TIMESTAMP_NTZ '2023-11-01 00:00:00'").select("user_id", "ingested_at")
        zone = DailyTable(_fresh_folder(spark, name), "ingested_at")
        zone.replace_days(rows)
        raw[f"audit.{name}"] = zone.read(spark, rows.schema, first=since)
    return governance.freshness_check(raw, FRESH_AS_OF)


def zone_reload(spark, d):
    """A table by day, of which every other day is loaded again with other amounts."""
    rows = fixture(spark, d, "tx").select("transaction_id", "user_id", "amount", "ingested_at")
    zone = DailyTable(_fresh_folder(spark, "zone"), "ingested_at")
    zone.replace_days(rows)
    again = rows.where("day(ingested_at) % 2 = 0").withColumn("amount", (-F.col("amount")).cast("decimal(10,2)"))
    zone.replace_days(again)
    return zone.read(spark, rows.schema)


def schema_evolution(spark, d):
    """Three generations of files, in which columns were renamed, retyped, dropped and added."""
    tx = fixture(spark, d, "tx").where("user_id IS NOT NULL")
    table = EvolvingTable(_fresh_folder(spark, "evolving"))
    first = tx.where("user_id % 3 = 0").selectExpr(
        "transaction_id", "user_id", "CAST(amount AS STRING) AS value", "status AS note"
    )
    second = tx.where("user_id % 3 = 1").selectExpr("transaction_id", "user_id", "amount", "currency")
    third = tx.where("user_id % 3 = 2").selectExpr(
        "transaction_id", "CAST(user_id AS BIGINT) AS customer_id", "amount", "currency",
        "CASE WHEN amount > 50 THEN 'large' ELSE 'small' END AS size",
    )
    plans = [
        None,
        Plan(renamed={"value": "amount"}, added={"currency": "'USD'"}, dropped=["note"]),
        Plan(renamed={"user_id": "customer_id"}, added={"size": "CASE WHEN amount > 50 THEN 'large' ELSE 'small' END"}),
    ]
    for rows, plan in zip((first, second, third), plans):
        table.evolve(spark, rows.schema, plan)
        table.append(rows)
    return table.read(spark)


def column_lineage(spark, d):
    """Source columns of two models by their plans, with the number of values of each column."""
    with CL.tracing() as trace:
        stg = staging.stg_transactions(trace.source(fixture(spark, d, "tx"), "prod.raw_transactions"), AS_OF)
        models = {"stg_raw_transactions": stg, "user_metrics": intermediate.user_metrics(stg)}
        lines = [CL.as_rows(spark, name, trace.columns(df)) for name, df in models.items()]
    counts = []
    for name, df in models.items():
        row = df.agg(*[F.count(c).alias(c) for c in df.columns])
        entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in df.columns]
        counts.append(row.select(F.lit(name).alias("model"), F.inline(F.array(*entries))))
    found, filled = (reduce(DataFrame.unionByName, x) for x in (lines, counts))
    return found.join(filled, ["model", "column_name"])


def _lineage(spark, d):
    return governance.record_lineage(fixture(spark, d, "runs"), AS_OF)


def _advanced(spark, d) -> MetricState:
    """The state after three batches, one of them repeated, compacted in between."""
    state, stg = MetricState(_fresh_folder(spark, "metric-state")), _stg(spark, d)
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for k in (0, 1, 1):
        state.advance(stg.where(part == k), f"batch-{k}")
    state.compact(spark)
    state.advance(stg.where(part == 1), "batch-1")
    state.advance(stg.where(part == 2), "batch-2")
    return state


# --- encryption ------------------------------------------------------------

_SECRET = ["email", "ip_address"]


def _keys(spark, d):
    table = tables.SnapshotTable(_fresh_folder(spark, "keys"))
    return table, shredding.generate_keys(fixture(spark, d, "key_owners"), AS_OF, table)


def _people(spark, d):
    return fixture(spark, d, "users").select("user_id", *_SECRET)


def encrypt_users(spark, d):
    """Sealed and opened again; users without a key come back as rejects."""
    _, keys = _keys(spark, d)
    sealed, rejected = shredding.encrypt(_people(spark, d), keys, _SECRET)
    sealed = sealed.withColumn("sealed_differs", F.length("ip_address") > 28)
    opened = shredding.decrypt(sealed, keys, _SECRET).drop("key_version").withColumn(
        "reject_reason", F.lit(None).cast("string")
    )
    return opened.unionByName(rejected.withColumn("sealed_differs", F.lit(False)))


def _shredded(spark, d, table):
    requests = shredding.register_requests(fixture(spark, d, "requests"), AS_OF)
    return shredding.shred(table, requests, AS_OF)


def shred_requests(spark, d):
    after, _ = _shredded(spark, d, _keys(spark, d)[0])
    return after.select(
        "user_id", "is_active", F.col("encryption_key").isNull().alias("key_destroyed"),
        "key_version", "created_at", "revoked_at", "revoke_reason",
    )


def deletion_requests(spark, d):
    return _shredded(spark, d, _keys(spark, d)[0])[1]


def decrypt_after_shred(spark, d):
    table, keys = _keys(spark, d)
    sealed = stage(shredding.encrypt(_people(spark, d), keys, _SECRET)[0], "sealed")
    after, _ = _shredded(spark, d, table)
    return shredding.decrypt(sealed, after, _SECRET).drop("key_version")


def _rotated(spark, d):
    """Rows sealed with version 1; then every third user gets version 2, and some leave."""
    table, keys = _keys(spark, d)
    sealed = stage(shredding.encrypt(_people(spark, d), keys, _SECRET)[0], "sealed")
    due = fixture(spark, d, "users").where("user_id % 3 = 0").select("user_id")
    return table, sealed, shredding.rotate_keys(due, AS_OF, table)


def decrypt_old_version(spark, d):
    """After a rotation, rows open with the version that sealed them."""
    _, sealed, keys = _rotated(spark, d)
    return shredding.decrypt(sealed, keys, _SECRET)


def key_rotation(spark, d):
    """Rows sealed anew with the active version; older versions lose their bytes."""
    table, sealed, keys = _rotated(spark, d)
    moved = stage(shredding.reseal(sealed, keys, _SECRET), "resealed")
    after = shredding.drop_unused(table, moved)
    same = sealed.select("user_id", *[F.col(c).alias(f"old_{c}") for c in _SECRET])
    opened = shredding.decrypt(moved, after, _SECRET)
    kept = moved.select("user_id", *[F.col(c).alias(f"new_{c}") for c in _SECRET])
    left = after.where("encryption_key IS NOT NULL").groupBy("user_id").agg(
        F.count("*").alias("keys_left"), F.max("key_version").alias("newest_version")
    )
    joined = opened.join(same, "user_id").join(kept, "user_id").join(left, "user_id")
    return joined.select(
        "user_id", *_SECRET, "key_version", "newest_version", "keys_left",
        (F.col("new_ip_address") == F.col("old_ip_address")).alias("untouched"),
    )


def keys_second_batch(spark, d):
    """Keys of three batches of users, who overlap, one of whom had left in between."""
    table = tables.SnapshotTable(_fresh_folder(spark, "keys"))
    people = fixture(spark, d, "users").select("user_id")
    first = shredding.generate_keys(people.where("user_id % 4 < 2"), AS_OF, table)
    marked = stage(first.select("user_id", "key_version", F.sha2("encryption_key", 256).alias("mark")), "marks")
    gone = people.where("user_id % 8 = 0").selectExpr(
        "user_id", "CAST(user_id AS STRING) AS request_id", "'left' AS reason"
    )
    shredding.shred(table, shredding.register_requests(gone, AS_OF), AS_OF)
    keys = shredding.generate_keys(people.where("user_id % 4 < 3"), FRESH_AS_OF, table)
    return keys.join(marked, ["user_id", "key_version"], "left").select(
        "user_id", "key_version", "is_active", "created_at", "revoke_reason",
        F.col("encryption_key").isNotNull().alias("has_key"),
        (F.sha2("encryption_key", 256) == F.col("mark")).alias("same_key"),
    )


def deletion_status(spark, d):
    after, done = _shredded(spark, d, _keys(spark, d)[0])
    return shredding.deletion_status(_people(spark, d), after, done)


# --- scalars ---------------------------------------------------------------


def _mask(column: str, mask) -> Query:
    return lambda spark, d: _users(spark, d).select("user_id", mask(F.col(column)).alias("masked"))


def pseudonymize_md5(spark, d):
    return fixture(spark, d, "tx").select(
        "transaction_id", M.pseudonym_md5(F.col("user_id"), SALT).alias("pseudonym")
    )


def pseudonymize_sha(spark, d):
    return _users(spark, d).select(
        "user_id",
        M.pseudonym_sha(F.col("user_id"), SALT).alias("user_pseudonym"),
        M.pseudonym_sha(F.col("email"), SALT).alias("email_pseudonym"),
        M.pseudonym_sha(F.col("ip_address"), SALT).alias("ip_pseudonym"),
    )


QUERIES: dict[str, Query] = {
    # landing
    "land_pages": land_pages,
    "paged_source": paged_source,
    "page_gap_report": page_gap_report,
    "reject_split": reject_split,
    "corrupt_pages": corrupt_pages,
    "extraction_metrics": extraction_metrics,
    # publish
    "publish_tx_clean": publish_tx_clean,
    "publish_users_clean": publish_users_clean,
    "publish_tx_masked": publish_tx_masked,
    "publish_tx_dedup": publish_tx_dedup,
    "publish_tx_new": publish_tx_new,
    "publish_metrics": publish_metrics,
    "publish_transactions": publish_transactions,
    "publish_tx_indexed": publish_tx_indexed,
    "publish_committed": publish_committed,
    "publish_users": publish_users,
    # expectations
    **{name: _one(t, kind, **kw) for name, (t, kind, kw) in SINGLE_CHECKS.items()},
    **{name: _suite(t, suite) for name, (t, suite) in SUITE_RUNS.items()},
    "dq_suite_with_errors": _suite("dirty", BROKEN),
    "dq_suite_empty": dq_suite_empty,
    "dq_combined_log": dq_combined_log,
    "dq_combined_log_observed": dq_combined_log_observed,
    "null_profile_users": null_profile_users,
    "null_profile_tx": null_profile_tx,
    # model tests
    "test_unique": _model_tests("unique"),
    "test_not_null": _model_tests("not_null"),
    "test_accepted_values": _model_tests("accepted_values"),
    "test_accepted_range": _model_tests("accepted_range"),
    # staging
    "stg_transactions": _stg,
    "stg_transactions_minimal": lambda s, d: staging.stg_transactions_minimal(fixture(s, d, "tx")),
    "stg_users": _stg_users,
    "stg_masked_transactions": lambda s, d: staging.stg_masked_transactions(_stg(s, d)),
    "stg_masked_users": lambda s, d: staging.stg_masked_users(_stg_users(s, d), strict=False),
    # aggregations and windows
    "user_metrics": user_metrics,
    "user_metrics_advanced": lambda s, d: _advanced(s, d).user_metrics(s).withColumn(
        "stddev_transaction_amount", F.round("stddev_transaction_amount", 6)
    ),
    "category_metrics_advanced": lambda s, d: _advanced(s, d).category_metrics(s),
    "daily_metrics_advanced": lambda s, d: _advanced(s, d).daily_metrics(s),
    "category_metrics": lambda s, d: intermediate.category_metrics(_stg(s, d)),
    "daily_metrics": lambda s, d: intermediate.daily_metrics(_stg(s, d)),
    "user_activity": lambda s, d: intermediate.user_activity(_stg(s, d)),
    "status_counts": lambda s, d: intermediate.status_counts(_stg(s, d)),
    "rfm_base": lambda s, d: intermediate.spending_base(fixture(s, d, "tx")),
    "user_value_quartile": user_value_quartile,
    "user_frequency_quartile": user_frequency_quartile,
    "daily_moving_avg": daily_moving_avg,
    "median_sketch_rank": median_sketch_rank,
    "txn_seq": lambda s, d: intermediate.transaction_sequence(
        fixture(s, d, "tx"), fixture(s, d, "users")
    ),
    # intermediate and marts
    "int_transactions": _int_transactions,
    "int_users": _int_users,
    "dim_users": _dim_users,
    "fct_transactions": _fct_transactions,
    "fct_users": _fct_users,
    "analytics_transactions": lambda s, d: marts.analytics_transactions(
        _fct_transactions(s, d), SALT
    ),
    "analytics_users": lambda s, d: marts.analytics_users(_fct_users(s, d), SALT),
    "segment_rollup": lambda s, d: marts.segment_rollup(_dim_users(s, d)),
    "simple_segments": lambda s, d: marts.simple_segments(
        fixture(s, d, "users"), intermediate.spending_base(fixture(s, d, "tx"))
    ),
    # masks, pseudonyms and views
    "mask_rules": lambda s, d: M.apply_rules(_users(s, d), M.DEFAULT_RULES, strict=False).select(
        "user_id", "email", "ip_address"
    ),
    "mask_rules_transactions": lambda s, d: M.apply_transaction_rules(
        fixture(s, d, "tx"), M.DEFAULT_RULES, strict=False
    ).select("transaction_id", "user_id", "amount"),
    "mask_email": _mask("email", lambda c: M.mask_email(c, strict=False)),
    "mask_id": lambda s, d: fixture(s, d, "tx").select(
        "transaction_id",
        M.mask_id(F.col("transaction_id")).alias("masked"),
        M.mask_id(F.col("user_id")).alias("masked_user"),
        M.mask_id(F.col("user_id") + 1_000_000_000).alias("masked_long_user"),
    ),
    "mask_name": _mask("first_name", M.mask_name),
    "mask_ip": _mask("ip_address", M.mask_ip),
    "pseudonymize_sha": pseudonymize_sha,
    "pseudonymize_md5": pseudonymize_md5,
    "v_dev_transactions": lambda s, d: views.dev_transactions(fixture(s, d, "dirty")),
    "v_dev_users": lambda s, d: views.dev_users(fixture(s, d, "users")),
    "v_prod_users": lambda s, d: views.prod_users(fixture(s, d, "users")),
    "v_prod_transactions": lambda s, d: views.prod_transactions(fixture(s, d, "tx")),
    "v_analytics_tx": lambda s, d: views.analyst_transactions(fixture(s, d, "tx"), SALT),
    "v_analytics_users": lambda s, d: views.analyst_users(fixture(s, d, "users"), SALT),
    # encryption
    "encrypt_users": encrypt_users,
    "shred_requests": shred_requests,
    "deletion_requests": deletion_requests,
    "deletion_status": deletion_status,
    "decrypt_after_shred": decrypt_after_shred,
    "decrypt_old_version": decrypt_old_version,
    "key_rotation": key_rotation,
    "keys_second_batch": keys_second_batch,
    # governance
    "quality_dashboard": lambda s, d: governance.quality_dashboard(fixture(s, d, "dirty")),
    "freshness_dashboard": lambda s, d: governance.freshness_dashboard(
        fixture(s, d, "monitor"), FRESH_AS_OF
    ),
    "freshness_check": freshness_check,
    "freshness_partitioned": freshness_partitioned,
    "zone_reload": zone_reload,
    "schema_evolution": schema_evolution,
    "email_completeness": lambda s, d: governance.email_completeness(fixture(s, d, "users")),
    "column_profile": lambda s, d: governance.column_profile(
        fixture(s, d, "dirty"), "transaction_id", "ingested_at"
    ),
    "hash_shape": lambda s, d: governance.hash_shape(
        pseudonymize_sha(s, d), "user_id", "email_pseudonym"
    ),
    "latest_validation_logs": lambda s, d: governance.latest_logs(fixture(s, d, "logs"), "click"),
    "latest_snapshot": lambda s, d: governance.latest_snapshot(fixture(s, d, "schema_log")),
    "schema_drift": schema_drift,
    "schema_history_append": lambda s, d: governance.schema_check(
        fixture(s, d, "schema_checks"), fixture(s, d, "schema_columns"), AS_OF
    ),
    "lineage_record": _lineage,
    "column_lineage": column_lineage,
    "lineage_view": lambda s, d: governance.lineage_view(_lineage(s, d)),
    "pii_catalog_upsert": _catalog,
    "pii_catalog": lambda s, d: governance.pii_view(_catalog(s, d)),
}
