"""The daily run: land, check freshness, audit, publish, build models, record lineage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.masking import DEFAULT_RULES, session_salt
from ..operators import modeltests, quality
from ..runtime import stage, staged_run
from ..schemas import RecordField
from ..sources import pages, tables
from ..sources.committed import CommittedTable
from . import governance, intermediate, marts, publish, staging, suites, views


@dataclass(frozen=True)
class Config:
    root: str
    transaction_pages: str
    user_pages: str
    salt: str | None = None
    rules: dict = field(default_factory=lambda: DEFAULT_RULES)
    strict_masks: bool = True
    run_model_tests: bool = True
    # keep the published tables bucketed in this database instead of in folders
    database: str | None = None
    buckets: int = 256
    # or as committed tables: a run's rows appear in one step, and an index of the keys,
    # in as many buckets, spares reading all that was published before
    committed: bool = False

    def published(
        self, entity: publish.Entity
    ) -> tables.FolderTable | tables.BucketedTable | CommittedTable:
        if self.committed:
            path = tables.folder(self.root, "prod", entity.table)
            return CommittedTable(path, entity.published_key, self.buckets)
        if self.database:
            name = f"{self.database}.prod_{entity.table}"
            return tables.BucketedTable(name, entity.published_key, self.buckets)
        return tables.FolderTable(tables.folder(self.root, "prod", entity.table))


class AuditBlocked(RuntimeError):
    """A critical suite failed; nothing of this table is published."""


def land(
    spark: SparkSession, source: str, target: str, fields: list[RecordField], key: str,
    as_of: datetime, watch: Callable[[DataFrame], quality.Watched] | None = None,
) -> tuple[dict[str, int], quality.Watched | None]:
    """Replace the raw table with the accepted records of the landed pages.

    The pages are staged as read, so that their JSON is parsed once. `watch` takes the
    audit's numbers while the records are written.
    """
    landed = stage(pages.read_pages(spark, source, fields), "pages")
    rows = pages.checked(pages.records(landed), fields)
    good = pages.with_ingest_columns(pages.accepted(rows, fields, key), as_of, source)
    watched = watch(good) if watch else None
    tables.replace(watched.rows if watched else good, target)
    tables.replace(pages.rejects(landed, rows), f"{target}_rejected")
    if watched:
        inserted = watched.counted()["total"]
    else:
        inserted = spark.read.schema(good.schema).parquet(target).count()
    return pages.extraction_metrics(landed, rows, inserted), watched


# Columns whose NULLs stop an audit before its suites run.
HARD_NULLS = {
    "raw_transactions": {"user_id": "null_users", "transaction_id": "null_ids"},
    "raw_users": {
        "user_id": "null_ids",
        "first_name": "null_first_name",
        "ip_address": "null_ips",
    },
}


def audit(
    raw: DataFrame,
    table: str,
    critical: quality.Suite,
    warning: quality.Suite,
    log_path: str,
    as_of: datetime,
    watched: quality.Watched | None = None,
) -> dict:
    """Run both suites, append the log line, and raise if the critical suite failed.

    With the numbers `watched` while `raw` was written, it is read only for uniqueness.
    """
    if watched:
        nulls = watched.null_counts()
    else:
        nulls = quality.null_profile(raw, HARD_NULLS[table]).first().asDict()
    found = {k: v for k, v in nulls.items() if k != "total" and v}
    if found:
        raise AuditBlocked(f"{table}: {found}")
    lines = watched.lines(raw) if watched else quality.run_audit(raw, critical, warning)
    line = quality.audit_log(lines, f"audit.{table}", critical.name)
    result = line.first().asDict()
    columns = [f.name for f in schemas.VALIDATION_LOG.fields]
    row = {**result, "validation_timestamp": as_of}
    tables.append(
        raw.sparkSession.createDataFrame([tuple(row[c] for c in columns)], schemas.VALIDATION_LOG),
        log_path,
    )
    if result["blocking_triggered"]:
        raise AuditBlocked("; ".join(result["failures"]))
    return {
        "audit_passed": True,
        "total_expectations": result["n_expectations"],
        "total_failed": result["n_failed"],
        "success_rate": float(result["success_rate"]),
        "warnings": list(result["failures"]),
    }


def build_models(
    transactions: DataFrame,
    users: DataFrame,
    as_of: datetime,
    salt: str,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> dict[str, DataFrame]:
    """All models over the two published tables, by name.

    `keep` writes the two enriched models for their readers and gives them back.
    """
    stg_tx = staging.stg_transactions(transactions, as_of)
    stg_users = staging.stg_users(users, as_of)
    by_day = stage(intermediate.day_cells(stg_tx), "day-cells")
    metrics = intermediate.transaction_metrics(stg_tx, by_day)
    enriched = keep(intermediate.int_transactions(stg_tx, metrics), "int_transactions_enriched")
    activity = intermediate.activity_base(by_day)
    int_users = keep(intermediate.int_users(stg_users, activity, as_of), "int_users_enriched")
    facts, fct_users = marts.fct_transactions(enriched), marts.fct_users(int_users)
    return {
        "stg_raw_transactions": stg_tx,
        "stg_raw_users": stg_users,
        "stg_masked_transactions": staging.stg_masked_transactions(stg_tx),
        "int_transactions_enriched": enriched,
        "int_users_enriched": int_users,
        "fct_transactions": facts,
        "dim_users": marts.dim_users(int_users, as_of),
        "fct_users": fct_users,
        "analytics_transactions": marts.analytics_transactions(facts, salt),
        "analytics_users": marts.analytics_users(fct_users, salt),
    }


def watch_schemas(
    spark: SparkSession, root: str, stored: dict[tuple[str, str], DataFrame], as_of: datetime
) -> DataFrame:
    """Compare tables with their last snapshot, log a line for each, and add the new snapshots.

    `stored` has the frames by schema and table name; only their columns matter.
    """
    history_path = tables.folder(root, "audit", "schema_history")
    history = tables.read_table(spark, history_path, schemas.SCHEMA_HISTORY)
    snapshots = [
        governance.schema_snapshot(spark, schema, table, df, as_of)
        for (schema, table), df in stored.items()
    ]
    current = reduce(DataFrame.unionByName, snapshots)
    checks = stage(governance.schema_check(history, current, as_of), "schema-checks")
    tables.append(checks, tables.folder(root, "audit", "schema_checks"))
    tables.append(current, history_path)
    return checks


INTERMEDIATE_MODELS = ("int_transactions_enriched", "int_users_enriched")
TABLE_MODELS = ("fct_transactions", "dim_users", "fct_users")


def write_models(models: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Materialise the table models and return the models with those read back.

    The facts are clustered by time for later pruning.
    """
    written = {}
    for name in TABLE_MODELS:
        df = models[name]
        if "transaction_date" in df.columns:
            df = df.repartitionByRange("transaction_date", "transaction_id").sortWithinPartitions(
                "transaction_date"
            )
        written[name] = _stored(df, tables.folder(root, "analytics", name))
    return {**models, **written}


def _stored(df: DataFrame, path: str) -> DataFrame:
    tables.replace(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_views(spark: SparkSession, cfg: Config, as_of: datetime) -> dict[str, DataFrame]:
    """What readers see of the last run, by name: models, role views and dashboards.

    Frames over the stored tables, in any session and at any time; none of the views is a copy
    of its rows. Models are left out as long as no run has built them.
    """
    salt = cfg.salt or session_salt(spark)
    at = lambda zone, table: tables.folder(cfg.root, zone, table)
    raw_tx = tables.read_table(spark, at("audit", publish.TRANSACTIONS.table), schemas.RAW_TRANSACTIONS)
    raw_users = tables.read_table(spark, at("audit", publish.USERS.table), schemas.RAW_USERS)
    transactions, users = (
        cfg.published(e).read(spark, e.schema) for e in (publish.TRANSACTIONS, publish.USERS)
    )
    stg_tx = staging.stg_transactions(transactions, as_of)
    # masks are put on raw values: those of masked ones would show other characters
    unmasked = staging.stg_users(publish.score(raw_users, as_of), as_of)
    found = {
        "stg_raw_transactions": stg_tx,
        "stg_raw_users": staging.stg_users(users, as_of),
        "stg_masked_transactions": staging.stg_masked_transactions(stg_tx),
        "stg_masked_users": staging.stg_masked_users(unmasked, cfg.strict_masks),
        "v_dev_transactions": views.dev_transactions(raw_tx),
        "v_dev_users": views.dev_users(raw_users),
        "v_prod_transactions": views.prod_transactions(transactions),
        "v_prod_users": views.prod_users(users),
        "v_analytics_tx": views.analyst_transactions(transactions, salt),
        "v_analytics_users": views.analyst_users(users, salt),
        "quality_dashboard": governance.quality_dashboard(raw_tx),
    }
    names = [("intermediate", n) for n in INTERMEDIATE_MODELS] + [("analytics", n) for n in TABLE_MODELS]
    for zone, name in names:
        if tables.exists(spark, at(zone, name)):
            found[name] = spark.read.parquet(at(zone, name))
    if "fct_transactions" in found:
        found["analytics_transactions"] = marts.analytics_transactions(found["fct_transactions"], salt)
    if "fct_users" in found:
        found["analytics_users"] = marts.analytics_users(found["fct_users"], salt)
    monitor = at("audit", "data_freshness_monitor")
    if tables.exists(spark, monitor):
        found["freshness_dashboard"] = governance.freshness_dashboard(spark.read.parquet(monitor), as_of)
    return found


def register_views(spark: SparkSession, cfg: Config, as_of: datetime) -> list[str]:
    """Make `stored_views` available to the session's SQL; returns their names."""
    found = stored_views(spark, cfg, as_of)
    for name, df in found.items():
        df.createOrReplaceTempView(name)
    return sorted(found)


def metric_rows(spark: SparkSession, metrics: dict[str, dict], as_of: datetime) -> DataFrame:
    """Numbers of the run's tasks as lines of the metrics table."""
    rows = [
        (as_of, task, name, float(value))
        for task, values in metrics.items()
        for name, value in values.items()
        if isinstance(value, (int, float)) and not isinstance(value, bool)
    ]
    return spark.createDataFrame(rows, schemas.PIPELINE_METRICS)


def run_pipeline(spark: SparkSession, cfg: Config, as_of: datetime, run_id: str) -> dict:
    """One daily run. Models are built only if both audits passed; lineage is always recorded."""
    result: dict = {"run_id": run_id, "metrics": {}, "blocked": {}}
    try:
        with staged_run(spark):
            _run_phases(spark, cfg, as_of, result)
        result["status"] = "blocked" if result["blocked"] else "completed"
    finally:
        run = spark.range(1).select(F.lit(run_id).alias("dag_execution_id"))
        lineage = governance.record_lineage(run, as_of)
        tables.append(lineage, tables.folder(cfg.root, "audit", "data_lineage"))
        if result["metrics"]:
            tables.append(
                metric_rows(spark, result["metrics"], as_of),
                tables.folder(cfg.root, "audit", "pipeline_metrics"),
            )
    return result


def _run_phases(spark: SparkSession, cfg: Config, as_of: datetime, result: dict) -> None:
    salt = cfg.salt or session_salt(spark)
    metrics = result["metrics"]
    at = lambda zone, table: tables.folder(cfg.root, zone, table)
    transactions, users = publish.TRANSACTIONS, publish.USERS
    both_suites = {
        e: [suites.suite(f"{e.table.removeprefix('raw_')}_{tier}_suite") for tier in ("critical", "warnings")]
        for e in (transactions, users)
    }
    watched = {}
    for entity, source, fields in (
        (transactions, cfg.transaction_pages, schemas.TRANSACTION_FIELDS),
        (users, cfg.user_pages, schemas.USER_FIELDS),
    ):
        metrics[f"land_{entity.table.removeprefix('raw_')}"], watched[entity] = land(
            spark, source, at("audit", entity.table), fields, entity.key, as_of,
            lambda df, e=entity: quality.Watched(df, *both_suites[e], HARD_NULLS[e.table]),
        )
    raw = {
        transactions: tables.read_table(spark, at("audit", transactions.table), schemas.RAW_TRANSACTIONS),
        users: tables.read_table(spark, at("audit", users.table), schemas.RAW_USERS),
    }
    checks = governance.freshness_check({f"audit.{e.table}": df for e, df in raw.items()}, as_of)
    tables.append(checks, at("audit", "data_freshness_monitor"))

    for entity, df in raw.items():
        side = entity.table.removeprefix("raw_")
        try:
            outcome = audit(
                df, entity.table,
                *both_suites[entity], at("audit", "gx_validation_logs"), as_of, watched[entity],
            )
        except AuditBlocked as e:
            result["blocked"][entity.table] = str(e)
            continue
        metrics[f"audit_{side}"] = outcome
        metrics[f"publish_{side}"] = publish.publish(
            spark, entity, df, cfg.published(entity), outcome, as_of, salt,
            cfg.rules, cfg.strict_masks, result["run_id"],
            metrics[f"land_{side}"]["records_inserted"],
        )
    stored = {("audit", e.table): spark.read.parquet(at("audit", e.table)) for e in raw}
    for entity in raw:
        prod = cfg.published(entity).as_stored(spark)
        if prod is not None:
            stored["prod", entity.table] = prod
    checks = watch_schemas(spark, cfg.root, stored, as_of)
    drifted = checks.where("drift_detected").select("schema_name", "table_name").collect()
    result["schema_drift"] = sorted(".".join(r) for r in drifted)
    if result["blocked"]:
        return
    published = [cfg.published(entity).read(spark, entity.schema) for entity in raw]
    models = build_models(
        *published, as_of, salt, lambda df, name: _stored(df, at("intermediate", name))
    )
    models = write_models(models, cfg.root)
    if cfg.run_model_tests:
        result["model_tests"] = _model_test_failures(models, *published)


def _model_test_failures(models: dict, transactions: DataFrame, users: DataFrame) -> list[dict]:
    """Declared tests that fail. Ids are masked by now, so uniqueness is asked of the hashed key."""
    tested = {
        **models, "prod.raw_transactions": transactions, "prod.raw_users": users,
    }
    tests = [
        modeltests.ModelTest(t.model, "transaction_key", t.kind)
        if (t.kind, t.column) == ("unique", "transaction_id")
        else t
        for t in modeltests.DECLARED
    ]
    names = {t.model for t in tests}
    lines = modeltests.run_tests({n: d for n, d in tested.items() if n in names}, tests)
    return [r.asDict() for r in lines.where(~F.col("passed")).collect()]

