"""Freshness, quality dashboards, schema drift, lineage and the PII catalogue."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.scalars import moment
from ..operators.skew import latest_per_key
from ..schemas import LINEAGE, PII_CATALOG, SCHEMA_HISTORY

THRESHOLD_MINUTES = 120


def seconds_since(then: Column, as_of: datetime) -> Column:
    """Elapsed seconds between two timestamps without time zone."""
    return (moment(as_of) - then).cast("interval second").cast("decimal(18,6)")


# --- quality and freshness -------------------------------------------------


def quality_dashboard(raw: DataFrame) -> DataFrame:
    """Row counts and share of good amounts per day of arrival. Column names are fixed values."""
    n = F.count(F.lit(1))
    good = F.count_if(F.col("amount") >= 0)
    return (
        raw.groupBy(F.to_date("ingested_at").alias("fecha"))
        .agg(
            n.alias("total_registros"),
            F.count_if(F.col("amount") < 0).alias("registros_monto_negativo"),
            F.count_if(F.col("amount").isNull()).alias("registros_monto_nulo"),
            F.count_if(F.col("user_id").isNull()).alias("registros_user_nulo"),
            F.round((good * 100).cast("double") / n, 2).alias("porcentaje_calidad"),
        )
        .orderBy(F.col("fecha").desc_nulls_first())
    )


def freshness_dashboard(monitor: DataFrame, as_of: datetime) -> DataFrame:
    age = seconds_since(F.col("last_data_arrival"), as_of)
    return (
        monitor.groupBy("table_name")
        .agg(F.max("actual_arrival_time").alias("last_data_arrival"))
        .withColumns(
            {
                "minutes_since_last_update": F.round(age.cast("double") / 60, 4),
                "freshness_status": L.freshness(age),
            }
        )
    )


def freshness_check(tables: dict[str, DataFrame], as_of: datetime) -> DataFrame:
    """One line per table: the newest arrival of the last 24 hours, its lag and its status."""
    since = moment(as_of - timedelta(hours=24))
    newest = [
        df.where(F.col("ingested_at") >= since)
        .agg(F.max("ingested_at").alias("actual_arrival_time"))
        .select(F.lit(name).alias("table_name"), "actual_arrival_time")
        for name, df in tables.items()
    ]
    age = seconds_since(F.col("actual_arrival_time"), as_of)
    return reduce(DataFrame.unionByName, newest).select(
        "table_name",
        moment(as_of - timedelta(hours=2)).alias("expected_arrival_time"),
        "actual_arrival_time",
        F.round(age.cast("double") / 3600, 2).alias("lag_hours"),
        L.freshness(age).alias("status"),
        moment(as_of).alias("check_timestamp"),
        F.lit(THRESHOLD_MINUTES).alias("threshold_minutes"),
    )


def email_completeness(users: DataFrame) -> DataFrame:
    n, missing = F.count(F.lit(1)), F.count_if(F.col("email").isNull())
    return users.agg(
        n.alias("total_users"),
        missing.alias("null_emails"),
        F.round((missing * 100).cast("double") / F.nullif(n, F.lit(0)), 2).alias("null_pct"),
    )


def column_profile(df: DataFrame, id_column: str, time_column: str) -> DataFrame:
    """Rows, share of NULL ids, share of distinct ids, earliest and latest record.

    Counted per id first, so that copies combine before the shuffle.
    """
    groups = df.groupBy(F.col(id_column).alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(time_column).alias("low"),
        F.max(time_column).alias("high"),
    )
    total = F.sum("n")
    is_null = F.col("id").isNull()
    share = lambda part: F.round(part.cast("double") / F.nullif(total, F.lit(0)), 6)
    return groups.agg(
        total.alias("total_rows"),
        share(F.coalesce(F.sum(F.when(is_null, F.col("n"))), F.lit(0))).alias("null_rate"),
        share(F.count_if(~is_null)).alias("uniqueness_rate"),
        F.min("low").alias("earliest_record"),
        F.max("high").alias("latest_record"),
    )


def latest_logs(logs: DataFrame, table: str, n: int = 5) -> DataFrame:
    """The last `n` validation results of a table."""
    return (
        logs.where(F.col("table_name") == table)
        .orderBy(F.col("validation_timestamp").desc(), F.col("success_rate").desc())
        .limit(n)
    )


def hash_shape(df: DataFrame, key: str, column: str, prefix: str = "a") -> DataFrame:
    """Whether a hashed column starts with `prefix`, and how long it is."""
    return df.select(
        key,
        F.col(column).startswith(prefix).alias("is_hashed_email"),
        F.length(column).alias("hash_length"),
    )


# --- schema drift ----------------------------------------------------------

TABLE_KEY = ["schema_name", "table_name"]


def schema_snapshot(
    spark: SparkSession, schema_name: str, table_name: str, df: DataFrame, as_of: datetime
) -> DataFrame:
    """The columns of `df` as lines of the schema history."""
    rows = [
        (schema_name, table_name, f.name, f.dataType.simpleString(), f.nullable, as_of)
        for f in df.schema.fields
    ]
    return spark.createDataFrame(rows, SCHEMA_HISTORY)


def latest_snapshot(history: DataFrame) -> DataFrame:
    """The lines of each table's last check."""
    last = history.groupBy(*TABLE_KEY).agg(F.max("check_timestamp").alias("check_timestamp"))
    return history.join(last, [*TABLE_KEY, "check_timestamp"], "left_semi").select(history.columns)


def schema_drift(previous: DataFrame, current: DataFrame) -> DataFrame:
    """New and removed columns and changed types against each table's previous snapshot.

    A table without a previous snapshot has no drift. Nullability is not compared.
    """
    key = [*TABLE_KEY, "column_name"]
    old_type, new_type = F.col("old_type"), F.col("new_type")
    both = previous.select(*key, F.col("type").alias("old_type")).join(
        current.select(*key, F.col("type").alias("new_type")), key, "full_outer"
    )
    change = (
        F.when(old_type.isNull(), F.lit("new_column"))
        .when(new_type.isNull(), F.lit("removed_column"))
        .when(old_type != new_type, F.lit("type_change"))
    )
    changes = both.withColumn("change", change).where(F.col("change").isNotNull())
    known = previous.select(*TABLE_KEY).distinct()
    added = changes.where("change = 'new_column'").join(known, TABLE_KEY, "left_semi")
    return changes.where("change <> 'new_column'").unionByName(added)


def schema_check(history: DataFrame, current: DataFrame, as_of: datetime) -> DataFrame:
    """One line per table of `current`: its columns, whether they drifted, and how.

    Both frames hold lines of the schema history; tables are compared with their latest
    snapshot. The first check of a table finds no drift.
    """
    tables = current.select(*TABLE_KEY).distinct()
    previous = latest_snapshot(history).join(tables, TABLE_KEY, "left_semi")
    column = F.col("column_name")
    named = lambda change: F.sort_array(
        F.collect_list(F.when(F.col("change") == change, column))
    )
    retyped = F.struct(column.alias("column"), F.col("old_type").alias("old"), F.col("new_type").alias("new"))
    changes = F.struct(
        named("new_column").alias("new_columns"),
        named("removed_column").alias("removed_columns"),
        F.sort_array(F.collect_list(F.when(F.col("change") == "type_change", retyped))).alias("type_changes"),
    )
    drift = schema_drift(previous, current).groupBy(*TABLE_KEY).agg(F.to_json(changes).alias("changes"))
    entries = F.sort_array(F.collect_list(F.struct("column_name", F.struct("type", "nullable"))))
    columns = current.groupBy(*TABLE_KEY).agg(F.to_json(F.map_from_entries(entries)).alias("schema_json"))
    none = '{"new_columns":[],"removed_columns":[],"type_changes":[]}'
    return columns.join(drift, TABLE_KEY, "left").select(
        *TABLE_KEY,
        "schema_json",
        F.col("changes").isNotNull().alias("drift_detected"),
        F.coalesce("changes", F.lit(none)).alias("changes_json"),
        moment(as_of).alias("check_timestamp"),
    )


# --- lineage ---------------------------------------------------------------

# Name, kind, schema and table of each node of the pipeline, and what it is.
NODES = [
    ("API Transacciones", "source", None, None, "transactions as delivered"),
    ("audit.raw_transactions", "table", "audit", "raw_transactions", "accepted records of the pages"),
    ("prod.raw_transactions", "table", "prod", "raw_transactions", "audited, cleaned and masked"),
    ("stg_raw_transactions", "model", "staging", "stg_raw_transactions", "staged transactions"),
    ("int_transactions_enriched", "model", "intermediate", "int_transactions_enriched", "transactions with metrics"),
    ("fct_transactions", "model", "analytics", "fct_transactions", "transaction facts"),
    ("dim_users", "model", "analytics", "dim_users", "user dimension"),
    ("API Usuarios", "source", None, None, "users as delivered"),
    ("audit.raw_users", "table", "audit", "raw_users", "accepted records of the pages"),
    ("prod.raw_users", "table", "prod", "raw_users", "audited, cleaned and masked"),
    ("stg_raw_users", "model", "staging", "stg_raw_users", "staged users"),
    ("int_users_enriched", "model", "intermediate", "int_users_enriched", "users with activity"),
    ("fct_users", "model", "analytics", "fct_users", "user facts"),
]
# From, to, and what happens in between.
EDGES = [
    ("API Transacciones", "audit.raw_transactions", "land pages"),
    ("audit.raw_transactions", "prod.raw_transactions", "publish completed, positive amounts"),
    ("prod.raw_transactions", "stg_raw_transactions", "normalise types"),
    ("stg_raw_transactions", "int_transactions_enriched", "add metrics"),
    ("int_transactions_enriched", "fct_transactions", "keep score of 0.7 and more"),
    ("int_users_enriched", "dim_users", "segment users"),
    ("API Usuarios", "audit.raw_users", "land pages"),
    ("audit.raw_users", "prod.raw_users", "publish with masked e-mail and address"),
    ("prod.raw_users", "stg_raw_users", "normalise types"),
    ("stg_raw_users", "int_users_enriched", "add activity"),
    ("int_users_enriched", "fct_users", "keep trusted and acceptable"),
]


def node_id(name: str) -> str:
    """Nodes with a table are known as schema.table, the others by name."""
    schema, table = next((s, t) for n, _, s, t, _ in NODES if n == name)
    return f"{schema}.{table}" if schema and table else name


def lineage_rows() -> list[dict]:
    """The declared graph as partial lineage lines."""
    nodes = [
        dict(
            lineage_type="node", node_id=node_id(name), node_name=name, node_type=kind,
            schema_name=schema, table_name=table, description=text,
        )
        for name, kind, schema, table, text in NODES
    ]
    edges = [
        dict(lineage_type="edge", source_id=node_id(a), target_id=node_id(b), transformation=t)
        for a, b, t in EDGES
    ]
    return nodes + edges


def record_lineage(executions: DataFrame, as_of: datetime) -> DataFrame:
    """The declared graph once per `dag_execution_id` of `executions`."""
    names = [
        f.name for f in LINEAGE.fields if f.name not in ("dag_execution_id", "created_at")
    ]
    lines = [
        F.struct(*[F.lit(row.get(n)).cast("string").alias(n) for n in names])
        for row in lineage_rows()
    ]
    return executions.select("dag_execution_id", F.inline(F.array(*lines))).select(
        *names, "dag_execution_id", moment(as_of).alias("created_at")
    )


def lineage_view(log: DataFrame) -> DataFrame:
    """Edges with the names and kinds of both ends, matched within an execution.

    The lines of a log may be made of far fewer rows, which is the size Spark goes by, so
    both ends are joined by shuffle.
    """
    run = "dag_execution_id"
    nodes = log.where(F.col("lineage_type") == "node")
    end = lambda role: nodes.select(
        run,
        F.col("node_id").alias(f"{role}_id"),
        F.col("node_name").alias(role),
        F.col("node_type").alias(f"{role}_type"),
    ).hint("merge")
    edges = log.where(F.col("lineage_type") == "edge").select(
        run, "source_id", "target_id", "transformation"
    )
    return (
        edges.join(end("source"), [run, "source_id"])
        .join(end("target"), [run, "target_id"])
        .select(run, "source", "transformation", "target", "source_type", "target_type")
    )


# --- PII catalogue ---------------------------------------------------------

# Protected columns and how they are protected.
PII_SEED = [
    ("audit", "raw_transactions", "user_id", "direct_identifier", "high", "hash_salting", "production_only", 365, "Consentimiento del usuario - LDPD Art. 8"),
    ("prod", "raw_transactions", "user_id", "direct_identifier", "high", "hash_salting", "production_only", 365, "Consentimiento del usuario - LDPD Art. 8"),
    ("staging", "stg_raw_transactions", "user_id", "direct_identifier", "high", "hash_salting", "production_only", 365, "Consentimiento del usuario - LDPD Art. 8"),
    ("audit", "raw_users", "email", "contact_information", "high", "hash_sha256", "restricted", 180, "LDPD Art. 12 - Consentimiento"),
    ("audit", "raw_users", "ip_address", "device_identifier", "medium", "hash_sha256", "restricted", 90, "LDPD Art. 12 - Auditoría de seguridad"),
    ("prod", "raw_users", "email", "contact_information", "high", "hash_sha256", "restricted", 180, "LDPD Art. 12 - Consentimiento"),
    ("prod", "raw_users", "ip_address", "device_identifier", "medium", "hash_sha256", "restricted", 90, "LDPD Art. 12 - Auditoría de seguridad"),
    ("staging", "stg_raw_users", "email", "contact_information", "high", "hash_sha256", "restricted", 180, "LDPD Art. 12 - Consentimiento"),
    ("staging", "stg_raw_users", "ip_address", "device_identifier", "medium", "hash_sha256", "restricted", 90, "LDPD Art. 12 - Auditoría de seguridad"),
]
PII_KEY = ["schema_name", "table_name", "column_name"]

def pii_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PII_SEED, PII_CATALOG)


def pii_upsert(catalog: DataFrame, incoming: DataFrame) -> DataFrame:
    """The catalogue with those lines of `incoming` whose column it does not list yet."""
    new = latest_per_key(incoming, PII_KEY, []).join(catalog.select(*PII_KEY), PII_KEY, "left_anti")
    return catalog.unionByName(new.select(catalog.columns))


def pii_view(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        F.concat_ws(".", "schema_name", "table_name").alias("full_table"),
        *[c for c in catalog.columns if c not in ("schema_name", "table_name")],
    ).orderBy(F.col("pii_sensitivity").desc(), "full_table", "column_name")
