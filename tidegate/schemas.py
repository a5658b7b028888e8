"""Columns of the zones: raw (audit), published (prod) and governance tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampNTZType,
)

MONEY = DecimalType(10, 2)
SCORE = DecimalType(3, 2)
TEXT, INT, LONG, MOMENT = StringType(), IntegerType(), LongType(), TimestampNTZType()


@dataclass(frozen=True)
class RecordField:
    """A field of a landed record and what the raw table demands of it."""

    name: str
    type: str
    required: bool = False
    max_length: int | None = None
    allowed: tuple[str, ...] = ()


# Field names, types, lengths and value sets of the raw tables.
TRANSACTION_FIELDS = [
    RecordField("transaction_id", "string", True, 50),
    RecordField("user_id", "int", True),
    RecordField("product_category", "string", False, 50),
    RecordField("amount", "decimal(10,2)"),
    RecordField("currency", "string", False, 10),
    RecordField("transaction_date", "timestamp_ntz"),
    RecordField("status", "string", False, 20, ("COMPLETED", "PENDING", "FAILED")),
]
USER_FIELDS = [
    RecordField("user_id", "int", True),
    RecordField("first_name", "string", True, 100),
    RecordField("last_name", "string", True, 100),
    RecordField("email", "string", False, 255),
    RecordField("ip_address", "string", True, 45),
    RecordField("country", "string", True, 50),
    RecordField("registration_date", "date", True),
]

INGEST_COLUMNS = [
    StructField("ingested_at", MOMENT),
    StructField("source_file", TEXT),
    StructField("gx_validation_status", TEXT),
    StructField("gx_validation_errors", TEXT),
]
PUBLISH_COLUMNS = [StructField("processed_at", MOMENT), StructField("data_quality_score", SCORE)]

RAW_TRANSACTIONS = StructType(
    [
        StructField("transaction_id", TEXT),
        StructField("user_id", INT),
        StructField("product_category", TEXT),
        StructField("amount", MONEY),
        StructField("currency", TEXT),
        StructField("transaction_date", MOMENT),
        StructField("status", TEXT),
        *INGEST_COLUMNS,
    ]
)
RAW_USERS = StructType(
    [
        StructField("user_id", INT),
        StructField("first_name", TEXT),
        StructField("last_name", TEXT),
        StructField("email", TEXT),
        StructField("ip_address", TEXT),
        StructField("country", TEXT),
        StructField("registration_date", DateType()),
        *INGEST_COLUMNS,
    ]
)
PUBLISHED_TRANSACTIONS = StructType(
    [*RAW_TRANSACTIONS.fields, *PUBLISH_COLUMNS, StructField("transaction_key", TEXT)]
)
PUBLISHED_USERS = StructType([*RAW_USERS.fields, *PUBLISH_COLUMNS])

VALIDATION_LOG = StructType(
    [
        StructField("table_name", TEXT),
        StructField("expectation_suite_name", TEXT),
        StructField("n_expectations", INT),
        StructField("n_failed", INT),
        StructField("success_rate", DecimalType(5, 2)),
        StructField("failures", ArrayType(TEXT)),
        StructField("blocking_triggered", BooleanType()),
        StructField("validation_timestamp", MOMENT),
    ]
)
FRESHNESS_LOG = StructType(
    [
        StructField("table_name", TEXT),
        StructField("expected_arrival_time", MOMENT),
        StructField("actual_arrival_time", MOMENT),
        StructField("lag_hours", DoubleType()),
        StructField("status", TEXT),
        StructField("check_timestamp", MOMENT),
        StructField("threshold_minutes", INT),
    ]
)
SCHEMA_HISTORY = StructType(
    [
        StructField("schema_name", TEXT),
        StructField("table_name", TEXT),
        StructField("column_name", TEXT),
        StructField("type", TEXT),
        StructField("nullable", BooleanType()),
        StructField("check_timestamp", MOMENT),
    ]
)
ENCRYPTION_KEYS = StructType(
    [
        StructField("user_id", INT),
        StructField("encryption_key", BinaryType()),
        StructField("key_version", INT),
        StructField("created_at", MOMENT),
        StructField("revoked_at", MOMENT),
        StructField("revoke_reason", TEXT),
        StructField("is_active", BooleanType()),
    ]
)
DELETION_REQUESTS = StructType(
    [
        StructField("request_id", TEXT),
        StructField("user_id", INT),
        StructField("request_type", TEXT),
        StructField("request_date", MOMENT),
        StructField("status", TEXT),
        StructField("completed_at", MOMENT),
        StructField("processed_by", TEXT),
        StructField("notes", TEXT),
        StructField("legal_reference", TEXT),
    ]
)
LINEAGE = StructType(
    [
        StructField("lineage_type", TEXT),
        StructField("node_id", TEXT),
        StructField("node_name", TEXT),
        StructField("node_type", TEXT),
        StructField("schema_name", TEXT),
        StructField("table_name", TEXT),
        StructField("description", TEXT),
        StructField("source_id", TEXT),
        StructField("target_id", TEXT),
        StructField("transformation", TEXT),
        StructField("dag_execution_id", TEXT),
        StructField("created_at", MOMENT),
    ]
)
PII_CATALOG = StructType(
    [
        StructField("schema_name", TEXT),
        StructField("table_name", TEXT),
        StructField("column_name", TEXT),
        StructField("pii_category", TEXT),
        StructField("pii_sensitivity", TEXT),
        StructField("protection_method", TEXT),
        StructField("access_restriction", TEXT),
        StructField("retention_days", INT),
        StructField("legal_basis", TEXT),
    ]
)
PIPELINE_METRICS = StructType(
    [
        StructField("execution_date", MOMENT),
        StructField("task_name", TEXT),
        StructField("metric_name", TEXT),
        StructField("metric_value", DoubleType()),
    ]
)

# Stored state of the metrics: cells of three kinds under one schema.
METRIC_CELLS = StructType(
    [
        StructField("cells", TEXT), StructField("user_id", INT), StructField("transaction_day", MOMENT),
        StructField("product_category", TEXT), StructField("cents", LONG), StructField("cell_rows", LONG),
        StructField("n", LONG), StructField("n_amount", LONG), StructField("total", DecimalType(38, 2)),
        StructField("first_at", MOMENT), StructField("last_at", MOMENT),
    ]
)

# Pages of a source that were landed, and the generations of a table's schema.
OFFSETS = StructType([StructField("page", LONG), StructField("attempts", INT), StructField("run_id", TEXT)])
GENERATIONS = StructType([StructField("version", INT), StructField("columns", TEXT), StructField("plan", TEXT)])
