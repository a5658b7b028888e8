"""The pipeline's tables, derived from the given ones.

Each text is portable SQL: Spark runs it to make the input, and the SQL
counterparts run it as a common table expression. Given tables stand in braces.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

AS_OF = datetime(2024, 2, 1)
FRESH_AS_OF = datetime(2024, 1, 31, 3)
SALT = "pepper-for-checks"

_UUID = (
    "concat(substr(h,1,8),'-',substr(h,9,4),'-',substr(h,13,4),'-',substr(h,17,4),'-',"
    "substr(h,21,12))"
)

FIXTURES: dict[str, str] = {
    # published transactions: every status, tier and weekday
    "tx": f"""
SELECT {_UUID} AS transaction_id,
  CAST(user_id AS INT) AS user_id, upper(event_type) AS product_category,
  CAST(CASE WHEN event_id % 97 = 0 THEN -value WHEN event_id % 11 = 0 THEN value*10
       ELSE value END AS DECIMAL(10,2)) AS amount,
  CASE event_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
  ts AS transaction_date,
  CASE WHEN event_id % 10 = 0 THEN 'FAILED' WHEN event_id % 10 = 1 THEN 'PENDING'
       ELSE 'COMPLETED' END AS status,
  ts + INTERVAL '1' HOUR AS ingested_at, ts + INTERVAL '2' HOUR AS processed_at,
  CAST(CASE WHEN event_id % 20 = 2 THEN 0.65 WHEN event_id % 20 < 6 THEN 0.75
       ELSE 1.0 END AS DECIMAL(3,2)) AS data_quality_score
FROM (SELECT *, md5(CAST(event_id AS STRING)) AS h FROM {{events}}) e""",
    # users: five percent without e-mail, names with apostrophes and hyphens
    "users": """
SELECT CAST(c_custkey AS INT) AS user_id, concat(c_mktsegment,'-ann') AS first_name,
  concat('o''',n_name) AS last_name,
  CASE WHEN c_custkey % 20 = 0 THEN NULL
       ELSE concat('User',CAST(c_custkey AS STRING),'@Example.com') END AS email,
  concat('192.168.',CAST(CAST(FLOOR(c_custkey/256) AS INT) % 256 AS STRING),'.',
         CAST(c_custkey % 256 AS STRING)) AS ip_address,
  n_name AS country,
  DATE '2024-01-31' - CAST(c_custkey % 400 AS INT) AS registration_date,
  CAST(CASE WHEN c_custkey % 7 = 0 THEN 0.65 WHEN c_custkey % 7 = 1 THEN 0.75
       ELSE 1.0 END AS DECIMAL(3,2)) AS data_quality_score
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    # a landed batch in which keys repeat with differing rows
    "batch": f"""
SELECT {_UUID} AS transaction_id, CAST(l_suppkey AS INT) AS user_id,
  concat('LINE_', CAST(l_linenumber AS STRING)) AS product_category,
  CAST(CASE WHEN l_discount = 0 THEN -l_extendedprice ELSE l_extendedprice END
       AS DECIMAL(10,2)) AS amount,
  CASE l_linestatus WHEN 'O' THEN 'USD' ELSE 'EUR' END AS currency,
  l_shipdate AS transaction_date,
  CASE l_returnflag WHEN 'R' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
  l_shipdate + INTERVAL '1' HOUR AS ingested_at
FROM (SELECT *, md5(concat(CAST(l_orderkey AS STRING),'-',CAST(l_linenumber AS STRING))) AS h
      FROM {{lineitem}}) l""",
    # raw transactions with faults of each kind
    "dirty": f"""
SELECT CASE WHEN value > 200 THEN NULL WHEN event_type = 'error' AND value > 40
       THEN concat('bad-', h) WHEN props = '{{{{"k": 7}}}}' THEN '00000000-0000-4000-8000-000000000000'
       ELSE {_UUID} END AS transaction_id,
  CASE WHEN value < 1 THEN NULL ELSE CAST(user_id AS INT) END AS user_id,
  upper(event_type) AS product_category,
  CAST(CASE WHEN value > 100 THEN NULL WHEN value < 2 THEN -value WHEN value > 50
       THEN value * 5000 ELSE value END AS DECIMAL(10,2)) AS amount,
  CASE WHEN event_type = 'signup' AND value > 30 THEN 'XXX' WHEN value > 90 THEN NULL
       ELSE 'USD' END AS currency,
  ts AS transaction_date,
  CASE WHEN event_type = 'view' AND value > 60 THEN 'UNKNOWN' ELSE 'COMPLETED' END AS status,
  ts + INTERVAL '1' HOUR AS ingested_at
FROM (SELECT *, md5(CAST(event_id AS STRING)) AS h FROM {{events}}) e""",
    # records as they come in a page: all text, some unreadable
    "wire": f"""
SELECT event_id,
  CASE WHEN value > 150 THEN NULL
       WHEN props = '{{{{"k": 7}}}}' THEN '00000000-0000-4000-8000-000000000000'
       ELSE {_UUID} END AS transaction_id,
  CASE WHEN value < 1 THEN NULL WHEN value < 2 THEN 'user'
       ELSE CAST(user_id AS STRING) END AS user_id,
  upper(event_type) AS product_category,
  CASE WHEN event_type = 'error' AND value > 30 THEN 'n/a'
       ELSE CAST(CAST(value AS DECIMAL(10,2)) AS STRING) END AS amount,
  CASE WHEN value > 80 THEN 'US-Dollars in cash' ELSE 'USD' END AS currency,
  CAST(ts AS STRING) AS transaction_date,
  CASE WHEN event_type = 'view' AND value > 60 THEN 'LOST' ELSE 'COMPLETED' END AS status
FROM (SELECT *, md5(CAST(event_id AS STRING)) AS h FROM {{events}}) e""",
    # lines of the PII catalogue, one per customer
    "catalog_lines": """
SELECT CASE WHEN c_nationkey < 12 THEN 'audit' ELSE 'prod' END AS schema_name,
  concat('segment_', lower(c_mktsegment)) AS table_name, c_name AS column_name,
  'direct_identifier' AS pii_category,
  CASE WHEN c_nationkey < 6 THEN 'low' WHEN c_nationkey < 12 THEN 'medium'
       WHEN c_nationkey < 18 THEN 'high' ELSE 'critical' END AS pii_sensitivity,
  'hash_sha256' AS protection_method, 'restricted' AS access_restriction,
  CAST(30 + c_nationkey * 10 AS INT) AS retention_days, 'consent' AS legal_basis
FROM {customer}""",
    # columns of many tables at many checks
    "schema_log": """
SELECT 'lake' AS schema_name, concat('supplier_', CAST(l_suppkey AS STRING)) AS table_name,
  concat('line_', CAST(l_linenumber AS STRING)) AS column_name, l_returnflag AS type,
  l_linestatus = 'O' AS nullable, l_shipdate AS check_timestamp
FROM {lineitem}""",
    # the columns of each order's table before and now
    "schema_before": """
SELECT 'lake' AS schema_name, concat('order_', CAST(l_orderkey AS STRING)) AS table_name,
  concat('line_', CAST(l_linenumber AS STRING)) AS column_name, min(l_returnflag) AS type
FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY 1, 2, 3""",
    "schema_now": """
SELECT 'lake' AS schema_name, concat('order_', CAST(l_orderkey AS STRING)) AS table_name,
  concat('line_', CAST(l_linenumber AS STRING)) AS column_name, min(l_returnflag) AS type
FROM {lineitem} WHERE l_linestatus = 'O' GROUP BY 1, 2, 3""",
    # snapshots of each supplier's table, and its columns now: some tables are new, one column
    # is called otherwise
    "schema_checks": """
SELECT 'lake' AS schema_name, concat('supplier_', CAST(l_suppkey AS STRING)) AS table_name,
  concat('line_', CAST(l_linenumber AS STRING)) AS column_name, max(l_returnflag) AS type,
  max(l_linestatus) = 'O' AS nullable, l_shipdate AS check_timestamp
FROM {lineitem} GROUP BY l_suppkey, l_linenumber, l_shipdate""",
    "schema_columns": """
SELECT 'lake' AS schema_name,
  concat(CASE WHEN l_suppkey % 10 = 0 THEN 'new_' ELSE '' END, 'supplier_',
         CAST(l_suppkey AS STRING)) AS table_name,
  CASE WHEN l_linenumber = 1 THEN 'first' ELSE concat('line_', CAST(l_linenumber AS STRING)) END
    AS column_name,
  min(l_returnflag) AS type, min(l_linestatus) = 'O' AS nullable
FROM {lineitem} GROUP BY l_suppkey, l_linenumber""",
    "monitor": """
SELECT event_type AS table_name, ts AS actual_arrival_time FROM {events}""",
    "logs": """
SELECT event_type AS table_name, CAST(value AS DECIMAL(10,2)) AS success_rate,
  event_id AS log_id, ts AS validation_timestamp FROM {events}""",
    # deletion requests: one per order of a customer
    "requests": """
SELECT CAST(o_orderkey AS STRING) AS request_id, CAST(o_custkey AS INT) AS user_id,
  concat('order of ', CAST(CAST(o_orderdate AS DATE) AS STRING)) AS reason
FROM {orders}""",
    # users without a key are needed, so customers in debt have none
    "key_owners": """
SELECT CAST(c_custkey AS INT) AS user_id FROM {customer} WHERE c_acctbal >= 0""",
    "runs": """
SELECT c_name AS dag_execution_id FROM {customer}""",
}

_TABLES = ("customer", "events", "lineitem", "nation", "orders")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = FIXTURES[name]
    used = {
        t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if f"{{{t}}}" in text
    }
    return spark.sql(text, **used)


def fixture_sql(name: str) -> str:
    return FIXTURES[name].format(**{t: t for t in _TABLES})
