"""The SQL counterpart of each registered query, for an independent engine.

Models are common table expressions over the fixtures; a query text pulls in
those it names, in order.
"""

from __future__ import annotations

import re

from .fixtures import FIXTURES, SALT, fixture_sql

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
FRESH_AS_OF = "TIMESTAMP '2024-01-31 03:00:00'"


def _avg(total: str, n: str, places: int = 6) -> str:
    """Mean in whole numbers, rounded once, half away from zero."""
    count = f"NULLIF({n}, 0)"
    whole = f"(CAST(round({total} * 100) AS HUGEINT) * {10 ** (places - 2)})"
    sign = f"CASE WHEN {whole} < 0 THEN -1 ELSE 1 END"
    nearest = f"({sign} * ((2 * abs({whole}) + {count}) // (2 * {count})))"
    unit = f"0.{'1'.rjust(places, '0')}"
    return f"CAST(CAST({nearest} AS DECIMAL(30,0)) * {unit} AS DECIMAL(28,{places}))"


def _words(text: str) -> str:
    pieces = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"
    return (
        f"array_to_string(list_transform({pieces}, "
        "lambda w: concat(upper(left(w, 1)), substr(w, 2))), '')"
    )


def _deviation(total: str, n: str) -> str:
    cents = "CAST(round(t.amount * 100) AS HUGEINT)"
    whole = f"CAST(round({total} * 100) AS HUGEINT)"
    over = f"(({cents} * {n} - {whole}) * 10000)"
    nearest = f"(CASE WHEN {over} < 0 THEN -1 ELSE 1 END * ((2 * abs({over}) + {whole}) // (2 * {whole})))"
    return f"CASE WHEN {total} > 0 THEN CAST(CAST({nearest} AS DECIMAL(30,0)) * 0.01 AS DECIMAL(28,2)) END"


def _tail(column: str, visible: int) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN NULL ELSE concat("
        f"repeat('*', greatest(0, length({column}) - {visible})), "
        f"right({column}, {visible})) END"
    )


def _sha(column: str) -> str:
    return f"sha256(CAST({column} AS VARCHAR) || '{SALT}')"


_RAW = "CAST({0} AS DECIMAL(10,2))"

MODELS: dict[str, str] = {
    "raw_users": f"""
SELECT *, CAST(registration_date AS TIMESTAMP) AS ingested_at, {AS_OF} AS processed_at FROM users""",
    "stg": f"""
SELECT left(transaction_id, 50) AS transaction_id, user_id,
  lower(product_category) AS product_category, left(currency, 3) AS currency, amount,
  transaction_date, CAST(date_trunc('day', transaction_date) AS TIMESTAMP) AS transaction_day,
  CAST(year(transaction_date) AS INT) AS transaction_year,
  CAST(month(transaction_date) AS INT) AS transaction_month,
  CAST(day(transaction_date) AS INT) AS transaction_day_of_month,
  CAST(dayofweek(transaction_date) AS INT) AS transaction_day_of_week,
  CAST(hour(transaction_date) AS INT) AS transaction_hour,
  left(upper(status), 20) AS status, processed_at, data_quality_score,
  CASE WHEN data_quality_score >= 0.9 THEN 'high' WHEN data_quality_score >= 0.7 THEN 'medium'
       ELSE 'low' END AS data_quality_tier,
  CASE WHEN amount >= 1000 THEN 'high_value' WHEN amount >= 100 THEN 'medium_value'
       ELSE 'low_value' END AS transaction_value_tier,
  {AS_OF} AS dbt_transformed_at, coalesce(amount < 0, false) AS is_anomaly,
  coalesce(dayofweek(transaction_date) IN (0, 6), false) AS is_weekend
FROM tx""",
    "done": "SELECT * FROM stg WHERE status = 'COMPLETED'",
    "user_sums": """
SELECT user_id, count(*) AS total_transactions, count(DISTINCT transaction_day) AS active_days,
  count(DISTINCT product_category) AS unique_categories,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount, count(amount) AS n_amount,
  min(amount) AS min_transaction_amount, max(amount) AS max_transaction_amount,
  CAST(CAST(quantile_cont(CAST(amount AS DOUBLE), 0.5) AS DECIMAL(18,3)) AS DOUBLE)
    AS median_transaction_amount,
  round(stddev_samp(CAST(amount AS DOUBLE)), 6) AS stddev_transaction_amount,
  min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
FROM done GROUP BY user_id""",
    "user_tiles": """
SELECT user_id,
  CAST(ntile(4) OVER (ORDER BY total_amount DESC NULLS FIRST, user_id) AS INT)
    AS user_value_quartile,
  CAST(ntile(4) OVER (ORDER BY total_transactions DESC, user_id) AS INT)
    AS user_frequency_quartile
FROM user_sums""",
    "category_sums": f"""
SELECT *, {_avg("category_total_amount", "n_amount")} AS category_avg_amount FROM (
  SELECT product_category, count(*) AS category_total_transactions,
    CAST(sum(amount) AS DECIMAL(20,2)) AS category_total_amount, count(amount) AS n_amount,
    count(DISTINCT user_id) AS category_unique_users
  FROM done GROUP BY product_category)""",
    "day_sums": f"""
SELECT *, {_avg("daily_total_amount", "n_amount")} AS daily_avg_amount,
  {_avg("sum(daily_total_amount) OVER week", "(count(daily_total_amount) OVER week)")}
    AS daily_amount_7day_moving_avg
FROM (
  SELECT transaction_day, count(*) AS daily_transaction_count,
    CAST(sum(amount) AS DECIMAL(20,2)) AS daily_total_amount, count(amount) AS n_amount,
    count(DISTINCT user_id) AS daily_unique_users
  FROM done GROUP BY transaction_day)
WINDOW week AS (ORDER BY transaction_day NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "enriched": f"""
SELECT t.*, u.total_transactions AS user_total_transactions, u.active_days AS user_active_days,
  u.unique_categories AS user_unique_categories, u.total_amount AS user_total_amount,
  {_avg("u.total_amount", "u.n_amount")} AS user_avg_transaction_amount,
  u.median_transaction_amount AS user_median_transaction_amount,
  u.stddev_transaction_amount AS user_stddev_transaction_amount,
  q.user_value_quartile, q.user_frequency_quartile, c.category_total_transactions,
  c.category_total_amount, c.category_avg_amount, c.category_unique_users,
  d.daily_transaction_count, d.daily_total_amount, d.daily_avg_amount, d.daily_unique_users,
  d.daily_amount_7day_moving_avg,
  {_deviation("u.total_amount", "u.n_amount")} AS deviation_from_user_avg_pct,
  {_deviation("d.daily_total_amount", "d.n_amount")} AS deviation_from_daily_avg_pct,
  CAST(ROUND(t.data_quality_score * 0.4
    + CASE WHEN u.total_transactions > 10 THEN 0.3 ELSE 0.1 END
    + CASE WHEN t.amount * c.n_amount > c.category_total_amount THEN 0.3 ELSE 0.1 END, 2)
    AS DECIMAL(4,2)) AS composite_reliability_score
FROM stg t LEFT JOIN user_sums u ON t.user_id = u.user_id
  LEFT JOIN user_tiles q ON t.user_id = q.user_id
  LEFT JOIN category_sums c ON t.product_category = c.product_category
  LEFT JOIN day_sums d ON t.transaction_day = d.transaction_day""",
    "facts": """
SELECT transaction_id, user_id, product_category, currency, status, transaction_value_tier,
  data_quality_tier, transaction_date, transaction_day, transaction_day_of_week,
  ['Domingo', 'Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado']
    [transaction_day_of_week + 1] AS transaction_day_name,
  transaction_month, transaction_year,
  concat('Q', coalesce(quarter(transaction_date), 4)) AS transaction_quarter,
  CASE WHEN transaction_month <= 6 THEN 'H1' ELSE 'H2' END AS transaction_semester,
  CASE WHEN is_weekend THEN 'Fin de Semana' ELSE 'Dia Laboral' END AS day_type,
  amount, data_quality_score, composite_reliability_score, user_total_transactions,
  user_total_amount, user_avg_transaction_amount, user_active_days, user_value_quartile,
  user_frequency_quartile, category_avg_amount, daily_transaction_count, daily_total_amount,
  daily_amount_7day_moving_avg, is_anomaly, is_weekend, dbt_transformed_at
FROM enriched WHERE data_quality_score >= 0.7 AND status = 'COMPLETED' AND amount > 0""",
    "stg_u": f"""
SELECT user_id, left({_words("first_name")}, 100) AS first_name,
  left({_words("last_name")}, 100) AS last_name, left(lower(email), 255) AS email,
  left(ip_address, 39) AS ip_address, left(country, 30) AS country, registration_date,
  CAST(year(registration_date) AS INT) AS registration_year,
  CAST(month(registration_date) AS INT) AS registration_month, data_quality_score,
  CASE WHEN data_quality_score >= 0.9 THEN 'high' WHEN data_quality_score >= 0.7 THEN 'medium'
       ELSE 'low' END AS data_quality_tier,
  CASE WHEN email IS NULL THEN 'missing_email' ELSE 'complete' END AS completeness_flag,
  processed_at, {AS_OF} AS dbt_transformed_at
FROM raw_users""",
    "activity": f"""
SELECT user_id, count(*) AS total_transactions, count(DISTINCT transaction_day) AS active_days,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_transaction_value,
  {_avg("sum(amount)", "count(amount)")} AS avg_transaction_amount, count(amount) AS amount_count,
  max(transaction_date) AS last_transaction_date,
  CASE WHEN count(*) >= 50 THEN 'high_activity' WHEN count(*) >= 10 THEN 'medium_activity'
       ELSE 'low_activity' END AS user_activity_segment
FROM done GROUP BY user_id""",
    "people": f"""
SELECT *, CASE WHEN days_since_registration <= 30 THEN 'new_user'
    WHEN days_since_registration <= 180 THEN 'recent_user' ELSE 'established_user' END
    AS user_age_segment
FROM (
  SELECT u.user_id, first_name, last_name,
    concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name, email, ip_address,
    email IS NULL AS has_missing_email, country, registration_date, registration_year,
    registration_month, coalesce(total_transactions, 0) AS total_transactions,
    coalesce(active_days, 0) AS active_days,
    CAST(coalesce(total_transaction_value, 0) AS DECIMAL(15,2)) AS total_lifetime_value,
    CAST(coalesce({_avg("total_transaction_value", "amount_count", 2)}, 0) AS DECIMAL(10,2))
      AS avg_transaction_amount,
    last_transaction_date, coalesce(user_activity_segment, 'no_activity') AS user_activity_segment,
    data_quality_score, data_quality_tier, completeness_flag, processed_at, dbt_transformed_at,
    {AS_OF} AS dbt_enriched_at,
    CASE WHEN data_quality_score >= 0.9 AND completeness_flag = 'complete' THEN 'trusted'
         WHEN data_quality_score >= 0.7 THEN 'acceptable' ELSE 'needs_review' END
      AS user_trust_level,
    CAST(DATE '2024-02-01' - registration_date AS INT) AS days_since_registration
  FROM stg_u u LEFT JOIN activity a ON u.user_id = a.user_id)""",
    "dimension": f"""
SELECT user_id, first_name, last_name, full_name, country, registration_date, registration_year,
  registration_month, total_transactions, active_days, total_lifetime_value AS lifetime_value,
  avg_transaction_amount, last_transaction_date, user_activity_segment,
  user_activity_segment IN ('high_activity', 'medium_activity') AS is_active_user,
  churn_risk_level = 'high_churn_risk' AS is_churned_user, customer_segment, churn_risk_level,
  CAST(CASE WHEN completeness_flag <> 'complete' THEN 25 WHEN data_quality_tier = 'high' THEN 100
       WHEN data_quality_tier = 'medium' THEN 75 ELSE 50 END AS INT) AS engagement_score,
  CAST(CASE customer_segment WHEN 'VIP_Customer' THEN 5 WHEN 'Premium_Customer' THEN 4
       WHEN 'Regular_Customer' THEN 3 WHEN 'One_Time_Buyer' THEN 2 ELSE 1 END AS INT) AS rfm_score,
  data_quality_score, data_quality_tier, completeness_flag, has_missing_email, user_trust_level,
  days_since_registration, user_age_segment, processed_at, {AS_OF} AS dbt_processed_at
FROM (
  SELECT *,
    CASE WHEN total_transactions >= 50 AND total_lifetime_value >= 5000 THEN 'VIP_Customer'
         WHEN total_transactions >= 20 AND total_lifetime_value >= 1000 THEN 'Premium_Customer'
         WHEN total_transactions >= 5 THEN 'Regular_Customer'
         WHEN total_transactions > 0 THEN 'One_Time_Buyer' ELSE 'No_Activity' END
      AS customer_segment,
    CASE WHEN days_since_registration IS NULL THEN 'unknown'
         WHEN user_activity_segment = 'high_activity' THEN 'low_churn_risk'
         WHEN user_activity_segment = 'medium_activity' THEN 'medium_churn_risk'
         ELSE 'high_churn_risk' END AS churn_risk_level
  FROM people)
WHERE data_quality_score >= 0.7 AND user_id IS NOT NULL""",
    "user_facts": """
SELECT user_id, first_name, last_name, full_name, email, ip_address, country, registration_date,
  registration_year, registration_month, total_transactions, active_days, total_lifetime_value,
  avg_transaction_amount, last_transaction_date, user_activity_segment, user_age_segment,
  user_trust_level, data_quality_score, data_quality_tier, processed_at,
  dbt_enriched_at AS transformed_at
FROM people WHERE user_trust_level IN ('trusted', 'acceptable')""",
    "numbered_pages": """
SELECT event_id // 100 + 1 AS page, arg_min(product_category, event_id) AS opens_with
FROM wire GROUP BY 1""",
    "checked_wire": """
SELECT *, CASE
    WHEN transaction_id IS NULL THEN 'transaction_id missing'
    WHEN user_id IS NULL THEN 'user_id missing'
    WHEN try_cast(user_id AS INT) IS NULL THEN 'user_id unreadable'
    WHEN try_cast(amount AS DECIMAL(10,2)) IS NULL THEN 'amount unreadable'
    WHEN length(currency) > 10 THEN 'currency too long'
    WHEN status NOT IN ('COMPLETED', 'PENDING', 'FAILED') THEN 'status not allowed' END
  AS reject_reason
FROM wire""",
    "placed_wire": """
SELECT w.*, p.page, p.opens_with NOT IN ('ERROR', 'SIGNUP') AS readable
FROM checked_wire w JOIN numbered_pages p ON w.event_id // 100 + 1 = p.page""",
    "batch_best": f"""
SELECT *, {_sha("transaction_id")} AS transaction_key FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ingested_at DESC, user_id DESC, product_category DESC, amount DESC, currency DESC,
             transaction_date DESC, status DESC) AS place
  FROM batch WHERE status = 'COMPLETED' AND amount > 0 AND user_id IS NOT NULL)
WHERE place = 1""",
    "batch_earlier": f"""
SELECT *, {_sha("transaction_id")} AS transaction_key FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY ingested_at DESC, user_id DESC, product_category DESC, amount DESC, currency DESC,
             transaction_date DESC, status DESC) AS place
  FROM batch WHERE status = 'COMPLETED' AND amount > 0 AND user_id IS NOT NULL
    AND ingested_at < TIMESTAMP '1996-07-01 00:00:00')
WHERE place = 1""",
    "batch_new": """
SELECT * FROM batch_best
WHERE transaction_key NOT IN (SELECT transaction_key FROM batch_earlier)""",
    "erased": """
SELECT user_id, max(reason) AS reason FROM requests GROUP BY user_id""",
    "catalog_after": """
SELECT * REPLACE ('hash_salting' AS protection_method) FROM catalog_lines
WHERE pii_sensitivity = 'low' OR retention_days > 200
UNION ALL
SELECT * FROM catalog_lines WHERE NOT (pii_sensitivity = 'low' OR retention_days > 200)
UNION ALL
SELECT * FROM (VALUES
  ('audit', 'raw_transactions', 'user_id', 'direct_identifier', 'high', 'hash_salting', 'production_only', 365, 'Consentimiento del usuario - LDPD Art. 8'),
  ('prod', 'raw_transactions', 'user_id', 'direct_identifier', 'high', 'hash_salting', 'production_only', 365, 'Consentimiento del usuario - LDPD Art. 8'),
  ('staging', 'stg_raw_transactions', 'user_id', 'direct_identifier', 'high', 'hash_salting', 'production_only', 365, 'Consentimiento del usuario - LDPD Art. 8'),
  ('audit', 'raw_users', 'email', 'contact_information', 'high', 'hash_sha256', 'restricted', 180, 'LDPD Art. 12 - Consentimiento'),
  ('audit', 'raw_users', 'ip_address', 'device_identifier', 'medium', 'hash_sha256', 'restricted', 90, 'LDPD Art. 12 - Auditoría de seguridad'),
  ('prod', 'raw_users', 'email', 'contact_information', 'high', 'hash_sha256', 'restricted', 180, 'LDPD Art. 12 - Consentimiento'),
  ('prod', 'raw_users', 'ip_address', 'device_identifier', 'medium', 'hash_sha256', 'restricted', 90, 'LDPD Art. 12 - Auditoría de seguridad'),
  ('staging', 'stg_raw_users', 'email', 'contact_information', 'high', 'hash_sha256', 'restricted', 180, 'LDPD Art. 12 - Consentimiento'),
  ('staging', 'stg_raw_users', 'ip_address', 'device_identifier', 'medium', 'hash_sha256', 'restricted', 90, 'LDPD Art. 12 - Auditoría de seguridad')
) seed(schema_name, table_name, column_name, pii_category,
  pii_sensitivity, protection_method, access_restriction, retention_days, legal_basis)""",
    "lineage_nodes": """
SELECT *, CASE WHEN schema_name IS NULL THEN node_name ELSE schema_name || '.' || table_name END
  AS node_id
FROM (VALUES
  ('API Transacciones', 'source', NULL, NULL, 'transactions as delivered'),
  ('audit.raw_transactions', 'table', 'audit', 'raw_transactions', 'accepted records of the pages'),
  ('prod.raw_transactions', 'table', 'prod', 'raw_transactions', 'audited, cleaned and masked'),
  ('stg_raw_transactions', 'model', 'staging', 'stg_raw_transactions', 'staged transactions'),
  ('int_transactions_enriched', 'model', 'intermediate', 'int_transactions_enriched', 'transactions with metrics'),
  ('fct_transactions', 'model', 'analytics', 'fct_transactions', 'transaction facts'),
  ('dim_users', 'model', 'analytics', 'dim_users', 'user dimension'),
  ('API Usuarios', 'source', NULL, NULL, 'users as delivered'),
  ('audit.raw_users', 'table', 'audit', 'raw_users', 'accepted records of the pages'),
  ('prod.raw_users', 'table', 'prod', 'raw_users', 'audited, cleaned and masked'),
  ('stg_raw_users', 'model', 'staging', 'stg_raw_users', 'staged users'),
  ('int_users_enriched', 'model', 'intermediate', 'int_users_enriched', 'users with activity'),
  ('fct_users', 'model', 'analytics', 'fct_users', 'user facts')
) n(node_name, node_type, schema_name, table_name, description)""",
    "lineage_edges": """
SELECT s.node_id AS source_id, t.node_id AS target_id, transformation
FROM (VALUES
  ('API Transacciones', 'audit.raw_transactions', 'land pages'),
  ('audit.raw_transactions', 'prod.raw_transactions', 'publish completed, positive amounts'),
  ('prod.raw_transactions', 'stg_raw_transactions', 'normalise types'),
  ('stg_raw_transactions', 'int_transactions_enriched', 'add metrics'),
  ('int_transactions_enriched', 'fct_transactions', 'keep score of 0.7 and more'),
  ('int_users_enriched', 'dim_users', 'segment users'),
  ('API Usuarios', 'audit.raw_users', 'land pages'),
  ('audit.raw_users', 'prod.raw_users', 'publish with masked e-mail and address'),
  ('prod.raw_users', 'stg_raw_users', 'normalise types'),
  ('stg_raw_users', 'int_users_enriched', 'add activity'),
  ('int_users_enriched', 'fct_users', 'keep trusted and acceptable')
) e(source, target, transformation)
  JOIN lineage_nodes s ON e.source = s.node_name JOIN lineage_nodes t ON e.target = t.node_name""",
    "lineage": """
SELECT r.dag_execution_id, 'node' AS lineage_type, node_id, node_name, node_type, schema_name,
  table_name, description, NULL AS source_id, NULL AS target_id, NULL AS transformation
FROM runs r CROSS JOIN lineage_nodes g
UNION ALL
SELECT r.dag_execution_id, 'edge', NULL, NULL, NULL, NULL, NULL, NULL, source_id, target_id,
  transformation
FROM runs r CROSS JOIN lineage_edges g""",
    "schema_last": """
SELECT * FROM schema_checks JOIN (SELECT table_name, max(check_timestamp) AS check_timestamp
  FROM schema_checks GROUP BY table_name) USING (table_name, check_timestamp)""",
    "schema_changes": """
SELECT coalesce(b.table_name, n.table_name) AS table_name,
  coalesce(b.column_name, n.column_name) AS column_name, b.type AS was, n.type AS is_now
FROM (SELECT * FROM schema_last WHERE table_name IN (SELECT table_name FROM schema_columns)) b
  FULL JOIN (SELECT * FROM schema_columns WHERE table_name IN (SELECT table_name FROM schema_last)) n
  ON b.table_name = n.table_name AND b.column_name = n.column_name
WHERE b.type IS DISTINCT FROM n.type""",
    "schema_lists": """
SELECT table_name,
  string_agg('"' || column_name || '"', ',' ORDER BY column_name) FILTER (WHERE was IS NULL)
    AS added,
  string_agg('"' || column_name || '"', ',' ORDER BY column_name) FILTER (WHERE is_now IS NULL)
    AS removed,
  string_agg('{"column":"' || column_name || '","old":"' || was || '","new":"' || is_now || '"}',
    ',' ORDER BY column_name) FILTER (WHERE was IS NOT NULL AND is_now IS NOT NULL) AS retyped
FROM schema_changes GROUP BY table_name""",
}

_TEXTS = {**{n: fixture_sql(n) for n in FIXTURES}, **MODELS}


def _needs(text: str) -> list[str]:
    named = set(re.findall(r"\b(?:FROM|JOIN|,)\s+([a-z_]+)\b", text))
    return [n for n in _TEXTS if n in named]


def with_models(text: str) -> str:
    wanted, todo = set(), _needs(text)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in _needs(_TEXTS[name]) if n != name]
    ctes = ",\n".join(f"{n} AS ({_TEXTS[n]}\n)" for n in _TEXTS if n in wanted)
    return f"WITH {ctes}\n{text}" if ctes else text


# --- expectations ----------------------------------------------------------


def _literal(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


# Type, column, what a cell (or the table) must satisfy, description, share.
# A condition of None marks a line that cannot be evaluated.
_ROWS = "expect_table_row_count_to_be_between"
_SET = "expect_column_values_to_not_be_null"
_ONCE = "expect_column_values_to_be_unique"
_AMONG = "expect_column_values_to_be_in_set"
_LIKE = "expect_column_values_to_match_regex"
_WITHIN = "expect_column_values_to_be_between"
_LONG = "expect_column_value_lengths_to_be_between"
_IS_UUID = (
    "regexp_matches(transaction_id, "
    "'^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$')"
)
_IS_IPV4 = (
    "regexp_matches(ip_address, '^(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\\.){3}"
    "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)$')"
)
_MAIL = r"regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')"
_TX_CRITICAL = [
    (_ROWS, None, "total >= 1", "table has rows", 1),
    (_SET, "user_id", None, "user_id is set", 1),
    (_SET, "transaction_id", None, "transaction_id is set", 1),
    (_ONCE, "transaction_id", None, "transaction_id is unique", 1),
    (_AMONG, "currency", "currency IN ('USD', 'EUR', 'GBP')", "currency is known", 1),
    (_AMONG, "status", "status IN ('COMPLETED', 'PENDING', 'FAILED')", "status is known", 1),
    (_LIKE, "transaction_id", _IS_UUID, "transaction_id is a UUID", 1),
]
_TX_WARNINGS = [
    (_WITHIN, "amount", "amount BETWEEN 0.01 AND 100000", "amount is positive and plausible", 0.99),
    ("expect_column_values_to_be_match_regex", "transaction_id", None, "transaction_id is a UUID", 1),
]
_USERS_CRITICAL = [
    (_ROWS, None, "total >= 1", "table has rows", 1),
    (_SET, "user_id", None, "user_id is set", 1),
    (_ONCE, "user_id", None, "user_id is unique", 1),
    (_SET, "first_name", None, "first_name is set", 1),
    (_SET, "last_name", None, "last_name is set", 1),
    (
        _LIKE, "registration_date",
        r"regexp_matches(CAST(registration_date AS VARCHAR), '^\d{4}-\d{2}-\d{2}$')",
        "registration_date is a date", 1,
    ),
    (
        _LIKE, "ip_address", r"regexp_matches(ip_address, '^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$')",
        "ip_address looks like IPv4", 1,
    ),
    (_SET, "ip_address", None, "ip_address is set", 1),
    (
        _LIKE, "registration_date",
        r"regexp_matches(CAST(registration_date AS VARCHAR), '^\d{4}-\d{2}-\d{2}')",
        "registration_date starts with a date", 1,
    ),
    (_LIKE, "ip_address", _IS_IPV4, "ip_address is IPv4", 1),
]
_USERS_WARNINGS = [
    (_SET, "email", None, "email is mostly set", 0.95),
    (_LIKE, "email", _MAIL, "email is well formed", 0.95),
    (_LONG, "first_name", "length(first_name) BETWEEN 1 AND 50", "first_name has 1-50 characters", 1),
    (_LONG, "last_name", "length(last_name) BETWEEN 1 AND 50", "last_name has 1-50 characters", 1),
    (_LONG, "country", "length(country) BETWEEN 2 AND 50", "country has 2-50 characters", 1),
]
_BROKEN = [
    (_AMONG, "currency", None, "no set", 1),
    (_LIKE, "currency", None, "no pattern", 1),
    (_WITHIN, "status", None, "text in a range", 1),
    (_SET, "absent", "no such column", "no column", 1),
    ("expect_magic", "status", None, "no such type", 1),
    (_SET, "user_id", None, "half is set", 0.5),
]
_SINGLE = {
    "dq_row_count": ("dirty", _ROWS, None, "total >= 1", 1),
    "dq_not_null": ("dirty", _SET, "user_id", None, 0.9),
    "dq_unique": ("dirty", _ONCE, "transaction_id", None, 1),
    "dq_in_set": ("dirty", _AMONG, "currency", "currency IN ('USD', 'EUR', 'GBP')", 1),
    "dq_regex": ("dirty", _LIKE, "transaction_id", _IS_UUID, 1),
    "dq_between": ("dirty", _WITHIN, "amount", "amount BETWEEN 0.01 AND 100000", 0.99),
    "dq_length": ("users", _LONG, "first_name", "length(first_name) BETWEEN 1 AND 12", 1),
}


def _check_line(table: str, no: int, severity: str, line: tuple) -> str:
    kind, c, test, description, mostly = line
    source, passes = table, f"evaluated = 0 OR (evaluated - unexpected) / evaluated >= {mostly}"
    if kind == _ROWS:
        seen, bad, passes = "count(*)", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END", test
    elif kind == _SET and test is None:
        seen, bad = "count(*)", f"count(*) FILTER (WHERE {c} IS NULL)"
    elif kind == _ONCE:
        source = f"(SELECT *, count(*) OVER (PARTITION BY {c}) AS copies FROM {table})"
        seen, bad = f"count({c})", f"count({c}) FILTER (WHERE copies > 1)"
    elif test and test != "no such column":
        seen, bad = f"count({c})", f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT ({test}))"
    else:
        seen = bad = passes = "NULL"
    status = f"CASE WHEN total = 0 THEN 'failed' WHEN {passes} THEN 'passed' ELSE 'failed' END"
    if passes == "NULL":
        status = "'error'"
    column = "CAST(NULL AS VARCHAR)" if c is None else _literal(c)
    return f"""
SELECT CAST({no} AS INT) AS expectation_no, {_literal(kind)} AS expectation_type,
  {column} AS column_name, {_literal(severity)} AS severity,
  {_literal(description)} AS description, total AS element_count,
  CAST(evaluated AS BIGINT) AS evaluated_count, CAST(unexpected AS BIGINT) AS unexpected_count,
  {status} AS status
FROM (SELECT count(*) AS total, {seen} AS evaluated, {bad} AS unexpected FROM {source})"""


def _suite_sql(table: str, severity: str, lines: list[tuple]) -> str:
    return "\nUNION ALL".join(
        _check_line(table, no, severity, line) for no, line in enumerate(lines, start=1)
    )


def _log_sql(table: str, name: str, suite: str, critical: list[tuple], warning: list[tuple]) -> str:
    lines = (
        f"SELECT 'critical' AS tier, * FROM ({_suite_sql(table, 'CRITICAL', critical)}) "
        f"UNION ALL SELECT 'warning' AS tier, * FROM ({_suite_sql(table, 'WARNING', warning)})"
    )
    text = (
        "CASE WHEN status = 'error' THEN expectation_type || ' (error)' ELSE '[' || severity "
        "|| '] ' || description || ': ' || unexpected_count || ' registros' END"
    )
    bad = "status <> 'passed'"
    return f"""
SELECT '{name}' AS table_name,
  CASE WHEN blocked THEN '{suite}' ELSE 'COMBINED_SUITES' END AS expectation_suite_name,
  CASE WHEN blocked THEN cn ELSE n END AS n_expectations,
  CASE WHEN blocked THEN cb ELSE b END AS n_failed,
  CAST(round(CASE WHEN blocked THEN (cn - cb) * 100.0 / cn ELSE (n - b) * 100.0 / n END, 2)
       AS DECIMAL(5,2)) AS success_rate,
  coalesce(CASE WHEN blocked THEN ct ELSE wt END, '') AS failures,
  blocked AS blocking_triggered
FROM (SELECT count(*) FILTER (WHERE tier = 'critical') AS cn,
    count(*) FILTER (WHERE tier = 'critical' AND {bad}) AS cb, count(*) AS n,
    count(*) FILTER (WHERE {bad}) AS b,
    string_agg({text}, '; ' ORDER BY expectation_no) FILTER (WHERE tier = 'critical' AND {bad}) AS ct,
    string_agg({text}, '; ' ORDER BY expectation_no) FILTER (WHERE tier = 'warning' AND {bad}) AS wt,
    count(*) FILTER (WHERE tier = 'critical' AND {bad}) > 0 AS blocked
  FROM ({lines}))"""


# --- model tests -----------------------------------------------------------

_TESTED = {
    "stg_raw_transactions": "stg",
    "int_transactions_enriched": "enriched",
    "fct_transactions": "facts",
    "dim_users": "dimension",
    "prod.raw_transactions": "tx",
    "prod.raw_users": "raw_users",
}


# Model, column, declared test, and the condition of a row that breaks it.
_MODEL_TESTS = [
    ("stg_raw_transactions", "transaction_id", "unique", None),
    ("stg_raw_transactions", "transaction_id", "not_null", None),
    ("stg_raw_transactions", "user_id", "not_null", None),
    ("stg_raw_transactions", "product_category", "not_null", None),
    ("stg_raw_transactions", "amount", "not_null", None),
    ("stg_raw_transactions", "amount", "accepted_range", "amount <= 0"),
    ("stg_raw_transactions", "currency", "accepted_values", "currency NOT IN ('USD', 'EUR', 'GBP')"),
    ("stg_raw_transactions", "status", "accepted_values", "status NOT IN ('COMPLETED', 'PENDING', 'FAILED')"),
    ("stg_raw_transactions", "data_quality_score", "accepted_range", "data_quality_score < 0 OR data_quality_score > 1"),
    ("stg_raw_transactions", "data_quality_tier", "accepted_values", "data_quality_tier NOT IN ('high', 'medium', 'low')"),
    ("stg_raw_transactions", "transaction_value_tier", "accepted_values", "transaction_value_tier NOT IN ('high_value', 'medium_value', 'low_value')"),
    ("int_transactions_enriched", "transaction_id", "unique", None),
    ("int_transactions_enriched", "transaction_id", "not_null", None),
    ("int_transactions_enriched", "composite_reliability_score", "accepted_range", "composite_reliability_score < 0 OR composite_reliability_score > 1"),
    ("fct_transactions", "transaction_id", "unique", None),
    ("fct_transactions", "transaction_id", "not_null", None),
    ("fct_transactions", "amount", "not_null", None),
    ("fct_transactions", "amount", "accepted_range", "amount < 0"),
    ("fct_transactions", "data_quality_score", "accepted_range", "data_quality_score < 0.7"),
    ("fct_transactions", "is_anomaly", "accepted_values", "is_anomaly NOT IN (true, false)"),
    ("dim_users", "user_id", "unique", None),
    ("dim_users", "user_id", "not_null", None),
    ("dim_users", "lifetime_value", "not_null", None),
    ("dim_users", "is_active_user", "accepted_values", "is_active_user NOT IN (true, false)"),
    ("dim_users", "is_churned_user", "accepted_values", "is_churned_user NOT IN (true, false)"),
    ("dim_users", "rfm_score", "accepted_range", "rfm_score < 1 OR rfm_score > 5"),
    ("prod.raw_transactions", "transaction_id", "unique", None),
    ("prod.raw_transactions", "transaction_id", "not_null", None),
    ("prod.raw_transactions", "user_id", "not_null", None),
    ("prod.raw_transactions", "amount", "not_null", None),
    ("prod.raw_users", "user_id", "unique", None),
    ("prod.raw_users", "user_id", "not_null", None),
    ("prod.raw_users", "registration_date", "not_null", None),
]


def _model_test_line(model: str, c: str, kind: str, breaks: str | None) -> str:
    table = _TESTED[model]
    if kind == "unique":
        found = f"SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    else:
        found = f"SELECT {c} FROM {table} WHERE {breaks or c + ' IS NULL'}"
    return f"""
SELECT '{model}' AS model, '{c}' AS column_name, '{kind}' AS test, count(*) AS failures,
  count(*) = 0 AS passed FROM ({found})"""


def _model_tests_sql(kind: str) -> str:
    return "\nUNION ALL".join(_model_test_line(*t) for t in _MODEL_TESTS if t[2] == kind)


# --- queries ---------------------------------------------------------------

_BATCH_COLUMNS = (
    "transaction_id, user_id, product_category, amount, currency, transaction_date, status, "
    "ingested_at"
)
_AFTER_SHREDDING = """
FROM key_owners k LEFT JOIN erased e ON k.user_id = e.user_id"""


def _published_sql(table: str, processed_at: str) -> str:
    return f"""
SELECT {_tail("transaction_id", 4)} AS transaction_id, transaction_key, user_id, product_category,
  amount, currency, transaction_date, status, ingested_at, {processed_at} AS processed_at,
  CAST(1 AS DECIMAL(3,2)) AS data_quality_score FROM {table}"""


TEXTS: dict[str, str] = {
    "land_pages": """
SELECT transaction_id, CAST(user_id AS INT) AS user_id, product_category,
  CAST(amount AS DECIMAL(10,2)) AS amount, currency,
  CAST(transaction_date AS TIMESTAMP) AS transaction_date, status
FROM checked_wire WHERE reject_reason IS NULL
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY event_id) = 1""",
    "paged_source": """
SELECT page, n AS records, CASE WHEN opens_with = 'ERROR' THEN 'run-2' ELSE 'run-1' END AS run_id
FROM numbered_pages JOIN (SELECT event_id // 100 + 1 AS page, count(*) AS n FROM wire GROUP BY 1) USING (page)""",
    "page_gap_report": """
SELECT page FROM numbered_pages WHERE opens_with IN ('ERROR', 'SIGNUP')""",
    "corrupt_pages": """
SELECT left('{"page":' || page || ',"meta":{"total_pages":' || (SELECT max(page) FROM numbered_pages)
    || '},"data":[', 40) AS page_text, 'page unreadable' AS reject_reason
FROM numbered_pages WHERE opens_with = 'SIGNUP'""",
    "reject_split": """
SELECT transaction_id, user_id, product_category, amount, currency, transaction_date, status,
  reject_reason FROM checked_wire WHERE reject_reason IS NOT NULL""",
    "extraction_metrics": """
SELECT inserted AS records_inserted, records - inserted
    + (SELECT count(*) FROM numbered_pages WHERE opens_with IN ('ERROR', 'SIGNUP')) AS errors,
  pages_processed
FROM (SELECT count(DISTINCT transaction_id) FILTER (WHERE readable AND reject_reason IS NULL)
    AS inserted, count(*) FILTER (WHERE readable) AS records, max(page) AS pages_processed
  FROM placed_wire)""",
    "publish_tx_clean": """
SELECT * FROM dirty WHERE status = 'COMPLETED' AND amount > 0 AND user_id IS NOT NULL""",
    "publish_users_clean": """
SELECT * FROM raw_users WHERE user_id IS NOT NULL AND email IS NOT NULL
  AND first_name IS NOT NULL AND last_name IS NOT NULL AND country IS NOT NULL""",
    "publish_tx_masked": f"""
SELECT * REPLACE ({_tail("transaction_id", 4)} AS transaction_id) FROM batch""",
    "publish_tx_dedup": f"SELECT {_BATCH_COLUMNS}, transaction_key FROM batch_best",
    "publish_tx_new": """
SELECT transaction_id, transaction_key, amount, ingested_at FROM batch_new""",
    "publish_tx_indexed": """
SELECT transaction_id, transaction_key, amount, ingested_at FROM batch_new""",
    "publish_committed": _published_sql("batch_earlier", FRESH_AS_OF)
    + "\nUNION ALL"
    + _published_sql("batch_new", AS_OF),
    "publish_metrics": """
SELECT fresh AS records_published, total - fresh AS records_filtered,
  best - fresh AS duplicate_records, round(100 * fresh / total, 2) AS approval_rate
FROM (SELECT (SELECT count(*) FROM batch) AS total, (SELECT count(*) FROM batch_best) AS best,
  (SELECT count(*) FROM batch_new) AS fresh)""",
    "publish_transactions": _published_sql("batch_earlier", FRESH_AS_OF)
    + "\nUNION ALL"
    + _published_sql("batch_new", AS_OF),
    "publish_users": f"""
SELECT user_id, first_name, last_name, {_tail("email", 4)} AS email,
  {_tail("ip_address", 3)} AS ip_address, country, registration_date, ingested_at,
  {AS_OF} AS processed_at, CAST(1 AS DECIMAL(3,2)) AS data_quality_score
FROM raw_users WHERE user_id IS NOT NULL AND email IS NOT NULL
  AND first_name IS NOT NULL AND last_name IS NOT NULL AND country IS NOT NULL""",
    **{
        name: _suite_sql(t, "CHECK", [(kind, c, test, kind, mostly)])
        for name, (t, kind, c, test, mostly) in _SINGLE.items()
    },
    "dq_suite_tx_critical": _suite_sql("dirty", "CRITICAL", _TX_CRITICAL),
    "dq_suite_tx_warning": _suite_sql("dirty", "WARNING", _TX_WARNINGS),
    "dq_suite_users_critical": _suite_sql("users", "CRITICAL", _USERS_CRITICAL),
    "dq_suite_users_warning": _suite_sql("users", "WARNING", _USERS_WARNINGS),
    "dq_suite_with_errors": _suite_sql("dirty", "CHECK", _BROKEN),
    "dq_suite_empty": _suite_sql("dirty", "CHECK", _BROKEN),
    "dq_combined_log": _log_sql(
        "dirty", "audit.raw_transactions", "transactions_critical_suite", _TX_CRITICAL, _TX_WARNINGS
    )
    + "\nUNION ALL"
    + _log_sql("users", "audit.raw_users", "users_critical_suite", _USERS_CRITICAL, _USERS_WARNINGS),
    "median_sketch_rank": """
SELECT product_category, CAST(share AS DOUBLE) AS share, count(*) AS n, true AS within_bound
FROM stg, (SELECT unnest([0.25, 0.5, 0.75]) AS share)
WHERE status = 'COMPLETED' AND amount IS NOT NULL GROUP BY 1, 2""",
    "null_profile_users": """
SELECT count(*) - count(user_id) AS null_ids, count(*) - count(first_name) AS null_first_name,
  count(*) - count(last_name) AS null_last_name, count(*) - count(ip_address) AS null_ips,
  count(*) - count(email) AS null_emails, count(*) AS total FROM raw_users""",
    "null_profile_tx": """
SELECT count(*) - count(user_id) AS null_users, count(*) - count(transaction_id) AS null_ids,
  count(*) AS total FROM dirty""",
    "test_unique": _model_tests_sql("unique"),
    "test_not_null": _model_tests_sql("not_null"),
    "test_accepted_values": _model_tests_sql("accepted_values"),
    "test_accepted_range": _model_tests_sql("accepted_range"),
    "stg_transactions": "SELECT * FROM stg",
    "stg_transactions_minimal": """
SELECT transaction_id, user_id, product_category, amount, currency, transaction_date, status,
  processed_at, data_quality_score FROM tx""",
    "stg_users": """
SELECT *, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name,
  CAST(email IS NOT NULL AS INT) AS is_complete FROM stg_u""",
    "stg_masked_transactions": """
SELECT transaction_id, CASE WHEN length(CAST(user_id AS VARCHAR)) <= 8 THEN '****'
    ELSE left(CAST(user_id AS VARCHAR), 2) || '****' || right(CAST(user_id AS VARCHAR), 4) END
    AS user_id_masked,
  product_category, amount, currency, transaction_date, status FROM stg""",
    "stg_masked_users": """
SELECT user_id, first_name, last_name, CASE WHEN length(email) <= 5 THEN '***'
    ELSE left(email, 2) || '***' || right(email, length(email) - strpos(email, '@') + 1) END
    AS email_masked,
  '***.***.' || split_part(ip_address, '.', 3) || '.' || split_part(ip_address, '.', 4)
    AS ip_address_masked,
  country, registration_date, processed_at FROM stg_u""",
    "user_metrics": f"""
SELECT user_id, total_transactions, active_days, unique_categories, total_amount,
  {_avg("total_amount", "n_amount")} AS avg_transaction_amount, min_transaction_amount,
  max_transaction_amount, median_transaction_amount, stddev_transaction_amount,
  first_transaction_date, last_transaction_date FROM user_sums""",
    "category_metrics": "SELECT * EXCLUDE (n_amount) FROM category_sums",
    "daily_metrics": "SELECT * EXCLUDE (n_amount) FROM day_sums",
    "user_activity": "SELECT * EXCLUDE (amount_count) FROM activity",
    "status_counts": """
SELECT user_id, count(*) FILTER (WHERE status = 'COMPLETED') AS completed_transactions,
  count(*) FILTER (WHERE status = 'FAILED') AS failed_transactions,
  count(*) FILTER (WHERE status = 'PENDING') AS pending_transactions
FROM stg GROUP BY user_id""",
    "rfm_base": """
SELECT user_id, count(DISTINCT transaction_id) AS transaction_count,
  CAST(sum(amount) AS DECIMAL(20,2)) AS total_spent, max(ingested_at) AS last_transaction_date
FROM tx GROUP BY user_id""",
    "user_value_quartile": """
SELECT user_id, total_amount, total_transactions, user_value_quartile
FROM user_sums JOIN user_tiles USING (user_id)""",
    "user_frequency_quartile": """
SELECT user_id, total_amount, total_transactions, user_frequency_quartile
FROM user_sums JOIN user_tiles USING (user_id)""",
    "daily_moving_avg": """
SELECT transaction_day, daily_total_amount, daily_amount_7day_moving_avg FROM day_sums""",
    "txn_seq": """
SELECT t.transaction_id, t.user_id, t.amount, t.currency, u.country AS user_country,
  CAST(row_number() OVER (PARTITION BY t.user_id ORDER BY t.ingested_at, t.transaction_id)
       AS INT) AS txn_seq
FROM tx t LEFT JOIN users u ON t.user_id = u.user_id""",
    "int_transactions": "SELECT * FROM enriched",
    "int_users": "SELECT * FROM people",
    "dim_users": "SELECT * FROM dimension",
    "fct_transactions": "SELECT * FROM facts",
    "fct_users": "SELECT * FROM user_facts",
    "analytics_transactions": f"""
SELECT transaction_id, {_sha("user_id")} AS user_pseudo_id, product_category, amount, currency,
  transaction_date, status, data_quality_score, transaction_day, transaction_quarter,
  user_value_quartile, user_frequency_quartile FROM facts""",
    "analytics_users": f"""
SELECT user_id, CASE WHEN length(full_name) > 2 THEN left(full_name, 1) || '****' ELSE '****' END
    AS user_display_name,
  {_sha("email")} AS pseudo_email, {_sha("ip_address")} AS pseudo_ip_address, country,
  user_age_segment, user_activity_segment, user_trust_level, total_transactions,
  total_lifetime_value, avg_transaction_amount, active_days,
  CAST(date_trunc('month', registration_date) AS DATE) AS cohort_month, last_transaction_date
FROM user_facts""",
    "segment_rollup": """
SELECT customer_segment, churn_risk_level, count(*) AS users FROM dimension GROUP BY 1, 2""",
    "simple_segments": """
SELECT u.user_id, first_name, last_name, CASE WHEN spent > 5000 THEN 'VIP'
  WHEN spent > 1000 THEN 'Premium' ELSE 'Standard' END AS segment
FROM users u LEFT JOIN (SELECT user_id, sum(amount) AS spent FROM tx GROUP BY user_id) s
  ON u.user_id = s.user_id""",
    "mask_rules": f"""
SELECT user_id, {_tail("email", 4)} AS email, {_tail("ip_address", 3)} AS ip_address
FROM raw_users""",
    "mask_rules_transactions": f"""
SELECT {_tail("transaction_id", 4)} AS transaction_id, user_id, amount FROM tx""",
    "mask_email": """
SELECT user_id, CASE WHEN length(email) <= 5 THEN '***' ELSE left(email, 2) || '***'
  || right(email, length(email) - strpos(email, '@') + 1) END AS masked FROM users""",
    "mask_id": """
SELECT transaction_id, left(transaction_id, 2) || '****' || right(transaction_id, 4) AS masked,
  '****' AS masked_user,
  left(CAST(user_id + 1000000000 AS VARCHAR), 2) || '****'
    || right(CAST(user_id + 1000000000 AS VARCHAR), 4) AS masked_long_user
FROM tx""",
    "mask_name": "SELECT user_id, left(first_name, 1) || '***' AS masked FROM users",
    "mask_ip": """
SELECT user_id, '***.***.' || split_part(ip_address, '.', 3) || '.'
  || split_part(ip_address, '.', 4) AS masked FROM users""",
    "pseudonymize_sha": f"""
SELECT user_id, {_sha("user_id")} AS user_pseudonym, {_sha("email")} AS email_pseudonym,
  {_sha("ip_address")} AS ip_pseudonym FROM users""",
    "pseudonymize_md5": f"""
SELECT transaction_id, 'U_' || left(md5('{SALT}' || CAST(user_id AS VARCHAR)), 16) AS pseudonym
FROM tx""",
    "v_dev_transactions": """
SELECT transaction_id, concat('user_', md5(CAST(user_id AS VARCHAR))) AS user_id_masked,
  product_category, amount, currency, transaction_date, status FROM dirty""",
    "v_dev_users": """
SELECT user_id, concat('dev_', md5(first_name)) AS first_name_masked,
  concat('dev_', md5(last_name)) AS last_name_masked,
  concat('user_', md5(coalesce(email, 'NULL'))) AS email_masked,
  concat('ip_', md5(ip_address)) AS ip_address_masked, country, registration_date FROM users""",
    "v_prod_users": """
SELECT user_id, concat('U', left(md5(first_name), 8)) AS first_name_short,
  concat('U', left(md5(last_name), 8)) AS last_name_short, email, ip_address, country,
  registration_date, data_quality_score FROM users""",
    "v_prod_transactions": """
SELECT transaction_id, concat('U', left(md5(CAST(user_id AS VARCHAR)), 8)) AS user_short_id,
  product_category, amount, currency,
  CAST(date_trunc('day', transaction_date) AS TIMESTAMP) AS transaction_day, status FROM tx""",
    "v_analytics_tx": f"""
SELECT transaction_id, {_sha("user_id")} AS user_pseudo_id, product_category, amount, currency,
  transaction_date, status, data_quality_score FROM tx""",
    "v_analytics_users": f"""
SELECT user_id, first_name, last_name, {_sha("email")} AS pseudo_email,
  {_sha("ip_address")} AS pseudo_ip_address, registration_date, country, data_quality_score
FROM users""",
    "encrypt_users": """
SELECT u.user_id, email, ip_address, k.user_id IS NOT NULL AS sealed_differs,
  CASE WHEN k.user_id IS NULL THEN 'no active key' END AS reject_reason
FROM users u LEFT JOIN key_owners k ON u.user_id = k.user_id""",
    "shred_requests": f"""
SELECT k.user_id, e.user_id IS NULL AS is_active, e.user_id IS NOT NULL AS key_destroyed,
  CAST(1 AS INT) AS key_version, {AS_OF} AS created_at,
  CASE WHEN e.user_id IS NOT NULL THEN {AS_OF} END AS revoked_at, e.reason AS revoke_reason
{_AFTER_SHREDDING}""",
    "deletion_requests": f"""
SELECT request_id, user_id, 'deletion' AS request_type, {AS_OF} AS request_date,
  'completed' AS status, {AS_OF} AS completed_at, 'crypto_shredding_script' AS processed_by,
  reason AS notes, 'LDPD Art. 12 / GDPR Art. 17' AS legal_reference FROM requests""",
    "deletion_status": f"""
SELECT u.user_id, k.user_id IS NOT NULL AS found,
  CASE WHEN k.user_id IS NOT NULL THEN r.user_id IS NULL END AS key_active,
  CASE WHEN k.user_id IS NOT NULL AND r.user_id IS NOT NULL THEN {AS_OF} END AS key_revoked,
  CASE WHEN k.user_id IS NOT NULL AND r.user_id IS NOT NULL THEN 'completed' END
    AS deletion_status,
  CASE WHEN k.user_id IS NOT NULL AND r.user_id IS NOT NULL THEN {AS_OF} END AS completed_at,
  CASE WHEN k.user_id IS NOT NULL THEN r.notes END AS notes
FROM users u LEFT JOIN key_owners k ON u.user_id = k.user_id
  LEFT JOIN (SELECT user_id, arg_max(reason, request_id) AS notes FROM requests GROUP BY 1) r
    ON u.user_id = r.user_id""",
    "decrypt_after_shred": """
SELECT u.user_id, CASE WHEN e.user_id IS NULL THEN email END AS email,
  CASE WHEN e.user_id IS NULL THEN ip_address END AS ip_address
FROM users u JOIN key_owners k ON u.user_id = k.user_id
  LEFT JOIN erased e ON u.user_id = e.user_id""",
    "decrypt_old_version": """
SELECT u.user_id, email, ip_address, CAST(1 AS INT) AS key_version
FROM users u JOIN key_owners k ON u.user_id = k.user_id""",
    "key_rotation": """
SELECT u.user_id, email, ip_address, CAST(1 + (u.user_id % 3 = 0)::INT AS INT) AS key_version,
  CAST(1 + (u.user_id % 3 = 0)::INT AS INT) AS newest_version, 1 AS keys_left,
  CASE WHEN ip_address IS NOT NULL THEN u.user_id % 3 <> 0 END AS untouched
FROM users u JOIN key_owners k ON u.user_id = k.user_id""",
    "keys_second_batch": f"""
SELECT user_id, CAST(1 AS INT) AS key_version, user_id % 8 <> 0 AS is_active,
  CASE WHEN user_id % 4 < 2 THEN {AS_OF} ELSE {FRESH_AS_OF} END AS created_at,
  CASE WHEN user_id % 8 = 0 THEN 'left' END AS revoke_reason, user_id % 8 <> 0 AS has_key,
  CASE WHEN user_id % 4 < 2 AND user_id % 8 <> 0 THEN true END AS same_key
FROM users WHERE user_id % 4 < 3
UNION ALL
SELECT user_id, CAST(2 AS INT), true, {FRESH_AS_OF}, NULL, true, NULL FROM users WHERE user_id % 8 = 0""",
    "quality_dashboard": """
SELECT CAST(ingested_at AS DATE) AS fecha, count(*) AS total_registros,
  count(*) FILTER (WHERE amount < 0) AS registros_monto_negativo,
  count(*) FILTER (WHERE amount IS NULL) AS registros_monto_nulo,
  count(*) FILTER (WHERE user_id IS NULL) AS registros_user_nulo,
  round(CAST(100 * count(*) FILTER (WHERE amount >= 0) AS DOUBLE) / count(*), 2)
    AS porcentaje_calidad
FROM dirty GROUP BY 1""",
    "freshness_dashboard": f"""
SELECT table_name, last_data_arrival,
  round(CAST(epoch_us({FRESH_AS_OF}) - epoch_us(last_data_arrival) AS DOUBLE) / 1e6 / 60, 4)
    AS minutes_since_last_update,
  CASE WHEN last_data_arrival > {FRESH_AS_OF} - INTERVAL '2' HOUR THEN 'FRESH'
       WHEN last_data_arrival > {FRESH_AS_OF} - INTERVAL '6' HOUR THEN 'STALE'
       ELSE 'MISSING' END AS freshness_status
FROM (SELECT table_name, max(actual_arrival_time) AS last_data_arrival
      FROM monitor GROUP BY table_name)""",
    "freshness_check": "\nUNION ALL".join(
        f"""
SELECT '{name}' AS table_name, {FRESH_AS_OF} - INTERVAL '2' HOUR AS expected_arrival_time,
  latest AS actual_arrival_time, round(lag_us / 1e6 / 3600, 2) AS lag_hours,
  CASE WHEN lag_us < 2 * 3600 * 1e6 THEN 'FRESH' WHEN lag_us < 6 * 3600 * 1e6 THEN 'STALE'
       ELSE 'MISSING' END AS status,
  {FRESH_AS_OF} AS check_timestamp, CAST(120 AS INT) AS threshold_minutes
FROM (SELECT max(ingested_at) AS latest,
        CAST(epoch_us({FRESH_AS_OF}) - epoch_us(max(ingested_at)) AS DOUBLE) AS lag_us
      FROM {table} WHERE ingested_at >= {FRESH_AS_OF} - INTERVAL '24' HOUR)"""
        for name, table in (("audit.raw_transactions", "tx"), ("audit.raw_users", "raw_users"))
    ),
    "zone_reload": """
SELECT transaction_id, user_id, CASE WHEN day(ingested_at) % 2 = 0 THEN -amount ELSE amount END AS amount,
  ingested_at FROM tx""",
    "schema_evolution": """
SELECT transaction_id, CAST(user_id AS BIGINT) AS customer_id, amount,
  CASE WHEN user_id % 3 = 0 THEN 'USD' ELSE currency END AS currency,
  CASE WHEN amount > 50 THEN 'large' ELSE 'small' END AS size
FROM tx WHERE user_id IS NOT NULL""",
    "email_completeness": """
SELECT count(*) AS total_users, count(*) - count(email) AS null_emails,
  round(CAST(100 * (count(*) - count(email)) AS DOUBLE) / count(*), 2) AS null_pct FROM users""",
    "column_profile": """
SELECT count(*) AS total_rows,
  round(CAST(count(*) - count(transaction_id) AS DOUBLE) / count(*), 6) AS null_rate,
  round(CAST(count(DISTINCT transaction_id) AS DOUBLE) / count(*), 6) AS uniqueness_rate,
  min(ingested_at) AS earliest_record, max(ingested_at) AS latest_record FROM dirty""",
    "hash_shape": f"""
SELECT user_id, starts_with({_sha("email")}, 'a') AS is_hashed_email,
  CAST(length({_sha("email")}) AS INT) AS hash_length FROM users""",
    "latest_validation_logs": """
SELECT * FROM logs WHERE table_name = 'click'
ORDER BY validation_timestamp DESC, success_rate DESC LIMIT 5""",
    "latest_snapshot": """
SELECT l.* FROM schema_log l JOIN (SELECT schema_name, table_name, max(check_timestamp) AS last
  FROM schema_log GROUP BY 1, 2) m ON l.schema_name = m.schema_name
  AND l.table_name = m.table_name AND l.check_timestamp = m.last""",
    "schema_drift": """
SELECT * FROM (
  SELECT coalesce(b.schema_name, n.schema_name) AS schema_name,
    coalesce(b.table_name, n.table_name) AS table_name,
    coalesce(b.column_name, n.column_name) AS column_name, b.type AS old_type, n.type AS new_type,
    CASE WHEN b.type IS NULL THEN 'new_column' WHEN n.type IS NULL THEN 'removed_column'
         WHEN b.type <> n.type THEN 'type_change' END AS change
  FROM schema_before b FULL JOIN (SELECT * FROM schema_now
      WHERE table_name IN (SELECT table_name FROM schema_before)) n
    ON b.table_name = n.table_name AND b.column_name = n.column_name)
WHERE change IS NOT NULL""",
    "schema_history_append": """
SELECT 'lake' AS schema_name, c.table_name, c.schema_json,
  l.table_name IS NOT NULL AS drift_detected,
  '{"new_columns":[' || coalesce(added, '') || '],"removed_columns":[' || coalesce(removed, '')
    || '],"type_changes":[' || coalesce(retyped, '') || ']}' AS changes_json,
  TIMESTAMP '2024-02-01 00:00:00' AS check_timestamp
FROM (SELECT table_name, '{' || string_agg('"' || column_name || '":{"type":"' || type
      || '","nullable":' || CAST(nullable AS VARCHAR) || '}', ',' ORDER BY column_name) || '}'
      AS schema_json
    FROM schema_columns GROUP BY table_name) c
  LEFT JOIN schema_lists l ON c.table_name = l.table_name""",
    "lineage_record": f"""
SELECT dag_execution_id, lineage_type, node_id, node_name, node_type, schema_name, table_name,
  description, source_id, target_id, transformation,
  {AS_OF} AS created_at FROM lineage""",
    "lineage_view": """
SELECT e.dag_execution_id, s.node_name AS source, e.transformation, t.node_name AS target,
  s.node_type AS source_type, t.node_type AS target_type
FROM lineage e JOIN lineage s ON e.source_id = s.node_id
    AND e.dag_execution_id = s.dag_execution_id
  JOIN lineage t ON e.target_id = t.node_id AND e.dag_execution_id = t.dag_execution_id
WHERE e.lineage_type = 'edge'""",
    "pii_catalog_upsert": "SELECT * FROM catalog_after",
    "pii_catalog": """
SELECT schema_name || '.' || table_name AS full_table, column_name, pii_category, pii_sensitivity,
  protection_method, access_restriction, retention_days, legal_basis FROM catalog_after""",
}

# numbers taken while a table is written, and metrics advanced batch by batch, change nothing
# Which columns of the published transactions each column of a model is made of.
_MADE_OF = {
    ("stg_raw_transactions", "stg"): {
        **{
            c: [c]
            for c in (
                "transaction_id", "user_id", "product_category", "currency", "amount", "transaction_date",
                "status", "processed_at", "data_quality_score",
            )
        },
        **{
            c: ["transaction_date"]
            for c in (
                "transaction_day", "transaction_year", "transaction_month", "transaction_day_of_month",
                "transaction_day_of_week", "transaction_hour", "is_weekend",
            )
        },
        "data_quality_tier": ["data_quality_score"],
        "transaction_value_tier": ["amount"],
        "is_anomaly": ["amount"],
        "dbt_transformed_at": [None],
    },
    ("user_metrics", f"({TEXTS['user_metrics']})"): {
        "user_id": ["user_id"],
        "total_transactions": ["status"],
        "active_days": ["status", "transaction_date"],
        "unique_categories": ["status", "product_category"],
        "total_amount": ["status", "amount"],
        "avg_transaction_amount": ["status", "amount"],
        "min_transaction_amount": ["amount"],
        "max_transaction_amount": ["amount"],
        "median_transaction_amount": ["amount"],
        "stddev_transaction_amount": ["amount"],
        "first_transaction_date": ["status", "transaction_date"],
        "last_transaction_date": ["status", "transaction_date"],
    },
}
TEXTS["column_lineage"] = "\nUNION ALL".join(
    f"""
SELECT '{model}' AS model, '{column}' AS column_name,
  {"'prod.raw_transactions'" if source else "NULL"} AS source_table,
  {f"'{source}'" if source else "NULL"} AS source_column, count({column}) AS n_values FROM {rows}"""
    for (model, rows), columns in _MADE_OF.items()
    for column, sources in columns.items()
    for source in sources
)
TEXTS["freshness_partitioned"] = TEXTS["freshness_check"]
TEXTS["dq_combined_log_observed"] = TEXTS["dq_combined_log"]
for _name in ("user_metrics", "category_metrics", "daily_metrics"):
    TEXTS[f"{_name}_advanced"] = TEXTS[_name]

ORACLE = {name: with_models(text) for name, text in TEXTS.items()}
