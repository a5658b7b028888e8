"""The four suites of the pipeline.

Checked columns, sets, patterns, bounds and shares are fixed values; suites of a
deployment may be loaded from JSON instead, see `operators.quality.load_suite`.
"""

from __future__ import annotations

from ..operators import quality as Q

UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_DATE_START = r"^\d{4}-\d{2}-\d{2}"
IPV4_LOOSE = r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)"
IPV4 = rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
CURRENCIES = ["USD", "EUR", "GBP"]
STATUSES = ["COMPLETED", "PENDING", "FAILED"]


def _critical(kind: str, text: str, **kwargs) -> Q.Expectation:
    return Q.Expectation(kind, kwargs, text, "CRITICAL")


def _warning(kind: str, text: str, **kwargs) -> Q.Expectation:
    return Q.Expectation(kind, kwargs, text, "WARNING")


TRANSACTIONS_CRITICAL = Q.Suite(
    "transactions_critical_suite",
    [
        _critical(Q.ROW_COUNT, "table has rows", min_value=1),
        _critical(Q.NOT_NULL, "user_id is set", column="user_id"),
        _critical(Q.NOT_NULL, "transaction_id is set", column="transaction_id"),
        _critical(Q.UNIQUE, "transaction_id is unique", column="transaction_id"),
        _critical(Q.IN_SET, "currency is known", column="currency", value_set=CURRENCIES, mostly=1.0),
        _critical(Q.IN_SET, "status is known", column="status", value_set=STATUSES),
        _critical(Q.REGEX, "transaction_id is a UUID", column="transaction_id", regex=UUID),
    ],
)

TRANSACTIONS_WARNINGS = Q.Suite(
    "transactions_warnings_suite",
    [
        _warning(
            Q.BETWEEN, "amount is positive and plausible",
            column="amount", min_value=0.01, max_value=100000, mostly=0.99,
        ),
        # misspelt on purpose: this suite is known to report an unsupported type
        _warning(
            "expect_column_values_to_be_match_regex", "transaction_id is a UUID",
            column="transaction_id", regex=UUID,
        ),
    ],
)

USERS_CRITICAL = Q.Suite(
    "users_critical_suite",
    [
        _critical(Q.ROW_COUNT, "table has rows", min_value=1),
        _critical(Q.NOT_NULL, "user_id is set", column="user_id"),
        _critical(Q.UNIQUE, "user_id is unique", column="user_id"),
        _critical(Q.NOT_NULL, "first_name is set", column="first_name"),
        _critical(Q.NOT_NULL, "last_name is set", column="last_name"),
        _critical(Q.REGEX, "registration_date is a date", column="registration_date", regex=ISO_DATE),
        _critical(Q.REGEX, "ip_address looks like IPv4", column="ip_address", regex=IPV4_LOOSE),
        _critical(Q.NOT_NULL, "ip_address is set", column="ip_address"),
        _critical(
            Q.REGEX, "registration_date starts with a date",
            column="registration_date", regex=ISO_DATE_START,
        ),
        _critical(Q.REGEX, "ip_address is IPv4", column="ip_address", regex=IPV4),
    ],
)

USERS_WARNINGS = Q.Suite(
    "users_warnings_suite",
    [
        _warning(Q.NOT_NULL, "email is mostly set", column="email", mostly=0.95),
        _warning(Q.REGEX, "email is well formed", column="email", regex=EMAIL, mostly=0.95),
        _warning(Q.LENGTH, "first_name has 1-50 characters", column="first_name", min_value=1, max_value=50),
        _warning(Q.LENGTH, "last_name has 1-50 characters", column="last_name", min_value=1, max_value=50),
        _warning(Q.LENGTH, "country has 2-50 characters", column="country", min_value=2, max_value=50),
    ],
)

SUITES = {
    s.name: s
    for s in (TRANSACTIONS_CRITICAL, TRANSACTIONS_WARNINGS, USERS_CRITICAL, USERS_WARNINGS)
}


def suite(name: str) -> Q.Suite:
    if name not in SUITES:
        raise Q.MissingSuite(name)
    return SUITES[name]
