"""Masks for identifiers, e-mails, names and addresses; salted pseudonyms.

`strict` masks a value wholly where the plain rule would show all of it: values
no longer than the visible part, and e-mails without an at sign.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

SALT_SETTING = "spark.tidegate.pii.salt"
# Fixed value: the salt of MD5 pseudonyms where none is given.
DEFAULT_SALT = "DEFAULT_SALT_CHANGE_ME"

# Rule types and the columns they mask by default.
TAIL_RULES = {"mask_email", "mask_ip_address", "mask_transaction_id"}
DEFAULT_RULES = {
    "fields": {
        "transaction_id": {
            "type": "mask_transaction_id",
            "params": {"visible_digits": 4, "mask_char": "*"},
        },
        "email": {"type": "mask_email", "params": {"visible_digits": 4, "mask_char": "*"}},
        "ip_address": {
            "type": "mask_ip_address",
            "params": {"visible_digits": 3, "mask_char": "*"},
        },
    },
    "default_action": "keep_original",
}


def keep_tail(value: Column, visible: int, mask_char: str = "*", strict: bool = True) -> Column:
    """Mask all but the last `visible` characters; the length stays the same."""
    text = value.cast("string")
    size = F.length(text)
    hidden = F.greatest(F.lit(0), size - F.lit(visible))
    if strict:
        hidden = F.when(size <= visible, size).otherwise(hidden)
    return F.concat(
        F.repeat(F.lit(mask_char), hidden),
        F.right(text, size - hidden),
    )


def apply_rules(
    df: DataFrame,
    rules: dict,
    strict: bool = True,
    known_types: set[str] = frozenset(TAIL_RULES),
    default_visible: int = 3,
) -> DataFrame:
    """Mask each column a rule names; unknown rule types warn and change nothing."""
    masked = {}
    for name, rule in rules.get("fields", {}).items():
        if name not in df.columns:
            continue
        if rule["type"] not in known_types:
            log.warning("masking rule %s for column %s is unknown", rule["type"], name)
            continue
        params = rule.get("params", {})
        masked[name] = keep_tail(
            F.col(name),
            int(params.get("visible_digits", default_visible)),
            params.get("mask_char", "*"),
            strict,
        )
    return df.withColumns(masked) if masked else df


def apply_transaction_rules(df: DataFrame, rules: dict, strict: bool = True) -> DataFrame:
    """The narrower rule set: transaction ids only, four characters by default."""
    return apply_rules(df, rules, strict, {"mask_transaction_id"}, default_visible=4)


def mask_email(email: Column, strict: bool = True) -> Column:
    at = F.locate("@", email)
    from_at = F.right(email, F.length(email) - at + F.lit(1))
    shown = F.concat(F.left(email, F.lit(2)), F.lit("***"), from_at)
    hide = F.length(email) <= 5
    if strict:
        hide = hide | (at == 0)
    return F.when(hide, F.lit("***")).otherwise(shown)


def mask_id(value: Column) -> Column:
    text = value.cast("string")
    return F.when(F.length(text) <= 8, F.lit("****")).otherwise(
        F.concat(F.left(text, F.lit(2)), F.lit("****"), F.right(text, F.lit(4)))
    )


def mask_name(name: Column) -> Column:
    return F.concat(F.left(name, F.lit(1)), F.lit("***"))


def mask_ip(ip: Column) -> Column:
    octet = lambda n: F.split_part(ip, F.lit("."), F.lit(n))
    return F.concat(F.lit("***.***."), octet(3), F.lit("."), octet(4))


def session_salt(spark: SparkSession) -> str:
    """The session's salt. There is no default: a known salt hides nothing."""
    salt = spark.conf.get(SALT_SETTING, None)
    if not salt:
        raise ValueError(f"set a salt: Config.salt or {SALT_SETTING}")
    return salt


def pseudonym_sha(value: Column, salt: str) -> Column:
    """Hex SHA-256 of value and salt; NULL stays NULL."""
    return F.sha2(F.concat(value.cast("string"), F.lit(salt)), 256)


def pseudonym_md5(value: Column, salt: str = DEFAULT_SALT) -> Column:
    """`U_` and half the MD5 of salt and value; NULL stays NULL."""
    digest = F.md5(F.concat(F.lit(salt), value.cast("string")))
    return F.concat(F.lit("U_"), F.left(digest, F.lit(16)))
