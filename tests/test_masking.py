import random
import string

import pytest
from pyspark.sql import functions as F

from tidegate.functions import masking as M

RULE = {"type": "mask_email", "params": {"visible_digits": 4, "mask_char": "#"}}


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def masked(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_tail_keeps_length_and_hides_something(spark):
    rng = random.Random(3)
    values = ["".join(rng.choices(string.printable, k=rng.randint(1, 40))) for _ in range(300)]
    df = texts(spark, values)
    for raw, out in zip(values, masked(df, M.keep_tail(F.col("x"), 4))):
        assert len(out) == len(raw)
        hidden = len(raw) if len(raw) <= 4 else len(raw) - 4
        assert out[:hidden] == "*" * hidden and out[hidden:] == raw[hidden:]


def test_loose_tail_shows_short_values(spark):
    df = texts(spark, ["abc", "abcd", "abcde", None])
    assert masked(df, M.keep_tail(F.col("x"), 4, strict=False)) == ["abc", "abcd", "*bcde", None]
    assert masked(df, M.keep_tail(F.col("x"), 4)) == ["***", "****", "*bcde", None]


def test_rules_pick_columns_and_ignore_unknown_types(spark, caplog):
    df = spark.createDataFrame([("someone@x.org", "keep")], "email string, other string")
    rules = {"fields": {"email": RULE, "other": {"type": "shuffle"}, "absent": RULE}}
    assert M.apply_rules(df, rules).first() == ("#########.org", "keep")
    assert "shuffle" in caplog.text


def test_narrow_rules_mask_ids_only(spark):
    df = spark.createDataFrame([("0123456789", "a@b.org")], "transaction_id string, email string")
    assert M.apply_transaction_rules(df, M.DEFAULT_RULES).first() == ("******6789", "a@b.org")


def test_rule_without_params_shows_three(spark):
    df = spark.createDataFrame([("123456",)], "ip_address string")
    rules = {"fields": {"ip_address": {"type": "mask_ip_address"}}}
    assert M.apply_rules(df, rules).first()[0] == "***456"


def test_email(spark):
    df = texts(spark, ["ab@cd", "anna@mail.org", "no-at-sign", None])
    assert masked(df, M.mask_email(F.col("x"))) == ["***", "an***@mail.org", "***", None]
    loose = masked(df, M.mask_email(F.col("x"), strict=False))
    assert loose[2] == "no***no-at-sign"


def test_ids_names_addresses(spark):
    df = texts(spark, ["12345678", "123456789", None])
    assert masked(df, M.mask_id(F.col("x"))) == ["****", "12****6789", None]
    assert masked(texts(spark, ["Ana", "", None]), M.mask_name(F.col("x"))) == ["A***", "***", None]
    ips = masked(texts(spark, ["10.20.30.40", "masked", None]), M.mask_ip(F.col("x")))
    assert ips == ["***.***.30.40", "***.***..", None]


def test_pseudonyms(spark):
    import hashlib

    df = spark.createDataFrame([(7,), (None,)], "id int")
    sha = masked(df, M.pseudonym_sha(F.col("id"), "salt"))
    assert sha == [hashlib.sha256(b"7salt").hexdigest(), None]
    md5 = masked(df, M.pseudonym_md5(F.col("id"), "salt"))
    assert md5 == ["U_" + hashlib.md5(b"salt7").hexdigest()[:16], None]


def test_salt_comes_from_the_session(spark):
    with pytest.raises(ValueError):
        M.session_salt(spark)
    spark.conf.set(M.SALT_SETTING, "own")
    try:
        assert M.session_salt(spark) == "own"
    finally:
        spark.conf.unset(M.SALT_SETTING)
