"""Encryption with one key per user, and erasure by destroying the key.

Keys lie in a table of their own, of which only the newest snapshot exists; they are never
staged. Spark's shuffle files hold key bytes until the session ends: switch
`spark.io.encryption.enabled` on where that matters.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import moment
from ..operators.skew import heavy_keys, salted_left_join
from ..runtime import ship_package
from ..schemas import ENCRYPTION_KEYS
from ..sources.tables import SnapshotTable

KEY_BYTES = 16
# Who processes requests, and on what legal ground.
PROCESSOR = "crypto_shredding_script"
# Why a version that was replaced is no longer active.
ROTATED = "rotated"
LEGAL_REFERENCE = "LDPD Art. 12 / GDPR Art. 17"


def _draw_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for users in batches:
        drawn = secrets.token_bytes(KEY_BYTES * len(users))
        keys = [drawn[k : k + KEY_BYTES] for k in range(0, len(drawn), KEY_BYTES)]
        yield users.assign(encryption_key=keys)


def _columns() -> list[str]:
    return [f.name for f in ENCRYPTION_KEYS.fields]


def _drawn(users: DataFrame, as_of: datetime) -> DataFrame:
    """An active key for each line of `user_id, key_version`."""
    drawn = users.mapInPandas(_draw_keys, "user_id int, key_version int, encryption_key binary")
    return drawn.withColumns(
        {
            "created_at": moment(as_of),
            "revoked_at": F.lit(None).cast("timestamp_ntz"),
            "revoke_reason": F.lit(None).cast("string"),
            "is_active": F.lit(True),
        }
    ).select(_columns())


def _wanted(user_ids: DataFrame) -> DataFrame:
    return user_ids.select(F.col("user_id").cast("int")).where("user_id IS NOT NULL").distinct()


def generate_keys(user_ids: DataFrame, as_of: datetime, table: SnapshotTable) -> DataFrame:
    """An active key for each user who has none; all keys of the table stay.

    A user whose keys were all revoked gets the next version: numbers are never given twice,
    so rows sealed before stay unreadable. Written to `table` at once, since a second
    evaluation would draw other keys.
    """
    spark = user_ids.sparkSession
    ship_package(spark)
    keys = table.read(spark, ENCRYPTION_KEYS)
    held = keys.groupBy("user_id").agg(
        F.max("key_version").alias("_version"), F.bool_or("is_active").alias("_active")
    )
    lacking = _wanted(user_ids).join(held, "user_id", "left").where("NOT coalesce(_active, false)")
    version = (F.coalesce("_version", F.lit(0)) + 1).cast("int").alias("key_version")
    table.replace(keys.unionByName(_drawn(lacking.select("user_id", version), as_of)))
    return table.read(spark, ENCRYPTION_KEYS)


def rotate_keys(user_ids: DataFrame, as_of: datetime, table: SnapshotTable) -> DataFrame:
    """The next version of the key for each of these users who has an active one.

    The version before is no longer active, but keeps its bytes until `drop_unused` finds
    no row sealed with it; users without an active key stay as they are.
    """
    spark = user_ids.sparkSession
    ship_package(spark)
    keys = table.read(spark, ENCRYPTION_KEYS)
    mine = _wanted(user_ids).withColumn("_hit", F.lit(True))
    joined = keys.join(mine, "user_id", "left")
    retire = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("is_active")
    before = joined.withColumns(
        {
            "revoked_at": F.when(retire, moment(as_of)).otherwise(F.col("revoked_at")),
            "revoke_reason": F.when(retire, F.lit(ROTATED)).otherwise(F.col("revoke_reason")),
            "is_active": F.col("is_active") & ~retire,
        }
    ).select(keys.columns)
    versions = keys.groupBy("user_id").agg(
        F.max("key_version").alias("_version"), F.bool_or("is_active").alias("_active")
    )
    due = mine.join(versions.where("_active"), "user_id")
    version = (F.col("_version") + 1).cast("int").alias("key_version")
    table.replace(before.unionByName(_drawn(due.select("user_id", version), as_of)))
    return table.read(spark, ENCRYPTION_KEYS)


def drop_unused(table: SnapshotTable, sealed: DataFrame) -> DataFrame:
    """Remove the bytes of rotated versions that no row of `sealed` names any more."""
    spark = sealed.sparkSession
    keys = table.read(spark, ENCRYPTION_KEYS)
    used = sealed.select("user_id", "key_version").distinct().withColumn("_used", F.lit(True))
    joined = keys.join(used, ["user_id", "key_version"], "left")
    unused = F.col("_used").isNull() & (F.col("revoke_reason") == ROTATED)
    bytes_ = F.when(unused, F.lit(None)).otherwise(F.col("encryption_key"))
    table.replace(joined.withColumn("encryption_key", bytes_).select(keys.columns))
    return table.read(spark, ENCRYPTION_KEYS)


def _with_active_key(data: DataFrame, keys: DataFrame, spread: str) -> DataFrame:
    """Add each user's newest active key and its version."""
    active = keys.where("is_active AND encryption_key IS NOT NULL")
    newest = active.groupBy("user_id").agg(
        F.max(F.struct("key_version", "encryption_key")).alias("_newest")
    )
    newest = newest.select(
        "user_id", F.col("_newest.encryption_key").alias("_key"), F.col("_newest.key_version")
    )
    return salted_left_join(data, newest, "user_id", heavy_keys(data, "user_id"), F.col(spread))


def _bound_to(column: str):
    """What a sealed value is bound to: moved to another user, version or column it stays shut."""
    return F.concat_ws(
        ":", F.col("user_id").cast("string"), F.col("key_version").cast("string"), F.lit(column)
    )


def _seal(column: str):
    random_start = F.lit("")
    return F.aes_encrypt(
        F.col(column).cast("string"), F.col("_key"), F.lit("GCM"), F.lit("DEFAULT"),
        random_start, _bound_to(column),
    )


def _open(column: str):
    return F.try_aes_decrypt(
        F.col(column), F.col("_key"), F.lit("GCM"), F.lit("DEFAULT"), _bound_to(column)
    ).cast("string")


def encrypt(
    data: DataFrame, keys: DataFrame, columns: list[str], spread: str = "user_id"
) -> tuple[DataFrame, DataFrame]:
    """Encrypt `columns` with each user's active key; rows without one are returned apart.

    Sealed rows get the key's version in `key_version`. `data` may hold many rows of a user;
    name in `spread` a column that differs between them, by which the rows of a user who
    holds many are dealt over the tasks.
    """
    joined = _with_active_key(data, keys, spread)
    sealed = joined.where("_key IS NOT NULL").withColumns({c: _seal(c) for c in columns})
    rejected = joined.where("_key IS NULL").drop("_key", "key_version")
    return sealed.drop("_key"), rejected.withColumn("reject_reason", F.lit("no active key"))


def _with_own_key(sealed: DataFrame, keys: DataFrame, spread: str) -> DataFrame:
    """Add the key of the version that sealed the row, active or not; NULL if its bytes are gone."""
    held = keys.where("encryption_key IS NOT NULL").select(
        F.struct("user_id", "key_version").alias("_sealed_by"), F.col("encryption_key").alias("_key")
    )
    named = sealed.withColumn("_sealed_by", F.struct("user_id", "key_version"))
    heavy = heavy_keys(named, "_sealed_by")
    return salted_left_join(named, held, "_sealed_by", heavy, F.col(spread)).drop("_sealed_by")


def decrypt(
    sealed: DataFrame, keys: DataFrame, columns: list[str], spread: str = "user_id"
) -> DataFrame:
    """Read `columns` back with the version that sealed each row; NULL where its key is gone."""
    opened = _with_own_key(sealed, keys, spread)
    return opened.withColumns({c: _open(c) for c in columns}).drop("_key")


def reseal(
    sealed: DataFrame, keys: DataFrame, columns: list[str], spread: str = "user_id"
) -> DataFrame:
    """Rows sealed with an older version, sealed with their user's active one instead.

    Other rows stay as they are, also those whose key is gone or whose user has none now.
    """
    active = keys.where("is_active AND encryption_key IS NOT NULL").groupBy("user_id").agg(
        F.max(F.struct("key_version", "encryption_key")).alias("_now")
    )
    held = _with_own_key(sealed, keys, spread)
    both = salted_left_join(held, active, "user_id", heavy_keys(sealed, "user_id"), F.col(spread))
    due = F.coalesce(
        F.col("_key").isNotNull() & (F.col("_now.key_version") > F.col("key_version")), F.lit(False)
    )
    opened = both.withColumns({"_due": due, **{f"_open_{c}": _open(c) for c in columns}})
    moved = opened.withColumns(
        {
            "key_version": F.when(due, F.col("_now.key_version")).otherwise(F.col("key_version")),
            "_key": F.col("_now.encryption_key"),
        }
    )
    again = {
        c: F.when(
            F.col("_due"),
            F.aes_encrypt(
                F.col(f"_open_{c}"), F.col("_key"), F.lit("GCM"), F.lit("DEFAULT"), F.lit(""), _bound_to(c)
            ),
        ).otherwise(F.col(c))
        for c in columns
    }
    return moved.withColumns(again).select(sealed.columns)


def register_requests(users: DataFrame, as_of: datetime) -> DataFrame:
    """Deletion requests for `user_id, request_id, reason`."""
    return users.select(
        F.col("request_id").cast("string").alias("request_id"),
        F.col("user_id").cast("int").alias("user_id"),
        F.lit("deletion").alias("request_type"),
        moment(as_of).alias("request_date"),
        F.lit("processing").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit(None).cast("string").alias("processed_by"),
        F.col("reason").alias("notes"),
        F.lit(LEGAL_REFERENCE).alias("legal_reference"),
    )


def shred(
    table: SnapshotTable, requests: DataFrame, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """Carry out the requests on the key table; returns the keys and the requests after it.

    The active key of a requesting user is revoked, and the bytes of all versions are removed:
    the snapshot that held them is deleted, so nothing encrypted with them can be read again,
    and frames over the keys before cannot be read either. Many requests of one user combine to one
    line before they meet the keys.
    """
    spark = requests.sparkSession
    keys = table.read(spark, ENCRYPTION_KEYS)
    wanted = requests.groupBy("user_id").agg(F.max("notes").alias("_reason"), F.lit(True).alias("_hit"))
    joined = keys.join(wanted, "user_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    revoke = hit & F.col("is_active")
    swap = lambda new, old: F.when(revoke, new).otherwise(F.col(old))
    after = joined.withColumns(
        {
            "encryption_key": F.when(hit, F.lit(None)).otherwise(F.col("encryption_key")),
            "revoked_at": swap(moment(as_of), "revoked_at"),
            "revoke_reason": swap(F.col("_reason"), "revoke_reason"),
            "is_active": F.col("is_active") & ~revoke,
        }
    ).select(keys.columns)
    table.replace(after)
    done = requests.withColumns(
        {
            "status": F.lit("completed"),
            "completed_at": moment(as_of),
            "processed_by": F.lit(PROCESSOR),
        }
    )
    return table.read(spark, ENCRYPTION_KEYS), done


def deletion_status(ids: DataFrame, keys: DataFrame, requests: DataFrame) -> DataFrame:
    """State of the newest key and last completed request for each id; `found`: it has a key."""
    completed = (
        requests.where(F.col("status") == "completed")
        .groupBy("user_id")
        .agg(F.max(F.struct("completed_at", "request_id", "notes")).alias("_last"))
    )
    newest = F.max(F.struct("key_version", "is_active", "revoked_at")).alias("_newest")
    known = keys.groupBy("user_id").agg(newest).select(
        "user_id",
        F.col("_newest.is_active").alias("key_active"),
        F.col("_newest.revoked_at").alias("key_revoked"),
        F.lit(True).alias("_found"),
    )
    found = F.coalesce(F.col("_found"), F.lit(False))
    shown = lambda c: F.when(found, F.col(c))
    return (
        ids.select("user_id")
        .distinct()
        .join(known, "user_id", "left")
        .join(completed, "user_id", "left")
        .select(
            "user_id",
            found.alias("found"),
            "key_active",
            "key_revoked",
            F.when(found & F.col("_last").isNotNull(), F.lit("completed")).alias("deletion_status"),
            shown("_last.completed_at").alias("completed_at"),
            shown("_last.notes").alias("notes"),
        )
    )
