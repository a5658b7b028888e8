"""Publish: clean, score, keep one row per key, leave out published keys, mask, append."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.masking import apply_rules, pseudonym_sha
from ..functions.scalars import moment
from ..operators import skew
from ..operators.skew import known_keys, latest_per_key, measure
from ..runtime import brief_shuffles, discard, stage, stage_parts, staged_run
from ..schemas import PUBLISHED_TRANSACTIONS, PUBLISHED_USERS
from ..sources import tables
from ..sources.committed import COMPACT, CommittedTable, bucket_of

#: Raw rows of a round, about, where a batch is published to an indexed table in rounds.
ROUND_ROWS = 1 << 23
REQUIRED_OF_USERS = ("user_id", "email", "first_name", "last_name", "country")


def clean_transactions(raw: DataFrame) -> DataFrame:
    return raw.where(
        (F.col("status") == "COMPLETED") & (F.col("amount") > 0) & F.col("user_id").isNotNull()
    )


def clean_users(raw: DataFrame, required: tuple[str, ...] = REQUIRED_OF_USERS) -> DataFrame:
    return raw.dropna(subset=list(required))


def score(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumns(
        {
            "processed_at": moment(as_of),
            "data_quality_score": F.lit(Decimal("1.00")).cast("decimal(3,2)"),
        }
    )


@dataclass(frozen=True)
class Entity:
    """What sets the two published tables apart.

    `published_key` identifies a row in the published table. Masked ids no longer
    do, so transactions carry a salted hash of the raw id for it.
    """

    table: str
    key: str
    published_key: str
    clean: Callable[[DataFrame], DataFrame]
    schema: StructType


TRANSACTIONS = Entity(
    "raw_transactions", "transaction_id", "transaction_key", clean_transactions,
    PUBLISHED_TRANSACTIONS,
)
USERS = Entity("raw_users", "user_id", "user_id", clean_users, PUBLISHED_USERS)


def one_per_key(entity: Entity, raw: DataFrame, as_of: datetime, salt: str) -> DataFrame:
    """Clean, scored rows with their published key: the latest arrival of each raw key."""
    rows = latest_per_key(entity.clean(raw), [entity.key], ["ingested_at"])
    rows = score(rows, as_of)
    if entity.published_key not in rows.columns:
        rows = rows.withColumn(entity.published_key, pseudonym_sha(F.col(entity.key), salt))
    return rows


def not_published(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return rows.join(known, key, "left_anti")


def audit_refusal(audit: dict | bool | None) -> str | None:
    """Why nothing may be published, or None."""
    if audit is None:
        return "audit_result_missing"
    passed = audit.get("audit_passed", False) if isinstance(audit, dict) else bool(audit)
    return None if passed else "audit_failed"


def _marked(rows: DataFrame, published: DataFrame, key: str, label: str) -> tuple[DataFrame, int, int]:
    """The unpublished ones of `rows` (unique by key), and the numbers of all and of published ones.

    For large batches: rows and published keys meet in one join, whose result is staged.
    """
    if published.isEmpty():
        rows = stage(rows, label)
        return rows, rows.count(), 0
    known = published.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_known", F.lit(True))
    rows = stage(rows.join(known.hint("merge"), key, "left"), label)
    n_rows, duplicates = rows.agg(F.count(F.lit(1)), F.count("_known")).first()
    return rows.where(F.col("_known").isNull()).drop("_known"), n_rows, duplicates


def _rounds(
    entity: Entity, raw: DataFrame, target: CommittedTable, salt: str, total: int
) -> tuple[list[DataFrame], int]:
    """The clean rows in parts by ranges of the target's buckets, each key in one part, and the buckets of a part.

    What a round shuffles and stages is gone before the next, so a batch takes the disk of a round.
    """
    key = entity.published_key
    n = min(target.buckets, -(-total // ROUND_ROWS))
    if n < 2 or key in raw.columns and key != entity.key:  # a key that raw rows bring may differ within a raw key
        return [raw], target.buckets
    of_row = F.col(key) if key == entity.key else pseudonym_sha(F.col(entity.key), salt)
    each = -(-target.buckets // n)
    part = F.floor(bucket_of(of_row, target.buckets) / F.lit(each)).cast("int")
    return stage_parts(entity.clean(raw), part, f"{entity.table}-raw", COMPACT), each


def _publish_indexed(
    spark: SparkSession,
    entity: Entity,
    raw: DataFrame,
    target: CommittedTable,
    as_of: datetime,
    salt: str,
    masked: Callable[[DataFrame], DataFrame],
    run_id: str | None,
    total: int,
) -> tuple[int, int]:
    """Append the new rows in one commit; how many keys the batch has, and how many were published before."""
    key, n_rows, duplicates = entity.published_key, 0, 0
    with brief_shuffles(spark), staged_run(spark), target.appending(spark, run_id) as add:
        parts, n_buckets = _rounds(entity, raw, target, salt, total)
        for part in parts:
            with staged_run(spark):
                rows = stage(one_per_key(entity, part, as_of, salt), f"{entity.table}-batch", COMPACT)
                if part is not raw:
                    discard(part)
                known = stage(target.known_keys(rows)[0], f"{entity.table}-known", COMPACT)
                n, n_known = rows.count(), known.count()
                if n > n_known:
                    add(masked(not_published(rows, known, key) if n_known else rows), (n - n_known) // n_buckets)
                n_rows, duplicates = n_rows + n, duplicates + n_known
    return n_rows, duplicates


def publish(
    spark: SparkSession,
    entity: Entity,
    raw: DataFrame,
    target: tables.FolderTable | tables.BucketedTable | CommittedTable,
    audit: dict | bool | None,
    as_of: datetime,
    salt: str,
    rules: dict,
    strict: bool = True,
    run_id: str | None = None,
    n_raw: int | None = None,
) -> dict:
    """Append the rows of `raw` that are new to the published table `target`.

    Keys are compared unmasked, and masks are put on last. A rerun publishes
    nothing twice. A `CommittedTable` takes the rows in one step under `run_id`, and its
    index of keys spares reading the history; a large batch goes there in rounds. `n_raw` is
    the number of raw rows, if known.
    """
    reason = audit_refusal(audit)
    if reason:
        return {"records_published": 0, "reason": reason}
    total = raw.count() if n_raw is None else n_raw
    key = entity.published_key

    def masked(new: DataFrame) -> DataFrame:
        new = apply_rules(new, rules, strict)
        return new.select(*[f.name for f in entity.schema.fields if f.name in new.columns])

    indexed = isinstance(target, CommittedTable) and target.key == key
    if indexed:
        n_rows, duplicates = _publish_indexed(spark, entity, raw, target, as_of, salt, masked, run_id, total)
    elif total > skew.BROADCAST_ROWS:
        rows, label = one_per_key(entity, raw, as_of, salt), f"{entity.table}-batch"
        new, n_rows, duplicates = _marked(rows, target.read(spark, entity.schema), key, label)
    else:
        rows = stage(one_per_key(entity, raw, as_of, salt), f"{entity.table}-batch")
        batch = measure(rows, key)
        known = stage(known_keys(batch, target.read(spark, entity.schema)), f"{entity.table}-known")
        new, n_rows, duplicates = not_published(rows, known, key), batch.n_rows, known.count()
    fresh = n_rows - duplicates
    if fresh and not indexed:
        if isinstance(target, CommittedTable):
            target.append(masked(new), run_id)
        else:
            target.append(masked(new))
    return {
        "records_published": fresh,
        "records_filtered": total - fresh,
        "duplicate_records": duplicates,
        "approval_rate": round(100 * fresh / total, 2) if fresh else 0.0,
    }
