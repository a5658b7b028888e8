"""Landed pages of records: reading, gaps, and rejected records.

A landed page is one JSON line `{"page": n, "meta": {"total_pages": m}, "data": [...]}`.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import moment
from ..schemas import RecordField

CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, fields: list[RecordField]) -> DataFrame:
    """Pages as `page, total_pages, data, _corrupt_record`; fields of records stay text."""
    record = ", ".join(f"{f.name}: string" for f in fields)
    schema = (
        f"page bigint, meta struct<total_pages: bigint>, data array<struct<{record}>>, "
        f"{CORRUPT} string"
    )
    pages = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return pages.select("page", "meta.total_pages", "data", CORRUPT)


def records(pages: DataFrame) -> DataFrame:
    """The records of all readable pages with their place."""
    readable = pages.where(F.col(CORRUPT).isNull())
    placed = readable.select("page", F.posexplode("data").alias("position", "record"))
    return placed.select("page", "position", "record.*")


def _typed(f: RecordField) -> Column:
    return F.col(f.name) if f.type == "string" else F.col(f.name).try_cast(f.type)


def _problem(f: RecordField) -> Column:
    """NULL for an acceptable field, else what is wrong with it."""
    raw = F.col(f.name)
    tests = []
    if f.required:
        tests.append((raw.isNull(), "missing"))
    if f.type != "string":
        tests.append((raw.isNotNull() & _typed(f).isNull(), "unreadable"))
    if f.max_length:
        tests.append((F.length(raw) > f.max_length, "too long"))
    if f.allowed:
        tests.append((~raw.isin(*f.allowed), "not allowed"))
    out = F.lit(None).cast("string")
    for test, what in reversed(tests):
        out = F.when(test, F.lit(f"{f.name} {what}")).otherwise(out)
    return out


def checked(rows: DataFrame, fields: list[RecordField]) -> DataFrame:
    """Add `reject_reason`: the first problem of the record, NULL if it has none."""
    return rows.withColumn("reject_reason", F.coalesce(*[_problem(f) for f in fields]))


def accepted(rows: DataFrame, fields: list[RecordField], key: str) -> DataFrame:
    """The typed records without a problem; of those with the same key the first to arrive.

    A grouped minimum, so that repeats combine before the shuffle.
    """
    good = rows.where(F.col("reject_reason").isNull())
    others = [f.name for f in fields if f.name != key]
    typed = good.select("page", "position", *[_typed(f).alias(f.name) for f in fields])
    first = typed.groupBy(key).agg(F.min(F.struct("page", "position", *others)).alias("first"))
    return first.select(
        *[F.col(key) if f.name == key else F.col(f"first.{f.name}") for f in fields]
    )


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull())


def unreadable(pages: DataFrame) -> DataFrame:
    """The text of staged pages that are no readable JSON."""
    text = F.col(CORRUPT)
    return pages.where(text.isNotNull()).select(
        text.alias("page_text"), F.lit("page unreadable").alias("reject_reason")
    )


def rejects(pages: DataFrame, rows: DataFrame) -> DataFrame:
    """All of staged pages that is not taken: records with a problem, the text of unreadable pages."""
    return rejected(rows).unionByName(unreadable(pages), allowMissingColumns=True)


def with_ingest_columns(rows: DataFrame, as_of: datetime, source: str) -> DataFrame:
    return rows.withColumns(
        {
            "ingested_at": moment(as_of),
            "source_file": F.lit(source),
            "gx_validation_status": F.lit("PENDING"),
            "gx_validation_errors": F.lit(None).cast("string"),
        }
    )


def last_page(pages: DataFrame) -> int:
    """The highest number of pages any page announces."""
    return pages.where(F.col(CORRUPT).isNull()).agg(F.max("total_pages")).first()[0] or 0


def missing_pages(pages: DataFrame) -> DataFrame:
    """Announced pages that were not landed, or landed unreadable."""
    spark = pages.sparkSession
    expected = spark.range(1, last_page(pages) + 1).withColumnRenamed("id", "page")
    seen = pages.where(F.col(CORRUPT).isNull()).select("page").distinct()
    return expected.join(seen, "page", "left_anti")


def extraction_metrics(pages: DataFrame, rows: DataFrame, inserted: int) -> dict[str, int]:
    """Records taken, errors (records not taken, and lost pages) and pages processed."""
    return {
        "records_inserted": inserted,
        "errors": rows.count() - inserted + missing_pages(pages).count(),
        "pages_processed": last_page(pages),
    }
