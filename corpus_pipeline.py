"""From raw documents to packed training sequences: four stages, each written and read again.

All stages read `doc_id` and `text` and hand on every column of their input, whatever its
name. Rows that repeat an id are judged each on its own text and stay or go one by one in
the first two stages, together in the third. An empty table gives an empty table. Texts of
any length are judged, compared and cut whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import linededup, packing, quality, simhash
from tidegate.llm.queries import _pattern, _table, _vocabulary
from tidegate.llm.shared import staged
from tidegate.runtime import ship_package


def _columns_of(docs: DataFrame) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold.

    Null texts are scored as empty ones. Of two equal texts both stay or both go.
    """
    scored = quality.classify(docs, _table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(_columns_of(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are deleted; every document stays.

    Earlier is the smaller id, null first, then the smaller hash of the text. `n_chars`
    counts the characters that are left. Null texts stay null, empty ones empty.
    """
    ship_package(spark)
    clean = linededup.dedup_lines(docs)
    counted = F.when(F.size("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", counted).select(_columns_of(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every SimHash group.

    Null and empty texts are one group. Documents without an id stay.
    """
    ship_package(spark)
    return simhash.first_of_groups(docs).select(_columns_of(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: its place in a sequence of at most 2048 ids.

    Null and empty texts are one id. Rows that repeat an id are documents of their own.
    """
    ship_package(spark)
    return packing.pack(docs, _vocabulary("byte_bpe_50k.json"), _pattern())


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: The classifier, patience diff and the linear program have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = _table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staged(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
