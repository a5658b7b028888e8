"""Zone tables partitioned by day: a day is reloaded alone, and readers open the days they need."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import exists, located

#: Directory of rows without a time.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class DailyTable:
    """A folder of Parquet files by the day of `time_column`, in the column `day`.

    Rows without a time make a day of their own, NULL.
    """

    path: str
    time_column: str
    day: str = "ingest_date"

    def _dated(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.day, F.col(self.time_column).cast("date"))

    def replace_days(self, df: DataFrame) -> None:
        """Truncate and reload the days that `df` holds; other days keep their files.

        Rows are sorted by time within their files, so that what the day does not prune the
        files' statistics may. A day of any size is cut over tasks by its rows' time.
        """
        rows = self._dated(df)
        (
            rows.repartitionByRange(self.day, self.time_column)
            .sortWithinPartitions(self.day, self.time_column)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.day)
            .parquet(self.path)
        )

    def days(self, spark: SparkSession) -> list[date]:
        """The days that are stored, ascending, from the names of their folders alone."""
        root, fs = located(spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        values = [n.split("=", 1)[1] for n in names if n.startswith(f"{self.day}=")]
        return sorted(date.fromisoformat(v) for v in values if v != NO_DAY)

    def read(
        self, spark: SparkSession, schema: StructType, first: date | None = None, last: date | None = None
    ) -> DataFrame:
        """The rows, or those of the days from `first` to `last`; other days are not opened."""
        if not exists(spark, self.path):
            return spark.createDataFrame([], schema)
        stored = StructType([f for f in schema.fields if f.name != self.day]).add(self.day, "date")
        rows = spark.read.schema(stored).parquet(self.path)
        if first is not None:
            rows = rows.where(F.col(self.day) >= F.lit(first))
        if last is not None:
            rows = rows.where(F.col(self.day) <= F.lit(last))
        return rows.select([n for n in schema.names if n != self.day])

    def newest(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The rows of the last day: enough to tell when data arrived last."""
        days = self.days(spark)
        return self.read(spark, schema, days[-1]) if days else self.read(spark, schema)

    def drop_before(self, spark: SparkSession, keep_days: int) -> list[date]:
        """Delete days older than `keep_days` before the newest; rows without a time stay."""
        days = self.days(spark)
        old = [d for d in days if d < days[-1] - timedelta(days=keep_days - 1)] if days else []
        for d in old:
            folder, fs = located(spark, f"{self.path.rstrip('/')}/{self.day}={d.isoformat()}")
            if not fs.delete(folder, True):
                raise OSError(f"could not delete {folder}")
        return old
