"""Schemas of a table over time, and how rows of each become rows of the newest.

Columns are renamed, added, dropped and retyped between generations of files. Each
generation is registered once with the plan that leads to it from the one before; files say
by their folder which generation they are of. Reading casts every generation along the
plans, so that a renamed column is not read as NULL.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import GENERATIONS
from .committed import CommittedTable
from .tables import located

class SchemaMismatch(ValueError):
    """A plan does not lead from the registered schema to the new one, or rows do not fit it."""


@dataclass(frozen=True)
class Plan:
    """From the generation before: new name by old name, SQL for added columns, dropped columns.

    A column that keeps its name and changes its type is cast; what cannot be cast is NULL,
    or an error with `strict`.
    """

    renamed: dict[str, str] = field(default_factory=dict)
    added: dict[str, str] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)
    strict: bool = False

    def check(self, before: StructType, after: StructType) -> None:
        kept = [self.renamed.get(n, n) for n in before.names if n not in self.dropped]
        unknown = {*self.renamed, *self.dropped} - set(before.names)
        made = [*kept, *self.added]
        if unknown or len(set(made)) < len(made) or set(made) != set(after.names):
            raise SchemaMismatch(f"{sorted(before.names)} becomes {sorted(made)}, not {sorted(after.names)}; unknown: {sorted(unknown)}")

    def apply(self, rows: DataFrame, after: StructType) -> DataFrame:
        back = {new: old for old, new in self.renamed.items()}

        def value(f) -> Column:
            if f.name in self.added:
                return F.expr(self.added[f.name]).cast(f.dataType)
            old = F.col(f"`{back.get(f.name, f.name)}`")
            if rows.schema[back.get(f.name, f.name)].dataType == f.dataType:
                return old
            return old.cast(f.dataType) if self.strict else old.try_cast(f.dataType)

        return rows.select(*[value(f).alias(f.name) for f in after.fields])


@dataclass(frozen=True)
class EvolvingTable:
    """A table at `path` whose generations lie in `v<n>/`, with its log of schemas beside them."""

    path: str

    @property
    def _log(self) -> CommittedTable:
        return CommittedTable(f"{self.path.rstrip('/')}/_schemas")

    def _folder(self, version: int) -> str:
        return f"{self.path.rstrip('/')}/v{version}"

    def generations(self, spark: SparkSession) -> list[tuple[int, StructType, Plan]]:
        """All registered generations, oldest first: few lines, one per change of the schema."""
        rows = self._log.read(spark, GENERATIONS).orderBy("version").collect()
        return [(r["version"], StructType.fromJson(json.loads(r["columns"])), Plan(**json.loads(r["plan"]))) for r in rows]

    def evolve(self, spark: SparkSession, schema: StructType, plan: Plan | None = None) -> int:
        """Register the next generation, unless it is the one that stands; returns its number."""
        known = self.generations(spark)
        plan = plan or Plan()
        if known:
            version, before, _ = known[-1]
            if before == schema:
                return version
            plan.check(before, schema)
        version = len(known) + 1
        line = (version, schema.json(), json.dumps(asdict(plan)))
        self._log.append(spark.createDataFrame([line], GENERATIONS), f"v{version}")
        return version

    def append(self, df: DataFrame) -> None:
        """Add rows of the newest generation; rows with other columns are refused."""
        version, schema, _ = self.generations(df.sparkSession)[-1]
        mine = {f.name: f.dataType for f in df.schema.fields}
        if mine != {f.name: f.dataType for f in schema.fields}:
            raise SchemaMismatch(f"{df.schema.simpleString()} is not {schema.simpleString()}")
        df.select(schema.names).write.mode("append").parquet(self._folder(version))

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows as rows of the newest generation, each scan reading its own columns only."""
        known = self.generations(spark)
        if not known:
            raise SchemaMismatch(f"{self.path} has no schema yet")
        frames = []
        for k, (version, schema, _) in enumerate(known):
            folder, fs = located(spark, self._folder(version))
            if not fs.exists(folder):
                continue
            rows = spark.read.schema(schema).parquet(self._folder(version))
            for _, after, plan in known[k + 1 :]:
                rows = plan.apply(rows, after)
            frames.append(rows)
        newest = known[-1][1]
        return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], newest)
