"""Session defaults and tables staged in the cluster's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tidegate", **conf) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEGATE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master may fall back to a temporary folder; on a cluster an
    unset folder is an error, since a machine-local path dies with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package wherever they run; once per context.

    Functions that run in Python workers are pickled by name. The archive goes
    through Spark's own file distribution, so it may lie in the driver's folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidegate_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tidegate-"), "tidegate.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in (n for n in sorted(names) if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._tidegate_shipped = True


#: Number of a part of a staged table: a partition column to Spark.
PART = "_staged_part"
#: Spark's setting by which a query removes its shuffle files when it has ended.
BRIEF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_run: ContextVar[str] = ContextVar("staged_run", default="kept")
#: Takes (frame, the frame that reads it back) where columns are followed through staging.
traced_by: ContextVar[Callable[[DataFrame, DataFrame], DataFrame] | None] = ContextVar("traced_by", default=None)


def stage(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage for results that several branches of a plan need, fixes
    non-deterministic columns, and leaves the planner with measured file sizes.
    """
    path = _new_path(df.sparkSession, label)
    df.write.options(**options or {}).parquet(path)
    return _read_back(df, path)


def stage_parts(
    df: DataFrame, part: Column, label: str, options: dict[str, str] | None = None
) -> list[DataFrame]:
    """Write `df` once, dealt by the whole number `part`; one frame for each number that occurs.

    Each frame can be deleted by itself (`discard`).
    """
    spark = df.sparkSession
    path = _new_path(spark, label)
    df.withColumn(PART, part).write.options(**options or {}).partitionBy(PART).parquet(path)
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(top)
    names = sorted(f.getPath().getName() for f in found if f.getPath().getName().startswith(f"{PART}="))
    return [_read_back(df, f"{path}/{name}") for name in names]


def _new_path(spark: SparkSession, label: str) -> str:
    return f"{_run_folder(spark, _run.get())}/{label}-{uuid.uuid4().hex}"


def _read_back(df: DataFrame, path: str) -> DataFrame:
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    if traced_by.get() is not None:
        frame = traced_by.get()(df, frame)
    frame.staged_at = path  # for those who delete it before the run ends
    return frame


def discard(frame: DataFrame) -> None:
    """Delete the files of a staged frame that nothing reads any more; other frames stay as they are."""
    if path := getattr(frame, "staged_at", None):
        _delete(frame.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when their query ends, not when the driver comes to collect its garbage.

    A frame that is read again after that computes its shuffles anew.
    """
    before = spark.conf.get(BRIEF, None)
    spark.conf.set(BRIEF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BRIEF)
        else:
            spark.conf.set(BRIEF, before)


def _run_folder(spark: SparkSession, run: str) -> str:
    return f"{shared_folder(spark)}/staged/{spark.sparkContext.applicationId}/{run}"


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[str]:
    """Delete at the end what is staged inside; every reader must be done by then.

    Work handed to threads takes part if it runs in a copy of this context.
    """
    folder = _run_folder(spark, uuid.uuid4().hex)
    token = _run.set(folder.rsplit("/", 1)[1])
    try:
        yield folder
    finally:
        _run.reset(token)
        _delete(spark, folder)
