"""A paged source as a Spark data source: one partition per page, retries, and an offset log.

    spark.dataSource.register(PageSource)
    spark.read.format("tidegate_pages").option("uri", folder).load()

Pages come through a transport, by default files (`page=<n>/` below `uri`, on any file
system that Arrow reads). Each page is fetched in a task of its own, again after a pause
if that fails for a moment; a page that cannot be had is a row with its error, so one lost
page costs no other. What was landed is written to an offset log, and the next read asks
for the other pages only.
"""

from __future__ import annotations

import base64
import importlib
import json
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..runtime import ship_package
from ..schemas import OFFSETS, RecordField
from .committed import CommittedTable
from .pages import CORRUPT

SCHEMA = "page bigint, attempts int, value string, error string"
#: Attempts per page, and the shortest and longest pause between them.
ATTEMPTS, PAUSE, LONGEST_PAUSE = 5, 2.0, 30.0


class Transport(Protocol):
    """Where pages come from; made anew in each task from the source's options."""

    def total_pages(self) -> int: ...

    def fetch(self, page: int) -> str: ...


class PageLost(Exception):
    """There is no such page now; asking again would not help."""


class FileTransport:
    """Pages as the text of the files below `<uri>/page=<n>/`."""

    def __init__(self, options: dict[str, str]):
        from pyarrow import fs

        uri = options["uri"]
        located = uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1)
        self.fs, self.root = fs.FileSystem.from_uri(located)

    def _names(self, folder: str) -> list:
        from pyarrow import fs

        return self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True))

    def total_pages(self) -> int:
        found = [i.base_name for i in self._names(self.root) if i.base_name.startswith("page=")]
        if not found:
            return 0
        for name in sorted(found):  # any readable page announces how many there are
            try:
                return int(json.loads(self.fetch(int(name[5:])))["meta"]["total_pages"])
            except (PageLost, ValueError, KeyError, TypeError):
                continue
        return max(int(name[5:]) for name in found)

    def fetch(self, page: int) -> str:
        files = [i for i in self._names(f"{self.root}/page={page}") if not i.base_name.startswith((".", "_"))]
        text = []
        for info in sorted(files, key=lambda i: i.path):
            with self.fs.open_input_stream(info.path) as f:
                text.append(f.read().decode("utf-8", "replace"))
        body = "".join(text).strip("\n")
        if not body:
            raise PageLost(f"page {page} was not delivered")
        return body


def _transport(options: dict[str, str]) -> Transport:
    module, _, name = options.get("transport", f"{__name__}:FileTransport").partition(":")
    return getattr(importlib.import_module(module), name)(options)


@dataclass
class Page(InputPartition):
    """The pages of a task, rising; between them lie pages that others have landed."""

    pages: list[int]

    def __post_init__(self):
        super().__init__(self.first)

    @property
    def first(self) -> int:
        return self.pages[0] if self.pages else 1

    @property
    def last(self) -> int:
        return self.pages[-1] if self.pages else 0


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.attempts = int(options.get("attempts", ATTEMPTS))
        self.pause = float(options.get("pause", PAUSE))
        self.each = int(options.get("pages_per_task", 1))

    def partitions(self) -> list[Page]:
        total, error = self._patiently(lambda: _transport(self.options).total_pages())[1:]
        if error:
            raise OSError(f"the number of pages is not to be had: {error}")
        landed = unpacked(self.options.get("landed", ""))
        wanted = [n for n in range(1, total + 1) if not _has(landed, n)]
        # a task for each run of pages would be a task for each page where the missing ones lie scattered
        return [Page(wanted[k : k + self.each]) for k in range(0, len(wanted), self.each)] or [Page([])]

    def read(self, partition: Page) -> Iterator[tuple]:
        transport = _transport(self.options)
        for page in partition.pages:
            yield self._one(transport, page)

    def _one(self, transport: Transport, page: int) -> tuple:
        attempts, value, error = self._patiently(lambda: transport.fetch(page))
        return page, attempts, value, error

    def _patiently(self, ask) -> tuple:
        """(attempts, answer, error) of a call that may fail for a moment."""
        pause, error = self.pause, None
        for attempt in range(1, self.attempts + 1):
            try:
                return attempt, ask(), None
            except PageLost as e:
                return attempt, None, str(e)
            except Exception as e:  # noqa: BLE001  whatever a transport fails with
                error = f"{type(e).__name__}: {e}"
            if attempt < self.attempts:
                time.sleep(pause)
                pause = min(2 * pause, LONGEST_PAUSE)
        return self.attempts, None, error


class PageSource(DataSource):
    """Options: `uri`, `transport` (module:class), `attempts`, `pause`, `pages_per_task`, `landed`."""

    @classmethod
    def name(cls) -> str:
        return "tidegate_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(dict(self.options))


# --- the offset log ---------------------------------------------------------

def packed(bits: dict[int, bytes]) -> str:
    """Bitmaps by their number, as text for an option."""
    body = b"".join(n.to_bytes(8, "little") + b for n, b in sorted(bits.items()))
    return base64.b64encode(zlib.compress(body)).decode()


def unpacked(text: str) -> dict[int, bytes]:
    body = zlib.decompress(base64.b64decode(text)) if text else b""
    size = 8 + 4096
    return {int.from_bytes(body[k : k + 8], "little"): body[k + 8 : k + size] for k in range(0, len(body), size)}


def _has(bits: dict[int, bytes], page: int) -> bool:
    number, at = divmod(page - 1, 8 * 4096)
    found = bits.get(number + 1)
    return bool(found and found[at >> 3] >> (at & 7) & 1)


@dataclass(frozen=True)
class OffsetLog:
    """Which pages of a source have been landed, and by which run."""

    path: str

    @property
    def table(self) -> CommittedTable:
        return CommittedTable(self.path)

    def pages(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark, OFFSETS)

    def landed(self, spark: SparkSession) -> str:
        """The landed pages as an option of the source: one bit a page reaches the driver."""
        bits = (
            self.pages(spark)
            .groupBy(F.bitmap_bucket_number("page").alias("number"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("page")).alias("bits"))
        )
        return packed({r["number"]: bytes(r["bits"]).ljust(4096, b"\0") for r in bits.collect()})

    def add(self, read: DataFrame, run_id: str) -> bool:
        """Note the pages of `read` that came; those that were lost are asked for again."""
        came = read.where("error IS NULL").select("page", "attempts", F.lit(run_id).alias("run_id"))
        return self.table.append(came, run_id)


def read_source(
    spark: SparkSession, uri: str, log: OffsetLog | None = None, **options: str | int | float
) -> DataFrame:
    """Pages not landed before, as `page, attempts, value, error`. Stage it: each evaluation fetches anew."""
    ship_package(spark)
    spark.dataSource.register(PageSource)
    reader = spark.read.format(PageSource.name()).option("uri", uri)
    if log is not None:
        reader = reader.option("landed", log.landed(spark))
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load()


def as_pages(read: DataFrame, fields: list[RecordField]) -> DataFrame:
    """Fetched pages in the form of `pages.read_pages`; pages that were lost are left out."""
    record = ", ".join(f"{f.name}: string" for f in fields)
    schema = (
        f"page bigint, meta struct<total_pages: bigint>, data array<struct<{record}>>, {CORRUPT} string"
    )
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = read.where("error IS NULL").select(F.from_json("value", schema, how).alias("p"))
    return parsed.select("p.page", "p.meta.total_pages", "p.data", f"p.{CORRUPT}")
