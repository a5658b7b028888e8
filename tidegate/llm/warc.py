"""WARC archives with an index that is written first and read by coalesced byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import scratch, staged

INDEX = "file string, offset long, length long, url string, digest string, page_id long"
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)
#: Ranges of one read: apart by at most GAP bytes, of READ bytes at most unless a record is longer.
GAP, READ = 1 << 16, 8 << 20
#: Bytes of archives that a task reads, stretch by stretch.
TASK = 128 << 20


def _store(path: str):
    """File system and path within it of a folder that all executors reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def revisits(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """`page_id, url, html, payload_bytes, payload_digest, record_type, refers_to` per page.

    Of pages with equal payloads of `least_bytes` or more the one with the smallest
    id is a response and the others revisit it. A null html is an empty payload. Of
    rows that repeat that smallest id each is a response; rows without an id revisit
    a page that has one, and are responses where no such page exists. An empty table
    gives no rows; other columns are not read.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    ).select(
        "*",
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"),
    )
    firsts = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    repeats = ~F.col("first").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull()
    return (
        rows.join(firsts, "payload_digest", "left")
        .withColumn("record_type", F.when(repeats, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(repeats, F.col("first")))
        .drop("first")
    )


#: Fixed values of the format: what a revisit record refers by.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGES = uuid.UUID("6f1d3c52-7a52-5f0e-9b0a-2f3d0c1b8a44")


def record_id(page: int | None) -> str:
    """The id of a page's record, so that revisits can name it; one of its own without a page id."""
    found = uuid.uuid4() if page is None else uuid.uuid5(_PAGES, f"page {page}")
    return f"<urn:uuid:{found}>"


def record(row, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record, compressed as a gzip member of its own.

    The block is an HTTP response; that of a revisit has no payload. The digest is labelled
    and in base 32, as readers of archives expect.
    """
    body = b"" if row.html is None else row.html.encode()
    again = row.record_type == "revisit"
    page = None if pd.isna(row.page_id) else int(row.page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n"
    block = http.encode() + (b"" if again else body)
    digest = base64.b32encode(bytes.fromhex(row.payload_digest)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {row.record_type}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Payload-Length: {row.payload_bytes}",
    ]
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if row.url is not None:
        head.append(f"WARC-Target-URI: {quote(row.url, safe=_PLAIN)}")
    if again:
        first = int(row.refers_to)
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first)}", f"X-Refers-To-Page: {first}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 1)


_PLAIN = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def write_archives(rows: DataFrame, folder: str, at: datetime | None = None) -> DataFrame:
    """Write a record per row of `revisits` below `folder`, dated `at` (now); returns the index.

    Record ids follow from page ids; rows that repeat a page id share one. An archive per task attempt. Only the index of the attempt that Spark commits
    names its archive, so one left by a lost executor is never read.
    """

    date = (at or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        store.create_dir(root, recursive=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        try:
            for batch in batches:
                found = []
                for row in batch.itertuples(index=False):
                    out = out or store.open_output_stream(f"{root}/{name}", compression=None)
                    data = record(row, date)
                    out.write(data)
                    page = None if pd.isna(row.page_id) else int(row.page_id)
                    found.append((name, at, len(data), row.url, row.payload_digest, page))
                    at += len(data)
                frame = pd.DataFrame(found, columns=["file", "offset", "length", "url", "digest", "page_id"])
                yield frame.astype({"page_id": "Int64"})
        finally:
            if out:
                out.close()

    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return staged(rows.select(columns).mapInPandas(write, INDEX), "warc-index")


def parse(data: bytes) -> tuple:
    """The columns of RECORD from a compressed record."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    digest = base64.b32decode(digest).hex()
    _, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(fields["X-Payload-Length"])
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page")
    return (
        int(page) if page else None,
        fields.get("WARC-Target-URI"),
        kind,
        int(refers) if refers else None,
        size,
        digest,
        body if kind == "response" else None,
    )


def read_records(
    spark: SparkSession, index: DataFrame, folder: str, with_payload: bool = True
) -> DataFrame:
    """The records that `index`, or a selection of its rows, names.

    Index rows are dealt by stretches of an archive and sorted, neighbouring ranges
    are read together. `payload` is null for revisits (their bytes are the ones of
    the page they refer to) and if `with_payload` is false.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    stretch = F.floor(F.col("offset") / READ)
    few = min(spark.sparkContext.defaultParallelism, -(-total // (2 << 20)))  # no core idle on little data
    tasks = max(1, few, -(-total // TASK))
    dealt = index.withColumn("stretch", stretch).repartition(tasks, "file", "stretch")
    columns = [c.split(" ")[0] for c in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for batch in batches:
            for file, rows in batch.groupby("file", sort=False):
                with store.open_input_file(f"{root}/{file}") as archive:
                    for start, stop, parts in ranges(rows.offset.tolist(), rows.length.tolist()):
                        data = archive.read_at(stop - start, start)
                        found = [parse(data[o - start : o - start + n]) for o, n in parts]
                        frame = pd.DataFrame(found, columns=columns)
                        if not with_payload:
                            frame["payload"] = None
                        yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt.sortWithinPartitions("file", "offset").mapInPandas(read, RECORD)


def ranges(offsets: list[int], lengths: list[int]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) pairs grouped into reads of (start, stop, their records)."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for o, n in zip(offsets, lengths, strict=True):
        if out and o - out[-1][1] <= GAP and o + n - out[-1][0] <= READ:
            start, stop, parts = out[-1]
            parts.append((o, n))
            out[-1] = (start, max(stop, o + n), parts)
        else:
            out.append((o, o + n, [(o, n)]))
    return out


def round_trip(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Archive all of `pages` and read the archives back: the columns of RECORD, no payload."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    index = write_archives(revisits(pages, least_bytes), folder)
    return read_records(spark, index, folder, with_payload=False).drop("payload", "url")
