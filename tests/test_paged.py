"""The paged source: a page per partition, retries, lost pages and the offset log."""

import json

from tidegate import schemas
from tidegate.runtime import stage
from tidegate.sources import paged, pages
from tidegate.sources.paged import OffsetLog, PageReader, read_source


def deliver(folder, numbers, total, body=None):
    for n in numbers:
        (folder / f"page={n}").mkdir(parents=True)
        page = {"page": n, "meta": {"total_pages": total}, "data": [{"transaction_id": f"t{n}-{k}", "user_id": "1"} for k in range(2)]}
        (folder / f"page={n}" / "part-0.txt").write_text(body or json.dumps(page) + "\n")


def test_lost_pages_are_rows_and_are_asked_for_again(spark, tmp_path):
    source, log = tmp_path / "in", OffsetLog(str(tmp_path / "log"))
    deliver(source, [1, 2, 4], total=5)
    first = stage(read_source(spark, str(source), log, pause=0), "fetched")
    assert first.rdd.getNumPartitions() >= 1
    got = {r["page"]: (r["attempts"], r["value"] is not None, r["error"]) for r in first.collect()}
    assert got == {
        1: (1, True, None), 2: (1, True, None), 4: (1, True, None),
        3: (1, False, "page 3 was not delivered"), 5: (1, False, "page 5 was not delivered"),
    }
    assert log.add(first, "run-1") and not log.add(first, "run-1")
    deliver(source, [3], total=5)
    second = stage(read_source(spark, str(source), log, pause=0), "fetched")
    assert sorted((r["page"], r["error"] is None) for r in second.collect()) == [(3, True), (5, False)]
    log.add(second, "run-2")
    assert sorted(r["page"] for r in log.pages(spark).collect()) == [1, 2, 3, 4]
    rows = pages.records(paged.as_pages(first.unionByName(second), schemas.TRANSACTION_FIELDS))
    assert sorted(r["transaction_id"] for r in rows.collect()) == sorted(f"t{n}-{k}" for n in range(1, 5) for k in range(2))


def test_unreadable_pages_keep_their_text(spark, tmp_path):
    deliver(tmp_path, [1], total=2)
    deliver(tmp_path, [2], total=2, body='{"page": 2, "meta": {"to')
    landed = paged.as_pages(stage(read_source(spark, str(tmp_path), pause=0), "fetched"), schemas.TRANSACTION_FIELDS)
    assert [r["page_text"] for r in pages.unreadable(stage(landed, "pages")).collect()] == ['{"page": 2, "meta": {"to']


def test_an_empty_source(spark, tmp_path):
    assert read_source(spark, str(tmp_path / "none"), pause=0).count() == 0


class Flaky:
    """Fails twice for each odd page, always for page 4."""

    asked: dict = {}

    def __init__(self, options):
        pass

    def total_pages(self):
        return 4

    def fetch(self, page):
        self.asked[page] = self.asked.get(page, 0) + 1
        if page == 4 or (page % 2 and self.asked[page] < 3):
            raise ConnectionError("busy")
        return f"page {page}"


def test_retries(monkeypatch):
    slept = []
    monkeypatch.setattr(paged.time, "sleep", slept.append)
    monkeypatch.setattr(paged, "_transport", Flaky)
    reader = PageReader({"pages_per_task": "3"})
    parts = reader.partitions()
    assert [(p.first, p.last) for p in parts] == [(1, 3), (4, 4)]
    rows = [r for p in parts for r in reader.read(p)]
    assert rows == [
        (1, 3, "page 1", None), (2, 1, "page 2", None), (3, 3, "page 3", None),
        (4, 5, None, "ConnectionError: busy"),
    ]
    assert slept == [2, 4, 2, 4, 2, 4, 8, 16]


def test_one_partition_per_page(monkeypatch):
    monkeypatch.setattr(paged, "_transport", Flaky)
    landed = paged.packed({1: bytes([0b10]) + bytes(4095)})
    assert [(p.first, p.last) for p in PageReader({"landed": landed}).partitions()] == [(1, 1), (3, 3), (4, 4)]
    assert paged.unpacked(paged.packed({})) == {}


def test_scattered_pages_share_tasks(spark, monkeypatch):
    """Of 64 pages every other one is landed; the rest are two tasks of 16 pages, not 32 of one."""
    monkeypatch.setattr(Flaky, "total_pages", lambda self: 64)
    monkeypatch.setattr(paged, "_transport", Flaky)
    landed = paged.packed({1: bytes([0b01010101] * 8) + bytes(4088)})
    parts = PageReader({"landed": landed, "pages_per_task": "16"}).partitions()
    assert [p.pages for p in parts] == [list(range(2, 33, 2)), list(range(34, 65, 2))]


def test_late_pages_come_with_the_second_run(spark, tmp_path):
    from registry.queries import QUERIES

    spark.range(950).selectExpr(
        "id AS event_id", "id AS user_id", "if(id % 300 = 0, 'error', 'view') AS event_type", "10D AS value",
        "'{}' AS props", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts",
    ).write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["paged_source"](spark, str(tmp_path)).collect()
    late = {1, 4, 7, 10}
    assert sorted((r["page"], r["records"], r["run_id"]) for r in found) == [
        (n, 50 if n == 10 else 100, "run-2" if n in late else "run-1") for n in range(1, 11)
    ]
