"""Packed id matrices by best-fit decreasing.

Every task packs its documents in batches of bounded size: pieces by falling length
go to the fullest open sequence that still holds them, found in a segment tree over
the free capacities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder


class Capacities:
    """Open sequences by free room: a segment tree over the rooms 0..most."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room of `need` or more, removed; None if none."""
        node = need + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Items (their numbers) of each sequence; no length exceeds `most`."""
    free, out = Capacities(most), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[item])
        room, sequence = found or (most, len(out))
        if found is None:
            out.append([])
        out[sequence].append(item)
        if room > lengths[item]:
            free.put(room - lengths[item], sequence)
    return out


def matrices(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    max_len: int = 2048,
    end_id: int = 1,
    pad_id: int = 0,
    batch_tokens: int = 4 << 20,
    dtype: str = "<u2",
) -> DataFrame:
    """One row per sequence.

    `sequence` (name: partition and number), `ids` (a row of the matrix: `max_len`
    ids of `dtype`, padded with `pad_id`), `n_tokens`, `cu_seqlens` (cumulative
    segment lengths from 0), `position_resets` (where positions begin at 0 again),
    `doc_ids` and `starts` (each segment's document and its place there). Documents
    end with `end_id`; those over `max_len` are cut, no id is lost. Null and empty
    texts are `end_id` alone, rows that repeat (or lack) an id are documents of their
    own, an empty table gives no sequences, other columns are not read.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = (
        "sequence string, ids binary, n_tokens int, cu_seqlens array<int>, "
        "position_resets array<int>, doc_ids array<long>, starts array<long>"
    )
    lists = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 2
    kinds = [pa.string(), pa.binary(), pa.int32(), *lists]
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def sequences(held: list[tuple], part: int, first: int) -> pa.RecordBatch:
        rows = []
        for n, items in enumerate(best_fit_decreasing([len(p[2]) for p in held], max_len)):
            own = [held[i] for i in items]
            ends = np.cumsum([len(ids) for _, _, ids in own])
            line = np.full(max_len, pad_id, dtype)
            line[: ends[-1]] = np.concatenate([ids for _, _, ids in own])
            cuts = [0, *ends.tolist()]
            docs_, starts = [d for d, _, _ in own], [s for _, s, _ in own]
            rows.append((f"{part}-{first + n}", line.tobytes(), cuts[-1], cuts, cuts[:-1], docs_, starts))
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer, pattern), TaskContext.get().partitionId()
        held: list[tuple] = []
        tokens = first = 0
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(enc.encode(body.as_py() or "") + end, "<u4")
                if ids.max() > np.iinfo(dtype).max:
                    raise ValueError(f"an id exceeds {dtype}")
                ids = ids.astype(dtype)
                for start in range(0, len(ids), max_len):
                    held.append((doc, start, ids[start : start + max_len]))
                    tokens += len(held[-1][2])
                    if tokens >= batch_tokens:
                        made = sequences(held, part, first)
                        first, tokens, held = first + made.num_rows, 0, []
                        yield made
        if held:
            yield sequences(held, part, first)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, schema)
