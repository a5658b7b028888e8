"""Bound-certified packing: few sequences, and a proof of how few there can be.

Every task packs the documents it has tokenised by best-fit decreasing and holds the number
of its sequences against lower bounds from dual-feasible functions. A task that meets its
bound is certified. The others have a gap: they give up all sequences with free room, the
certified ones only their emptiest. What is given up is dealt anew, whole sequences at a
time, over as few tasks of bounded size as hold it, and packed again, until one task holds
the rest or a round saves no sequence. Only lengths and checksums travel, never texts.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, staged
from .tokens import encoder

#: Functions u(k) that are tried for the bound, and the rounds that may deal anew.
STEPS, ROUNDS = 64, 12


def best_fit_decreasing(lengths: np.ndarray, room: int) -> np.ndarray:
    """The bin of every item: by falling length, each into the fullest bin that takes it.

    Items of one length and bins of one free room are handled together. The fullest bin
    that takes an item stays the fullest until no further item of that length fits, so a
    run of bins takes `free // length` items each.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes, counts = np.unique(lengths, return_counts=True)
    rooms: list[int] = []  # free rooms that occur, ascending
    held: dict[int, list[tuple[int, int]]] = {}  # their bins, as ranges
    out, bins = [], 0

    def put(free: int, start: int, stop: int) -> None:
        if stop > start and free:
            if free not in held:
                insort(rooms, free)
                held[free] = []
            held[free].append((start, stop))

    for size, left in zip(sizes[::-1].tolist(), counts[::-1].tolist()):
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                free = rooms[at]
                start, stop = held[free].pop()
                if not held[free]:
                    del held[free], rooms[at]
            else:
                free, start = room, bins
                stop = bins = bins + -(-left // (room // size))
            each = free // size
            full = min(stop - start, left // each)
            out.append(np.repeat(np.arange(start, start + full), each))
            put(free - each * size, start, start + full)
            left, start = left - full * each, start + full
            if start < stop and left:  # fewer than `each` are left
                out.append(np.full(left, start))
                put(free - left * size, start, start + 1)
                left, start = 0, start + 1
            put(free, start, stop)
    found = np.empty(len(lengths), np.int64)
    found[order] = np.concatenate(out) if out else np.empty(0, np.int64)
    return found


def lower_bound(counts: np.ndarray, room: int) -> int:
    """Bins that any packing needs; `counts[x]` items have length x, none above `room`.

    A dual-feasible function maps lengths so that what fits one bin still sums to at most
    one; so the rounded up sum over all items bounds the bins from below. Tried are the
    volume, u(k) for k up to `STEPS` after U(e), and phi(e), for every threshold e. All
    sums are whole numbers over a common denominator.
    """
    x = np.arange(room + 1, dtype=np.int64)
    counts = np.asarray(counts, np.int64)
    best = -(-int((counts * x).sum()) // room)
    if not counts.any():
        return 0
    thresholds = np.arange(room // 2 + 1)
    at_least = np.append(np.cumsum(counts[::-1])[::-1], 0)  # items of length x or more
    large = at_least[room - thresholds + 1]
    for k in range(0, STEPS + 1):
        if k:
            whole, rest = np.divmod((k + 1) * x, room)
            value, one = np.where(rest == 0, whole * k, whole * (k + 1)), k * (k + 1)
        else:
            value, one = x, room
        below = np.append(0, np.cumsum(counts * value))  # values of lengths under x
        middle = below[room - thresholds + 1] - below[thresholds]
        best = max(best, -(-int((large * one + middle).max()) // one))
    used = np.flatnonzero(counts)
    small, big = used[2 * used <= room], used[2 * used > room]
    for e in thresholds[1:]:
        one = room // e
        total = counts[small[small >= e]].sum() + (counts[big] * (one - (room - big) // e)).sum()
        best = max(best, -(-int(total) // int(one)))
    return best


def _places(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each item begins in its bin, gapless."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    starts = ends - lengths[order]
    first = np.flatnonzero(np.diff(bins[order], prepend=-1))
    at = np.repeat(starts[first], np.diff(first, append=len(bins)))
    out = np.empty(len(bins), np.int64)
    out[order] = starts - at
    return out


def _arranged(lengths: np.ndarray, room: int, last: bool, old: np.ndarray | None = None):
    """Bins, places, and which items are given up for the next round.

    Falls back to the `old` bins where a new packing needs as many.
    """
    bins = best_fit_decreasing(lengths, room)
    n = int(bins.max()) + 1
    if old is not None and old.max() + 1 <= n:
        bins, n = old, int(old.max()) + 1
    free = room - np.bincount(bins, lengths, n).astype(np.int64)
    if last:
        given = np.zeros(n, bool)
    elif n > lower_bound(np.bincount(lengths, minlength=room + 1), room):
        given = free > 0
    else:
        given = (np.arange(n) == free.argmax()) & (free > 0)
    return bins, _places(bins, lengths), given[bins]


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACE = "grp long, bin long, offset long, given boolean"


def _first_packing(
    docs: DataFrame, tokenizer: str, pattern: str | None, room: int, end_id: int,
    batch_pieces: int, with_ids: bool,
) -> DataFrame:
    """Tokenise and pack each task's documents, in batches of bounded size."""
    end = np.array([end_id], "<u4").tobytes()
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = [c.split(" ")[0] for c in f"{PIECE}, {PLACE}".split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer, pattern), TaskContext.get().partitionId()
        held: list[tuple] = []
        first = 0

        def packed() -> pa.RecordBatch:
            nonlocal first
            columns = list(zip(*held, strict=True))
            bins, offset, given = _arranged(np.array(columns[3]), room, False)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            arrays += [pa.array(np.full(len(bins), part)), pa.array(bins + first)]
            arrays += [pa.array(offset), pa.array(given)]
            first += int(bins.max()) + 1
            if with_ids:
                arrays.append(pa.array(columns[5], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(body.as_py() or "") + end
                for k in range(-(-len(ids) // (4 * room))):
                    own = ids[4 * k * room : 4 * (k + 1) * room]
                    row = (doc, k, k * room, len(own) // 4, zlib.crc32(own))
                    held.append((*row, own) if with_ids else row)
                    if len(held) >= batch_pieces:
                        yield packed()
                        held.clear()
        if held:
            yield packed()

    schema = f"{PIECE}, {PLACE}" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, schema)


def _dealt_anew(given: DataFrame, groups: int, room: int) -> DataFrame:
    """Sequences given up, dealt over `groups` tasks and packed again."""
    columns = given.columns

    def again(rows: pd.DataFrame) -> pd.DataFrame:
        old = rows.groupby(["grp", "bin"], sort=False).ngroup().to_numpy()
        bins, offset, left = _arranged(rows["length"].to_numpy(), room, groups == 1, old)
        out = rows.assign(grp=rows["_to"], bin=bins, offset=offset, given=left)
        return out[columns]

    to = F.pmod(F.xxhash64("grp", "bin"), F.lit(groups))
    return given.withColumn("_to", to).groupBy("_to").applyInPandas(again, given.schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    pattern: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    max_len: int = 4096,
    end_id: int = 1,
    batch_pieces: int = 1 << 18,
    exchange_pieces: int = 1 << 16,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's ids, ended by `end_id`, in few sequences of at most `max_len`.

    One row per piece: `doc_id, piece, start, length, ids_crc32, sequence_id, offset` (and
    `ids`, little-endian unsigned 32-bit, with `with_ids=True`). Only documents above
    `max_len` are cut; their pieces are full but for the last. `pattern=None` names a
    tokenizer of whole words, else the pattern of a byte-level one (see `tokens`).

    Null and empty texts are `end_id` alone. Very long texts are encoded whole, by the
    library itself where white space or a word runs on without end. Rows that repeat an
    id, or have none, are documents of their own; equal lengths go in order of arrival.
    An empty table gives no rows. Other columns are not read, whatever their names.
    """
    named = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    first = _first_packing(named, tokenizer, pattern, max_len, end_id, batch_pieces, with_ids)
    now = staged(first, "packed")
    settled = []
    for turn in range(ROUNDS + 1):
        sequence = F.lit(turn << 57) + F.shiftleft("grp", 25) + F.col("bin")
        n, before = now.where("given").agg(F.count("*"), F.count_distinct("grp", "bin")).first()
        groups = -(-n // exchange_pieces)
        end = turn == ROUNDS or before < 2
        if not end:
            dealt = staged(_dealt_anew(now.where("given"), groups, max_len), "repacked")
            after = dealt.agg(F.count_distinct("grp", "bin")).first()[0]
            if after == before:
                drop(dealt)
                end = True
        kept = now if end else now.where("not given")
        settled.append(kept.withColumn("sequence_id", sequence))
        if end:
            break
        now = dealt
    out = settled[0]
    for other in settled[1:]:
        out = out.unionByName(other)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(*columns, *["ids"] * with_ids)


def certificate(packed: DataFrame, max_len: int = 4096) -> tuple[int, int]:
    """(sequences used, sequences that any packing of these pieces needs).

    The histogram of lengths that reaches the driver has at most `max_len` lines.
    """
    counts = np.zeros(max_len + 1, np.int64)
    for length, n in packed.groupBy("length").count().collect():
        counts[length] = n
    used = packed.agg(F.count_distinct("sequence_id")).first()[0]
    return used, lower_bound(counts, max_len)
