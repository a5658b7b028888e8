"""Sequence packing as a cutting-stock problem solved by column generation.

Documents are tokenised where they lie. Only the histogram of piece lengths, at
most `CLASSES` numbers, reaches the driver; there a linear program over patterns
(multisets of lengths that fit a sequence) is solved, its patterns priced by a
knapsack recursion, and rounded. Documents then take their places in the patterns
by their rank within their length class, again where they lie.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged
from .tokens import encoder

#: Lengths are rounded up to multiples of max_len / CLASSES for the program, which
#: bounds it whatever the data; the places in a sequence use the true lengths.
CLASSES = 256

#: Pieces of up to this share of a sequence travel in bundles of up to that share, which
#: the program takes for one piece: rounding up costs little of a bundle, but much of a
#: single short piece.
SHORT, BUNDLE = 1 / 32, 1 / 4


def units(max_len: int) -> tuple[int, int]:
    """Ids per class step, and how many steps a sequence holds.

    A piece that needs more steps than there are fills a sequence on its own.
    """
    unit = -(-max_len // CLASSES)
    return unit, max_len // unit


def pieces(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    max_len: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most `max_len` ids per document, ranked in their class per partition.

    Columns `doc_id, start, length, ids_crc32, doc_tokens, cls, part, place, inner`, and
    `ids` (binary) on request. Pieces of a bundle share class and rank and are told apart
    by `inner`. Every document ends with `end_id`; null and empty texts are that id alone.
    Very long texts are encoded whole (see `tokens` for those without end of white space).
    """
    unit, room = units(max_len)
    short, bundle = int(max_len * SHORT), int(max_len * BUNDLE)
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "cls", "part", "place", "inner"]
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64(), pa.int32()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer, pattern), TaskContext.get().partitionId()
        ranked = np.zeros(CLASSES + 1, np.int64)
        held: list[tuple] = []  # short pieces of a bundle that is still open
        filled = 0

        def placed(together: list[tuple], length: int) -> list[tuple]:
            cls = min(room, -(-length // unit))
            ranked[cls] += 1
            at = (cls, part, ranked[cls] - 1)
            return [(*p[:5], *at, k, p[5]) for k, p in enumerate(together)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 10
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
            if with_ids:
                arrays.append(pa.array(columns[9], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names + ["ids"] * with_ids)

        for batch in batches:
            rows: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(body.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, max_len):
                    own = ids[4 * start : 4 * (start + max_len)]
                    n = len(own) // 4
                    piece = (doc, start, n, zlib.crc32(own), total, own if with_ids else None)
                    if n > short:
                        rows += placed([piece], n)
                        continue
                    if filled + n > bundle:
                        rows += placed(held, filled)
                        held, filled = [], 0
                    held.append(piece)
                    filled += n
            yield batch_of(rows)
        if held:
            yield batch_of(placed(held, filled))

    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int, part int, place long, inner int"
        + ", ids binary" * with_ids
    )
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(cut, schema)


def best_pattern(worth: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within `room` that is worth most: unbounded knapsack."""
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fits = size <= r
        gain = np.where(fits, worth + best[np.where(fits, r - size, 0)], -1.0)
        k = int(gain.argmax())
        best[r], took[r] = max((best[r - 1], -1), (gain[k], k))
    counts, r = np.zeros(len(size), np.int64), room
    while r > 0:
        if took[r] < 0:
            r -= 1
        else:
            counts[took[r]] += 1
            r -= size[took[r]]
    return float(best[room]), counts


def cutting_patterns(
    need: np.ndarray, room: int = CLASSES, rounds: int = 500, gap: float = 5e-4
) -> list[tuple[np.ndarray, int]]:
    """(items per class, how many sequences) that hold all of `need` (index = size).

    Column generation: from a first basis of well filled patterns, the dual prices
    of the program's rows price a new pattern by knapsack until the sequences used
    are within `gap` of the bound that the prices give. Each solution on the way can
    be used, so `rounds` limits only the time spent. Fractions are rounded down;
    what is left, less than one sequence per pattern, is packed longest first.
    """
    size = np.flatnonzero(need[: room + 1])
    if not len(size):
        return []
    left, m = need[size].astype(np.int64), len(size)
    # A little noise in the demand keeps degenerate pivots from going round in circles.
    demand = left * (1 + 1e-6 * np.random.default_rng(0).random(m))
    basis = _first_basis(demand, size, room)
    inverse = _inverse(basis)
    amounts = np.maximum(_times(inverse, demand), 0)
    bound = float(demand @ size) / room
    for k in range(rounds):
        if k % 50 == 49:
            inverse = _inverse(basis)
            amounts = np.maximum(_times(inverse, demand), 0)
        prices = np.maximum(inverse.sum(axis=0), 0)
        value, counts = best_pattern(prices, size, room)
        bound = max(bound, float(prices @ demand) / max(1.0, value))
        if value <= 1 + 1e-7 or amounts.sum() <= bound * (1 + gap):
            break
        step = _times(inverse, counts)
        able = step > 1e-7
        if not able.any():
            break
        ratio = np.where(able, amounts / np.where(able, step, 1), np.inf)
        # Among the rows that leave first, the largest pivot is the safest.
        out = int(np.where(ratio <= ratio.min() + 1e-9, step, -1).argmax())
        amounts = np.maximum(amounts - ratio[out] * step, 0)
        amounts[out] = ratio[out]
        basis[:, out] = counts
        inverse[out] /= step[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(step[others], inverse[out])
    patterns = []
    for p in np.flatnonzero(amounts >= 1 - 1e-6):
        counts = np.rint(basis[:, p]).astype(np.int64)
        used = counts > 0
        times = min(int(amounts[p] + 1e-6), int((left[used] // counts[used]).min()))
        if times:
            patterns.append((counts, times))
            left -= counts * times
    while left.any():
        counts, free = np.zeros(m, np.int64), room
        for c in np.flatnonzero(left)[::-1]:
            counts[c] = min(left[c], free // size[c])
            free -= counts[c] * size[c]
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        patterns.append((counts, times))
        left -= counts * times
    out = []
    for counts, times in patterns:
        full = np.zeros(room + 1, np.int64)
        full[size] = counts
        out.append((full, times))
    return out


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination with row pivots.

    The library's threaded routine was seen to hang in a driver beside its JVM; at
    `CLASSES` rows nothing is lost without it.
    """
    m = len(matrix)
    both = np.hstack([matrix, np.eye(m)])
    for k in range(m):
        p = k + int(np.abs(both[k:, k]).argmax())
        both[[k, p]] = both[[p, k]]
        both[k] /= both[k, k]
        others = np.flatnonzero(both[:, k])
        others = others[others != k]
        both[others] -= both[others, k, None] * both[k]
    return both[:, m:]


def _first_basis(demand: np.ndarray, size: np.ndarray, room: int) -> np.ndarray:
    """One pattern per size that use up the demand one size at a time.

    Each holds the largest size left and the fullest choice beside it. Since later
    patterns hold none of the sizes used up before, the matrix is triangular.
    """
    left, basis = demand.copy(), np.zeros((len(size), len(size)))
    alive = np.ones(len(size), bool)
    for p in range(len(size)):
        top = int(np.flatnonzero(alive)[-1])
        worth = np.where(alive, size * (1 + 1e-4 * left / left.max()), -1.0)
        _, counts = best_pattern(worth, size, room - size[top])
        counts[top] += 1
        basis[:, p] = counts
        ratio = np.where(counts > 0, left / np.maximum(counts, 1), np.inf)
        out = int(ratio.argmin())
        left = np.maximum(left - ratio[out] * counts, 0)
        left[out], alive[out] = 0, False
    return basis


@dataclass
class Places:
    """Where each rank of each class goes, as sorted intervals of ranks."""

    key: np.ndarray  # class * 2^44 + first rank
    each: np.ndarray  # items of the class in one sequence of the pattern
    base: np.ndarray  # first sequence of the pattern

    @classmethod
    def of(cls, patterns: list[tuple[np.ndarray, int]]) -> Places:
        found, rank, base = [], np.zeros(CLASSES + 1, np.int64), 0
        for counts, times in patterns:
            for c in np.flatnonzero(counts):
                found.append(((int(c) << 44) + int(rank[c]), int(counts[c]), base))
                rank[c] += counts[c] * times
            base += times
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        return cls(table[:, 0], table[:, 1], table[:, 2])

    def sequence(self, cls: np.ndarray, rank: np.ndarray) -> np.ndarray:
        at = (cls.astype(np.int64) << 44) + rank
        k = np.searchsorted(self.key, at, side="right") - 1
        return self.base[k] + (at - self.key[k]) // self.each[k]


def pack(
    docs: DataFrame, tokenizer: str, pattern: str, max_len: int = 2048, **how
) -> DataFrame:
    """Every document's ids packed into sequences of at most `max_len`.

    One row per piece: `doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset` (and `ids` with `with_ids=True`); options as in `pieces`. Short pieces are
    bundled, so padding stays low for tables of them, too. Null and empty texts are one
    id, texts of any length are cut without loss, rows that repeat an id (or have none) are documents of
    their own, an empty table gives no sequences, and other columns are not read.
    """
    cut = staged(pieces(docs, tokenizer, pattern, max_len=max_len, **how), "pieces")
    cells = staged(cut.where("inner = 0").groupBy("part", "cls").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    need = np.zeros(CLASSES + 1, np.int64)
    for c, n in cells.groupBy("cls").agg(F.sum("n")).collect():
        need[c] = n
    places = Places.of(cutting_patterns(need, units(max_len)[1]))

    @F.pandas_udf("long")
    def sequence(cls: pd.Series, rank: pd.Series) -> pd.Series:
        return pd.Series(places.sequence(cls.to_numpy(), rank.to_numpy()))

    before = Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        "part", "cls", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    ranked = cut.join(offsets, ["part", "cls"]).withColumn("rank", F.col("first") + F.col("place"))
    ahead = (
        Window.partitionBy("sequence_id")
        .orderBy("cls", "rank", "inner")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return (
        ranked.withColumn("sequence_id", sequence("cls", "rank"))
        .withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
        .select(*kept, *(["ids"] if "ids" in cut.columns else []))
    )
