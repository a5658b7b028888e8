"""Line dedup by pairwise alignment.

Documents that share rare lines, or a whole passage, are paired through hashes, each
pair is aligned with patience diff, and common blocks are deleted from the later document.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of aligned places of two sequences, rising in both.

    Equal ends are aligned first. Between them the lines that occur once on either
    side are anchors, of which the longest rising run stays; the gaps between
    anchors are aligned the same way. Where no line occurs once on either side, the
    first occurrences of a line are taken for one another, the second ones, and so on.
    """
    found, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, i_end, j, j_end = gaps.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {b[y]: y for y in range(j, j_end) if in_b[b[y]] == 1}
        once = [(x, place[a[x]]) for x in range(i, i_end) if in_a[a[x]] == 1 and a[x] in place]
        anchors = _rising(once or _by_occurrence(a, i, i_end, b, j, j_end))
        if not anchors:
            continue
        found += anchors
        edges = [(i - 1, j - 1), *anchors, (i_end, j_end)]
        gaps += [
            (x + 1, u, y + 1, v)
            for (x, y), (u, v) in zip(edges, edges[1:], strict=False)
            if x + 1 < u and y + 1 < v
        ]
    return sorted(found)


def _by_occurrence(a: list, i: int, i_end: int, b: list, j: int, j_end: int) -> list[tuple[int, int]]:
    """Places of equal lines that are as often repeated before on either side."""
    places: dict = {}
    for y in range(j, j_end):
        places.setdefault(b[y], []).append(y)
    seen: Counter = Counter()
    out = []
    for x in range(i, i_end):
        k = seen[a[x]]
        if k < len(places.get(a[x], ())):
            out.append((x, places[a[x]][k]))
        seen[a[x]] += 1
    return out


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence that rises in the second place, too."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        p = bisect_left(tops, y)
        back.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(y)
            piles.append(k)
        else:
            tops[p], piles[p] = y, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_blocks(
    a_pos: np.ndarray, a_line: np.ndarray, b_pos: np.ndarray, b_line: np.ndarray, b_words: np.ndarray, min_words: int
) -> list[int]:
    """Places in the later document `b` of common blocks with `min_words` words or more.

    A block is a run of lines aligned one after the other in both documents; the
    places number the lines that are not blank, so blank lines end no block. What
    one alignment leaves over is aligned again, so passages that come in another
    order in the later document are found as well. An alignment takes each line of
    `a` once; runs of `b` that it leaves or splits are looked up among the runs of `a`,
    so in the end a line is in the result if and only if it lies in a common block.
    """
    in_a, in_b = np.isin(a_line, b_line), np.isin(b_line, a_line)
    if b_words[in_b].sum() < min_words:
        return []
    pairs: list[tuple[int, int]] = []
    a_left = list(zip(a_pos[in_a].tolist(), a_line[in_a].tolist(), strict=True))
    b_left = list(zip(b_pos[in_b].tolist(), b_line[in_b].tolist(), strict=True))
    while a_left and b_left:
        found = patience([h for _, h in a_left], [h for _, h in b_left])
        if not found:
            break
        pairs += [(a_left[x][0], b_left[y][0]) for x, y in found]
        used_a, used_b = {x for x, _ in found}, {y for _, y in found}
        a_left = [p for x, p in enumerate(a_left) if x not in used_a]
        b_left = [p for y, p in enumerate(b_left) if y not in used_b]
    words = dict(zip(b_pos.tolist(), b_words.tolist(), strict=True))
    gone: list[int] = []
    block: list[int] = []
    last = None
    for x, y in [*sorted(pairs, key=lambda p: p[1]), (None, None)]:
        if last is not None and (x, y) != (last[0] + 1, last[1] + 1):
            if sum(words[k] for k in block) >= min_words:
                gone += block
            block = []
        block.append(y)
        last = (x, y)
    return sorted({*gone, *_held_again(a_pos, a_line, b_pos, b_line, b_words, in_a, in_b, gone, min_words)})


def _held_again(
    a_pos: np.ndarray, a_line: np.ndarray, b_pos: np.ndarray, b_line: np.ndarray, b_words: np.ndarray,
    in_a: np.ndarray, in_b: np.ndarray, gone: list[int], min_words: int,
) -> set[int]:
    """Places of `b` in a run that `a` has, too, from stretches with lines not in `gone`."""
    pos, line, words = b_pos[in_b], b_line[in_b], b_words[in_b]
    stretch = np.cumsum(np.diff(pos, prepend=pos[:1]) > 1)
    long = np.bincount(stretch, words) >= min_words
    some = long & (np.bincount(stretch, ~np.isin(pos, gone)) > 0)
    if not some.any():
        return set()
    pos, line, words = (c[some[stretch]] for c in (pos, line, words))
    size = dict(zip(line.tolist(), words.tolist(), strict=True))
    a_words = np.array([size.get(h, 0) for h in a_line[in_a].tolist()])
    known = set(passages(a_pos[in_a], a_line[in_a], a_words, min_words))
    found: set[int] = set()
    for x, y, run in _runs(pos, line, words, min_words):
        if run in known:
            found.update(pos[x : y + 1].tolist())
    return found


def passages(pos: np.ndarray, line: np.ndarray, words: np.ndarray, min_words: int) -> list[int]:
    """Hashes of the shortest runs with `min_words` words that start or end at each line.

    `line` and `words` stand at the rising places `pos`; a run has no place left out.
    Of two documents with a common block of that many words, both have each of its
    lines in such a run within the block.
    """
    found = {run for _, _, run in _runs(pos, line, words, min_words)}
    return sorted(found)


def _runs(pos: np.ndarray, line: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """(first, last, hash) of the runs of `passages`, as indexes into `pos`."""
    n = len(pos)
    both = np.column_stack([line, words]).astype("<i8")
    sums = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    run = np.cumsum(np.diff(pos, prepend=pos[:1]) > 1)
    here = range(n)
    stop = (np.searchsorted(sums, sums[:-1] + min_words) - 1).tolist()
    start = (np.searchsorted(sums, sums[1:] - min_words, side="right") - 1).tolist()
    spans = sorted({*zip(here, stop, strict=True), *zip(start, here, strict=True)})
    whole = [(x, y) for x, y in spans if x >= 0 and y < n and run[x] == run[y]]
    found = np.array([xxhash.xxh64_intdigest(both[x : y + 1].tobytes()) for x, y in whole], np.uint64)
    return [(x, y, h) for (x, y), h in zip(whole, found.view(np.int64).tolist(), strict=True)]


def repeated_lines(
    docs: DataFrame, text: str, doc_id: str, min_words: int, rare: int
) -> DataFrame:
    """(`key`, `gone`): the line numbers, from 0 and sorted, to delete from a document.

    `key` is the struct (id, hash of the text); documents come in its order.
    """
    key = F.struct(F.col(doc_id).alias("d"), F.xxhash64(F.col(text)).alias("t"))
    numbered = F.transform(
        F.split(F.col(text), "\n", -1), lambda line, pos: F.struct(pos.alias("pos"), line.alias("line"))
    )
    # `k` counts the lines that are not blank, so that blank ones end no run; `pos` counts all.
    split = F.posexplode(F.filter(numbered, lambda x: x["line"].rlike(r"\S"))).alias("k", "x")
    words = F.size(F.filter(F.split("line", r"\s+"), lambda w: w != ""))
    lines = staged(
        docs.select(key.alias("key"), split)
        .select("key", "k", "x.pos", "x.line")
        .select("key", "k", "pos", F.xxhash64("line").alias("h"), words.alias("w")),
        "lines",
    )
    spread = lines.groupBy("h", "w").agg(
        F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("n")
    )
    # Staged, so that the join deals lines only for itself and a hot line can be split.
    shared = staged(spread.where("first != last").select("h", "w", "n"), "repeated-lines")
    held = staged(lines.join(shared, ["h", "w"]), "shared-lines")
    shape = held.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("k", "pos", "h", "w"))).alias("s"))
    shape = staged(
        shape.select("key", *(F.col(f"s.{c}").alias(c) for c in ("k", "pos", "h", "w"))), "shapes"
    )

    # Rare lines pair every two of their few holders.
    few = held.where(F.col("n") <= rare)
    holders = few.groupBy("h", "w").agg(F.collect_set("key").alias("keys"))
    close = holders.select(F.explode("keys").alias("b"), "keys").select("b", F.explode("keys").alias("a"))

    # A passage pairs each holder with the first one, however many hold it or its lines.
    @F.pandas_udf("array<long>")
    def runs(k: pd.Series, line: pd.Series, words: pd.Series) -> pd.Series:
        rows = zip(k, line, words, strict=True)
        return pd.Series([passages(*row, min_words) for row in rows], dtype=object)

    held_runs = staged(shape.select("key", F.explode(runs("k", "h", "w")).alias("run")), "passages")
    spread = held_runs.groupBy("run").agg(F.min("key").alias("a"), F.max("key").alias("last"))
    again = staged(spread.where("a != last").select("run", "a"), "repeated-passages")
    far = held_runs.join(again, "run").select(F.col("key").alias("b"), "a")
    pairs = close.where("a < b").unionByName(far.where("a < b")).distinct()
    sides = pairs
    for side in ("a", "b"):
        own = shape.select(F.col("key").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in ("k", "pos", "h", "w")))
        sides = sides.join(own, side)
    flat = sides.select(
        F.col("b.d").alias("d"), F.col("b.t").alias("t"), "a_k", "a_h", "b_k", "b_h", "b_w", "b_pos"
    )

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = zip(batch.a_k, batch.a_h, batch.b_k, batch.b_h, batch.b_w, batch.b_pos, strict=True)
            gone = [
                pos[np.searchsorted(sides[2], common_blocks(*sides, min_words))].tolist() for *sides, pos in rows
            ]
            out = batch[["d", "t"]].assign(gone=gone)
            yield out[[bool(g) for g in gone]]

    kind = docs.schema[doc_id].dataType.simpleString()
    cut = flat.mapInPandas(align, f"d {kind}, t long, gone array<int>")
    return (
        cut.select(F.struct("d", "t").alias("key"), F.explode("gone").alias("pos"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )


def dedup_lines(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 25, rare: int = 8
) -> DataFrame:
    """`docs` with common blocks of `min_words` words or more deleted from later documents.

    All columns stay, whatever their names; `text` changes, and `lines_removed` (array of
    line numbers from 0) is added in place of a column of that name in any case. Documents
    are ordered by id, a null id first, and by text where an id repeats; rows equal in both
    are one document, so none of them is later than the other. The first document to hold a
    passage keeps it. Lines are compared as they are; blank lines match nothing, end no
    passage and stay. A null text stays null and an empty one empty, an empty table gives an
    empty table. A very long text is compared whole, as one row of line hashes.
    """
    names = [c for c in docs.columns if c.lower() != "lines_removed"]
    # numbered columns inside: no given name can clash with another, a dot or the operator's own
    inner = docs.select(*[docs[_quoted(c)].alias(f"c{k}") for k, c in enumerate(names)])
    own_text, own_id = (f"c{names.index(_same(names, c))}" for c in (text, doc_id))
    found = repeated_lines(inner, own_text, own_id, min_words, rare)
    found = found.select(F.col("key").alias("found_key"), F.col("gone").alias("found_gone"))
    key = F.struct(inner[own_id].alias("d"), F.xxhash64(inner[own_text]).alias("t"))
    lines = F.transform(
        F.split(F.col(own_text), "\n", -1), lambda line, k: F.struct(k.alias("k"), line.alias("line"))
    )
    rest = F.filter(lines, lambda x: ~F.array_contains(F.col("found_gone"), x["k"]))
    cleaned = F.when(F.col("found_gone").isNull(), F.col(own_text)).otherwise(
        F.array_join(F.transform(rest, lambda x: x["line"]), "\n")
    )
    joined = inner.join(found.hint("shuffle_hash"), key == F.col("found_key"), "left")
    columns = [
        (cleaned if f"c{k}" == own_text else F.col(f"c{k}")).alias(c) for k, c in enumerate(names)
    ]
    none = F.array().cast("array<int>")
    return joined.select(*columns, F.coalesce(F.col("found_gone"), none).alias("lines_removed"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _same(names: list[str], wanted: str) -> str:
    """The column that is meant by `wanted`: itself, or else the one that differs by case only."""
    return wanted if wanted in names else next(c for c in names if c.lower() == wanted.lower())
