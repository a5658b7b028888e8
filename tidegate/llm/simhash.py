"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits per text, then every pair of fingerprints that differ in
at most `max_bits` bits is found by probing: the bits are cut into segments with a
radius each, so that a pair within `max_bits` lies within the radius in one
segment at least. The table holds each fingerprint under its segment values, a
probe enumerates the small Hamming ball around its own value, and the join checks
the complete distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import components, free_name, sized, staged

BITS = 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, 65536):
        hashes = [
            digest(joined[i:j], 42)
            for i, j in zip(starts[k : k + 65536], stops[k : k + 65536], strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = 4) -> Column:
    """Signed long with the fingerprint's bits."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return of(text)


def segments(max_bits: int, count: int) -> list[tuple[int, int]]:
    """(mask, radius) per segment; the radii plus one sum to max_bits + 1.

    A pair that misses every segment differs by radius + 1 bits in each of them,
    so by more than `max_bits` in all.
    """
    count = min(count, max_bits + 1)
    each, more = divmod(max_bits + 1 - count, count)
    out, low = [], 0
    for k in range(count):
        width = BITS // count + (k >= count - BITS % count)
        out.append((((1 << width) - 1) << low, each + (k < more)))
        low += width
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _balls(parts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(segment, mask, bits to flip) of every probe of a fingerprint."""
    out = []
    for k, (mask, radius) in enumerate(parts):
        bits = [b for b in range(BITS) if mask >> b & 1]
        for r in range(radius + 1):
            out += [(k, mask, sum(1 << b for b in some)) for some in combinations(bits, r)]
    return out


def _table(prints: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """(`b`, `seg`, `val`): each fingerprint under the value of each of its segments."""
    entries = F.array(
        *(F.struct(F.lit(k).alias("seg"), F.lit(_signed(m)).alias("mask")) for k, (m, _) in enumerate(parts))
    )
    return prints.select("*", F.explode(entries).alias("e")).select(
        F.col("fp").alias("b"),
        *(F.col(c).alias(f"b_{c}") for c in prints.columns if c != "fp"),
        F.col("e.seg").alias("seg"),
        F.col("fp").bitwiseAND(F.col("e.mask")).alias("val"),
    )


def _probes(prints: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """(`a`, `seg`, `val`): the values within each segment's radius of each fingerprint."""
    probes = F.array(
        *(
            F.struct(F.lit(k).alias("seg"), F.lit(_signed(m)).alias("mask"), F.lit(_signed(x)).alias("flip"))
            for k, m, x in _balls(parts)
        )
    )
    return prints.select("*", F.explode(probes).alias("p")).select(
        F.col("fp").alias("a"),
        *(F.col(c).alias(f"a_{c}") for c in prints.columns if c != "fp"),
        F.col("p.seg").alias("seg"),
        F.col("fp").bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.mask")).alias("val"),
    )


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(prints: DataFrame, max_bits: int = 4, segment_count: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most `max_bits` apart.

    `prints` has one distinct long column `fp`. More probes and fewer rows per
    table entry come with fewer segments: 3 segments mean 45 probes for 4 bits,
    2 segments 562. A cluster of n gives up to n^2 / 2 pairs; `groups` needs them not.
    """
    parts = segments(max_bits, segment_count)
    table = sized(_table(prints, parts), prints.count() * len(_balls(parts)))
    found = _probes(prints, parts).join(table, ["seg", "val"])
    return found.where((F.col("a") < F.col("b")) & _near("a", "b", max_bits)).select("a", "b").distinct()


#: Distinct fingerprints up to which three segments serve; beyond, their buckets grow long.
THREE_SEGMENTS = 10_000_000


def groups(prints: DataFrame, max_bits: int = 4, segment_count: int | None = None) -> DataFrame:
    """`node, component` of every fingerprint that is linked to another.

    The components of all `links`, from far fewer rows. First each fingerprint is linked to
    the smallest one of each segment value it has, if that is near: a cluster collapses
    by as many rows as it has members. Then the probes look for near pairs across what
    has been found so far, and these are all that is left to join. `prints` is staged.
    """
    n = prints.count()
    if segment_count is None:
        segment_count = 3 if n <= THREE_SEGMENTS else 2
    parts = segments(max_bits, segment_count)
    table = _table(prints, parts)
    least = table.groupBy("seg", "val").agg(F.min("b").alias("a"))
    stars = table.join(sized(least, n * len(parts)), ["seg", "val"]).where((F.col("a") < F.col("b")) & _near("a", "b", max_bits))
    stars = staged(stars.select("a", "b").distinct(), "simhash-stars")
    so_far = components(stars).withColumnRenamed("node", "fp")
    known = prints.join(sized(so_far, n), "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"))
    known = staged(known, "simhash-roots")
    table = sized(_table(known, parts), n * len(_balls(parts)))
    pairs = _probes(known, parts).join(table, ["seg", "val"])
    across = pairs.where(
        (F.col("a") < F.col("b")) & (F.col("a_root") != F.col("b_root")) & _near("a", "b", max_bits)
    )
    across = across.select(
        F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")
    ).distinct()
    return components(stars.unionByName(across))


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = 4,
    max_bits: int = 4,
    segment_count: int | None = None,
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `fingerprint` (hex), `component_id`.

    Equal fingerprints are one node, so exact copies cost one row of the search
    whatever their number. `component_id` is the smallest id of the group. Null and
    empty texts have fingerprint zero and are linked like any other. Rows with a
    null id belong to the group of their text and never name it; a group of such
    rows alone has a null component. Other columns of `docs` are not read; an empty
    table gives an empty result. Very long texts are hashed whole, in pieces of 65,536
    shingles. `segment_count` follows from the number of fingerprints unless it is given;
    the result is the same.
    """
    rows = staged(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), fingerprints(F.col(text), shingle).alias("fp")
        ),
        "prints",
    )
    nodes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = groups(nodes.select("fp"), max_bits, segment_count).withColumnRenamed("node", "fp")
    n = nodes.count()
    placed = staged(nodes.join(sized(found, n), "fp", "left"), "placed")
    alone = placed.where(F.col("component").isNull()).select("fp", "least")
    joined = placed.where(F.col("component").isNotNull())
    least = joined.groupBy("component").agg(F.min("least").alias("least"))
    members = joined.select("fp", "component").join(sized(least, n), "component")
    named = alone.unionByName(members.select("fp", "least")).withColumnRenamed("least", "component_id")
    return rows.join(sized(named, n), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """The rows of `docs` whose id names their group, with all their columns.

    Rows with a null id are kept, since no other row stands for them for certain.
    Rows that repeat an id all stay or all go.
    """
    found = near_duplicates(docs, text, doc_id, **how)
    mark = free_name(docs, "gone_id")
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(gone, docs[doc_id] == gone[mark], "left_anti")
