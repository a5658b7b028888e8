"""Which sources of a language use words as no other does: divergences over shared terms.

Equal texts of a language collapse to one row with their number per source, so each is
cut into terms once and its counts are added with weights. Pairs of sources are evaluated
sparsely: what two sources have in common is summed term by term, all terms that only one
of them has by the histogram of its counts, and the terms of neither in one product.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import BROADCAST_KEY_BYTES, BROADCAST_ROWS
from .shared import staged

#: Letters A to Z of either case and everything beyond ASCII, as bytes of lower-cased UTF-8.
TERM = re.compile(rb"[a-z\x80-\xff]+")
ONE = 1_000_000_000
#: Counters of a task are handed on at so many entries, pairs summed up at so many.
ENTRIES, PAIRS = 1_500_000, 1 << 22
EXACT = "decimal(38,0)"


def _distinct_texts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per language and text with its copies per source, and all groups.

    Copies are counted by digest; each text then travels once per task that holds it.
    """
    empty = F.lit("")
    rows = docs.select(
        *(F.coalesce(docs[f"`{c}`"].cast("string"), empty).alias(c) for c in ("lang", "source", "text"))
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    counted = staged(rows.groupBy("lang", "source", "digest").agg(F.count("*").alias("n")), "copies")
    copies = counted.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
    groups = counted.groupBy("lang", "source").agg(F.sum("n").alias("docs"))
    return texts.join(copies, ["lang", "digest"]).select("lang", "text", "copies"), groups


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each source (and, without a source, documents with the term) in this task."""
    # Terms are numbered per language, so that each is held once, whatever its sources.
    numbers: dict[str, dict[bytes, int]] = {}
    uses: dict[tuple[str, str], dict[int, int]] = {}
    having: dict[str, list[int]] = {}

    def rows(lang: str, source: str | None, terms: np.ndarray, n: list[int]) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(terms), 100_000):
            own = terms[k : k + 100_000]
            columns = [pa.array([x] * len(own), pa.string()) for x in (lang, source)]
            columns += [pa.array(own, pa.binary()), pa.array(n[k : k + 100_000], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n"])

    def handed_on() -> Iterator[pa.RecordBatch]:
        for lang, own in numbers.items():
            terms = np.array([*own, None], object)[:-1]
            yield from rows(lang, None, terms, having[lang])
            for source in [s for x, s in uses if x == lang]:
                found = uses.pop((lang, source))
                yield from rows(lang, source, terms[list(found)], list(found.values()))
        numbers.clear()
        having.clear()

    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lang, text, copies in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
            body = text.as_py().lower()
            own = Counter(TERM.findall(body)) if len(body) < 1 << 22 else Counter(m[0] for m in TERM.finditer(body))
            known, seen = numbers.setdefault(lang, {}), having.setdefault(lang, [])
            ids = [known.setdefault(term, len(known)) for term in own]
            seen += [0] * (len(known) - len(seen))
            held = sum(c["n"] for c in copies)
            for i in ids:
                seen[i] += held
            for c in copies:
                into, times = uses.setdefault((lang, c["source"]), {}), c["n"]
                get = into.get
                into.update({i: n * times + get(i, 0) for i, n in zip(ids, own.values())})
        if sum(map(len, uses.values())) > ENTRIES:
            yield from handed_on()
    yield from handed_on()


def _share(n: str, of: str) -> Column:
    """1 + floor(10^9 (n + 1) / of), exact for any count."""
    return F.expr(
        f"1 + (cast({ONE} as decimal(10,0)) * cast({n} + 1 as decimal(20,0))) div cast({of} as decimal(20,0))"
    )


def _f(p: str, q: str) -> Column:
    """(p - q)^2 / q in whole numbers; p and q are at most 10^9 + 1."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _small(table: DataFrame) -> DataFrame:
    """`table`, marked for broadcast if its counted rows and bytes allow."""
    n, size = table.agg(F.count("*"), F.sum(F.octet_length("lang") + F.octet_length("source"))).first()
    return F.broadcast(table) if n <= BROADCAST_ROWS and (size or 0) <= BROADCAST_KEY_BYTES else table


def _in_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources, over the terms both have: what the sums by histogram miss."""
    langs: dict[str, int] = {}
    keys: list[np.ndarray] = []
    sums: list[np.ndarray] = []

    def summed() -> tuple[np.ndarray, np.ndarray]:
        key, total = np.concatenate(keys), np.concatenate(sums)
        order = np.lexsort(key.T[::-1])
        key, total = key[order], total[order]
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        return key[first], np.add.reduceat(total, first)

    def handed_on() -> pa.RecordBatch:
        names = np.array(list(langs), object)
        key, total = keys[0], sums[0]
        columns = [pa.array(names[key[:, 0]], pa.string()), *map(pa.array, (key[:, 1], key[:, 2], total))]
        keys.clear()
        sums.clear()
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    for batch in batches:
        code = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], np.int64)
        posts = batch.column(1)
        sizes = np.diff(posts.offsets.to_numpy())
        values = posts.flatten()
        idx, p, p0 = (values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        row = np.repeat(np.arange(len(sizes)), sizes)
        start = (np.cumsum(sizes) - sizes)[row]
        width = sizes[row]
        done = np.cumsum(width)
        at = 0
        while at < len(row):
            stop = max(at + 1, int(np.searchsorted(done, done[at] - width[at] + PAIRS, side="right")))
            own = np.arange(at, stop)
            left = np.repeat(own, width[at:stop])
            inner = np.arange(len(left)) - np.repeat(np.cumsum(width[at:stop]) - width[at:stop], width[at:stop])
            right = start[left] + inner
            other = left != right
            left, right = left[other], right[other]
            if len(left):
                pa_, pb, za, zb = p[left], p[right], p0[left], p0[right]
                part = f(pa_, pb) - f(pa_, zb) - f(za, pb) + f(za, zb)
                keys.append(np.stack([code[row[left]], idx[left], idx[right]], 1))
                sums.append(part)
                key, total = summed()
                keys[:], sums[:] = [key], [total]
                if len(key) > PAIRS:
                    yield handed_on()
            at = stop
    if keys:
        yield handed_on()


def audit(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """`lang, source, part, item, value, rank` for every language and source that occurs.

    Terms are runs of letters A to Z and of characters beyond ASCII, only A to Z being
    lower-cased; a language keeps those in at least `min_docs` of its documents. A group
    gives a kept term with n uses the share p = 1 + floor(10^9 (n + 1) / (N + V)): N counts
    its uses of kept terms, V the kept terms. Part `pair`: each other source of the
    language with the sum of floor((p - q)^2 / q) over all kept terms, q being its shares.
    Part `term`: the `top` terms of the group whose share exceeds the language's, by the
    same measure. Ranks count from 1, ties by item in the order of UTF-8.

    Null text, lang and source are empty strings, and the empty source is a source.
    Repeated rows are documents. A language without kept terms gives pairs of value 0. Very
    long texts are walked without a list of their words. An empty table gives no rows;
    other columns are not read. All sums are whole numbers.
    """
    texts, groups = _distinct_texts(docs)
    counted = texts.mapInArrow(_counted, "lang string, source string, term binary, n long")
    uses = F.col("source").isNotNull()
    kept = staged(
        counted.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang", "term")
        .agg(
            F.sum(F.when(~uses, F.col("n"))).alias("having"),
            F.sum(F.when(uses, F.col("n"))).alias("total"),
            F.collect_list(F.when(uses, F.struct("source", "n"))).alias("posts"),
        )
        .where(F.col("having") >= min_docs)
        .select("lang", F.col("term").cast("string").alias("term"), "total", "posts")
        .withColumn("tid", F.monotonically_increasing_id()),
        "kept-terms",
    )
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all"))
    single = kept.select("lang", "term", "total", "tid", F.explode("posts").alias("post"))
    single = single.select("lang", "term", "total", "tid", "post.source", "post.n")
    of_group = single.groupBy("lang", "source").agg(F.sum("n").alias("uses"), F.count("*").alias("terms"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    table = staged(
        groups.join(of_group, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .select(
            "lang", "source", number.alias("idx"), "v", (F.col("all") + F.col("v")).alias("d_lang"),
            F.coalesce("terms", F.lit(0)).alias("terms"),
            (F.coalesce("uses", F.lit(0)) + F.col("v")).alias("d"),
        )
        .withColumn("p0", _share("0", "d")),
        "sources",
    )
    small = _small(table)
    posts = staged(
        single.join(small.drop("v", "terms"), ["lang", "source"])
        .withColumn("p", _share("n", "d"))
        .withColumn("q", _share("total", "d_lang"))
        .select("lang", "source", "idx", "tid", "term", "p", "p0", "q"),
        "postings",
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        posts.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
        .where(F.col("rank") <= top)
    )

    common = (
        posts.groupBy("lang", "tid")
        .agg(F.collect_list(F.struct("idx", "p", "p0")).alias("posts"))
        .where(F.size("posts") > 1)
        .select("lang", "posts")
        .mapInArrow(_in_common, "lang string, a long, b long, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum(F.col("value").cast(EXACT)).alias("value"))
    )
    # Terms of one source against the share that the other gives to a term it lacks.
    partner = small.select("lang", F.col("idx").alias("b"), F.col("p0").alias("z"))
    weight = F.col("m").cast("decimal(18,0)")
    times = lambda f: F.sum((weight * f.cast("decimal(19,0)")).cast(EXACT))
    alone = staged(
        posts.groupBy("lang", F.col("idx").alias("a"), "p").agg(F.count("*").alias("m"))
        .join(partner, "lang").where("a <> b")
        .groupBy("lang", "a", "b").agg(times(_f("p", "z")).alias("out"), times(_f("z", "p")).alias("back")),
        "one-sided",
    )
    one, other = table.select("lang", F.col("idx").alias("a"), "source", "v", "terms", "p0"), small.select(
        "lang", F.col("idx").alias("b"), F.col("source").alias("item"), F.col("terms").alias("terms_b"), F.col("p0").alias("z")
    )
    neither = F.col("v") - F.col("terms") - F.col("terms_b")
    pairs = one.join(other, "lang").where("a <> b")
    pairs = pairs.withColumn("value", neither.cast("decimal(18,0)") * _f("p0", "z").cast("decimal(19,0)"))
    pairs = pairs.select("lang", "a", "b", "source", "item", F.coalesce(F.col("value").cast(EXACT), F.lit(0).cast(EXACT)).alias("value"))
    parts = [common, alone.select("lang", "a", "b", F.col("out").alias("value"))]
    parts.append(alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("back").alias("value")))
    for part in parts:
        pairs = pairs.unionByName(part, allowMissingColumns=True)
    pairs = (
        pairs.groupBy("lang", "a", "b")
        .agg(F.max("source").alias("source"), F.max("item").alias("item"), F.sum("value").cast("long").alias("value"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(by_value))
    )
    return pairs.unionByName(terms).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")
    )
