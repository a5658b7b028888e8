"""Nearest neighbours over learned partitions.

A sample's neighbour graph is cut into balanced parts, a small classifier learns
which part a vector belongs to, every row is indexed under its part, and a query is
sent to its most probable parts and ranked there by exact distances.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged
from .vectors import matrix, valid


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row, itself left out."""
    norms, out = (x * x).sum(axis=1), []
    for at in range(0, len(x), 512):
        d = norms[at : at + 512, None] + norms - 2 * x[at : at + 512] @ x.T
        d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
        out.append(np.argpartition(d, k - 1, axis=1)[:, :k])
    return np.vstack(out)


def balanced_parts(near: np.ndarray, parts: int, sweeps: int = 8, slack: float = 1.1) -> np.ndarray:
    """Parts of at most `slack` times the mean size that cut few links of the graph.

    Nodes are placed one by one with most of their neighbours, discounted by how
    full a part is, and placed anew in each sweep.
    """
    n = len(near)
    both = [[] for _ in range(n)]
    for i, row in enumerate(near.tolist()):
        both[i] += row
        for j in row:
            both[j].append(i)
    links = [np.array(b) for b in both]
    most = math.ceil(slack * n / parts)
    part, load = np.full(n, -1), np.zeros(parts)
    order = np.random.default_rng(3).permutation(n)
    for _ in range(sweeps):
        for i in order:
            if part[i] >= 0:
                load[part[i]] -= 1
            own = part[links[i]]
            pull = np.bincount(own[own >= 0], minlength=parts)
            gain = np.where(load < most, (pull + 1e-3) * (1 - load / most), -1.0)
            part[i] = int(gain.argmax())
            load[part[i]] += 1
    return part


@dataclass
class Router:
    """A network of one hidden layer from vectors to parts, and how many parts to ask."""

    mean: np.ndarray
    scale: float
    first: np.ndarray
    second: np.ndarray
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1))])
        hidden = np.maximum(z @ self.first, 0)
        return np.hstack([hidden, np.ones((len(x), 1))]) @ self.second

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")


def train(
    x: np.ndarray, parts: int, k: int = 10, hidden: int = 128, epochs: int = 40, goal: float = 0.97
) -> Router:
    """Cut the neighbour graph of `x`, learn its parts, and measure how many to ask.

    Each row learns the shares of parts among its neighbours. `probes` is the least
    number of parts that hold `goal` of the true neighbours of rows left out of the
    training.
    """
    n, dim = x.shape
    parts = max(1, min(parts, n // 16))
    draw = np.random.default_rng(5)
    router = Router(
        x.mean(axis=0),
        float(x.std()) or 1.0,
        draw.standard_normal((dim + 1, hidden)) / math.sqrt(dim),
        np.zeros((hidden + 1, parts)),
        1,
    )
    if parts == 1:
        return router
    near = neighbours(x, k)
    part = balanced_parts(near, parts)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), k), part[near].ravel()), 1 / (2 * k))
    target[np.arange(n), part] += 0.5
    test = np.zeros(n, bool)
    test[draw.permutation(n)[: n // 5]] = True
    _descend(router, x[~test], target[~test], epochs, draw)
    assigned, asked = router.logits(x).argmax(axis=1), router.ranked(x[test])
    place = np.empty_like(asked)
    np.put_along_axis(place, asked, np.arange(parts)[None, :].repeat(len(asked), 0), axis=1)
    rank = np.take_along_axis(place, assigned[near[test]], axis=1).ravel()
    router.probes = min(parts, int(np.quantile(rank, goal, method="higher")) + 1)
    return router


def _descend(router: Router, x: np.ndarray, y: np.ndarray, epochs: int, draw) -> None:
    """Adam over the cross entropy of softmax shares, in place."""
    z = np.hstack([(x - router.mean) / router.scale, np.ones((len(x), 1))])
    weights = [router.first, router.second]
    speed, size, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = draw.permutation(len(z))
        for at in range(0, len(z), 128):
            b = order[at : at + 128]
            up = np.maximum(z[b] @ router.first, 0)
            up1 = np.hstack([up, np.ones((len(b), 1))])
            s = up1 @ router.second
            s = np.exp(s - s.max(axis=1, keepdims=True))
            err = (s / s.sum(axis=1, keepdims=True) - y[b]) / len(b)
            back = (err @ router.second[:-1].T) * (up > 0)
            t += 1
            for w, v, m, g in zip(weights, speed, size, (z[b].T @ back, up1.T @ err), strict=True):
                v += 0.1 * (g - v)
                m += 0.001 * (g * g - m)
                w -= 0.003 * (v / (1 - 0.9**t)) / (np.sqrt(m / (1 - 0.999**t)) + 1e-8)


def search(
    vectors: DataFrame,
    query: str,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    sample: int = 4096,
    part_rows: int = 1500,
    least_parts: int = 8,
    most_parts: int = 128,
) -> DataFrame:
    """`query_id, rank, vec_id, score` of the `k` nearest rows of each query.

    `query` is a condition on `vec_id` that selects the queries; candidates are all
    rows but those with the query's id. The router is fitted on at most `sample`
    rows (those with the smallest hashes), every row is indexed. There is a part for each
    `part_rows` rows, from `least_parts` (each of 16 sampled rows or more) to `most_parts`. `score` is the
    Euclidean distance of the vectors as given, in double precision; ties go to the
    smaller id. Null and zero vectors, those with null or non-finite components and
    rows without an id take no part; vectors of another length than the sample's
    most common one have no distance to the others and take none either. Rows that
    repeat an id are candidates of their own; a query that repeats is asked once.
    """
    spark = vectors.sparkSession
    rows = staged(
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
        .where(valid(F.col("v")) & F.col("vec_id").isNotNull()),
        "vectors",
    )
    top = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    top = top.orderBy(F.desc("n"), "dim").first()
    result = "query_id long, rank int, vec_id long, score double"
    if top is None:
        return spark.createDataFrame([], result)
    rows = rows.where(F.size("v") == top["dim"])
    seen = rows.orderBy(F.xxhash64("vec_id", F.lit(17)), "vec_id").limit(sample).select("v").collect()
    router = train(np.array([r.v for r in seen], float), min(most_parts, max(least_parts, top["n"] // part_rows)))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(part=router.logits(matrix(batch.v)).argmax(axis=1))

    index = staged(rows.mapInPandas(assign, "vec_id long, v array<double>, part int"), "index")
    held = np.zeros(router.second.shape[1], np.int64)
    for part, n in index.groupBy("part").count().collect():
        held[part] = n

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            order = router.ranked(matrix(batch.v))
            # Small parts: go on until there are k rows beside the query's own.
            lacking = np.cumsum(held[order], axis=1) < (k + batch.copies.to_numpy())[:, None]
            asked = np.maximum(router.probes, lacking.sum(axis=1) + 1)
            yield batch[["query_id", "v"]].assign(parts=[o[:n] for o, n in zip(order, asked, strict=True)])

    asked = rows.where(query).groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("copies"))
    routed = staged(
        asked.withColumnRenamed("vec_id", "query_id")
        .mapInPandas(route, "query_id long, v array<double>, parts array<int>")
        .select("query_id", F.col("v").alias("q"), F.explode("parts").alias("part")),
        "routed",
    )
    # A part is compared in blocks of rows and blocks of queries, all of about one size.
    blocks = index.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("nb"))
    lots = routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / (2 * part_rows)).cast("int").alias("nq"))
    shape = staged(blocks.join(lots, "part"), "part-sizes")
    left = (
        index.join(shape, "part")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.col("nb")).cast("int"))
        .withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
        .select("part", "block", "lot", "vec_id", "v")
    )
    right = (
        routed.join(shape, "part")
        .withColumn("lot", F.pmod(F.xxhash64("query_id", F.lit(3)), F.col("nq")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("part", "block", "lot", "query_id", "q")
    )

    def rank(key, have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, ids, out = matrix(have.v), have.vec_id.to_numpy(), []
        norms = (x * x).sum(axis=1)
        for q_id, q in zip(ask.query_id.to_numpy(), matrix(ask.q), strict=True):
            rough = norms - 2 * (x * q).sum(axis=1)
            rough[ids == q_id] = np.inf
            last = min(k, len(rough)) - 1
            limit = np.partition(rough, last)[last]
            reach = rough <= limit + 1e-9 * (abs(limit) + (q * q).sum())
            near = np.flatnonzero(reach & (ids != q_id))
            score = np.sqrt(((x[near] - q) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], score))[:k]
            out.append(pd.DataFrame({"query_id": q_id, "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(out, ignore_index=True)

    keys = ["part", "block", "lot"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        rank, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
