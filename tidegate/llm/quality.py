"""Text quality from random Fourier features over document statistics.

The features approximate a Gaussian kernel; normal equations summed over the
partitions fit ridge scores, and isotonic regression turns these into probabilities.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"]] = True
#: Order of the statistics that `statistics` returns.
STATISTICS = (
    "log_bytes upper digit bang symbol stop white newline high distinct again top_word word_length "
    "line_again entropy odd_end capital_words single"
).split()


def statistics(text: str | None) -> list[float]:
    """Shape of a whole text as numbers, all zero for null and empty texts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(hist[65:91].sum()), int(hist[97:123].sum())
    share = hist[hist > 0] / n
    words = raw.split()
    m = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    distinct = len(counts)
    again = sum(map(bytes.__eq__, words, words[1:]))
    odd = capital = single = 0
    for w, c in counts.items():
        last = w[-1]
        odd += c * (last < 128 and bool(_SYMBOLS[last] or last == 33))
        capital += c * (len(w) > 1 and w.isupper())
        single += c * (len(w) == 1)
    return [
        math.log1p(n),
        upper / max(1, upper + lower),
        hist[48:58].sum() / n,
        hist[33] / m,
        hist[_SYMBOLS].sum() / m,
        (hist[46] + hist[44]) / m,
        (hist[32] + hist[9:14].sum()) / n,
        hist[10] / m,
        hist[128:].sum() / n,
        distinct / m,
        again / m,
        max(counts.values(), default=0) / m,
        min(40.0, n / m),
        1 - len(set(lines)) / max(1, len(lines)),
        float(-(share * np.log2(share)).sum()),
        odd / m,
        capital / m,
        single / m,
    ]


def _statistics(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(-1, len(STATISTICS))


@dataclass
class Model:
    """Standardisation, random directions, ridge weights and calibration knots."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0.0, 1.0)


def isotonic(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Rising fit of `value` with the least weighted squares: pool adjacent violators."""
    pools: list[list[float]] = []
    for w, v in zip(weight, value, strict=True):
        pools.append([w, v, 1])
        while len(pools) > 1 and pools[-2][1] >= pools[-1][1]:
            w2, v2, n2 = pools.pop()
            w1, v1, n1 = pools[-1]
            pools[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.repeat([p[1] for p in pools], [int(p[2]) for p in pools])


#: Cells in which raw scores from -1 to 2 are summed for the calibration.
CELLS = 3000


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    target: str = "quality",
    waves: int = 256,
    width: float = 4.0,
    ridge: float = 1e-3,
    seed: int = 7,
) -> Model:
    """Model learned from all labelled documents in `docs`.

    `labels` has `doc_id` and `target` (0 or 1; null is no label). A document with
    several labels takes their mean. Without any label the score is 0.5 for all.
    """
    known = labels.where(F.col(target).isNotNull()).groupBy(F.col("doc_id").alias("k")).agg(
        F.avg(F.col(target).cast("double")).alias("y")
    )

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_statistics(texts)))

    rows = docs.select(F.col(doc_id).alias("id"), described(F.col(text)).alias("x")).join(
        known, F.col("id") == F.col("k")
    )
    rows = staged(rows.select("x", "y"), "labelled")
    d = len(STATISTICS)
    sums = rows.agg(
        F.count(F.lit(1)),
        *(F.avg(F.col("x")[k]) for k in range(d)),
        *(F.stddev_pop(F.col("x")[k]) for k in range(d)),
    ).first()
    draw = np.random.default_rng(seed)
    directions = draw.standard_normal((d, waves)) / width
    phases = draw.uniform(0, 2 * math.pi, waves)
    flat = np.array([0.0, 1.0]), np.array([0.5, 0.5])
    if not sums[0]:
        return Model(np.zeros(d), np.ones(d), directions, phases, np.zeros(waves + 1), *flat)
    mean, spread = np.array(sums[1 : d + 1], float), np.array(sums[d + 1 :], float)
    model = Model(
        mean, np.where(spread > 1e-9, spread, 1.0), directions, phases, np.zeros(waves + 1), *flat
    )

    # By the same kind of Python function as all others: rows of an RDD would have workers of their own.
    def equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((waves + 1, waves + 2))
        for batch in batches:
            for k in range(0, len(batch), 4096):
                part = batch.iloc[k : k + 4096]
                total += _normal(model, np.column_stack([np.stack(part.x.to_numpy()), part.y.to_numpy()]))
        yield pd.DataFrame({"cell": np.arange(total.size, dtype=np.int32), "total": total.ravel()})

    sums_of = rows.mapInPandas(equations, "cell int, total double").groupBy("cell").agg(F.sum("total"))
    both = np.zeros((waves + 1, waves + 2))
    for k, total in sums_of.collect():  # as many lines as the equations have coefficients
        both.flat[k] = total
    lift = ridge * sums[0] * np.eye(waves + 1)
    lift[-1, -1] = 0.0
    model.weights = np.linalg.solve(both[:, :-1] + lift + 1e-9 * np.eye(waves + 1), both[:, -1])

    @F.pandas_udf("int")
    def cell(x: pd.Series) -> pd.Series:
        raw = model.raw(np.stack(x.to_numpy()).astype(float))
        return pd.Series(np.clip((raw + 1) / 3 * CELLS, 0, CELLS - 1).astype(np.int32))

    cells = rows.select(cell("x").alias("cell"), "y").groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("y")
    )
    seen = sorted((r.cell, r.n, r.y) for r in cells.collect())
    at, n, y = (np.array(c, float) for c in zip(*seen, strict=True))
    model.knots, model.levels = (at + 0.5) / CELLS * 3 - 1, isotonic(n, y)
    return model


def _normal(model: Model, rows: np.ndarray) -> np.ndarray:
    f = model.features(rows[:, :-1])
    return f.T @ np.hstack([f, rows[:, -1:]])


def scores(model: Model, text: Column) -> Column:
    """Probability of label 1 for a whole text; null counts as empty."""

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_statistics(texts)))

    return of(text)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept out of the training; one without an id always is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = 0.3,
    **how,
) -> DataFrame:
    """`docs` with `held_out`, `score` and `predicted` (1 if score >= threshold) added.

    The model learns from the labelled rows that are not held out. Columns of these
    names are replaced. Null and empty texts get a score like any other text;
    repeated rows count as often as they occur; an empty table stays empty.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = fit(docs.where(~held_out(F.col(doc_id))), labels, text, doc_id, **how)
    return (
        docs.withColumn("held_out", held_out(F.col(doc_id)))
        .withColumn("score", scores(model, F.col(text)))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
