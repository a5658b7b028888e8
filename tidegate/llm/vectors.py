"""What the vector operators share: valid vectors and orthogonal rotations."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def valid(vector: Column) -> Column:
    """Whether a vector has components, all finite, and is not zero; never null."""

    def finite(x: Column) -> Column:
        d = x.cast("double")
        return x.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf"))

    sound = (F.size(vector) > 0) & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(sound, F.lit(False))


def matrix(cells: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in cells])


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix: Gram-Schmidt over Gaussian rows."""
    rows = np.random.default_rng((seed, dim)).standard_normal((dim, dim))
    for k in range(dim):
        for _ in range(2):
            rows[k] -= (rows[:k] * (rows[:k] * rows[k]).sum(axis=1, keepdims=True)).sum(axis=0)
        rows[k] /= np.sqrt((rows[k] ** 2).sum())
    return rows
