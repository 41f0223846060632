"""Labelled rows to learn from, and a logistic fit on few columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most about so many labelled rows are learnt from, chosen by a hash of their id.
SAMPLE = 200_000


def remainder(id_col: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; -1 for a null id."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % by, F.lit(-1).cast("long"))


def training(labels: DataFrame, label: str, held_out: Column, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of about `sample` labelled rows at most that are not held out; repeated ids count once, with the larger label."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out)
    share = min(1.0, sample / max(1, rows.count()))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40))
    return rows.where(chosen).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


class Logistic:
    """A ridge logistic regression by Newton's method; with one class only, the share of ones."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        k = x.shape[1]
        self.mean, self.scale, self.weights, self.start = np.zeros(k), np.ones(k), np.zeros(k), 0.0
        ones = (y.sum() + 0.5) / (len(y) + 1.0)
        self.start = float(np.log(ones / (1 - ones)))
        if 0 < y.sum() < len(y):
            self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
            self._fit(np.c_[(x - self.mean) / self.scale, np.ones(len(x))], y, ridge)

    def _fit(self, z: np.ndarray, y: np.ndarray, ridge: float) -> None:
        w = np.r_[np.zeros(z.shape[1] - 1), self.start]
        penalty = np.r_[np.full(len(w) - 1, ridge), 1e-6]
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        self.weights, self.start = w[:-1], float(w[-1])

    def column(self, names: list[str]) -> Column:
        """The probability as a column expression."""
        linear = F.lit(self.start)
        for name, mean, scale, weight in zip(names, self.mean, self.scale, self.weights, strict=True):
            linear = linear + (F.col(name) - F.lit(float(mean))) * F.lit(float(weight / scale))
        return probability(linear)


def probability(linear: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), linear))))
