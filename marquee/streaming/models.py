"""Streaming model updates in ``foreachBatch``.

Each micro-batch is reduced on the executors to k (or d) numbers with
one aggregate; only those numbers reach the driver, where the small
model is updated.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class StreamingKMeans:
    """Mini-batch k-means with forgetful updates:
    c' = (c·n·a + x̄·m) / (n·a + m),  n' = n·a + m  (a = decay)."""

    def __init__(self, centers: np.ndarray, decay: float = 1.0):
        self.centers = np.asarray(centers, dtype=float)
        self.weights = np.zeros(len(self.centers))
        self.decay = decay

    def assign(self, df: DataFrame, cols: list[str]) -> DataFrame:
        dist = None
        for i, c in enumerate(self.centers):
            d = sum((F.col(x) - float(v)) ** 2 for x, v in zip(cols, c))
            expr = F.struct(d.alias("d"), F.lit(i).alias("i"))
            dist = expr if dist is None else F.least(dist, expr)
        return df.withColumn("cluster", dist["i"])

    def update(self, batch: DataFrame, cols: list[str]) -> None:
        stats = (self.assign(batch, cols).groupBy("cluster")
                 .agg(F.count(F.lit(1)).alias("m"), *[F.avg(c).alias(c) for c in cols]).collect())
        for row in stats:
            i, m = row["cluster"], row["m"]
            mean = np.array([row[c] for c in cols], dtype=float)
            n = self.weights[i] * self.decay
            self.centers[i] = (self.centers[i] * n + mean * m) / (n + m)
            self.weights[i] = n + m

    def foreach_batch(self, cols: list[str]):
        return lambda batch, _id: self.update(batch, cols)


class StreamingLinearRegression:
    """Least-squares SGD: one full-batch gradient step per micro-batch,
    the gradient summed on the executors."""

    def __init__(self, n_features: int, step: float = 0.01):
        self.w = np.zeros(n_features)
        self.b = 0.0
        self.step = step

    def update(self, batch: DataFrame, features: list[str], label: str) -> None:
        pred = sum(F.col(f) * float(w) for f, w in zip(features, self.w)) + F.lit(self.b)
        err = pred - F.col(label)
        row = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(err).alias("gb"),
                        *[F.sum(err * F.col(f)).alias(f"g{i}") for i, f in enumerate(features)]).first()
        if not row["n"]:
            return
        g = np.array([row[f"g{i}"] for i in range(len(features))]) / row["n"]
        self.w -= self.step * g
        self.b -= self.step * row["gb"] / row["n"]

    def foreach_batch(self, features: list[str], label: str):
        return lambda batch, _id: self.update(batch, features, label)


class StreamingLogisticRegression:
    """Logistic SGD: full-batch gradient steps per micro-batch (step size
    falling with the square root of the step), the gradient summed on the
    executors.  Rows with a NULL feature or label do not count."""

    def __init__(self, n_features: int, step: float = 0.5, rounds: int = 10, ridge: float = 0.0):
        self.w = np.zeros(n_features)
        self.b = 0.0
        self.step, self.rounds, self.ridge = step, rounds, ridge

    def probability(self, features: list[str]):
        z = F.lit(float(self.b))
        for f, w in zip(features, self.w):
            z = z + F.col(f) * float(w)
        return 1 / (1 + F.exp(-z))

    def update(self, batch: DataFrame, features: list[str], label: str) -> None:
        known = batch.select(*features, label).na.drop()
        for i in range(self.rounds):
            err = self.probability(features) - F.col(label)
            row = known.agg(F.count(F.lit(1)).alias("n"), F.sum(err).alias("gb"),
                            *[F.sum(err * F.col(f)).alias(f"g{j}") for j, f in enumerate(features)]).first()
            if not row["n"]:
                return
            g = np.array([row[f"g{j}"] for j in range(len(features))]) / row["n"]
            rate = self.step / np.sqrt(i + 1)
            self.w -= rate * (g + self.ridge * self.w)
            self.b -= rate * row["gb"] / row["n"]

    def foreach_batch(self, features: list[str], label: str):
        return lambda batch, _id: self.update(batch, features, label)
