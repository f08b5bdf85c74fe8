"""Ridge logistic regression by Newton steps on sums over partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import tidied

STEPS = 8


def _sums(rows: DataFrame, features: list[str], label: str, beta: np.ndarray) -> np.ndarray:
    """Gradient and Hessian at ``beta``: one row of numbers a task, summed."""
    k = len(features) + 1

    def run(batches):
        total = np.zeros(k + k * k)
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows)] + [
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(k - 1)])
            y = batch.column(k - 1).to_numpy(zero_copy_only=False)
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            total[:k] += x.T @ (y - p)
            total[k:] += ((x * (p * (1 - p))[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "v"])

    parts = rows.select(*[F.col(f).cast("double") for f in features], F.col(label).cast("double")).mapInArrow(
        tidied(run), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(k + k * k)
    for r in parts:
        out[r["i"]] = r["v"]
    return out


def fit(rows: DataFrame, features: list[str], label: str, ridge: float = 1.0) -> np.ndarray:
    """Intercept and weights; without rows of both labels, the smoothed rate."""
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col(label).cast("double")), F.lit(0.0)).alias("p")
                 ).collect()[0]
    k = len(features) + 1
    beta = np.zeros(k)
    beta[0] = np.log((n["p"] + 0.5) / (n["n"] - n["p"] + 0.5))
    if 0 < n["p"] < n["n"]:
        penalty = ridge * np.eye(k)
        penalty[0, 0] = 1e-6
        for _ in range(STEPS):
            s = _sums(rows, features, label, beta)
            step = np.linalg.solve(s[k:].reshape(k, k) + penalty, s[:k] - penalty @ beta)
            beta = beta + np.clip(step, -5, 5)
    return beta


def probability(features: list[str], beta: np.ndarray) -> Column:
    z = F.lit(float(beta[0]))
    for name, b in zip(features, beta[1:]):
        z = z + F.col(name) * float(b)
    return 1 / (1 + F.exp(-z))
