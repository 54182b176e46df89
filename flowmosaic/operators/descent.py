"""Mini-batch gradient descent with a step that shrinks as 1 / sqrt(t), for the linear classifier kinds.

Every step is one job: tasks add up their rows' gradients, Spark adds the tasks' sums, one row per weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.keyed import keyed_uniform
from flowmosaic.operators.models import L2_REG, PARTITION_BYTES

LOSSES = ("squared", "logistic", "hinge")


@dataclass
class Descent:
    """Weights after the last step, and for each step the loss of the weights it started from."""

    weights: np.ndarray
    history: list[tuple[int, float]] = field(default_factory=list)
    converged: bool = False


def row_gradients(kind: str, score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor of the row's features in the gradient, loss) per row; labels are 0 and 1."""
    if kind == "squared":
        return score - label, (score - label) ** 2 / 2
    if kind == "logistic":
        return 1 / (1 + np.exp(-score)) - label, np.logaddexp(0.0, score) - label * score
    sign = 2 * label - 1
    inside = sign * score < 1
    return np.where(inside, -sign, 0.0), np.where(inside, 1 - sign * score, 0.0)


def fit_descent(
    points: DataFrame, kind: str, iterations: int, *, key: str | None = None, features: str = "features", label: str = "label",
    step: float = 1.0, l2: float = L2_REG, fraction: float = 1.0, tolerance: float = 1e-3, seed: int = 0,
    start: np.ndarray | None = None, done: int = 0,
) -> Descent:
    """Minimise loss + l2 / 2 |w|^2 from ``start`` (zero), no intercept.

    Step t shrinks the weights by the factor 1 - l2 * step / sqrt(t) and moves them against the mean gradient
    by step / sqrt(t). With a ``fraction`` below 1, step t sees the rows whose draw keyed by ``key`` and t is
    below it, whatever the partitioning; a step that sees none changes nothing. It ends early when the
    weights move by less than ``tolerance`` times their length (at least 1). ``done`` steps count as taken,
    so that a run can be continued from its weights. Rows without label or features are left out.
    """
    if kind not in LOSSES:
        raise ValueError(f"loss {kind!r} is none of {LOSSES}")
    if fraction < 1.0 and key is None:
        raise ValueError("mini-batches are drawn by a key")
    columns = [vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")]
    rows = points.filter(F.col(features).isNotNull() & F.col(label).isNotNull()).select(*columns, *([F.col(key).alias("_key")] if key else []))
    shape = rows.select(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")).first()
    if not shape["n"]:
        raise ValueError("there are no rows to train on")
    width = shape["width"]
    frame = rows.coalesce(max(1, -(-shape["n"] * width * 8 // PARTITION_BYTES))).persist()
    fitted = Descent(np.zeros(width) if start is None else np.array(start, float))
    try:
        for t in range(done + 1, done + iterations + 1):
            batch = frame if fraction >= 1.0 else frame.filter(in_batch(F.col("_key"), t, fraction, seed))
            sums = gradient_sums(batch.select("x", "y"), kind, fitted.weights)
            if not sums[-1]:
                continue
            w, rate, n = fitted.weights, step / np.sqrt(t), sums[-1]
            fitted.history.append((t, float(sums[-2] / n + l2 / 2 * (w @ w))))
            fitted.weights = w * (1 - rate * l2) - rate * sums[:width] / n
            moved = np.linalg.norm(fitted.weights - w)
            if moved < tolerance * max(np.linalg.norm(fitted.weights), 1.0):
                fitted.converged = True
                break
    finally:
        frame.unpersist()
    return fitted


def in_batch(key: Column, t: int, fraction: float, seed: int) -> Column:
    return keyed_uniform(seed, "minibatch", F.lit(t), key) < fraction


def gradient_sums(rows: DataFrame, kind: str, weights: np.ndarray) -> np.ndarray:
    """Sums over (x, y) rows: the gradient, then the loss, then the number of rows."""
    width = len(weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2)
        for batch in batches:
            if batch.num_rows:
                x, y = batch.column("x").flatten().to_numpy().reshape(-1, width), batch.column("y").to_numpy()
                factor, loss = row_gradients(kind, x @ weights, y)
                total += np.r_[factor @ x, loss.sum(), len(y)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 2), pa.int32()), pa.array(total)], names=["i", "part"])

    sums = rows.mapInArrow(partial, "i INT, part DOUBLE").groupBy("i").agg(F.sum("part").alias("v")).toArrow()
    out = np.zeros(width + 2)
    out[sums["i"].to_numpy()] = sums["v"].to_numpy()
    return out


def descent_scores(points: DataFrame, fitted: Descent, features: str = "features", cut: float = 0.0) -> DataFrame:
    """All columns with ``score`` and the 0/1 ``prediction`` (score above ``cut``)."""
    # one literal array, not one expression per weight
    weights = F.array(*[F.lit(float(w)) for w in fitted.weights])
    score = F.aggregate(F.zip_with(vector_to_array(features), weights, lambda x, w: x * w), F.lit(0.0), lambda total, v: total + v)
    return points.withColumn("score", score).withColumn("prediction", (F.col("score") > cut).cast("double"))


def history_table(points: DataFrame, fitted: Descent) -> DataFrame:
    return points.sparkSession.createDataFrame(fitted.history, "step INT, loss DOUBLE")
