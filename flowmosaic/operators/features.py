"""Feature vectors: scaling, covariance, principal components, dense layers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.arrays import dot

# A covariance has width^2 entries and so has the matrix PCA decomposes: pool the grid first.
MAX_COVARIANCE_WIDTH = 4096


def labeled_points(rows: DataFrame, key: str = "id") -> DataFrame:
    """(key, label, features vector) from (key, label, features array)."""
    return rows.select(
        key,
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("features").cast("array<double>")).alias("features"),
    )


def fit_scaler(points: DataFrame, inputs: str = "features", output: str = "scaled") -> StandardScalerModel:
    """Column means and sample deviations in one tree aggregation."""
    scaler = StandardScaler(withMean=True, withStd=True, inputCol=inputs, outputCol=output)
    return scaler.fit(points)


def scaler_table(points: DataFrame, model: StandardScalerModel) -> DataFrame:
    """(i, mean, std) of a fitted scaler: as many rows as the vectors are wide."""
    rows = [
        (i, float(mean), float(std))
        for i, (mean, std) in enumerate(zip(model.mean.toArray(), model.std.toArray()))
    ]
    return points.sparkSession.createDataFrame(rows, "i INT, mean DOUBLE, std DOUBLE")


def fit_pca(points: DataFrame, k: int, inputs: str = "scaled", output: str = "components") -> PCAModel:
    return PCA(k=k, inputCol=inputs, outputCol=output).fit(points)


def covariance_matrix(points: DataFrame, features: str = "features") -> DataFrame:
    """(i, j, cov) for i <= j, sample covariance.

    Tasks add up their rows' centred products and ship one partial triangle each; Spark sums the
    partials per entry. No row is paired with another and nothing row-sized is shuffled.
    """
    stats = points.select(
        Summarizer.metrics("mean", "count").summary(F.col(features)).alias("s")
    ).select("s.mean", "s.count").first()
    n = int(stats["count"])
    if n < 2:
        raise ValueError("a sample covariance needs at least two rows")
    centre = np.asarray(stats["mean"].toArray())
    width = len(centre)
    if width > MAX_COVARIANCE_WIDTH:
        raise ValueError(f"{width} columns: pool or project to {MAX_COVARIANCE_WIDTH} or fewer first")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                centred = np.stack(batch["x"].to_numpy()) - centre
                total += centred.T @ centred
        i, j = np.triu_indices(width)
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "part": total[i, j]})

    return (
        points.select(vector_to_array(features).alias("x"))
        .mapInPandas(partial, "i INT, j INT, part DOUBLE")
        .groupBy("i", "j")
        .agg((F.sum("part") / F.lit(float(n - 1))).alias("cov"))
    )


def linear_score(features: Column, weights: Sequence[float], bias: float = 0.0) -> Column:
    """Fixed-weight dot product; no join, no shuffle, no Python."""
    return dot(features, weights) + F.lit(float(bias))


def dense_layer(features: Column, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """x W + b with W given as [input][output]; row-local, weights are plan constants.

    Meant for layers of a few thousand weights; whole networks go through
    :mod:`flowmosaic.operators.forward`.
    """
    columns = zip(*weights)
    return F.array(*[linear_score(features, w, b) for w, b in zip(columns, bias)])


def concat_features(*blocks: Column) -> Column:
    return F.concat(*blocks)


def vector_rows(rows: DataFrame, key: str, vector: str, out: str = "value") -> DataFrame:
    """(key, i, value): a vector column in long form."""
    return rows.select(key, F.posexplode(vector_to_array(vector)).alias("i", out))
