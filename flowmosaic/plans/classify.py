"""From day sets to evaluated weekend classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.arrays import net_tensor, pool_tensor
from flowmosaic.operators.forward import NetWeights, extract_features
from flowmosaic.operators.models import fit_cached, neural_classifier, predict, train_model
from flowmosaic.operators.splits import split_fraction
from flowmosaic.schema import N_OTHERS, GridSpec


def split_roles(examples: DataFrame) -> tuple[DataFrame, DataFrame]:
    return examples.filter("role = 'train'"), examples.filter("role = 'test'")


def classify_extracted(
    days: DataFrame,
    spec: GridSpec,
    weights: NetWeights,
    kind: int = 2,
    iterations: int = 1000,
    pca_k: int | None = None,
    ratio: float = 0.8,
    seed: int = 0,
) -> DataFrame:
    """Network features -> scaler -> optional PCA -> classifier -> metric row."""
    featured = extract_features(days, spec, weights).filter("features IS NOT NULL")
    points = featured.select(
        "date",
        F.col("label").cast("double").alias("label"),
        array_to_vector("features").alias("features"),
    )
    train, test = split_roles(split_fraction(points, ["date"], ratio, seed))
    return train_model(train, test, kind, iterations, pca_k)


def with_features(examples: DataFrame, grid: Column) -> DataFrame:
    """Labelled vectors of a grid array and the attributes; days with unknown attributes left out."""
    return examples.filter("others IS NOT NULL").select(
        *[c for c in examples.columns if c not in ("flow", "others", "label")],
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.concat(grid, F.col("others"))).alias("features"),
    )


def flat_points(examples: DataFrame) -> DataFrame:
    """Whole in- and outflow tensors plus attributes (no network, wide vectors)."""
    return with_features(examples, F.col("flow"))


def net_points(examples: DataFrame) -> DataFrame:
    """Net flow plus attributes: what is lost when in- and outflow are not told apart?"""
    return with_features(examples, net_tensor(F.col("flow")))


def pooled_points(examples: DataFrame, spec: GridSpec, size: int = 4) -> DataFrame:
    """Pooled tensors plus attributes, for models that cannot take a full-width vector."""
    return with_features(examples, pool_tensor(F.col("flow"), spec, size))


def pooled_width(spec: GridSpec, size: int) -> int:
    return -(-spec.rows // size) * -(-spec.cols // size) * spec.channels + N_OTHERS


def classify_examples(
    examples: DataFrame,
    kind: int = 2,
    iterations: int = 1000,
    pca_k: int | None = None,
    points: Callable[[DataFrame], DataFrame] = flat_points,
) -> DataFrame:
    """Metric row of one classifier under any protocol that assigned a ``role``."""
    train, test = split_roles(points(examples))
    return train_model(train, test, kind, iterations, pca_k)


def neural_day_classifier(
    examples: DataFrame, spec: GridSpec, size: int = 4, max_iter: int = 100, seed: int = 0
) -> tuple[PipelineModel, DataFrame]:
    """(fitted model, test predictions) of the multilayer day classifier under any protocol."""
    train, test = split_roles(pooled_points(examples, spec, size))
    model = fit_cached(neural_classifier(pooled_width(spec, size), max_iter, seed), train)
    return model, predict(model, test)
