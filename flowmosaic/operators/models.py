"""The five classifier families, the neural day classifier, and train-and-evaluate runs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.scoring import threshold
from flowmosaic.operators.features import MAX_COVARIANCE_WIDTH
from flowmosaic.operators.metrics import confusion_counts, metric_report
from flowmosaic.operators.wide import reduce_wide

# Classifier kinds by their number; anything above 4 is a forest.
KINDS = {1: "linear", 2: "logistic_l2", 3: "logistic_lbfgs", 4: "svm", 5: "forest"}

PARTITION_BYTES = 16 * 1024 * 1024  # train data per task of an optimiser step

L2_REG = 0.01  # regularisation of the logistic (2) and SVM (4) kinds


def estimator(kind: int, iterations: int, features: str = "scaled", seed: int = 0):
    """Unfitted classifier of a kind; ``iterations`` is the number of trees for a forest."""
    common = {"featuresCol": features, "labelCol": "label"}
    if kind == 1:
        return LinearRegression(
            maxIter=iterations, regParam=0.0, fitIntercept=False, predictionCol="score", **common
        )
    plain = {"maxIter": iterations, "fitIntercept": False, "standardization": False}
    if kind == 2:
        return LogisticRegression(regParam=L2_REG, elasticNetParam=0.0, tol=1e-9, **plain, **common)
    if kind == 3:
        return LogisticRegression(regParam=0.0, tol=1e-9, **plain, **common)
    if kind == 4:
        return LinearSVC(regParam=L2_REG, tol=1e-4, threshold=0.0, **plain, **common)
    return RandomForestClassifier(
        numTrees=iterations, maxDepth=5, maxBins=32, impurity="gini",
        featureSubsetStrategy="auto", seed=seed, **common,
    )


def classifier_stages(
    kind: int, iterations: int, pca_k: int | None = None, seed: int = 0
) -> list:
    """Scaler, optional PCA, classifier; all fitted on train rows only."""
    stages = [StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled")]
    inputs = "scaled"
    if pca_k is not None:
        stages.append(PCA(k=pca_k, inputCol="scaled", outputCol="components"))
        inputs = "components"
    return [*stages, estimator(kind, iterations, inputs, seed)]


def sized_for_iterations(frame: DataFrame) -> DataFrame:
    """A persisted train frame in as few partitions as its measured size needs.

    Every optimiser step is a job over all partitions; tiny ones only add scheduling time. Large
    frames keep their partitions (coalescing to more than there are changes nothing).
    """
    sample = frame.select("features").first()
    if sample is None:
        raise ValueError("there are no rows to train on")
    size = frame.count() * sample["features"].size * 8
    return frame.coalesce(max(1, -(-size // PARTITION_BYTES)))


def fit_cached(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit with the train columns persisted (memory, then disk) for the passes of all stages.

    What the caller has persisted already is used as it is and left to the caller.
    """
    level = train.storageLevel
    if level.useMemory or level.useDisk:
        return pipeline.fit(sized_for_iterations(train))
    frame = train.select("label", "features").persist()
    try:
        return pipeline.fit(sized_for_iterations(frame))
    finally:
        frame.unpersist()


def fit_classifier(
    train: DataFrame, kind: int, iterations: int, pca_k: int | None = None, seed: int = 0
) -> PipelineModel:
    """Fit on (label, features)."""
    return fit_cached(Pipeline(stages=classifier_stages(kind, iterations, pca_k, seed)), train)


def predict(model: PipelineModel, points: DataFrame, cut: float = 0.0) -> DataFrame:
    """(…, score, prediction): the score ranks, the prediction is 0.0 or 1.0.

    A linear regression scores directly and is cut at ``cut``; classifiers bring both.
    """
    out = model.transform(points)
    if "rawPrediction" in out.columns:
        out = out.withColumn("score", F.element_at(vector_to_array("rawPrediction"), 2))
    else:
        out = out.withColumn("prediction", threshold(F.col("score"), cut))
    made = {"scaled", "components", "rawPrediction", "probability"}
    return out.select(*[c for c in out.columns if c not in made])


def train_model(
    train: DataFrame,
    test: DataFrame,
    kind: int,
    iterations: int,
    pca_k: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Train, predict, evaluate: one metric row plus the two sizes.

    Components of vectors too wide for a covariance matrix are fitted without one.
    """
    first = train.select("features").first()
    if pca_k is not None and first is not None and first["features"].size > MAX_COVARIANCE_WIDTH:
        near, far = reduce_wide(train, test, pca_k)
        model = fit_cached(Pipeline(stages=[estimator(kind, iterations, "features", seed)]), near.withColumnRenamed("components", "features"))
        pairs = predict(model, far.withColumnRenamed("components", "features"))
    else:
        model = fit_classifier(train, kind, iterations, pca_k, seed)
        pairs = predict(model, test)
    n_train = train.agg(F.count(F.lit(1))).scalar()
    return metric_report(pairs).select(
        F.lit(KINDS[min(kind, 5)]).alias("model"),
        "auc",
        "recall",
        "precision",
        "f1",
        n_train.alias("n_train"),
        F.col("n_rows").alias("n_test"),
    )


def model_bakeoff(
    train: DataFrame, test: DataFrame, runs: Iterable[tuple[int, int]], pca_k: int | None = None
) -> DataFrame:
    """One metric row per (kind, iterations); the train rows are persisted once for all fits."""
    frame = train.select("label", "features").persist()
    try:
        rows = [train_model(frame, test, kind, iterations, pca_k) for kind, iterations in runs]
    finally:
        frame.unpersist()
    if not rows:
        raise ValueError("no runs given")
    return reduce(DataFrame.unionByName, rows)


def neural_classifier(width: int, max_iter: int = 100, seed: int = 0) -> Pipeline:
    """Scaler and a multilayer perceptron with two hidden layers and a 2-class softmax."""
    return Pipeline(
        stages=[
            StandardScaler(withMean=True, withStd=True, inputCol="features", outputCol="scaled"),
            MultilayerPerceptronClassifier(
                layers=[width, 128, 64, 2], maxIter=max_iter, seed=seed,
                featuresCol="scaled", labelCol="label",
            ),
        ]
    )


def objective_history(model: PipelineModel) -> list[float]:
    """Loss of the last stage's optimiser, one value per iteration."""
    last = model.stages[-1]
    summary = last.summary() if callable(last.summary) else last.summary
    return [float(loss) for loss in summary.objectiveHistory]


def objective_trace(model: PipelineModel, like: DataFrame) -> DataFrame:
    """(step, loss) of the last stage's optimiser: one row per iteration."""
    rows = list(enumerate(objective_history(model)))
    return like.sparkSession.createDataFrame(rows, "step INT, loss DOUBLE")


def accuracy_trace(
    train: DataFrame, test: DataFrame, kind: int, checkpoints: Iterable[int], seed: int = 0
) -> DataFrame:
    """(step, train_accuracy, test_accuracy, train_loss) after each number of iterations."""
    rows = []
    frame = train.select("label", "features").persist()
    try:
        for step in checkpoints:
            model = fit_classifier(frame, kind, step, seed=seed)
            shares = []
            for part in (frame, test):
                c = confusion_counts(predict(model, part)).first()
                shares.append((c["tp"] + c["tn"]) / max(1, sum(c)))
            rows.append((step, *shares, objective_history(model)[-1]))
    finally:
        frame.unpersist()
    return train.sparkSession.createDataFrame(
        rows, "step INT, train_accuracy DOUBLE, test_accuracy DOUBLE, train_loss DOUBLE"
    )
