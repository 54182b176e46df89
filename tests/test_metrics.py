"""Metrics on hand-sized cases and against the library's own metric classes."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.mllib.evaluation import BinaryClassificationMetrics, MulticlassMetrics
from pyspark.sql import functions as F

from flowmosaic.operators import metrics


def pairs(spark, tp, fp, tn, fn):
    rows = [(1.0, 1.0)] * tp + [(1.0, 0.0)] * fp + [(0.0, 0.0)] * tn + [(0.0, 1.0)] * fn
    return spark.createDataFrame(rows, "prediction DOUBLE, label DOUBLE")


def test_hand_sized_case(spark):
    frame = pairs(spark, 3, 2, 4, 1)
    assert metrics.auc_hard(frame).first()["auc"] == pytest.approx(0.708333, abs=1e-6)
    matrix = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in metrics.confusion_matrix(frame).collect()}
    assert matrix == {0: (4, 2), 1: (1, 3)}
    assert tuple(metrics.accuracy(frame).first()) == (0.7, 10)
    assert tuple(metrics.prf_overall(frame).first()) == (0.7, 0.7, 0.7)
    report = metrics.metric_report(frame).first()
    assert (report["recall"], report["precision"], report["f1"], report["n_rows"]) == (0.7, 0.7, 0.7, 10)


@pytest.mark.parametrize("cells,auc", [((3, 0, 0, 2), 1.0), ((0, 3, 2, 0), 0.0)])
def test_hard_auc_of_one_class(spark, cells, auc):
    assert metrics.auc_hard(pairs(spark, *cells)).first()["auc"] == auc


@pytest.mark.parametrize("cells", [(3, 2, 4, 1), (10, 0, 5, 5), (1, 7, 3, 9)])
def test_same_values_as_the_rdd_metrics(spark, cells):
    frame = pairs(spark, *cells)
    rdd = frame.rdd.map(tuple)
    assert metrics.auc_hard(frame).first()["auc"] == pytest.approx(BinaryClassificationMetrics(rdd).areaUnderROC)
    old = MulticlassMetrics(rdd)
    assert metrics.accuracy(frame).first()["accuracy"] == pytest.approx(old.accuracy)
    want = old.confusionMatrix().toArray()
    got = [[r["predicted_0"], r["predicted_1"]] for r in metrics.confusion_matrix(frame).orderBy("label").collect()]
    assert np.array_equal(got, want)
    rows = {r["class"]: r for r in metrics.prf_per_class(frame).collect()}
    for label in (0.0, 1.0):
        r = rows[str(int(label))]
        assert (r["precision"], r["recall"], r["f1"]) == pytest.approx((old.precision(label), old.recall(label), old.fMeasure(label)))
    assert (rows["weighted"]["precision"], rows["weighted"]["recall"], rows["weighted"]["f1"]) == pytest.approx(
        (old.weightedPrecision, old.weightedRecall, old.weightedFMeasure())
    )
    assert metrics.prf_overall(frame).first()["f1"] == pytest.approx(
        MulticlassClassificationEvaluator(metricName="accuracy").evaluate(frame)
    )


def test_score_auc_counts_ties_half(spark):
    rng = np.random.default_rng(0)
    score, label = rng.integers(0, 20, 300).astype(float), rng.integers(0, 2, 300)
    frame = spark.createDataFrame([(float(s), float(y)) for s, y in zip(score, label)], "score DOUBLE, label DOUBLE")
    pos, neg = score[label == 1], score[label == 0]
    brute = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert metrics.auc_score(frame) == pytest.approx(brute, abs=1e-12)


def test_losses(spark):
    frame = spark.createDataFrame([([0.25, 0.75], [1, 0]), ([0.0, 1.0], [1, 0])], "p ARRAY<DOUBLE>, y ARRAY<INT>")
    loss = metrics.cross_entropy(frame, "p", "y")
    want = -math.log(0.25 + 1e-10) - math.log(1e-10)
    assert loss.first()["cross_entropy"] == pytest.approx(want)
    weights = spark.createDataFrame([("a", 3.0), ("b", 4.0)], "layer STRING, w DOUBLE")
    penalty = metrics.l2_penalty(weights, 10 / 138)
    assert penalty.first()["l2_penalty"] == pytest.approx(12.5 * 10 / 138)
    total = metrics.total_loss(loss, penalty).first()
    assert total["total_loss"] == pytest.approx(want + 12.5 * 10 / 138)


def test_hot_cell_of_the_confusion_matrix(spark):
    """One (prediction, label) pair holds nearly all rows: counted on the map side."""
    frame = spark.range(200_000).select(
        F.lit(1.0).alias("prediction"), (F.col("id") > 0).cast("double").alias("label")
    )
    counts = metrics.confusion_counts(frame).first()
    assert tuple(counts) == (199_999, 1, 0, 0)
