"""Evaluation as aggregates: one pass over (prediction, label), everything else from the counts."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.scoring import guarded_log


def confusion_counts(pairs: DataFrame) -> DataFrame:
    """One row (tp, fp, tn, fn) from 0/1 predictions and labels."""
    def count(prediction: int, label: int) -> Column:
        hit = (F.col("prediction") == prediction) & (F.col("label") == label)
        return F.count(F.when(hit, 1))

    return pairs.agg(
        count(1, 1).alias("tp"), count(1, 0).alias("fp"), count(0, 0).alias("tn"), count(0, 1).alias("fn")
    )


def confusion_matrix(pairs: DataFrame) -> DataFrame:
    """Rows = actual label, columns = predicted label, both ascending."""
    return (
        pairs.groupBy(F.col("label").cast("int").alias("label"))
        .pivot("prediction", [0, 1])
        .agg(F.count(F.lit(1)))
        .select(
            "label",
            F.coalesce(F.col("0"), F.lit(0)).alias("predicted_0"),
            F.coalesce(F.col("1"), F.lit(0)).alias("predicted_1"),
        )
    )


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _hard_auc() -> Column:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    both = (tp / (tp + fn) + tn / (tn + fp)) / 2
    return (
        F.when(tp + fn == 0, F.lit(0.0)).when(tn + fp == 0, F.lit(1.0)).otherwise(both)
    )


def _total() -> Column:
    return F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")


def _accuracy() -> Column:
    return _ratio(F.col("tp") + F.col("tn"), _total())


def accuracy(pairs: DataFrame) -> DataFrame:
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return pairs.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def auc_hard(pairs: DataFrame) -> DataFrame:
    """Area under the curve of 0/1 predictions: (TPR + TNR) / 2.

    Without negatives the curve is 1, without positives 0.
    """
    return confusion_counts(pairs).select(_hard_auc().alias("auc"))


def auc_score(scored: DataFrame, score: str = "score", label: str = "label") -> float:
    """Exact area under the curve of the scores (``numBins=0``: no down-sampling of thresholds)."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(
        scored.select(F.col(score).cast("double"), F.col(label).cast("double"))
    )


def prf_overall(pairs: DataFrame) -> DataFrame:
    """Overall precision, recall and F1 in the old no-argument sense: all equal accuracy."""
    return confusion_counts(pairs).select(
        _accuracy().alias("precision"), _accuracy().alias("recall"), _accuracy().alias("f1")
    )


def prf_per_class(pairs: DataFrame) -> DataFrame:
    """(class, support, precision, recall, f1) for class 0, class 1 and their weighted mean."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def scores(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            (hit + missed).alias("support"),
            _ratio(hit, hit + wrong).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
        )

    per_class = confusion_counts(pairs).select(
        scores("0", tn, fn, fp).alias("c0"), scores("1", tp, fp, fn).alias("c1")
    )

    def weighted(metric: str) -> Column:
        zero, one = F.col("c0.support"), F.col("c1.support")
        return _ratio(
            F.col(f"c0.{metric}") * zero + F.col(f"c1.{metric}") * one, zero + one
        ).alias(metric)

    mean = F.struct(
        F.lit("weighted").alias("class"),
        (F.col("c0.support") + F.col("c1.support")).alias("support"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )
    return per_class.select(F.inline(F.array(F.col("c0"), F.col("c1"), mean)))


def metric_report(pairs: DataFrame) -> DataFrame:
    """(auc, recall, precision, f1, n_rows) in one row, legacy overall values."""
    return confusion_counts(pairs).select(
        _hard_auc().alias("auc"),
        _accuracy().alias("recall"),
        _accuracy().alias("precision"),
        _accuracy().alias("f1"),
        _total().alias("n_rows"),
    )


def cross_entropy(
    scored: DataFrame, probabilities: str, onehot: str, epsilon: float = 1e-10
) -> DataFrame:
    """-sum(y log(p + eps)) over rows and classes (a sum, not a mean)."""
    terms = F.zip_with(probabilities, onehot, lambda p, y: y * guarded_log(p, epsilon))
    row_loss = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return scored.agg((-F.sum(row_loss)).alias("cross_entropy"))


def l2_penalty(weights: DataFrame, scale: Column | float) -> DataFrame:
    """scale * sum(w^2) / 2 over a long weights table."""
    factor = scale if isinstance(scale, Column) else F.lit(float(scale))
    return weights.agg((F.sum(F.col("w") * F.col("w")) / 2).alias("half_squares")).select(
        (F.col("half_squares") * factor).alias("l2_penalty")
    )


def total_loss(loss: DataFrame, penalty: DataFrame) -> DataFrame:
    """Sum of two one-row aggregates, the second as a scalar subquery."""
    return loss.select(
        "cross_entropy", penalty.select("l2_penalty").scalar().alias("l2_penalty")
    ).withColumn("total_loss", F.col("cross_entropy") + F.col("l2_penalty"))
