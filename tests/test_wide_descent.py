"""Wide components against a dense decomposition; gradient descent against the library's and a plain loop."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from flowmosaic.functions.keyed import keyed_uniform
from flowmosaic.operators import descent, models, wide


def points_of(spark, x, y=None):
    y = np.zeros(len(x)) if y is None else y
    rows = [(i, float(b), a.tolist()) for i, (a, b) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "id INT, label DOUBLE, x ARRAY<DOUBLE>")
    return frame.select("id", "label", array_to_vector("x").alias("features"))


def dense(x, k):
    _, s, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    v = v[:k] * np.sign(v[np.arange(k), np.abs(v[:k]).argmax(axis=1)])[:, None]
    return v, s[:k] ** 2 / (len(x) - 1), (s**2).sum() / (len(x) - 1)


def loadings(fitted):
    return np.array([r["loadings"] for r in sorted(fitted.loadings.collect(), key=lambda r: r["i"])]).T


@pytest.fixture(scope="module")
def steep():
    """Rows whose variance falls quickly from direction to direction."""
    rng = np.random.default_rng(3)
    return (rng.standard_normal((90, 40)) * 2.0 ** -np.arange(40)) @ np.linalg.qr(rng.standard_normal((40, 40)))[0] + 5.0


@pytest.mark.parametrize("limits", [{}, {"gram_rows": 0}, {"gram_rows": 0, "covariance_width": 0}])
def test_every_path_gives_the_components(spark, steep, limits):
    for x in (steep, steep[:30]):
        fitted = wide.fit_wide_pca(points_of(spark, x), "id", 4, "features", **limits)
        v, variances, total = dense(x, 4)
        assert np.allclose(loadings(fitted), v, atol=1e-6)
        assert np.allclose(fitted.variances, variances) and np.isclose(fitted.total_variance, total)


def test_days_of_full_width(spark):
    """98,323 columns, as 32 x 32 cells x 96 channels and 19 attributes make."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((24, 5)) @ rng.standard_normal((5, 98_323)) + 0.1 * rng.standard_normal((24, 98_323))
    frame = (
        spark.createDataFrame([(i, a.tobytes()) for i, a in enumerate(x)], "id INT, raw BINARY").repartition(6)
        .mapInPandas(lambda parts: (p.assign(x=[np.frombuffer(r) for r in p["raw"]])[["id", "x"]] for p in parts), "id INT, x ARRAY<DOUBLE>")
        .select("id", array_to_vector("x").alias("features"))
    )
    fitted = wide.fit_wide_pca(frame, "id", 3, "features")
    v, variances, _ = dense(x, 3)
    assert np.allclose(loadings(fitted), v, atol=1e-8) and np.allclose(fitted.variances, variances)
    got = {r["id"]: r["components"] for r in wide.project_wide(frame, "id", fitted, "features").collect()}
    assert np.allclose([got[i] for i in range(24)], x @ v.T)


def test_too_many_components_or_repeated_keys(spark, steep):
    with pytest.raises(ValueError):
        wide.fit_wide_pca(points_of(spark, steep[:3]), "id", 3, "features")
    with pytest.raises(ValueError):
        wide.fit_wide_pca(points_of(spark, steep[:9]).withColumn("id", F.lit(1)), "id", 2, "features")


def test_classifier_on_wide_components(spark, monkeypatch):
    rng = np.random.default_rng(5)
    y = np.arange(80) % 2
    x = rng.standard_normal((80, 50))
    x[:, :10] += 3 * y[:, None]
    frame = points_of(spark, x, y)
    train, test = frame.filter("id < 60"), frame.filter("id >= 60")
    narrow = models.train_model(train, test, 3, 100, pca_k=3).first()
    monkeypatch.setattr(models, "MAX_COVARIANCE_WIDTH", 40)
    assert models.train_model(train, test, 3, 100, pca_k=3).first() == narrow and narrow["auc"] > 0.9


@pytest.fixture(scope="module")
def separable():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 6))
    return x, (x @ [1, -2, 0.5, 0, 0, 1] + 0.3 * rng.standard_normal(120) > 0).astype(float)


@pytest.mark.parametrize("kind", ["hinge", "logistic", "squared"])
def test_descent_takes_the_librarys_steps(spark, separable, kind):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD

    x, y = separable
    rdd = spark.sparkContext.parallelize([LabeledPoint(b, a) for a, b in zip(x, y)], 3)
    train = {"hinge": SVMWithSGD, "logistic": LogisticRegressionWithSGD, "squared": LinearRegressionWithSGD}[kind].train
    l2 = 0.0 if kind == "squared" else 0.01
    penalty = {} if kind == "squared" else {"regParam": l2, "regType": "l2"}
    expected = train(rdd, iterations=30, step=0.5, convergenceTol=0.0, **penalty)
    got = descent.fit_descent(points_of(spark, x, y), kind, 30, step=0.5, l2=l2, tolerance=0.0)
    assert np.allclose(got.weights, expected.weights.toArray(), atol=1e-10) and len(got.history) == 30


def test_mini_batches_resume_and_partitions(spark, separable):
    x, y = separable
    frame = points_of(spark, x, y)
    options = dict(key="id", fraction=0.3, seed=4, tolerance=0.0)
    whole = descent.fit_descent(frame, "hinge", 12, **options)
    again = descent.fit_descent(frame.repartition(7), "hinge", 12, **options)
    half = descent.fit_descent(frame, "hinge", 5, **options)
    rest = descent.fit_descent(frame, "hinge", 7, start=half.weights, done=5, **options)
    assert np.allclose(whole.weights, again.weights, atol=1e-12) and np.allclose(whole.weights, rest.weights, atol=1e-12)
    w = np.zeros(6)
    for t in range(1, 13):
        drawn = {r["id"] for r in frame.filter(keyed_uniform(4, "minibatch", F.lit(t), F.col("id")) < 0.3).select("id").collect()}
        rows, rate = sorted(drawn), 1 / np.sqrt(t)
        sign = 2 * y[rows] - 1
        hit = sign * (x[rows] @ w) < 1
        w = w * (1 - rate * 0.01) - rate * (np.where(hit, -sign, 0) @ x[rows]) / len(rows)
    assert np.allclose(whole.weights, w)


def test_descent_stops_and_refuses(spark, separable):
    x, y = separable
    frame = points_of(spark, x, y)
    done = descent.fit_descent(frame, "logistic", 500, tolerance=0.05)
    assert done.converged and len(done.history) < 500
    extra = frame.unionByName(spark.createDataFrame([(500, None)], "id INT, label DOUBLE").withColumn("features", array_to_vector(F.array(*[F.lit(9.0)] * 6))))
    assert np.allclose(descent.fit_descent(extra, "logistic", 3).weights, descent.fit_descent(frame, "logistic", 3).weights)
    for bad in (lambda: descent.fit_descent(frame, "cubic", 3), lambda: descent.fit_descent(frame.limit(0), "hinge", 3), lambda: descent.fit_descent(frame, "hinge", 3, fraction=0.5)):
        with pytest.raises(ValueError):
            bad()
