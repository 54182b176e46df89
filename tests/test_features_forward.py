"""Scaling, covariance, components, dense layers and the network against NumPy."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowmosaic.operators import features, forward
from flowmosaic.schema import GridSpec


def points(spark, matrix, labels=None):
    rows = [(i, float(labels[i]) if labels is not None else 0.0, [float(v) for v in row]) for i, row in enumerate(matrix)]
    frame = spark.createDataFrame(rows, "id BIGINT, label DOUBLE, x ARRAY<DOUBLE>")
    return frame.select("id", "label", array_to_vector("x").alias("features"))


def matrix_of(frame, column):
    rows = frame.select("id", vector_to_array(column).alias("v")).orderBy("id").collect()
    return np.array([r["v"] for r in rows])


def test_scaler_and_constant_column(spark):
    frame = points(spark, [[1, 5], [2, 5], [4, 5]])
    model = features.fit_scaler(frame)
    got = matrix_of(model.transform(frame), "scaled")
    assert np.allclose(got[:, 0], [-0.8729, -0.2182, 1.0911], atol=1e-4) and np.array_equal(got[:, 1], [0, 0, 0])
    table = {r["i"]: (r["mean"], r["std"]) for r in features.scaler_table(frame, model).collect()}
    assert table[0] == pytest.approx((7 / 3, 1.527525), abs=1e-6) and table[1] == (5.0, 0.0)


def test_scaler_applies_to_other_rows(spark):
    model = features.fit_scaler(points(spark, [[0.0], [2.0]]))
    got = matrix_of(model.transform(points(spark, [[1.0], [5.0]])), "scaled")
    assert np.allclose(got[:, 0], [0.0, 4 / np.sqrt(2)])


@pytest.mark.parametrize("parts", [1, 7])
def test_covariance_matrix(spark, parts):
    data = np.random.default_rng(0).normal(size=(200, 6)) * 3 + 1000
    got = features.covariance_matrix(points(spark, data).repartition(parts)).collect()
    want = np.cov(data.T)
    assert len(got) == 21
    for r in got:
        assert r["i"] <= r["j"] and r["cov"] == pytest.approx(want[r["i"], r["j"]], abs=1e-9)


def test_covariance_refuses_what_cannot_fit(spark):
    with pytest.raises(ValueError, match="two rows"):
        features.covariance_matrix(points(spark, [[1.0]]))
    wide = spark.range(2).select(array_to_vector(F.array_repeat(F.lit(1.0), 4097)).alias("features"))
    with pytest.raises(ValueError, match="4097"):
        features.covariance_matrix(wide)


def test_pca_is_orthonormal_and_keeps_variance(spark):
    data = np.random.default_rng(3).normal(size=(80, 5)) @ np.random.default_rng(4).normal(size=(5, 5)) + 7
    frame = points(spark, data)
    model = features.fit_pca(frame, 3, "features")
    axes = model.pc.toArray()
    assert np.allclose(axes.T @ axes, np.eye(3))
    projected = matrix_of(model.transform(frame), "components")
    assert np.allclose(projected, data @ axes)  # not centred
    eigenvalues = np.sort(np.linalg.eigvalsh(np.cov(data.T)))[::-1]
    assert np.allclose(projected.var(axis=0, ddof=1), eigenvalues[:3])
    assert np.allclose(model.explainedVariance.toArray(), eigenvalues[:3] / eigenvalues.sum())


def test_pca_of_one_column_is_the_column(spark):
    frame = points(spark, [[1.0], [2.0], [4.0]])
    got = matrix_of(features.fit_pca(frame, 1, "features").transform(frame), "components")[:, 0]
    assert np.allclose(np.abs(got), [1, 2, 4])


def test_dense_layer(spark):
    rng = np.random.default_rng(5)
    x, w, b = rng.normal(size=(9, 4)), rng.normal(size=(4, 3)), rng.normal(size=3)
    frame = points(spark, x).select("id", vector_to_array("features").alias("x"))
    layer = features.dense_layer(F.col("x"), w.tolist(), b.tolist())
    got = np.array([r["z"] for r in frame.select("id", layer.alias("z")).orderBy("id").collect()])
    assert np.allclose(got, x @ w + b)


def naive_network(flow, others, w):
    """Loop-by-loop forward pass of one day."""
    def conv(x, k, bias):
        h, wd, _ = x.shape
        kh, kw, _, filters = k.shape
        out = np.zeros((h, wd, filters))
        for r in range(h):
            for c in range(wd):
                for a in range(kh):
                    for b in range(kw):
                        rr, cc = r + a - kh // 2, c + b - kw // 2
                        if 0 <= rr < h and 0 <= cc < wd:
                            out[r, c] += x[rr, cc] @ k[a, b]
        return np.maximum(out + bias, 0)

    def pool(x):
        h, wd, ch = x.shape
        return np.array([[x[2 * r : 2 * r + 2, 2 * c : 2 * c + 2].reshape(-1, ch).max(0)
                          for c in range(-(-wd // 2))] for r in range(-(-h // 2))])

    x = pool(conv(pool(conv(flow, w.conv1, w.conv1_bias)), w.conv2, w.conv2_bias))
    a = np.maximum(x.reshape(-1) @ w.grid + w.grid_bias, 0)
    b = np.maximum(others @ w.others + w.others_bias, 0)
    return np.maximum(np.concatenate([a, b]) @ w.joint + w.joint_bias, 0)


def random_weights(spec, rng, sizes=(3, 4, 6, 5, 7)):
    f1, f2, g, o, j = sizes
    pooled = -(-(-(-spec.rows // 2)) // 2) * -(-(-(-spec.cols // 2)) // 2)

    def n(*shape):
        return rng.normal(size=shape)

    return forward.NetWeights(n(5, 5, spec.channels, f1), n(f1), n(5, 5, f1, f2), n(f2), n(pooled * f2, g), n(g),
                              n(19, o), n(o), n(g + o, j), n(j))


@pytest.mark.parametrize("spec", [GridSpec(4, 4, 360), GridSpec(5, 7, 720)])
def test_network_features(spark, spec):
    rng = np.random.default_rng(6)
    weights = random_weights(spec, rng)
    flow, others = rng.normal(size=(11, spec.tensor_size)), rng.normal(size=(11, 19))
    rows = [(f"2024-01-{i + 1:02d}", flow[i].tolist(), others[i].tolist() if i != 4 else None, i % 2) for i in range(11)]
    days = spark.createDataFrame(rows, "d STRING, flow ARRAY<DOUBLE>, others ARRAY<DOUBLE>, label INT")
    days = days.select(F.col("d").cast("date").alias("date"), "flow", "others", "label").repartition(3)
    got = {r["date"].day - 1: r for r in forward.extract_features(days, spec, weights, chunk=2).collect()}
    assert len(got) == 11 and got[4]["features"] is None
    shape = (spec.rows, spec.cols, spec.channels)
    for i in set(range(11)) - {4}:
        assert got[i]["label"] == i % 2
        assert np.allclose(got[i]["features"], naive_network(flow[i].reshape(shape), others[i], weights))


def test_weights_beyond_the_bound_are_refused(spark, monkeypatch):
    monkeypatch.setattr(forward, "MAX_WEIGHT_BYTES", 10)
    with pytest.raises(ValueError, match="bound"):
        forward.extract_features(spark.range(1), GridSpec(), random_weights(GridSpec(4, 4, 720), np.random.default_rng(0)))
