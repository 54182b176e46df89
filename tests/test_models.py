"""Classifiers on separable data, optimality of the fits, saved models, day plans."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowmosaic.operators import models
from flowmosaic.plans import classify, days as day_plans
from flowmosaic.schema import GridSpec
from flowmosaic.sources import registry, scans, sinks


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    x = rng.normal(size=(300, 4)) + np.outer(2 * y - 1, [1.0, 0.5, 0.0, -0.5])
    rows = [(i, float(y[i]), [float(v) for v in x[i]]) for i in range(300)]
    frame = spark.createDataFrame(rows, "id BIGINT, label DOUBLE, x ARRAY<DOUBLE>").select(
        "id", "label", array_to_vector("x").alias("features")
    )
    return frame.cache(), x, y


@pytest.mark.parametrize("kind", models.KINDS)
def test_every_kind_learns(data, kind):
    frame, _, _ = data
    row = models.train_model(frame.filter("id < 240"), frame.filter("id >= 240"), kind, 20).first()
    assert row["model"] == models.KINDS[kind]
    assert (row["n_train"], row["n_test"]) == (240, 60)
    assert row["recall"] == row["precision"] == row["f1"] > 0.75 and row["auc"] > 0.75


def test_bakeoff_and_pca(data):
    frame, _, _ = data
    report = models.model_bakeoff(frame, frame, [(2, 10), (3, 10)], pca_k=2).collect()
    assert [r["model"] for r in report] == ["logistic_l2", "logistic_lbfgs"]
    with pytest.raises(ValueError):
        models.model_bakeoff(frame, frame, [])


def test_training_on_nothing_is_refused(data):
    frame, _, _ = data
    with pytest.raises(ValueError, match="no rows"):
        models.fit_classifier(frame.filter("false"), 2, 5)


def scaled(x):
    return (x - x.mean(0)) / x.std(0, ddof=1)


def test_linear_kind_is_least_squares_through_the_origin(data):
    frame, x, y = data
    model = models.fit_classifier(frame, 1, 100)
    want, *_ = np.linalg.lstsq(scaled(x), y, rcond=None)
    assert np.allclose(model.stages[-1].coefficients.toArray(), want, atol=1e-6)
    out = models.predict(model, frame, cut=0.1).collect()
    for r in out:
        score = scaled(x)[r["id"]] @ want
        assert r["score"] == pytest.approx(score, abs=1e-6) and r["prediction"] == float(score > 0.1)


@pytest.mark.parametrize("kind,l2", [(2, 0.01), (3, 0.0)])
def test_logistic_kinds_reach_a_stationary_point(data, kind, l2):
    frame, x, y = data
    model = models.fit_classifier(frame, kind, 1000)
    w = model.stages[-1].coefficients.toArray()
    z = scaled(x)
    slope = z.T @ (1 / (1 + np.exp(-z @ w)) - y) / len(y) + l2 * w
    assert np.abs(slope).max() < 1e-4 and model.stages[-1].intercept == 0.0


def test_svm_comes_close_to_the_best_hinge_loss(data):
    frame, x, y = data
    z, sign = scaled(x), 2 * y - 1

    def objective(w):
        return np.maximum(0, 1 - sign * (z @ w)).mean() + models.L2_REG / 2 * w @ w

    w, best = np.zeros(4), np.inf
    for step in range(1, 20_001):  # plain subgradient descent
        margin = sign * (z @ w) < 1
        w = w - 1 / (models.L2_REG * (step + 100)) * (-(z * sign[:, None])[margin].sum(0) / len(y) + models.L2_REG * w)
        best = min(best, objective(w))
    fitted = models.fit_classifier(frame, 4, 100).stages[-1]
    assert objective(fitted.coefficients.toArray()) < best * 1.005 and fitted.intercept == 0.0


def test_forest_shape(data):
    frame, _, _ = data
    forest = models.fit_classifier(frame, 5, 7, seed=1).stages[-1]
    assert forest.getNumTrees == 7 and max(t.depth for t in forest.trees) <= 5


def test_curves(data):
    frame, _, _ = data
    trace = models.objective_trace(models.fit_classifier(frame, 2, 30), frame).orderBy("step").collect()
    losses = [r["loss"] for r in trace]
    assert losses[0] == pytest.approx(np.log(2), abs=1e-6) and losses == sorted(losses, reverse=True)
    steps = models.accuracy_trace(frame, frame, 2, [1, 10]).orderBy("step").collect()
    assert [r["step"] for r in steps] == [1, 10] and steps[1]["train_accuracy"] > 0.75


def test_retention(spark):
    rows = [("cnn", s, f"cnn-{s}") for s in range(1000, 11000, 1000)] + [("cnn", 9000, "cnn-9000"), ("other", 5, "o-5")]
    kept = registry.retained(spark.createDataFrame(rows, registry.MANIFEST_SCHEMA)).collect()
    assert sorted(r["step"] for r in kept if r["model"] == "cnn") == [6000, 7000, 8000, 9000, 10000]
    assert {(r["model"], r["step"]) for r in kept if r["is_latest"]} == {("cnn", 10000), ("other", 5)}


def test_retention_of_a_hot_model(spark):
    manifest = spark.range(100_000).select(
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id"))).alias("model"),
        F.col("id").alias("step"), F.col("id").cast("string").alias("path"),
    )
    kept = registry.retained(manifest)
    assert kept.count() == 5 + 10_000
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_retention_of_a_hot_step(spark):
    """One step saved 50,000 times is still one step."""
    rows = spark.range(50_000).select(F.lit("m").alias("model"), F.lit(9).cast("bigint").alias("step"), F.lit("p9").alias("path"))
    rest = spark.range(9).select(F.lit("m").alias("model"), F.col("id").alias("step"), F.concat(F.lit("p"), F.col("id")).alias("path"))
    kept = registry.retained(rows.unionByName(rest)).collect()
    assert sorted((r["step"], r["path"]) for r in kept) == [(s, f"p{s}") for s in (5, 6, 7, 8, 9)]


def test_save_choose_restore(spark, data, tmp_path):
    frame, _, _ = data
    store = registry.ModelRegistry(spark, str(tmp_path), "lr", keep=2)
    fitted = {step: models.fit_classifier(frame, 2, step) for step in (1, 2, 30)}
    for step, model in fitted.items():
        store.save(model, step)
    assert [r["step"] for r in store.checkpoints().orderBy("step").collect()] == [2, 30]
    assert store.choose("latest").endswith("lr-30") and store.choose("oldest").endswith("lr-2")
    with pytest.raises(LookupError):
        store.choose(1)
    for step in (2, 30):
        same = [models.predict(m, frame).select("id", "score", "prediction").orderBy("id").collect()
                for m in (fitted[step], store.restore(step))]
        assert same[0] == same[1]


def test_local_rows_are_bounded(spark):
    assert scans.local_rows(spark, [(1, "a")], "i INT, s STRING").count() == 1
    with pytest.raises(ValueError, match="scan"):
        scans.local_rows(spark, [(1,)] * 11, "i INT", limit=10)


# -- plans on a small city -----------------------------------------------------------------------

CITY = GridSpec(4, 4, 360)


@pytest.fixture(scope="module")
def city(spark):
    cells = spark.range(60 * CITY.slots * CITY.cells)
    day = F.floor(F.col("id") / (CITY.slots * CITY.cells)).cast("int")
    place = (F.col("id") % CITY.cells).cast("int")
    date = F.date_add(F.lit("2024-01-01").cast("date"), day)
    busy = F.when(F.weekday(date) >= 5, 3.0).otherwise(1.0)
    flow = cells.select(
        date.alias("date"),
        (F.floor(F.col("id") / CITY.cells) % CITY.slots + 1).cast("int").alias("slot"),
        F.floor(place / 4).cast("int").alias("grid_row"),
        (place % 4).alias("grid_col"),
        (busy * (100 + F.col("id") % 13)).alias("inflow"),
        (busy * (50 + F.col("id") % 7)).alias("outflow"),
    )
    weather = flow.select("date", "slot").distinct().select(
        "date", "slot", (F.dayofmonth("date") * 1.0).alias("temperature"), F.lit(5.0).alias("windspeed"),
        (F.dayofmonth("date") % 17).alias("weather_code"),
    )
    return flow, weather


def test_day_sets_written_and_read_back(spark, city, tmp_path):
    flow, weather = city
    raw_path, gen_path = str(tmp_path / "raw"), str(tmp_path / "gen")
    made = day_plans.raw_days(flow, weather, CITY)
    for _ in range(2):  # the second write replaces the first
        day_plans.write_day_sets(made, raw_path, gen_path, seed=1)
    raw, gen = scans.scan_raw_days(spark, raw_path), scans.scan_gen_days(spark, gen_path)
    assert (raw.count(), gen.count()) == (60, 300)
    assert sorted(raw.collect()) == sorted(made.select(*raw.columns).collect())
    plan = gen.filter("batch = 3").select("label")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan
    assert gen.filter("batch = 3").count() == 60


def test_flow_table_prunes_by_date(spark, city, tmp_path):
    flow, _ = city
    sinks.write_flow(flow, str(tmp_path / "flow"))
    stored = scans.scan_flow(spark, str(tmp_path / "flow"))
    assert stored.count() == flow.count()
    one = stored.filter("date = DATE '2024-01-05'").select("inflow")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters:")[1].split("]")[0] and "outflow" not in plan
    assert one.count() == CITY.slots * CITY.cells


def test_day_totals(city):
    flow, _ = city
    rows = day_plans.day_totals(flow, CITY).collect()
    assert len(rows) == 60 and sum(r["label"] for r in rows) == 16
    assert all(r["n_cells"] == CITY.slots * CITY.cells for r in rows)


def test_weekends_are_found_end_to_end(spark, city):
    from flowmosaic.operators.augment import augment_days
    from flowmosaic.operators.splits import (
        protocol_aug_raw,
        protocol_raw_split,
        protocol_split_augment,
        raw_examples,
    )

    flow, weather = city
    days = day_plans.raw_days(flow, weather, CITY).cache()
    report = classify.classify_examples(protocol_split_augment(days, seed=2), kind=2, iterations=50).first()
    assert report["auc"] == 1.0 and report["f1"] == 1.0
    net = classify.classify_examples(
        protocol_split_augment(days, seed=2), kind=2, iterations=50, points=classify.net_points
    ).first()
    assert net["auc"] == 1.0 and net["n_test"] == report["n_test"]
    points = classify.pooled_points(raw_examples(days), CITY, 3)
    width = len(points.select(vector_to_array("features").alias("v")).first()["v"])
    assert width == classify.pooled_width(CITY, 3) == CITY.channels * 4 + 19
    for examples in (protocol_split_augment(days, seed=2), protocol_aug_raw(days, augment_days(days)), protocol_raw_split(days)):
        _, out = classify.neural_day_classifier(examples, CITY, 2, 20, seed=2)
        assert out.count() > 0 and out.filter("prediction != label").count() == 0
    days.unpersist()
