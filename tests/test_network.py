"""Back-propagation by finite differences; training does not depend on partitions and goes on from stored weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmosaic.operators import network
from flowmosaic.schema import N_OTHERS, GridSpec
from flowmosaic.sources.weights import WeightStore

SPEC = GridSpec(3, 5, 720)  # odd sides: pooled blocks at the edge are smaller
SMALL = network.NetworkSettings(filters=(3, 4), units=(6, 5, 4), rate=0.01, batch_size=8, l2=0.001, seed=3)


@pytest.fixture(scope="module")
def days(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(20):
        flow = rng.standard_normal(SPEC.cells * SPEC.channels) + (i % 2)
        rows.append((f"d{i:02d}", flow.tolist(), rng.standard_normal(N_OTHERS).tolist(), i % 2))
    rows.append(("none", rows[0][1], None, 1))
    return spark.createDataFrame(rows, "date STRING, flow ARRAY<DOUBLE>, others ARRAY<DOUBLE>, label INT").cache()


def same(a, b):
    return all(np.array_equal(x, b.network.arrays()[k]) for k, x in a.network.arrays().items())


def test_gradients_by_finite_differences():
    rng = np.random.default_rng(1)
    net = network.fresh_network(SPEC, SMALL)
    flow, others = rng.standard_normal((3, 5, SPEC.channels)), rng.standard_normal(N_OTHERS)
    masks = network.dropout_masks(net, SMALL, 2, 5)
    grads, loss, _ = network.day_gradients(flow, others, 1, net, masks)
    assert loss > 0 and set(grads) == set(net.arrays())
    for name, grad in grads.items():
        arrays = {k: v.copy() for k, v in net.arrays().items()}
        places = np.argsort(-np.abs(grad), axis=None)[:3].tolist() + [0]
        for at in places:
            kept = arrays[name].flat[at]
            losses = []
            for move in (1e-5, -1e-5):
                arrays[name].flat[at] = kept + move
                losses.append(network.day_gradients(flow, others, 1, network.DayNetwork.of(arrays), masks)[1])
            arrays[name].flat[at] = kept
            assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(grad.flat[at], rel=1e-4, abs=1e-8)


def test_masks_and_fresh_weights():
    net = network.fresh_network(SPEC, SMALL)
    assert all(np.abs(v).max() <= 0.2 for v in net.arrays().values()) and (net.out_bias == 0.1).all()
    masks = network.dropout_masks(net, SMALL, 1, 1)
    assert [len(m) for m in masks] == [6, 5, 4] and set(np.concatenate(masks)) <= {0.0, 2.0}
    everything = network.dropout_masks(net, network.NetworkSettings(keep=1.0), 1, 1)
    assert all((m == 1).all() for m in everything)


def test_partitions_do_not_matter(days):
    one = network.train_network(days.coalesce(1), SPEC, "date", 4, SMALL)
    many = network.train_network(days.repartition(9), SPEC, "date", 4, SMALL)
    assert same(one, many) and one.trace == many.trace and one.step == 4
    assert not same(one, network.fresh_state(SPEC, SMALL))


def test_a_step_is_adam_on_the_mean_gradient(days):
    seen = []
    network.train_network(days, SPEC, "date", 1, SMALL, on_step=seen.append)
    drawn = network.bootstrap_batches(days.filter("others IS NOT NULL").select("date"), ["date"], 1, 8, SMALL.seed).collect()
    rows = {r["date"]: r for r in days.collect()}
    net, total = network.fresh_network(SPEC, SMALL), None
    for pick in drawn:
        row = rows[pick["date"]]
        masks = network.dropout_masks(net, SMALL, 0, pick["draw"])
        grads, *_ = network.day_gradients(np.reshape(row["flow"], (3, 5, -1)), np.array(row["others"]), row["label"], net, masks)
        total = grads if total is None else {k: total[k] + g for k, g in grads.items()}
    for name, before in net.arrays().items():
        g = total[name] / 8 + (0 if name.endswith("bias") else SMALL.l2) * before
        sizeable = np.abs(g) > 1e-6
        moved = (seen[0].network.arrays()[name] - before)[sizeable]
        g = g[sizeable]  # the first step of Adam: both moments hold this gradient alone
        assert np.allclose(moved, -SMALL.rate * g / (np.abs(g) + SMALL.epsilon / np.sqrt(1 - SMALL.beta[1])), rtol=1e-3)


def test_training_goes_on_from_stored_weights(spark, days, tmp_path):
    store = WeightStore(spark, str(tmp_path / "w"), keep=2)
    saved = []

    def keep(state):
        if state.step in (2, 3, 5):
            saved.append(store.save(state))

    whole = network.train_network(days, SPEC, "date", 7, SMALL, on_step=keep)
    assert [r["step"] for r in store.checkpoints().orderBy("step").collect()] == [3, 5] and len(saved) == 3
    for choice, left in (("oldest", 4), ("latest", 2), (3, 4)):
        state = store.restore(choice, like=whole.network)
        rest = network.train_network(days, SPEC, "date", left, SMALL, state)
        assert same(rest, whole) and rest.trace == whole.trace
    with pytest.raises(LookupError):
        store.restore(2)
    with pytest.raises(ValueError):
        store.restore("latest", like=network.fresh_network(SPEC, network.NetworkSettings(units=(6, 5, 3))))


def test_a_damaged_table_is_refused_and_a_second_save_counts(spark, tmp_path):
    store = WeightStore(spark, str(tmp_path / "w"))
    with pytest.raises(LookupError):
        store.restore()
    state = network.fresh_state(SPEC, SMALL)
    store.save(state)
    twice = network.fresh_state(SPEC, network.NetworkSettings(filters=(3, 4), units=(6, 5, 4), seed=9))
    path = store.save(twice)
    assert same(store.restore(0), twice)
    part = store.table(0).filter("NOT (layer = 'grid' AND slot = 'weights' AND position = 4)").collect()
    spark.createDataFrame(part, store.table(0).schema).write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError):
        store.restore(0)


def test_it_learns_and_predicts(spark, days):
    settings = network.NetworkSettings(filters=(3, 4), units=(8, 8, 6), rate=0.01, batch_size=16, keep=1.0, seed=1)
    state = network.train_network(days, SPEC, "date", 25, settings)
    assert state.trace[-1][1] < state.trace[0][1] and network.trace_table(days, state).count() == 25
    out = network.predict_days(days, SPEC, state.network, "date").collect()
    assert np.mean([r["prediction"] == r["label"] for r in out if r["score"] is not None]) >= 0.9
    assert [r["date"] for r in out if r["score"] is None] == ["none"]
    with pytest.raises(ValueError):
        network.train_network(days.filter(F.col("others").isNull()), SPEC, "date", 1, SMALL)
