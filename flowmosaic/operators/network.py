"""Training of the convolutional day network: back-propagation in tasks, sums by Spark, Adam.

A step draws days with replacement. Each task runs the drawn days it holds forwards and backwards, one at
a time, and adds their gradients up as whole multiples of 2^-32, so a sum does not depend on its order and
a step gives the same weights however the days are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.operators.features import dense_layer
from flowmosaic.operators.forward import MAX_WEIGHT_BYTES, NetWeights, conv_same, extract_features, pool_2x2
from flowmosaic.operators.splits import bootstrap_batches
from flowmosaic.schema import N_OTHERS, GridSpec

#: Gradients are added as multiples of this.
GRAIN = 2.0**-32
#: Entries of one row in which partial gradients travel.
BLOCK = 4096
#: Classes of the output layer; days of class 1 have label 1.
CLASSES = 2


@dataclass(frozen=True)
class DayNetwork:
    """The feature layers and the output layer on top of them."""

    layers: NetWeights
    out: np.ndarray  # (features, classes)
    out_bias: np.ndarray

    def arrays(self) -> dict[str, np.ndarray]:
        return {f.name: getattr(self.layers, f.name) for f in fields(self.layers)} | {"out": self.out, "out_bias": self.out_bias}

    @staticmethod
    def of(arrays: dict[str, np.ndarray]) -> DayNetwork:
        names = [f.name for f in fields(NetWeights)]
        return DayNetwork(NetWeights(*[arrays[n] for n in names]), arrays["out"], arrays["out_bias"])


@dataclass(frozen=True)
class NetworkSettings:
    filters: tuple[int, int] = (16, 32)
    units: tuple[int, int, int] = (128, 128, 64)  # after the grid, after the others, after both
    rate: float = 1e-4
    batch_size: int = 32
    keep: float = 0.5
    l2: float = 0.0  # times the sum of squared weights / 2, biases left out
    beta: tuple[float, float] = (0.9, 0.999)
    epsilon: float = 1e-8
    seed: int = 0


@dataclass
class TrainingState:
    """Everything a run needs to go on: weights, both moments of Adam, steps taken; and its trace."""

    network: DayNetwork
    first: dict[str, np.ndarray]
    second: dict[str, np.ndarray]
    step: int = 0
    trace: list[tuple[int, float, float]] = field(default_factory=list)  # step, mean loss, accuracy of its batch


def fresh_network(spec: GridSpec, settings: NetworkSettings) -> DayNetwork:
    """Normal weights of deviation 0.1, none beyond two deviations; biases 0.1."""
    draw = np.random.default_rng(settings.seed)
    (f1, f2), (u1, u2, u3) = settings.filters, settings.units
    pooled = -(-spec.rows // 4) * -(-spec.cols // 4)

    def weights(*shape: int) -> np.ndarray:
        values = draw.standard_normal(shape)
        while (far := np.abs(values) > 2).any():
            values[far] = draw.standard_normal(int(far.sum()))
        return 0.1 * values

    layers = NetWeights(
        weights(5, 5, spec.channels, f1), np.full(f1, 0.1), weights(5, 5, f1, f2), np.full(f2, 0.1),
        weights(pooled * f2, u1), np.full(u1, 0.1), weights(N_OTHERS, u2), np.full(u2, 0.1),
        weights(u1 + u2, u3), np.full(u3, 0.1),
    )
    return DayNetwork(layers, weights(u3, CLASSES), np.full(CLASSES, 0.1))


def fresh_state(spec: GridSpec, settings: NetworkSettings) -> TrainingState:
    network = fresh_network(spec, settings)
    zeros = lambda: {k: np.zeros_like(v) for k, v in network.arrays().items()}
    return TrainingState(network, zeros(), zeros())


def _pool_back(grad: np.ndarray, x: np.ndarray, pooled: np.ndarray) -> np.ndarray:
    """Gradient of a 2x2 max pool: to the first largest entry of each block."""
    n, h, w, c = x.shape
    hh, ww = pooled.shape[1:3]
    padded = np.full((n, 2 * hh, 2 * ww, c), -np.inf)
    padded[:, :h, :w] = x
    blocks = padded.reshape(n, hh, 2, ww, 2, c).transpose(0, 1, 3, 5, 2, 4).reshape(n, hh, ww, c, 4)
    out = np.zeros_like(blocks)
    np.put_along_axis(out, blocks.argmax(axis=-1)[..., None], grad[..., None], axis=-1)
    return out.reshape(n, hh, ww, c, 2, 2).transpose(0, 1, 4, 2, 5, 3).reshape(n, 2 * hh, 2 * ww, c)[:, :h, :w]


def _conv_back(x: np.ndarray, kernel: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a zero-padded convolution of odd size: of its kernel and of its input."""
    kh, kw = kernel.shape[:2]
    padded = np.pad(x, ((0, 0), (kh // 2, kh // 2), (kw // 2, kw // 2), (0, 0)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, (kh, kw), axis=(1, 2))
    of_kernel = np.tensordot(windows, grad, axes=([0, 1, 2], [0, 1, 2])).transpose(1, 2, 0, 3)
    return of_kernel, conv_same(grad, kernel[::-1, ::-1].transpose(0, 1, 3, 2))


def day_gradients(
    flow: np.ndarray, others: np.ndarray, label: int, net: DayNetwork, masks: tuple[np.ndarray, ...]
) -> tuple[dict[str, np.ndarray], float, bool]:
    """(gradient of the cross-entropy per weight table, cross-entropy, right or not) of one day.

    ``masks`` multiply the three hidden dense layers: grid, others, joint.
    """
    w = net.layers
    x = flow[None]
    z1 = conv_same(x, w.conv1) + w.conv1_bias
    a1 = np.maximum(z1, 0.0)
    p1 = pool_2x2(a1)
    z2 = conv_same(p1, w.conv2) + w.conv2_bias
    a2 = np.maximum(z2, 0.0)
    p2 = pool_2x2(a2)
    flat = p2.reshape(-1)
    zg, zo = flat @ w.grid + w.grid_bias, others @ w.others + w.others_bias
    both = np.concatenate([np.maximum(zg, 0.0) * masks[0], np.maximum(zo, 0.0) * masks[1]])
    zj = both @ w.joint + w.joint_bias
    hidden = np.maximum(zj, 0.0) * masks[2]
    logits = hidden @ net.out + net.out_bias
    shifted = logits - logits.max()
    chance = np.exp(shifted) / np.exp(shifted).sum()
    loss = float(np.log(np.exp(shifted).sum()) - shifted[label])

    d_logits = chance - np.eye(CLASSES)[label]
    d_joint = (net.out @ d_logits) * masks[2] * (zj > 0)
    d_both = w.joint @ d_joint
    d_grid = d_both[: len(zg)] * masks[0] * (zg > 0)
    d_others = d_both[len(zg) :] * masks[1] * (zo > 0)
    d_z2 = _pool_back((w.grid @ d_grid).reshape(p2.shape), a2, p2) * (z2 > 0)
    d_conv2, d_p1 = _conv_back(p1, w.conv2, d_z2)
    d_z1 = _pool_back(d_p1, a1, p1) * (z1 > 0)
    d_conv1, _ = _conv_back(x, w.conv1, d_z1)
    grads = {
        "conv1": d_conv1, "conv1_bias": d_z1.sum(axis=(0, 1, 2)), "conv2": d_conv2, "conv2_bias": d_z2.sum(axis=(0, 1, 2)),
        "grid": np.outer(flat, d_grid), "grid_bias": d_grid, "others": np.outer(others, d_others), "others_bias": d_others,
        "joint": np.outer(both, d_joint), "joint_bias": d_joint, "out": np.outer(hidden, d_logits), "out_bias": d_logits,
    }
    return grads, loss, bool(logits.argmax() == label)


def dropout_masks(net: DayNetwork, settings: NetworkSettings, step: int, draw: int) -> tuple[np.ndarray, ...]:
    """Zero or 1 / keep per hidden unit, a function of seed, step and draw."""
    dice = np.random.default_rng([settings.seed, step, draw])
    sizes = [len(b) for b in (net.layers.grid_bias, net.layers.others_bias, net.layers.joint_bias)]
    return tuple((dice.random(n) < settings.keep) / settings.keep for n in sizes)


def batch_gradients(
    days: DataFrame, key: str, picks: dict, net: DayNetwork, spec: GridSpec, settings: NetworkSettings, step: int
) -> tuple[np.ndarray, float, float]:
    """(mean gradient as one vector, mean loss, accuracy) over the draws of a step.

    ``picks`` maps a key to the draws that fell on it; at most a batch of days reaches Python.
    """
    shared = days.sparkSession.sparkContext.broadcast((net, picks))
    size = sum(v.size for v in net.arrays().values())
    shape = (spec.rows, spec.cols, spec.channels)

    def gradients(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        network, drawn = shared.value
        total, found = np.zeros(size + 2, np.int64), False
        for batch in batches:
            for name, flow, others, label in zip(batch[key], batch["flow"], batch["others"], batch["label"]):
                for draw in drawn[name]:
                    masks = dropout_masks(network, settings, step, draw)
                    grads, loss, right = day_gradients(np.reshape(flow, shape), np.asarray(others), int(label), network, masks)
                    row = np.concatenate([*[grads[k].ravel() for k in network.arrays()], [loss, float(right)]])
                    total += np.rint(row / GRAIN).astype(np.int64)
                    found = True
        if found:
            starts = range(0, size + 2, BLOCK)
            yield pd.DataFrame({"block": list(starts), "part": [total[s : s + BLOCK].tobytes() for s in starts]})

    def add(parts: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(p, np.int64) for p in parts["part"].to_pylist())
        return pa.table({"block": parts["block"].slice(0, 1), "part": pa.array([whole.tobytes()])})

    chosen = days.filter(F.col(key).isin(list(picks))).select(key, "flow", "others", "label")
    sums = chosen.mapInPandas(gradients, "block INT, part BINARY").groupBy("block").applyInArrow(add, "block INT, part BINARY")
    rows = sorted(sums.collect(), key=lambda r: r["block"])
    shared.destroy()
    whole = np.concatenate([np.frombuffer(r["part"], np.int64) for r in rows]) * GRAIN / sum(map(len, picks.values()))
    return whole[:size], float(whole[-2]), float(whole[-1])


def adam(state: TrainingState, gradient: np.ndarray, s: NetworkSettings) -> TrainingState:
    """One update; the penalty's gradient is added to all weight tables but the biases."""
    t, at = state.step + 1, 0
    arrays, first, second = {}, {}, {}
    for name, value in state.network.arrays().items():
        g = gradient[at : at + value.size].reshape(value.shape) + (0.0 if name.endswith("bias") else s.l2) * value
        at += value.size
        first[name] = s.beta[0] * state.first[name] + (1 - s.beta[0]) * g
        second[name] = s.beta[1] * state.second[name] + (1 - s.beta[1]) * g * g
        rate = s.rate * np.sqrt(1 - s.beta[1] ** t) / (1 - s.beta[0] ** t)
        arrays[name] = value - rate * first[name] / (np.sqrt(second[name]) + s.epsilon)
    return replace(state, network=DayNetwork.of(arrays), first=first, second=second, step=t)


def train_network(
    days: DataFrame, spec: GridSpec, key: str, steps: int, settings: NetworkSettings = NetworkSettings(),
    state: TrainingState | None = None, on_step=None,
) -> TrainingState:
    """``steps`` more steps on (key, flow, others, label), from ``state`` or from fresh weights.

    ``key`` tells the days apart. Days without attributes or label are left out. ``on_step(state)`` is called
    after every step, to save or report. The trace grows by one entry per step.
    """
    state = state or fresh_state(spec, settings)
    if 3 * sum(v.nbytes for v in state.network.arrays().values()) > MAX_WEIGHT_BYTES:
        raise ValueError("the weights exceed the broadcast bound")
    frame = days.filter("others IS NOT NULL AND label IS NOT NULL").select(key, "flow", "others", "label").persist()
    try:
        keys = frame.select(key)
        if keys.isEmpty():
            raise ValueError("there are no days to train on")
        last = state.step + steps
        drawn = bootstrap_batches(keys, [key], last, settings.batch_size, settings.seed).filter(F.col("step") >= state.step)
        by_step: dict[int, dict] = {}
        for row in drawn.collect():  # keys only: steps x batch size
            by_step.setdefault(row["step"], {}).setdefault(row[key], []).append(row["draw"])
        while state.step < last:
            picks = by_step[state.step]
            gradient, loss, right = batch_gradients(frame, key, picks, state.network, spec, settings, state.step)
            penalty = settings.l2 / 2 * sum(float((v * v).sum()) for k, v in state.network.arrays().items() if not k.endswith("bias"))
            after = adam(state, gradient, settings)
            state = replace(after, trace=[*state.trace, (after.step, loss + penalty, right)])
            if on_step:
                on_step(state)
    finally:
        frame.unpersist()
    return state


def trace_table(days: DataFrame, state: TrainingState) -> DataFrame:
    """(step, loss, accuracy) of every step's own batch."""
    return days.sparkSession.createDataFrame(state.trace, "step INT, loss DOUBLE, accuracy DOUBLE")


def predict_days(days: DataFrame, spec: GridSpec, net: DayNetwork, key: str) -> DataFrame:
    """(key, label, score, prediction): the score is the chance of class 1. Unknown attributes: null score."""
    featured = extract_features(days, spec, net.layers, key)
    logits = dense_layer(F.col("features"), net.out.tolist(), net.out_bias.tolist())
    score = 1.0 / (1.0 + F.exp(F.col("_logits")[0] - F.col("_logits")[1]))
    out = featured.withColumn("_logits", logits).withColumn("score", F.when(F.col("features").isNotNull(), score))
    return out.select(key, "label", "score", (F.col("score") > 0.5).cast("double").alias("prediction"))
