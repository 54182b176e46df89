"""Batch forward pass of the day network up to its last hidden layer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from flowmosaic.schema import GridSpec

# Network weights are broadcast to every executor; this bounds them.
MAX_WEIGHT_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class NetWeights:
    """Weights of conv-pool-conv-pool-dense on the grid, dense on the others, dense on both."""

    conv1: np.ndarray  # (kh, kw, channels, filters1)
    conv1_bias: np.ndarray
    conv2: np.ndarray  # (kh, kw, filters1, filters2)
    conv2_bias: np.ndarray
    grid: np.ndarray  # (pooled rows * pooled cols * filters2, units)
    grid_bias: np.ndarray
    others: np.ndarray  # (attributes, units)
    others_bias: np.ndarray
    joint: np.ndarray  # (both units, features)
    joint_bias: np.ndarray

    @property
    def nbytes(self) -> int:
        return sum(getattr(self, f.name).nbytes for f in fields(self))


def conv_same(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """(n, h, w, c) cross-correlated with (kh, kw, c, f), stride 1, zero padding."""
    kh, kw = kernel.shape[:2]
    top, left = (kh - 1) // 2, (kw - 1) // 2
    padded = np.pad(x, ((0, 0), (top, kh - 1 - top), (left, kw - 1 - left), (0, 0)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, (kh, kw), axis=(1, 2))
    return np.tensordot(windows, kernel, axes=([4, 5, 3], [0, 1, 2]))


def pool_2x2(x: np.ndarray) -> np.ndarray:
    """Max over 2x2 blocks; an odd last row or column forms a smaller block."""
    n, h, w, c = x.shape
    padded = np.pad(x, ((0, 0), (0, h % 2), (0, w % 2), (0, 0)), constant_values=-np.inf)
    return padded.reshape(n, (h + 1) // 2, 2, (w + 1) // 2, 2, c).max(axis=(2, 4))


def forward_features(flow: np.ndarray, others: np.ndarray, w: NetWeights) -> np.ndarray:
    """(n, h, w, c) and (n, attributes) -> (n, features)."""
    def relu(x: np.ndarray) -> np.ndarray:
        return np.maximum(x, 0.0)

    x = pool_2x2(relu(conv_same(flow, w.conv1) + w.conv1_bias))
    x = pool_2x2(relu(conv_same(x, w.conv2) + w.conv2_bias))
    from_grid = relu(x.reshape(len(x), -1) @ w.grid + w.grid_bias)
    from_others = relu(others @ w.others + w.others_bias)
    return relu(np.concatenate([from_grid, from_others], axis=1) @ w.joint + w.joint_bias)


def extract_features(
    days: DataFrame, spec: GridSpec, weights: NetWeights, key: str = "date", chunk: int = 32
) -> DataFrame:
    """(key, label, features): days scored in small chunks inside each task.

    Scoring is row-local, so there is no shuffle. Days whose attributes are unknown cannot be
    scored and come back with null features.
    """
    if weights.nbytes > MAX_WEIGHT_BYTES:
        raise ValueError(f"{weights.nbytes} bytes of weights exceed the broadcast bound")
    shared = days.sparkSession.sparkContext.broadcast(weights)
    shape = (spec.rows, spec.cols, spec.channels)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), chunk):
                part = batch.iloc[start : start + chunk]
                known = part["others"].notna().to_numpy()
                out = pd.Series([None] * len(part), dtype=object)
                if known.any():
                    usable = part[known]
                    flow = np.stack(usable["flow"].to_numpy()).reshape(-1, *shape)
                    features = forward_features(flow, np.stack(usable["others"].to_numpy()), shared.value)
                    for i, row in zip(np.flatnonzero(known), features):
                        out.iat[i] = row
                yield pd.DataFrame(
                    {key: part[key].to_numpy(), "label": part["label"].to_numpy(), "features": out}
                )

    key_type = days.schema[key].dataType.simpleString()
    return days.select(key, "flow", "others", "label").mapInPandas(
        score, f"{key} {key_type}, label INT, features ARRAY<DOUBLE>"
    )
