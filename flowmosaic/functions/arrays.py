"""Array expressions: weather one-hots, channel layouts, tensor positions, records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmosaic.schema import WEATHER_CLASSES, GridSpec


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def weather_onehot(code: Column) -> Column:
    """Class code -> 17-wide 0/1 array (null code -> null)."""
    last = len(WEATHER_CLASSES) - 1
    onehot = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda i: (i == code).cast("int"))
    return F.when(code.isNotNull(), onehot)


def weather_code(onehot: Column) -> Column:
    """Position of the first 1; an all-zero or null array gives null."""
    position = F.array_position(onehot, 1)
    return F.when(position > 0, (position - 1).cast("int"))


def weather_name(code: Column) -> Column:
    """Class code -> class name; codes outside the legend give null."""
    names = F.array(*[F.lit(name) for name in WEATHER_CLASSES])
    return F.when(code.between(0, len(WEATHER_CLASSES) - 1), F.element_at(names, code + 1))


def as_int_array(values: Column) -> Column:
    return F.transform(values, lambda x: x.cast("int"))


def others_vector(temperature: Column, windspeed: Column, onehot: Column) -> Column:
    """[temperature, wind speed] ++ weather one-hot, as doubles."""
    head = F.array(temperature.cast("double"), windspeed.cast("double"))
    return F.concat(head, onehot.cast("array<double>"))


def interleave(first: Column, second: Column) -> Column:
    """out[2m] = first[m], out[2m+1] = second[m]."""
    return F.flatten(F.zip_with(first, second, lambda a, b: F.array(a, b)))


def stride_channels(values: Column, stride: int, keep: Sequence[int]) -> Column:
    """Keep positions whose remainder by ``stride`` is in ``keep``."""
    wanted = list(keep)
    return F.filter(values, lambda _, i: (i % stride).isin(wanted))


def flat_position(row: Column, col: Column, channel: Column, spec: GridSpec) -> Column:
    """(row, col, channel) -> position in the flattened day tensor."""
    return (row * spec.cols + col) * spec.channels + channel


def unflatten(position: Column, cols: int, channels: int) -> tuple[Column, Column, Column]:
    """Inverse of :func:`flat_position`: position -> (row, col, channel)."""
    width = cols * channels
    row = F.floor(position / width).cast("int")
    col = F.floor((position % width) / channels).cast("int")
    return row, col, (position % channels).cast("int")


def nest_tensor(flat: Column, spec: GridSpec) -> Column:
    """Flat day tensor -> nested [row][col][channel]."""
    def cells(row: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(spec.cols - 1)),
            lambda col: F.slice(
                flat, (row * spec.cols + col) * spec.channels + 1, F.lit(spec.channels)
            ),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(spec.rows - 1)), cells)


def flatten_tensor(nested: Column) -> Column:
    """Nested [row][col][channel] -> flat array in row-major order."""
    return F.flatten(F.flatten(nested))


def net_tensor(flat: Column) -> Column:
    """Day tensor with in- and outflow channels -> one net channel (in - out) per slot."""
    pairs = F.sequence(F.lit(0), (F.size(flat) / 2).cast("int") - 1)
    return F.transform(pairs, lambda p: F.get(flat, 2 * p) - F.get(flat, 2 * p + 1))


def pool_tensor(flat: Column, spec: GridSpec, size: int) -> Column:
    """Max over size x size cells of every channel; blocks at the rim may be smaller.

    Works on the array, so any day set (raw or augmented) is pooled without a shuffle.
    """
    rows, cols = -(-spec.rows // size), -(-spec.cols // size)

    def pooled(position: Column) -> Column:
        row, col, channel = unflatten(position, cols, spec.channels)
        members = []
        for down in range(size):
            for right in range(size):
                r, c = row * size + down, col * size + right
                inside = (r < spec.rows) & (c < spec.cols)
                members.append(F.when(inside, F.get(flat, flat_position(r, c, channel, spec))))
        return F.array_max(F.array(*members))

    return F.transform(F.sequence(F.lit(0), F.lit(rows * cols * spec.channels - 1)), pooled)


def assemble_record(flow: Column, others: Column, label: Column) -> Column:
    """flow ++ others ++ [label]."""
    return F.concat(flow, others, F.array(label.cast("double")))


def record_features(record: Column) -> Column:
    """Everything but the last element."""
    return F.slice(record, F.lit(1), F.size(record) - 1)


def record_label(record: Column) -> Column:
    return F.element_at(record, -1)


def dot(values: Column, weights: Sequence[float]) -> Column:
    """Dot product with fixed weights; stays on the JVM and inside the row."""
    fixed = F.array(*[F.lit(float(w)) for w in weights])
    return F.aggregate(
        F.zip_with(values, fixed, lambda x, w: x * w), F.lit(0.0), lambda acc, x: acc + x
    )
