"""Score expressions: activations, class choice, guarded logarithm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmosaic.functions.arrays import bind


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def relu_array(values: Column) -> Column:
    return F.transform(values, relu)


def softmax(values: Column) -> Column:
    """Max-shifted softmax, so large scores cannot overflow."""
    powers = bind(F.array_max(values), lambda top: F.transform(values, lambda x: F.exp(x - top)))

    def normalise(parts: Column) -> Column:
        total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
        return bind(total, lambda t: F.transform(parts, lambda x: x / t))

    return bind(powers, normalise)


def argmax(values: Column) -> Column:
    """Zero-based position of the largest value; the first one wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def threshold(score: Column, cut: float = 0.0) -> Column:
    """1.0 above the cut, else 0.0."""
    return (score.cast("double") > F.lit(float(cut))).cast("double")


def guarded_log(p: Column, epsilon: float = 1e-10) -> Column:
    """log(p + epsilon): finite at p = 0."""
    return F.log(p + F.lit(epsilon))
