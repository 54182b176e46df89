"""Multiplicative jitter that turns every day into several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.arrays import bind, flat_position
from flowmosaic.functions.calendar import date_text
from flowmosaic.functions.keyed import (
    digest_uniform,
    jitter_factor,
    keyed_digest,
    keyed_prefix,
    keyed_uniform,
)
from flowmosaic.schema import AUGMENT_SCHEDULE, GridSpec

Schedule = Sequence[tuple[int, float]]


def with_batches(days: DataFrame, schedule: Schedule = AUGMENT_SCHEDULE) -> DataFrame:
    """One copy of every row per (batch, limit) of the schedule; a narrow step, no join."""
    plan = F.array(
        *[F.struct(F.lit(b).alias("batch"), F.lit(float(x)).alias("limit")) for b, x in schedule]
    )
    return days.select("*", F.inline(plan))


def augment_cells(
    flow: DataFrame, spec: GridSpec, seed: int = 0, schedule: Schedule = AUGMENT_SCHEDULE
) -> DataFrame:
    """Jitter long flow rows; each value draws for itself.

    A cell's in- and outflow take two words of one digest, halving the hashing. The draws equal
    those of :func:`augment_days` for the same tensor position.
    """
    pair = flat_position(F.col("grid_row"), F.col("grid_col"), (F.col("slot") - 1) * 2, spec) / 2
    digest = keyed_digest(
        seed, "flow", date_text(F.col("date")), F.col("batch"), pair.cast("bigint")
    )
    limit = F.col("limit")
    return (
        with_batches(flow, schedule)
        .withColumn("_digest", digest)
        .withColumns(
            {
                "inflow": F.col("inflow") * jitter_factor(digest_uniform(F.col("_digest"), 0), limit),
                "outflow": F.col("outflow") * jitter_factor(digest_uniform(F.col("_digest"), 1), limit),
            }
        )
        .drop("_digest")
    )


def jitter_others(others: Column, date: Column, batch: Column, limit: Column, seed: int,
                  jitter_weather: bool = True) -> Column:
    """Jitter the attribute vector; without ``jitter_weather`` only temperature and wind move."""
    def draw(x: Column, i: Column) -> Column:
        moved = x * jitter_factor(keyed_uniform(seed, "others", date, batch, i), limit)
        return moved if jitter_weather else F.when(i < 2, moved).otherwise(x)

    return F.transform(others, draw)


def jitter_tensor(flow: Column, date: Column, batch: Column, limit: Column, seed: int) -> Column:
    """Jitter a day tensor in place: position 2p and 2p+1 share digest p.

    The part of the key that all positions share is built once per day.
    """
    def jitter_pairs(shared: Column) -> Column:
        def pair(p: Column) -> Column:
            return bind(
                F.md5(F.concat(shared, p.cast("string"))),
                lambda digest: F.array(
                    F.get(flow, 2 * p) * jitter_factor(digest_uniform(digest, 0), limit),
                    F.get(flow, 2 * p + 1) * jitter_factor(digest_uniform(digest, 1), limit),
                ),
            )

        pairs = F.sequence(F.lit(0), (F.size(flow) / 2).cast("int") - 1)
        return F.flatten(F.transform(pairs, pair))

    return bind(keyed_prefix(seed, "flow", date, batch), jitter_pairs)


def augment_days(
    days: DataFrame,
    seed: int = 0,
    schedule: Schedule = AUGMENT_SCHEDULE,
    jitter_weather: bool = True,
) -> DataFrame:
    """Day tensors -> augmented day tensors, label copied, source day kept. No shuffle."""
    date = date_text(F.col("date"))
    batch, limit = F.col("batch"), F.col("limit")
    return with_batches(days, schedule).select(
        F.col("date").alias("source_date"),
        jitter_tensor(F.col("flow"), date, batch, limit, seed).alias("flow"),
        jitter_others(F.col("others"), date, batch, limit, seed, jitter_weather).alias("others"),
        "label",
        "limit",
        "batch",
    )


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Concatenate separately generated batches by column name."""
    first, *rest = batches
    for batch in rest:
        first = first.unionByName(batch)
    return first
