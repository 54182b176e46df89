"""Seeded splits, shuffles, bootstrap batches and named train/test protocols.

Every draw is a hash of the row's key, so a lost executor or a repartition changes nothing. Keys
given to these operators must identify rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmosaic.functions.keyed import keyed_fine_uniform, keyed_uniform
from flowmosaic.operators.augment import augment_days

# Upper bound on the rows of the histogram that gives exact global ranks. One bucket of a 10^12-row
# table then holds about 15 million narrow keys.
RANK_BUCKETS = 65_536


def with_uniform(
    rows: DataFrame, keys: Sequence[str], seed: int, purpose: str, out: str = "u"
) -> DataFrame:
    return rows.withColumn(out, keyed_uniform(seed, purpose, *[F.col(k) for k in keys]))


def _role(is_train: Column) -> Column:
    return F.when(is_train, F.lit("train")).otherwise(F.lit("test"))


def split_fraction(
    rows: DataFrame, keys: Sequence[str], ratio: float = 0.8, seed: int = 0
) -> DataFrame:
    """Adds ``role``: each row goes to train with probability ``ratio``. Narrow, no shuffle."""
    drawn = with_uniform(rows, keys, seed, "split", "_u")
    return drawn.withColumn("role", _role(F.col("_u") < ratio)).drop("_u")


def shuffle_rows(rows: DataFrame, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Rows in keyed random order: a distributed range sort."""
    return with_uniform(rows, keys, seed, "shuffle", "u").orderBy("u", *keys)


def _ranked_buckets(rows: DataFrame, keys: Sequence[str], seed: int, buckets: int):
    """Narrow keys with their hash bucket, and per bucket the number of rows before it.

    The windows over the histogram have no partition key, but see at most ``buckets`` rows.
    """
    keyed = with_uniform(rows.select(*keys), keys, seed, "shuffle", "u").withColumn(
        # Never null; saying so spares the joins a null filter that would hash every key again.
        "_bucket", F.coalesce(F.floor(F.col("u") * buckets).cast("int"), F.lit(0))
    )
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = (
        keyed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_bucket",
            "_rows",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(everything).alias("_total"),
        )
    )
    return keyed, offsets


def dense_index(
    rows: DataFrame, keys: Sequence[str], seed: int = 0, buckets: int = RANK_BUCKETS
) -> DataFrame:
    """(keys, u, idx): exact 0-based position of each key in the shuffled order.

    A histogram of hash buckets gives each bucket's offset; ranks are counted inside the buckets
    in parallel. The broadcast side has at most ``buckets`` rows.
    """
    keyed, offsets = _ranked_buckets(rows, keys, seed, buckets)
    inside = Window.partitionBy("_bucket").orderBy("u", *keys)
    return (
        keyed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets.select("_bucket", "_before")), "_bucket")
        .select(*keys, "u", (F.col("_before") + F.col("_rank") - 1).alias("idx"))
    )


def shuffle_split(
    rows: DataFrame,
    keys: Sequence[str],
    ratio: float = 0.8,
    seed: int = 0,
    buckets: int = RANK_BUCKETS,
) -> DataFrame:
    """Adds ``role``: train is the first floor(n * ratio) rows of the shuffled order, exactly.

    Only the key of the last train row is searched for: the histogram names its bucket, and ranks
    are counted in that bucket alone. The full rows are compared with that key where they are;
    they are never shuffled.
    """
    keyed, offsets = _ranked_buckets(rows, keys, seed, buckets)
    size = F.floor(F.col("_total") * F.lit(float(ratio)))
    cut = offsets.filter(
        (F.col("_before") < size) & (size <= F.col("_before") + F.col("_rows"))
    ).select("_bucket", (size - F.col("_before")).alias("_wanted"))
    inside = Window.partitionBy("_bucket").orderBy("u", *keys)
    last = (
        keyed.join(F.broadcast(cut), "_bucket")
        .withColumn("_rank", F.row_number().over(inside))
        .filter(F.col("_rank") == F.col("_wanted"))
        .select(F.struct("u", *keys).alias("_last"))
    )
    drawn = with_uniform(rows, keys, seed, "shuffle", "_u")
    here = F.struct(F.col("_u").alias("u"), *keys)
    # No such key when floor(n * ratio) is 0: the comparison is null and everything is test.
    return drawn.withColumn("role", _role(here <= last.scalar())).drop("_u")


def bootstrap_batches(
    rows: DataFrame,
    keys: Sequence[str],
    steps: int = 1,
    batch_size: int = 32,
    seed: int = 0,
    buckets: int = RANK_BUCKETS,
) -> DataFrame:
    """(step, draw, row columns): ``batch_size`` draws with replacement for every step.

    Draws join the narrow key index first; only the keys drawn then meet the full rows.
    """
    spark = rows.sparkSession
    total = rows.agg(F.count(F.lit(1))).scalar()
    draws = (
        spark.range(steps * batch_size)
        .select(
            F.floor(F.col("id") / batch_size).cast("int").alias("step"),
            (F.col("id") % batch_size).cast("int").alias("draw"),
        )
        .withColumn("_u", keyed_fine_uniform(seed, "bootstrap", F.col("step"), F.col("draw")))
        .withColumn("idx", F.floor(F.col("_u") * total))
    )
    picks = draws.join(dense_index(rows, keys, seed, buckets), "idx").select(
        "step", "draw", *keys
    )
    return picks.join(rows, list(keys))


def poisson_thresholds(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), .. of a Poisson count, until nothing of 52 bits is left."""
    if not 0 < mean <= 30:
        raise ValueError("the mean number of copies must be above 0 and at most 30")
    term, total, out = math.exp(-mean), 0.0, []
    while total + term < 1 - 2.0**-52 and len(out) < 200:
        total += term
        out.append(total)
        term *= mean / len(out)
    return out


def bootstrap_poisson(rows: DataFrame, keys: Sequence[str], replicate: int | Column = 0, mean: float = 1.0, seed: int = 0) -> DataFrame:
    """``rows`` with ``copies``, how often each is drawn; rows drawn never are left out.

    An approximate bootstrap: each row's count is Poisson on its own, so there are no ranks, no join and no
    shuffle, and the total is n times ``mean`` within a few times its square root.
    """
    number = replicate if isinstance(replicate, Column) else F.lit(replicate)
    u = keyed_fine_uniform(seed, "poisson", number, *[F.col(k) for k in keys])
    drawn = rows.withColumn("_u", u)
    copies = reduce(lambda a, b: a + b, [(F.col("_u") >= F.lit(t)).cast("int") for t in poisson_thresholds(mean)])
    return drawn.withColumn("copies", copies).drop("_u").filter("copies > 0")


# -- protocols over day tensors ------------------------------------------------------------------

EXAMPLE_COLUMNS = ("source_date", "flow", "others", "label", "limit", "batch")


def raw_examples(days: DataFrame) -> DataFrame:
    """Raw days in the layout of augmented ones; batch -1 marks them."""
    return days.select(
        F.col("date").alias("source_date"),
        "flow",
        "others",
        "label",
        F.lit(0.0).alias("limit"),
        F.lit(-1).alias("batch"),
    )


def _as_role(examples: DataFrame, role: str) -> DataFrame:
    present = [c for c in EXAMPLE_COLUMNS if c in examples.columns]
    return examples.select(*present, F.lit(role).alias("role"))


def protocol_aug_raw(days: DataFrame, augmented: DataFrame) -> DataFrame:
    """Train on augmented days, test on the raw days they came from (leaks by design)."""
    return _as_role(augmented, "train").unionByName(_as_role(raw_examples(days), "test"))


def protocol_raw_aug(days: DataFrame, augmented: DataFrame) -> DataFrame:
    """Train on raw days, test on their augmented copies (leaks by design)."""
    return _as_role(raw_examples(days), "train").unionByName(_as_role(augmented, "test"))


def protocol_raw_split(days: DataFrame, ratio: float = 0.8, seed: int = 0) -> DataFrame:
    """Raw days only, exact shuffled prefix split."""
    return shuffle_split(raw_examples(days), ["source_date"], ratio, seed)


def protocol_split_augment(days: DataFrame, ratio: float = 0.8, seed: int = 0) -> DataFrame:
    """Default: split by source day, then augment the train days only."""
    parted = split_fraction(days, ["date"], ratio, seed)
    train = augment_days(parted.filter("role = 'train'"), seed)
    test = raw_examples(parted.filter("role = 'test'"))
    return _as_role(train, "train").unionByName(_as_role(test, "test"))


def leakage_audit(examples: DataFrame) -> DataFrame:
    """One row: train rows, test rows, and test rows whose source day is also trained on.

    Counted per source day with map-side combining instead of joining the two roles.
    """
    is_train = (F.col("role") == "train").cast("int")
    per_day = examples.groupBy("source_date").agg(
        F.sum(is_train).alias("n_train"), F.sum(1 - is_train).alias("n_test")
    )
    return per_day.agg(
        F.coalesce(F.sum("n_train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("n_test"), F.lit(0)).alias("n_test"),
        F.coalesce(
            F.sum(F.when(F.col("n_train") > 0, F.col("n_test")).otherwise(0)), F.lit(0)
        ).alias("n_leaked"),
    )


def split_counts(examples: DataFrame) -> DataFrame:
    return examples.groupBy("role").agg(F.count(F.lit(1)).alias("n_rows"))
