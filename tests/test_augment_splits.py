"""Augmentation bounds, reproducible splits, exact ranks, protocols, skew."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from flowmosaic.operators import augment, splits
from flowmosaic.schema import AUGMENT_SCHEDULE, GridSpec

SPEC = GridSpec(2, 2, 720)


@pytest.fixture
def days(spark):
    rows = [
        (f"2024-01-{d:02d}", [float(d + i) if i % 3 else 0.0 for i in range(SPEC.tensor_size)],
         [1.5 * d, 2.0] + [1.0] + [0.0] * 16, d % 2)
        for d in range(1, 21)
    ]
    return spark.createDataFrame(rows, "d STRING, flow ARRAY<DOUBLE>, others ARRAY<DOUBLE>, label INT").select(
        F.col("d").cast("date").alias("date"), "flow", "others", "label"
    )


def test_augmentation_multiplies_days_within_limits(days):
    source = {r["date"]: r for r in days.collect()}
    made = augment.augment_days(days, seed=5).collect()
    assert len(made) == 5 * len(source)
    limits = dict(AUGMENT_SCHEDULE)
    factors = []
    for r in made:
        raw = source[r["source_date"]]
        assert r["label"] == raw["label"] and r["limit"] == limits[r["batch"]]
        for before, after in zip(raw["flow"] + raw["others"], r["flow"] + r["others"]):
            if before == 0.0:
                assert after == 0.0
            else:
                factors.append((after / before - 1) * 100 / r["limit"])
    assert max(map(abs, factors)) <= 1.0 + 1e-9
    assert len(set(factors)) > 0.99 * len(factors)  # values draw for themselves
    assert abs(sum(factors) / len(factors)) < 0.05


def test_weather_can_be_left_alone(days):
    made = augment.augment_days(days, jitter_weather=False).collect()
    assert all(r["others"][2] == 1.0 for r in made)
    assert any(r["others"][0] != 1.5 for r in made)


def test_long_and_tensor_jitter_agree(spark, days):
    """A cell gets the same draw whichever form of the data is jittered."""
    from flowmosaic.functions.arrays import unflatten
    from flowmosaic.operators.grid import day_tensor

    long = days.select("date", F.posexplode("flow").alias("pos", "v"))
    row, col, chan = unflatten(F.col("pos"), SPEC.cols, SPEC.channels)
    cells = long.select("date", (F.floor(chan / 2) + 1).cast("int").alias("slot"), row.alias("grid_row"), col.alias("grid_col"),
                        (chan % 2).alias("ch"), "v")
    flow = cells.groupBy("date", "slot", "grid_row", "grid_col").agg(
        F.sum(F.when(F.col("ch") == 0, F.col("v"))).alias("inflow"),
        F.sum(F.when(F.col("ch") == 1, F.col("v"))).alias("outflow"),
    )
    jittered = augment.augment_cells(flow, SPEC, seed=5, schedule=[(3, 10.0)])
    from_cells = {r["date"]: r["flow"] for r in day_tensor(jittered, SPEC, unique=True).collect()}
    from_days = {r["source_date"]: r["flow"] for r in augment.augment_days(days, 5, [(3, 10.0)]).collect()}
    assert from_cells.keys() == from_days.keys()
    for date, flow_values in from_cells.items():
        assert flow_values == pytest.approx(from_days[date], abs=1e-12)


def test_union_of_batches_equals_schedule(days):
    def keyed(frame):
        return {(r["source_date"], r["batch"]): (r["flow"], r["others"]) for r in frame.collect()}

    whole = keyed(augment.augment_days(days))
    parts = keyed(augment.union_batches([augment.augment_days(days, schedule=[s]) for s in AUGMENT_SCHEDULE]))
    assert whole == parts


@pytest.mark.parametrize("n,ratio,train", [(138, 0.8, 110), (10, 0.05, 0), (7, 1.0, 7), (1, 0.8, 0), (5, 0.99, 4)])
def test_prefix_split_is_exact(spark, n, ratio, train):
    got = splits.shuffle_split(spark.range(n), ["id"], ratio, seed=1, buckets=16)
    counts = {r["role"]: r["n_rows"] for r in splits.split_counts(got).collect()}
    assert counts.get("train", 0) == train and counts.get("test", 0) == n - train


def brute_order(n, seed):
    def u(i):
        return int(hashlib.md5(f"{seed}|shuffle|{i}".encode()).hexdigest()[:8], 16)

    return sorted(range(n), key=lambda i: (u(i), i))


@pytest.mark.parametrize("buckets", [1, 3, 64, 65_536])
def test_dense_index_equals_a_global_sort(spark, buckets):
    n = 2_000
    got = {r["id"]: r["idx"] for r in splits.dense_index(spark.range(n).repartition(5), ["id"], 9, buckets).collect()}
    assert got == {key: place for place, key in enumerate(brute_order(n, 9))}


def test_shuffle_order_and_split_agree(spark):
    n = 500
    order = [r["id"] for r in splits.shuffle_rows(spark.range(n), ["id"], 9).collect()]
    assert order == brute_order(n, 9)
    train = {r["id"] for r in splits.shuffle_split(spark.range(n), ["id"], 0.8, 9).filter("role = 'train'").collect()}
    assert train == set(order[:400])


def test_splits_do_not_depend_on_partitioning(spark):
    a = splits.split_fraction(spark.range(1000), ["id"]).collect()
    b = splits.split_fraction(spark.range(1000).repartition(13), ["id"]).collect()
    assert sorted(a) == sorted(b)
    share = sum(r["role"] == "train" for r in a) / 1000
    assert 0.75 < share < 0.85


def test_split_never_shuffles_the_rows(spark, tmp_path):
    spark.range(100).withColumn("payload", F.lit("x")).write.parquet(str(tmp_path / "t"))
    wide = spark.read.parquet(str(tmp_path / "t"))
    plan = splits.split_fraction(wide, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    plan = splits.shuffle_split(wide, ["id"])._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    scans = [line for line in plan.splitlines() if "FileScan" in line and "payload" in line]
    assert moved and len(scans) == 1 and not any("payload" in line for line in moved)


def test_bootstrap_draws(spark):
    rows = spark.range(50).withColumn("v", F.col("id") * 2)
    got = splits.bootstrap_batches(rows, ["id"], steps=20, batch_size=32, seed=4).collect()
    assert len(got) == 640 and {r["step"] for r in got} == set(range(20))
    assert all(r["v"] == 2 * r["id"] for r in got)
    order = brute_order(50, 4)
    for r in got[:50]:
        u = int(hashlib.md5(f"4|bootstrap|{r['step']}|{r['draw']}".encode()).hexdigest()[:8], 16) / 2**32
        assert order[math.floor(u * 50)] == r["id"]


def audit(frame):
    return tuple(splits.leakage_audit(frame).select("n_train", "n_test", "n_leaked").first())


def test_protocols_and_their_leaks(days):
    made = augment.augment_days(days)
    assert audit(splits.protocol_aug_raw(days, made)) == (100, 20, 20)
    assert audit(splits.protocol_raw_aug(days, made)) == (20, 100, 100)
    assert audit(splits.protocol_raw_split(days)) == (16, 4, 0)
    safe = splits.protocol_split_augment(days)
    train, test, leaked = audit(safe)
    assert leaked == 0 and train % 5 == 0 and train // 5 + test == 20 and test > 0


def test_leak_audit_of_nothing(days):
    assert audit(splits.protocol_raw_split(days.filter("false"))) == (0, 0, 0)


def test_hot_source_day(days):
    """A third of all rows under one source day: counted by map-side sums, not by pairing rows."""
    base = splits.raw_examples(days).select("source_date", F.lit("test").alias("role"))
    hot = base.filter("source_date = '2024-01-07'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(30_000)))).drop("n")
    trained = base.filter("source_date = '2024-01-07'").withColumn("role", F.lit("train"))
    assert audit(base.unionByName(hot).unionByName(trained)) == (1, 30_020, 30_001)
