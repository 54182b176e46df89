"""Column functions against hand-worked values."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from flowmosaic.functions import arrays, calendar, keyed, scoring
from flowmosaic.schema import WEATHER_CLASSES, GridSpec


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_weekend_labels(spark):
    days = spark.createDataFrame([(k,) for k in ("20240105", "20240106", "20240107", "20240108")], "k STRING")
    got = days.select("k", calendar.weekend_label(calendar.key_date(F.col("k"))).alias("w")).collect()
    assert [r["w"] for r in sorted(got)] == [0, 1, 1, 0]


def test_slot_key_from_bytes_and_back(spark):
    raw = spark.createDataFrame([(bytearray(b"2016030148"),), (bytearray(b"2016030101"),)], "b BINARY")
    key = calendar.decode_key(F.col("b"))
    got = raw.select(key.alias("k"), calendar.key_date(key).alias("d"), calendar.key_slot(key).alias("s"))
    rows = got.withColumn("again", calendar.encode_key(F.col("d"), F.col("s"))).collect()
    assert {(r["d"].isoformat(), r["s"]) for r in rows} == {("2016-03-01", 48), ("2016-03-01", 1)}
    assert all(r["k"] == r["again"] for r in rows)


def test_label_onehot_roundtrip(spark):
    for label, pair in ((1, [1, 0]), (0, [0, 1])):
        assert one(spark, calendar.label_onehot(F.lit(label))) == pair
        assert one(spark, calendar.label_scalar(calendar.label_onehot(F.lit(label)))) == label
    assert one(spark, calendar.label_onehot(F.lit(None).cast("int"))) is None


def test_weather_codes_survive_the_onehot(spark):
    codes = spark.range(len(WEATHER_CLASSES)).select(F.col("id").cast("int").alias("code"))
    onehot = arrays.weather_onehot(F.col("code"))
    rows = codes.select("code", onehot.alias("h"), arrays.weather_code(onehot).alias("back"),
                        arrays.weather_name(F.col("code")).alias("n")).collect()
    for r in rows:
        assert r["back"] == r["code"] and sum(r["h"]) == 1 and len(r["h"]) == 17
        assert r["n"] == WEATHER_CLASSES[r["code"]]
    assert one(spark, arrays.weather_code(F.array(*[F.lit(0)] * 17))) is None
    assert one(spark, arrays.weather_name(F.lit(17))) is None
    assert one(spark, arrays.weather_onehot(F.lit(None).cast("int"))) is None


def test_interleave_stride_and_record(spark):
    a, b = F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(2.0), F.lit(4.0))
    assert one(spark, arrays.interleave(a, b)) == [1.0, 2.0, 3.0, 4.0]
    nine = F.array(*[F.lit(i) for i in range(9)])
    assert one(spark, arrays.stride_channels(nine, 3, (0, 1))) == [0, 1, 3, 4, 6, 7]
    record = arrays.assemble_record(a, b, F.lit(1))
    assert one(spark, record) == [1.0, 3.0, 2.0, 4.0, 1.0]
    assert one(spark, arrays.record_features(record)) == [1.0, 3.0, 2.0, 4.0]
    assert one(spark, arrays.record_label(record)) == 1.0


@pytest.mark.parametrize("spec", [GridSpec(), GridSpec(3, 5, 60)])
def test_positions_invert(spark, spec):
    ids = spark.range(spec.tensor_size)
    row, col, chan = arrays.unflatten(F.col("id"), spec.cols, spec.channels)
    wrong = ids.filter(arrays.flat_position(row, col, chan, spec) != F.col("id"))
    assert wrong.count() == 0
    assert one(spark, arrays.flat_position(F.lit(2), F.lit(1), F.lit(7), spec)) == (
        (2 * spec.cols + 1) * spec.channels + 7
    )


def test_nest_then_flatten_is_identity(spark):
    spec = GridSpec(2, 3, 720)
    flat = F.array(*[F.lit(float(i)) for i in range(spec.tensor_size)])
    nested = one(spark, arrays.nest_tensor(flat, spec))
    assert nested[1][2] == [float(i) for i in range(20, 24)]
    assert one(spark, arrays.flatten_tensor(arrays.nest_tensor(flat, spec))) == [
        float(i) for i in range(spec.tensor_size)
    ]


def test_scores(spark):
    scores = F.array(F.lit(1000.0), F.lit(1001.0), F.lit(1001.0))
    p = one(spark, scoring.softmax(scores))
    assert math.isclose(sum(p), 1.0) and math.isclose(p[1] / p[0], math.e)
    assert one(spark, scoring.argmax(scores)) == 1
    assert one(spark, scoring.relu_array(F.array(F.lit(-2.0), F.lit(0.5)))) == [0.0, 0.5]
    assert [one(spark, scoring.threshold(F.lit(x))) for x in (0.0, 0.1, -3.0)] == [0.0, 1.0, 0.0]
    assert one(spark, scoring.threshold(F.lit(0.4), 0.5)) == 0.0
    assert math.isclose(one(spark, scoring.guarded_log(F.lit(0.0))), math.log(1e-10))


def test_keyed_uniform_matches_md5_and_ignores_partitioning(spark):
    ids = spark.range(500)
    drawn = ids.withColumn("u", keyed.keyed_uniform(3, "x", F.col("id")))
    got = {r["id"]: r["u"] for r in drawn.collect()}
    moved = {r["id"]: r["u"] for r in ids.repartition(7).withColumn("u", keyed.keyed_uniform(3, "x", F.col("id"))).collect()}
    want = {i: int(hashlib.md5(f"3|x|{i}".encode()).hexdigest()[:8], 16) / 2**32 for i in range(500)}
    assert got == want == moved
    assert 0.45 < sum(got.values()) / 500 < 0.55
    second = one(spark, keyed.digest_uniform(F.md5(F.lit("a")), 1))
    assert second == int(hashlib.md5(b"a").hexdigest()[8:16], 16) / 2**32


def test_slot_keys_of_any_width(spark):
    rows = spark.sql("SELECT DATE'2024-03-01' AS d, explode(sequence(1, 288)) AS s").withColumn("k", calendar.encode_key(F.col("d"), F.col("s"), 288))
    back = rows.withColumn("again", calendar.key_slot(F.col("k"))).collect()
    assert len({r["k"] for r in back}) == 288 and all(r["again"] == r["s"] for r in back)
    assert rows.select(calendar.encode_key(F.col("d"), F.lit(100)).alias("k")).first()["k"] == "20240301100"
