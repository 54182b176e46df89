"""Dense tensor files, pairing by position, Poisson bootstrap, feature selection, sparse days."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from flowmosaic.operators import align, select, splits
from flowmosaic.schema import GridSpec
from flowmosaic.sources import tensors

SPEC = GridSpec(2, 3, 30)


@pytest.fixture
def flow(flow_rows):
    rows = [("20240101", s, r, c, s + r / 10, -float(c)) for s in range(1, 49) for r in range(2) for c in range(3) if (s + r + c) % 4]
    rows += [("20240102", 48, 1, 2, None, 5.0), ("20240102", 1, 0, 0, 0.0, 0.0), ("20240102", 1, 7, 0, 1.0, 1.0)]
    return flow_rows(rows)


def cells(frame):
    return sorted((str(r["date"]), r["slot"], r["grid_row"], r["grid_col"], str(r["inflow"]), str(r["outflow"])) for r in frame.collect())


def test_flow_survives_dense_files(spark, flow, tmp_path):
    path = str(tmp_path / "cube")
    tensors.write_tensor_files(flow.withColumn("outflow", F.lit(9.0)), path, SPEC)
    tensors.write_tensor_files(flow, path, SPEC)
    assert cells(tensors.scan_tensor_files(spark, path, SPEC)) == cells(flow.filter("grid_row < 2"))
    tensors.write_tensor_files(flow.filter("slot = 1"), path, SPEC, mode="append")
    assert tensors.scan_tensor_files(spark, path, SPEC).count() == flow.filter("grid_row < 2").count() + flow.filter("slot = 1 AND grid_row < 2").count()
    names = sorted(os.listdir(path))
    assert all(n.endswith(".npy") for n in names) and np.load(f"{path}/{[n for n in names if 'keys' not in n][0]}").shape[1] == 12


def test_only_the_rows_asked_for_are_read(tmp_path):
    values = np.arange(60.0).reshape(10, 6)
    np.save(tmp_path / "a.npy", values)
    np.save(tmp_path / "a.keys.npy", np.array([f"20240101{i:02d}" for i in range(10)], "S"))
    store, base = tensors.open_store(f"file:{tmp_path}")
    assert np.array_equal(tensors.read_rows(store, f"{base}/a.npy", 3, 5), values[3:5])
    reader = tensors.TensorReader(str(tmp_path))
    assert [(p.start, p.stop) for p in reader.partitions()] == [(0, 10)]
    batches = list(reader.read(tensors.SlotRange(f"{base}/a.npy", 8, 10)))
    assert batches[0].column("slot_key").to_pylist() == ["2024010108", "2024010109"] and batches[0].num_rows == 2
    np.save(tmp_path / "a.npy", np.asfortranarray(values))
    with pytest.raises(ValueError):
        tensors.read_rows(store, f"{base}/a.npy", 0, 1)


def test_a_failed_task_leaves_no_file(spark, flow, tmp_path):
    path = str(tmp_path / "cube")
    twice = flow.unionByName(flow.filter("slot = 5"))  # a cell that comes twice fails in its task
    with pytest.raises(Exception):
        tensors.write_tensor_files(twice, path, SPEC)
    assert not os.path.exists(path) or os.listdir(path) == []
    tensors.write_tensor_files(flow, path, SPEC)
    with pytest.raises(Exception):
        tensors.write_tensor_files(twice, path, SPEC)
    assert cells(tensors.scan_tensor_files(spark, path, SPEC)) == cells(flow.filter("grid_row < 2"))


def test_positions_run_over_files(spark, tmp_path):
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    spark.range(0, 100, 1, 7).write.parquet(left)
    spark.range(0, 93, 1, 3).select((F.col("id") * 2).alias("twice")).write.parquet(right)
    zipped = align.zip_by_position(align.with_position(spark, left, "id"), align.with_position(spark, right, "twice"))
    rows = {r["position"]: r for r in zipped.collect()}
    assert len(rows) == 100 and all(r["id"] == p and r["twice"] == (2 * p if p < 93 else None) and r["paired"] == (p < 93) for p, r in rows.items())
    assert tuple(align.zip_lengths(zipped).first()) == (93, 7)


def test_poisson_copies(spark):
    rows = spark.range(20_000).withColumn("copies", F.lit("a column of this name is replaced"))
    one = splits.bootstrap_poisson(rows, ["id"], 3, 1.0, 5)
    counts = {r["copies"]: r["n"] for r in one.groupBy("copies").agg(F.count("*").alias("n")).collect()}
    total = sum(k * n for k, n in counts.items())
    assert abs(total - 20_000) < 5 * 20_000**0.5 and abs(counts[1] - 20_000 * np.exp(-1)) < 5 * 20_000**0.5
    assert sorted(one.collect()) == sorted(splits.bootstrap_poisson(rows.repartition(5), ["id"], 3, 1.0, 5).collect())
    for mean in (0.0, -1.0, 31.0):
        with pytest.raises(ValueError):
            splits.poisson_thresholds(mean)


def test_chi_square_is_the_librarys(spark):
    rng = np.random.default_rng(0)
    rows = [(int(y), [float(rng.integers(0, 3)), float(y * rng.integers(1, 3)), 1.0]) for y in rng.integers(0, 2, 300)]
    frame = spark.createDataFrame(rows, "label INT, x ARRAY<DOUBLE>")
    points = frame.select(F.col("label").cast("double").alias("label"), array_to_vector("x").alias("v"))
    expected = ChiSquareTest.test(points, "v", "label", flatten=True).orderBy("featureIndex").collect()
    odd = frame.unionByName(spark.createDataFrame([(None, [5.0, 5.0, 5.0]), (1, [None, None, None])], frame.schema))
    got = select.chi_square(odd, "x", "label").orderBy("i").collect()
    for e, g in zip(expected, got, strict=True):
        assert g["statistic"] == pytest.approx(e["statistic"], abs=1e-9) and g["degrees"] == e["degreesOfFreedom"] and g["n"] == 300
    top = select.chi_square_top(frame, "x", "label", 2).collect()
    assert [r["i"] for r in sorted(top, key=lambda r: r["rank"])] == sorted(range(3), key=lambda i: (-got[i]["statistic"], i))[:2]
    assert frame.select(select.keep_features(F.col("x"), [2, 0]).alias("k")).first()["k"] == [1.0, rows[0][1][0]]


@pytest.mark.parametrize("p", [1.0, 2.0, 3.0, float("inf")])
def test_normalized_rows(spark, p):
    frame = spark.createDataFrame([([3.0, -4.0, 0.5],), ([0.0, 0.0, 0.0],)], "x ARRAY<DOUBLE>")
    got = [r[0] for r in frame.select(select.normalized(F.col("x"), p)).collect()]
    x = np.array([3.0, -4.0, 0.5])
    assert np.allclose(got[0], x / np.linalg.norm(x, p)) and got[1] == [0.0, 0.0, 0.0]


def test_sparse_scores_are_the_dense_ones(spark):
    rng = np.random.default_rng(7)
    x = np.where(rng.random((30, 12)) < 0.2, rng.standard_normal((30, 12)), 0.0)
    x[:, 3], x[:, 4], x[9] = 0.0, 0.1, 0.0
    x[9, 4] = 0.1
    w = rng.standard_normal(12)
    std = x.std(axis=0, ddof=1)
    z = np.divide(x - x.mean(axis=0), std, out=np.zeros_like(x), where=std > 1e-12)
    cells = spark.createDataFrame([(int(r), int(i), float(x[r, i])) for r, i in zip(*np.nonzero(x))], "row INT, i INT, x DOUBLE")
    weights = spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "i INT, w DOUBLE")
    rows = spark.createDataFrame([(i,) for i in range(30)], "row INT")
    got = {r["row"]: r for r in select.sparse_scores(rows, cells, "row", select.sparse_stats(cells, 30), weights).collect()}
    assert np.allclose([got[i]["score"] for i in range(30)], z @ w, atol=1e-9)
    assert [got[i]["n_filled"] for i in range(30)] == np.count_nonzero(x, axis=1).tolist()


def test_a_task_that_outlives_its_run_leaves_no_file(tmp_path):
    path = str(tmp_path / "cube")
    writer = tensors.TensorWriter(path, True)
    writer.abort([])
    late = pa.RecordBatch.from_pydict({"slot_key": ["2024010100"], "cube": [[1.0, 2.0]]})
    with pytest.raises(FileNotFoundError):
        writer.write(iter([late]))
    assert not os.path.exists(path) or os.listdir(path) == []
