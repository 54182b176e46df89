"""Principal components of vectors too wide for a covariance matrix.

Few rows: the inner products of the rows (rows x rows) are summed over blocks of columns and decomposed
instead of the covariance. Many rows and many columns: subspace iteration, which holds a few vectors of
full width. No matrix of width x width is built anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.operators.features import MAX_COVARIANCE_WIDTH, covariance_matrix, fit_scaler
from flowmosaic.session import shared_dir

#: Columns of one block.
BLOCK = 512
#: Up to so many rows their inner products are decomposed on the driver (32 MB).
MAX_GRAM_ROWS = 2048
#: Data of one task of a subspace iteration; Spark hands a task's rows to Python in one batch.
TASK_BYTES = 32 << 20
#: Full-width vectors of a subspace iteration, sent to every task: beyond this many bytes, ask for fewer components.
MAX_SUBSPACE_BYTES = 512 << 20
EXTRA_DIRECTIONS = 10


@dataclass(frozen=True)
class WideComponents:
    """``loadings``: (i, loadings array) per column; variances of the components and of all columns together."""

    loadings: DataFrame
    variances: list[float]
    total_variance: float

    @property
    def k(self) -> int:
        return len(self.variances)


def column_blocks(points: DataFrame, keys: list[str], features: str, size: int = BLOCK) -> DataFrame:
    """(keys.., _block, part): every vector in slices of ``size`` columns."""
    rows = points.select(*keys, vector_to_array(features).alias("_x"))
    starts = F.sequence(F.lit(0), F.floor((F.size("_x") - 1) / size).cast("int"))
    return rows.select(*keys, "_x", F.explode(starts).alias("_block")).select(
        *keys, "_block", F.slice("_x", F.col("_block") * size + 1, F.lit(size)).alias("part")
    )


def _whole_blocks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block, centred n x columns matrix) from rows sorted by block and row number."""
    held: list[np.ndarray] = []
    for batch in batches:
        parts = batch.column("part")
        for i, block in enumerate(batch.column("_block").to_pylist()):
            held.append(parts[i].values.to_numpy())
            if len(held) == n:
                matrix = np.stack(held)
                held = []
                yield block, matrix - matrix.mean(axis=0)


def _dual(points: DataFrame, key: str, k: int, features: str, n: int) -> WideComponents:
    spark = points.sparkSession
    ids = sorted(row[0] for row in points.select(key).collect())  # at most MAX_GRAM_ROWS
    if len(set(ids)) < n:
        raise ValueError(f"{key} does not tell the rows apart")
    kind = points.schema[key].dataType.simpleString()
    numbers = spark.createDataFrame(list(zip(ids, range(n))), f"{key} {kind}, _row INT")
    dealt = (
        column_blocks(points.join(numbers, key), ["_row"], features)
        .repartition("_block").sortWithinPartitions("_block", "_row")
    )

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for _, z in _whole_blocks(batches, n):
            total += z @ z.T
        i, j = np.triu_indices(n)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "part"])

    sums = dealt.mapInArrow(products, "i INT, j INT, part DOUBLE").groupBy("i", "j").agg(F.sum("part").alias("v"))
    long = sums.toArrow()  # rows x rows / 2
    gram = np.zeros((n, n))
    i, j = long["i"].to_numpy(), long["j"].to_numpy()
    gram[i, j] = gram[j, i] = long["v"].to_numpy()
    values, vectors = np.linalg.eigh(gram)
    values, vectors = np.maximum(values[::-1][:k], 0.0), vectors[:, ::-1][:, :k]
    scale = np.where(values > values[0] * 1e-12, 1 / np.sqrt(np.where(values > 0, values, 1.0)), 0.0)

    def loads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, z in _whole_blocks(batches, n):
            table = (z.T @ vectors) * scale
            at = pa.array(np.arange(len(table)) + block * BLOCK, pa.int32())
            offsets = pa.array(np.arange(len(table) + 1) * k, pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.ListArray.from_arrays(offsets, pa.array(table.ravel()))], names=["i", "loadings"])

    loadings = dealt.mapInArrow(loads, "i INT, loadings ARRAY<DOUBLE>")
    return WideComponents(_signed(loadings, k), [float(v) / (n - 1) for v in values], float(np.trace(gram)) / (n - 1))


def _signed(loadings: DataFrame, k: int) -> DataFrame:
    """Each component's entry of largest size is positive; written, since every use would compute it again."""
    spark = loadings.sparkSession
    path = shared_dir(spark, "loadings")
    loadings.write.parquet(path)
    kept = spark.read.schema(loadings.schema).parquet(path)
    at = [F.col("loadings")[c] for c in range(k)]
    largest = kept.agg(*[F.max(F.struct(F.abs(v).alias("size"), v.alias("v")))["v"].alias(f"c{c}") for c, v in enumerate(at)]).first()
    signs = F.array(*[F.lit(-1.0 if (v or 0.0) < 0 else 1.0) for v in largest])
    return kept.select("i", F.zip_with("loadings", signs, lambda v, s: v * s).alias("loadings"))


def _from_driver(points: DataFrame, vectors: np.ndarray) -> DataFrame:
    rows = pa.table({"i": pa.array(range(len(vectors)), pa.int32()), "loadings": pa.array(vectors.tolist(), pa.list_(pa.float64()))})
    return points.sparkSession.createDataFrame(rows)


def _by_covariance(points: DataFrame, k: int, features: str) -> WideComponents:
    long = covariance_matrix(points, features).toArrow()
    i, j = long["i"].to_numpy(), long["j"].to_numpy()
    matrix = np.zeros((int(j.max()) + 1,) * 2)
    matrix[i, j] = matrix[j, i] = long["cov"].to_numpy()
    values, vectors = np.linalg.eigh(matrix)
    loadings = _signed(_from_driver(points, vectors[:, ::-1][:, :k]), k)
    return WideComponents(loadings, [float(v) for v in values[::-1][:k]], float(np.trace(matrix)))


def _by_subspace(points: DataFrame, k: int, features: str, n: int, width: int, rounds: int, seed: int) -> WideComponents:
    """Covariance times a few directions, over and over; each round is one pass over the rows."""
    spark = points.sparkSession
    directions = min(k + EXTRA_DIRECTIONS, width)
    if width * directions * 8 > MAX_SUBSPACE_BYTES:
        raise ValueError(f"{directions} directions of {width} columns exceed {MAX_SUBSPACE_BYTES} bytes; ask for fewer components")
    stats = points.select(Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("s")).select("s.*").first()
    mean, total = stats["mean"].toArray(), float(stats["variance"].toArray().sum())
    rows = points.select(vector_to_array(features).alias("x")).repartition(max(1, n * width * 8 // TASK_BYTES)).persist()
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, directions)))[0]
    try:
        for _ in range(rounds):
            shared = spark.sparkContext.broadcast((mean, basis))

            def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                centre, q = shared.value
                out = np.zeros_like(q)
                for batch in batches:
                    if batch.num_rows:
                        x = batch.column("x").flatten().to_numpy().reshape(-1, width) - centre
                        out += x.T @ (x @ q)
                for start in range(0, width, BLOCK):
                    yield pa.RecordBatch.from_arrays([pa.array([start], pa.int32()), pa.array([out[start : start + BLOCK].tobytes()])], names=["start", "part"])

            def add(parts: pa.Table) -> pa.Table:
                whole = sum(np.frombuffer(p, np.float64) for p in parts["part"].to_pylist())
                return pa.table({"start": parts["start"].slice(0, 1), "part": pa.array([whole.tobytes()])})

            sums = rows.mapInArrow(multiply, "start INT, part BINARY").groupBy("start").applyInArrow(add, "start INT, part BINARY")
            image = np.concatenate([np.frombuffer(r["part"], np.float64).reshape(-1, directions) for r in sorted(sums.collect(), key=lambda r: r["start"])])
            small = basis.T @ image / (n - 1)
            values, turn = np.linalg.eigh((small + small.T) / 2)
            best, basis = basis @ turn[:, ::-1][:, :k], np.linalg.qr(image)[0]
            shared.destroy()
    finally:
        rows.unpersist()
    return WideComponents(_signed(_from_driver(points, best), k), [float(v) for v in values[::-1][:k]], total)


def fit_wide_pca(
    points: DataFrame, key: str, k: int, features: str = "scaled", rounds: int = 12, seed: int = 0,
    gram_rows: int = MAX_GRAM_ROWS, covariance_width: int = MAX_COVARIANCE_WIDTH,
) -> WideComponents:
    """The ``k`` leading components of the sample covariance of ``features``, at any width.

    ``key`` tells the rows apart. There must be more than ``k`` rows and at least ``k`` columns. Up to
    ``gram_rows`` rows and up to ``covariance_width`` columns are decomposed exactly; beyond both, ``rounds``
    of subspace iteration approach the components (the better, the wider the gap behind the last of them).
    """
    head = points.select(F.count(F.lit(1)).alias("n"), F.max(F.size(vector_to_array(features))).alias("width")).first()
    n, width = head["n"], head["width"]
    if n <= k or not 0 < k <= width:
        raise ValueError(f"{k} components need more rows than {n} or more columns than {width}")
    if n <= gram_rows and n <= width:
        return _dual(points, key, k, features, n)
    if width <= covariance_width:
        return _by_covariance(points, k, features)
    return _by_subspace(points, k, features, n, width, rounds, seed)


def project_wide(points: DataFrame, key: str, fitted: WideComponents, features: str = "scaled", output: str = "components") -> DataFrame:
    """(key, output array): uncentred projections, as the library's. Slices of vectors meet slices of loadings."""
    table = fitted.loadings.groupBy(F.floor(F.col("i") / BLOCK).cast("int").alias("_block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "loadings"))), lambda e: e["loadings"]).alias("_rows")
    )
    pairs = column_blocks(points, [key], features).join(table, "_block")
    product = lambda c: F.aggregate(
        F.zip_with("_rows", "part", lambda row, x: F.get(row, c) * x), F.lit(0.0), lambda total, v: total + v
    )
    parts = pairs.select(key, F.transform(F.sequence(F.lit(0), F.lit(fitted.k - 1)), product).alias("_p"))
    sums = parts.groupBy(key).agg(*[F.sum(F.col("_p")[c]).alias(f"_c{c}") for c in range(fitted.k)])
    return sums.select(key, F.array(*[F.col(f"_c{c}") for c in range(fitted.k)]).alias(output))


def reduce_wide(train: DataFrame, test: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(label, components) of both parts; scaler and components are fitted on the train part only."""
    scaler, spark = fit_scaler(train), train.sparkSession
    parts = []
    for part in (train, test):
        path = shared_dir(spark, "scaled")
        scaled = scaler.transform(part).select("label", "scaled").withColumn("_row", F.monotonically_increasing_id())
        scaled.write.parquet(path)  # the row numbers must stay as they are
        parts.append(spark.read.schema(scaled.schema).parquet(path))
    fitted = fit_wide_pca(parts[0], "_row", k)
    return tuple(
        part.select("_row", "label").join(project_wide(part, "_row", fitted), "_row")
        .select("label", array_to_vector("components").alias("components"))
        for part in parts
    )
