"""How the driver's tables stand in for flow, weather, vectors and predictions (see FIXTURES.md)."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.operators.forward import NetWeights
from flowmosaic.plans.days import raw_days
from flowmosaic.schema import N_OTHERS, GridSpec

SPEC = GridSpec(4, 4, 30)
SEED = 7
INFLOW_TYPES = ("click", "view", "signup")
OUTFLOW_TYPES = ("purchase", "error")
WIDTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slot_of(spec: GridSpec) -> Column:
    minute = F.hour("ts") * 60 + F.minute("ts")
    return (F.floor(minute / spec.slot_minutes) + 1).cast("int")


def event_cells(spark: SparkSession, sf_dir: str, spec: GridSpec = SPEC) -> DataFrame:
    """Every event as one (date, slot, cell) observation, not yet summed."""
    cell = F.col("user_id") % spec.cells
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"),
        slot_of(spec).alias("slot"),
        F.floor(cell / spec.cols).cast("int").alias("grid_row"),
        (cell % spec.cols).cast("int").alias("grid_col"),
        F.when(F.col("event_type").isin(*INFLOW_TYPES), F.col("value")).otherwise(0.0).alias("inflow"),
        F.when(F.col("event_type").isin(*OUTFLOW_TYPES), F.col("value")).otherwise(0.0).alias("outflow"),
    )


def event_flow(spark: SparkSession, sf_dir: str, spec: GridSpec = SPEC) -> DataFrame:
    """Flow cube: one row per (date, slot, cell); partial sums before the shuffle."""
    return (
        event_cells(spark, sf_dir, spec)
        .groupBy("date", "slot", "grid_row", "grid_col")
        .agg(F.sum("inflow").alias("inflow"), F.sum("outflow").alias("outflow"))
    )


def event_weather(spark: SparkSession, sf_dir: str, spec: GridSpec = SPEC) -> DataFrame:
    """Weather readings for the slots in which something was purchased; the others have none."""
    day = F.dayofmonth("date")
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'purchase'")
        .select(F.to_date("ts").alias("date"), slot_of(spec).alias("slot"))
        .distinct()
        .select(
            "date",
            "slot",
            ((day * 7 + F.col("slot") * 3) % 400 - 100).cast("double").alias("temperature"),
            ((day * 5 + F.col("slot")) % 120).cast("double").alias("windspeed"),
            ((day * 48 + F.col("slot")) % 17).cast("int").alias("weather_code"),
        )
    )


def event_days(spark: SparkSession, sf_dir: str, spec: GridSpec = SPEC, missing: str = "next") -> DataFrame:
    return raw_days(
        event_flow(spark, sf_dir, spec), event_weather(spark, sf_dir, spec), spec,
        missing=missing, unique=True,
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label 0/1, features array<double>)."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        (F.col("label") >= 5).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector("features").alias("features"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, score, prediction, label): long documents are predicted to be good."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("score"),
        (F.col("n_chars") > 1000).cast("double").alias("prediction"),
        F.col("quality").cast("double").alias("label"),
    )


def weight(i: int, j: int) -> float:
    """Arithmetic weights shared with the SQL side."""
    return ((i * 7 + j * 13) % 11 - 5) / 10


def weight_column(j: int, width: int = WIDTH) -> list[float]:
    return [weight(i, j) for i in range(width)]


def kernel() -> list[list[float]]:
    """5x5 stencil kernel."""
    return [[((a * 5 + b) % 7 - 3) / 10 for b in range(5)] for a in range(5)]


def net_weights(spec: GridSpec = SPEC) -> NetWeights:
    """Arithmetic weights in the network's shape, divided by the number of inputs."""
    def layer(*shape: int) -> np.ndarray:
        fan_in, units = int(np.prod(shape[:-1])), shape[-1]
        i, j = np.indices((fan_in, units))
        return (((i * 7 + j * 13) % 11 - 5) / np.sqrt(fan_in)).reshape(shape)

    pooled = -(-spec.rows // 4) * -(-spec.cols // 4)
    return NetWeights(
        layer(5, 5, spec.channels, 16), np.full(16, 0.1),
        layer(5, 5, 16, 32), np.full(32, 0.1),
        layer(pooled * 32, 128), np.full(128, 0.1),
        layer(N_OTHERS, 128), np.full(128, 0.1),
        layer(256, 64), np.full(64, 0.1),
    )
