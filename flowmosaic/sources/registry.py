"""Saved models by training step: an append-only manifest next to the model folders."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "model STRING, step BIGINT, path STRING"
SALTS = 256


def retained(manifest: DataFrame, keep: int = 5) -> DataFrame:
    """Newest ``keep`` steps of each model, with the latest one flagged.

    A model and step saved twice counts once. First every input partition drops what cannot be
    among the newest (a rank limit Spark applies before the shuffle); the partition number serves
    as salt, so that neither a hot model nor a hot step meets in one task. It only thins out the
    candidates: the result does not depend on it.
    """
    by_part = Window.partitionBy("model", "_part").orderBy(F.col("step").desc())
    newest_first = Window.partitionBy("model").orderBy(F.col("step").desc())
    candidates = (
        manifest.withColumn("_part", F.spark_partition_id() % SALTS)
        .withColumn("_rank", F.dense_rank().over(by_part))
        .filter(F.col("_rank") <= keep)
    )
    return (
        candidates.groupBy("model", "step")
        .agg(F.max("path").alias("path"))
        .withColumn("newest", F.row_number().over(newest_first))
        .filter(F.col("newest") <= keep)
        .withColumn("is_latest", (F.col("newest") == 1).cast("int"))
    )


class ModelRegistry:
    """Save, list, choose and restore fitted models under one shared folder."""

    def __init__(self, spark: SparkSession, base: str, model: str = "model", keep: int = 5):
        self.spark = spark
        self.base = base.rstrip("/")
        self.model = model
        self.keep = keep

    @property
    def _manifest_path(self) -> str:
        return f"{self.base}/manifest"

    def save(self, fitted: PipelineModel, step: int) -> str:
        path = f"{self.base}/{self.model}-{step}"
        fitted.write().overwrite().save(path)
        row = self.spark.createDataFrame([(self.model, step, path)], MANIFEST_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self._manifest_path)
        return path

    def checkpoints(self) -> DataFrame:
        saved = self.spark.read.schema(MANIFEST_SCHEMA).parquet(self._manifest_path)
        return retained(saved.filter(F.col("model") == self.model), self.keep)

    def choose(self, step: int | str = "latest") -> str:
        """Path of a retained checkpoint: a step number, ``latest`` or ``oldest``."""
        kept = self.checkpoints()
        if step == "latest":
            kept = kept.orderBy(F.col("step").desc())
        elif step == "oldest":
            kept = kept.orderBy("step")
        else:
            kept = kept.filter(F.col("step") == int(step))
        row = kept.select("path").first()
        if row is None:
            raise LookupError(f"no retained checkpoint for step {step!r}")
        return row["path"]

    def restore(self, step: int | str = "latest") -> PipelineModel:
        return PipelineModel.load(self.choose(step))
