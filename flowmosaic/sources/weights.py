"""Network weights and optimiser state as a table, one row per value, saved by training step."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.operators.network import DayNetwork, TrainingState
from flowmosaic.sources.registry import MANIFEST_SCHEMA, retained

VALUES = "slot STRING, layer STRING, shape ARRAY<INT>, position INT, value DOUBLE"
#: What is stored per layer: the weights themselves and Adam's two moments.
SLOTS = ("weights", "first", "second")


class WeightStore:
    """Save, list and restore the training states of one model under one shared folder.

    Rows are (slot, layer, shape, position, value), positions in row-major order. Saving a step again writes a
    new folder, and the newest entry of the manifest counts. A step is in the manifest only once its table
    is complete.
    """

    def __init__(self, spark: SparkSession, base: str, model: str = "network", keep: int = 5):
        self.spark, self.base, self.model, self.keep = spark, base.rstrip("/"), model, keep

    def save(self, state: TrainingState) -> str:
        parts = {"weights": state.network.arrays(), "first": state.first, "second": state.second}
        rows = [
            (slot, layer, list(values.shape), values.ravel().tolist())
            for slot in SLOTS for layer, values in parts[slot].items()
        ]
        wide = self.spark.createDataFrame(rows, "slot STRING, layer STRING, shape ARRAY<INT>, v ARRAY<DOUBLE>")
        # names of one step sort by the time they were saved
        taken = self._manifest().filter(F.col("step") == state.step).count()
        path = f"{self.base}/{self.model}-{state.step}-{taken:06d}"
        wide.select("slot", "layer", "shape", F.posexplode("v").alias("position", "value")).write.mode("overwrite").parquet(path)
        trace = self.spark.createDataFrame(state.trace, "step INT, loss DOUBLE, accuracy DOUBLE")
        trace.coalesce(1).write.mode("overwrite").parquet(f"{path}-trace")
        row = self.spark.createDataFrame([(self.model, state.step, path)], MANIFEST_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(f"{self.base}/weights_manifest")
        return path

    def _manifest(self) -> DataFrame:
        empty = self.spark.createDataFrame([], MANIFEST_SCHEMA)
        try:
            saved = self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.base}/weights_manifest")
        except Exception as missing:  # nothing was saved yet
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return empty
        return saved.filter(F.col("model") == self.model)

    def checkpoints(self) -> DataFrame:
        return retained(self._manifest(), self.keep)

    def choose(self, step: int | str = "latest") -> tuple[int, str]:
        """(step, path) of a retained state: a step number, ``latest`` or ``oldest``."""
        kept = self.checkpoints()
        if step == "latest":
            kept = kept.orderBy(F.col("step").desc())
        elif step == "oldest":
            kept = kept.orderBy("step")
        else:
            kept = kept.filter(F.col("step") == int(step))
        row = kept.select("step", "path").first()
        if row is None:
            raise LookupError(f"no retained weights for step {step!r}")
        return row["step"], row["path"]

    def table(self, step: int | str = "latest") -> DataFrame:
        """The stored values, long."""
        return self.spark.read.schema(VALUES).parquet(self.choose(step)[1])

    def restore(self, step: int | str = "latest", like: DayNetwork | None = None) -> TrainingState:
        """The state as it was saved. Missing or repeated positions and, with ``like``, other shapes raise ValueError."""
        at, path = self.choose(step)
        values = self.spark.read.schema(VALUES).parquet(path)
        packed = values.groupBy("slot", "layer", "shape").agg(F.sort_array(F.collect_list(F.struct("position", "value"))).alias("v"))
        slots: dict[str, dict[str, np.ndarray]] = {slot: {} for slot in SLOTS}
        for row in packed.select("slot", "layer", "shape", "v.position", "v.value").collect():
            if row["position"] != list(range(math.prod(row["shape"]))) or row["layer"] in slots[row["slot"]]:
                raise ValueError(f"step {at}: values of {row['slot']} {row['layer']} are missing or repeated")
            slots[row["slot"]][row["layer"]] = np.array(row["value"]).reshape(row["shape"])
        try:
            network = DayNetwork.of(slots["weights"])
        except KeyError as missing:
            raise ValueError(f"step {at} lacks layer {missing}") from missing
        for name, expected in like.arrays().items() if like else ():
            if slots["weights"][name].shape != expected.shape:
                raise ValueError(f"step {at}: {name} has shape {slots['weights'][name].shape}, not {expected.shape}")
        trace = self.spark.read.parquet(f"{path}-trace").orderBy("step").collect()
        return TrainingState(network, slots["first"], slots["second"], at, [tuple(r) for r in trace])
