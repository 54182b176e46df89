"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "flowmosaic",
    *,
    master: str | None = None,
    driver_memory: str = "8g",
    executor_memory: str = "8g",
    shuffle_partitions: int | None = None,
) -> SparkSession:
    """Start (or join) a session with the run sizing of the original batch jobs.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the first comes from
    spark-submit, the second should start high and let AQE coalesce.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.executor.memory", executor_memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder: on a cluster the executors would
    each write to their own disk.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="flowmosaic-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
