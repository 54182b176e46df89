"""Overwriting sinks for day tensors and flow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One full-size day is 98,304 doubles (786 KB). Short files bound what a vectorised reader
# loads per batch without touching session settings.
DAYS_PER_FILE = 64


def write_flow(flow: DataFrame, path: str) -> None:
    """Long flow table, one folder per date so that date filters prune files.

    Rebalancing by date lets the engine write few files per folder, yet split a date that turns
    out heavy and merge light ones.
    """
    (
        flow.hint("rebalance", F.col("date"))
        .sortWithinPartitions("date", "slot", "grid_row", "grid_col")
        .write.partitionBy("date")
        .mode("overwrite")
        .parquet(path)
    )


def write_raw_days(days: DataFrame, path: str) -> None:
    days.select("date", "flow", "others", "label").write.option(
        "maxRecordsPerFile", DAYS_PER_FILE
    ).mode("overwrite").parquet(path)


def write_gen_days(days: DataFrame, path: str) -> None:
    days.select("source_date", "flow", "others", "label", "limit", "batch").write.option(
        "maxRecordsPerFile", DAYS_PER_FILE
    ).partitionBy("batch").mode("overwrite").parquet(path)
