"""Key-based joins where positions were matched before, and pairing by position where only files are given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def align_weather(flow: DataFrame, weather: DataFrame) -> DataFrame:
    """Left equi-join on (date, slot); ``has_weather`` tells hits from misses.

    Of several readings for one slot the smallest in column order counts, so flow rows never multiply.
    No broadcast hint: the weather table grows with time, so the planner decides by its size.
    """
    values = [c for c in weather.columns if c not in ("date", "slot")]
    readings = weather.groupBy("date", "slot").agg(F.min(F.struct(*values)).alias("_reading"))
    marked = readings.select("date", "slot", "_reading.*", F.lit(1).alias("has_weather"))
    return flow.join(marked, ["date", "slot"], "left").withColumn(
        "has_weather", F.coalesce("has_weather", F.lit(0))
    )


def unmatched_slots(flow: DataFrame, weather: DataFrame) -> DataFrame:
    """Flow slots without a weather row."""
    return flow.select("date", "slot").distinct().join(weather, ["date", "slot"], "left_anti")


ATTRIBUTES = ("temperature", "windspeed", "weather_code")


def earliest_reading(weather: DataFrame) -> DataFrame:
    """(date, slot, attributes): each day's first slot with a usable reading.

    A reading is usable if none of its values is null; of several for one slot the smallest counts.
    """
    return (
        weather.dropna(subset=list(ATTRIBUTES))
        .groupBy("date")
        .agg(F.min(F.struct("slot", *ATTRIBUTES)).alias("_first"))
        .select("date", "_first.*")
    )


def first_slot_attributes(flow: DataFrame, weather: DataFrame, missing: str = "null") -> DataFrame:
    """Each day's weather at its first flow slot.

    Where that slot has no usable reading, ``missing="null"`` keeps nulls and ``missing="next"``
    takes the day's next flow slot that has one. A day without any keeps nulls either way.
    """
    if missing not in ("null", "next"):
        raise ValueError("missing must be 'null' or 'next'")
    first = flow.groupBy("date").agg(F.min("slot").alias("slot"))
    slots = flow.select("date", "slot").distinct() if missing == "next" else first
    readings = earliest_reading(weather.join(slots, ["date", "slot"], "left_semi"))
    found = readings.withColumnRenamed("slot", "_found")
    return first.join(found, "date", "left").select(
        "date", F.coalesce("_found", "slot").alias("first_slot"), *ATTRIBUTES
    )


def zip_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Pair two row sets that describe the same items, by key instead of by position."""
    return left.join(right, key)


def with_position(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """(position, columns..) of a Parquet table: files in order of their names, rows as they stand in them.

    A file knows the number of each of its rows; what comes before it is a running sum over one row per file.
    """
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), *columns
    )
    sizes = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    starts = sizes.select("_file", F.coalesce(before, F.lit(0)).alias("_start"))
    return rows.join(starts, "_file").withColumn("position", F.col("_start") + F.col("_at")).select("position", *columns)


def zip_by_position(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two tables with equal ``position``; the longer one's rest is kept, with nulls beside it."""
    return left.withColumn("_left", F.lit(True)).join(right.withColumn("_right", F.lit(True)), "position", "full").withColumn(
        "paired", F.col("_left").isNotNull() & F.col("_right").isNotNull()
    ).drop("_left", "_right")


def zip_lengths(zipped: DataFrame) -> DataFrame:
    """One row: pairs and rows that found none."""
    return zipped.agg(F.count_if("paired").alias("n_paired"), F.count_if(~F.col("paired")).alias("n_unpaired"))
