"""Scans. Explicit schemas: no inference job, and only the columns a plan uses are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowmosaic.schema import FLOW_SCHEMA, GEN_DAYS_SCHEMA, RAW_DAYS_SCHEMA, WEATHER_SCHEMA


def scan_flow(spark: SparkSession, path: str) -> DataFrame:
    """Gridded flow, one row per (date, slot, cell)."""
    return spark.read.schema(FLOW_SCHEMA).parquet(path)


def scan_weather(spark: SparkSession, path: str) -> DataFrame:
    """Meteorology, one row per (date, slot)."""
    return spark.read.schema(WEATHER_SCHEMA).parquet(path)


def scan_raw_days(spark: SparkSession, path: str) -> DataFrame:
    """Day tensors as written by :func:`flowmosaic.sources.sinks.write_raw_days`."""
    return spark.read.schema(RAW_DAYS_SCHEMA).parquet(path)


def scan_gen_days(spark: SparkSession, path: str) -> DataFrame:
    """Augmented day tensors; a filter on ``batch`` prunes whole folders."""
    return spark.read.schema(GEN_DAYS_SCHEMA).parquet(path)


def local_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str, limit: int = 10_000
) -> DataFrame:
    """A small driver-side collection as a DataFrame; bulk data belongs in a scan."""
    if len(rows) > limit:
        raise ValueError(f"{len(rows)} local rows exceed {limit}: write a table and scan it")
    return spark.createDataFrame(list(rows), schema)
