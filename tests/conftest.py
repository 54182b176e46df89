import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from flowmosaic.session import build_session

    session = build_session("tests", master="local[8]", shuffle_partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def flow_rows(spark):
    """Builds a flow table from (yyyymmdd, slot, row, col, inflow, outflow) tuples."""
    from pyspark.sql import functions as F

    def build(rows):
        raw = spark.createDataFrame(
            rows, "d STRING, slot INT, grid_row INT, grid_col INT, inflow DOUBLE, outflow DOUBLE"
        )
        return raw.withColumn("date", F.to_date("d", "yyyyMMdd")).drop("d")

    return build
