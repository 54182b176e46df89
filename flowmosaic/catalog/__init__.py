"""All queries, with the SQL that checks them."""

from flowmosaic.catalog import extra_queries, learning_queries, network_queries, sampling_queries, tables_queries, wide_queries  # noqa: F401
from flowmosaic.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
