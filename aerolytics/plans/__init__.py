"""Registered queries (Spark builders + DuckDB oracles). Importing this package fills the registry."""

from aerolytics.plans import (artifact_queries, clean_queries, feature_queries, forecast_queries,  # noqa: F401
                              ml_queries, quality_queries, source_queries, series_queries,
                              stream_queries)
from aerolytics.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
