"""The registry: queries by name, their SQL, and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesloom.plans.oracles import ORACLES
from seriesloom.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES", "entry"]


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines to forecasts, end to end."""
    return QUERIES["forecast_direct_linear"](spark, sf_dir)
