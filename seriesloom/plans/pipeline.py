"""The chains from order lines to stored forecasts, as lazy plans."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators import clean, features, forecast, frames, gates
from seriesloom.operators.evaluate import actual_vs_pred
from seriesloom.sources import readers, writers


def newest_day(df: DataFrame, column: str = "date") -> date:
    """The newest day of a table: one number, the usual ``as_of`` of tests and backfills."""
    return df.agg(F.to_date(F.max(column)).alias("d")).first()["d"]


def featured(raw: DataFrame, date_mode: str = "wall_clock", include_current: bool = True) -> DataFrame:
    """Raw order lines -> clean daily series -> features."""
    return features.add_features(clean.process(raw, date_mode), include_current=include_current)


def production(raw: DataFrame, as_of: str | date, horizon: int = 90) -> DataFrame:
    """Direct forecasts of all series that pass the gates."""
    return forecast.direct(featured(raw), as_of, horizon, gate=lambda series: gates.gate_direct(series, as_of, horizon))


def training_view(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The model table, and every row with its holdout prediction."""
    feat = featured(raw, include_current=False)
    models = forecast.train(feat)
    test = frames.holdout_split(feat).where("split = 'test'")
    return models, actual_vs_pred(feat, forecast.score(test, models))


def stored_forecasts(spark: SparkSession, path: str, make: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """Stored forecasts if there are any, else ``make()``, stored first."""
    if not refresh:
        found = readers.forecasts(spark, path)
        if not found.isEmpty():
            return found
    writers.replace_forecasts(make(), path)
    return readers.forecasts(spark, path)
