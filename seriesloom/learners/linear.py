"""One line per series and step: the target on one feature, fitted by Spark's regression aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit(frame: DataFrame, by: list[str], target: str = "y", feature: str = "lag_1") -> DataFrame:
    """``by, slope, intercept, mean``; rows without target or feature are left out, slope is null without variance."""
    known = frame.where(F.col(target).isNotNull() & F.col(feature).isNotNull())
    return known.groupBy(*by).agg(
        F.regr_slope(target, feature).alias("slope"),
        F.regr_intercept(target, feature).alias("intercept"),
        F.avg(target).alias("mean"),
    )


def value(feature: str = "lag_1") -> Column:
    """The fitted value; the mean where no line could be fitted or the feature is unknown."""
    return F.coalesce(F.col("intercept") + F.col("slope") * F.col(feature), F.col("mean"))
