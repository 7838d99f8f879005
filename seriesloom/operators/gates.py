"""Which series get a model."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.operators.frames import holdout_split

ACTIVE_DAYS = 30
MIN_EXTRA_ROWS = 15
MIN_SPAN_DAYS = 365
MIN_TRAIN = 10


def profile_columns() -> list[Column]:
    """First and last day, rows, span in days, and rows without a target, as aggregates."""
    missing = F.col("quant").isNull() | F.isnan("quant")
    return [
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count("*").alias("rows"),
        F.datediff(F.max("date"), F.min("date")).alias("span_days"),
        F.count_if(missing).alias("missing_target"),
    ]


def series_profile(feat: DataFrame, key: str = "series_id") -> DataFrame:
    return feat.groupBy(key).agg(*profile_columns())


def train_rows(feat: DataFrame, key: str = "series_id", months: int = 1) -> DataFrame:
    """Rows before and after the holdout threshold of each series."""
    split = holdout_split(feat, key, months)
    return split.groupBy(key).agg(
        F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "test").alias("test_rows")
    )


def _inactive(as_of: str | date, days: int) -> Column:
    return F.col("last_date") < F.date_sub(F.lit(as_of).cast("date"), days)


def gate_direct(profile: DataFrame, as_of: str | date, horizon: int, active_days: int = ACTIVE_DAYS, min_extra: int = MIN_EXTRA_ROWS) -> DataFrame:
    """``gate_reason``: inactive, insufficient, empty_training or ok, judged in that order."""
    reason = (
        F.when(_inactive(as_of, active_days), "inactive")
        .when(F.col("rows") < horizon + min_extra, "insufficient")
        .when(F.col("rows") <= horizon, "empty_training")
        .otherwise("ok")
    )
    return profile.withColumn("gate_reason", reason)


def gate_recursive(
    profile: DataFrame,
    trains: DataFrame,
    as_of: str | date,
    key: str = "series_id",
    active_days: int = ACTIVE_DAYS,
    min_span: int = MIN_SPAN_DAYS,
    min_train: int = MIN_TRAIN,
) -> DataFrame:
    """``gate_reason``: short_span, inactive, empty_training, insufficient or ok, judged in that order."""
    reason = (
        F.when(F.col("span_days") < min_span, "short_span")
        .when(_inactive(as_of, active_days), "inactive")
        .when(F.col("train_rows") == 0, "empty_training")
        .when(F.col("train_rows") < min_train, "insufficient")
        .otherwise("ok")
    )
    return profile.join(trains, key).withColumn("gate_reason", reason)


def gate_train(trains: DataFrame) -> DataFrame:
    """``gate_reason`` of plain training: a series needs training rows."""
    return trains.withColumn("gate_reason", F.when(F.col("train_rows") == 0, "empty_training").otherwise("ok"))


def passing(df: DataFrame, gated: DataFrame, key: str = "series_id") -> DataFrame:
    return df.join(gated.where("gate_reason = 'ok'").select(key), key, "left_semi")


def summary(gated: DataFrame) -> DataFrame:
    """Series by reason, and all of them."""
    return gated.rollup("gate_reason").agg(F.count("*").alias("series")).select(
        F.coalesce("gate_reason", F.lit("total")).alias("gate_reason"), "series"
    )
