"""Predictions against actuals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def actual_vs_pred(actual: DataFrame, pred: DataFrame, key: str = "series_id") -> DataFrame:
    """Actual rows with their prediction, null where there is none."""
    return actual.join(pred.select(key, "date", "prediction"), [key, "date"], "left")


def rmse(rows: DataFrame, key: str = "series_id") -> DataFrame:
    error = F.col("quant") - F.col("prediction")
    return rows.where("prediction is not null").groupBy(key).agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count("*").alias("n"))


def worst_days(rows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` days of the largest mean absolute error; ties by date."""
    error = F.abs(F.col("quant") - F.col("prediction"))
    days = rows.where("prediction is not null").groupBy("date").agg(F.avg(error).alias("mean_error"))
    return days.orderBy(F.col("mean_error").desc(), "date").limit(n)


def horizon_totals(pred: DataFrame, until: str | date, key: str = "series_id", value: str = "prediction") -> DataFrame:
    """Predicted total of each series, and up to a day."""
    early = F.when(F.col("date") <= F.lit(until).cast("date"), F.col(value))
    return pred.groupBy(key).agg(F.sum(value).alias("total"), F.coalesce(F.sum(early), F.lit(0)).alias("total_until"))


def running_totals(pred: DataFrame, key: str = "series_id", value: str = "prediction") -> DataFrame:
    from pyspark.sql import Window as W

    upto = W.partitionBy(key).orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return pred.withColumn("running_total", F.sum(value).over(upto))
