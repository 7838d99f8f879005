"""Frames for learners: supervised rows, tails, future days, splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.operators.schema import FEATURES


def series_calendar(daily: DataFrame, series_id: str, start: str | date, end: str | date, key: str = "series_id") -> DataFrame:
    """One series on an explicit calendar; days without a row keep null."""
    days = daily.sparkSession.range(1).select(
        F.lit(series_id).alias(key), F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date")
    )
    return days.join(daily.where(F.col(key) == series_id), [key, "date"], "left")


def ahead(key: str, horizon: int, target: str = "quant") -> Column:
    """The targets of the ``horizon`` rows after each row; null where fewer follow."""
    after = W.partitionBy(key).orderBy("date").rowsBetween(1, horizon)
    y = F.collect_list(F.col(target).cast("double")).over(after)
    return F.when(F.size(y) == horizon, y)


def direct_frame(feat: DataFrame, key: str = "series_id", horizon: int = 30, features: Sequence[str] = FEATURES, long: bool = False) -> DataFrame:
    """Features of each row and the target of the ``horizon`` rows after it: an array ``y``, or a row per ``step``."""
    ahead = W.partitionBy(key).orderBy("date").rowsBetween(1, horizon)
    wide = feat.select(key, "date", *features, F.collect_list("quant").over(ahead).alias("y")).where(F.size("y") == horizon)
    if not long:
        return wide
    return wide.select(key, "date", *features, F.posexplode("y").alias("step", "y")).withColumn("step", F.col("step") + 1)


def last_features(feat: DataFrame, key: str = "series_id", features: Sequence[str] = FEATURES) -> DataFrame:
    """Each series' last row."""
    row = F.max_by(F.struct("date", *features), "date").alias("_last")
    return feat.groupBy(key).agg(row).select(key, "_last.*")


def last_values(daily: DataFrame, key: str = "series_id", k: int = 3) -> DataFrame:
    """The last ``k`` targets of each series in date order; shorter series repeat their last value.

    Ranked by a window whose limit Spark applies before its shuffle, so no series is collected whole.
    """
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.col("date").desc()))
    tail = daily.select(key, "date", "quant").withColumn("_n", rank).where(F.col("_n") <= k)
    lists = tail.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("date", "quant"))).alias("t"))
    values = F.transform("t", lambda x: x["quant"])
    whole = F.when(F.size("t") < k, F.array_repeat(F.element_at(values, -1), k)).otherwise(values)
    return lists.select(key, whole.alias("last_values"))


def future_calendar(series: DataFrame, key: str, as_of: str | date, horizon: int, anchor: str = "as_of") -> DataFrame:
    """``step, date`` of the days to forecast: after ``as_of``, or after each series' ``last_date``."""
    start = {"as_of": F.lit(as_of).cast("date"), "last_date": F.col("last_date")}[anchor]
    steps = series.select(key, start.alias("_from"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(key, "step", F.date_add("_from", F.col("step")).alias("date"))


def holdout_split(feat: DataFrame, key: str = "series_id", months: int = 1) -> DataFrame:
    """``split``: ``test`` from ``months`` calendar months before the series' last day on, else ``train``."""
    last = F.max("date").over(W.partitionBy(key))
    return feat.withColumn("split", F.when(F.col("date") < F.add_months(last, -months), "train").otherwise("test"))


def fixed_split(feat: DataFrame, cutoff: str | date, column: str = "date") -> DataFrame:
    return feat.withColumn("split", F.when(F.col(column) < F.lit(cutoff).cast("date"), "train").otherwise("test"))
