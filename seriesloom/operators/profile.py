"""Profiles: counts, ranges, weekday means, box summaries, histograms, slices."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.plans.scratch import Scratch


def series_list(df: DataFrame, key: str = "series_id") -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)


def series_count(df: DataFrame, key: str = "series_id", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(F.col(key)).alias("series"))


def series_date_range(df: DataFrame, key: str = "series_id") -> DataFrame:
    """First and last day of each series, and of all under a null key."""
    return df.groupingSets([[F.col(key)], []], F.col(key)).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def date_range_of(df: DataFrame, series_id: str, today: str | date, key: str = "series_id") -> DataFrame:
    """Range of one series; of all if it is unknown; ``today`` alone if there is nothing."""
    own = F.col(key) == series_id
    edge = lambda f: F.coalesce(f(F.when(own, F.col("date"))), f("date"), F.lit(today).cast("date"))
    return df.agg(edge(F.min).alias("first_date"), edge(F.max).alias("last_date"))


def weekday_profile(daily: DataFrame, value: str = "quant") -> DataFrame:
    """Mean by weekday, Sunday first."""
    named = daily.select(F.dayofweek("date").alias("weekday_order"), F.date_format("date", "EEEE").alias("weekday"), value)
    return named.groupBy("weekday_order", "weekday").agg(F.avg(value).alias("mean_quant")).orderBy("weekday_order")


def _placed_counts(df: DataFrame, by: str, value: str) -> DataFrame:
    """``by, _v, _c, _part``: how often each value occurs in each group, dealt by ranges of (group, value)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(by), F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    order = [F.col(by).asc_nulls_first(), F.col("_v")]
    return counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())


def order_statistics(counts: DataFrame, by: str, parts: Sequence[float]) -> DataFrame:
    """``by, _part_of, value``: interpolated quantiles of ``_placed_counts`` by distributed selection.

    Only totals of a group and range are added up in order; then those ranges alone are opened that hold a wanted rank, and
    a running count is made inside each. So no task sees a group, however few and large the groups are.
    """
    totals = counts.groupBy(F.col(by), "_part").agg(F.sum("_c").alias("_own"))
    group = W.partitionBy(by)
    before = F.coalesce(F.sum("_own").over(group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    totals = totals.withColumns({"_start": before, "_n": F.sum("_own").over(group)})
    at = lambda p: F.lit(float(p)) * (F.col("_n") - 1)
    wanted = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("p"), side.cast("long").alias("rank")) for p in parts for side in (F.floor(at(p)), F.ceil(at(p)))]))
    held = totals.select(F.col(by).alias("_by"), F.col("_part").alias("_at"), "_start", "_own", "_n", wanted.alias("w"))
    held = held.where((F.col("w.rank") >= F.col("_start")) & (F.col("w.rank") < F.col("_start") + F.col("_own")))
    opened = held.groupBy("_by", "_at", "_start", "_n").agg(F.collect_set("w").alias("_wanted"))
    rows = counts.join(opened, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_at")))
    upto = W.partitionBy("_by", "_at").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_upto", F.sum("_c").over(upto) + F.col("_start"))
    hits = F.filter("_wanted", lambda w: (w["rank"] < F.col("_upto")) & (w["rank"] >= F.col("_upto") - F.col("_c")))
    found = rows.select("_by", "_n", "_v", F.explode(hits).alias("w")).groupBy("_by", F.col("w.p").alias("_part_of"), "_n")
    low, high, rank = F.min("_v"), F.max("_v"), F.col("_part_of") * (F.col("_n") - 1)
    return found.agg((low + (high - low) * (rank - F.floor(rank))).alias("value"))


def box_summary(df: DataFrame, by: str, value: str = "quant") -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (extreme values inside the fences) and outliers of ``value`` for each ``by``.

    Equal values are counted first; quartiles come by selection among the counts, whiskers and outliers from the counts
    themselves. The counts are a table while this runs; what it returns has a row for each group.
    """
    with Scratch(df.sparkSession, "box") as work:
        counts = work.written(_placed_counts(df, by, value))
        quartiles = order_statistics(counts, by, [0.25, 0.5, 0.75]).groupBy("_by").pivot("_part_of", [0.25, 0.5, 0.75]).agg(F.first("value"))
        quartiles = quartiles.toDF("_by", "q1", "median", "q3")
        low, high = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
        inside = F.col("_v").between(low, high)
        joined = counts.join(quartiles, F.col(by).eqNullSafe(F.col("_by")))
        found = joined.groupBy(by, "q1", "median", "q3").agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.sum(F.when(~inside, F.col("_c")).otherwise(0)).alias("outliers"),
            F.sum("_c").alias("n"),
        )
        return work.written(found, kept=True)


def histogram(df: DataFrame, value: str = "quant", bins: int = 100) -> DataFrame:
    """Rows in ``bins`` equal bins between the least and the largest value (which counts in the last bin)."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.least(F.floor((F.col(value) - F.col("lo")) / width) + 1, F.lit(bins))
    placed = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(ends))  # the right side is a single row of two numbers
    placed = placed.withColumn("bin", F.when(width > 0, bin_).otherwise(1).cast("int"))
    return placed.groupBy("bin").agg(F.count("*").alias("rows"))


def below(df: DataFrame, limit: float, value: str = "quant") -> DataFrame:
    """Rows under an outlier threshold."""
    return df.where(F.col(value) < limit)


def forecast_slice(df: DataFrame, series_id: str | None = None, start: str | date | None = None, end: str | date | None = None, key: str = "series_id") -> DataFrame:
    """Rows of one series and, if both ends are given, a closed date range; filters reach the scan."""
    if series_id is not None:
        df = df.where(F.col(key) == series_id)
    if start is not None and end is not None:
        df = df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return df


def page(df: DataFrame, columns: list[str], order: list[str], size: int, number: int = 0) -> DataFrame:
    """One page of records in a stable order."""
    return df.select(*columns).orderBy(*order).offset(size * number).limit(size)


def page_after(df: DataFrame, columns: Sequence[str], order: Sequence[str], size: int, after: Sequence | None = None) -> DataFrame:
    """The ``size`` records that follow the key ``after`` in the order of the columns ``order``; the first ones without it.

    ``order`` must tell records apart, so that none is lost or repeated between pages. The key is a filter that reaches the
    scan, and each task passes on ``size`` rows at most: a later page costs no more than the first.
    """
    if after is not None:
        past: Column = F.lit(False)
        for name, key in reversed(list(zip(order, after, strict=True))):
            past = (F.col(name) > F.lit(key)) | ((F.col(name) == F.lit(key)) & past)
        df = df.where(F.col(order[0]) >= F.lit(after[0])).where(past)
    return df.orderBy(*order).limit(size).select(*columns)
