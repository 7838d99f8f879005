"""Data quality: freshness, key contract."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.scalar import lenient_date

FRESH_DAYS, STALE_DAYS = 2, 7


def freshness(feat: DataFrame, as_of: str | date, limit: int = 30) -> DataFrame:
    """Age of the newest day and whether it is within ``limit`` days."""
    age = F.datediff(F.lit(as_of).cast("date"), F.max("date"))
    status = F.when(F.max("date").isNull(), "empty").when(age > limit, "stale").otherwise("fresh")
    return feat.agg(F.max("date").alias("last_date"), age.alias("age_days"), status.alias("status"))


def freshness_levels(data: DataFrame, as_of: str | date, stale: int = STALE_DAYS, aging: int = FRESH_DAYS) -> DataFrame:
    """``fresh``, ``aging`` or ``stale`` by the newest ``date_created`` (else ``date``); ``unparseable`` if none can be
    read, ``no_date`` without such a column."""
    column = next((c for c in ("date_created", "date") if c in data.columns), None)
    if column is None:
        return data.sparkSession.range(1).select(F.lit(None).cast("int").alias("age_days"), F.lit("no_date").alias("status"))
    newest = F.max(lenient_date(column))
    age = F.datediff(F.lit(as_of).cast("date"), newest)
    status = F.when(newest.isNull(), "unparseable").when(age > stale, "stale").when(age > aging, "aging").otherwise("fresh")
    return data.agg(age.alias("age_days"), status.alias("status"))


def sku_contract(lines: DataFrame, key: str = "series_id", item: str = "item_ref") -> DataFrame:
    """Series with more than one item."""
    return lines.groupBy(key).agg(F.count_distinct(F.col(item)).alias("items")).where("items > 1")
