"""Features of daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.functions.scalar import CALENDAR, unit_price


def add_features(
    daily: DataFrame,
    key: str = "series_id",
    lags: Sequence[int] = (1,),
    windows: Sequence[int] = (3,),
    include_current: bool = True,
) -> DataFrame:
    """Lags, rolling means (null until the window is full), weekday (Monday 0), day of month, price per unit.

    Lags and windows count rows of the same series. ``include_current=False`` shifts the windows back by a row, which
    keeps the target of the row out of its own features.
    """
    ordered = W.partitionBy(key).orderBy("date")
    out = daily
    for n in lags:
        out = out.withColumn(f"lag_{n}", F.lag("quant", n).over(ordered))
    for n in windows:
        frame = ordered.rowsBetween(1 - n, 0) if include_current else ordered.rowsBetween(-n, -1)
        full = F.count(F.lit(1)).over(frame) == n
        out = out.withColumn(f"rolling_mean_{n}", F.when(full, F.avg("quant").over(frame)))
    return out.withColumns(
        {
            "day_of_week": F.weekday("date"),
            "day_of_month": F.dayofmonth("date"),
            "price_per_unit": unit_price(),
        }
    )


def add_calendar(df: DataFrame, column: str, parts: Sequence[str] = tuple(CALENDAR)) -> DataFrame:
    return df.withColumns({part: CALENDAR[part](F.col(column)) for part in parts})


def complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in ``columns`` (all by default)."""
    return df.dropna("any", subset=list(columns) if columns else None)
