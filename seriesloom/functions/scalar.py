"""Column functions: lenient dates, calendar parts, rounding, unit price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR = {
    "hour": F.hour,
    "day_of_week": F.weekday,
    "day_of_month": F.dayofmonth,
    "week_of_year": F.weekofyear,
    "month": F.month,
    "quarter": F.quarter,
    "year": F.year,
    "day_of_year": F.dayofyear,
}


def lenient_date(column: str, mode: str = "wall_clock") -> Column:
    """The date of a timestamp or text; what cannot be read is null.

    ``wall_clock`` takes the date as written and drops an offset; ``utc`` moves to UTC first, whatever the
    session's time zone.
    """
    if mode == "wall_clock":
        return F.to_date(F.col(column).try_cast("timestamp_ntz"))
    if mode == "utc":
        return F.to_date(F.to_utc_timestamp(F.col(column).try_cast("timestamp"), F.current_timezone()))
    raise ValueError(f"unknown date mode {mode}")


def half_even(column: Column) -> Column:
    """Whole units, halves to the even neighbour; null and NaN stay null."""
    return F.when(~F.isnan(column), F.rint(column)).cast("bigint")


def unit_price(price: str = "price", quant: str = "quant") -> Column:
    return F.try_divide(F.col(price), F.col(quant))
