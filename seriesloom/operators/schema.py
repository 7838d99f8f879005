"""Schemas of the tables that pass through the engine, and the checks on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY, DATE, TARGET = "series_id", "date", "quant"
#: The feature names of stored models.
FEATURES = ("lag_1", "rolling_mean_3", "day_of_week", "day_of_month", "price_per_unit")
FEATURES_WITH_PRICE = (*FEATURES, "price")

#: The columns of raw order lines as the source names them, and the canonical names they get.
RAW_COLUMNS = {
    "order_id": "order_id",
    "date_created": "ts",
    "fulfilled": "fulfilled",
    "order_items_item_seller_sku": "item_ref",
    "order_items_quantity": "quant",
    "order_items_unit_price": "price",
    "mlb": "series_id",
}
TEXT, NUMBER, DAY, WHOLE, CLOCK = T.StringType(), T.DoubleType(), T.DateType(), T.LongType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_RAW_NUMBERS = ("order_items_quantity", "order_items_unit_price")
RAW = _struct(**{name: NUMBER if name in _RAW_NUMBERS else TEXT for name in RAW_COLUMNS})
DAILY = _struct(series_id=TEXT, date=DAY, quant=NUMBER, price=NUMBER, item_ref=TEXT)
FORECAST = _struct(date=DAY, prediction=WHOLE, series_id=TEXT, item_ref=TEXT)
HOURLY = _struct(ts=CLOCK, value=NUMBER)
LEGACY = _struct(SKU=TEXT, DataEmissao=DAY, Qtd=NUMBER)


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> DataFrame:
    """``df`` itself; a ``ValueError`` names the columns it lacks."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"{what} must be a DataFrame, not {type(df).__name__}")
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")
    return df


def require_raw(df: DataFrame) -> DataFrame:
    return require_columns(df, RAW_COLUMNS, "order lines")


def require_dated(df: DataFrame, column: str = DATE) -> DataFrame:
    """``df`` itself if ``column`` is a DATE; the engine keeps dates as columns and needs them typed."""
    require_columns(df, [column])
    if not isinstance(df.schema[column].dataType, T.DateType):
        raise ValueError(f"{column} must be a DATE, not {df.schema[column].dataType.simpleString()}")
    return df
