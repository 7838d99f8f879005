"""Sources: order lines, JDBC views, CSV snapshots, hourly and legacy series, stored forecasts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.operators.schema import FORECAST, RAW_COLUMNS
from seriesloom.sources import versions

SERIES_KEYS = {"p_brand": "p_brand", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_order_lines(spark: SparkSession, sf_dir: str, key: str = "p_brand") -> DataFrame:
    """Order lines of the given tables under the raw names; the series is the brand, the part or the supplier."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    values = {
        "order_id": F.col("l_orderkey").cast("string"),
        "date_created": F.col("l_shipdate"),
        "fulfilled": F.col("l_linestatus"),
        "order_items_item_seller_sku": F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")),
        "order_items_quantity": F.col("l_quantity").cast("double"),
        "order_items_unit_price": F.try_divide("l_extendedprice", "l_quantity"),
        "mlb": F.col(SERIES_KEYS[key]).cast("string"),
    }
    return joined.select(*[values[c].alias(c) for c in RAW_COLUMNS])


def jdbc(
    spark: SparkSession,
    url: str,
    view: str,
    options: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 8,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A whole view over JDBC; credentials only through ``options``. With a partition column the reads run in parallel;
    no order is asked of the server, since keys restore it."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", view).option("fetchsize", str(fetch_size))
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", str(partitions))
        )
    return reader.options(**(options or {})).load()


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    return str(value) if isinstance(value, int | float | Decimal) else "'" + str(value).replace("'", "''") + "'"


def split_points(spark: SparkSession, url: str, view: str, column: str, partitions: int, options: dict[str, str] | None = None) -> list:
    """Values of ``column`` that cut its rows into ``partitions`` even parts, asked of the server by rank."""
    ask = lambda sql: spark.read.format("jdbc").option("url", url).options(**(options or {})).option("query", sql).load().first()
    rows = ask(f"SELECT COUNT({column}) AS n FROM {view}")[0]
    ranks = sorted({rows * i // partitions for i in range(1, partitions)} - {0})
    at = f"SELECT {column} FROM {view} WHERE {column} IS NOT NULL ORDER BY {column} OFFSET {{}} ROWS FETCH NEXT 1 ROWS ONLY"
    return list(dict.fromkeys(ask(at.format(r))[0] for r in ranks if r < rows))


def jdbc_even(
    spark: SparkSession, url: str, view: str, column: str, partitions: int = 8, options: dict[str, str] | None = None, fetch_size: int = 10_000
) -> DataFrame:
    """A whole view read in parallel parts of about equal size, without bounds given.

    ``column`` (best an indexed key) may be skewed and have nulls, which join the first part; equal values stay together.
    """
    points = [_literal(p) for p in split_points(spark, url, view, column, partitions, options)]
    parts = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(points, points[1:], strict=False)]
    whole = [f"{column} < {points[0]} OR {column} IS NULL", *parts, f"{column} >= {points[-1]}"] if points else ["1 = 1"]
    properties = {"fetchsize": str(fetch_size), **(options or {})}
    return spark.read.jdbc(url, view, predicates=whole, properties=properties)


def csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with a header and an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def hourly_csv(spark: SparkSession, path: str, time: str, value: str) -> DataFrame:
    raw = spark.read.schema(f"`{time}` string, `{value}` double").option("header", True).csv(path)
    return raw.select(F.col(time).try_cast("timestamp_ntz").alias("ts"), F.col(value).alias("value"))


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed event values by hour."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("ts")).agg(F.sum("value").alias("value"))


def legacy_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older sales sheet's columns."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.col("p_brand").alias("SKU"), F.to_date("l_shipdate").alias("DataEmissao"), F.col("l_quantity").alias("Qtd"))


def forecasts(spark: SparkSession, path: str) -> DataFrame:
    """Stored forecasts with a typed date; an empty typed frame if there are none."""
    found = versions.read(spark, path)
    if found is None:
        return spark.createDataFrame([], FORECAST)
    return found.withColumn("date", F.to_date("date"))


def snapshot(spark: SparkSession, path: str, load: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The copy at ``path``; made from ``load()`` first if it is missing or ``refresh`` is set.

    Sessions may load at once: each writes a version of its own, and all of them read a whole one.
    """
    found = None if refresh else versions.read(spark, path)
    if found is None:
        versions.publish(load(), path)
        found = versions.read(spark, path)
    return found
