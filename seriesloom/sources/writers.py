"""Sinks: forecasts, snapshots, models."""

from __future__ import annotations

from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.schema import FORECAST, require_columns
from seriesloom.sources import versions


def forecast_rows(forecasts: DataFrame, key: str = "series_id") -> DataFrame:
    """The flat forecast table: sound rows only, typed."""
    if "status" in forecasts.columns:
        forecasts = forecasts.where("status = 'ok'")
    require_columns(forecasts, ["date", "prediction", key], "forecasts")
    item = F.col("item_ref") if "item_ref" in forecasts.columns else F.lit(None)
    columns = {"date": F.col("date"), "prediction": F.col("prediction"), "series_id": F.col(key), "item_ref": item}
    return forecasts.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in FORECAST])


def replace_forecasts(forecasts: DataFrame, path: str) -> bool:
    """Replace the stored forecasts in one step; nothing to store leaves them alone and returns False."""
    return versions.publish(forecast_rows(forecasts), path, empty=False) > 0


def save_forecasts(forecasts: DataFrame, path: str, if_exists: str = "replace") -> None:
    """Store forecasts, also none; ``if_exists`` is fail, replace or append."""
    if if_exists not in ("fail", "replace", "append"):
        raise ValueError(f"if_exists is {if_exists}")
    if if_exists == "fail" and versions.names(forecasts.sparkSession, path):
        raise FileExistsError(f"{path} exists already")
    versions.publish(forecast_rows(forecasts), path, append=if_exists == "append")


#: How databases rename a table, by the start of their JDBC address.
RENAME = {"jdbc:derby:": "RENAME TABLE {0} TO {1}", "jdbc:mysql:": "RENAME TABLE {0} TO {1}", "": "ALTER TABLE {0} RENAME TO {1}"}


def _connection(spark: SparkSession, url: str, options: dict[str, str]):
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        properties.setProperty(key, value)
    if "driver" not in options:
        return jvm.java.sql.DriverManager.getConnection(url, properties)
    kind = jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(options["driver"])
    none = spark.sparkContext._gateway.new_array(jvm.java.lang.Class, 0)
    return kind.getDeclaredConstructor(none).newInstance(spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0)).connect(url, properties)


def _transaction(spark: SparkSession, url: str, options: dict[str, str], *commands: str) -> None:
    connection = _connection(spark, url, options)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for command in commands:
            statement.execute(command)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _exists(spark: SparkSession, url: str, options: dict[str, str], table: str) -> bool:
    connection = _connection(spark, url, options)
    try:
        connection.createStatement().executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0").close()
        return True
    except Py4JJavaError:
        return False
    finally:
        connection.close()


def forecasts_to_jdbc(forecasts: DataFrame, url: str, table: str, options: dict[str, str] | None = None, if_exists: str = "replace") -> bool:
    """The same over JDBC; credentials only through ``options``. Nothing to store changes nothing and returns False.

    Rows go to a staging table first, where they are counted. Then one transaction drops the old table and renames the
    staging table (or appends its rows), so readers never find the table missing or half filled, and a failed write
    leaves the old rows.
    """
    if if_exists not in ("fail", "replace", "append"):
        raise ValueError(f"if_exists is {if_exists}")
    spark, own = forecasts.sparkSession, options or {}
    there = _exists(spark, url, own, table)
    if there and if_exists == "fail":
        raise FileExistsError(f"{table} exists already")
    staging, seen = f"{table}_{uuid4().hex[:8]}", Observation()
    rows = forecast_rows(forecasts).observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        rows.write.format("jdbc").option("url", url).option("dbtable", staging).options(**own).mode("errorifexists").save()
        stored = spark.read.format("jdbc").option("url", url).options(**own).option("query", f"SELECT COUNT(*) AS n FROM {staging}").load().first()[0]
        if stored != seen.get["rows"]:
            raise OSError(f"{staging} holds {stored} of {seen.get['rows']} rows")
        if not stored:
            return False
        rename = next(sql for start, sql in RENAME.items() if url.startswith(start)).format(staging, table.rpartition(".")[2])
        if there and if_exists == "append":
            _transaction(spark, url, own, f"INSERT INTO {table} SELECT * FROM {staging}")
        else:
            _transaction(spark, url, own, *[f"DROP TABLE {table}"] * there, rename)
        return True
    finally:
        if _exists(spark, url, own, staging):
            _transaction(spark, url, own, f"DROP TABLE {staging}")


def to_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_models(models: DataFrame, path: str, buckets: int = 16) -> None:
    """The model table, partitioned by a hash bucket of the series so that one model is found without a full scan."""
    bucket = F.pmod(F.xxhash64("series_id"), F.lit(buckets)).cast("int")
    models.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(path)
