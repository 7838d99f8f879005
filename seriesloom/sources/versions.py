"""Parquet tables that are replaced as a whole: readers see the old rows or the new ones, never a part.

A table is a folder of versions, each written and committed on its own, and a pointer file that names those that count.
The pointer is renamed into place in one step after the versions are complete, so a failed or half-done write changes
nothing, and of two writers the later one to finish counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_CURRENT"
#: Versions that stay for readers that still have them open.
KEPT = 2


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _child(spark: SparkSession, path: str, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")


def names(spark: SparkSession, path: str) -> list[str]:
    """The versions that count, oldest first; none if nothing was ever published."""
    _, fs = _files(spark, path)
    pointer = _child(spark, path, POINTER)
    if not fs.exists(pointer):
        return []
    stream = fs.open(pointer)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.split()


def _point(spark: SparkSession, path: str, versions: list[str]) -> None:
    _, fs = _files(spark, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    new, pointer = _child(spark, path, f"_{uuid.uuid4().hex}"), _child(spark, path, POINTER)
    stream = fs.create(new, True)
    try:
        stream.write(bytearray("\n".join(versions).encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(new), fs.makeQualified(pointer), how)


def _tidy(spark: SparkSession, path: str, current: list[str]) -> None:
    place, fs = _files(spark, path)
    old = sorted((s for s in fs.listStatus(place) if s.getPath().getName().startswith("v-") and s.getPath().getName() not in current), key=lambda s: s.getModificationTime())
    done = [s for s in old if fs.exists(_child(spark, path, f"{s.getPath().getName()}/_SUCCESS"))]
    for status in done[: max(0, len(done) - KEPT)]:
        fs.delete(status.getPath(), True)


def publish(df: DataFrame, path: str, append: bool = False, empty: bool = True) -> int:
    """Make ``df`` the table at ``path`` (or add it), and return its rows, counted as they are written.

    With ``empty`` off, no rows leave the table as it is.
    """
    spark = df.sparkSession
    version, seen = f"v-{uuid.uuid4().hex}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{path.rstrip('/')}/{version}")
    rows = seen.get["rows"]
    if not rows and not empty:
        _, fs = _files(spark, path)
        fs.delete(_child(spark, path, version), True)
        return 0
    if not _files(spark, path)[1].exists(_child(spark, path, f"{version}/_SUCCESS")):
        raise OSError(f"{path}/{version} was not committed")
    current = [*(names(spark, path) if append else []), version]
    _point(spark, path, current)
    _tidy(spark, path, current)
    return rows


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``; None if there is none."""
    current = names(spark, path)
    if not current:
        return None
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[f"{path.rstrip('/')}/{v}" for v in current])
