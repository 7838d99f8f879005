"""Sessions whose tasks stay small however large a table is."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Bytes of a table for each shuffle partition, and the most bytes of a table or of a shuffle that a task is to read.
#: Sorts and windows hold some 20 times as much as a task reads of a shuffle, and far more of dense days, which compress
#: well; so Spark may merge only small partitions.
SHARE, TASK = 2 << 20, 4 << 20
_TASK_BYTES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
_PARTITIONS = "spark.sql.shuffle.partitions"


def table_bytes(spark: SparkSession, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def _bytes(text: str) -> int:
    """A size as Spark's settings give it: bytes, or a number with a unit."""
    number = text.strip().lower().removesuffix("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}.get(number[-1:], 1)
    return int(number.rstrip("kmgt")) * unit


def sized(spark: SparkSession, path: str) -> SparkSession:
    """``spark`` itself for tables that one task may read; else a session with its settings, a number of shuffle
    partitions that follows the table at ``path``, and small shares for tasks. Results do not depend on it."""
    total = table_bytes(spark, path)
    if total <= TASK:
        return spark
    own = spark.newSession()
    known = own.conf.getAll
    for name, value in spark.conf.getAll.items():
        if known.get(name) != value:
            own.conf.set(name, value)
    own.conf.set(_PARTITIONS, max(int(spark.conf.get(_PARTITIONS)), -(-total // SHARE)))
    for name in _TASK_BYTES:
        own.conf.set(name, min(_bytes(spark.conf.get(name)), TASK))
    return own
