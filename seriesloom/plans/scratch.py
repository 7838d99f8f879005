"""Working tables of iterative jobs in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local master may do without, and gets a temporary folder for the session."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="seriesloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables of one job: written once, read by path, deleted when the job is over, but for those it hands out."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.paths = spark, name, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            delete(self.spark, path)

    def write(self, df: DataFrame, kept: bool = False) -> str:
        path = f"{shared_dir(self.spark)}/{self.name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        if not kept:
            self.paths.append(path)
        return path

    def read(self, schema, *paths: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths)

    def written(self, df: DataFrame, kept: bool = False) -> DataFrame:
        """``df`` as a table: its lineage ends here, lost executors cost no more than a read."""
        return self.read(df.schema, self.write(df, kept))
