"""Intermediate tables in the shared folder of the cluster.

A result that several datasets read is written once as Parquet and read back.
Unlike a cached block it outlives a lost executor, it is columnar, and its size
is known to the optimizer when it plans the joins that follow.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none, it is a folder in the session's warehouse, which
    driver and executors share too. On a cluster one of the two must be named: the
    warehouse's default is a folder of the driver's own, and raises ``ValueError``.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        named = spark.sparkContext.getConf().contains("spark.sql.warehouse.dir")
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
    return configured.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that goes when the session ends."""
    root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return root


class Staging:
    """A folder of intermediate tables that lives as long as one job."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self.root = f"{shared_dir(spark)}/staging-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a DataFrame that reads the written table."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self._spark.read.schema(df.schema).parquet(self.path(name))

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc: object) -> None:
        """Remove the folder this object made; nothing else lives in it."""
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        fs.delete(path, True)
