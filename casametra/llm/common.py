"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import casametra
from casametra.staging import scratch_dir

#: Words are runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``--py-files`` would, once a session."""
    context = spark.sparkContext
    name = "casametra_package.zip"
    if name in context._python_includes:
        return
    package = Path(casametra.__file__).parent
    # the session's own folder on the driver, from where executors fetch the file
    archive = Path(context._temp_dir) / name
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))


class Stage:
    """A folder in the cluster's shared folder for the written tables of one job.

    The folder goes when the session ends; results that read from it are lazy.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = scratch_dir(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read the written table."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_crc(column: str | Column) -> Column:
    """crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))


def source_key(column: str) -> Column:
    """A source as a key without nulls: equal keys for equal sources, null included."""
    return F.when(F.col(column).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(column)))
