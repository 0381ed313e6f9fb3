"""Choosing which snapshots to clean."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

SNAPSHOT = ("operation", "snapshot_date")


def snapshots_of(keys: DataFrame) -> DataFrame:
    """Group decoded page keys into snapshots, with the number of pages."""
    return keys.groupBy(*SNAPSHOT).agg(F.count("*").alias("pages"))


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The latest snapshot of each operation.

    The input has one row per snapshot, so a window over an operation holds as
    many rows as there are snapshot dates.
    """
    latest = F.max("snapshot_date").over(Window.partitionBy("operation"))
    return (
        snapshots.withColumn("_latest", latest)
        .filter(F.col("snapshot_date") == F.col("_latest"))
        .drop("_latest")
    )


def snapshots_on(snapshots: DataFrame, day: date) -> DataFrame:
    return snapshots.filter(F.col("snapshot_date") == F.lit(day))


def snapshot_dates(snapshots: DataFrame) -> DataFrame:
    """Distinct snapshot dates, oldest first."""
    return snapshots.select("snapshot_date").distinct().orderBy("snapshot_date")


def unwritten(snapshots: DataFrame, written: DataFrame) -> DataFrame:
    """Snapshots that have no partition in the silver history yet."""
    return snapshots.join(written.select(*SNAPSHOT), on=list(SNAPSHOT), how="left_anti")
