"""The silver history: a Parquet table partitioned by operation and snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casametra.schemas import OWN_OPERATION, PARTITION_COLUMNS, SILVER_SCHEMA

_NO_TABLE_YET = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def write_snapshots(silver: DataFrame, root: str) -> None:
    """Write cleaned snapshots as partitions of the history.

    Rows are rebalanced by partition first: a small snapshot becomes one file,
    and a very large one is split over several tasks. Dynamic overwrite moves
    each finished partition into place as a whole, so that a job that dies
    leaves complete partitions or none, never half of one.
    """
    (
        silver.hint("rebalance", *PARTITION_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(root)
    )


def _stored_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The table as stored, or None while there is none."""
    try:
        return spark.read.parquet(root)
    except AnalysisException as error:
        if error.getCondition() in _NO_TABLE_YET:
            return None
        raise


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SILVER_SCHEMA).drop(OWN_OPERATION)


def read_history(
    spark: SparkSession, root: str, pages_of: Sequence[str] | None = None
) -> DataFrame:
    """Lazy scan of the whole history; empty while nothing has been written.

    ``pages_of`` limits the scan to the partitions of pages of some operations. A filter
    on ``operation`` alone can't prune, as a page may hold a listing of the other
    operation; who does not want such listings names the pages.

    Raises ``ValueError`` when the stored table lacks ``operation`` or
    ``snapshot_date``. The operation of the listing itself wins over that of the
    page it came from. Tables of other writers may lack optional columns; their
    row order is that of the files.
    """
    stored = _stored_table(spark, root)
    if stored is None:
        return empty_history(spark)
    missing = [c for c in PARTITION_COLUMNS if c not in stored.columns]
    if missing:
        raise ValueError(f"silver table {root!r} lacks the columns {missing}")
    if pages_of is not None:
        stored = stored.filter(F.col("operation").isin(*pages_of))
    table = stored.select(*[_stored_column(stored, f).alias(f.name) for f in SILVER_SCHEMA])
    return table.withColumn(
        "operation", F.coalesce(OWN_OPERATION, "operation")
    ).drop(OWN_OPERATION)


#: Stands in for the position of a row in tables that other writers made.
_POSITION_IN_FILE = {"_page_file": "_metadata.file_path", "_page_pos": "_metadata.row_index"}


def _stored_column(stored: DataFrame, wanted: T.StructField) -> Column:
    """A stored column in the type of the silver schema, null if it is absent."""
    if wanted.name in stored.columns:
        column = F.col(wanted.name)
    elif wanted.name in _POSITION_IN_FILE:
        column = F.col(_POSITION_IN_FILE[wanted.name])
    else:
        column = F.lit(None)
    return column.cast(wanted.dataType)


def written_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The (operation, snapshot_date) pairs that have a partition already.

    Taken from the names of the stored files; no file is opened for its rows.
    """
    schema = "operation string, snapshot_date date"
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", True)
            .load(root)
            .select("path")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return files.select(
        F.nullif(F.regexp_extract("path", r"/operation=([^/]+)/", 1), F.lit("")).alias(
            "operation"
        ),
        F.try_to_date(F.regexp_extract("path", r"/snapshot_date=([^/]+)/", 1)).alias(
            "snapshot_date"
        ),
    ).distinct()
