"""Points of the map as a table whose files each cover a small part of it.

Rows are cut into ranges of their place codes, one or more files for each range. Beside the table
stands an index with the first and last code of every file, so that a section of the
map opens only the files that can have a point in it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casametra.operators.spatial import Box, code_ranges, in_box, place_code

_INDEX = "_files"
_INDEX_SCHEMA = "file string, first_code bigint, last_code bigint, n_rows bigint"


def clustered(points: DataFrame, files: int | None = None) -> DataFrame:
    """The points in ranges of their codes and in order within each.

    ``files`` is the number of ranges; without it the session's number of shuffle
    partitions is, merged where they are small.
    """
    code = place_code(F.col("latitude"), F.col("longitude"))
    ranges = points.repartitionByRange(code) if files is None else points.repartitionByRange(files, code)
    return ranges.sortWithinPartitions(code)


def write_locations(points: DataFrame, root: str, files: int | None = None) -> int:
    """Write points with known coordinates and their index; returns the number of files."""
    spark = points.sparkSession
    clustered(points, files).write.mode("overwrite").parquet(root)
    code = place_code(F.col("latitude"), F.col("longitude"))
    stored = spark.read.schema(points.schema).parquet(root)
    index = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(code).alias("first_code"), F.max(code).alias("last_code"), F.count("*").alias("n_rows")
    )
    # the name's underscore hides the index from readers of the table
    index.coalesce(1).write.mode("overwrite").parquet(f"{root}/{_INDEX}")
    return spark.read.schema(_INDEX_SCHEMA).parquet(f"{root}/{_INDEX}").count()


def files_of(spark: SparkSession, root: str, box: Box) -> list[str]:
    """The files that can have a point of the box; as many as lie under it."""
    ranges = code_ranges(box)
    meets = reduce(
        lambda a, b: a | b, [(F.col("first_code") <= high) & (F.col("last_code") >= low) for low, high in ranges]
    )
    index = spark.read.schema(_INDEX_SCHEMA).parquet(f"{root}/{_INDEX}")
    return sorted(f"{root}/{r[0]}" for r in index.filter(meets).select("file").collect())


def read_box(spark: SparkSession, root: str, box: Box) -> DataFrame:
    """The points of a box, from the files that can have one."""
    files = files_of(spark, root, box)
    table = spark.read.parquet(root)
    if not files:
        return table.limit(0)
    return spark.read.schema(table.schema).parquet(*files).filter(in_box(box))
