"""Three ways to keep one row per property, each with an explicit order.

Each is ``row_number() = 1``, which Spark plans as a per-partition group limit
before the shuffle: of a property that fills a third of the table, each map
task sends one row. The property comes first among the keys: sorts compare the first
key's leading bytes, and whole rows only where these are equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from casametra.schemas import ORDINAL_COLUMNS


def _one_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_per_snapshot(
    listings: DataFrame, order: Sequence[str] = ORDINAL_COLUMNS
) -> DataFrame:
    """First row of each property within each snapshot of an operation.

    A property listed in several snapshots keeps one row in each of them. Null
    keys compare equal.
    """
    return _one_per(
        listings,
        ("propertyCode", "operation", "snapshot_date"),
        [F.col(c).asc() for c in order],
    )


def latest_per_property(
    listings: DataFrame, order: Sequence[str] = ORDINAL_COLUMNS
) -> DataFrame:
    """Latest row of each property of an operation, the last one on ties.

    A row whose date is unknown sorts after all dates and thus wins.
    """
    return _one_per(
        listings,
        ("propertyCode", "operation"),
        [
            F.col("snapshot_date").desc_nulls_first(),
            *[F.col(c).desc() for c in order],
        ],
    )


def last_per_property(
    listings: DataFrame,
    order: Sequence[str] = ("operation", "snapshot_date", *ORDINAL_COLUMNS),
) -> DataFrame:
    """Last row of each property over everything, for exploratory views only.

    It collapses time series, so the gold datasets do not use it.
    """
    return _one_per(listings, ("propertyCode",), [F.col(c).desc() for c in order])
