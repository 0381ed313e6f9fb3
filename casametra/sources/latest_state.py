"""The latest row of every property, kept as a bucketed table and merged with new snapshots.

The table is bucketed and sorted by property. A merge is a full outer join of the table
with the latest rows of the new snapshots: only these are shuffled, into the table's
buckets, and the result is written bucket by bucket as a new version. A run thus costs
the properties there are and the listings that are new, not all listings there ever were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casametra.operators.dedup import latest_per_property
from casametra.schemas import ORDINAL_COLUMNS

#: Buckets of a new state; a cluster wants some multiple of its cores.
BUCKETS = 64

KEY = "_property"


def property_key() -> Column:
    """One text per (operation, propertyCode); null parts are parts of their own."""
    return F.to_json(F.struct("operation", "propertyCode"), {"ignoreNullFields": "false"})


def recency(columns: Sequence[str], order: Sequence[str], of: str = "") -> Column:
    """What makes a row the latest: the order of ``latest_per_property`` as one value.

    Nulls come first in it, as they come last among descending values.
    """

    def column(name: str) -> Column:
        return F.col(f"{of}.{name}" if of else name)

    day = column("snapshot_date")
    return F.struct(day.isNull(), day, *[column(c) for c in order])


class LatestState:
    """Versions of the bucketed table below one folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        order: Sequence[str] = ORDINAL_COLUMNS,
        buckets: int = BUCKETS,
    ):
        self._spark, self._order, self._buckets = spark, tuple(order), buckets
        self.root = root.rstrip("/")
        self.schema = schema
        self._columns = [f.name for f in schema]

    def path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def table(self, version: int) -> DataFrame:
        """A version as stored, in its buckets."""
        return self._spark.table(self._registered(version))

    def rows(self, version: int) -> DataFrame:
        return self.table(version).select(*self._columns)

    def merge(self, listings: DataFrame, version: int, previous: int | None) -> None:
        """Write ``version``: the rows of ``previous`` and of the listings, the latest of each property."""
        fresh = latest_per_property(listings.select(*self._columns), self._order).withColumn(KEY, property_key())
        if previous is None:
            merged = fresh.repartition(self._buckets, KEY)
        else:
            merged = self.merged(self.table(previous), fresh)
        self._remove(version)
        name = self._registered(version)
        merged.select(*self._columns, KEY).write.mode("append").insertInto(name)
        self._spark.catalog.refreshTable(name)

    def merged(self, stored: DataFrame, fresh: DataFrame) -> DataFrame:
        """The later row of each property from either side."""
        old = stored.select(KEY, F.struct(*self._columns).alias("_old"))
        new = fresh.select(F.col(KEY), F.struct(*self._columns).alias("_new"))
        newer = F.col("_old").isNull() | (
            F.col("_new").isNotNull()
            & (recency(self._columns, self._order, "_new") > recency(self._columns, self._order, "_old"))
        )
        # buckets of the table are the partitions of the join, and of what it writes
        return old.join(new, KEY, "full").select(KEY, F.when(newer, F.col("_new")).otherwise(F.col("_old")).alias("_row")).select(
            KEY, "_row.*"
        )

    def _registered(self, version: int) -> str:
        """The version under a name of this session's catalog, which knows its buckets."""
        path = self.path(version)
        name = f"latest_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
        if not self._spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            self._spark.sql(
                f"CREATE TABLE {name} ({columns}, `{KEY}` string) USING parquet "
                f"CLUSTERED BY (`{KEY}`) SORTED BY (`{KEY}`) INTO {self._buckets} BUCKETS LOCATION '{path}'"
            )
        return name

    def _remove(self, version: int) -> None:
        """Remove what a run that died has left of a version."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.path(version))
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)

    def forget(self, before: int) -> None:
        """Remove the versions before one that is committed, but for the last of them."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self._spark._jsc.hadoopConfiguration())
        for folder in fs.listStatus(path):
            number = folder.getPath().getName().removeprefix("version=")
            if number.isdigit() and int(number) < before - 1:
                self._spark.sql(f"DROP TABLE IF EXISTS {self._registered(int(number))}")
                fs.delete(folder.getPath(), True)
