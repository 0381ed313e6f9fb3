"""Gold from maintained aggregates: a run reads the new snapshots, not the history.

Rows of a property are deduplicated within a snapshot, so what a snapshot adds to the
datasets never changes once it is complete. For each population three tables keep it, by
commit and snapshot date:

* ``cells``: counts and sums of the finest grain, from which all means and counts follow;
* ``values``: the values of the box plots with their counts, in order of their buckets;
* ``buckets``: the totals of those buckets, which add up across snapshots.

A box plot merges bucket totals, then reads only the values in the few buckets that hold a
wanted rank. The latest row of each property is a fourth, bucketed table
(``LatestState``). A ledger names the commit that is valid for each snapshot date: when a late
page of a date arrives, the date is computed again from all its rows and its new commit
takes over. Readers see only what the ledger names, so a run that dies leaves nothing to see.

The unit is the date, since pages of one operation may hold listings of the other. Rows
without a snapshot date belong to no snapshot and take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casametra.operators import market
from casametra.operators.cells import CELL_KEYS, roll_up, unit_cells
from casametra.operators.dedup import first_per_snapshot
from casametra.operators.filters import in_scope, relevant
from casametra.operators.quantiles import bucket_totals, counted_values, merged_totals, quantiles_by_rank
from casametra.params import MarketParams
from casametra.plans import gold
from casametra.plans.silver import silver_snapshots
from casametra.schemas import ORDINAL_COLUMNS, SILVER_SCHEMA
from casametra.sources.latest_state import BUCKETS, LatestState
from casametra.sources.ledger import Ledger
from casametra.sources.silver_table import read_history
from casametra.staging import Staging

Snapshot = tuple[str | None, date]

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
    ]
)

POPULATIONS = ("general", "relevant")
_VALUE = "priceByArea"
_LATEST_COLUMNS = (
    "operation", "propertyCode", "snapshot_date", "size", "rooms", "priceByArea",
    "district", "neighborhood", "latitude", "longitude",
)
#: Ranges of buckets that a filter on the values may name.
_RANGES = 8


class GoldState:
    """Maintained aggregates below one folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        params: MarketParams = MarketParams(),
        order: Sequence[str] = ORDINAL_COLUMNS,
        listing_schema: T.StructType = SILVER_SCHEMA,
        buckets: int = BUCKETS,
    ):
        self._spark, self.params, self._order = spark, params, tuple(order)
        self.root = root.rstrip("/")
        self.ledger = Ledger(spark, self.root, COMMIT_SCHEMA)
        kept = list(dict.fromkeys((*_LATEST_COLUMNS, *order)))
        schema = T.StructType([listing_schema[c] for c in kept])
        self.latest = LatestState(spark, f"{self.root}/latest", schema, order, buckets)

    # --- writing ------------------------------------------------------------

    def missing(self, snapshots: DataFrame) -> list[Snapshot]:
        """Those of the given snapshots that no commit names; as many as the calendar has."""
        known = self.ledger.entries().select("operation", "snapshot_date")
        return [tuple(r) for r in snapshots.select("operation", "snapshot_date").exceptAll(
            known.join(snapshots, ["operation", "snapshot_date"], "left_semi").distinct()
        ).collect()]

    def absorb(self, listings: DataFrame, snapshots: Sequence[Snapshot]) -> int:
        """Take snapshots in; returns the number of the commit.

        ``listings`` has all rows of the dates of the snapshots, and no others.
        """
        number = self.ledger.next()
        previous = max(self.ledger.commits(), default=None)
        scoped = in_scope(listings.filter(F.col("snapshot_date").isNotNull()), self.params.scope_districts)
        with Staging(self._spark) as stage, ThreadPoolExecutor(max_workers=3) as pool:
            parts = [
                pool.submit(self._write_population, scoped, "general", number, stage),
                pool.submit(self._write_population, relevant(scoped, self.params.relevant), "relevant", number, stage),
                pool.submit(self.latest.merge, scoped, number, previous),
            ]
            for part in parts:
                part.result()
        # the commit comes last: without it the tables above are not there for any reader
        rows = self._spark.createDataFrame(list(snapshots), COMMIT_SCHEMA)
        self.ledger.append(rows, number)
        self.latest.forget(number)
        return number

    def _write_population(self, listings: DataFrame, name: str, number: int, stage: Staging) -> None:
        columns = ("propertyCode", *CELL_KEYS, *[c for c in ("priceByArea", "size", "price")])
        slim = listings.select(*dict.fromkeys((*columns, *self._order)))
        rows = stage.table(first_per_snapshot(slim, self._order).select(*columns), f"{name}-rows")
        keys = (*market.BOX_KEYS, "snapshot_date")
        values = stage.table(counted_values(rows, keys, _VALUE), f"{name}-values")
        self._write(roll_up(unit_cells(rows), CELL_KEYS), "cells", name, number)
        self._write(values, "values", name, number, ("_b0", "_v"))
        self._write(bucket_totals(values, keys), "buckets", name, number)

    def _write(self, df: DataFrame, table: str, population: str, number: int, order: Sequence[str] = ()) -> None:
        (
            df.repartitionByRange("snapshot_date", *order)
            .sortWithinPartitions("snapshot_date", *order)
            .write.mode("overwrite")
            .partitionBy("snapshot_date")
            .parquet(f"{self.root}/{table}/commit={number}/population={population}")
        )

    # --- reading ------------------------------------------------------------

    def valid(self) -> DataFrame:
        """Snapshot dates with their commits, and whether a later one has computed them again."""
        dates = self.ledger.entries().select("snapshot_date", "commit").distinct()
        last = dates.groupBy("snapshot_date").agg(F.max("commit").alias("last"))
        return dates.join(last, "snapshot_date").select("snapshot_date", "commit", (F.col("commit") < F.col("last")).alias("replaced"))

    def stored(self, table: str, population: str, since: date | None = None) -> DataFrame:
        """A table of the valid snapshots; ``since`` leaves out older partitions.

        Commits are named by their folders, dates by literals on the partition column, so
        that no file of another snapshot is opened.
        """
        # as many rows as the calendar has
        dates = [r for r in self.valid().collect() if since is None or r["snapshot_date"] >= since]
        commits = sorted({r["commit"] for r in dates if not r["replaced"]})
        schema = _SCHEMAS[table]
        if not commits:
            return self._spark.createDataFrame([], schema)
        root = f"{self.root}/{table}"
        found = self._spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.IntegerType())])).option(
            "basePath", root
        ).parquet(*[f"{root}/commit={c}/population={population}" for c in commits])
        if since is not None:
            found = found.filter(F.col("snapshot_date") >= F.lit(since))
        for commit in commits:
            replaced = sorted(r["snapshot_date"] for r in dates if r["commit"] == commit and r["replaced"])
            if replaced:
                found = found.filter((F.col("commit") != commit) | ~F.col("snapshot_date").isin(replaced))
        return found.select(*schema.names)

    def boxes(
        self, population: str, min_count: int = 1, since: date | None = None, stage: Staging | None = None, name: str = "boxes"
    ) -> DataFrame:
        """The box plots of a population, over all dates or those from ``since`` on."""
        keys = market.BOX_KEYS
        number = iter(range(100))

        def keep(df: DataFrame) -> DataFrame:
            return stage.table(df, f"{population}/{name}-{next(number)}")

        totals = merged_totals(self.stored("buckets", population, since), keys)
        values = self.stored("values", population, since).select(*keys, "_b0", "_v", "_n")
        summary = quantiles_by_rank(
            values, totals, keys, market.QUARTILES,
            keep=None if stage is None else keep,
            only=None if stage is None else only_wanted,
        )
        return summary if min_count <= 1 else summary.filter(F.col("count") >= min_count)

    def inputs(self, stage: Staging | None = None) -> gold.GoldInputs:
        """What the gold datasets start from."""
        trends = [self._trend(name, stage) for name in POPULATIONS]
        cells, anchor = trends[0].cells, trends[0].last
        latest = self._latest()
        start = None if anchor is None else _months_before(self._spark, anchor, self.params.window_months)
        recent = latest.filter(F.col("snapshot_date") >= F.lit(start).cast("date"))
        basis = gold.BasisInputs(cells, latest, recent, self.params)
        return gold.GoldInputs(trends[0], trends[1], basis)

    def _latest(self) -> DataFrame:
        commits = self.ledger.commits()
        if not commits:
            return self._spark.createDataFrame([], self.latest.schema)
        return self.latest.rows(commits[-1])

    def _trend(self, name: str, stage: Staging | None) -> "MaintainedTrend":
        cells = self.stored("cells", name)
        # the cells are small; a literal date prunes the partitions of the values
        last = cells.agg(F.max("snapshot_date")).first()[0]
        return MaintainedTrend(None, cells, F.lit(last).cast("date"), self.params, stage, name, self, last)


@dataclass(frozen=True)
class MaintainedTrend(gold.TrendInputs):
    """Inputs of a population whose box plots come from stored counts, not from listings."""

    state: GoldState | None = None
    last: date | None = None

    def boxes(self) -> DataFrame:
        return self.state.boxes(self.name, stage=self.stage)

    def recent_boxes(self) -> DataFrame:
        if self.last is None:
            return self.boxes()
        start = _months_before(self.state._spark, self.last, self.params.window_months)
        return self.state.boxes(self.name, self.params.min_count, start, self.stage, "recent")


RELEVANT = {
    **gold.RELEVANT,
    "boxplot_by_neighborhood": lambda t: t.boxes(),
    "boxplot_by_neighborhood_last_3m": lambda t: t.recent_boxes(),
}
GENERAL = {**gold.GENERAL, **RELEVANT}

_CELL_SCHEMA = T.StructType(
    [
        *[T.StructField(k, T.StringType()) for k in ("operation", "district", "neighborhood")],
        *[T.StructField(c, T.LongType()) for c in ("n_listings",)],
        *[
            T.StructField(f"{m}_{part}", kind)
            for m in ("priceByArea", "size", "price")
            for part, kind in (("sum", T.DoubleType()), ("n", T.LongType()))
        ],
        T.StructField("snapshot_date", T.DateType()),
    ]
)
_BOX_FIELDS = [T.StructField(k, T.StringType()) for k in market.BOX_KEYS]
_SCHEMAS = {
    "cells": _CELL_SCHEMA,
    "values": T.StructType(
        [*_BOX_FIELDS, T.StructField("_b0", T.LongType()), T.StructField("_v", T.DoubleType()),
         T.StructField("_n", T.LongType()), T.StructField("snapshot_date", T.DateType())]
    ),
    "buckets": T.StructType(
        [*_BOX_FIELDS, T.StructField("_b0", T.LongType()), T.StructField("_bn", T.LongType()),
         T.StructField("_lo", T.DoubleType()), T.StructField("_hi", T.DoubleType()), T.StructField("snapshot_date", T.DateType())]
    ),
}


def only_wanted(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows within a few ranges that cover the wanted buckets; files are in order of buckets.

    There are at most six wanted buckets a group, and groups are bounded by the map.
    """
    wanted = sorted(r[0] for r in chosen.select("_b0").distinct().collect())
    if not wanted:
        return rows.filter(F.lit(False))
    gaps = sorted(range(1, len(wanted)), key=lambda i: wanted[i - 1] - wanted[i])[: _RANGES - 1]
    bounds = [0, *sorted(gaps), len(wanted)]
    inside: Column = F.lit(False)
    for low, high in zip(bounds, bounds[1:]):
        inside = inside | F.col("_b0").between(wanted[low], wanted[high - 1])
    return rows.filter(inside)


def _months_before(spark: SparkSession, day: date, months: int) -> date:
    return spark.range(1).select(F.add_months(F.lit(day).cast("date"), -months)).first()[0]


def update_state(spark: SparkSession, silver_root: str, state: GoldState) -> list[Snapshot]:
    """Take in the snapshots that silver has and the state lacks; returns them.

    Of the history only the partitions of their dates are read.
    """
    todo = state.missing(silver_snapshots(spark, silver_root))
    if not todo:
        return []
    days = sorted({day for _, day in todo})
    rows = read_history(spark, silver_root).filter(F.col("snapshot_date").isin(days))
    state.absorb(rows, todo)
    return todo


def write_gold(
    spark: SparkSession, state: GoldState, root: str, generated_at: Column
) -> gold.GoldResult:
    """The gold tables and document from the state alone; the same as from the whole history."""
    with Staging(spark) as stage:
        datasets = gold.gold_datasets(state.inputs(stage), GENERAL, RELEVANT)
        return gold.write_datasets(spark, datasets, root, generated_at, state.params)
