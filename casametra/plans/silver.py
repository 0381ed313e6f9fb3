"""The bronze-to-silver job.

What has been written stands in a ledger beside the history: the pages of each snapshot and
the rows that came of each. It is appended last, so a job that dies before is repeated as if
it had never run, and a run asks the ledger instead of listing the history's files.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casametra.operators.cleaning import to_stored
from casametra.operators.snapshots import (
    SNAPSHOT,
    latest_snapshots,
    snapshots_of,
    snapshots_on,
    unwritten,
)
from casametra.params import SalePriceBounds
from casametra.sources.bronze import (
    PAGES_PER_TASK,
    decode_keys,
    explode_elements,
    list_keys,
    open_folder,
    open_pages,
    scan_pages,
    skipped_keys,
    valid_keys,
)
from casametra.sources.ledger import Ledger
from casametra.sources.silver_table import write_snapshots, written_snapshots
from casametra.staging import Staging, scratch_dir

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("page_file", T.StringType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


@dataclass(frozen=True)
class CleaningResult:
    """What one run wrote: (operation, snapshot date, rows) of each partition.

    ``skipped_keys`` has the page keys that did not decode, ``skipped`` their number.
    """

    written: tuple[tuple[str, date, int], ...]
    snapshots_found: bool
    skipped: int = 0
    skipped_keys: DataFrame | None = None

    @property
    def rows_written(self) -> int:
        return sum(rows for _, _, rows in self.written)


def clean_snapshots(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    target_date: date | None = None,
    bounds: SalePriceBounds = SalePriceBounds(),
) -> CleaningResult:
    """Clean the latest snapshot of each operation, or those of one date.

    Snapshots that are in the silver history already are never rewritten.
    """
    return _run(spark, bronze_root, silver_root, bounds, target_date, everything=False)


def backfill(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    bounds: SalePriceBounds = SalePriceBounds(),
) -> CleaningResult:
    """Clean every snapshot that is not in the silver history yet, in one job."""
    return _run(spark, bronze_root, silver_root, bounds, None, everything=True)


def _run(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    bounds: SalePriceBounds,
    target_date: date | None,
    everything: bool,
) -> CleaningResult:
    try:
        keys = list_keys(spark, bronze_root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return CleaningResult((), snapshots_found=False)

    with Staging(spark) as stage:
        # Every page costs a look at its file: once a run, by as few tasks as keep all cores busy.
        few = keys.coalesce(4 * spark.sparkContext.defaultParallelism)
        decoded = stage.table(decode_keys(few), "keys")
        bad = _kept_keys(skipped_keys(decoded))
        n_bad = bad.count()
        chosen = snapshots_of(valid_keys(decoded))
        if target_date is not None:
            chosen = snapshots_on(chosen, target_date)
        elif not everything:
            chosen = latest_snapshots(chosen)

        ledger = snapshot_ledger(spark, silver_root)
        # One row per operation and snapshot date: as many as the calendar has.
        counts = unwritten(chosen, recorded_snapshots(ledger)).select(*SNAPSHOT, "pages").collect()
        todo = [(row["operation"], row["snapshot_date"]) for row in counts]
        if not todo:
            return CleaningResult((), not chosen.isEmpty(), n_bad, bad)

        if open_folder(spark, bronze_root) is None:
            pages = scan_pages(spark, bronze_root, todo)
        else:
            n_pages = sum(row["pages"] for row in counts)
            tasks = max(spark.sparkContext.defaultParallelism, -(-n_pages // PAGES_PER_TASK))
            pages = open_pages(valid_keys(decoded).filter(_of_snapshots(todo)), tasks)
        write_snapshots(to_stored(explode_elements(pages), bounds), silver_root)
        number = record_written(ledger, silver_root, valid_keys(decoded), todo)
    return CleaningResult(_committed_rows(ledger, number), True, n_bad, bad)


def _kept_keys(keys: DataFrame) -> DataFrame:
    """Keys as this run saw them, to be read until the session ends; no list of files stays with the result."""
    root = f"{scratch_dir(keys.sparkSession, 'skipped')}/keys"
    keys.write.parquet(root)
    return keys.sparkSession.read.schema(keys.schema).parquet(root)


def snapshot_ledger(spark: SparkSession, silver_root: str) -> Ledger:
    """The ledger of a history.

    A history that has none yet, from before there was one, is recorded as it stands.
    """
    ledger = Ledger(spark, silver_root, LEDGER_SCHEMA)
    if not ledger.commits():
        found = [tuple(r) for r in written_snapshots(spark, silver_root).select(*SNAPSHOT).collect()]
        if found:
            rows = partition_counts(spark.read.parquet(silver_root), found)
            ledger.append(rows.select(*SNAPSHOT, F.lit(None).alias("page_file"), F.col("count").alias("n_rows")), 1)
    return ledger


def recorded_snapshots(ledger: Ledger) -> DataFrame:
    """The snapshots that the ledger has rows of: operation, snapshot_date, pages, n_rows.

    One that was cleaned to nothing has none; its pages are tried again.
    """
    return (
        ledger.entries().groupBy(*SNAPSHOT)
        .agg(F.countDistinct("page_file").alias("pages"), F.sum("n_rows").alias("n_rows"))
        .filter(F.col("n_rows") > 0)
    )


def silver_snapshots(spark: SparkSession, silver_root: str) -> DataFrame:
    """The snapshots of a history by its ledger; by its file names where it has none."""
    ledger = Ledger(spark, silver_root, LEDGER_SCHEMA)
    if ledger.commits():
        return recorded_snapshots(ledger).select(*SNAPSHOT)
    return written_snapshots(spark, silver_root).select(*SNAPSHOT)


def record_written(
    ledger: Ledger, silver_root: str, keys: DataFrame, todo: Sequence[tuple[str, date]]
) -> int:
    """Append what was just written to the ledger; returns the number of the commit.

    ``keys`` are the decoded page keys, of which those of the snapshots ``todo`` count.
    """
    number = ledger.next()
    ledger.append(_page_rows(keys.sparkSession, silver_root, keys, todo), number)
    return number


def late_pages(spark: SparkSession, bronze_root: str, silver_root: str) -> DataFrame:
    """Pages that came after their snapshot had been written: operation, snapshot_date, page_file.

    A written snapshot is never rewritten, so no run takes these in.
    """
    entries = Ledger(spark, silver_root, LEDGER_SCHEMA).entries()
    named = entries.filter(F.col("page_file").isNotNull())
    keys = valid_keys(decode_keys(list_keys(spark, bronze_root)))
    pages = keys.select(*SNAPSHOT, F.substring_index("key", "/", -1).alias("page_file"))
    written = named.groupBy(*SNAPSHOT).agg(F.sum("n_rows").alias("n_rows")).filter(F.col("n_rows") > 0)
    return pages.join(written.select(*SNAPSHOT), list(SNAPSHOT)).join(
        named.select(*SNAPSHOT, "page_file"), [*SNAPSHOT, "page_file"], "left_anti"
    )


def _page_rows(
    spark: SparkSession, silver_root: str, keys: DataFrame, todo: Sequence[tuple[str, date]]
) -> DataFrame:
    """The pages of the snapshots just written, and the rows that came of each."""
    pages = keys.join(spark.createDataFrame([tuple(t) for t in todo], "operation string, snapshot_date date"), list(SNAPSHOT)).select(
        *SNAPSHOT, F.substring_index("key", "/", -1).alias("page_file")
    )
    try:
        stored = spark.read.parquet(silver_root)
    except AnalysisException as error:
        if error.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return pages.withColumn("n_rows", F.lit(0))
    rows = stored.filter(_of_snapshots(todo)).groupBy(*SNAPSHOT, F.col("_page_file").alias("page_file")).agg(
        F.count("*").alias("n_rows")
    )
    return pages.join(rows, [*SNAPSHOT, "page_file"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def _committed_rows(ledger: Ledger, number: int) -> tuple[tuple[str, date, int], ...]:
    """Row counts of the partitions that a commit names.

    A snapshot all of whose listings were dropped has no partition.
    """
    of_commit = ledger.entries().filter(F.col("commit") == number).groupBy(*SNAPSHOT).agg(F.sum("n_rows").alias("n"))
    return tuple(tuple(row) for row in of_commit.filter("n > 0").orderBy(*SNAPSHOT).collect())


def partition_counts(stored: DataFrame, todo: Sequence[tuple[str, date]]) -> DataFrame:
    """Rows of some partitions of the history.

    The partitions are named by literals, so that only theirs are scanned, and counted
    within each task: what is shuffled is a count, not a listing.
    """
    return stored.filter(_of_snapshots(todo)).groupBy(*SNAPSHOT).count().orderBy(*SNAPSHOT)


def _of_snapshots(todo: Sequence[tuple[str, date]]) -> Column:
    """Whether a row is of one of the snapshots, by literals."""
    days: dict[str, list[date]] = {}
    for operation, day in todo:
        days.setdefault(operation, []).append(day)
    wanted = F.lit(False)
    for operation, of_operation in days.items():
        wanted = wanted | (
            (F.col("operation") == operation) & F.col("snapshot_date").isin(of_operation)
        )
    return wanted
