"""Clean newly landed pages with a file stream.

The stream's checkpoint remembers which pages were read, so a run does not list
and compare the whole of bronze. Each run takes all pages that have landed and
stops. As in the batch job, a snapshot that is in the history already is left
alone: pages that land after their snapshot was cleaned are not added to it. Their names
are written to a table of refused pages, so that a later run of the batch job, or a
person, can find them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casametra.operators.cleaning import to_stored
from casametra.operators.snapshots import SNAPSHOT, snapshots_of, unwritten
from casametra.params import SalePriceBounds
from casametra.plans.silver import record_written, recorded_snapshots, snapshot_ledger
from casametra.schemas import PAGE_SCHEMA
from casametra.sources.bronze import decode_keys, explode_elements, valid_keys
from casametra.sources.silver_table import write_snapshots


def clean_new_pages(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    checkpoint: str,
    refused_root: str,
    bounds: SalePriceBounds = SalePriceBounds(),
) -> StreamingQuery:
    """Start a stream over the landed pages; it ends when they are cleaned.

    Pages of snapshots that are in the history go to ``refused_root``, one folder a batch.

    Each batch ends with its entry in the history's ledger; one that is repeated after a
    failure writes what has no entry yet.
    """
    pages = (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .json(bronze_root)
        .select("*", F.col("_metadata.file_name").alias("page_file"))
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ledger = snapshot_ledger(batch.sparkSession, silver_root)
        written = recorded_snapshots(ledger)
        keys = valid_keys(decode_keys(batch.select("page_file"), "page_file"))
        refused = keys.join(written.select(*SNAPSHOT), list(SNAPSHOT), "left_semi")
        refused.write.mode("overwrite").parquet(f"{refused_root}/batch={batch_id}")
        fresh = unwritten(snapshots_of(keys), written).select(*SNAPSHOT).collect()
        if not fresh:
            return
        stored = to_stored(explode_elements(batch), bounds)
        write_snapshots(unwritten(stored, written), silver_root)
        record_written(ledger, silver_root, keys.withColumnRenamed("page_file", "key"), fresh)

    return (
        pages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
