"""Raw listing pages: file names, page scans and the explode to elements."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casametra.schemas import CORRUPT_COLUMN, ELEMENT_SCHEMA, PAGE_SCHEMA

# Fixed value: the page file name, "{operation}_{YYYYMMDD}_{HHMMSS}_{page}.json".
PAGE_NAME_PATTERN = r"^(rent|sale)_(\d{8})_(\d{6})_(\d+)\.json$"

_PAGE_WITH_CORRUPT = T.StructType(
    [*PAGE_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())]
)


#: Pages that one task opens, and bytes of pages that go to Spark at once.
PAGES_PER_TASK, BATCH_BYTES = 1000, 4 << 20


def open_folder(spark: SparkSession, root: str) -> str | None:
    """The path of ``root`` where it is a folder that tasks can open as files, else None.

    Spark's own readers hold the status of each file in the driver, about a kilobyte, and deal a few
    pages to a task, as each file counts as four megabytes. In a local or mounted folder the
    tasks do the listing and the reading, so that neither grows in the driver.
    """
    if any(c in root for c in "{}[]*?\\"):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file" or not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return None
    return fs.makeQualified(path).toUri().getPath()


def list_keys(spark: SparkSession, root: str) -> DataFrame:
    """One row per JSON file under ``root``; no file content is read."""
    folder = open_folder(spark, root)
    if folder is not None:
        return _keys_by_tasks(spark, folder)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(F.col("path").alias("key"))
    )


def _keys_by_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as Spark's reader finds: one task looks into the folder, many into those below."""

    def hidden(name: str) -> bool:
        return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)

    def within(top: str, deep: bool) -> Iterator[tuple[str, bool]]:
        with os.scandir(top) as found:
            for entry in found:
                if hidden(entry.name):
                    continue
                if not entry.is_dir():
                    if entry.name.endswith(".json"):
                        yield os.fsencode(entry.path).decode("utf-8", "replace"), False
                elif deep:
                    yield from within(entry.path, deep)
                else:
                    yield entry.path, True

    def listed(batches: Iterator[pa.RecordBatch], deep: bool) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, bool]] = []

        def batch() -> pa.RecordBatch:
            paths, folders = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(folders, pa.bool_())], ["path", "folder"])

        for given in batches:
            for path, is_folder in zip(given["path"].to_pylist(), given["folder"].to_pylist()):
                for row in within(path, deep) if is_folder else [(path, False)]:
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield batch()
                        rows.clear()
        yield batch()

    schema = "path string, folder boolean"
    top = spark.range(0, 1, 1, 1).select(F.lit(folder).alias("path"), F.lit(True).alias("folder"))
    found = top.mapInArrow(lambda batches: listed(batches, False), schema)
    spread = found.repartition(4 * spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(lambda batches: listed(batches, True), schema).select(F.concat(F.lit("file:"), "path").alias("key"))


def decode_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """Add ``operation``, ``snapshot_date`` and ``page`` decoded from a key.

    Only the last path component counts. A key with another shape, an unknown
    operation or an impossible calendar date gets nulls in all three columns.
    """
    name = F.substring_index(F.col(key), "/", -1)

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(name, PAGE_NAME_PATTERN, group), F.lit(""))

    day = F.try_to_date(part(2), "yyyyMMdd")
    return df.withColumns(
        {
            "operation": F.when(day.isNotNull(), part(1)),
            "snapshot_date": day,
            "page": F.when(day.isNotNull(), part(4).try_cast("bigint")),
        }
    )


def valid_keys(decoded: DataFrame) -> DataFrame:
    """Keep the keys that decode; the others are skipped."""
    return decoded.filter(F.col("operation").isNotNull())


def skipped_keys(decoded: DataFrame, key: str = "key") -> DataFrame:
    """The keys that ``valid_keys`` drops, for the run log."""
    return decoded.filter(F.col("operation").isNull()).select(key)


def scan_pages(
    spark: SparkSession,
    root: str,
    snapshots: Iterable[tuple[str, date]] | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read page files; one row per page, with its file name.

    ``snapshots`` limits the scan to the pages of some snapshots. The limit is
    a predicate on the file name, which prunes files before any is opened.
    ``FAILFAST`` stops on a malformed page; ``PERMISSIVE`` returns such a page
    with its text in the corrupt-record column and no elements.
    """
    schema = _PAGE_WITH_CORRUPT if mode == "PERMISSIVE" else PAGE_SCHEMA
    reader = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", mode)
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
    )
    pages = reader.json(root)
    if snapshots is not None:
        prefixes = [f"{op}_{day:%Y%m%d}" for op, day in snapshots]
        pages = pages.filter(
            F.substring_index(F.col("_metadata.file_name"), "_", 2).isin(prefixes)
        )
    return pages.select("*", F.col("_metadata.file_name").alias("page_file"))


def open_pages(keys: DataFrame, tasks: int) -> DataFrame:
    """Pages by the keys of ``open_folder``'s files, in the shape of ``scan_pages``.

    As many ``tasks`` open the files, stopping at a malformed one. Keys of one snapshot lie in few tasks.
    """

    def text(page: bytes) -> bytes:
        encoding = json.detect_encoding(page)
        return page if encoding == "utf-8" else page.decode(encoding).encode()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        bodies: list[bytes] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary()).cast(pa.string())], ["page_file", "body"])

        size = 0
        for given in batches:
            for key in given["key"].to_pylist():
                with open(key.removeprefix("file:"), "rb") as page:
                    bodies.append(text(page.read()))
                names.append(key.rpartition("/")[2])
                size += len(bodies[-1])
                if size >= BATCH_BYTES:
                    yield batch()
                    names.clear()
                    bodies.clear()
                    size = 0
        yield batch()

    dealt = keys.repartitionByRange(tasks, "operation", "snapshot_date", "key").select("key")
    bodies = dealt.mapInArrow(opened, "page_file string, body string")
    # a file may hold one page or, as for Spark's reader, a list of them
    pages = F.from_json("body", T.ArrayType(PAGE_SCHEMA), {"mode": "FAILFAST"})
    return bodies.select(F.explode(pages).alias("_page"), "page_file").select("_page.*", "page_file")


def parse_pages(
    df: DataFrame, body: str = "body", page_file: str = "page_file", mode: str = "FAILFAST"
) -> DataFrame:
    """Parse pages that arrive as text in a column, in the shape of ``scan_pages``."""
    schema = _PAGE_WITH_CORRUPT if mode == "PERMISSIVE" else PAGE_SCHEMA
    parsed = F.from_json(F.col(body), schema, {"mode": mode})
    page = F.struct(parsed.alias("_page"), F.col(page_file).alias("page_file"))
    # As a generator the parser runs once, however many columns are used later,
    # and rules on page names are checked per page, not on what pages are made of.
    return df.select(F.inline(F.array(page))).select("_page.*", "page_file")


def explode_elements(pages: DataFrame) -> DataFrame:
    """One row per listing element of pages whose names decode.

    Columns: the element's own columns, ``page_operation``, ``snapshot_date``
    and the position of the element (``_page_file``, ``_page_pos``). A page
    without an element list gives no rows.
    """
    decoded = valid_keys(decode_keys(pages, "page_file"))
    exploded = decoded.select(
        F.col("operation").alias("page_operation"),
        "snapshot_date",
        F.col("page_file").alias("_page_file"),
        F.posexplode("elementList").alias("_page_pos", "_element"),
    )
    return exploded.select(
        *[F.col("_element")[name].alias(name) for name in ELEMENT_SCHEMA.fieldNames()],
        "page_operation",
        "snapshot_date",
        "_page_file",
        "_page_pos",
    )


def quality_profile(pages: DataFrame) -> DataFrame:
    """Quality counters over pages read in ``PERMISSIVE`` mode, in one row.

    Counts pages that parse and pages that do not, all elements, and elements
    without a price per area, a neighborhood or an operation, the latter also
    as percentages (null when there are no elements).
    """
    failed = F.col(CORRUPT_COLUMN).isNotNull()
    elements = F.when(~failed, F.col("elementList"))

    def count_where(condition) -> Column:
        return F.coalesce(F.sum(F.size(F.filter(elements, condition))), F.lit(0)).cast("bigint")

    counts = pages.agg(
        F.count_if(~failed).alias("files_scanned"),
        F.count_if(failed).alias("files_failed"),
        count_where(lambda e: F.lit(True)).alias("total_elements"),
        count_where(lambda e: e["priceByArea"].isNull()).alias("null_price_by_area"),
        count_where(
            lambda e: e["neighborhood"].isNull() | (e["neighborhood"] == "")
        ).alias("missing_neighborhood"),
        count_where(lambda e: e["operation"].isNull()).alias("missing_operation"),
    )
    percent = {
        f"{name}_pct": F.try_divide(F.col(name) * 100.0, F.col("total_elements"))
        for name in ("null_price_by_area", "missing_neighborhood", "missing_operation")
    }
    return counts.withColumns(percent)


def failed_pages(pages: DataFrame) -> DataFrame:
    """Names of the pages that did not parse.

    File scans refuse a query on the corrupt-record column alone, hence the
    second condition, which always holds.
    """
    any_size = F.coalesce(F.size("elementList"), F.lit(0)) >= -1
    return pages.filter(F.col(CORRUPT_COLUMN).isNotNull() & any_size).select("page_file")
