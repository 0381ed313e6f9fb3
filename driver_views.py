"""The driver's tables seen as listings, raw pages and health inputs."""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from casametra.operators.cleaning import clean_elements
from casametra.params import HealthParams, MarketParams
from casametra.schemas import ELEMENT_SCHEMA

#: A total order over lineitem rows, in place of file name and position.
ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_shipdate",
    "l_returnflag",
)

MARKET = MarketParams(scope_districts=("AFRICA", "ASIA", "EUROPE"))

HEALTH = HealthParams(
    function_names=("click", "error", "purchase", "refund", "signup", "view"),
    credential_labels={"F": "filled", "O": "open", "P": "pending", "X": "unused"},
    quota_yellow_requests=60.0,
    quota_red_requests=75.0,
    cost_yellow=2.0e7,
    cost_red=1.0e8,
    excluded_services=("5-LOW",),
)

STAGES = {"bronze": "click", "silver": "view", "gold": "absent"}


#: Schemas of the tables in use, so that no job has to look them up.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing elements: one per lineitem row, some with missing values."""
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
        .join(table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey")
        .join(table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
        .join(table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    )
    priced = joined.selectExpr(
        "*",
        "if(l_linestatus = 'O', 'sale', 'rent') AS page_operation",
        "if(l_linestatus = 'O', l_extendedprice * 5D, l_extendedprice / 50D) AS price",
        "CAST(p_size * 4 AS double) AS size",
    )
    return priced.selectExpr(
        "if(l_tax <> 0D, page_operation, NULL) AS operation",
        "r_name AS province",
        "n_name AS municipality",
        "r_name AS district",
        "if(l_quantity = 49D, '', n_name) AS neighborhood",
        "if(l_quantity <> 48D, 39.4D + (l_partkey % 1000) / 10000D, NULL) AS latitude",
        "-0.4D + (l_partkey % 97) / 10000D AS longitude",
        "CAST(l_partkey % 1500 AS string) AS distance",
        "s_name AS address",
        "CAST(l_partkey AS string) AS propertyCode",
        "p_type AS propertyType",
        "price",
        "if(l_quantity <> 50D, price / size, NULL) AS priceByArea",
        "size",
        "if(l_linenumber <> 6, CAST(l_linenumber AS string), NULL) AS floor",
        "l_discount > 0.05D AS exterior",
        "CAST(p_size % 6 AS double) AS rooms",
        "if(l_discount <> 0D, CAST(l_linenumber % 4 AS double), NULL) AS bathrooms",
        "l_returnflag AS status",
        "l_tax = 0.08D AS newDevelopment",
        "l_returnflag <> 'A' AS hasLift",
        "if(l_linenumber = 2, '{\"hasParkingSpace\":true}', NULL) AS parkingSpace",
        "page_operation",
        "CAST(trunc(l_shipdate, 'MM') AS date) AS snapshot_date",
        *ORDER,
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_elements(elements(spark, sf_dir), order=ORDER)


def page_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys of raw pages, one per lineitem row, a part of them malformed."""
    line = F.col("l_linenumber")
    operation = (
        F.when(line == 7, "auction")
        .when(F.col("l_linestatus") == "O", "sale")
        .otherwise("rent")
    )
    day = F.when(line == 6, F.date_format("l_shipdate", "yyyy'13'dd")).otherwise(
        F.date_format("l_shipdate", "yyyyMMdd")
    )
    page = F.when(line == 5, "").otherwise(F.col("l_orderkey").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        F.format_string("bronze/%s_%s_120000_%s.json", operation, day, page).alias("key")
    )


def pages(spark: SparkSession, sf_dir: str, damaged: bool = False) -> DataFrame:
    """All elements as raw pages."""
    return paged(elements(spark, sf_dir), damaged)


def paged(elements_: DataFrame, damaged: bool = False) -> DataFrame:
    """Raw pages as JSON text, with 50 elements at most, as a search returns them.

    The elements of a snapshot are numbered within blocks of 2,000 order keys.
    If ``damaged``, some pages are cut off in the middle of the text.
    """
    names = ELEMENT_SCHEMA.fieldNames()
    block = ("block", "page_operation", "snapshot_date")
    position = F.row_number().over(Window.partitionBy(*block).orderBy(*ORDER)) - 1
    item = F.struct(F.col("position"), F.struct(*names).alias("element"))
    grouped = (
        elements_.withColumn("block", F.floor(F.col("l_orderkey") / 2000))
        .withColumn("position", position)
        .groupBy(*block, F.floor(F.col("position") / 50).cast("int").alias("actualPage"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    body = F.to_json(
        F.struct(
            F.transform("items", lambda i: i["element"]).alias("elementList"),
            F.size("items").alias("total"),
            "actualPage",
        )
    )
    cut_off = F.lit(damaged) & ((F.col("block") + F.col("actualPage")) % 7 == 3)
    # a column first, so that each page is put together once
    return grouped.withColumn("body", body).select(
        F.format_string(
            "%s_%s_120000_%d.json",
            "page_operation",
            F.date_format("snapshot_date", "yyyyMMdd"),
            F.col("block") * 100000 + F.col("actualPage"),
        ).alias("page_file"),
        F.when(cut_off, F.expr("substr(body, 1, length(body) - 1)")).otherwise(F.col("body")).alias("body"),
    )


def invocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("function_name"),
        "ts",
        (F.col("value") * 1000.0).alias("duration_ms"),
        F.when(F.col("user_id") % 29 == 0, "REPORT Status: ERROR")
        .when(F.col("user_id") % 31 == 0, "START")
        .otherwise("REPORT")
        .alias("message"),
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page calls: one per lineitem row; some failed, some of an unknown operation."""
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.when(line == 7, "auction").when(F.col("l_linestatus") == "O", "sale").otherwise("rent").alias("operation"),
        F.col("l_shipdate").alias("ts"),
        (~line.isin(5, 6)).alias("succeeded"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("credential_set"),
        F.col("o_orderdate").alias("ts"),
        F.lit(1.0).alias("value"),
    )


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("day"),
        F.col("o_orderpriority").alias("service"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
    )


def land_pages(spark: SparkSession, sf_dir: str, root: str) -> None:
    """The pages as files with their own names, and two files whose names don't decode."""
    land(pages(spark, sf_dir), root)


def land(pages_: DataFrame, root: str) -> None:
    """Pages as files of their own, and two files whose names don't decode.

    In a folder that tasks can open as files they write the pages themselves; elsewhere Spark's
    text writer makes a folder of each page, whose file the driver then renames.
    """
    spark = pages_.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(root))
    if fs.getUri().getScheme() == "file":
        write_files(pages_, path(root).toUri().getPath())
    else:
        rename_files(pages_, root, fs)
    for name in ("sale_20231301_120000_1.json", "auction_20230101_120000_1.json"):
        out = fs.create(path(f"{root}/{name}"))
        out.writeBytes("{}")
        out.close()


def write_files(pages_: DataFrame, folder: str) -> None:
    """A file for each page name, a line for each of its rows, which are all in one task.

    A file gets its name when it is whole, so that a task may be repeated. Until then it is in a
    folder of its task, as tasks that make files in one folder wait for each other.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = f"{folder}/.{uuid.uuid4().hex}"
        os.mkdir(own)
        rows = (row for b in batches for row in zip(b["page_file"].to_pylist(), b["body"].cast(pa.binary())))
        for name, of_name in itertools.groupby(rows, key=lambda row: row[0]):
            with open(f"{own}/{name}", "wb") as out:
                for _, body in of_name:
                    out.write(body.as_buffer() or b"")
                    out.write(b"\n")
            os.replace(f"{own}/{name}", f"{folder}/{name}")
        os.rmdir(own)
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], ["page_file"])

    pages_.select("page_file", "body").sortWithinPartitions("page_file").mapInArrow(write, "page_file string").count()


def rename_files(pages_: DataFrame, root: str, fs: JavaObject) -> None:
    path = pages_.sparkSession._jvm.org.apache.hadoop.fs.Path
    landed = f"{root}-landing"
    pages_.write.partitionBy("page_file").text(landed)
    for folder in fs.listStatus(path(landed)):
        name = folder.getPath().getName()
        if not name.startswith("page_file="):
            continue
        for part in fs.listStatus(folder.getPath()):
            fs.rename(part.getPath(), path(f"{root}/{name.removeprefix('page_file=')}"))
    fs.delete(path(landed), True)
