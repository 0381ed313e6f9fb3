"""Nested JSON documents: assembling, writing and version-checked reading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casametra.functions.columns import null_if_nan


def record_list(df: DataFrame) -> Column:
    """All rows of a small dataset as one sorted array of records.

    A scalar subquery. Records sort by their fields from left to right, and
    every dataset leads with its keys. NaN has no JSON form and becomes null.
    """
    fields = [
        null_if_nan(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema
    ]
    return df.agg(F.sort_array(F.collect_list(F.struct(*fields)))).scalar()


def block(datasets: Mapping[str, DataFrame], locations: Mapping[str, str] | None = None) -> Column:
    """A struct of datasets; those in ``locations`` are named by their place instead."""
    places = locations or {}
    return F.struct(
        *[
            (F.lit(places[name]) if name in places else record_list(df)).alias(name)
            for name, df in datasets.items()
        ]
    )


def document(spark: SparkSession, fields: Mapping[str, Column]) -> DataFrame:
    """A one-row DataFrame with the JSON text of a document in ``value``."""
    body = F.struct(*[column.alias(name) for name, column in fields.items()])
    return spark.range(1).select(
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value")
    )


def write_document(doc: DataFrame, path: str) -> None:
    """Write the document as a single text file in the folder ``path``."""
    doc.coalesce(1).write.mode("overwrite").text(path)


def read_document(
    spark: SparkSession, path: str, schema: T.StructType, versions: Sequence[str]
) -> DataFrame:
    """Read a document; raise ``ValueError`` on an unknown schema version."""
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    row = doc.select("schema_version").first()
    found = row[0] if row else None
    if found not in versions:
        raise ValueError(f"schema_version {found!r} is not one of {list(versions)}")
    return doc


def read_document_if_available(
    spark: SparkSession, path: str, schema: T.StructType, versions: Sequence[str]
) -> DataFrame | None:
    """Like ``read_document``, with None for a document that is missing, damaged or of another version."""
    try:
        return read_document(spark, path, schema, versions)
    except (PySparkException, ValueError):
        return None


def dataset(doc: DataFrame, block_name: str, name: str) -> DataFrame:
    """One dataset of a read document as rows.

    A dataset that is null in the document is an error, not an empty dataset. One that
    the document gives as a place is read from there.
    """
    kind = doc.schema[block_name].dataType[name].dataType
    if isinstance(kind, T.StringType):
        row = doc.select(F.col(block_name)[name]).first()
        if row is None or row[0] is None:
            raise ValueError(f"the document has no place of {block_name}.{name}")
        return doc.sparkSession.read.parquet(row[0])
    missing = F.raise_error(F.lit(f"the document has no {block_name}.{name}")).cast(kind)
    return doc.select(F.inline(F.coalesce(F.col(block_name)[name], missing)))
