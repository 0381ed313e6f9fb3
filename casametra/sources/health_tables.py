"""The three inputs of the health checks: run logs, request metrics and costs.

Each is a folder of JSON lines as log, metric and cost services export them. Fields that
an export lacks are null; a line that is no JSON stops the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casametra.functions.columns import iso_timestamp_or_text, log_timestamp
from casametra.schemas import COSTS_SCHEMA, INVOCATIONS_SCHEMA, REQUESTS_SCHEMA


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_invocations(spark: SparkSession, path: str) -> DataFrame:
    """Closing log lines: ``function_name``, ``ts``, ``duration_ms``, ``message``.

    Timestamps arrive as text. Text of another form gives no time, so the line is the
    oldest of its function; ``ts_text`` keeps what is shown of it.
    """
    raw = _lines(spark, path, "function_name string, timestamp string, duration_ms double, message string")
    columns = raw.select(
        "function_name", log_timestamp(F.col("timestamp")).alias("ts"), "duration_ms", "message",
        iso_timestamp_or_text(F.col("timestamp")).alias("ts_text"),
    )
    return columns.select(*[F.col(f.name).cast(f.dataType) for f in INVOCATIONS_SCHEMA], "ts_text")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Request counts by credential set and time."""
    raw = _lines(spark, path, "credential_set string, timestamp string, value double")
    return raw.select("credential_set", log_timestamp(F.col("timestamp")).alias("ts"), "value").select(
        *[F.col(f.name).cast(f.dataType) for f in REQUESTS_SCHEMA]
    )


def read_costs(spark: SparkSession, path: str) -> DataFrame:
    """Costs by day and service."""
    raw = _lines(spark, path, "day string, service string, amount string")
    return raw.select(*[F.col(f.name).try_cast(f.dataType) for f in COSTS_SCHEMA])
