"""The health job: four checks, an overall status and one document."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casametra.functions.columns import (
    RED,
    SEVERITY,
    iso_timestamp,
    severity,
    sorted_by,
    status_name,
)
from casametra.operators import health
from casametra.params import HEALTH_SCHEMA_VERSION, READABLE_HEALTH_VERSIONS, HealthParams
from casametra.schemas import HEALTH_DOCUMENT_SCHEMA
from casametra.sources.documents import read_document_if_available, write_document

Check = Callable[[], DataFrame]


def _execution_check(
    title: str, per_function: DataFrame, recent: DataFrame, params: HealthParams
) -> DataFrame:
    """One row (status, summary, details) from a status per function."""
    invocation = F.struct(
        F.col("recency"),
        F.coalesce(
            iso_timestamp(F.col("ts")),
            F.col("ts_text") if "ts_text" in recent.columns else F.lit(None).cast("string"),
        ).alias("timestamp"),
        "succeeded",
        "duration_seconds",
    )
    newest_first = recent.groupBy("function_name").agg(
        F.transform(
            F.sort_array(F.collect_list(invocation)), lambda i: i.dropFields("recency")
        ).alias("recent_invocations")
    )
    measures = [c for c in per_function.columns if c == "max_duration_seconds"]
    detail = F.struct(
        "status",
        F.when(F.col("insufficient_history"), True).alias("insufficient_history"),
        "invocations_checked",
        *measures,
        "recent_invocations",
    )
    joined = per_function.join(newest_first, "function_name", "left")
    worst = status_name(F.min(severity(F.col("status"))))
    return joined.agg(
        worst.alias("status"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("function_name", detail.alias("detail"))))
        ).alias("functions"),
    ).select(
        "status",
        F.format_string(
            f"{title}: %s across {len(params.function_names)} function(s)", "status"
        ).alias("summary"),
        F.struct("functions").alias("details"),
    )


def _quota_check(monthly: DataFrame, params: HealthParams) -> DataFrame:
    per_set = health.api_quota(monthly, params)
    detail = F.struct("status", "label", "monthly_requests", "quota")
    return per_set.agg(
        status_name(F.min(severity(F.col("status")))).alias("status"),
        F.map_from_entries(
            sorted_by(
                F.collect_list(F.struct("credential_set", detail.alias("detail"))),
                "credential_set",
            )
        ).alias("credential_sets"),
    ).select(
        "status",
        F.format_string(
            f"API quota: %s across {len(params.credential_labels)} credential set(s)", "status"
        ).alias("summary"),
        F.struct(F.lit("global").alias("credential_scope"), "credential_sets").alias("details"),
    )


def _cost_check(costs: DataFrame, now: Column, params: HealthParams) -> DataFrame:
    history = health.cost_history(costs, now, params)
    by_month = history.agg(
        sorted_by(F.collect_list(F.struct("month", "services")), "month")
    )
    left_out = f"; not counted: {', '.join(params.excluded_services)}" if params.excluded_services else ""
    return health.month_to_date_cost(costs, now, params).select(
        "status",
        F.concat(
            F.format_string("Cost: %s ($%.2f this month so far", "status", F.col("included_total").cast("double")),
            F.lit(f"{left_out})"),
        ).alias("summary"),
        F.struct(
            F.col("included_total").cast("double").alias("included_total_usd"),
            F.col("excluded_total").cast("double").alias("excluded_total_usd"),
            "excluded_services",
            F.lit(list(params.excluded_services)).alias("excluded_services_configured"),
            by_month.scalar().alias("monthly_cost_by_service"),
        ).alias("details"),
    )


def checks(
    invocations: DataFrame,
    requests: DataFrame,
    costs: DataFrame,
    now: Column,
    params: HealthParams = HealthParams(),
) -> dict[str, Check]:
    """The four checks by name; each builds a one-row DataFrame when called."""

    def executions(title: str, operator) -> DataFrame:
        recent = health.recent_invocations(invocations, now, params)
        return _execution_check(title, operator(recent, params), recent, params)

    return {
        "execution_success": lambda: executions("Execution success", health.execution_success),
        "execution_duration": lambda: executions(
            "Execution duration", health.execution_duration
        ),
        "api_quota": lambda: _quota_check(
            health.monthly_requests(requests, now, params), params
        ),
        "aws_cost": lambda: _cost_check(costs, now, params),
    }


def _evaluate(name: str, check: Check) -> dict:
    """Run one check. A check that fails is red and says why.

    The result is a single row with a few records per monitored function.
    """
    try:
        row = check().select(F.to_json(F.struct("status", "summary", "details"))).first()
        return json.loads(row[0])
    except Exception as error:  # one failing check must not stop the others
        return {
            "status": RED,
            "summary": f"{name} check failed to evaluate: {error}",
            "details": {"error": str(error), "error_type": type(error).__name__},
        }


def health_document(
    spark: SparkSession,
    named_checks: dict[str, Check],
    generated_at: datetime,
) -> DataFrame:
    """The health document as one row of JSON text."""
    stamp = generated_at.isoformat()
    results = {
        name: {**_evaluate(name, check), "evaluated_at": stamp}
        for name, check in named_checks.items()
    }
    if not results:
        raise ValueError("a health document needs at least one check")
    worst = min((r["status"] for r in results.values()), key=SEVERITY.__getitem__)
    body = {
        "schema_version": HEALTH_SCHEMA_VERSION,
        "generated_at": stamp,
        "overall_status": worst,
        **results,
    }
    return spark.createDataFrame([(json.dumps(body),)], "value string")


def write_health(
    spark: SparkSession,
    named_checks: dict[str, Check],
    root: str,
    generated_at: datetime,
) -> str:
    """Evaluate the checks and write their document; returns its folder."""
    path = f"{root}/latest"
    write_document(health_document(spark, named_checks, generated_at), path)
    return path


def read_health(spark: SparkSession, path: str) -> DataFrame | None:
    """A written health document, or None when it cannot be had."""
    return read_document_if_available(
        spark, path, HEALTH_DOCUMENT_SCHEMA, READABLE_HEALTH_VERSIONS
    )
