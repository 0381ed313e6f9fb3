"""Traffic-light rollups over run logs, request counts and costs.

``now`` is always a column, so that a check can be anchored to a fixed moment,
to the clock, or to the latest row of the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from casametra.functions.columns import (
    GREEN,
    month_key,
    month_start,
    severity,
    status_name,
    traffic_light,
)
from casametra.params import (
    CREDENTIAL_SET_BY_OPERATION,
    FAILURE_PATTERN,
    INVOCATION_PATTERN,
    STAGE_FUNCTIONS,
    HealthParams,
)

_DEFAULTS = HealthParams()


def _names(spark: SparkSession, column: str, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


# --- executions -------------------------------------------------------------


def recent_invocations(
    invocations: DataFrame,
    now: Column,
    params: HealthParams = _DEFAULTS,
) -> DataFrame:
    """The last few invocations of each function, ``recency`` 1 the newest.

    Only log lines that close an invocation count, and only those within the
    lookback. An invocation succeeded when its line shows no sign of failure.
    Of lines with one timestamp, failures count as newer, then longer ones, so
    that the rows alone decide and never their order. Lines without a readable time
    are the oldest, so they count only where dated lines leave room in the window. They are
    not held against the lookback: an export has the lines of a time range that its
    query names. ``ts_text``, if there is such a column, is what is shown of them.
    """
    lookback = F.make_dt_interval(F.lit(params.lookback_days))
    newest_first = [
        F.col("ts").desc_nulls_last(),
        F.col("message").rlike(FAILURE_PATTERN).desc(),
        F.col("duration_ms").desc_nulls_last(),
        F.col("message"),
    ]
    recency = F.row_number().over(Window.partitionBy("function_name").orderBy(*newest_first))
    return (
        invocations.filter(F.col("message").contains(INVOCATION_PATTERN))
        .filter(F.col("ts").isNull() | ((F.col("ts") >= now - lookback) & (F.col("ts") <= now)))
        .withColumn("recency", recency)
        .filter(F.col("recency") <= params.history_window)
        .select(
            "function_name",
            "recency",
            "ts",
            *[c for c in ("ts_text",) if c in invocations.columns],
            (~F.col("message").rlike(FAILURE_PATTERN)).alias("succeeded"),
            (F.coalesce("duration_ms", F.lit(0.0)) / 1000.0).alias("duration_seconds"),
        )
    )


def _per_function(
    recent: DataFrame, function_names: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Aggregate recent invocations for the listed functions, absent ones too."""
    found = recent.groupBy("function_name").agg(
        F.count("*").alias("invocations_checked"), *measures
    )
    listed = _names(recent.sparkSession, "function_name", function_names)
    return listed.join(found, "function_name", "left").withColumn(
        "invocations_checked", F.coalesce("invocations_checked", F.lit(0))
    )


def execution_success(recent: DataFrame, params: HealthParams = _DEFAULTS) -> DataFrame:
    """Did the last invocations of each function succeed?

    Red when the latest failed, yellow when an earlier one did or when there is
    none at all, green otherwise. A short history is flagged unless a failure
    decides the status.
    """
    failed = ~F.col("succeeded")
    checked = _per_function(
        recent,
        params.function_names,
        [
            F.bool_or((F.col("recency") == 1) & failed).alias("latest_failed"),
            F.bool_or((F.col("recency") > 1) & failed).alias("earlier_failed"),
        ],
    )
    none = F.col("invocations_checked") == 0
    short = F.col("invocations_checked") < params.history_window
    status = traffic_light(F.col("latest_failed"), none | F.col("earlier_failed"))
    return checked.select(
        "function_name",
        status.alias("status"),
        "invocations_checked",
        (none | (short & (status == GREEN))).alias("insufficient_history"),
    )


def execution_duration(recent: DataFrame, params: HealthParams = _DEFAULTS) -> DataFrame:
    """How long did the last invocations of each function take, at most?"""
    checked = _per_function(
        recent,
        params.function_names,
        [F.max("duration_seconds").alias("max_duration_seconds")],
    )
    longest = F.col("max_duration_seconds")
    none = F.col("invocations_checked") == 0
    return checked.select(
        "function_name",
        traffic_light(
            longest > params.duration_red_seconds,
            none | (longest >= params.duration_yellow_seconds),
        ).alias("status"),
        "invocations_checked",
        "max_duration_seconds",
        (F.col("invocations_checked") < params.history_window).alias("insufficient_history"),
    )


def invocation_series(recent: DataFrame) -> DataFrame:
    """The recent invocations of each function as one array, oldest first."""
    point = F.struct("ts", "recency", "succeeded", "duration_seconds")
    ordered = F.sort_array(F.collect_list(point))
    return recent.groupBy("function_name").agg(
        F.transform(
            ordered,
            lambda p: F.struct(
                p["ts"].alias("timestamp"),
                p["succeeded"].alias("succeeded"),
                p["duration_seconds"].alias("duration_seconds"),
            ),
        ).alias("points")
    )


# --- complete months --------------------------------------------------------


def _complete_months(now: Column, months: int) -> Column:
    """Starts of the last complete calendar months, oldest first."""
    this_month = month_start(now)
    first, last = F.add_months(this_month, -months), F.add_months(this_month, -1)
    return F.sequence(first, last, F.make_ym_interval(F.lit(0), F.lit(1)))


def _in_complete_months(day: Column, now: Column, months: int) -> Column:
    this_month = month_start(now)
    return (day >= F.add_months(this_month, -months)) & (day < this_month)


# --- request quota ----------------------------------------------------------


def requests_of_attempts(
    attempts: DataFrame, by_operation: Mapping[str, str] = CREDENTIAL_SET_BY_OPERATION
) -> DataFrame:
    """One request per attempted page, charged to the operation's credentials.

    ``attempts`` has the operation, the time ``ts`` and whether the page arrived
    (``succeeded``). A failed call uses up quota like any other. Attempts of an
    operation without credentials are charged to none.
    """
    credential_set: Column | None = None
    for operation, name in by_operation.items():
        case = (F.col("operation") == operation, F.lit(name))
        credential_set = (
            F.when(*case) if credential_set is None else credential_set.when(*case)
        )
    return attempts.select(
        credential_set.alias("credential_set"), "ts", F.lit(1.0).alias("value")
    )


def attempts_of_pages(pages: DataFrame, ts: Column) -> DataFrame:
    """Attempts whose pages landed, from their decoded keys.

    Without a log of the failed calls this is the least that was requested.
    """
    return pages.select("operation", ts.alias("ts"), F.lit(True).alias("succeeded"))


def monthly_requests(
    requests: DataFrame, now: Column, params: HealthParams = _DEFAULTS
) -> DataFrame:
    """Requests per credential set in each complete month, zero where none.

    The zero rows of every month join the counted rows before the final sum.
    """
    names = list(params.credential_labels)
    zero = _names(requests.sparkSession, "credential_set", names).select(
        "credential_set",
        F.explode(_complete_months(now, params.evaluation_months)).alias("month"),
        F.lit(0.0).alias("value"),
    )
    counted = requests.filter(
        F.col("credential_set").isin(names)
        & _in_complete_months(F.col("ts"), now, params.evaluation_months)
    ).select("credential_set", month_start(F.col("ts")).alias("month"), "value")
    return (
        zero.unionByName(counted)
        .groupBy("credential_set", "month")
        .agg(F.sum("value").alias("requests"))
        .withColumn("month", month_key(F.col("month")))
    )


def _credential_label(params: HealthParams) -> Column:
    label: Column = F.col("credential_set")
    for name, text in params.credential_labels.items():
        label = F.when(F.col("credential_set") == name, F.lit(text)).otherwise(label)
    return label


def api_quota(monthly: DataFrame, params: HealthParams = _DEFAULTS) -> DataFrame:
    """Status of each credential set by its busiest complete month."""
    busiest = F.max("requests")
    months = F.sort_array(F.collect_list(F.struct("month", "requests")))
    return monthly.groupBy("credential_set").agg(
        traffic_light(
            busiest >= params.quota_red_requests, busiest >= params.quota_yellow_requests
        ).alias("status"),
        F.first(_credential_label(params)).alias("label"),
        F.map_from_entries(months).alias("monthly_requests"),
        F.lit(params.quota_monthly_requests).alias("quota"),
    )


def quota_series(quota: DataFrame) -> DataFrame:
    """Months and values of each credential set, months ascending."""
    entries = F.sort_array(F.map_entries("monthly_requests"))
    return quota.select(
        "credential_set",
        "label",
        "quota",
        F.transform(entries, lambda e: e["key"]).alias("months"),
        F.transform(entries, lambda e: e["value"]).alias("values"),
    )


# --- cost -------------------------------------------------------------------


def month_to_date_cost(
    costs: DataFrame, now: Column, params: HealthParams = _DEFAULTS
) -> DataFrame:
    """Cost of the current month before today, in one row.

    On the first of a month the window is the whole month. Excluded services
    are summed apart and do not count toward the status.
    """
    today, start = F.to_date(now), month_start(now)
    end = F.when(today <= start, F.add_months(start, 1)).otherwise(today)
    excluded = F.col("service").isin(*params.excluded_services)
    zero = F.lit(0).cast("decimal(18,2)")

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("amount"))), zero)

    month = costs.filter((F.col("day") >= start) & (F.col("day") < end)).agg(
        total(~excluded).alias("included"),
        total(excluded).alias("excluded"),
        F.sort_array(F.collect_set(F.when(excluded, F.col("service")))).alias(
            "excluded_services"
        ),
    )
    return month.select(
        traffic_light(
            F.col("included") >= params.cost_red, F.col("included") >= params.cost_yellow
        ).alias("status"),
        F.bround("included", 2).alias("included_total"),
        F.bround("excluded", 2).alias("excluded_total"),
        "excluded_services",
    )


def cost_by_month_and_service(
    costs: DataFrame, now: Column, params: HealthParams = _DEFAULTS
) -> DataFrame:
    """Cost of each service that counts, in each complete month."""
    return (
        costs.filter(
            _in_complete_months(F.col("day"), now, params.evaluation_months)
            & ~F.col("service").isin(*params.excluded_services)
        )
        .groupBy(month_key(F.col("day")).alias("month"), "service")
        .agg(F.bround(F.sum("amount"), 2).alias("amount"))
    )


def cost_history(
    costs: DataFrame, now: Column, params: HealthParams = _DEFAULTS
) -> DataFrame:
    """One row per complete month, with a map of cost by service.

    A month without costs has an empty map.
    """
    counted = cost_by_month_and_service(costs, now, params)
    months = costs.sparkSession.range(1).select(
        F.explode(_complete_months(now, params.evaluation_months)).alias("month")
    )
    entry = F.struct("service", "amount")
    every_month = months.select(month_key(F.col("month")).alias("month")).join(
        counted, "month", "left"
    )
    return every_month.groupBy("month").agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.when(F.col("service").isNotNull(), entry)))
        ).alias("services")
    )


def cost_matrix(by_service: DataFrame, services: Sequence[str] | None = None) -> DataFrame:
    """Months by services, zero where a service cost nothing.

    The services are looked up first when they are not given.
    """
    pivot = by_service.groupBy("month").pivot("service", list(services) if services else None)
    return pivot.agg(F.sum("amount")).na.fill(0)


# --- composition ------------------------------------------------------------


def worst_status(statuses: DataFrame) -> DataFrame:
    """The worst status of a non-empty DataFrame, in one row."""
    worst = F.min(severity(F.col("status")))
    return statuses.agg(
        F.when(worst.isNull(), F.raise_error(F.lit("no status to compose")))
        .otherwise(status_name(worst))
        .alias("status")
    )


def stage_statuses(
    success: DataFrame, duration: DataFrame, stages: Mapping[str, str] = STAGE_FUNCTIONS
) -> DataFrame:
    """Worst known status of each stage over both execution checks.

    A stage whose function neither check knows is ``unknown``.
    """
    both = success.select("function_name", "status").unionByName(
        duration.select("function_name", "status")
    )
    worst = both.groupBy("function_name").agg(F.min(severity(F.col("status"))).alias("_worst"))
    listed = success.sparkSession.createDataFrame(
        list(stages.items()), "stage string, function_name string"
    )
    return listed.join(worst, "function_name", "left").select(
        "stage", "function_name", status_name(F.col("_worst")).alias("status")
    )
