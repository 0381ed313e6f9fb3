import datetime
import json

import pytest
from pyspark.sql import functions as F

from casametra.operators import health
from casametra.params import HealthParams
from casametra.plans.health import checks, health_document, read_health, write_health
from casametra.schemas import COSTS_SCHEMA, INVOCATIONS_SCHEMA, REQUESTS_SCHEMA
from tests.conftest import day, records

NOON = datetime.datetime(2026, 6, 15, 12)


def now():
    return F.lit(NOON)


ONE = HealthParams(function_names=("fn",))


@pytest.fixture
def runs(spark):
    """Invocations of ``fn``, newest first, one hour apart."""

    def build(*outcomes, name="fn"):
        rows = [
            (name, NOON - datetime.timedelta(hours=i), seconds * 1000.0, message)
            for i, (seconds, message) in enumerate(outcomes)
        ]
        return spark.createDataFrame(rows, INVOCATIONS_SCHEMA)

    return build


OK, BAD = (10.0, "REPORT"), (10.0, "REPORT Task timed out")


@pytest.mark.parametrize(
    "outcomes, status, short",
    [
        ([], "yellow", True),
        ([OK] * 5, "green", False),
        ([OK] * 4, "green", True),
        ([BAD, OK, OK, OK, OK], "red", False),
        ([BAD], "red", False),
        ([OK, BAD, OK, OK, OK], "yellow", False),
        ([OK, BAD], "yellow", False),
        ([OK] * 5 + [BAD], "green", False),
    ],
)
def test_execution_success(runs, outcomes, status, short):
    recent = health.recent_invocations(runs(*outcomes), now(), ONE)
    (row,) = records(health.execution_success(recent, ONE))
    assert (row["status"], row["insufficient_history"]) == (status, short)
    assert row["invocations_checked"] == min(5, len(outcomes))


@pytest.mark.parametrize(
    "seconds, status",
    [(59.999, "green"), (60.0, "yellow"), (120.0, "yellow"), (120.001, "red")],
)
def test_execution_duration_bounds(runs, seconds, status):
    recent = health.recent_invocations(runs(OK, (seconds, "REPORT")), now(), ONE)
    (row,) = records(health.execution_duration(recent, ONE))
    assert row["status"] == status
    assert row["max_duration_seconds"] == pytest.approx(seconds)


def test_only_closing_lines_within_the_lookback_count(spark):
    old = NOON - datetime.timedelta(days=30, seconds=1)
    edge = NOON - datetime.timedelta(days=30)
    rows = [
        ("fn", NOON, 1000.0, "START"),
        ("fn", NOON + datetime.timedelta(seconds=1), 1000.0, "REPORT"),
        ("fn", edge, None, "REPORT Process exited before completing request"),
        ("fn", old, 1000.0, "REPORT"),
    ]
    recent = health.recent_invocations(spark.createDataFrame(rows, INVOCATIONS_SCHEMA), now())
    (row,) = records(recent)
    assert (row["ts"], row["succeeded"], row["duration_seconds"]) == (edge, False, 0.0)


def test_invocation_series_is_oldest_first(runs):
    recent = health.recent_invocations(runs((1.0, "REPORT"), (2.0, "REPORT ERROR")), now())
    (row,) = records(health.invocation_series(recent))
    assert [(p["duration_seconds"], p["succeeded"]) for p in row["points"]] == [
        (2.0, False), (1.0, True)
    ]


def requests(spark, *rows):
    return spark.createDataFrame(
        [(name, datetime.datetime.combine(day(d), datetime.time(8)), float(n)) for name, d, n in rows],
        REQUESTS_SCHEMA,
    )


@pytest.mark.parametrize(
    "n, status", [(79, "green"), (80, "yellow"), (94, "yellow"), (95, "red")]
)
def test_quota_thresholds(spark, n, status):
    monthly = health.monthly_requests(requests(spark, ("sale_requests", "2026-03-31", n)), now())
    by_name = {r["credential_set"]: r for r in records(health.api_quota(monthly))}
    assert by_name["sale_requests"]["status"] == status
    assert by_name["sale_requests"]["label"] == "sale"
    assert by_name["rent_requests"]["status"] == "green"
    assert list(by_name["rent_requests"]["monthly_requests"].values()) == [0.0] * 5


def test_quota_counts_complete_months_only(spark):
    monthly = health.monthly_requests(
        requests(
            spark,
            ("sale_requests", "2026-06-01", 500),
            ("sale_requests", "2025-12-31", 500),
            ("sale_requests", "2026-01-01", 3),
            ("sale_requests", "2026-01-31", 4),
            ("sale_requests", "2026-05-31", 5),
            ("other", "2026-05-31", 500),
        ),
        now(),
    )
    quota = health.api_quota(monthly)
    by_name = {r["credential_set"]: r for r in records(health.quota_series(quota))}
    assert set(by_name) == {"sale_requests", "rent_requests"}
    assert by_name["sale_requests"]["months"] == ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05"]
    assert by_name["sale_requests"]["values"] == [7.0, 0.0, 0.0, 0.0, 5.0]


def test_attempted_pages_are_charged_by_operation(spark):
    attempts = spark.createDataFrame(
        [("sale", NOON, True), ("sale", NOON, False), ("rent", NOON, True), ("auction", NOON, True)],
        "operation string, ts timestamp, succeeded boolean",
    )
    charged = health.requests_of_attempts(attempts).dropna(subset=["credential_set"])
    totals = charged.groupBy("credential_set").agg(F.sum("value").alias("n"))
    assert {r["credential_set"]: r["n"] for r in records(totals)} == {"sale_requests": 2.0, "rent_requests": 1.0}


def costs(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame([(day(d), s, Decimal(a)) for d, s, a in rows], COSTS_SCHEMA)


@pytest.mark.parametrize(
    "amount, status", [("1.99", "green"), ("2.00", "yellow"), ("4.99", "yellow"), ("5.00", "red")]
)
def test_cost_thresholds(spark, amount, status):
    row = health.month_to_date_cost(costs(spark, ("2026-06-01", "Compute", amount)), now()).first()
    assert row.status == status


def test_cost_window_ends_before_today_and_splits_excluded(spark):
    table = costs(
        spark,
        ("2026-05-31", "Compute", "100"),
        ("2026-06-01", "Compute", "1.25"),
        ("2026-06-14", "Storage", "0.50"),
        ("2026-06-14", "Amazon Registrar", "12"),
        ("2026-06-15", "Compute", "100"),
    )
    row = health.month_to_date_cost(table, now()).first()
    assert (float(row.included_total), float(row.excluded_total)) == (1.75, 12.0)
    assert (row.status, row.excluded_services) == ("green", ["Amazon Registrar"])
    first = F.lit(datetime.datetime(2026, 6, 1, 9))
    row = health.month_to_date_cost(table, first).first()
    assert float(row.included_total) == 101.75
    row = health.month_to_date_cost(table.limit(0), now()).first()
    assert (row.status, float(row.included_total), row.excluded_services) == ("green", 0.0, [])


def test_cost_history_and_matrix(spark):
    table = costs(
        spark,
        ("2026-01-01", "Compute", "1.00"),
        ("2026-01-31", "Compute", "0.50"),
        ("2026-05-02", "Storage", "2.00"),
        ("2026-05-02", "Amazon Registrar", "9"),
        ("2026-06-02", "Compute", "9"),
        ("2025-12-31", "Compute", "9"),
    )
    history = {r["month"]: r["services"] for r in records(health.cost_history(table, now()))}
    assert sorted(history) == ["2026-01", "2026-02", "2026-03", "2026-04", "2026-05"]
    assert {k: float(v) for k, v in history["2026-01"].items()} == {"Compute": 1.5}
    assert history["2026-02"] == {}
    assert {k: float(v) for k, v in history["2026-05"].items()} == {"Storage": 2.0}
    matrix = records(
        health.cost_matrix(health.cost_by_month_and_service(table, now())).orderBy("month")
    )
    assert [{k: v if k == "month" else float(v) for k, v in r.items()} for r in matrix] == [
        {"month": "2026-01", "Compute": 1.5, "Storage": 0.0},
        {"month": "2026-05", "Compute": 0.0, "Storage": 2.0},
    ]


def test_worst_status(spark):
    def worst(*names):
        return health.worst_status(spark.createDataFrame([(n,) for n in names], "status string"))

    assert worst("green", "yellow").first().status == "yellow"
    assert worst("green", "red", "yellow").first().status == "red"
    assert worst("green").first().status == "green"
    with pytest.raises(Exception, match="no status"):
        worst().first()


def test_stage_status_takes_the_worst_known(spark):
    schema = "function_name string, status string"
    success = spark.createDataFrame([("bronze-collector", "green"), ("silver-cleaner", "green")], schema)
    duration = spark.createDataFrame([("bronze-collector", "yellow")], schema)
    stages = {r["stage"]: r["status"] for r in records(health.stage_statuses(success, duration))}
    assert stages == {"bronze": "yellow", "silver": "green", "gold": "unknown"}


def test_document_isolates_a_failing_check(spark, runs):
    params = HealthParams(function_names=("fn", "absent"))
    named = checks(
        runs(OK, BAD),
        requests(spark, ("rent_requests", "2026-05-01", 80)),
        costs(spark, ("2026-06-02", "Compute", "1.50"), ("2026-04-02", "Compute", "3.10")),
        now(),
        params,
    )
    doc = json.loads(health_document(spark, named, NOON).first()[0])
    assert list(doc) == [
        "schema_version", "generated_at", "overall_status",
        "execution_success", "execution_duration", "api_quota", "aws_cost",
    ]
    assert (doc["schema_version"], doc["overall_status"]) == ("1.1", "yellow")
    fn = doc["execution_success"]["details"]["functions"]["fn"]
    assert [i["succeeded"] for i in fn["recent_invocations"]] == [True, False]
    assert fn["recent_invocations"][0]["timestamp"] == "2026-06-15T12:00:00"
    absent = doc["execution_duration"]["details"]["functions"]["absent"]
    assert absent == {"status": "yellow", "insufficient_history": True, "invocations_checked": 0}
    quota = doc["api_quota"]["details"]["credential_sets"]
    assert quota["rent_requests"]["monthly_requests"]["2026-05"] == 80.0
    history = doc["aws_cost"]["details"]["monthly_cost_by_service"]
    assert [m["month"] for m in history][0] == "2026-01" and len(history) == 5
    assert history[3]["services"] == {"Compute": 3.1}

    def broken():
        raise RuntimeError("no access")

    doc = json.loads(health_document(spark, {**named, "api_quota": broken}, NOON).first()[0])
    assert (doc["overall_status"], doc["api_quota"]["status"]) == ("red", "red")
    assert doc["api_quota"]["details"] == {"error": "no access", "error_type": "RuntimeError"}
    assert doc["aws_cost"]["status"] == "green"
    with pytest.raises(ValueError):
        health_document(spark, {}, NOON)


def test_written_document_is_read_back(spark, runs, tmp_path):
    named = checks(
        runs(OK), requests(spark), costs(spark, ("2026-04-02", "Compute", "3.10")), now(), ONE
    )
    path = write_health(spark, named, str(tmp_path), NOON)
    row = read_health(spark, path).first()
    assert row.overall_status == "green"
    assert row.execution_success.details.functions["fn"].insufficient_history
    assert row.api_quota.details.credential_sets["sale_requests"].monthly_requests["2026-01"] == 0.0
    assert row.aws_cost.details.monthly_cost_by_service[3].services == {"Compute": 3.1}
    assert read_health(spark, str(tmp_path / "none")) is None


def test_status_does_not_depend_on_the_order_of_rows(spark):
    """Eight lines with one timestamp, one of them failed."""
    lines = [("fn", NOON, 1000.0 * k, "REPORT ERROR" if k == 3 else "REPORT") for k in range(8)]
    found = set()
    for turn in (lines, lines[::-1], lines[4:] + lines[:4], lines[1::2] + lines[::2]):
        frame = spark.createDataFrame(turn, INVOCATIONS_SCHEMA).repartition(3)
        recent = health.recent_invocations(frame, now(), ONE)
        shown = tuple((r["recency"], r["duration_seconds"], r["succeeded"]) for r in recent.orderBy("recency").collect())
        (row,) = records(health.execution_success(recent, ONE))
        found.add((row["status"], shown))
    assert len(found) == 1
    assert found.pop()[0] == "red"


def test_health_tables_are_read_from_exports(spark, tmp_path):
    from casametra.sources.health_tables import read_costs, read_invocations, read_requests

    def export(name, *rows):
        (tmp_path / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
        return str(tmp_path / name)

    runs = read_invocations(spark, export(
        "runs.json",
        {"function_name": "fn", "timestamp": "2026-06-15 11:00:00.000", "duration_ms": 5.0, "message": "REPORT"},
        {"function_name": "fn", "timestamp": "yesterday", "message": "REPORT ERROR"},
    ))
    recent = health.recent_invocations(runs, now(), ONE)
    assert [(r["recency"], r["succeeded"], r["ts_text"]) for r in recent.orderBy("recency").collect()] == [
        (1, True, "2026-06-15T11:00:00"), (2, False, "yesterday"),
    ]
    named = checks(runs, read_requests(spark, export("r.json", {"credential_set": "sale_requests", "timestamp": "2026-05-01 00:00:00.0", "value": 80})),
                   read_costs(spark, export("c.json", {"day": "2026-06-01", "service": "Compute", "amount": "1.50"})), now(), ONE)
    doc = json.loads(health_document(spark, named, NOON).first()[0])
    stamps = [r["timestamp"] for r in doc["execution_success"]["details"]["functions"]["fn"]["recent_invocations"]]
    assert stamps == ["2026-06-15T11:00:00", "yesterday"]
    assert doc["api_quota"]["details"]["credential_sets"]["sale_requests"]["monthly_requests"]["2026-05"] == 80.0
    assert doc["aws_cost"]["details"]["included_total_usd"] == 1.5


def test_lines_without_a_readable_time_fill_what_dated_ones_leave(spark):
    """They are older than all dated lines, whatever the lookback is."""
    import datetime

    day = datetime.datetime(2026, 6, 1)
    rows = [("f", day - datetime.timedelta(days=k), 1000.0, "REPORT") for k in range(3)]
    rows += [("f", None, 2000.0 + k, "REPORT Status: ERROR") for k in range(4)] + [("g", None, 1.0, "REPORT")]
    df = spark.createDataFrame(rows, "function_name string, ts timestamp, duration_ms double, message string")
    found = health.recent_invocations(df, F.lit(day), HealthParams(history_window=5)).collect()
    of_f = sorted((r.recency, r.ts is not None, r.succeeded) for r in found if r.function_name == "f")
    assert of_f == [(1, True, True), (2, True, True), (3, True, True), (4, False, False), (5, False, False)]
    assert [(r.recency, r.ts) for r in found if r.function_name == "g"] == [(1, None)]


def test_cost_summary_names_what_it_leaves_out(spark):
    from casametra.plans.health import _cost_check

    spent = costs(spark, ("2026-06-01", "Compute", "1.50"))
    for services, end in ((("Domains",), "; not counted: Domains)"), ((), "so far)")):
        row = _cost_check(spent, now(), HealthParams(excluded_services=services)).first()
        assert row.summary.endswith(end)
