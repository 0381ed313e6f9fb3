"""Queries against their oracle SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
import check_oracle
import driver_oracle
import driver_queries

SF = "/root/testdata/sf0.001"

SAMPLE = (
    "bronze_page_scan",
    "bronze_quality_profile",
    "silver_clean",
    "silver_history_roundtrip",
    "latest_snapshot",
    "unwritten_snapshots",
    "dedup_snapshot",
    "latest_by_property",
    "price_ts_neighborhood",
    "ratio_ts",
    "boxplot_all",
    "boxplot_last_3m",
    "price_hist",
    "location_grid",
    "describe_by_operation",
    "kpi_summary",
    "execution_success",
    "quota_series",
    "cost_history",
    "dashboard_figures",
    "silver_job_run",
    "gold_document",
    "drop_redundant",
    "request_accounting",
)


def test_every_query_has_an_oracle():
    assert set(driver_queries.QUERIES) == set(driver_oracle.oracle_sql())
    assert set(driver_queries.QUERIES) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:4] == ["operation", "district", "neighborhood", "snapshot_date"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duckdb():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_oracle(spark, duckdb, name):
    ok, detail = check_oracle.compare(spark, duckdb, SF, name)
    assert ok, detail
