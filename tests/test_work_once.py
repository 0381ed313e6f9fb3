"""Steps of the driver's queries that must be planned once, or in an order that sorts cheaply."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

import driver_queries
import driver_views as views
from casametra.operators import dedup

ROWS = {
    "region": [(0, "AFRICA")],
    "nation": [(0, "NATION_0", 0)],
    "supplier": [(1, "S", 0, 1.0)],
    "part": [(1, "P", "B", "T", 10, 9.0)],
    "lineitem": [
        (k, 1, 1, 1, 5.0, 20000.0, 0.01, 0.02, "N", status, datetime.datetime(2024, 1, 2))
        for k, status in enumerate("OFOF")
    ],
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, views.SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return root


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_incremental_query_takes_new_rows_from_pages_cleaned_once(spark, tables):
    fresh = driver_queries.silver_incremental(spark, tables)
    assert "l_orderkey" not in plan_of(fresh)
    assert [(r["operation"], r["n_rows"]) for r in fresh.collect()] == [("sale", 2)]


def test_a_damaged_page_is_put_together_once(spark, tables):
    pages = views.pages(spark, tables, damaged=True)
    assert pages._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
    whole = {r["page_file"]: r["body"] for r in views.pages(spark, tables).collect()}
    assert {r["page_file"]: r["body"] for r in pages.collect()} == whole


@pytest.mark.parametrize("keep", (dedup.first_per_snapshot, dedup.latest_per_property))
def test_dedups_compare_the_property_first(spark, tables, keep):
    rows = views.silver(spark, tables).withColumn("n", F.lit(1))
    assert "Sort [propertyCode" in plan_of(keep(rows, views.ORDER))
