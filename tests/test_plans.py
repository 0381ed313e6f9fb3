"""The shape of physical plans: what reaches the scan, what is shuffled."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

import driver_queries
from casametra.operators import dedup, filters
from casametra.operators.cells import CELL_KEYS
from casametra.plans.gold import gold_blocks
from casametra.sources import silver_table
from tests.conftest import day

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    from casametra.schemas import SILVER_SCHEMA

    names = SILVER_SCHEMA.fieldNames()
    rows = [
        {
            "operation": op, "district": "Extramurs", "neighborhood": "x", "propertyCode": str(i),
            "price": 1.0, "priceByArea": 2000.0, "size": 150.0, "snapshot_date": day(d),
            "_page_file": "f", "_page_pos": i, "_listing_operation": op,
        }
        for op in ("sale", "rent")
        for d in ("2023-01-01", "2023-05-01", "2023-06-01")
        for i in range(3)
    ]
    root = str(tmp_path_factory.mktemp("silver") / "table")
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SILVER_SCHEMA)
    silver_table.write_snapshots(df, root)
    return silver_table.read_history(spark, root)


def test_scope_and_relevance_reach_the_scan(history):
    plan = plan_of(filters.relevant(filters.in_scope(history)).select("price"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (\S+)", plan)
    assert "In(district" in pushed.group(1)
    assert "GreaterThan(size,120.0)" in pushed.group(1)
    assert "EqualTo(hasLift,true)" in pushed.group(1)
    assert "address" not in pushed.group(2) and "latitude" not in pushed.group(2)


def test_literal_window_prunes_partitions(history):
    anchor = F.lit(datetime.date(2023, 6, 1)).cast("date")
    recent = filters.in_window(history, 3, anchor)
    assert len(recent.inputFiles()) > 0
    plan = plan_of(recent)
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "snapshot_date" in partition_filters
    assert recent.count() == 12


def test_a_partition_is_one_file_when_small(history):
    assert len(history.inputFiles()) == 6


def test_dedups_limit_groups_before_the_shuffle(history):
    for keep in (dedup.first_per_snapshot, dedup.latest_per_property, dedup.last_per_property):
        plan = plan_of(keep(history))
        assert plan.count("WindowGroupLimit") == 2
        below = plan[plan.index("Exchange hashpartitioning") :]
        assert "WindowGroupLimit" in below


def test_dedup_shuffles_only_what_the_dataset_needs(history):
    blocks = gold_blocks(history)
    plan = plan_of(blocks["general"]["price_time_series_neighborhood"])
    schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert "latitude" not in schema and "floor" not in schema and "address" not in schema
    assert all(c in plan for c in CELL_KEYS)


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_no_query_has_a_cross_join_or_python_in_its_plan(spark, name):
    if name.startswith("gold_") or name in {"dashboard_figures", "health_document_statuses", "silver_job_run", "drop_redundant"}:
        pytest.skip("runs its job while it is built")
    if name in {"silver_history_roundtrip", "silver_incremental", "csv_roundtrip", "silver_ledger", "silver_empty_snapshot",
                "silver_refused_table", "latest_rows_state", "boxplot_merged", "boxplot_merged_last_3m", "locations_in_box"}:
        pytest.skip("writes while it is built")
    plan = plan_of(driver_queries.QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_run_summary_scans_and_shuffles_only_what_was_written(spark, history, tmp_path):
    from casametra.plans.silver import partition_counts

    silver_table.write_snapshots(history.withColumn("_listing_operation", F.col("operation")), str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    counts = partition_counts(stored, [("sale", day("2023-05-01")), ("rent", day("2023-06-01"))])
    plan = plan_of(counts)
    filters_ = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "operation" in filters_ and "snapshot_date" in filters_
    assert "2023-05-01" in filters_ and "2023-06-01" in filters_ and "2023-07-01" not in filters_
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "partial_count" in below
    assert {tuple(r) for r in counts.collect()} == {("sale", day("2023-05-01"), 3), ("rent", day("2023-06-01"), 3)}


def test_pages_of_an_operation_prune_its_partitions(spark, history, tmp_path):
    silver_table.write_snapshots(history.withColumn("_listing_operation", F.col("operation")), str(tmp_path / "t"))
    sale = silver_table.read_history(spark, str(tmp_path / "t"), pages_of=["sale"])
    assert "operation" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(sale)).group(1)
    assert {r.operation for r in sale.select("operation").collect()} == {"sale"}


def test_describe_shares_the_scans_of_its_values(history):
    from casametra.operators import profile

    df = profile.describe(history)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    # the listings for the moments; their values for the buckets and for the refinement
    assert "ReusedExchange" in final and final.count("FileScan") <= 3
