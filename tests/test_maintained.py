"""Gold from maintained aggregates against the full run over the same history."""

import datetime

import pytest
from pyspark.sql import functions as F

from casametra.operators.dedup import latest_per_property
from casametra.operators.filters import in_scope
from casametra.params import MarketParams
from casametra.plans import gold, maintained
from casametra.schemas import SILVER_SCHEMA
from casametra.sources.latest_state import KEY, property_key
from casametra.sources.silver_table import read_history, write_snapshots
from tests.test_gold import STAMP, market_rows
from tests.test_plans import plan_of

SCHEMA = type(SILVER_SCHEMA)([f for f in SILVER_SCHEMA if f.name != "_listing_operation"])


@pytest.fixture(scope="module")
def rows(spark):
    names = SCHEMA.fieldNames()
    drawn = market_rows()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in drawn], SCHEMA).cache()


def dates_of(rows):
    return sorted(r[0] for r in rows.select("snapshot_date").distinct().collect())


def absorbed(spark, rows, root, batches, buckets=4):
    state = maintained.GoldState(spark, str(root), buckets=buckets)
    for days in batches:
        state.absorb(rows.filter(F.col("snapshot_date").isin(days)), [(None, d) for d in days])
    return state


def plain(df):
    columns = sorted(df.columns)

    def value(x):
        return round(x, 6) if isinstance(x, float) else x

    return sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=str)


ORDERS = {
    "backwards": lambda d: [d[5:], d[3:5], d[:3]],
    "late and again": lambda d: [d[3:], d[:2], [d[4]], [d[2]], [d[0], d[6]]],
}


@pytest.mark.parametrize("order", sorted(ORDERS))
def test_datasets_and_latest_rows_equal_the_full_run(spark, rows, tmp_path, order):
    state = absorbed(spark, rows, tmp_path / "state", ORDERS[order](dates_of(rows)))
    full = gold.gold_datasets(gold.gold_inputs(rows, MarketParams()))
    ours = gold.gold_datasets(state.inputs(), maintained.GENERAL, maintained.RELEVANT)
    assert ours.keys() == full.keys()
    for job, make in full.items():
        assert plain(ours[job]()) == plain(make()), job
    kept = state.latest.rows(state.ledger.commits()[-1])
    expected = latest_per_property(in_scope(rows)).select(*kept.columns)
    assert plain(kept) == plain(expected) and kept.count() > 50


def test_ties_null_keys_and_odd_names(spark, listings, tmp_path):
    day = datetime.date(2024, 1, 1)
    rows = listings(
        {"propertyCode": "1", "snapshot_date": day, "size": 100.0, "_page_pos": 1},
        {"propertyCode": "1", "snapshot_date": day, "size": 101.0, "_page_pos": 2},
        {"propertyCode": None, "snapshot_date": day, "size": 102.0},
        {"propertyCode": None, "operation": None, "snapshot_date": day, "size": 103.0},
        {"propertyCode": '{"a"|', "snapshot_date": day, "size": 104.0},
        {"propertyCode": "1", "operation": "rent", "snapshot_date": day, "size": 105.0},
        {"propertyCode": "1", "snapshot_date": datetime.date(2023, 1, 1), "size": 106.0, "_page_pos": 9},
        {"propertyCode": "2", "snapshot_date": datetime.date(2024, 2, 1), "size": None},
    )
    state = absorbed(spark, rows, tmp_path / "state", [[day], dates_of(rows), [day]])
    kept = state.latest.rows(3)
    assert plain(kept) == plain(latest_per_property(rows).select(*kept.columns))
    assert kept.count() == 6


def test_a_second_run_reads_one_snapshot(spark, rows, tmp_path):
    """The older partitions of silver are gone by then, and nothing is missing."""
    silver, days = str(tmp_path / "silver"), dates_of(rows)
    stored = rows.withColumn("_listing_operation", F.col("operation"))
    write_snapshots(stored.filter(F.col("snapshot_date") < days[-1]), silver)
    state = maintained.GoldState(spark, str(tmp_path / "state"), buckets=4)
    assert {d for _, d in maintained.update_state(spark, silver, state)} == set(days[:-1])
    assert maintained.update_state(spark, silver, state) == []

    newest = str(tmp_path / "newest")
    write_snapshots(stored.filter(F.col("snapshot_date") == days[-1]), newest)
    assert {d for _, d in maintained.update_state(spark, newest, state)} == {days[-1]}
    result = maintained.write_gold(spark, state, str(tmp_path / "gold"), F.lit(STAMP))
    full = gold.write_gold(spark, rows, str(tmp_path / "full"), F.lit(STAMP))
    assert result.rows == full.rows and len(result.rows) == 16
    for block, name in full.rows:
        ours, theirs = (spark.read.parquet(f"{r.tables}/{block}/{name}") for r in (result, full))
        assert plain(ours) == plain(theirs), (block, name)

    write_snapshots(stored, silver)
    todo = [(op, d) for op in ("rent", "sale") for d in days]
    assert state.missing(spark.createDataFrame(todo, maintained.COMMIT_SCHEMA)) == []
    plan = plan_of(read_history(spark, silver).filter(F.col("snapshot_date").isin([days[-1]])))
    assert str(days[-1]) in plan[plan.index("PartitionFilters") :]


def test_a_late_page_of_another_operation(spark, rows, tmp_path):
    """The second part of a date computes it again from both."""
    silver = str(tmp_path / "silver")
    stored = rows.withColumn("_listing_operation", F.col("operation"))
    write_snapshots(stored.filter("operation = 'sale'"), silver)
    state = maintained.GoldState(spark, str(tmp_path / "state"), buckets=4)
    maintained.update_state(spark, silver, state)
    write_snapshots(stored.filter("operation = 'rent'"), silver)
    assert {op for op, _ in maintained.update_state(spark, silver, state)} == {"rent"}
    full = gold.gold_datasets(gold.gold_inputs(rows, MarketParams()))
    ours = gold.gold_datasets(state.inputs(), maintained.GENERAL, maintained.RELEVANT)
    for job in (("general", "rent_vs_sale_ratio"), ("relevant", "boxplot_by_neighborhood"), ("data_basis", "rooms_distribution")):
        assert plain(ours[job]()) == plain(full[job]()), job


def test_a_run_that_dies_leaves_nothing_to_see(spark, rows, tmp_path, monkeypatch):
    days = dates_of(rows)
    state = absorbed(spark, rows, tmp_path / "state", [days[:3]])
    before = plain(state.stored("cells", "general"))

    def fails(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(state.ledger, "append", fails)
        with pytest.raises(RuntimeError):
            state.absorb(rows.filter(F.col("snapshot_date") > days[2]), [(None, d) for d in days[3:]])
    assert plain(state.stored("cells", "general")) == before
    assert state.ledger.commits() == [1]
    state.absorb(rows.filter(F.col("snapshot_date").isin(days[3:5])), [(None, d) for d in days[3:5]])
    state.absorb(rows.filter(F.col("snapshot_date").isin(days[5:])), [(None, d) for d in days[5:]])
    kept = state.latest.rows(3)
    assert plain(kept) == plain(latest_per_property(in_scope(rows)).select(*kept.columns))
    full = gold.gold_datasets(gold.gold_inputs(rows, MarketParams()))
    ours = gold.gold_datasets(state.inputs(), maintained.GENERAL, maintained.RELEVANT)
    assert plain(ours["general", "boxplot_by_neighborhood"]()) == plain(full["general", "boxplot_by_neighborhood"]())


def test_the_state_is_not_shuffled(spark, rows, tmp_path):
    """Of a merge, only the new listings move; whatever the number of shuffle partitions."""
    state = absorbed(spark, rows, tmp_path / "state", [dates_of(rows)[:4]])
    fresh = latest_per_property(rows.select(*state.latest.schema.names)).withColumn(KEY, property_key())
    for partitions in ("4", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            plan = plan_of(state.latest.merged(state.latest.table(1), fresh))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert "SelectedBucketsCount: 4 out of 4" in plan or "Bucketed: true" in plan
        # one exchange for the dedup of the new rows, one into the buckets
        assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan


def test_the_rolling_box_plot_reads_the_window_only(spark, rows, tmp_path):
    days = dates_of(rows)
    state = absorbed(spark, rows, tmp_path / "state", [days])
    since = days[-2]
    df = state.boxes("general", since=since)
    plan = plan_of(df)
    assert str(since) in plan[plan.index("PartitionFilters") :] and "latitude" not in plan
    read = state.stored("values", "general", since).select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all(any(f"snapshot_date={d}" in r.f for d in days[-2:]) for r in read)


def test_an_empty_state_and_no_rows_in_scope(spark, rows, tmp_path):
    state = maintained.GoldState(spark, str(tmp_path / "none"), buckets=4)
    datasets = gold.gold_datasets(state.inputs(), maintained.GENERAL, maintained.RELEVANT)
    assert all(make().isEmpty() for make in datasets.values())
    outside = rows.filter("district = 'Suburb'")
    state = absorbed(spark, outside, tmp_path / "state", [dates_of(outside)])
    datasets = gold.gold_datasets(state.inputs(), maintained.GENERAL, maintained.RELEVANT)
    assert all(make().isEmpty() for make in datasets.values())
