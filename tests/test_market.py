import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casametra.functions.columns import floor_bin, iso_timestamp_or_text
from casametra.operators import dedup, filters, locations, market, profile
from casametra.operators.cells import CELL_KEYS, roll_up, unit_cells
from casametra.operators.quantiles import exact_quantiles
from casametra.staging import Staging
from tests.conftest import day, records


def codes(df):
    return sorted(r.propertyCode for r in df.collect())


# --- filters ----------------------------------------------------------------


def test_scope_compares_names_byte_by_byte(listings):
    df = listings({"district": "L'Eixample"}, {"district": "L’Eixample"}, {"district": None})
    assert codes(filters.in_scope(df)) == ["0"]


def test_relevant_null_rules(listings):
    df = listings(
        {},
        {"floor": None},
        {"floor": "1"},
        {"hasLift": None},
        {"hasLift": False},
        {"size": 120.0},
        {"size": None},
        {"rooms": None},
        {"rooms": 1},
        {"bathrooms": None},
        {"bathrooms": 1},
        {"floor": "bj"},
    )
    assert codes(filters.relevant(df)) == ["0", "1", "11"]


def test_window_is_inclusive_and_clamps_month_ends(listings):
    dates = ["2023-05-31", "2023-02-28", "2023-02-27", None]
    df = listings(*[{"snapshot_date": day(d)} for d in dates])
    assert codes(filters.in_window(df, 3)) == ["0", "1"]
    assert codes(filters.in_window(df, 3, F.lit("2023-05-27").cast("date"))) == ["0", "1", "2"]


def test_window_of_no_dates_is_empty(listings):
    assert codes(filters.in_window(listings({"snapshot_date": None}), 3)) == []


def test_dashboard_scope(spark):
    df = spark.createDataFrame(
        [("A", "x"), ("A", "y"), ("B", "x"), (None, "x"), ("A", None), ("", "")],
        "district string, neighborhood string",
    )
    assert filters.dashboard_scope(df).count() == 6
    assert filters.dashboard_scope(df, ["A"]).count() == 5
    assert filters.dashboard_scope(df, ["A"], ["x"]).count() == 4
    assert filters.dashboard_scope(df.select("district"), [], ["x"]).count() == 6


# --- dedup ------------------------------------------------------------------


def test_first_per_snapshot_keeps_the_first_in_each_snapshot(listings):
    df = listings(
        {"propertyCode": "p", "price": 1.0},
        {"propertyCode": "p", "price": 2.0},
        {"propertyCode": "p", "price": 3.0, "snapshot_date": day("2023-04-16")},
        {"propertyCode": "p", "price": 4.0, "operation": "rent"},
        {"propertyCode": None, "price": 5.0},
        {"propertyCode": None, "price": 6.0},
    )
    assert sorted(r.price for r in dedup.first_per_snapshot(df).collect()) == [1.0, 3.0, 4.0, 5.0]


def test_latest_per_property_takes_the_last_and_unknown_dates_win(listings):
    df = listings(
        {"propertyCode": "p", "price": 1.0, "snapshot_date": day("2023-04-16")},
        {"propertyCode": "p", "price": 2.0, "snapshot_date": day("2023-04-16")},
        {"propertyCode": "p", "price": 3.0, "snapshot_date": day("2023-04-09")},
        {"propertyCode": "q", "price": 4.0, "snapshot_date": None},
        {"propertyCode": "q", "price": 5.0, "snapshot_date": day("2023-04-16")},
    )
    assert sorted(r.price for r in dedup.latest_per_property(df).collect()) == [2.0, 4.0]
    assert dedup.last_per_property(df).count() == 2


@pytest.mark.parametrize("seed", range(3))
def test_dedups_do_not_depend_on_row_placement(listings, seed):
    rng = random.Random(seed)
    rows = [
        {
            "propertyCode": str(rng.randrange(6)),
            "operation": rng.choice(["sale", "rent"]),
            "snapshot_date": day(rng.choice(["2023-04-09", "2023-04-16"])),
            "price": float(i),
        }
        for i in range(120)
    ]
    df = listings(*rows)
    moved = df.orderBy(F.rand(seed)).repartition(7)
    for keep in (dedup.first_per_snapshot, dedup.latest_per_property, dedup.last_per_property):
        assert keep(df).exceptAll(keep(moved)).isEmpty()
        assert keep(moved).exceptAll(keep(df)).isEmpty()


# --- series and ratios ------------------------------------------------------


def test_series_count_known_codes_and_skip_null_values(listings):
    df = listings(
        {"priceByArea": 10.0, "size": 100.0},
        {"priceByArea": 20.0, "size": None},
        {"priceByArea": None, "size": None, "propertyCode": None},
        {"neighborhood": None, "priceByArea": 99.0},
        {"district": None},
    )
    rows = records(market.price_series_by_neighborhood(unit_cells(df)))
    assert len(rows) == 1
    row = rows[0]
    assert (row["count_listings"], row["mean_priceByArea"], row["mean_size"]) == (2, 15.0, 100.0)
    assert row["snapshot_date"] == "2023-04-09"
    (district,) = records(market.price_series_by_district(unit_cells(df)))
    assert district["count_listings"] == 3 and district["mean_priceByArea"] == 43.0
    (volume,) = records(market.weekly_volume(unit_cells(df)))
    assert volume["count_listings"] == 4


def test_rolled_up_cells_give_the_same_datasets(listings):
    rng = random.Random(7)
    df = listings(
        *[
            {
                "operation": rng.choice(["sale", "rent"]),
                "district": rng.choice(["A", "B", None]),
                "neighborhood": rng.choice(["x", "y", None]),
                "snapshot_date": day(rng.choice(["2023-04-09", "2023-04-16"])),
                "priceByArea": rng.choice([None, 2.0, 4.0, 8.0]),
            }
            for _ in range(200)
        ]
    )
    fine = roll_up(unit_cells(df), CELL_KEYS)
    for make in (
        market.price_series_by_neighborhood,
        market.price_series_by_district,
        market.weekly_volume,
        lambda c: market.rent_vs_sale_ratio(c, 3),
        lambda c: market.rent_vs_sale_ratio_series(c, 3),
    ):
        a, b = make(unit_cells(df)), make(fine)
        assert a.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_ratio_needs_both_sides_and_the_minimum_on_each(listings):
    sale = [{"operation": "sale", "priceByArea": 3000.0}] * 5
    rent = [{"operation": "rent", "priceByArea": 15.0}] * 5
    df = listings(*sale, *rent, {"operation": "sale", "neighborhood": "only sale"})
    (row,) = records(market.rent_vs_sale_ratio(unit_cells(df)))
    assert row["mean_sales_price_by_rent_ratio"] == 200.0
    assert (row["count_listings_sale"], row["count_listings_rent"]) == (5, 5)
    assert records(market.rent_vs_sale_ratio(unit_cells(df), 6)) == []
    assert len(records(market.rent_vs_sale_ratio(unit_cells(df), 0))) == 1


def test_ratio_over_a_zero_rent_is_null(listings):
    df = listings({"operation": "sale"}, {"operation": "rent", "priceByArea": 0.0})
    (row,) = records(market.rent_vs_sale_ratio(unit_cells(df), 1))
    assert row["mean_sales_price_by_rent_ratio"] is None


def test_ratio_series_applies_the_minimum_per_snapshot(listings):
    rows = []
    for when, n in (("2023-04-09", 5), ("2023-04-16", 4)):
        for op in ("sale", "rent"):
            rows += [{"operation": op, "snapshot_date": day(when)}] * n
    (row,) = records(market.rent_vs_sale_ratio_series(unit_cells(listings(*rows))))
    assert row["snapshot_date"] == "2023-04-09"


# --- quantiles --------------------------------------------------------------


@pytest.mark.parametrize("keep", [None, lambda df: df])
@pytest.mark.parametrize("seed", range(3))
def test_quantiles_equal_numpy(spark, seed, keep):
    rng = np.random.default_rng(seed)
    groups = {
        "one": [5.0],
        "two": [1.0, 2.0],
        "four": [1.0, 2.0, 4.0, 8.0],
        "same": [3.0] * 17,
        "signed": list(rng.normal(0, 100, 301)),
        "outlier": [*rng.uniform(0, 1, 200), 1e12],
        "skewed": [*([7.0] * 500), *np.round(rng.lognormal(3, 2, 250), 2)],
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [("four", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    got = {
        r["g"]: r
        for r in records(exact_quantiles(df, ["g"], "v", wanted, keep))
    }
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        row = got[g]
        assert (row["count"], row["min"], row["max"]) == (len(values), min(values), max(values))
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
        assert row["min"] <= row["q1"] <= row["median"] <= row["q3"] <= row["max"]


def test_stored_buckets_are_broadcast_and_give_the_same(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        (F.col("id") * 7919 % 1009).cast("double").alias("v"),
    )
    wanted = {"q1": 0.25, "q3": 0.75}
    plain = exact_quantiles(df, ["g"], "v", wanted)
    number = itertools.count()
    with Staging(spark) as stage:
        kept = exact_quantiles(df, ["g"], "v", wanted, lambda b: stage.table(b, f"buckets-{next(number)}"))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, plain.collect()))


def test_boxplot_minimum_counts_known_prices(listings):
    rows = [{"priceByArea": float(v)} for v in (1, 2, 4, 8)] + [{"priceByArea": None}]
    df = listings(*rows)
    (box,) = records(market.boxplot(df))
    assert (box["count"], box["min"], box["q1"], box["median"], box["q3"], box["max"]) == (
        4, 1.0, 1.75, 3.0, 5.0, 8.0
    )
    assert len(records(market.boxplot(df, 4))) == 1
    assert records(market.boxplot(df, 5)) == []


# --- histograms and locations -----------------------------------------------


@pytest.mark.parametrize("width", [10.0, 250.0, 1.0, 0.1, 0.25])
def test_floor_bins_equal_pandas_floor_division(spark, width):
    rng = np.random.default_rng(1)
    values = [*rng.uniform(-500, 500, 200), 0.3, 0.7, -0.1, 0.0, width, -width, 3 * width]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = sorted(r[0] for r in df.select(floor_bin(F.col("v"), F.lit(width))).collect())
    expected = sorted(pd.Series(values) // width * width)
    assert got == pytest.approx(expected, rel=1e-12, abs=1e-12)


def test_histograms(listings):
    df = listings(
        {"size": 109.9, "priceByArea": 2249.0, "rooms": 2},
        {"size": 100.0, "priceByArea": 2250.0, "rooms": 2},
        {"size": None, "priceByArea": 2499.99, "rooms": None},
        {"operation": "rent", "size": 110.0, "priceByArea": 12.5, "rooms": 0},
        {"operation": "auction", "size": 5.0, "priceByArea": 251.0, "rooms": 1},
    )
    sizes = {tuple(r.values()) for r in records(market.size_histogram(df))}
    assert sizes == {
        ("sale", 100, 110, 2), ("rent", 110, 120, 1), ("auction", 0, 10, 1)
    }
    rooms = {tuple(r.values()) for r in records(market.rooms_distribution(df))}
    assert rooms == {("sale", 2, 2), ("rent", 0, 1), ("auction", 1, 1)}
    prices = {tuple(r.values()) for r in records(market.price_histogram(df))}
    assert prices == {
        ("sale", 2000.0, 2250.0, 1),
        ("sale", 2250.0, 2500.0, 2),
        ("rent", 12.0, 13.0, 1),
        ("auction", 250.0, 500.0, 1),
    }
    wide = market.price_histogram(df, {"sale": 1000.0})
    assert {r["bin_start_price_m2"] for r in records(wide) if r["operation"] == "sale"} == {2000.0}
    assert sum(r["count_listings"] for r in records(market.price_histogram(df))) == 5


def test_grid_rounds_half_even_and_shows_nothing_else(listings):
    df = listings(
        {"latitude": 39.46949, "longitude": -0.37951},
        {"latitude": 39.4694, "longitude": -0.3795001},
        {"latitude": 0.0625, "longitude": 0.0005},
        {"latitude": None},
        {"neighborhood": None},
    )
    grid = locations.location_grid(df)
    assert grid.columns == [
        "operation", "district", "neighborhood", "latitude", "longitude", "count_listings"
    ]
    cells = {(r["latitude"], r["longitude"]): r["count_listings"] for r in records(grid)}
    assert cells == {(39.469, -0.38): 2, (0.062, 0.0): 1}
    assert locations.listing_locations(df).count() == 4
    assert locations.listing_locations(df).columns == grid.columns[:5]


# --- exploratory statistics -------------------------------------------------


def test_describe_equals_pandas(listings):
    rng = random.Random(3)
    df = listings(
        *[
            {
                "operation": rng.choice(["sale", "rent"]),
                "price": rng.uniform(1, 9),
                "rooms": rng.choice([None, 1, 2, 3]),
            }
            for _ in range(80)
        ]
    )
    frame = df.toPandas()
    rows = records(profile.describe(df, columns=("price", "rooms")))
    assert len(rows) == 4
    for row in rows:
        expected = frame[frame.operation == row["operation"]][row["column"]].describe()
        for ours, theirs in (
            ("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
            ("q1", "25%"), ("median", "50%"), ("q3", "75%"), ("max", "max"),
        ):
            assert row[ours] == pytest.approx(expected[theirs], rel=1e-9)


def test_correlation_pruning(listings):
    rng = random.Random(5)
    rows = []
    for _ in range(60):
        size = rng.uniform(50, 200)
        rows.append({"size": size, "price": size * 2000, "rooms": rng.randrange(5), "bathrooms": 2})
    df = listings(*rows)
    columns = ("size", "price", "rooms", "bathrooms")
    pairs = profile.correlation_pairs(df, columns)
    by_pair = {(r["column"], r["later_column"]): r["abs_correlation"] for r in records(pairs)}
    assert len(by_pair) == 6
    assert by_pair["size", "price"] == pytest.approx(1.0)
    assert by_pair["size", "bathrooms"] is None
    assert [r["column"] for r in records(profile.redundant_columns(pairs))] == ["price"]
    assert "price" not in profile.drop_redundant(df, columns).columns


def test_volume_order_and_zero_counts(listings):
    df = listings(
        {"priceByArea": 9.0, "neighborhood": "dear"},
        {"priceByArea": 1.0, "neighborhood": "cheap", "rooms": 0, "propertyType": "studio"},
        {"priceByArea": 3.0, "neighborhood": "cheap", "snapshot_date": day("2023-04-16")},
    )
    assert [r["neighborhood"] for r in records(profile.neighborhood_order(df))] == ["cheap", "dear"]
    (volume,) = records(profile.mean_download_volume(df))
    assert (volume["weekly_mean"], volume["monthly_mean"]) == (1.5, 7.5)
    assert records(profile.count_where_zero(df, "rooms", "propertyType")) == [
        {"propertyType": "studio", "count_listings": 1}
    ]
    assert profile.highest_price_per_area(df).first()[0] == 9.0


def test_head_and_sample(listings):
    df = listings(*[{"price": float(9 - i)} for i in range(9)])
    assert [r.price for r in profile.head(df, 2, ["price"]).collect()] == [1.0, 2.0]
    assert profile.sample(df, 1.0).count() == 9


def test_scope_options(spark):
    a = spark.createDataFrame([("B", "y"), ("A", "x"), (None, None)], "district string, neighborhood string")
    b = spark.createDataFrame([("C",), ("",)], "district string")
    assert [r[0] for r in profile.scope_districts([a, b]).collect()] == ["A", "B", "C"]
    assert [r[0] for r in profile.scope_neighborhoods([a, b]).collect()] == ["x", "y"]
    assert [r[0] for r in profile.scope_neighborhoods([a, b], ["B"]).collect()] == ["y"]


def test_log_timestamps(spark):
    texts = ["2026-01-01 00:00:00.000", "2026-01-01 00:00:00.250", "soon", "2026-01-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(iso_timestamp_or_text(F.col("t"))).collect()] == [
        "2026-01-01T00:00:00", "2026-01-01T00:00:00.250000", "soon", "2026-01-01", "", None
    ]


def test_close_values_spread_over_buckets(spark):
    """A million coordinates of one town: no window task gets a large part of a group."""
    from casametra.operators import quantiles

    spread = spark.range(1_000_000).select(
        F.lit("g").alias("g"), (39.45 + F.rand(7) * 0.05).alias("v")
    )
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    original = quantiles._PARTS
    assert original >= 1024
    (row,) = records(exact_quantiles(spread, ["g"], "v", wanted))
    values = sorted(r.v for r in spread.select("v").collect())
    n = len(values)

    def at(p):
        low = int((n - 1) * p)
        return values[low] + (values[min(low + 1, n - 1)] - values[low]) * ((n - 1) * p - low)

    assert all(row[name] == pytest.approx(at(p), abs=1e-12) for name, p in wanted.items())
    low, high = values[0], values[-1]
    parts = [0] * original
    for v in values:
        parts[min(int((v - low) / (high - low) * original), original - 1)] += 1
    assert max(parts) < n / 1000
