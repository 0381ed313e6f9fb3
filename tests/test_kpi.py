import pytest
from pyspark.sql import functions as F

from casametra.operators import kpi
from tests.conftest import records

BOX = "operation string, district string, neighborhood string, count bigint, median double"
RATIO = (
    "mean_sales_price_by_rent_ratio double, count_listings_sale bigint, "
    "count_listings_rent bigint"
)


def boxes(spark, *rows):
    return spark.createDataFrame([(op, "d", f"n{i}", n, m) for i, (op, n, m) in enumerate(rows)], BOX)


@pytest.mark.parametrize(
    "groups, expected",
    [
        ([(10, 5.0)], 5.0),
        ([(1, 1.0), (100, 9.0)], 9.0),
        ([(5, 1.0), (5, 2.0)], 1.0),
        ([(2, 3.0), (2, 1.0), (2, 2.0)], 2.0),
        ([(3, 2.0), (3, 2.0), (7, 4.0)], 4.0),
        ([(0, 1.0), (None, 1.0), (4, None), (1, 8.0)], 8.0),
    ],
)
def test_weighted_median(spark, groups, expected):
    (row,) = records(kpi.weighted_median(boxes(spark, *[("sale", n, m) for n, m in groups])))
    assert row["weighted_median"] == expected


def test_rolling_boxes_win_when_there_are_any(spark):
    recent, every = boxes(spark, ("sale", 1, 1.0)), boxes(spark, ("sale", 9, 9.0), ("rent", 9, 9.0))
    assert [r["median"] for r in records(kpi.preferred_boxes(recent, every))] == [1.0]
    assert kpi.preferred_boxes(recent.limit(0), every).count() == 2


def test_yield_weights_by_listings_and_ignores_non_positive_ratios(spark):
    ratios = spark.createDataFrame(
        [(200.0, 10, 20), (100.0, None, None), (0.0, 5, 5), (None, 5, 5)], RATIO
    )
    mean = (200.0 * 30 + 100.0 * 1) / 31
    assert kpi.gross_yield(ratios).first()[0] == pytest.approx(12 / mean * 100)
    assert kpi.total_listings(ratios).first()[0] == 50


def test_summary_is_null_safe(spark):
    empty = spark.createDataFrame([], RATIO)
    row = records(kpi.summary(boxes(spark, ("rent", 3, 12.5)), empty, F.lit("now")))[0]
    assert row == {
        "median_rent_per_m2_month": 12.5,
        "median_sale_per_m2": None,
        "implied_gross_yield_percent": None,
        "total_listing_count": None,
        "last_updated": "now",
    }


def test_series_are_chronological_and_keep_equal_names_apart(spark):
    rows = [
        ("sale", d, "same", day, value, n)
        for d, day, value, n in (
            ("A", "2023-04-16", 2.0, 20), ("A", "2023-04-09", 1.0, 10), ("B", "2023-04-09", 5.0, 50)
        )
    ]
    df = spark.createDataFrame(
        rows,
        "operation string, district string, neighborhood string, snapshot_date string, "
        "mean_priceByArea double, count_listings bigint",
    )
    lines = {r["district"]: r["points"] for r in records(kpi.price_series_lines(df))}
    assert lines["A"] == [{"x": "2023-04-09", "y": 1.0}, {"x": "2023-04-16", "y": 2.0}]
    assert lines["B"] == [{"x": "2023-04-09", "y": 5.0}]
    counts = {r["district"]: r["points"] for r in records(kpi.count_series_lines(df))}
    assert [p["y"] for p in counts["A"]] == [10, 20]


def test_bars_are_ordered_and_labelled(spark):
    sizes = spark.createDataFrame(
        [("sale", 100, 110, 3), ("sale", 90, 100, 2)],
        "operation string, bin_start_m2 bigint, bin_end_m2 bigint, count_listings bigint",
    )
    (row,) = records(kpi.size_bars(sizes))
    assert row["points"] == [{"x": "90-100", "y": 2}, {"x": "100-110", "y": 3}]
    rooms = spark.createDataFrame(
        [("sale", "10", 1), ("sale", "n/a", 4), ("sale", "2", 3)],
        "operation string, rooms string, count_listings bigint",
    )
    (row,) = records(kpi.room_bars(rooms))
    assert [p["x"] for p in row["points"]] == ["2", "10", "n/a"]
    prices = spark.createDataFrame(
        [("rent", 9.5, 10.0, 1), ("rent", 10.0, 10.5, 2)],
        "operation string, bin_start_price_m2 double, bin_end_price_m2 double, count_listings bigint",
    )
    (row,) = records(kpi.price_bars(prices))
    assert [p["x"] for p in row["points"]] == ["9.5-10", "10-10.5"]


def test_points_keep_every_row(spark):
    df = spark.createDataFrame(
        [("sale", "A", "x", 1.0, 2.0, 3)] * 3,
        "operation string, district string, neighborhood string, latitude double, "
        "longitude double, count_listings bigint",
    )
    points = records(kpi.map_points(df))
    assert len(points) == 3 and points[0]["label"] == "x (sale)" and points[0]["series"] == "x"
    assert records(kpi.grid_points(df))[0]["label"] == "x (sale): 3 listing(s)"
