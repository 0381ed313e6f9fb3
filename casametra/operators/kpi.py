"""Headline figures and chart series over the gold datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def weighted_median(boxes: DataFrame, keys: Sequence[str] = ("operation",)) -> DataFrame:
    """Median of group medians, weighted by their counts.

    The first median, in ascending order, at which the running count reaches
    half of the total. One row per neighborhood goes in, so a window over an
    operation stays small.
    """
    usable = boxes.filter(F.col("median").isNotNull() & (F.col("count") > 0))
    group = Window.partitionBy(*keys)
    running = F.sum("count").over(
        group.orderBy("median").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        usable.select(
            *keys, "median", running.alias("_running"), F.sum("count").over(group).alias("_all")
        )
        .filter(F.col("_running") * 2 >= F.col("_all"))
        .groupBy(*keys)
        .agg(F.min("median").alias("weighted_median"))
    )


def preferred_boxes(recent: DataFrame, all_time: DataFrame) -> DataFrame:
    """The rolling box plots, or the all-time ones when there is no rolling row."""
    columns = all_time.columns
    return recent.select(*columns).unionByName(all_time.filter(~recent.exists()))


def _listings_of_both_sides() -> Column:
    return F.coalesce("count_listings_sale", F.lit(0)) + F.coalesce(
        "count_listings_rent", F.lit(0)
    )


def _yield_percent() -> Column:
    """Implied gross yield over the positive ratios, weighted by listings."""
    ratio, listings = F.col("mean_sales_price_by_rent_ratio"), _listings_of_both_sides()
    weight = F.when(ratio > 0, F.when(listings == 0, F.lit(1)).otherwise(listings))
    mean_ratio = F.try_divide(F.sum(ratio * weight), F.sum(weight))
    return F.try_divide(F.lit(12.0), mean_ratio) * 100.0


def _listing_count() -> Column:
    return F.sum(_listings_of_both_sides())


def gross_yield(ratios: DataFrame) -> DataFrame:
    """Implied gross yield in percent, from ratios weighted by listing count."""
    return ratios.agg(_yield_percent().alias("implied_gross_yield_percent"))


def total_listings(ratios: DataFrame) -> DataFrame:
    """Listings on both sides of all ratios; null when there is no ratio."""
    return ratios.agg(_listing_count().alias("total_listing_count"))


def summary(
    boxes: DataFrame, ratios: DataFrame, generated_at: Column
) -> DataFrame:
    """The headline figures in one row, each null when its input is empty.

    Two scalar subqueries, one over the box plots and one over the ratios.
    """

    def median_of(operation: str) -> Column:
        return F.max(F.when(F.col("operation") == operation, F.col("weighted_median")))

    medians = weighted_median(boxes).agg(
        F.struct(median_of("rent").alias("rent"), median_of("sale").alias("sale"))
    )
    totals = ratios.agg(
        F.struct(_yield_percent().alias("percent"), _listing_count().alias("listings"))
    )
    return (
        boxes.sparkSession.range(1)
        .select(medians.scalar().alias("medians"), totals.scalar().alias("totals"))
        .select(
            F.col("medians.rent").alias("median_rent_per_m2_month"),
            F.col("medians.sale").alias("median_sale_per_m2"),
            F.col("totals.percent").alias("implied_gross_yield_percent"),
            F.col("totals.listings").alias("total_listing_count"),
            generated_at.alias("last_updated"),
        )
    )


def series(
    dataset: DataFrame, keys: Sequence[str], y: str, x: str = "snapshot_date"
) -> DataFrame:
    """One row per series: its keys and its points in order of ``x``.

    A series has one point per snapshot date, so its array stays small.
    """
    points = F.sort_array(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))))
    return dataset.groupBy(*keys).agg(points.alias("points"))


def price_series_lines(dataset: DataFrame) -> DataFrame:
    """Price lines of neighborhoods, or of districts when there are none."""
    return series(dataset, _place_keys(dataset), "mean_priceByArea")


def count_series_lines(dataset: DataFrame) -> DataFrame:
    return series(dataset, _place_keys(dataset), "count_listings")


def ratio_series_lines(dataset: DataFrame) -> DataFrame:
    """Ratio lines; equal neighborhood names in two districts stay apart."""
    return series(dataset, ("district", "neighborhood"), "mean_sales_price_by_rent_ratio")


def _place_keys(dataset: DataFrame) -> list[str]:
    wanted = ("operation", "district", "neighborhood")
    return [c for c in wanted if c in dataset.columns]


def ratio_scatter(ratios: DataFrame) -> DataFrame:
    """Rent against sale price of each neighborhood, with its label."""
    return ratios.select(
        F.col("mean_priceByArea_rent").alias("x"),
        F.col("mean_priceByArea_sale").alias("y"),
        F.format_string("%s (%s)", "neighborhood", "district").alias("label"),
    )


def map_points(locations: DataFrame) -> DataFrame:
    """Listing points, each with the series (neighborhood) it belongs to.

    Points stay rows: a neighborhood may hold any number of them.
    """
    return locations.select(
        F.col("neighborhood").alias("series"),
        "longitude",
        "latitude",
        F.format_string("%s (%s)", "neighborhood", "operation").alias("label"),
    )


def grid_points(grid: DataFrame) -> DataFrame:
    """Grid cells, each with the series (district) it belongs to."""
    return grid.select(
        F.col("district").alias("series"),
        "longitude",
        "latitude",
        "count_listings",
        F.format_string(
            "%s (%s): %d listing(s)", "neighborhood", "operation", "count_listings"
        ).alias("label"),
    )


def size_bars(histogram: DataFrame) -> DataFrame:
    """Size histogram of each operation as ordered, labelled bars."""
    label = F.format_string("%d-%d", "bin_start_m2", "bin_end_m2")
    return _bars(histogram, F.col("bin_start_m2").cast("double"), label)


def price_bars(histogram: DataFrame) -> DataFrame:
    def number(column: str) -> Column:
        return F.regexp_replace(F.col(column).cast("string"), r"\.0$", "")

    label = F.concat_ws("-", number("bin_start_price_m2"), number("bin_end_price_m2"))
    return _bars(histogram, F.col("bin_start_price_m2"), label)


def room_bars(distribution: DataFrame) -> DataFrame:
    """Room counts of each operation; numbers first, in order, then texts."""
    rooms = F.col("rooms").cast("string")
    return _bars(
        distribution, F.coalesce(rooms.try_cast("double"), F.lit(float("inf"))), rooms
    )


def volume_line(volume: DataFrame) -> DataFrame:
    return series(volume, ("operation",), "count_listings")


def _bars(dataset: DataFrame, position: Column, label: Column) -> DataFrame:
    point = F.struct(
        position.alias("position"), label.alias("x"), F.col("count_listings").alias("y")
    )
    ordered = F.sort_array(F.collect_list(point))
    return dataset.groupBy("operation").agg(
        F.transform(
            ordered, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))
        ).alias("points")
    )
