"""The trend and distribution datasets of the gold layer.

Functions that take ``cells`` accept either unit cells or cells already rolled
up to the finest grain, and give the same result on both.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casametra.functions.columns import by_name, floor_bin, iso_date
from casametra.operators.cells import mean, roll_up
from casametra.operators.quantiles import exact_quantiles
from casametra.params import MarketParams

BOX_KEYS = ("operation", "district", "neighborhood")
QUARTILES = {"q1": 0.25, "median": 0.50, "q3": 0.75}

_DEFAULTS = MarketParams()


def _price_series(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = cells.dropna(subset=[*keys])
    return roll_up(known, keys).select(
        *[iso_date(F.col(k)).alias(k) if k == "snapshot_date" else F.col(k) for k in keys],
        F.col("n_listings").alias("count_listings"),
        mean("priceByArea").alias("mean_priceByArea"),
        mean("size").alias("mean_size"),
        mean("price").alias("mean_price"),
    )


def price_series_by_neighborhood(cells: DataFrame) -> DataFrame:
    return _price_series(cells, ("operation", "district", "neighborhood", "snapshot_date"))


def price_series_by_district(cells: DataFrame) -> DataFrame:
    """Means over all listings of a district, not over neighborhood means."""
    return _price_series(cells, ("operation", "district", "snapshot_date"))


def weekly_volume(cells: DataFrame) -> DataFrame:
    keys = ("operation", "snapshot_date")
    return roll_up(cells.dropna(subset=[*keys]), keys).select(
        "operation",
        iso_date(F.col("snapshot_date")).alias("snapshot_date"),
        F.col("n_listings").alias("count_listings"),
    )


def rent_and_sale(
    cells: DataFrame, keys: Sequence[str], measures: Sequence[str], min_count: int
) -> DataFrame:
    """Groups seen on both sides: counts and means of each, in one aggregation.

    Stands for the inner join of the sale groups with the rent groups. A group
    must have rows on both sides and ``min_count`` listings on each.
    """

    def side(operation: str) -> list[Column]:
        def of(column: str) -> Column:
            return F.sum(F.when(F.col("operation") == operation, F.col(column)))

        return [
            F.bool_or(F.col("operation") == operation).alias(f"_has_{operation}"),
            of("n_listings").alias(f"count_listings_{operation}"),
            *[
                F.try_divide(of(f"{m}_sum"), of(f"{m}_n")).alias(f"mean_{m}_{operation}")
                for m in measures
            ],
        ]

    sides = (
        cells.dropna(subset=[*keys])
        .groupBy(*keys)
        .agg(*side("sale"), *side("rent"))
        .filter(F.col("_has_sale") & F.col("_has_rent"))
        .filter(
            (F.col("count_listings_sale") >= min_count)
            & (F.col("count_listings_rent") >= min_count)
        )
    )
    return sides.withColumn(
        "mean_sales_price_by_rent_ratio",
        F.try_divide("mean_priceByArea_sale", "mean_priceByArea_rent"),
    )


_RATIO_COLUMNS = (
    "mean_priceByArea_sale",
    "mean_priceByArea_rent",
    "mean_sales_price_by_rent_ratio",
    "count_listings_sale",
    "count_listings_rent",
)


def rent_vs_sale_ratio(cells: DataFrame, min_count: int = _DEFAULTS.min_count) -> DataFrame:
    """Sale over rent price per area of each neighborhood, over all time."""
    keys = ("district", "neighborhood")
    return rent_and_sale(cells, keys, ("priceByArea",), min_count).select(
        *keys, *_RATIO_COLUMNS
    )


def rent_vs_sale_ratio_series(
    cells: DataFrame, min_count: int = _DEFAULTS.min_count
) -> DataFrame:
    """The same ratio for each snapshot, with the minimum applied in each."""
    keys = ("district", "neighborhood", "snapshot_date")
    return rent_and_sale(cells, keys, ("priceByArea",), min_count).select(
        "district",
        "neighborhood",
        iso_date(F.col("snapshot_date")).alias("snapshot_date"),
        *_RATIO_COLUMNS,
    )


def boxplot(
    listings: DataFrame,
    min_count: int = 1,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Five-number summary of price per area for each neighborhood.

    Groups with fewer than ``min_count`` prices are left out. For ``keep`` see
    ``exact_quantiles``.
    """
    summary = exact_quantiles(listings, BOX_KEYS, "priceByArea", QUARTILES, keep)
    return summary if min_count <= 1 else summary.filter(F.col("count") >= min_count)


def size_histogram(listings: DataFrame, bin_width: int = _DEFAULTS.size_bin_m2) -> DataFrame:
    start = floor_bin(F.col("size"), F.lit(float(bin_width))).cast("bigint")
    return (
        listings.dropna(subset=["operation", "size"])
        .groupBy("operation", start.alias("bin_start_m2"))
        .agg(F.count("*").alias("count_listings"))
        .select(
            "operation",
            "bin_start_m2",
            (F.col("bin_start_m2") + bin_width).alias("bin_end_m2"),
            "count_listings",
        )
    )


def rooms_distribution(listings: DataFrame) -> DataFrame:
    return (
        listings.dropna(subset=["operation", "rooms"])
        .groupBy("operation", F.col("rooms").cast("int").alias("rooms"))
        .agg(F.count("*").alias("count_listings"))
    )


def price_histogram(
    listings: DataFrame,
    bin_widths: Mapping[str, float] | None = None,
    default_width: float = _DEFAULTS.default_price_bin,
) -> DataFrame:
    """Price per area in bins whose width depends on the operation."""
    widths = bin_widths or _DEFAULTS.price_bin_widths
    width = by_name(F.col("operation"), widths, default_width)
    return (
        listings.dropna(subset=["operation", "priceByArea"])
        .groupBy(
            "operation",
            floor_bin(F.col("priceByArea"), width).alias("bin_start_price_m2"),
        )
        .agg(F.count("*").alias("count_listings"))
        .select(
            "operation",
            "bin_start_price_m2",
            (F.col("bin_start_price_m2") + width).alias("bin_end_price_m2"),
            "count_listings",
        )
    )
