"""Where the listings of the rolling window are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casametra.functions.columns import round_half_even
from casametra.operators.filters import with_coordinates
from casametra.params import MarketParams

GRID_KEYS = ("operation", "district", "neighborhood", "latitude", "longitude")


def location_grid(
    recent: DataFrame, decimals: int = MarketParams.grid_decimals
) -> DataFrame:
    """Listings per cell of a coordinate grid.

    ``recent`` has one row per property of the window. Coordinates are rounded
    before grouping; nothing but the six listed columns leaves the function.
    """
    rounded = with_coordinates(recent).select(
        "operation",
        "district",
        "neighborhood",
        round_half_even(F.col("latitude"), decimals).alias("latitude"),
        round_half_even(F.col("longitude"), decimals).alias("longitude"),
    )
    return (
        rounded.dropna(subset=["operation", "district", "neighborhood"])
        .groupBy(*GRID_KEYS)
        .agg(F.count("*").alias("count_listings"))
    )


def listing_locations(recent: DataFrame) -> DataFrame:
    """Exact coordinates, one row per property of the window.

    As many rows as there are current properties: keep it a table at scale.
    """
    return with_coordinates(recent).select(*GRID_KEYS)
