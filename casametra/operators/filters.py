"""Population filters: scope, relevance, rolling window, dashboard scope."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casametra.params import SCOPE_DISTRICTS, RelevantSpec


def in_scope(listings: DataFrame, districts: Sequence[str] = SCOPE_DISTRICTS) -> DataFrame:
    """Listings of the given districts; names compare byte by byte."""
    return listings.filter(F.col("district").isin(*districts))


def relevant(listings: DataFrame, spec: RelevantSpec = RelevantSpec()) -> DataFrame:
    """Comparable apartments. An unknown floor passes; other unknowns fail."""
    return listings.filter(
        (F.col("hasLift") == spec.has_lift)
        & ~F.col("floor").eqNullSafe(spec.floor_not)
        & (F.col("size") > spec.size_gt)
        & (F.col("rooms") >= spec.rooms_gte)
        & (F.col("bathrooms") >= spec.bathrooms_gte)
    )


def latest_date(listings: DataFrame) -> Column:
    """The latest snapshot date of a DataFrame, as a scalar subquery."""
    return listings.agg(F.max("snapshot_date")).scalar()


def in_window(
    listings: DataFrame, months: int, anchor: Column | None = None
) -> DataFrame:
    """Rows of the last ``months`` calendar months, the start day included.

    The window is anchored to the latest date of the listings themselves, never
    to the clock. Pass ``anchor`` when that date is known from a cheaper
    DataFrame, such as the same rows before a dedup. Null dates fall outside.
    """
    latest = latest_date(listings) if anchor is None else anchor
    return listings.filter(F.col("snapshot_date") >= F.add_months(latest, -months))


def with_coordinates(listings: DataFrame) -> DataFrame:
    return listings.dropna(subset=["latitude", "longitude"])


def dashboard_scope(
    dataset: DataFrame, districts: Sequence[str] = (), neighborhoods: Sequence[str] = ()
) -> DataFrame:
    """Rows of the selected districts and neighborhoods.

    Both selections must hold; an empty selection limits nothing. A row without
    a value, and a dataset without the column, pass that selection.
    """
    for column, chosen in (("district", districts), ("neighborhood", neighborhoods)):
        if chosen and column in dataset.columns:
            value = F.col(column)
            dataset = dataset.filter(
                value.isNull() | (value == "") | value.isin(*chosen)
            )
    return dataset


def of_operation(dataset: DataFrame, operation: str) -> DataFrame:
    return dataset.filter(F.col("operation") == operation)
