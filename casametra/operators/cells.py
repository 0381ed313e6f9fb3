"""Market cells: counts and sums that roll up to any coarser grain.

A listing is a cell of one. Cells of the finest grain (operation, district,
neighborhood, snapshot) are a small table, from which every mean and count of
the gold document follows without another pass over the listings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_KEYS = ("operation", "district", "neighborhood", "snapshot_date")
MEASURES = ("priceByArea", "size", "price")
_ADDITIVE = ("n_listings", *[f"{m}_{part}" for m in MEASURES for part in ("sum", "n")])


def unit_cells(listings: DataFrame) -> DataFrame:
    """Each listing as a cell; listings without a property code count zero."""

    def known(column: str) -> Column:
        return F.col(column).isNotNull().cast("bigint")

    return listings.select(
        *CELL_KEYS,
        known("propertyCode").alias("n_listings"),
        *[
            column
            for m in MEASURES
            for column in (F.col(m).alias(f"{m}_sum"), known(m).alias(f"{m}_n"))
        ],
    )


def roll_up(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add cells up by ``keys``. Null keys form groups of their own."""
    return cells.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _ADDITIVE])


def mean(measure: str) -> Column:
    """Mean of a measure over its known values; null when there are none."""
    return F.try_divide(F.col(f"{measure}_sum"), F.col(f"{measure}_n"))
