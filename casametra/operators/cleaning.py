"""Row rules that turn raw listing elements into silver rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casametra.params import SCOPE_DISTRICTS, SalePriceBounds
from casametra.schemas import ORDINAL_COLUMNS, OWN_OPERATION, SILVER_COLUMNS


def effective_operation() -> Column:
    """The listing's own operation, or that of its page when it states none."""
    return F.coalesce(F.nullif(F.col("operation"), F.lit("")), F.col("page_operation"))


def has_price_per_area() -> Column:
    return F.col("priceByArea").isNotNull()


def has_neighborhood() -> Column:
    """Neither null nor empty; a name of blanks passes."""
    return F.col("neighborhood") != ""


def has_plausible_bathrooms() -> Column:
    """Unknown passes, zero or less does not."""
    return F.col("bathrooms").isNull() | (F.col("bathrooms") > 0)


def within_sale_bounds(operation: Column, bounds: SalePriceBounds) -> Column:
    """Sale prices per area lie strictly inside the bounds; others are free."""
    price = F.col("priceByArea")
    return ~operation.eqNullSafe("sale") | ((price > bounds.low) & (price < bounds.high))


def clean_elements(
    elements: DataFrame,
    bounds: SalePriceBounds = SalePriceBounds(),
    order: Sequence[str] = ORDINAL_COLUMNS,
) -> DataFrame:
    """Valid listings in the 23 silver columns, plus the ordinal columns.

    Input as from ``explode_elements``; other columns are dropped. The
    ``operation`` of a result row is never null.
    """
    valid = elements.filter(
        has_price_per_area()
        & has_neighborhood()
        & has_plausible_bathrooms()
        & within_sale_bounds(effective_operation(), bounds)
    )
    integers = {"rooms", "bathrooms"}
    columns = {
        "operation": effective_operation(),
        **{c: F.col(c).cast("int") for c in integers},
    }
    return valid.select(
        *[columns.get(c, F.col(c)).alias(c) for c in SILVER_COLUMNS], *order
    )


def to_stored(elements: DataFrame, bounds: SalePriceBounds = SalePriceBounds()) -> DataFrame:
    """Clean elements in the layout of the silver table.

    The partition takes the operation of the page; that of the listing itself
    is kept beside it.
    """
    cleaned = clean_elements(
        elements, bounds, order=(*ORDINAL_COLUMNS, "page_operation")
    )
    return cleaned.withColumnRenamed("operation", OWN_OPERATION).withColumnRenamed(
        "page_operation", "operation"
    )


def clean_for_exploration(
    listings: DataFrame,
    districts: Sequence[str] = SCOPE_DISTRICTS,
    bounds: SalePriceBounds = SalePriceBounds(),
) -> DataFrame:
    """The stricter exploratory cleaning.

    Unlike the silver rules it drops listings with unknown bathrooms and with
    an operation other than sale or rent, and it applies the scope at once.
    """
    price = F.col("priceByArea")
    sale = (F.col("operation") == "sale") & (price > bounds.low) & (price < bounds.high)
    return listings.filter(
        (F.col("bathrooms") > 0)
        & F.col("district").isin(*districts)
        & (sale | (F.col("operation") == "rent"))
    )
