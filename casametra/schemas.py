"""Explicit schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

#: One listing as it appears in a raw page. ``rooms`` and ``bathrooms`` are
#: read as doubles because pages write both ``2`` and ``2.0``.
#: ``parkingSpace`` is an object in the page and is kept as its JSON text.
ELEMENT_SCHEMA = T.StructType(
    [
        T.StructField("operation", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("municipality", T.StringType()),
        T.StructField("district", T.StringType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("distance", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("propertyCode", T.StringType()),
        T.StructField("propertyType", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("priceByArea", T.DoubleType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("floor", T.StringType()),
        T.StructField("exterior", T.BooleanType()),
        T.StructField("rooms", T.DoubleType()),
        T.StructField("bathrooms", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("newDevelopment", T.BooleanType()),
        T.StructField("hasLift", T.BooleanType()),
        T.StructField("parkingSpace", T.StringType()),
    ]
)

CORRUPT_COLUMN = "_corrupt_record"

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("elementList", T.ArrayType(ELEMENT_SCHEMA)),
        T.StructField("total", T.IntegerType()),
        T.StructField("totalPages", T.IntegerType()),
        T.StructField("actualPage", T.IntegerType()),
    ]
)

#: The 23 columns of a cleaned listing, in order.
SILVER_COLUMNS = (*ELEMENT_SCHEMA.fieldNames(), "snapshot_date")

#: Where a row stood in the raw pages; the order behind "first" and "last".
ORDINAL_COLUMNS = ("_page_file", "_page_pos")

#: The operation of the listing itself: the one it states, else that of its page.
#: The partition column ``operation`` is always that of the page, so that the
#: written-partition guard and the page names speak of the same snapshot.
OWN_OPERATION = "_listing_operation"

_INTEGER_IN_SILVER = {"rooms", "bathrooms"}


def _silver_field(f: T.StructField) -> T.StructField:
    if f.name in _INTEGER_IN_SILVER:
        return T.StructField(f.name, T.IntegerType())
    return f


#: Silver history as stored; ``operation`` and ``snapshot_date`` are partitions.
SILVER_SCHEMA = T.StructType(
    [_silver_field(f) for f in ELEMENT_SCHEMA]
    + [
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("_page_file", T.StringType()),
        T.StructField("_page_pos", T.IntegerType()),
        T.StructField(OWN_OPERATION, T.StringType()),
    ]
)

PARTITION_COLUMNS = ("operation", "snapshot_date")

INVOCATIONS_SCHEMA = T.StructType(
    [
        T.StructField("function_name", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("message", T.StringType()),
    ]
)

REQUESTS_SCHEMA = T.StructType(
    [
        T.StructField("credential_set", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)

COSTS_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("service", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)),
    ]
)


def _records(*fields: tuple[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields]))


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_PLACE = (("district", _S), ("neighborhood", _S))
_MEANS = (("count_listings", _L), ("mean_priceByArea", _D), ("mean_size", _D), ("mean_price", _D))
_RATIO = (
    ("mean_priceByArea_sale", _D),
    ("mean_priceByArea_rent", _D),
    ("mean_sales_price_by_rent_ratio", _D),
    ("count_listings_sale", _L),
    ("count_listings_rent", _L),
)
_BOX = (("count", _L), ("min", _D), ("q1", _D), ("median", _D), ("q3", _D), ("max", _D))

# Record shape of every gold dataset, keyed by its name in the document.
DATASET_TYPES: dict[str, T.ArrayType] = {
    "price_time_series_neighborhood": _records(
        ("operation", _S), *_PLACE, ("snapshot_date", _S), *_MEANS
    ),
    "price_time_series_district": _records(
        ("operation", _S), ("district", _S), ("snapshot_date", _S), *_MEANS
    ),
    "rent_vs_sale_ratio": _records(*_PLACE, *_RATIO),
    "rent_vs_sale_ratio_time_series": _records(*_PLACE, ("snapshot_date", _S), *_RATIO),
    "boxplot_by_neighborhood": _records(("operation", _S), *_PLACE, *_BOX),
    "boxplot_by_neighborhood_last_3m": _records(("operation", _S), *_PLACE, *_BOX),
    "weekly_listing_volume": _records(
        ("operation", _S), ("snapshot_date", _S), ("count_listings", _L)
    ),
    "size_histogram_10sqm": _records(
        ("operation", _S), ("bin_start_m2", _L), ("bin_end_m2", _L), ("count_listings", _L)
    ),
    "rooms_distribution": _records(("operation", _S), ("rooms", _I), ("count_listings", _L)),
    "price_per_area_histogram": _records(
        ("operation", _S),
        ("bin_start_price_m2", _D),
        ("bin_end_price_m2", _D),
        ("count_listings", _L),
    ),
    "listing_location_grid_last_3m": _records(
        ("operation", _S), *_PLACE, ("latitude", _D), ("longitude", _D), ("count_listings", _L)
    ),
    "listing_locations_last_3m": _records(
        ("operation", _S), *_PLACE, ("latitude", _D), ("longitude", _D)
    ),
}

GENERAL_DATASETS = (
    "price_time_series_neighborhood",
    "price_time_series_district",
    "rent_vs_sale_ratio",
    "rent_vs_sale_ratio_time_series",
    "boxplot_by_neighborhood",
    "boxplot_by_neighborhood_last_3m",
)
RELEVANT_DATASETS = GENERAL_DATASETS[2:]
DATA_BASIS_DATASETS = (
    "weekly_listing_volume",
    "size_histogram_10sqm",
    "rooms_distribution",
    "price_per_area_histogram",
    "listing_location_grid_last_3m",
    "listing_locations_last_3m",
)


#: Datasets with a row per property. They are tables of their own; the document names
#: the place. All others are bounded by the calendar and the map, and are in the document.
TABLE_DATASETS = ("listing_locations_last_3m",)


def _block(names: tuple[str, ...]) -> T.StructType:
    return T.StructType(
        [T.StructField(n, _S if n in TABLE_DATASETS else DATASET_TYPES[n]) for n in names]
    )


#: The part of the gold document that holds datasets, as readers parse it.
GOLD_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", _S),
        T.StructField("generated_at", _S),
        T.StructField("scope_districts", T.ArrayType(_S)),
        T.StructField("min_count", _I),
        T.StructField("general", _block(GENERAL_DATASETS)),
        T.StructField("relevant", _block(RELEVANT_DATASETS)),
        T.StructField("data_basis", _block(DATA_BASIS_DATASETS)),
    ]
)


def _check(*details: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("status", _S),
            T.StructField("summary", _S),
            T.StructField("details", T.StructType(list(details))),
            T.StructField("evaluated_at", _S),
        ]
    )


_FUNCTION_DETAIL = T.StructType(
    [
        T.StructField("status", _S),
        T.StructField("insufficient_history", T.BooleanType()),
        T.StructField("invocations_checked", _L),
        T.StructField("max_duration_seconds", _D),
        T.StructField(
            "recent_invocations",
            _records(
                ("timestamp", _S), ("succeeded", T.BooleanType()), ("duration_seconds", _D)
            ),
        ),
    ]
)
_EXECUTIONS = _check(T.StructField("functions", T.MapType(_S, _FUNCTION_DETAIL)))
_CREDENTIAL_SET = T.StructType(
    [
        T.StructField("status", _S),
        T.StructField("label", _S),
        T.StructField("monthly_requests", T.MapType(_S, _D)),
        T.StructField("quota", _I),
    ]
)

#: The health document, as readers parse it.
HEALTH_DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", _S),
        T.StructField("generated_at", _S),
        T.StructField("overall_status", _S),
        T.StructField("execution_success", _EXECUTIONS),
        T.StructField("execution_duration", _EXECUTIONS),
        T.StructField(
            "api_quota", _check(T.StructField("credential_sets", T.MapType(_S, _CREDENTIAL_SET)))
        ),
        T.StructField(
            "aws_cost",
            _check(
                T.StructField("included_total_usd", _D),
                T.StructField("excluded_total_usd", _D),
                T.StructField("excluded_services", T.ArrayType(_S)),
                T.StructField(
                    "monthly_cost_by_service",
                    _records(("month", _S), ("services", T.MapType(_S, _D))),
                ),
            ),
        ),
    ]
)
