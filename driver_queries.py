"""Every operator over the driver's tables, by name.

Means, quantiles and other computed doubles are rounded here, and in the oracle
SQL alike, since two engines add doubles in different orders. The small offset
keeps exact ties from rounding apart. The operators themselves never round.
"""

from __future__ import annotations

import dataclasses
import datetime
import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import driver_views as views
from casametra.functions.columns import iso_date, iso_timestamp
from casametra.operators import cleaning, dedup, filters, health, kpi, locations, market
from casametra.operators import profile, snapshots
from casametra.operators.cells import unit_cells
from casametra.operators.spatial import Box
from casametra.plans import gold, maintained
from casametra.plans.dashboard import (
    block_datasets,
    headline_figures,
    read_gold,
    scoped_block,
)
from casametra.plans.health import checks, health_document
from casametra.plans.silver import backfill, clean_snapshots, snapshot_ledger
from casametra.sources import bronze, csv_export, location_table, silver_table
from casametra.staging import Staging, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

P, ORDER = views.MARKET, views.ORDER
GENERATED_AT = "2026-01-01T12:00:00+00:00"


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) for c in columns})


def with_iso(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    return df.withColumn(column, iso_date(F.col(column)))


# --- shared inputs ----------------------------------------------------------


def scoped(spark: SparkSession, sf: str) -> DataFrame:
    return filters.in_scope(views.silver(spark, sf), P.scope_districts)


def population(spark: SparkSession, sf: str, only_relevant: bool = False) -> DataFrame:
    listings = scoped(spark, sf)
    return filters.relevant(listings, P.relevant) if only_relevant else listings


def first_rows(listings: DataFrame) -> DataFrame:
    return dedup.first_per_snapshot(listings, ORDER)


def cells(spark: SparkSession, sf: str, only_relevant: bool = False) -> DataFrame:
    return unit_cells(first_rows(population(spark, sf, only_relevant)))


def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_per_property(scoped(spark, sf), ORDER)


def recent_rows(spark: SparkSession, sf: str) -> DataFrame:
    recent = filters.in_window(scoped(spark, sf), P.window_months)
    return dedup.latest_per_property(recent, ORDER)


def boxes(spark: SparkSession, sf: str, only_relevant: bool = False) -> DataFrame:
    listings = first_rows(population(spark, sf, only_relevant))
    return market.boxplot(listings)


def recent_boxes(spark: SparkSession, sf: str, only_relevant: bool = False) -> DataFrame:
    recent = filters.in_window(population(spark, sf, only_relevant), P.window_months)
    return market.boxplot(first_rows(recent), P.min_count)


def ratios(spark: SparkSession, sf: str, only_relevant: bool = False) -> DataFrame:
    return market.rent_vs_sale_ratio(cells(spark, sf, only_relevant), P.min_count)


def ratio_series(spark: SparkSession, sf: str, only_relevant: bool = False) -> DataFrame:
    return market.rent_vs_sale_ratio_series(cells(spark, sf, only_relevant), P.min_count)


def explored(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_for_exploration(views.silver(spark, sf), P.scope_districts)


def decoded_keys(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.decode_keys(views.page_keys(spark, sf))


def found_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshots_of(bronze.valid_keys(decoded_keys(spark, sf)))


def orders_now(spark: SparkSession, sf: str) -> Column:
    """The day before the latest order, so that its month is under way."""
    latest = views.table(spark, sf, "orders").agg(F.max("o_orderdate")).scalar()
    return F.date_sub(latest, 1)


def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = views.invocations(spark, sf)
    now = runs.agg(F.max("ts")).scalar()
    return health.recent_invocations(runs, now, views.HEALTH)


def scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark, name)}/data"


def staging(spark: SparkSession, name: str) -> Staging:
    """Intermediate tables that stay until the session ends, as results are read later."""
    stage = Staging(spark)
    stage.root = scratch_dir(spark, name)
    return stage


# --- raw pages and silver ---------------------------------------------------


def bronze_key_decode(spark: SparkSession, sf: str) -> DataFrame:
    return with_iso(decoded_keys(spark, sf))


def bronze_skipped_keys(spark: SparkSession, sf: str) -> DataFrame:
    skipped = bronze.skipped_keys(decoded_keys(spark, sf))
    return skipped.groupBy("key").agg(F.count("*").alias("n"))


def page_elements(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.explode_elements(bronze.parse_pages(views.pages(spark, sf)))


def bronze_page_scan(spark: SparkSession, sf: str) -> DataFrame:
    elements = page_elements(spark, sf)
    return with_iso(elements).select(
        F.col("_page_file").alias("page_file"),
        F.col("_page_pos").alias("page_pos"),
        "page_operation",
        "snapshot_date",
        "operation",
        "propertyCode",
        "neighborhood",
        "priceByArea",
        "bathrooms",
        "hasLift",
        "parkingSpace",
    )


def bronze_quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile_row = bronze.quality_profile(
        bronze.parse_pages(views.pages(spark, sf, damaged=True), mode="PERMISSIVE")
    )
    return rounded(
        profile_row, "null_price_by_area_pct", "missing_neighborhood_pct", "missing_operation_pct"
    )


def bronze_failed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.failed_pages(bronze.parse_pages(views.pages(spark, sf, damaged=True), mode="PERMISSIVE"))


def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    return with_iso(views.silver(spark, sf)).drop(*ORDER)


def silver_from_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to silver rows, counted per partition."""
    stored = cleaning.to_stored(page_elements(spark, sf))
    return with_iso(stored).groupBy("operation", "snapshot_date").agg(
        F.count("*").alias("n_rows"),
        F.sum("_page_pos").alias("sum_pos"),
        F.count_if(F.col("_listing_operation") == F.col("operation")).alias("n_operation"),
    )


def silver_history_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows written as partitions and read back as the history."""
    root = scratch(spark, "silver")
    stored = cleaning.to_stored(page_elements(spark, sf))
    silver_table.write_snapshots(stored, root)
    history = silver_table.read_history(spark, root)
    return rounded(
        with_iso(history).groupBy("operation", "snapshot_date").agg(
            F.count("*").alias("n_rows"),
            F.countDistinct("propertyCode").alias("n_properties"),
            F.sum("price").alias("sum_price"),
            F.sum("rooms").alias("sum_rooms"),
        ),
        "sum_price",
        digits=2,
    )


def silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The partitions of rent come first; the guard then lets only sale through."""
    root = scratch(spark, "silver")
    # both runs take rows from what the pages gave once
    stored = staging(spark, "cleaned").table(cleaning.to_stored(page_elements(spark, sf)), "rows")
    silver_table.write_snapshots(stored.filter(F.col("operation") == "rent"), root)
    written = silver_table.written_snapshots(spark, root)
    fresh = snapshots.unwritten(stored, written)
    return with_iso(fresh).groupBy("operation", "snapshot_date").agg(
        F.count("*").alias("n_rows")
    )


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "csv")
    listings = views.silver(spark, sf).drop(*ORDER)
    csv_export.write_csv(listings, path)
    return with_iso(csv_export.read_csv(spark, path, listings.schema))


def silver_job_run(spark: SparkSession, sf: str) -> DataFrame:
    """The silver job over landed page files: the latest snapshots, then the backfill.

    Per written partition: which run wrote it, the rows it reported, and what the history
    has of it; ``skipped`` is the number of keys that did not decode.
    """
    pages_root, silver_root = scratch(spark, "bronze"), scratch(spark, "silver")
    views.land_pages(spark, sf, pages_root)
    runs = {
        "latest": clean_snapshots(spark, pages_root, silver_root),
        "backfill": backfill(spark, pages_root, silver_root),
        "again": backfill(spark, pages_root, silver_root),
    }
    reported = spark.createDataFrame(
        [(name, op, day.isoformat(), n, run.skipped) for name, run in runs.items() for op, day, n in run.written],
        "run string, operation string, snapshot_date string, n_reported long, skipped long",
    )
    history = silver_table.read_history(spark, silver_root)
    stored = with_iso(history).groupBy("operation", "snapshot_date").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("propertyCode").alias("n_properties"),
        F.sum("price").alias("sum_price"),
    )
    return rounded(reported.join(stored, ["operation", "snapshot_date"], "full"), "sum_price", digits=2)


def silver_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What the ledger of two runs of the silver job has of each snapshot."""
    pages_root, silver_root = scratch(spark, "bronze"), scratch(spark, "silver")
    views.land_pages(spark, sf, pages_root)
    clean_snapshots(spark, pages_root, silver_root)
    backfill(spark, pages_root, silver_root)
    entries = snapshot_ledger(spark, silver_root).entries()
    return with_iso(entries).groupBy("operation", "snapshot_date").agg(
        F.count("page_file").alias("pages"), F.sum("n_rows").alias("n_rows")
    )


def silver_empty_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The silver job over snapshots of which one operation cleans to nothing.

    The pages of rent have only listings without a price per area or a neighborhood.
    """
    pages_root, silver_root = scratch(spark, "bronze"), scratch(spark, "silver")
    dropped = F.col("l_quantity").isin(49.0, 50.0)
    kept = (F.col("page_operation") == "sale") | dropped
    views.land(views.paged(views.elements(spark, sf).filter(kept)), pages_root)
    runs = [backfill(spark, pages_root, silver_root) for _ in range(2)]
    found = [(n, run.snapshots_found, op, day.isoformat(), rows) for n, run in enumerate(runs) for op, day, rows in run.written]
    reported = spark.createDataFrame(
        found, "run long, snapshots_found boolean, operation string, snapshot_date string, n_rows long"
    )
    keys = bronze.valid_keys(bronze.decode_keys(bronze.list_keys(spark, pages_root)))
    landed = with_iso(snapshots.snapshots_of(keys))
    return landed.join(reported, ["operation", "snapshot_date"], "left")


def silver_refused_table(spark: SparkSession, sf: str) -> DataFrame:
    """The refusal of a table without a required column, as a row; and the rows it has."""
    out = []
    for missing in ("operation", "snapshot_date"):
        root = scratch(spark, "refused")
        views.silver(spark, sf).drop(missing).write.parquet(root)
        try:
            silver_table.read_history(spark, root)
            refused = False
        except ValueError as error:
            refused = missing in str(error)
        out.append(spark.read.parquet(root).agg(
            F.lit(missing).alias("missing"), F.lit(refused).alias("refused"), F.count("*").alias("n_rows")
        ))
    return out[0].unionByName(out[1])


def gold_of_no_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Records of each gold dataset over a history with nothing in scope."""
    nothing = dataclasses.replace(P, scope_districts=("ATLANTIS",))
    result = gold.write_gold(
        spark, views.silver(spark, sf), scratch(spark, "gold"), F.lit(GENERATED_AT), nothing, ORDER
    )
    doc = read_gold(spark, result.document)
    parts = [
        df.agg(F.lit(b).alias("block"), F.lit(name).alias("dataset"), F.count("*").alias("n_records"))
        for b in ("general", "relevant", "data_basis")
        for name, df in block_datasets(doc, b).items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def silver_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return with_iso(found_snapshots(spark, sf))


def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return with_iso(snapshots.latest_snapshots(found_snapshots(spark, sf)))


def snapshot_on_date(spark: SparkSession, sf: str) -> DataFrame:
    day = datetime.date(1998, 6, 15)
    return with_iso(snapshots.snapshots_on(found_snapshots(spark, sf), day))


def snapshot_dates(spark: SparkSession, sf: str) -> DataFrame:
    return with_iso(snapshots.snapshot_dates(found_snapshots(spark, sf)))


def unwritten_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots on days without a pending order count as not yet written."""
    written = (
        views.table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(F.to_date("o_orderdate").alias("snapshot_date"))
        .distinct()
        .select(F.explode(F.array(F.lit("rent"), F.lit("sale"))).alias("operation"), "snapshot_date")
    )
    return with_iso(snapshots.unwritten(found_snapshots(spark, sf), written))


# --- filters and dedup ------------------------------------------------------

LISTING_VIEW = (
    "operation",
    "district",
    "neighborhood",
    "snapshot_date",
    "propertyCode",
    "price",
    "priceByArea",
    "size",
    "floor",
    "rooms",
    "bathrooms",
    "hasLift",
)


def listing_view(df: DataFrame) -> DataFrame:
    return with_iso(df).select(*LISTING_VIEW)


def scope_filter(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(scoped(spark, sf))


def relevant_filter(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(filters.relevant(views.silver(spark, sf), P.relevant))


def rolling_window(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(filters.in_window(views.silver(spark, sf), P.window_months))


def coordinate_filter(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(filters.with_coordinates(views.silver(spark, sf)))


def exploration_clean(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(explored(spark, sf))


def dashboard_scope(spark: SparkSession, sf: str) -> DataFrame:
    """Both series under one selection; the district series has no neighborhood."""
    block = scoped_block(
        {
            "neighborhood": market.price_series_by_neighborhood(cells(spark, sf)),
            "district": market.price_series_by_district(cells(spark, sf)),
        },
        districts=("AFRICA", "ASIA"),
        neighborhoods=("NATION_12", "NATION_15"),
    )
    return block["neighborhood"].unionByName(
        block["district"], allowMissingColumns=True
    ).select("operation", "district", "neighborhood", "snapshot_date", "count_listings")


def dedup_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(dedup.first_per_snapshot(views.silver(spark, sf), ORDER))


def latest_by_property(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(dedup.latest_per_property(views.silver(spark, sf), ORDER))


def dedup_global(spark: SparkSession, sf: str) -> DataFrame:
    order = ("operation", "snapshot_date", *ORDER)
    return listing_view(dedup.last_per_property(views.silver(spark, sf), order))


# --- gold datasets ----------------------------------------------------------

MEANS = ("mean_priceByArea", "mean_size", "mean_price")
RATIO = (
    "mean_priceByArea_sale",
    "mean_priceByArea_rent",
    "mean_sales_price_by_rent_ratio",
)
BOX = ("min", "q1", "median", "q3", "max")


def price_ts_neighborhood(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(market.price_series_by_neighborhood(cells(spark, sf)), *MEANS)


def price_ts_district(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(market.price_series_by_district(cells(spark, sf)), *MEANS)


def weekly_volume(spark: SparkSession, sf: str) -> DataFrame:
    return market.weekly_volume(cells(spark, sf))


def ratio_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ratios(spark, sf), *RATIO)


def ratio_all_relevant(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ratios(spark, sf, True), *RATIO)


def ratio_ts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ratio_series(spark, sf), *RATIO)


def ratio_ts_relevant(spark: SparkSession, sf: str) -> DataFrame:
    listings = cells(spark, sf, True)
    return rounded(market.rent_vs_sale_ratio_series(listings, 1), *RATIO)


def boxplot_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(boxes(spark, sf), *BOX)


def boxplot_all_relevant(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(boxes(spark, sf, True), *BOX)


def boxplot_last_3m(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(recent_boxes(spark, sf), *BOX)


def boxplot_last_3m_relevant(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(recent_boxes(spark, sf, True), *BOX)


def size_hist(spark: SparkSession, sf: str) -> DataFrame:
    return market.size_histogram(latest_rows(spark, sf), P.size_bin_m2)


def rooms_dist(spark: SparkSession, sf: str) -> DataFrame:
    return market.rooms_distribution(latest_rows(spark, sf))


def price_hist(spark: SparkSession, sf: str) -> DataFrame:
    return market.price_histogram(latest_rows(spark, sf), P.price_bin_widths)


def location_grid(spark: SparkSession, sf: str) -> DataFrame:
    grid = locations.location_grid(recent_rows(spark, sf), P.grid_decimals)
    return rounded(grid, "latitude", "longitude", digits=6)


def listing_locations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        locations.listing_locations(recent_rows(spark, sf)), "latitude", "longitude", digits=6
    )


def written_document(spark: SparkSession, sf: str) -> DataFrame:
    """The gold job's document, written and read back."""
    result = gold.write_gold(
        spark, views.silver(spark, sf), scratch(spark, "gold"), F.lit(GENERATED_AT), P, ORDER
    )
    return read_gold(spark, result.document)


#: Columns of the gold datasets that are keys; what else a dataset has are its values.
GOLD_KEYS = ("operation", "district", "neighborhood", "snapshot_date")


def gold_records(datasets: dict[str, DataFrame], block_name: str) -> DataFrame:
    """All records of a block in one shape: keys, and values by position."""
    parts = []
    for name, df in datasets.items():
        values = [c for c in df.columns if c not in GOLD_KEYS]
        parts.append(
            df.select(
                F.lit(block_name).alias("block"),
                F.lit(name).alias("dataset"),
                *[(F.col(k) if k in df.columns else F.lit(None).cast("string")).alias(k) for k in GOLD_KEYS],
                *[
                    (F.round(F.col(values[i]).cast("double") + 1e-9, 4) if i < len(values) else F.lit(None).cast("double")).alias(f"v{i}")
                    for i in range(6)
                ],
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


def gold_document(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of the written document, and of the table that it names."""
    doc = written_document(spark, sf)
    blocks = [gold_records(block_datasets(doc, b), b) for b in ("general", "relevant", "data_basis")]
    return functools.reduce(DataFrame.unionByName, blocks)


def _gold_tables(spark: SparkSession, sf: str, block_name: str) -> DataFrame:
    result = gold.write_gold(
        spark, views.silver(spark, sf), scratch(spark, "gold"), F.lit(GENERATED_AT), P, ORDER
    )
    names = [name for b, name in result.rows if b == block_name]
    return gold_records(
        {name: spark.read.parquet(f"{result.tables}/{block_name}/{name}") for name in names}, block_name
    )


def gold_tables_general(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_tables(spark, sf, "general")


def gold_tables_relevant(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_tables(spark, sf, "relevant")


def gold_tables_data_basis(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_tables(spark, sf, "data_basis")


# --- maintained gold ----------------------------------------------------------


def maintained_state(spark: SparkSession, sf: str) -> maintained.GoldState:
    """The state after three runs: later dates first, earlier ones after, one date again."""
    root = scratch(spark, "listings")
    listings = views.silver(spark, sf)
    listings.hint("rebalance", "snapshot_date").write.partitionBy("snapshot_date").parquet(root)
    stored = spark.read.schema(listings.schema).parquet(root)
    days = sorted(r[0] for r in stored.select("snapshot_date").distinct().collect())
    half = len(days) // 2
    state = maintained.GoldState(
        spark, scratch(spark, "state"), P, ORDER, listings.schema, buckets=8
    )
    for batch in (days[half:], days[:half], days[half : half + 1]):
        state.absorb(stored.filter(F.col("snapshot_date").isin(batch)), [(None, d) for d in batch])
    return state


def gold_from_state(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of the document that the maintained aggregates give."""
    state = maintained_state(spark, sf)
    result = maintained.write_gold(spark, state, scratch(spark, "gold"), F.lit(GENERATED_AT))
    doc = read_gold(spark, result.document)
    blocks = [gold_records(block_datasets(doc, b), b) for b in ("general", "relevant", "data_basis")]
    return functools.reduce(DataFrame.unionByName, blocks)


def latest_rows_state(spark: SparkSession, sf: str) -> DataFrame:
    """The latest row of each property after three merges."""
    state = maintained_state(spark, sf)
    rows = state.latest.rows(state.ledger.commits()[-1]).drop(*ORDER)
    return rounded(with_iso(rows), "priceByArea").drop("latitude", "longitude")


def boxplot_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Box plots of all time out of the value counts of the snapshots."""
    return rounded(maintained_state(spark, sf).boxes("general"), *BOX)


def boxplot_merged_last_3m(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(maintained_state(spark, sf).inputs().everyone.recent_boxes(), *BOX)


def locations_in_box(spark: SparkSession, sf: str) -> DataFrame:
    """A section of the map from the files that lie under it."""
    root = scratch(spark, "locations")
    location_table.write_locations(locations.listing_locations(recent_rows(spark, sf)), root, files=16)
    found = location_table.read_box(spark, root, Box(39.42, -0.397, 39.46, -0.392))
    return rounded(found, "latitude", "longitude", digits=6)


# --- exploratory statistics -------------------------------------------------


def download_volume(spark: SparkSession, sf: str) -> DataFrame:
    return with_iso(profile.download_volume(explored(spark, sf)))


def monthly_volume(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        profile.mean_download_volume(explored(spark, sf)), "weekly_mean", "monthly_mean"
    )


def neighborhood_stats(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.neighborhood_statistics(explored(spark, sf)), *MEANS)


WIDE = (*RATIO, "mean_size_sale", "mean_size_rent", "mean_price_sale", "mean_price_rent")


def ratio_wide(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.wide_ratio(unit_cells(explored(spark, sf))), *WIDE)


def ratio_wide_relevant(spark: SparkSession, sf: str) -> DataFrame:
    listings = filters.relevant(explored(spark, sf), P.relevant)
    order = ("operation", "snapshot_date", *ORDER)
    return rounded(
        profile.wide_ratio(unit_cells(dedup.last_per_property(listings, order))), *WIDE
    )


def ordered_means(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.neighborhood_order(explored(spark, sf)), "mean_priceByArea")


def describe_by_operation(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe(views.silver(spark, sf)), "mean", "std", *BOX)


def zero_rooms_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return profile.count_where_zero(views.silver(spark, sf), "rooms", "propertyType")


def zero_bathrooms_by_neighborhood(spark: SparkSession, sf: str) -> DataFrame:
    return profile.count_where_zero(views.elements(spark, sf), "bathrooms", "neighborhood")


def correlation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.correlation_pairs(views.silver(spark, sf)), "abs_correlation")


def redundant_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.redundant_columns(profile.correlation_pairs(views.silver(spark, sf)), 0.5)


def drop_redundant(spark: SparkSession, sf: str) -> DataFrame:
    """Listings less the columns that correlate with an earlier one."""
    listings = views.silver(spark, sf).select("propertyCode", *profile.CORRELATED_COLUMNS)
    kept = profile.drop_redundant(listings, threshold=0.5)
    numbers = [F.col(c).cast("double").alias(c) for c in kept.columns if c != "propertyCode"]
    return kept.select("propertyCode", *numbers)


def first_listings(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(profile.head(views.silver(spark, sf), 3, ORDER))


def sampled_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly 500 listings by the hash of their keys, the same from any partitioning."""
    listings = views.silver(spark, sf)
    drawn = profile.sample_rows(listings, 500, ("l_orderkey", "l_linenumber", "propertyCode"), seed=7)
    return drawn.select("l_orderkey", "l_linenumber", "propertyCode", "operation")


def max_price(spark: SparkSession, sf: str) -> DataFrame:
    return profile.highest_price_per_area(views.silver(spark, sf))


def scope_districts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.scope_districts([ratios(spark, sf), recent_boxes(spark, sf)])


def scope_neighborhoods(spark: SparkSession, sf: str) -> DataFrame:
    datasets = [
        market.price_series_by_neighborhood(cells(spark, sf)),
        market.price_series_by_district(cells(spark, sf)),
    ]
    return profile.scope_neighborhoods(datasets, ("ASIA", "EUROPE"))


# --- headline figures and series --------------------------------------------


def weighted_median_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kpi.weighted_median(boxes(spark, sf)), "weighted_median")


def preferred_boxes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kpi.preferred_boxes(recent_boxes(spark, sf), boxes(spark, sf)), *BOX)


def preferred_boxes_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """No neighborhood reaches the minimum, so the all-time summary steps in."""
    recent = recent_boxes(spark, sf).filter(F.col("count") < 0)
    return rounded(kpi.preferred_boxes(recent, boxes(spark, sf)), *BOX)


def gross_yield(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kpi.gross_yield(ratios(spark, sf)), "implied_gross_yield_percent")


def listing_total(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.total_listings(ratios(spark, sf))


def kpi_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The figures over inputs that are written once, as the gold job writes them."""
    stage = staging(spark, "kpi")
    trend = gold.trend_inputs(population(spark, sf), P, ORDER, stage)
    recent = filters.in_window(trend.listings, P.window_months, trend.anchor)
    boxes_of_window = market.boxplot(recent, P.min_count, keep=trend.keep_as("recent"))
    figures = kpi.summary(
        boxes_of_window, market.rent_vs_sale_ratio(trend.cells, P.min_count), F.lit(GENERATED_AT)
    )
    return rounded(
        figures, "median_rent_per_m2_month", "median_sale_per_m2", "implied_gross_yield_percent"
    )


def dashboard_figures(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of the relevant block, from the written document."""
    doc = written_document(spark, sf)
    return rounded(
        headline_figures(doc, block_datasets(doc, "relevant")),
        "median_rent_per_m2_month",
        "median_sale_per_m2",
        "implied_gross_yield_percent",
    )


def points_of(lines: DataFrame, keys: Sequence[str], y_digits: int | None = 4) -> DataFrame:
    """Series arrays as rows with their positions."""
    rows = lines.select(*keys, F.posexplode("points").alias("pos", "p")).select(
        *keys, "pos", F.col("p.x").alias("x"), F.col("p.y").alias("y")
    )
    return rows if y_digits is None else rounded(rows, "y", digits=y_digits)


PLACE = ("operation", "district", "neighborhood")


def series_neighborhood(spark: SparkSession, sf: str) -> DataFrame:
    dataset = market.price_series_by_neighborhood(cells(spark, sf))
    return points_of(kpi.price_series_lines(filters.of_operation(dataset, "sale")), PLACE)


def series_district(spark: SparkSession, sf: str) -> DataFrame:
    dataset = market.price_series_by_district(cells(spark, sf))
    return points_of(kpi.price_series_lines(dataset), PLACE[:2])


def series_counts_neighborhood(spark: SparkSession, sf: str) -> DataFrame:
    dataset = market.price_series_by_neighborhood(cells(spark, sf))
    return points_of(kpi.count_series_lines(dataset), PLACE, None)


def series_counts_district(spark: SparkSession, sf: str) -> DataFrame:
    dataset = market.price_series_by_district(cells(spark, sf))
    return points_of(kpi.count_series_lines(dataset), PLACE[:2], None)


def series_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return points_of(kpi.ratio_series_lines(ratio_series(spark, sf)), PLACE[1:])


def series_volume(spark: SparkSession, sf: str) -> DataFrame:
    return points_of(
        kpi.volume_line(market.weekly_volume(cells(spark, sf))), ("operation",), None
    )


def bars_size(spark: SparkSession, sf: str) -> DataFrame:
    return points_of(kpi.size_bars(size_hist(spark, sf)), ("operation",), None)


def bars_rooms(spark: SparkSession, sf: str) -> DataFrame:
    return points_of(kpi.room_bars(rooms_dist(spark, sf)), ("operation",), None)


def bars_price(spark: SparkSession, sf: str) -> DataFrame:
    return points_of(kpi.price_bars(price_hist(spark, sf)), ("operation",), None)


def ratio_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(kpi.ratio_scatter(ratios(spark, sf)), "x", "y")


def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.map_points(listing_locations(spark, sf))


def grid_points(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.grid_points(location_grid(spark, sf))


# --- health -----------------------------------------------------------------


def recent_invocations(spark: SparkSession, sf: str) -> DataFrame:
    runs = recent_runs(spark, sf).withColumn("ts", iso_timestamp(F.col("ts")))
    return rounded(runs, "duration_seconds")


def execution_success(spark: SparkSession, sf: str) -> DataFrame:
    return health.execution_success(recent_runs(spark, sf), views.HEALTH)


def execution_duration(spark: SparkSession, sf: str) -> DataFrame:
    checked = health.execution_duration(recent_runs(spark, sf), views.HEALTH)
    return rounded(checked, "max_duration_seconds")


def invocation_series(spark: SparkSession, sf: str) -> DataFrame:
    lines = health.invocation_series(recent_runs(spark, sf))
    return rounded(
        lines.select("function_name", F.posexplode("points").alias("pos", "p")).select(
            "function_name",
            "pos",
            iso_timestamp(F.col("p.timestamp")).alias("ts"),
            "p.succeeded",
            "p.duration_seconds",
        ),
        "duration_seconds",
    )


def monthly_requests(spark: SparkSession, sf: str) -> DataFrame:
    return health.monthly_requests(
        views.requests(spark, sf), orders_now(spark, sf), views.HEALTH
    )


def api_quota(spark: SparkSession, sf: str) -> DataFrame:
    quota = health.api_quota(monthly_requests(spark, sf), views.HEALTH)
    return quota.drop("monthly_requests")


def quota_series(spark: SparkSession, sf: str) -> DataFrame:
    series = health.quota_series(
        health.api_quota(monthly_requests(spark, sf), views.HEALTH)
    )
    return series.select(
        "credential_set",
        "label",
        F.posexplode(F.arrays_zip("months", "values")).alias("pos", "p"),
    ).select(
        "credential_set",
        "label",
        "pos",
        F.col("p.months").alias("month"),
        F.col("p.values").alias("requests"),
    )


def request_accounting(spark: SparkSession, sf: str) -> DataFrame:
    """Every attempted page is charged, also those that never landed (lines 5 and 6)."""
    charged = health.requests_of_attempts(views.attempts(spark, sf)).dropna(subset=["credential_set"])
    return charged.groupBy("credential_set", F.trunc("ts", "MM").alias("month")).agg(
        F.sum("value").alias("requests")
    ).withColumn("month", iso_date(F.col("month")))


def _cost_row(row: DataFrame) -> DataFrame:
    return row.select(
        "status",
        F.col("included_total").cast("double").alias("included_total"),
        F.col("excluded_total").cast("double").alias("excluded_total"),
        F.array_join("excluded_services", ",").alias("excluded_services"),
    )


def cost_mtd(spark: SparkSession, sf: str) -> DataFrame:
    return _cost_row(
        health.month_to_date_cost(
            views.costs(spark, sf), orders_now(spark, sf), views.HEALTH
        )
    )


def cost_mtd_first_of_month(spark: SparkSession, sf: str) -> DataFrame:
    """On the first day of a month the window is the whole month."""
    first = F.add_months(F.trunc(orders_now(spark, sf), "MM"), -1)
    return _cost_row(
        health.month_to_date_cost(views.costs(spark, sf), first, views.HEALTH)
    )


def cost_history(spark: SparkSession, sf: str) -> DataFrame:
    history = health.cost_history(
        views.costs(spark, sf), orders_now(spark, sf), views.HEALTH
    )
    return history.select("month", F.explode("services").alias("service", "amount")).withColumn(
        "amount", F.col("amount").cast("double")
    )


def cost_matrix(spark: SparkSession, sf: str) -> DataFrame:
    by_service = health.cost_by_month_and_service(
        views.costs(spark, sf), orders_now(spark, sf), views.HEALTH
    ).withColumn("amount", F.col("amount").cast("double"))
    services = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
    return health.cost_matrix(by_service, services)


def overall_status(spark: SparkSession, sf: str) -> DataFrame:
    statuses = (
        execution_success(spark, sf).select("status")
        .unionByName(execution_duration(spark, sf).select("status"))
        .unionByName(api_quota(spark, sf).select("status"))
        .unionByName(cost_mtd(spark, sf).select("status"))
    )
    return health.worst_status(statuses)


def stage_status(spark: SparkSession, sf: str) -> DataFrame:
    recent = recent_runs(spark, sf)
    return health.stage_statuses(
        health.execution_success(recent, views.HEALTH),
        health.execution_duration(recent, views.HEALTH),
        views.STAGES,
    )


def health_document_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses out of the whole health document.

    Requests and costs are anchored to the orders, invocations to the events.
    """
    events_now = views.invocations(spark, sf).agg(F.max("ts")).scalar()
    named = {
        **checks(
            views.invocations(spark, sf),
            views.requests(spark, sf),
            views.costs(spark, sf),
            orders_now(spark, sf),
            views.HEALTH,
        ),
        **{
            name: check
            for name, check in checks(
                views.invocations(spark, sf),
                views.requests(spark, sf),
                views.costs(spark, sf),
                events_now,
                views.HEALTH,
            ).items()
            if name.startswith("execution")
        },
    }
    doc = health_document(spark, named, datetime.datetime(2026, 1, 1, 12))
    names = ("execution_success", "execution_duration", "api_quota", "aws_cost")
    schema = ", ".join(f"{n} struct<status: string>" for n in names)
    return doc.select(
        F.from_json("value", f"overall_status string, {schema}").alias("d")
    ).select("d.overall_status", *[F.col(f"d.{n}.status").alias(n) for n in names])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        bronze_key_decode,
        bronze_skipped_keys,
        bronze_page_scan,
        bronze_quality_profile,
        bronze_failed_pages,
        silver_clean,
        silver_from_pages,
        silver_history_roundtrip,
        silver_incremental,
        csv_roundtrip,
        silver_job_run,
        silver_ledger,
        silver_empty_snapshot,
        silver_refused_table,
        gold_of_no_listing,
        silver_snapshots,
        latest_snapshot,
        snapshot_on_date,
        snapshot_dates,
        unwritten_snapshots,
        scope_filter,
        relevant_filter,
        rolling_window,
        coordinate_filter,
        exploration_clean,
        dashboard_scope,
        dedup_snapshot,
        latest_by_property,
        dedup_global,
        price_ts_neighborhood,
        price_ts_district,
        weekly_volume,
        ratio_all,
        ratio_all_relevant,
        ratio_ts,
        ratio_ts_relevant,
        boxplot_all,
        boxplot_all_relevant,
        boxplot_last_3m,
        boxplot_last_3m_relevant,
        size_hist,
        rooms_dist,
        price_hist,
        location_grid,
        listing_locations,
        gold_document,
        gold_tables_general,
        gold_tables_relevant,
        gold_tables_data_basis,
        gold_from_state,
        latest_rows_state,
        boxplot_merged,
        boxplot_merged_last_3m,
        locations_in_box,
        download_volume,
        monthly_volume,
        neighborhood_stats,
        ratio_wide,
        ratio_wide_relevant,
        ordered_means,
        describe_by_operation,
        zero_rooms_by_type,
        zero_bathrooms_by_neighborhood,
        correlation_pairs,
        redundant_columns,
        drop_redundant,
        first_listings,
        sampled_listings,
        max_price,
        scope_districts,
        scope_neighborhoods,
        weighted_median_kpi,
        preferred_boxes,
        preferred_boxes_fallback,
        gross_yield,
        listing_total,
        kpi_summary,
        dashboard_figures,
        series_neighborhood,
        series_district,
        series_counts_neighborhood,
        series_counts_district,
        series_ratio,
        series_volume,
        bars_size,
        bars_rooms,
        bars_price,
        ratio_points,
        map_points,
        grid_points,
        recent_invocations,
        execution_success,
        execution_duration,
        invocation_series,
        monthly_requests,
        api_quota,
        quota_series,
        request_accounting,
        cost_mtd,
        cost_mtd_first_of_month,
        cost_history,
        cost_matrix,
        overall_status,
        stage_status,
        health_document_statuses,
    )
}
