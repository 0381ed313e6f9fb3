"""The silver-to-gold job: dataset registry, populations, tables, document."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casametra.operators import market
from casametra.operators.cells import CELL_KEYS, roll_up, unit_cells
from casametra.operators.dedup import first_per_snapshot, latest_per_property
from casametra.operators.filters import in_scope, in_window, latest_date, relevant
from casametra.operators.locations import listing_locations, location_grid
from casametra.params import GOLD_SCHEMA_VERSION, SEARCH_CONFIG, MarketParams
from casametra.schemas import ORDINAL_COLUMNS, TABLE_DATASETS
from casametra.sources.documents import block, document, write_document
from casametra.sources.location_table import write_locations
from casametra.staging import Staging

Blocks = dict[str, dict[str, DataFrame]]


@dataclass(frozen=True)
class TrendInputs:
    """What the datasets of a population start from.

    ``listings`` has one row per property and snapshot, ``cells`` is rolled up
    to the finest grain. ``anchor`` is the latest snapshot date.
    """

    listings: DataFrame
    cells: DataFrame
    anchor: Column
    params: MarketParams
    stage: Staging | None = None
    name: str = "general"

    def keep_as(self, part: str) -> Callable[[DataFrame], DataFrame] | None:
        """A way to store intermediate results in turn, when the job stages at all."""
        if self.stage is None:
            return None
        number = count()
        return lambda df: self.stage.table(df, f"{self.name}/{part}-{next(number)}")


@dataclass(frozen=True)
class BasisInputs:
    """What the data-basis datasets start from.

    ``cells`` are those of the general population; ``latest`` has one row per
    property, ``recent`` one per property of the rolling window.
    """

    cells: DataFrame
    latest: DataFrame
    recent: DataFrame
    params: MarketParams


TrendDataset = Callable[[TrendInputs], DataFrame]
BasisDataset = Callable[[BasisInputs], DataFrame]

RELEVANT: Mapping[str, TrendDataset] = {
    "rent_vs_sale_ratio": lambda t: market.rent_vs_sale_ratio(t.cells, t.params.min_count),
    "rent_vs_sale_ratio_time_series": lambda t: market.rent_vs_sale_ratio_series(
        t.cells, t.params.min_count
    ),
    "boxplot_by_neighborhood": lambda t: market.boxplot(
        t.listings, keep=t.keep_as("buckets")
    ),
    "boxplot_by_neighborhood_last_3m": lambda t: market.boxplot(
        in_window(t.listings, t.params.window_months, t.anchor),
        t.params.min_count,
        keep=t.keep_as("recent_buckets"),
    ),
}

GENERAL: Mapping[str, TrendDataset] = {
    "price_time_series_neighborhood": lambda t: market.price_series_by_neighborhood(t.cells),
    "price_time_series_district": lambda t: market.price_series_by_district(t.cells),
    **RELEVANT,
}

DATA_BASIS: Mapping[str, BasisDataset] = {
    "weekly_listing_volume": lambda b: market.weekly_volume(b.cells),
    "size_histogram_10sqm": lambda b: market.size_histogram(b.latest, b.params.size_bin_m2),
    "rooms_distribution": lambda b: market.rooms_distribution(b.latest),
    "price_per_area_histogram": lambda b: market.price_histogram(
        b.latest, b.params.price_bin_widths, b.params.default_price_bin
    ),
    "listing_location_grid_last_3m": lambda b: location_grid(b.recent, b.params.grid_decimals),
    "listing_locations_last_3m": lambda b: listing_locations(b.recent),
}


_TREND_COLUMNS = (*CELL_KEYS, "propertyCode", "priceByArea", "size", "price")


def trend_inputs(
    listings: DataFrame,
    params: MarketParams = MarketParams(),
    order: Sequence[str] = ORDINAL_COLUMNS,
    stage: Staging | None = None,
    name: str = "general",
) -> TrendInputs:
    """Deduplicate a filtered population once and derive its inputs.

    With ``stage`` both inputs become tables, so that no dataset repeats the
    dedup. Only the columns the datasets need take part in its shuffle.
    """
    order_only = [c for c in order if c not in _TREND_COLUMNS]

    def keep(df: DataFrame, part: str) -> DataFrame:
        return df if stage is None else stage.table(df, f"{name}/{part}")

    slim = listings.select(*_TREND_COLUMNS, *order_only)
    deduped = keep(first_per_snapshot(slim, order).drop(*order_only), "listings")
    cells = keep(roll_up(unit_cells(deduped), CELL_KEYS), "cells")
    return TrendInputs(deduped, cells, latest_date(cells), params, stage, name)


def _latest_rows(
    listings: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    stage: Staging | None,
    name: str,
) -> DataFrame:
    """One row per property, with only the columns the datasets need."""
    keys = ("operation", "propertyCode", "snapshot_date")
    needed = list(dict.fromkeys((*keys, *columns, *order)))
    rows = latest_per_property(listings.select(*needed), order).select("operation", *columns)
    return rows if stage is None else stage.table(rows, name)


@dataclass(frozen=True)
class GoldInputs:
    everyone: TrendInputs
    comparable: TrendInputs
    basis: BasisInputs


def gold_inputs(
    history: DataFrame,
    params: MarketParams = MarketParams(),
    order: Sequence[str] = ORDINAL_COLUMNS,
    stage: Staging | None = None,
) -> GoldInputs:
    """The four dedups of the gold layer and what follows from them directly.

    The relevant population is filtered before its dedup, and so has its own,
    possibly earlier, window. The data basis windows before its dedup too. With
    ``stage`` the independent parts are written at the same time.
    """
    scoped = in_scope(history, params.scope_districts)
    similar = relevant(scoped, params.relevant)
    basis_columns = ("size", "rooms", "priceByArea")
    with ThreadPoolExecutor(max_workers=3) as pool:
        parts = [
            pool.submit(trend_inputs, scoped, params, order, stage, "general"),
            pool.submit(trend_inputs, similar, params, order, stage, "relevant"),
            pool.submit(_latest_rows, scoped, basis_columns, order, stage, "latest"),
        ]
        everyone, comparable, latest = (part.result() for part in parts)
    anchor = latest_date(everyone.cells)
    if stage is not None:
        # The cells are a small table by now; a literal date prunes partitions.
        anchor = F.lit(everyone.cells.agg(F.max("snapshot_date")).first()[0]).cast("date")
    recent = _latest_rows(
        in_window(scoped, params.window_months, anchor),
        ("district", "neighborhood", "latitude", "longitude"),
        order,
        stage,
        "recent",
    )
    return GoldInputs(everyone, comparable, BasisInputs(everyone.cells, latest, recent, params))


Datasets = dict[tuple[str, str], Callable[[], DataFrame]]


def gold_datasets(
    inputs: GoldInputs,
    general: Mapping[str, TrendDataset] = GENERAL,
    relevant_datasets: Mapping[str, TrendDataset] = RELEVANT,
    data_basis: Mapping[str, BasisDataset] = DATA_BASIS,
) -> Datasets:
    """A builder for each dataset, by block and name.

    The dataset mappings can be replaced or extended.
    """
    blocks = (
        ("general", general, inputs.everyone),
        ("relevant", relevant_datasets, inputs.comparable),
        ("data_basis", data_basis, inputs.basis),
    )
    return {
        (block_name, name): partial(make, source)
        for block_name, datasets, source in blocks
        for name, make in datasets.items()
    }


def gold_blocks(
    history: DataFrame,
    params: MarketParams = MarketParams(),
    order: Sequence[str] = ORDINAL_COLUMNS,
) -> Blocks:
    """All datasets of the gold layer as lazy DataFrames, by block and name."""
    blocks: Blocks = {}
    for (block_name, name), make in gold_datasets(gold_inputs(history, params, order)).items():
        blocks.setdefault(block_name, {})[name] = make()
    return blocks


def _literal(value: object) -> Column:
    return F.lit(list(value)) if isinstance(value, (tuple, list)) else F.lit(value)


def gold_document(
    spark: SparkSession,
    blocks: Mapping[str, Mapping[str, DataFrame]],
    generated_at: Column,
    params: MarketParams = MarketParams(),
    search_config: Mapping[str, object] | None = SEARCH_CONFIG,
    tables: str = "",
) -> DataFrame:
    """The nested gold document as one row of JSON text.

    The datasets of ``TABLE_DATASETS`` are given by their place below ``tables``,
    whatever their size.
    """

    def dataset_block(name: str) -> Column:
        places = {n: f"{tables}/{name}/{n}" for n in blocks[name] if n in TABLE_DATASETS}
        return block(blocks[name], places)

    basis = dataset_block("data_basis")
    if search_config is not None:
        settings = F.struct(*[F.lit(v).alias(k) for k, v in search_config.items()])
        basis = F.struct(
            settings.alias("search_config"),
            *[basis[n].alias(n) for n in blocks["data_basis"]],
        )
    spec = params.relevant
    return document(
        spark,
        {
            "schema_version": F.lit(GOLD_SCHEMA_VERSION),
            "generated_at": generated_at,
            "scope_districts": _literal(params.scope_districts),
            "min_count": F.lit(params.min_count),
            "relevant_filter": F.struct(
                F.lit(spec.has_lift).alias("hasLift"),
                F.lit(spec.floor_not).alias("floor_not"),
                F.lit(spec.size_gt).alias("size_gt"),
                F.lit(spec.rooms_gte).alias("rooms_gte"),
                F.lit(spec.bathrooms_gte).alias("bathrooms_gte"),
            ),
            "general": dataset_block("general"),
            "relevant": dataset_block("relevant"),
            "data_basis": basis,
        },
    )


@dataclass(frozen=True)
class GoldResult:
    """Where the gold layer went, and the rows of each dataset."""

    tables: str
    document: str
    rows: dict[tuple[str, str], int] = field(default_factory=dict)


def write_gold(
    spark: SparkSession,
    history: DataFrame,
    root: str,
    generated_at: Column,
    params: MarketParams = MarketParams(),
    order: Sequence[str] = ORDINAL_COLUMNS,
) -> GoldResult:
    """Write every dataset as a table, and those bounded by calendar and map as a document.

    Which dataset goes where depends on its name alone (``TABLE_DATASETS``).
    """
    with Staging(spark) as stage:
        datasets = gold_datasets(gold_inputs(history, params, order, stage))
        return write_datasets(spark, datasets, root, generated_at, params)


def write_datasets(
    spark: SparkSession, datasets: Datasets, root: str, generated_at: Column, params: MarketParams
) -> GoldResult:
    """Write the tables of the datasets, then the document that is made of them."""
    tables, doc = f"{root}/tables", f"{root}/latest"

    def store(job: tuple[str, str]) -> tuple[DataFrame, int]:
        path = f"{tables}/{job[0]}/{job[1]}"
        df = datasets[job]()
        n = _write_points(df, path) if job[1] in TABLE_DATASETS else _write_table(df, path)
        return spark.read.schema(df.schema).parquet(path), n

    with ThreadPoolExecutor(max_workers=_CONCURRENT_WRITES) as pool:
        stored = dict(zip(datasets, pool.map(store, datasets)))
    rows = {job: n for job, (_, n) in stored.items()}
    written: Blocks = {}
    for (block_name, name), (table, _) in stored.items():
        written.setdefault(block_name, {})[name] = table
    write_document(gold_document(spark, written, generated_at, params, tables=tables), doc)
    return GoldResult(tables, doc, rows)


#: Most datasets are small; written one after another they would leave a
#: cluster idle.
_CONCURRENT_WRITES = 4


def _write_table(df: DataFrame, path: str) -> int:
    """Write one dataset and return its number of rows, as the files' footers have it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def _write_points(df: DataFrame, path: str) -> int:
    """The same for points: in files that each cover a part of the map, with an index."""
    write_locations(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()
