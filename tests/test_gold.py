"""The gold layer against SQL over an own history, and its edge cases."""

import datetime
import json

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import driver_oracle
import driver_queries
from casametra.operators.filters import in_scope
from casametra.params import MarketParams
from casametra.plans import gold
from casametra.plans.dashboard import block_datasets, headline_figures, read_gold, scoped_block
from casametra.schemas import (
    DATA_BASIS_DATASETS,
    DATASET_TYPES,
    GENERAL_DATASETS,
    GOLD_DOCUMENT_SCHEMA,
    RELEVANT_DATASETS,
    SILVER_SCHEMA,
    TABLE_DATASETS,
)
from casametra.sources.documents import dataset, read_document_if_available
from casametra.sources.silver_table import empty_history
from tests.conftest import records

STAMP = "2026-01-01T12:00:00+00:00"

#: Streets of the invented town; the last district is out of scope.
TOWN = {
    "Extramurs": ["Mill", "Harbour", "Ferry"],
    "Ciutat Vella": ["Market", "Cloister"],
    "Suburb": ["Orchard"],
}


def market_rows(seed: int = 3, n: int = 900) -> list[dict]:
    """Listings drawn at random: returning properties, gaps, ties and odd values."""
    rng = np.random.default_rng(seed)
    months = [datetime.date(2024, m, 3 * m) for m in range(1, 8)]
    rows = []
    for position in range(n):
        district = rng.choice(list(TOWN), p=[0.5, 0.3, 0.2])
        operation = "sale" if rng.random() < 0.6 else "rent"
        size = float(rng.integers(40, 260))
        per_area = rng.normal(3000, 700) if operation == "sale" else rng.normal(14, 3)
        rows.append(
            {
                "operation": operation,
                "district": str(district),
                "neighborhood": str(rng.choice(TOWN[district])),
                "snapshot_date": months[int(rng.integers(len(months)))],
                "propertyCode": f"h{rng.integers(n // 2)}",
                "price": round(size * per_area, 2),
                "size": size,
                "priceByArea": round(float(per_area), 2),
                "floor": [None, "1", "2", "bj"][int(rng.integers(4))],
                "rooms": int(rng.integers(0, 6)),
                "bathrooms": [None, 1, 2, 3][int(rng.integers(4))],
                "hasLift": bool(rng.random() < 0.7),
                "latitude": None if rng.random() < 0.1 else round(39.4 + float(rng.random()) / 50, 4),
                "longitude": round(-0.4 + float(rng.random()) / 50, 4),
                "_page_file": f"p{position // 50:03d}",
                "_page_pos": position % 50,
            }
        )
    return rows


def expected_records(listings: list[dict], block: str) -> list[tuple]:
    """Every record of a block by SQL over the rows."""
    order, newest = "_page_file, _page_pos", "snapshot_date DESC, _page_file DESC, _page_pos DESC"

    def first(source: str, keys: str, by: str) -> str:
        return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {by}) = 1"

    def window(source: str) -> str:
        return f"SELECT * FROM {source} WHERE snapshot_date >= (SELECT max(snapshot_date) - INTERVAL 3 MONTH FROM {source})"

    views = {
        "scoped": "SELECT * FROM rows WHERE district <> 'Suburb'",
        "rel": "SELECT * FROM scoped WHERE hasLift AND floor IS DISTINCT FROM '1' AND size > 120 AND rooms >= 2 AND bathrooms >= 2",
        "d1": first("scoped", "operation, snapshot_date, propertyCode", order),
        "rel1": first("rel", "operation, snapshot_date, propertyCode", order),
        "d2": first("scoped", "operation, propertyCode", newest),
        "recent": window("scoped"),
        "recent2": first("recent", "operation, propertyCode", newest),
        "recent1": window("d1"),
        "recent_rel1": window("rel1"),
    }
    sql = "WITH " + ", ".join(f"{k} AS ({v})" for k, v in views.items())
    connection = duckdb.connect()
    connection.register("rows", pd.DataFrame(listings).convert_dtypes())
    result = connection.execute(sql + driver_oracle._gold_records((block,)))
    names = [d[0] for d in result.description]
    return sorted(map(repr, (tuple(sorted(zip(names, r))) for r in result.fetchall())))


@pytest.fixture(scope="module")
def history():
    return market_rows()


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory, history):
    names = SILVER_SCHEMA.fieldNames()
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in history], SILVER_SCHEMA)
    root = str(tmp_path_factory.mktemp("gold"))
    result = gold.write_gold(spark, df.drop("_listing_operation"), root, F.lit(STAMP))
    return result, json.loads(spark.read.text(result.document).first()[0])


def test_header(written):
    _, doc = written
    assert list(doc) == [
        "schema_version", "generated_at", "scope_districts", "min_count", "relevant_filter",
        "general", "relevant", "data_basis",
    ]
    assert (doc["schema_version"], doc["generated_at"], doc["min_count"]) == ("1.0", STAMP, 5)
    assert doc["scope_districts"] == ["Extramurs", "Ciutat Vella", "L'Eixample"]
    assert doc["relevant_filter"] == {
        "hasLift": True, "floor_not": "1", "size_gt": 120, "rooms_gte": 2, "bathrooms_gte": 2
    }
    assert list(doc["general"]) == list(GENERAL_DATASETS)
    assert list(doc["relevant"]) == list(RELEVANT_DATASETS)
    assert list(doc["data_basis"]) == ["search_config", *DATA_BASIS_DATASETS]
    assert doc["data_basis"]["search_config"]["distance_m"] == 1500


@pytest.mark.parametrize("block", ["general", "relevant", "data_basis"])
def test_every_record_against_sql(spark, written, history, block):
    doc = read_gold(spark, written[0].document)
    found = driver_queries.gold_records(block_datasets(doc, block), block).collect()
    shown = sorted(repr(tuple(sorted(r.asDict().items()))) for r in found)
    assert len(shown) > 10
    assert shown == expected_records(history, block)


def test_records_are_in_key_order(written):
    for block in ("general", "relevant", "data_basis"):
        for name, found in written[1][block].items():
            if isinstance(found, list):
                keys = [[r[k] for k in driver_queries.GOLD_KEYS if k in r] for r in found]
                assert keys == sorted(keys), name


def test_tables_and_schema_agree_with_the_document(spark, written):
    result, doc = written
    for (block, name), n in result.rows.items():
        table = spark.read.parquet(f"{result.tables}/{block}/{name}")
        assert table.count() == n
        assert table.columns == DATASET_TYPES[name].elementType.fieldNames()
        if name not in TABLE_DATASETS:
            assert len(doc[block][name]) == n


def test_dashboard_reads_the_document(spark, written, history):
    doc = read_gold(spark, written[0].document)
    datasets = block_datasets(doc, "general")
    (row,) = records(headline_figures(doc, datasets))
    assert row["last_updated"] == STAMP
    ratios = records(datasets["rent_vs_sale_ratio"])
    counts = [r["count_listings_sale"] + r["count_listings_rent"] for r in ratios]
    mean = sum(r["mean_sales_price_by_rent_ratio"] * n for r, n in zip(ratios, counts)) / sum(counts)
    assert row["total_listing_count"] == sum(counts)
    assert row["implied_gross_yield_percent"] == pytest.approx(12 / mean * 100)
    scoped = scoped_block(datasets, ["Extramurs"])
    assert {r["district"] for r in records(scoped["price_time_series_neighborhood"])} == {"Extramurs"}


def test_unknown_versions_are_refused(spark, written):
    path = written[0].document
    with pytest.raises(ValueError, match="schema_version"):
        from casametra.sources.documents import read_document

        read_document(spark, path, GOLD_DOCUMENT_SCHEMA, ["9.9"])
    assert read_document_if_available(spark, path, GOLD_DOCUMENT_SCHEMA, ["9.9"]) is None
    assert read_document_if_available(spark, path + "-none", GOLD_DOCUMENT_SCHEMA, ["1.0"]) is None


def test_empty_history_gives_empty_lists(spark, tmp_path):
    result = gold.write_gold(spark, empty_history(spark), str(tmp_path), F.lit(STAMP))
    doc = json.loads(spark.read.text(result.document).first()[0])
    for block in ("general", "relevant", "data_basis"):
        assert all(v == [] for k, v in doc[block].items() if k != "search_config" and k not in TABLE_DATASETS)
    locations = spark.read.parquet(f"{result.tables}/data_basis/listing_locations_last_3m")
    assert locations.isEmpty()


def test_the_layout_depends_on_names_and_never_on_size(spark, tmp_path, listings):
    df = listings(*[{"latitude": 39.0 + i, "longitude": float(i)} for i in range(6)])
    for rows in (df, df.limit(0)):
        root = str(tmp_path / f"g{rows.count()}")
        result = gold.write_gold(spark, rows, root, F.lit(STAMP))
        doc = json.loads(spark.read.text(result.document).first()[0])
        place = f"{result.tables}/data_basis/listing_locations_last_3m"
        assert doc["data_basis"]["listing_locations_last_3m"] == place
        assert isinstance(doc["data_basis"]["listing_location_grid_last_3m"], list)
        assert spark.read.parquet(place).count() == rows.count()


def test_a_dataset_missing_from_the_document_is_an_error(spark):
    schema = "general struct<a: array<struct<x: int>>, listing: string>"
    doc = spark.createDataFrame([((None, None),)], schema)
    with pytest.raises(Exception, match="the document has no general.a"):
        dataset(doc, "general", "a").collect()
    with pytest.raises(ValueError, match="no place of general.listing"):
        dataset(doc, "general", "listing")


def test_datasets_can_be_added(listings):
    inputs = gold.gold_inputs(listings({}, {}))
    extra = {**gold.GENERAL, "listings": lambda t: t.listings.agg(F.count("*").alias("n"))}
    datasets = gold.gold_datasets(inputs, general=extra)
    assert datasets["general", "listings"]().first().n == 2
    assert ("relevant", "listings") not in datasets


def test_relevant_population_has_its_own_window(listings):
    recent = datetime.date(2023, 6, 1)
    rows = [{"snapshot_date": datetime.date(2023, 1, 1)}] * 5
    rows += [{"snapshot_date": recent, "hasLift": False}] * 5
    blocks = gold.gold_blocks(listings(*rows), MarketParams())
    (general,) = records(blocks["general"]["boxplot_by_neighborhood_last_3m"])
    (comparable,) = records(blocks["relevant"]["boxplot_by_neighborhood_last_3m"])
    assert (general["count"], comparable["count"]) == (5, 5)


def test_relevant_filter_comes_before_the_dedup(listings):
    df = listings(
        {"propertyCode": "p", "hasLift": False, "priceByArea": 1.0},
        {"propertyCode": "p", "priceByArea": 2.0},
    )
    blocks = gold.gold_blocks(df)
    assert records(blocks["general"]["boxplot_by_neighborhood"])[0]["max"] == 1.0
    assert records(blocks["relevant"]["boxplot_by_neighborhood"])[0]["max"] == 2.0


def test_data_basis_is_scoped_and_windows_before_its_dedup(listings):
    df = listings(
        {"district": "Campanar"},
        {"propertyCode": "p", "snapshot_date": None, "latitude": 1.0},
        {"propertyCode": "p", "snapshot_date": datetime.date(2023, 4, 9), "latitude": 2.0},
    )
    assert in_scope(df).count() == 2
    blocks = gold.gold_blocks(df)
    located = records(blocks["data_basis"]["listing_locations_last_3m"])
    assert [r["latitude"] for r in located] == [2.0]


def test_nan_becomes_null_and_keys_stay(spark, tmp_path, listings):
    df = listings({"priceByArea": 3.0, "size": None})
    result = gold.write_gold(spark, df, str(tmp_path), F.lit(STAMP))
    text = spark.read.text(result.document).first()[0]
    (record,) = json.loads(text)["general"]["price_time_series_neighborhood"]
    assert record["mean_size"] is None and "NaN" not in text
