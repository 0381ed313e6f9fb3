import datetime

import pytest
from pyspark.sql import functions as F

from casametra.operators import cleaning, dedup, snapshots
from casametra.plans.silver import backfill, clean_snapshots
from casametra.schemas import SILVER_COLUMNS
from casametra.sources import bronze as bronze_source
from casametra.sources import csv_export, silver_table
from casametra.sources.bronze import explode_elements, scan_pages
from casametra.streaming.incremental import clean_new_pages
from tests.conftest import element, write_page

D9, D16 = datetime.date(2023, 4, 9), datetime.date(2023, 4, 16)


def cleaned_codes(spark, tmp_path, *elements, operation="sale"):
    write_page(
        tmp_path,
        f"{operation}_20230409_120000_1.json",
        [element(propertyCode=str(i), **e) for i, e in enumerate(elements)],
    )
    pages = scan_pages(spark, str(tmp_path))
    return sorted(r.propertyCode for r in cleaning.clean_elements(explode_elements(pages)).collect())


def test_price_neighborhood_and_bathroom_rules(spark, tmp_path):
    kept = cleaned_codes(
        spark,
        tmp_path,
        {},
        {"priceByArea": None},
        {"neighborhood": None},
        {"neighborhood": ""},
        {"neighborhood": "  "},
        {"bathrooms": 0},
        {"bathrooms": -1},
        {"bathrooms": None},
    )
    assert kept == ["0", "4", "7"]


def test_sale_bounds_are_strict_and_for_sale_only(spark, tmp_path):
    kept = cleaned_codes(
        spark,
        tmp_path,
        {"priceByArea": 1000.0},
        {"priceByArea": 1000.01},
        {"priceByArea": 10000.0},
        {"priceByArea": 9999.99},
        {"priceByArea": 12.0, "operation": "rent"},
        {"priceByArea": 12.0, "operation": None},
        {"priceByArea": 12.0, "operation": ""},
    )
    assert kept == ["1", "3", "4"]


def test_operation_falls_back_to_that_of_the_page(spark, tmp_path):
    write_page(tmp_path, "rent_20230409_120000_1.json", [element(operation=None, priceByArea=12.0)])
    row = cleaning.clean_elements(explode_elements(scan_pages(spark, str(tmp_path)))).first()
    assert row.operation == "rent"
    assert row.snapshot_date == D9


def test_columns_are_the_fixed_list(spark, tmp_path):
    write_page(tmp_path, "sale_20230409_120000_1.json", [element(extra="dropped")])
    df = cleaning.clean_elements(explode_elements(scan_pages(spark, str(tmp_path))), order=())
    assert tuple(df.columns) == SILVER_COLUMNS
    assert len(df.columns) == 23


def test_exploratory_cleaning_drops_unknown_bathrooms(listings):
    df = listings(
        {},
        {"bathrooms": None},
        {"district": "Campanar"},
        {"operation": "rent", "priceByArea": 12.0},
        {"priceByArea": 500.0},
        {"operation": "auction"},
    )
    kept = cleaning.clean_for_exploration(df)
    assert sorted(r.propertyCode for r in kept.collect()) == ["0", "3"]


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    root.mkdir()
    for name in ("sale_20230409_120000", "sale_20230416_120000", "rent_20230409_120000"):
        price = 2000.0 if name.startswith("sale") else 12.0
        op = name.split("_")[0]
        for page in (1, 2):
            write_page(
                root,
                f"{name}_{page}.json",
                [
                    element(operation=op, priceByArea=price, propertyCode=f"{name}-{page}-{i}")
                    for i in range(2)
                ],
            )
    write_page(root, "unrelated.json", [element()])
    return root


def test_latest_snapshot_of_each_operation(spark, tmp_path, bronze):
    silver = str(tmp_path / "silver")
    result = clean_snapshots(spark, str(bronze), silver)
    assert result.written == (("rent", D9, 4), ("sale", D16, 4))
    assert result.snapshots_found and result.rows_written == 8
    history = silver_table.read_history(spark, silver)
    assert history.count() == 8
    assert set(SILVER_COLUMNS) <= set(history.columns)


def test_target_date_and_guard(spark, tmp_path, bronze):
    silver = str(tmp_path / "silver")
    assert clean_snapshots(spark, str(bronze), silver, D9).rows_written == 8
    assert clean_snapshots(spark, str(bronze), silver, D9).written == ()
    assert clean_snapshots(spark, str(bronze), silver, D9).snapshots_found
    assert not clean_snapshots(spark, str(bronze), silver, datetime.date(2020, 1, 1)).snapshots_found
    result = clean_snapshots(spark, str(bronze), silver)
    assert result.written == (("sale", D16, 4),)


def test_backfill_takes_what_is_missing_in_one_run(spark, tmp_path, bronze):
    silver = str(tmp_path / "silver")
    clean_snapshots(spark, str(bronze), silver)
    result = backfill(spark, str(bronze), silver)
    assert result.written == (("sale", D9, 4),)
    assert backfill(spark, str(bronze), silver).written == ()
    assert silver_table.read_history(spark, silver).count() == 12


def test_written_partition_is_left_alone_by_later_pages(spark, tmp_path, bronze):
    silver = str(tmp_path / "silver")
    backfill(spark, str(bronze), silver)
    write_page(bronze, "sale_20230416_130000_3.json", [element(propertyCode="late")])
    backfill(spark, str(bronze), silver)
    codes = {r.propertyCode for r in silver_table.read_history(spark, silver).collect()}
    assert "late" not in codes and len(codes) == 12


def test_no_bronze_and_all_rows_dropped(spark, tmp_path):
    silver = str(tmp_path / "silver")
    result = clean_snapshots(spark, str(tmp_path / "none"), silver)
    assert not result.snapshots_found and result.written == ()
    root = tmp_path / "bronze"
    root.mkdir()
    write_page(root, "sale_20230409_120000_1.json", [element(priceByArea=None)])
    result = clean_snapshots(spark, str(root), silver)
    assert result.snapshots_found and result.written == ()
    assert silver_table.read_history(spark, silver).isEmpty()


def test_listing_of_the_other_operation_does_not_block_its_snapshot(spark, tmp_path):
    root, silver = tmp_path / "bronze", str(tmp_path / "silver")
    root.mkdir()
    write_page(root, "rent_20230409_120000_1.json", [element(operation="sale", propertyCode="stray")])
    assert clean_snapshots(spark, str(root), silver).written == (("rent", D9, 1),)
    write_page(root, "sale_20230409_120000_1.json", [element(propertyCode="own")])
    assert clean_snapshots(spark, str(root), silver).written == (("sale", D9, 1),)
    rows = silver_table.read_history(spark, silver).collect()
    assert {(r.propertyCode, r.operation) for r in rows} == {("stray", "sale"), ("own", "sale")}


def test_history_of_another_writer_keeps_file_order(spark, tmp_path):
    """Key columns in path and file, dates as text, no positions, wider integers."""
    import pandas as pd

    part = tmp_path / "silver" / "operation=sale" / "snapshot_date=2023-04-09"
    part.mkdir(parents=True)
    pd.DataFrame(
        {
            "operation": ["sale"] * 3,
            "snapshot_date": ["2023-04-09"] * 3,
            "propertyCode": ["p", "q", "p"],
            "price": [1.0, 2.0, 3.0],
            "rooms": [2, 3, 4],
        }
    ).to_parquet(part / "part.parquet", index=False)
    history = silver_table.read_history(spark, str(tmp_path / "silver"))
    assert set(SILVER_COLUMNS) <= set(history.columns)
    first = dedup.first_per_snapshot(history).select("propertyCode", "price", "rooms", "snapshot_date")
    assert {tuple(r) for r in first.collect()} == {("p", 1.0, 2, D9), ("q", 2.0, 3, D9)}
    latest = dedup.latest_per_property(history).select("propertyCode", "price")
    assert {tuple(r) for r in latest.collect()} == {("p", 3.0), ("q", 2.0)}


def test_history_needs_its_key_columns(spark, tmp_path):
    spark.range(1).withColumnRenamed("id", "price").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="snapshot_date"):
        silver_table.read_history(spark, str(tmp_path / "bad"))


def test_missing_history_is_empty_with_all_columns(spark, tmp_path):
    history = silver_table.read_history(spark, str(tmp_path / "none"))
    assert history.isEmpty()
    assert set(SILVER_COLUMNS) <= set(history.columns)
    assert silver_table.written_snapshots(spark, str(tmp_path / "none")).isEmpty()


def test_snapshot_selection(spark):
    keys = spark.createDataFrame(
        [("sale", D9), ("sale", D9), ("sale", D16), ("rent", D9)],
        "operation string, snapshot_date date",
    )
    found = snapshots.snapshots_of(keys)
    assert {tuple(r) for r in found.collect()} == {
        ("sale", D9, 2), ("sale", D16, 1), ("rent", D9, 1)
    }
    latest = snapshots.latest_snapshots(found).select("operation", "snapshot_date")
    assert {tuple(r) for r in latest.collect()} == {("sale", D16), ("rent", D9)}
    assert [r[0] for r in snapshots.snapshot_dates(found).collect()] == [D9, D16]
    assert snapshots.unwritten(found, latest).count() == 1


def test_csv_roundtrip_keeps_types(tmp_path, spark, listings):
    df = listings({"parkingSpace": '{"hasParkingSpace":true}'}, {"floor": None, "rooms": None})
    csv_export.write_csv(df, str(tmp_path / "csv"))
    again = csv_export.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert df.exceptAll(again).isEmpty() and again.count() == 2


def test_stream_cleans_new_pages_and_keeps_written_snapshots(spark, tmp_path, bronze):
    silver, checkpoint = str(tmp_path / "silver"), str(tmp_path / "checkpoint")
    refused = str(tmp_path / "refused")
    clean_new_pages(spark, str(bronze), silver, checkpoint, refused).awaitTermination(120)
    assert silver_table.read_history(spark, silver).count() == 12
    write_page(bronze, "sale_20230409_130000_9.json", [element(propertyCode="late")])
    write_page(bronze, "sale_20230423_120000_1.json", [element(propertyCode="new")])
    clean_new_pages(spark, str(bronze), silver, checkpoint, refused).awaitTermination(120)
    late = [r.page_file for r in spark.read.parquet(refused).collect()]
    assert "sale_20230409_130000_9.json" in late and "sale_20230423_120000_1.json" not in late
    codes = {r.propertyCode for r in silver_table.read_history(spark, silver).collect()}
    assert "new" in codes and "late" not in codes and len(codes) == 13


def ledger_rows(spark, silver):
    from casametra.plans.silver import recorded_snapshots, snapshot_ledger

    rows = recorded_snapshots(snapshot_ledger(spark, silver)).collect()
    return {(r.operation, r.snapshot_date): (r.pages, r.n_rows) for r in rows}


def test_ledger_names_pages_and_rows(spark, tmp_path, bronze):
    from casametra.plans.silver import late_pages, snapshot_ledger

    silver = str(tmp_path / "silver")
    clean_snapshots(spark, str(bronze), silver)
    backfill(spark, str(bronze), silver)
    history = silver_table.read_history(spark, silver)
    counts = history.groupBy("operation", "snapshot_date").count().collect()
    found = ledger_rows(spark, silver)
    assert {k: n for k, (_, n) in found.items()} == {(r.operation, r.snapshot_date): r["count"] for r in counts}
    named = sorted(r.page_file for r in snapshot_ledger(spark, silver).entries().collect())
    keys = bronze_source.decode_keys(bronze_source.list_keys(spark, str(bronze)))
    decoded = bronze_source.valid_keys(keys).select(F.substring_index("key", "/", -1)).collect()
    assert named == sorted(r[0] for r in decoded)
    assert late_pages(spark, str(bronze), silver).isEmpty()
    write_page(bronze, "sale_20230416_130000_3.json", [element(propertyCode="late")])
    assert [r.page_file for r in late_pages(spark, str(bronze), silver).collect()] == ["sale_20230416_130000_3.json"]


def test_job_killed_before_its_commit_repeats_cleanly(spark, tmp_path, bronze, monkeypatch):
    """Whatever the dead run wrote, the next one writes it again, and only then is it there."""
    from casametra.sources.ledger import Ledger

    silver, undisturbed = str(tmp_path / "silver"), str(tmp_path / "undisturbed")
    clean_snapshots(spark, str(bronze), silver)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "append", killed)
        with pytest.raises(RuntimeError):
            backfill(spark, str(bronze), silver)
    assert ("sale", D9) not in ledger_rows(spark, silver)
    # a page that the dead run could not know takes part in the repetition
    write_page(bronze, "sale_20230409_130000_7.json", [element(propertyCode="between")])
    result = backfill(spark, str(bronze), silver)
    assert [w[:2] for w in result.written] == [("sale", D9)]
    backfill(spark, str(bronze), undisturbed)
    ours, theirs = (silver_table.read_history(spark, r) for r in (silver, undisturbed))
    assert ours.count() == theirs.count() and ours.exceptAll(theirs).isEmpty()
    assert {k: v[1] for k, v in ledger_rows(spark, silver).items()} == {k: v[1] for k, v in ledger_rows(spark, undisturbed).items()}
    assert backfill(spark, str(bronze), silver).written == ()


def test_commit_that_died_is_replaced_and_a_finished_one_kept(spark, tmp_path):
    from casametra.plans.silver import LEDGER_SCHEMA
    from casametra.sources.ledger import Ledger

    ledger = Ledger(spark, str(tmp_path / "t"), LEDGER_SCHEMA)
    assert ledger.commits() == [] and ledger.next() == 1 and ledger.entries().isEmpty()
    (tmp_path / "t" / "_commits" / "commit=1" / "_temporary").mkdir(parents=True)
    assert ledger.commits() == [] and ledger.entries().isEmpty()
    row = spark.createDataFrame([("sale", D9, "p", 3)], LEDGER_SCHEMA)
    ledger.append(row, 1)
    assert ledger.commits() == [1] and ledger.next() == 2
    with pytest.raises(ValueError, match="finished"):
        ledger.append(row, 1)
    ledger.append(row.limit(0), 2)
    assert [tuple(r) for r in ledger.entries().collect()] == [("sale", D9, "p", 3, 1)]


def test_history_from_before_the_ledger_is_recorded(spark, tmp_path, bronze):
    silver = str(tmp_path / "silver")
    backfill(spark, str(bronze), silver)
    older = str(tmp_path / "older")
    spark.read.parquet(silver).write.partitionBy("operation", "snapshot_date").parquet(older)
    assert backfill(spark, str(bronze), older).written == ()
    assert {k: n for k, (_, n) in ledger_rows(spark, older).items()} == {
        k: n for k, (_, n) in ledger_rows(spark, silver).items()
    }


def test_snapshot_that_cleans_to_nothing_is_tried_again(spark, tmp_path):
    root, silver = tmp_path / "bronze", str(tmp_path / "silver")
    root.mkdir()
    write_page(root, "sale_20230409_120000_1.json", [element(priceByArea=None)])
    assert clean_snapshots(spark, str(root), silver).written == ()
    write_page(root, "sale_20230409_120000_2.json", [element(propertyCode="better")])
    assert clean_snapshots(spark, str(root), silver).written == (("sale", D9, 1),)
    # the page without a row, in both runs, and the second one
    assert ledger_rows(spark, silver) == {("sale", D9): (2, 1)}
