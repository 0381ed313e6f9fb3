"""Page files that tasks list and open themselves, so that the driver holds none of their names."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

import driver_views as views
from casametra.plans import silver
from casametra.sources import bronze
from casametra.sources.silver_table import read_history
from tests.conftest import element, write_page

MONDAY = datetime.date(2024, 1, 1)


def spark_keys(spark, root) -> list[str]:
    """What Spark's own reader finds."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
    return sorted(r[0] for r in reader.load(root).select("path").collect())


def test_no_file_list_is_kept_in_the_driver(spark, tmp_path):
    write_page(tmp_path, "sale_20240101_120000_1.json", [element()])
    assert bronze.list_keys(spark, str(tmp_path)).inputFiles() == []
    for root in (str(tmp_path), f"file://{tmp_path}"):
        assert [r[0] for r in bronze.list_keys(spark, root).collect()] == spark_keys(spark, root)


def test_the_job_opens_many_pages_in_a_task(spark, tmp_path, monkeypatch):
    """Spark's reader deals a few small pages to a task: with these settings, one."""
    root = tmp_path / "bronze"
    root.mkdir()
    for n in range(40):
        write_page(root, f"sale_202401{n % 4 + 1:02d}_120000_{n}.json", [element(propertyCode=str(n))])
    (root / "unknown_20240101_120000_1.json").write_text("{}")
    scanned = []

    def written(rows, of):
        scanned.append((rows.rdd.getNumPartitions(), [f for f in rows.inputFiles() if f.endswith(".json")]))
        return silver_write(rows, of)

    silver_write = silver.write_snapshots
    monkeypatch.setattr(silver, "write_snapshots", written)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        run = silver.backfill(spark, str(root), str(tmp_path / "silver"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    [(tasks, files)] = scanned
    assert tasks <= spark.sparkContext.defaultParallelism and files == []
    assert run.rows_written == 40 and run.skipped == 1
    codes = [r.propertyCode for r in read_history(spark, str(tmp_path / "silver")).collect()]
    assert sorted(codes, key=int) == [str(n) for n in range(40)]
    # as the run saw them, whatever comes later
    (root / "unknown_20240101_120000_2.json").write_text("{}")
    assert [r.key for r in run.skipped_keys.collect()] == [f"file:{root}/unknown_20240101_120000_1.json"]
    assert not any(name in f for f in run.skipped_keys.inputFiles() for name in os.listdir(root))


def test_pages_are_dealt_by_number(spark, tmp_path, monkeypatch):
    for n in range(30):
        write_page(tmp_path, f"sale_20240101_120000_{n}.json", [])
    keys = bronze.valid_keys(bronze.decode_keys(bronze.list_keys(spark, str(tmp_path))))
    pages = bronze.open_pages(keys, 5)
    assert pages.rdd.getNumPartitions() == 5 and pages.count() == 30
    monkeypatch.setattr(bronze, "BATCH_BYTES", 30)
    assert bronze.open_pages(keys, 2).select("page_file").distinct().count() == 30


def test_folders_below_and_hidden_ones_as_for_the_reader_of_spark(spark, tmp_path):
    for folder in ("a", "a/b", "c.json", "c.json/d", ".hidden", "_hidden", "_x=1", "with space", "é"):
        (tmp_path / folder).mkdir()
        for name in ("sale_20240101_120000_1.json", "x y.json", ".h.json", "_h.json", "_h=1.json", "p.json.crc", "p.txt", "p.json._COPYING_"):
            (tmp_path / folder / name).write_text("{}")
    os.symlink(tmp_path / "a", tmp_path / "linked")
    (tmp_path / "empty").mkdir()
    found = bronze.list_keys(spark, str(tmp_path))
    keys = sorted(r[0] for r in found.collect())
    assert keys == spark_keys(spark, str(tmp_path)) and len(keys) > 20
    assert bronze.list_keys(spark, str(tmp_path / "empty")).isEmpty()


def test_what_is_no_folder_is_left_to_spark(spark, tmp_path):
    write_page(tmp_path, "sale_20240101_120000_1.json", [])
    for root in (f"{tmp_path}/*.json", f"{tmp_path}/sale_20240101_120000_1.json"):
        assert bronze.open_folder(spark, root) is None
        assert [r[0] for r in bronze.list_keys(spark, root).collect()] == spark_keys(spark, root)
    assert bronze.open_folder(spark, f"{tmp_path}/none") is None


def test_opened_pages_are_as_scanned_ones(spark, tmp_path):
    page = '{"elementList":[{"propertyCode":"ñ","price":1.5,"rooms":2}],"total":1}'
    texts = {
        1: page.encode(),
        2: b"\xef\xbb\xbf" + page.encode(),
        3: page.encode("utf-16"),
        4: f"[{page},{page}]".encode(),
        5: b"",
        6: b" \n",
        7: f"{page}\n{page}\n".encode(),
        8: b"{}",
        9: page.encode("utf-32-le"),
    }
    for n, text in texts.items():
        (tmp_path / f"sale_20240101_120000_{n}.json").write_bytes(text)
    keys = bronze.valid_keys(bronze.decode_keys(bronze.list_keys(spark, str(tmp_path))))
    opened, scanned = (bronze.explode_elements(pages) for pages in (bronze.open_pages(keys, 2), bronze.scan_pages(spark, str(tmp_path))))
    assert opened.dtypes == scanned.dtypes
    rows = sorted(map(str, scanned.collect()))
    assert sorted(map(str, opened.collect())) == rows and len(rows) == 7


@pytest.mark.parametrize("text", (b'{"elementList": [', b'{"elementList": [{"price": "x"}]}', b'{"elementList": [{"propertyCode": "\xff"}]}'))
def test_a_malformed_page_stops_the_job(spark, tmp_path, text):
    root = tmp_path / "bronze"
    root.mkdir()
    write_page(root, "sale_20240101_120000_1.json", [element()])
    (root / "sale_20240101_120000_2.json").write_bytes(text)
    with pytest.raises(Exception, match="(?i)malformed|utf"):
        silver.backfill(spark, str(root), str(tmp_path / "silver"))
    assert read_history(spark, str(tmp_path / "silver")).isEmpty()


def test_rows_of_one_name_in_different_batches_are_lines_of_one_file(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        rows = spark.createDataFrame([("p.json", "a"), ("q.json", "b"), ("p.json", "a")], "page_file string, body string")
        views.land(rows.coalesce(1), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (tmp_path / "p.json").read_text() == "a\na\n" and (tmp_path / "q.json").read_text() == "b\n"
    assert not any(entry.is_dir() for entry in os.scandir(tmp_path))


def test_a_scan_of_chosen_snapshots_opens_no_other_page(spark, tmp_path):
    root = tmp_path / "bronze"
    root.mkdir()
    write_page(root, "sale_20240101_120000_1.json", [element(propertyCode="a")])
    write_page(root, "sale_20240108_120000_1.json", None, text="{broken")
    assert silver.clean_snapshots(spark, str(root), str(tmp_path / "silver"), MONDAY).written == (("sale", MONDAY, 1),)
    assert read_history(spark, str(tmp_path / "silver")).select(F.first("propertyCode")).first()[0] == "a"
