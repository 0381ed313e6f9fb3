"""Page files as the driver's queries land them, and how often the silver job looks at them."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

import driver_views as views
from casametra.plans import silver
from casametra.sources import bronze

BODIES = {
    "sale_20240101_120000_1.json": '{"elementList":[],"total":0,"actualPage":1}',
    "rent_20240101_120000_1.json": '{"elementList":[{"propertyCode":"ñ\\r"}],"total":1}',
    "rent_20240108_120000_2.json": "{",
}
UNDECODABLE = {"sale_20231301_120000_1.json", "auction_20230101_120000_1.json"}


def _landed(spark, tmp_path, bodies):
    root = str(tmp_path / "bronze")
    views.land(spark.createDataFrame(list(bodies.items()), "page_file string, body string"), root)
    return root


def test_a_page_is_one_file_under_its_own_name_and_nothing_else_is_left(spark, tmp_path):
    root = _landed(spark, tmp_path, BODIES)
    for name, body in BODIES.items():
        with open(f"{root}/{name}", encoding="utf-8", newline="") as page:
            assert page.read() == body + "\n"
    left = {n for n in os.listdir(root) if not n.endswith(".crc")}
    assert left == {*BODIES, *UNDECODABLE}
    assert os.listdir(tmp_path) == ["bronze"]
    # written by the tasks themselves: the writer of Spark leaves a checksum beside each file
    assert not any(name in n for n in os.listdir(root) if n.endswith(".crc") for name in BODIES)


def test_rows_of_one_name_are_lines_of_one_file_as_in_the_text_writer(spark, tmp_path):
    rows = spark.createDataFrame([("p.json", "{}"), ("p.json", "{}")], "page_file string, body string").coalesce(1)
    by_task, renamed = str(tmp_path / "a"), str(tmp_path / "b")
    views.land(rows, by_task)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(renamed).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(renamed))
    views.rename_files(rows, renamed, fs)
    for root in (by_task, renamed):
        with open(f"{root}/p.json", encoding="utf-8") as page:
            assert page.read() == "{}\n{}\n"


def test_a_run_of_the_silver_job_looks_at_each_page_once(spark, tmp_path, monkeypatch):
    bodies = {f"sale_202401{d:02d}_120000_1.json": '{"elementList":[]}' for d in range(1, 9)}
    root = _landed(spark, tmp_path, bodies)
    looks = spark.sparkContext.accumulator(0)

    def looked_at(key: str) -> str:
        looks.add(1)
        return key

    def counted(session, of):
        seen = F.udf(looked_at, "string").asNondeterministic()
        return bronze.list_keys(session, of).select(seen("key").alias("key"))

    monkeypatch.setattr(silver, "list_keys", counted)
    run = silver.backfill(spark, root, str(tmp_path / "silver"))
    assert (run.snapshots_found, run.skipped) == (True, 2)
    assert looks.value == len(bodies) + len(UNDECODABLE)
