import datetime
import json

import pytest

from casametra.sources import bronze
from tests.conftest import element, records, write_page


@pytest.mark.parametrize(
    "key, expected",
    [
        ("sale_20230409_120044_1.json", ("sale", datetime.date(2023, 4, 9), 1)),
        ("a/b/rent_20230409_120044_12.json", ("rent", datetime.date(2023, 4, 9), 12)),
        ("a/auction_20230409_120044_1.json", (None, None, None)),
        ("sale_20231309_120044_1.json", (None, None, None)),
        ("sale_20230230_120044_1.json", (None, None, None)),
        ("sale_20230409_120044_.json", (None, None, None)),
        ("sale_20230409_1.json", (None, None, None)),
        ("sale_20230409_120044_1.json.bak", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_key_decoding(spark, key, expected):
    row = bronze.decode_keys(spark.createDataFrame([(key,)], "key string")).first()
    assert (row.operation, row.snapshot_date, row.page) == expected


def test_skipped_keys_are_the_undecodable_ones(spark):
    keys = spark.createDataFrame([("sale_20230409_120044_1.json",), ("x.json",)], "key string")
    decoded = bronze.decode_keys(keys)
    assert bronze.valid_keys(decoded).count() == 1
    assert [r.key for r in bronze.skipped_keys(decoded).collect()] == ["x.json"]


def test_scan_explodes_pages_in_position_order(spark, tmp_path):
    write_page(
        tmp_path,
        "sale_20230409_120000_1.json",
        [element(propertyCode="a", parkingSpace={"has": True}), element(propertyCode="b", rooms=2.0)],
    )
    write_page(tmp_path, "rent_20230409_120000_1.json", None)
    write_page(tmp_path, "notes.txt", [element()])
    write_page(tmp_path, "odd_name.json", [element()])
    rows = records(bronze.explode_elements(bronze.scan_pages(spark, str(tmp_path))).orderBy("_page_pos"))
    assert [(r["propertyCode"], r["_page_pos"]) for r in rows] == [("a", 0), ("b", 1)]
    assert json.loads(rows[0]["parkingSpace"]) == {"has": True}
    assert rows[0]["page_operation"] == "sale"
    assert rows[0]["snapshot_date"] == datetime.date(2023, 4, 9)


def test_scan_opens_only_the_pages_of_chosen_snapshots(spark, tmp_path):
    for name in ("sale_20230409", "sale_20230416", "rent_20230416"):
        write_page(tmp_path, f"{name}_120000_1.json", [element(propertyCode=name)])
    # A page that cannot be parsed proves that its file is never opened.
    write_page(tmp_path, "rent_20230409_120000_1.json", None, text="{broken")
    chosen = [("sale", datetime.date(2023, 4, 9)), ("rent", datetime.date(2023, 4, 16))]
    rows = bronze.explode_elements(bronze.scan_pages(spark, str(tmp_path), chosen)).collect()
    assert {r.propertyCode for r in rows} == {"sale_20230409", "rent_20230416"}


def test_malformed_page_fails_or_is_profiled(spark, tmp_path):
    write_page(tmp_path, "sale_20230409_120000_1.json", None, text='{"elementList": [')
    write_page(
        tmp_path,
        "sale_20230409_120000_2.json",
        [
            element(),
            element(priceByArea=None),
            element(neighborhood=""),
            element(neighborhood=None, operation=None),
            element(neighborhood=" "),
        ],
    )
    with pytest.raises(Exception, match="(?i)malformed|MALFORMED_RECORD"):
        bronze.scan_pages(spark, str(tmp_path)).collect()
    pages = bronze.scan_pages(spark, str(tmp_path), mode="PERMISSIVE")
    row = bronze.quality_profile(pages).first()
    assert (row.files_scanned, row.files_failed, row.total_elements) == (1, 1, 5)
    assert (row.null_price_by_area, row.missing_neighborhood, row.missing_operation) == (1, 2, 1)
    assert row.missing_neighborhood_pct == 40.0
    assert [r.page_file for r in bronze.failed_pages(pages).collect()] == [
        "sale_20230409_120000_1.json"
    ]


def test_profile_without_elements_has_no_percentages(spark, tmp_path):
    write_page(tmp_path, "sale_20230409_120000_1.json", None)
    row = bronze.quality_profile(bronze.scan_pages(spark, str(tmp_path), mode="PERMISSIVE")).first()
    assert (row.files_scanned, row.total_elements, row.missing_operation_pct) == (1, 0, None)


def test_pages_as_text_equal_pages_as_files(spark, tmp_path):
    name = "sale_20230409_120000_1.json"
    write_page(tmp_path, name, [element(propertyCode=str(i)) for i in range(3)])
    text = spark.createDataFrame([(name, (tmp_path / name).read_text())], "page_file string, body string")
    from_files = bronze.explode_elements(bronze.scan_pages(spark, str(tmp_path)))
    from_text = bronze.explode_elements(bronze.parse_pages(text))
    assert from_files.exceptAll(from_text).isEmpty()
    assert from_text.count() == 3
