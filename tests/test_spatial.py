"""The spatial order of points, their table, and the files that a section of the map opens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from casametra.operators import spatial
from casametra.operators.spatial import Box
from casametra.sources import location_table


def plain_code(latitude, longitude):
    """Bit by bit."""
    y = min(max(int((latitude + 90) / 180 * 2**spatial.BITS // 1), 0), 2**spatial.BITS - 1)
    x = min(max(int((longitude + 180) / 360 * 2**spatial.BITS // 1), 0), 2**spatial.BITS - 1)
    code = 0
    for bit in reversed(range(spatial.BITS)):
        code = code << 2 | (y >> bit & 1) << 1 | (x >> bit & 1)
    return code


EDGES = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (39.47, -0.38), (95.0, -200.0), (None, 1.0), (1.0, None)]


def test_codes_against_single_bits(spark):
    rng = np.random.default_rng(1)
    points = [*EDGES, *((float(a), float(b)) for a, b in zip(rng.uniform(-90, 90, 200), rng.uniform(-180, 180, 200)))]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    coded = df.withColumn("code", spatial.place_code(F.col("latitude"), F.col("longitude"))).collect()
    assert [r.code for r in coded] == [None if None in p else plain_code(*p) for p in points]


def test_ranges_cover_the_box_and_little_more():
    rng = np.random.default_rng(2)
    for box in (Box(39.4, -0.41, 39.5, -0.36), Box(-1.0, -1.0, 1.0, 1.0), Box(10.0, 10.0, 10.0, 10.0), Box(-90.0, -180.0, 90.0, 180.0)):
        ranges = spatial.code_ranges(box)
        assert len(ranges) <= 64 and all(a <= b for a, b in ranges)
        assert all(ranges[i][1] < ranges[i + 1][0] - 1 for i in range(len(ranges) - 1))
        for _ in range(300):
            code = plain_code(rng.uniform(box.south, box.north), rng.uniform(box.west, box.east))
            assert any(a <= code <= b for a, b in ranges)
        area = sum(b - a + 1 for a, b in ranges) / 4**spatial.BITS
        wanted = (box.north - box.south) / 180 * (box.east - box.west) / 360
        assert area <= 5 * wanted + 1e-9


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    rows = [("sale", "D", f"N{k % 7}", float(rng.normal(39.47, 0.02)), float(rng.normal(-0.38, 0.02))) for k in range(20_000)]
    rows += [("rent", "D", "N0", 39.47, -0.38)] * 50
    return spark.createDataFrame(rows, "operation string, district string, neighborhood string, latitude double, longitude double")


def test_a_box_opens_few_files_and_misses_nothing(spark, points, tmp_path):
    root = str(tmp_path / "points")
    assert location_table.write_locations(points, root, files=32) == 32
    assert spark.read.parquet(root).exceptAll(points).isEmpty() and spark.read.parquet(root).count() == points.count()
    for box in (Box(39.469, -0.381, 39.471, -0.379), Box(39.44, -0.40, 39.45, -0.39), Box(39.47, -0.38, 39.47, -0.38)):
        files = location_table.files_of(spark, root, box)
        assert 1 <= len(files) <= 8
        found = location_table.read_box(spark, root, box)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, points.filter(spatial.in_box(box)).collect()))
        assert set(found.inputFiles()) == {f"file://{f}" for f in files}
    assert location_table.files_of(spark, root, Box(-10.0, 10.0, -9.0, 11.0)) == []
    nothing = location_table.read_box(spark, root, Box(-10.0, 10.0, -9.0, 11.0))
    assert nothing.isEmpty() and nothing.columns == points.columns


def test_no_points(spark, points, tmp_path):
    root = str(tmp_path / "none")
    assert location_table.write_locations(points.limit(0), root) == 0
    assert location_table.read_box(spark, root, Box(-90.0, -180.0, 90.0, 180.0)).isEmpty()
