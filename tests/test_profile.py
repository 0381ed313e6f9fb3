"""Correlations by co-moments, quartiles by two scans, exact samples."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casametra.operators import profile
from tests.test_plans import plan_of

COLUMNS = ("a", "b", "c", "constant", "sometimes")


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(9)
    n = 3000
    a = rng.normal(4e6, 1, n)  # far from zero: sums of plain squares would lose all digits
    frame = pd.DataFrame({
        "g": rng.choice(["x", "y", None], n, p=[0.7, 0.299, 0.001]),
        "a": a, "b": a * 2 + rng.normal(0, 0.5, n), "c": np.round(rng.gamma(2, 2, n)),
        "constant": 39.47, "sometimes": np.where(rng.random(n) < 0.3, np.nan, rng.normal(0, 1, n)),
        "text": [str(x) if x % 5 else "none" for x in rng.integers(0, 900, n)],
    })
    frame.loc[rng.random(n) < 0.2, "b"] = np.nan
    frame.loc[:, "never"] = np.nan
    df = spark.createDataFrame(
        [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in frame.itertuples(index=False)],
        "g string, a double, b double, c double, constant double, sometimes double, text string, never double",
    )
    return frame, df.repartition(6).cache()


def test_correlations_of_known_pairs(numbers):
    frame, df = numbers
    columns = (*COLUMNS, "never")
    found = {(r.column, r.later_column): r.abs_correlation for r in profile.correlation_pairs(df, columns).collect()}
    assert len(found) == 15
    expected = frame[list(columns)].astype(float).corr().abs()
    for (x, y), r in found.items():
        if "constant" in (x, y) or "never" in (x, y):
            assert r is None
        else:
            assert r == pytest.approx(expected.loc[x, y], abs=1e-7)


def test_a_column_that_is_constant_where_both_are_known(spark):
    rows = [(1.1, 2.0), (1.1, 3.0), (1.1, 7.0), (5.0, None), (6.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert profile.correlation_pairs(df, ("a", "b")).first().abs_correlation is None
    assert profile.correlation_pairs(df.limit(0), ("a", "b")).isEmpty()


def test_correlations_take_one_pass_of_plain_sums(numbers):
    _, df = numbers
    plan = plan_of(profile.correlation_pairs(df, COLUMNS))
    assert "covar" not in plan and "stddev" not in plan and "corr(" not in plan
    # the sums of the listings, then those of the few sets of known columns
    assert plan.count("keys=[known#") == 2


def expected_quartiles(values):
    return [float(np.quantile(values, p)) for p in (0.25, 0.5, 0.75)]


def check(frame, df, columns):
    found = {(r.g, r.column): r for r in profile.describe(df, ("g",), columns).collect()}
    wanted = 0
    for group, part in frame.groupby("g"):
        key = group if isinstance(group, str) else None
        for column in columns:
            values = pd.to_numeric(part[column], errors="coerce").dropna().to_numpy(float)
            if not len(values):
                assert (key, column) not in found
                continue
            wanted += 1
            row = found[key, column]
            assert row["count"] == len(values) and row["min"] == values.min() and row["max"] == values.max()
            assert row["mean"] == pytest.approx(values.mean())
            assert [row.q1, row.median, row.q3] == pytest.approx(expected_quartiles(values), rel=1e-12)
            if len(values) > 1:
                assert row["std"] == pytest.approx(values.std(ddof=1), rel=1e-6, abs=1e-6)
    assert len(found) == wanted


def test_quartiles_of_all_columns(numbers):
    frame, df = numbers
    check(frame, df, ("a", "b", "c", "constant", "sometimes", "text", "never"))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 11])
def test_quartiles_of_few_rows(spark, n):
    rng = np.random.default_rng(n)
    frame = pd.DataFrame({"g": ["x"] * n + ["y"], "v": [*rng.normal(0, 1, n), 3.0], "w": [*rng.integers(0, 3, n).astype(float), 3.0]})
    check(frame, spark.createDataFrame(frame).repartition(3), ("v", "w"))


def test_quartiles_of_many_rows(spark):
    """More rows than the sketch keeps, close values and heavy ties."""
    n = 200_000
    df = spark.range(n).select(
        F.lit("x").alias("g"),
        (F.lit(39.4) + F.pmod(F.xxhash64("id"), F.lit(100_003)) / 1e7).alias("near"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)).cast("double").alias("few"),
        F.exp(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(99_991)) / 5000).alias("wide"),
    )
    check(df.toPandas(), df, ("near", "few", "wide"))


def test_samples_have_their_size_and_repeat(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("x"), F.lit(None).cast("string").alias("s"))
    for n in (0, 1, 17, 700, 4999, 5000, 9000):
        drawn = profile.sample_rows(df.repartition(7), n, ("id", "s"), seed=3)
        again = profile.sample_rows(df.repartition(2, "x"), n, ("id", "s"), seed=3)
        assert drawn.count() == min(n, 5000) and drawn.columns == df.columns
        assert drawn.exceptAll(again).isEmpty()
    some = profile.sample_rows(df, 2000, ("id",), seed=3)
    other = profile.sample_rows(df, 2000, ("id",), seed=4)
    assert 600 < some.join(other, "id").count() < 1000
    shares = some.groupBy("x").count().collect()
    assert all(560 < r["count"] < 780 for r in shares)


def test_sample_of_repeated_and_of_no_rows(spark):
    rows = spark.createDataFrame([(1, "a")] * 30 + [(1, "b")] * 30 + [(2, "a")] * 3, "k int, v string")
    first = sorted(map(tuple, profile.sample_rows(rows.repartition(5), 40, ("k",)).collect()))
    assert len(first) == 40 and first == sorted(map(tuple, profile.sample_rows(rows.coalesce(1), 40, ("k",)).collect()))
    assert profile.sample_rows(rows.limit(0), 4, ("k",)).isEmpty()
