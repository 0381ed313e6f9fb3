"""Exact interpolated quantiles of groups of any size.

Spark's ``percentile`` keeps all distinct values of a group in one buffer. With
two operations and a few dozen neighborhoods a group may hold a third of all
rows, so the quantiles are found by rank instead: values fall into buckets that
follow their order, and the running totals of the buckets say in which bucket
each wanted rank lies. Each of those few buckets is then cut again, evenly between its
own smallest and largest value, a fixed number of times, so that buckets follow the data
also where values lie close together, as coordinates do. What is left is
counted by value and put in order. No task sees more than one such bucket of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

_BUCKETS_PER_E_FOLD = 512

#: Rounds of cutting the wanted buckets, and the parts of a bucket in each.
REFINEMENTS = 1
_PARTS = 4096


def _bucket(value: Column) -> Column:
    """A bucket number that never decreases as the value grows.

    Buckets widen with the value, so an outlier does not squeeze all other
    values into one of them. Doubles give at most about 730,000 buckets.
    """
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * _BUCKETS_PER_E_FOLD)


def _bucket_sums(rows: DataFrame, within: Sequence[str], bucket: str) -> DataFrame:
    """Rows and extremes of each bucket."""
    return rows.groupBy(*within, bucket).agg(
        F.sum("_n").alias("_bn"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )


def _with_totals(sums: DataFrame, within: Sequence[str], bucket: str, before: Column) -> DataFrame:
    """Adds the running total, after ``before``, up to each bucket."""
    up_to_bucket = (
        Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    )
    return sums.withColumn("_before", before + F.sum("_bn").over(up_to_bucket) - F.col("_bn"))


def counted_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Known values of each group with their counts and buckets: keys, ``_b0``, ``_v``, ``_n``."""
    known = df.dropna(subset=[*keys, value]).select(*keys, F.col(value).cast("double").alias("_v"))
    return known.groupBy(*keys, _bucket(F.col("_v")).alias("_b0"), "_v").agg(F.count("*").alias("_n"))


def bucket_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted values by bucket: keys, ``_b0``, ``_bn``, ``_lo``, ``_hi``. Totals of parts add up."""
    return _bucket_sums(counts, keys, "_b0")


def merged_totals(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bucket totals of several parts as those of the whole."""
    return totals.groupBy(*keys, "_b0").agg(
        F.sum("_bn").alias("_bn"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``count``, ``min``, ``max`` and the named quantiles of each group.

    Null values and null keys are left out; groups without values give no row.
    Quantiles interpolate linearly between the two nearest ranks.

    ``keep`` may store each list of wanted buckets as a table. Its size is then
    known when the join is planned: a short list is broadcast, and the rows are
    read twice but never shuffled. Without ``keep`` the rows are counted by
    value first, so that repeated values cross the shuffle once.
    """
    known = df.dropna(subset=[*keys, value]).select(
        *keys, F.col(value).cast("double").alias("_v")
    )
    if keep is None:
        known = known.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    else:
        known = known.withColumn("_n", F.lit(1).cast("bigint"))
    rows = known.withColumn("_b0", _bucket(F.col("_v")))
    return quantiles_by_rank(rows, _bucket_sums(rows, keys, "_b0"), keys, quantiles, keep)


def quantiles_by_rank(
    rows: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, float],
    keep: Callable[[DataFrame], DataFrame] | None = None,
    only: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The same from values with counts (``_v``, ``_n``, ``_b0``) and their bucket totals.

    ``rows`` may be those of several parts: equal values need not have met yet. ``only`` may
    narrow the rows to the wanted buckets by a filter that reaches the files.
    """
    in_group = Window.partitionBy(*keys)
    buckets = _with_totals(totals, keys, "_b0", F.lit(0)).select(
        *keys, "_b0", "_before", "_bn", "_lo", "_hi",
        F.sum("_bn").over(in_group).alias("_total"),
        F.min("_lo").over(in_group).alias("_min"),
        F.max("_hi").over(in_group).alias("_max"),
    )

    last_rank = F.col("_total") - 1
    ranks = {
        name: (F.floor(last_rank * p), F.ceil(last_rank * p)) for name, p in quantiles.items()
    }

    def wanted(found: DataFrame) -> DataFrame:
        first, last = F.col("_before"), F.col("_before") + F.col("_bn") - 1
        hit = F.lit(False)
        for low, high in ranks.values():
            hit = hit | low.between(first, last) | high.between(first, last)
        chosen = found.filter(hit).drop("_bn")
        return chosen if keep is None else keep(chosen)

    of_group = ("_total", "_min", "_max")
    path = ["_b0"]
    chosen = wanted(buckets)
    if only is not None:
        rows = only(rows, chosen)
    for k in range(1, REFINEMENTS + 1):
        inner = rows.join(chosen, on=[*keys, *path])
        share = F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo"))
        inner = inner.withColumn(f"_b{k}", F.coalesce(F.floor(share * _PARTS), F.lit(0)))
        rows = inner.select(*keys, "_v", "_n", *path, f"_b{k}")
        within = (*keys, *path, *of_group, "_before")
        sums = _with_totals(
            _bucket_sums(inner.drop("_lo", "_hi"), within, f"_b{k}"), within, f"_b{k}", F.col("_before")
        )
        path.append(f"_b{k}")
        chosen = wanted(sums.select(*keys, *path, *of_group, "_before", "_bn", "_lo", "_hi"))

    of_bucket = (*keys, *path, "_before", *of_group)
    counted = (
        rows.join(chosen, on=[*keys, *path]).groupBy(*of_bucket, "_v").agg(F.sum("_n").alias("_n"))
    )
    up_to_value = (
        Window.partitionBy(*keys, *path).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    )
    ordered = counted.withColumn(
        "_last", F.col("_before") + F.sum("_n").over(up_to_value) - 1
    )
    first, last = F.col("_last") - F.col("_n") + 1, F.col("_last")

    def value_at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, last), F.col("_v")))

    group_columns = (*keys, "_total", "_min", "_max")
    picked = ordered.groupBy(*group_columns).agg(
        *[
            column
            for name, (low, high) in ranks.items()
            for column in (
                value_at(low).alias(f"_{name}_low"),
                value_at(high).alias(f"_{name}_high"),
            )
        ]
    )

    def interpolated(name: str, p: float) -> Column:
        rank = last_rank * p
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * (rank - F.floor(rank))).alias(name)

    return picked.select(
        *keys,
        F.col("_total").alias("count"),
        F.col("_min").alias("min"),
        *[interpolated(name, p) for name, p in quantiles.items()],
        F.col("_max").alias("max"),
    )
