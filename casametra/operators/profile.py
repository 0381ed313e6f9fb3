"""Exploratory statistics over listings."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from casametra.operators.market import QUARTILES, rent_and_sale
from casametra.operators.quantiles import exact_quantiles

NUMERIC_COLUMNS = (
    "latitude",
    "longitude",
    "price",
    "priceByArea",
    "size",
    "rooms",
    "bathrooms",
)

#: Columns of the correlation: booleans count as 0 and 1.
CORRELATED_COLUMNS = (*NUMERIC_COLUMNS, "exterior", "newDevelopment", "hasLift")


def _number(column: str) -> Column:
    """A column as a double; text that is no number is unknown."""
    return F.col(column).try_cast("double")


def download_volume(listings: DataFrame) -> DataFrame:
    """Listings per snapshot and operation."""
    return (
        listings.dropna(subset=["snapshot_date", "operation"])
        .groupBy("snapshot_date", "operation")
        .agg(F.count("propertyCode").alias("count_listings"))
    )


def mean_download_volume(listings: DataFrame, snapshots_per_month: int = 5) -> DataFrame:
    """Mean listings per snapshot, and scaled to a month, per operation."""
    return (
        download_volume(listings)
        .groupBy("operation")
        .agg(F.avg("count_listings").alias("weekly_mean"))
        .withColumn("monthly_mean", F.col("weekly_mean") * snapshots_per_month)
    )


def neighborhood_statistics(listings: DataFrame) -> DataFrame:
    """Counts and means per neighborhood and operation, duplicates included."""
    keys = ("district", "neighborhood", "operation")
    return (
        listings.dropna(subset=[*keys])
        .groupBy(*keys)
        .agg(
            F.count("propertyCode").alias("count_listings"),
            F.avg("priceByArea").alias("mean_priceByArea"),
            F.avg("size").alias("mean_size"),
            F.avg("price").alias("mean_price"),
        )
    )


def wide_ratio(cells: DataFrame, min_count: int = 5) -> DataFrame:
    """Rent-versus-sale comparison with sizes and prices of both sides."""
    keys = ("district", "neighborhood")
    return rent_and_sale(cells, keys, ("priceByArea", "size", "price"), min_count).select(
        *keys,
        "mean_priceByArea_sale",
        "mean_priceByArea_rent",
        "mean_sales_price_by_rent_ratio",
        "mean_size_sale",
        "mean_size_rent",
        "count_listings_sale",
        "count_listings_rent",
        "mean_price_sale",
        "mean_price_rent",
    )


def neighborhood_order(listings: DataFrame) -> DataFrame:
    """Neighborhoods of each operation by mean price per area, cheapest first."""
    keys = ("operation", "neighborhood")
    return (
        listings.dropna(subset=[*keys])
        .groupBy(*keys)
        .agg(F.avg("priceByArea").alias("mean_priceByArea"))
        .orderBy("operation", "mean_priceByArea", "neighborhood")
    )


def describe(
    listings: DataFrame,
    keys: Sequence[str] = ("operation",),
    columns: Sequence[str] = (*NUMERIC_COLUMNS, "distance"),
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of each column.

    One row per group and column; columns without a known value give none. Text columns
    count as numbers where they are. Means and deviations come from one aggregation over
    the listings as they are; values are listed by column only to be counted, before any
    shuffle. For ``keep`` see ``exact_quantiles``.
    """
    long = listings.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), _number(c).alias("value"))
                    for c in columns
                ]
            )
        ),
    )
    groups = (*keys, "column")
    summary = exact_quantiles(long, groups, "value", QUARTILES, keep)

    wide = listings.groupBy(*keys).agg(
        *[
            F.struct(F.avg(_number(c)).alias("mean"), F.stddev_samp(_number(c)).alias("std")).alias(f"m{i}")
            for i, c in enumerate(columns)
        ]
    )
    moments = wide.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"m{i}.mean").alias("mean"),
                        F.col(f"m{i}.std").alias("std"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        ),
    )
    return summary.join(moments, on=[*groups]).select(
        *groups, "count", "mean", "std", "min", *QUARTILES, "max"
    )


def count_where_zero(listings: DataFrame, column: str, by: str) -> DataFrame:
    """Listings whose ``column`` is zero, counted by another column."""
    return (
        listings.filter(F.col(column) == 0)
        .dropna(subset=[by])
        .groupBy(by)
        .agg(F.count("propertyCode").alias("count_listings"))
    )


#: Listings whose mean shifts all values, so that sums of squares keep their digits.
_SHIFT_ROWS = 1000


def co_moments(numbers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Plain sums from which all correlations follow, by the set of columns that are known.

    One pass: counts, sums of the shifted columns and of the products of any two, extremes.
    Listings with the same columns known share a row (``known`` has a bit for each), so
    there are a few rows, and the pairs of columns that are both known need no sums of
    their own.
    """
    shift = numbers.limit(_SHIFT_ROWS).agg(
        F.struct(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns])
    ).scalar()
    known = sum((F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)), F.lit(0))
    shifted = numbers.withColumn("_shift", shift).select(
        known.alias("known"),
        *[(F.col(c) - F.col("_shift")[c]).alias(f"y{i}") for i, c in enumerate(columns)],
    )
    n = range(len(columns))
    return shifted.groupBy("known").agg(
        F.count("*").alias("n"),
        *[F.sum(f"y{i}").alias(f"s{i}") for i in n],
        *[F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"p{i}_{j}") for i in n for j in n if i <= j],
        *[F.min(f"y{i}").alias(f"lo{i}") for i in n],
        *[F.max(f"y{i}").alias(f"hi{i}") for i in n],
    )


def correlation_pairs(
    listings: DataFrame, columns: Sequence[str] = CORRELATED_COLUMNS
) -> DataFrame:
    """Absolute correlation of each pair of columns, from one pass over the listings.

    Each pair uses the rows where both columns are known; it is null when one
    of them is constant there.
    """
    sums = co_moments(listings.select(*[_number(c).alias(c) for c in columns]), columns)
    pairs = list(combinations(range(len(columns)), 2))
    # a row of sums for each pair: as many as pairs and sets of known columns
    of_pair = sums.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(columns[i]).alias("column"), F.lit(columns[j]).alias("later_column"),
                (F.col("known").bitwiseAND(F.lit(1 << i | 1 << j)) == F.lit(1 << i | 1 << j)).alias("both"),
                F.col("n").alias("n"),
                F.col(f"s{i}").alias("sa"), F.col(f"s{j}").alias("sb"),
                F.col(f"p{i}_{i}").alias("saa"), F.col(f"p{j}_{j}").alias("sbb"), F.col(f"p{i}_{j}").alias("sab"),
                F.col(f"lo{i}").alias("loa"), F.col(f"hi{i}").alias("hia"),
                F.col(f"lo{j}").alias("lob"), F.col(f"hi{j}").alias("hib"),
            )
            for i, j in pairs
        ]))
    )

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("both"), F.col(column)))

    def varies(side: str) -> Column:
        return F.min(F.when(F.col("both"), F.col(f"lo{side}"))) < F.max(F.when(F.col("both"), F.col(f"hi{side}")))

    covariance = total("sab") - total("sa") * total("sb") / total("n")
    spread_a = total("saa") - total("sa") * total("sa") / total("n")
    spread_b = total("sbb") - total("sb") * total("sb") / total("n")
    r = F.when(varies("a") & varies("b"), F.try_divide(covariance, F.sqrt(spread_a * spread_b)))
    return of_pair.groupBy("column", "later_column").agg(F.abs(r).alias("abs_correlation"))


def redundant_columns(pairs: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Columns that correlate above the threshold with an earlier column."""
    return (
        pairs.filter(F.col("abs_correlation") > threshold)
        .select(F.col("later_column").alias("column"))
        .distinct()
    )


def drop_redundant(
    listings: DataFrame,
    columns: Sequence[str] = CORRELATED_COLUMNS,
    threshold: float = 0.95,
) -> DataFrame:
    """The listings without their redundant columns.

    Runs the correlation job, since the result's schema depends on it.
    """
    found = redundant_columns(correlation_pairs(listings, columns), threshold)
    return listings.drop(*[row[0] for row in found.collect()])


def head(listings: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in an explicit order, for inspection."""
    return listings.orderBy(*order).limit(n)


def sample(listings: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """A random part of the rows, for inspection."""
    return listings.sample(fraction=fraction, seed=seed)


#: Leading hexadecimal digits of a hash that the histogram of a sample counts by.
_HASH_DIGITS = 4


def sample_rows(listings: DataFrame, n: int, by: Sequence[str], seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the smallest hashes.

    The hash is of the text of the columns ``by``, which should tell rows apart, and the
    seed. The same rows come out however the table is partitioned; rows with equal ``by``
    are ordered by their other columns. A histogram of leading digits shows up to where
    all rows are taken; only those of one further bucket, a 65,536th, are put in order.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in by])
    hashed = listings.withColumn("_hash", F.sha2(text, 256)).withColumn("_bucket", F.substring("_hash", 1, _HASH_DIGITS))
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    up_to = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    edge = sizes.withColumn("_upto", F.sum("_size").over(up_to)).filter(F.col("_upto") - F.col("_size") < n)
    last = edge.agg(F.max(F.struct("_bucket", "_upto", "_size"))).first()[0]
    if last is None or n <= 0:
        return listings.limit(0)
    whole = hashed.filter(F.col("_bucket") < last["_bucket"])
    missing = n - (last["_upto"] - last["_size"])
    rest = hashed.filter(F.col("_bucket") == last["_bucket"]).orderBy("_hash", *listings.columns).limit(missing)
    return whole.unionByName(rest).select(*listings.columns)


def highest_price_per_area(listings: DataFrame) -> DataFrame:
    return listings.agg(F.max("priceByArea").alias("max_priceByArea"))


def scope_districts(datasets: Sequence[DataFrame]) -> DataFrame:
    """Districts that occur in any of the datasets, sorted."""
    return _options(datasets, "district").distinct().orderBy("district")


def scope_neighborhoods(
    datasets: Sequence[DataFrame], districts: Sequence[str] = ()
) -> DataFrame:
    """Neighborhoods in any of the datasets, optionally of some districts."""
    options = _options(datasets, "neighborhood")
    if districts:
        options = options.filter(F.col("district").isin(*districts))
    return options.select("neighborhood").distinct().orderBy("neighborhood")


def _options(datasets: Sequence[DataFrame], column: str) -> DataFrame:
    out: DataFrame | None = None
    for df in datasets:
        if column not in df.columns:
            continue
        wanted = list(dict.fromkeys(("district", column)))
        part = df.select(*wanted).filter(F.col(column) != "").distinct()
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError(f"no dataset has the column {column!r}")
    return out
