"""Mixing sources to target weights by thresholds on a document hash.

Every document has a fixed 63-bit hash. A histogram of words by source and leading
hash bits shows in which bucket a source's budget ends; only the documents of that
boundary bucket are looked at one by one. What remains of the budget then goes, by
the same steps, to documents small enough to fit, in a fixed number of rounds, and at
last to single documents whose size comes nearest to it. A document is chosen if its
hash and size lie in one of its source's ranges, so the choice is a filter: no source
is sorted, and reruns agree.
A source whose target exceeds its size gives all documents once, twice or three
times, and the rest of the target by the same choice.

Defined cases: a null text has size 0 and gives nothing; a null source is a source
of its own, last in order; repeated rows share a hash and are chosen together; an
empty table gives no rows; a null doc_id hashes like any other value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage, WORD, source_key

#: Leading hash bits of a histogram bucket. A boundary bucket holds 1/4096 of a source.
BUCKET_BITS = 12
#: Rounds of filling what is left of a budget with documents that fit.
ROUNDS = 3
#: Single documents of the nearest size that may be added at last.
SINGLES = 2
#: Pieces of a source in joins with the small table of sources.
SALTS = 16

HASH_BITS = 63


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash() -> Column:
    """63 bits from doc_id and source; the same in every run."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(41), "doc_id", "_source"), 1)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source key, size in words and hash of each document."""
    return docs.select(
        "doc_id", source_key("source").alias("_source"), word_count("text").alias("size")
    ).withColumn("_hash", document_hash())


def source_targets(sizes: DataFrame, stage: Stage, weights: Sequence[float], max_repeats: float) -> DataFrame:
    """Target words of each source: budgets by weight, none above its stop.

    The budget is the size of all sources together. Sources in code point order, null
    last, weigh ``weights`` in turn. A source above its stop gives the excess back, which
    is shared by weight until none is above: target = min(level * weight, stop).
    Only totals of each round come to the driver.
    """
    spark = stage.spark
    totals = stage.table(sizes.groupBy("_source").agg(F.sum("size").alias("source_size")), "totals")
    null_last = totals.withColumn("_null", F.col("_source") == "0").orderBy("_null", "_source").select("_source", "source_size")
    ranked = spark.createDataFrame(
        null_last.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])),
        "_source string, source_size long, _rank long",
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = stage.table(
        ranked.withColumns({"_weight": weight, "_stop": F.col("source_size") * float(max_repeats)}), "sources"
    )
    level, held = 0.0, -1
    while True:
        full = F.col("_stop") <= F.col("_weight") * level
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.count_if(full).alias("held"),
            F.sum(F.when(full, F.col("_stop"))).alias("kept"),
            F.sum(F.when(~full, F.col("_weight"))).alias("weight"),
        ).first()
        if row["held"] == held or not row["weight"]:
            break
        held, level = row["held"], (row["all"] - (row["kept"] or 0.0)) / row["weight"]
    return sources.select("_source", "source_size", F.least(F.col("_weight") * level, F.col("_stop")).alias("target"))


def salted(sources: DataFrame) -> DataFrame:
    """Each source in all its pieces, so that a hot source is not one join key."""
    return sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def with_salt(sizes: DataFrame) -> DataFrame:
    return sizes.withColumn("_salt", (F.col("_hash") % SALTS).cast("int"))


RANGES = "array<struct<least: bigint, limit: bigint, from: bigint, below: bigint>>"


def chosen() -> Column:
    """Whether one of the source's ranges of size and hash takes the document."""
    return F.exists(
        "_thresholds",
        lambda t: F.col("size").between(t["least"], t["limit"])
        & (F.col("_hash") >= t["from"]) & (F.col("_hash") < t["below"]),
    )


def size_and_hash_range(least: Column, limit: Column, start: Column, below: Column) -> Column:
    return F.array(F.struct(
        least.cast("long").alias("least"), limit.cast("long").alias("limit"),
        start.cast("long").alias("from"), below.cast("long").alias("below"),
    ))


def choose_round(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """One round: budgets with a further threshold for each source and what then remains.

    ``budgets`` has, per source, the words still to take (``_left``) and the thresholds so far.
    """
    open_rows = (
        with_salt(sizes)
        .join(salted(budgets.select("_source", "_left", "_thresholds")), ["_source", "_salt"])
        .filter((F.col("size") > 0) & (F.col("size") <= F.greatest("_left", F.when(F.size("_thresholds") == 0, F.lit(1 << 62)))) & ~chosen())
        .withColumn("_bucket", F.shiftright("_hash", HASH_BITS - BUCKET_BITS))
    )
    histogram = open_rows.groupBy("_source", "_bucket").agg(
        F.sum("size").alias("_words"), F.first("_left").alias("_left")
    )
    upto = F.sum("_words").over(Window.partitionBy("_source").orderBy("_bucket"))
    boundary = (
        histogram.withColumn("_before", upto - F.col("_words"))
        .filter((F.col("_before") <= F.col("_left")) & (F.col("_before") + F.col("_words") > F.col("_left")))
        .select("_source", "_bucket", "_before")
    )
    inside = open_rows.select("_source", "_bucket", "_hash", "size", "_left").join(boundary, ["_source", "_bucket"])
    by_hash = inside.groupBy("_source", "_hash", "_before", "_left").agg(F.sum("size").alias("size"))
    cumulated = by_hash.withColumn(
        "_after", F.col("_before") + F.sum("size").over(Window.partitionBy("_source").orderBy("_hash"))
    )
    cut = cumulated.groupBy("_source").agg(
        F.min(F.when(F.col("_after") > F.col("_left"), F.col("_hash"))).alias("_cut"),
        F.max(F.when(F.col("_after") <= F.col("_left"), F.col("_after"))).alias("_inner"),
        F.first("_before").alias("_outer"),
    )
    whole = histogram.groupBy("_source").agg(F.sum("_words").alias("_whole"))
    first = F.size("_thresholds") == 0
    threshold = size_and_hash_range(
        F.lit(0), F.when(first, F.lit(1 << 62)).otherwise(F.floor("_left")),
        F.lit(0), F.coalesce("_cut", F.lit((1 << 63) - 1)),
    )
    took = F.coalesce("_inner", "_outer", "_whole", F.lit(0))
    return (
        budgets.join(whole, "_source", "left")
        .join(cut, "_source", "left")
        .select(
            "_source", "source_size", "target", "_copies",
            F.concat("_thresholds", threshold).alias("_thresholds"),
            (F.col("_left") - took).alias("_left"),
        )
    )


def choose_single(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """Adds to each source the document whose size comes nearest to what is left, if that helps."""
    off = F.abs(F.col("size") - F.col("_left"))
    nearest = (
        with_salt(sizes)
        .join(salted(budgets.select("_source", "_left", "_thresholds")), ["_source", "_salt"])
        .filter((F.col("size") > 0) & (off < F.col("_left")) & ~chosen())
        .groupBy("_source").agg(F.min(F.struct(off.alias("off"), F.col("_hash").alias("hash"), F.col("size").alias("size"))).alias("_one"))
    )
    one = F.col("_one")
    added = F.when(one.isNull(), F.expr(f"CAST(array() AS {RANGES})")).otherwise(
        size_and_hash_range(one["size"], one["size"], one["hash"], one["hash"] + 1)
    )
    return budgets.join(nearest, "_source", "left").select(
        "_source", "source_size", "target", "_copies", F.concat("_thresholds", added).alias("_thresholds"),
        (F.col("_left") - F.coalesce(one["size"], F.lit(0))).alias("_left"),
    )


def mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeats: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents, and for each source its target, full copies and thresholds."""
    stage = Stage(docs.sparkSession, "mixing")
    sizes = stage.table(sized(docs), "sizes")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    budgets = source_targets(sizes, stage, weights, max_repeats).withColumn("_copies", copies).select(
        "*",
        F.expr(f"CAST(array() AS {RANGES})").alias("_thresholds"),
        (F.col("target") - F.col("_copies") * F.col("source_size")).alias("_left"),
    )
    for k in range(ROUNDS):
        budgets = stage.table(choose_round(sizes, budgets), f"budgets-{k}")
    for k in range(SINGLES):
        budgets = stage.table(choose_single(sizes, budgets), f"singles-{k}")
    return sizes, budgets


def repeats(budgets_joined: DataFrame) -> Column:
    """How often the mix takes a document."""
    return F.col("_copies") + F.when((F.col("size") > 0) & chosen(), 1).otherwise(0)


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeats: float = 3.0) -> DataFrame:
    """Per document: doc_id, size, source_size, target, copies and taken words."""
    sizes, budgets = mixture(docs, weights, max_repeats)
    joined = with_salt(sizes).join(salted(budgets), ["_source", "_salt"])
    return joined.withColumn("copies", repeats(joined)).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeats: float = 3.0) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    _, budgets = mixture(docs, weights, max_repeats)
    rows = docs.select(F.struct("*").alias("_row"), "doc_id", "text", source_key("source").alias("_source"))
    rows = rows.select("_row", "doc_id", "_source", word_count("text").alias("size")).withColumn("_hash", document_hash())
    joined = with_salt(rows).join(salted(budgets), ["_source", "_salt"])
    times = F.array_repeat(F.lit(0), repeats(joined))
    return joined.select("_row", F.explode(times)).select("_row.*")
