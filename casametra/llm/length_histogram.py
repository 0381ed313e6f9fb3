"""Token counts from an exact histogram of encoded lengths.

Documents are counted by encoded length, with partial counts before the shuffle.
Sums over the lengths from either end then answer, for every context limit at once:
how many documents exceed it, how many tokens are kept when texts are truncated to
it, and which quantile it is. Between two neighbouring lengths all of these are
constant or linear in the limit, so that one row per length is the whole answer.

The running sums go over blocks of lengths, then over the blocks, so that no task
sorts all lengths. Null and empty texts have length 0; an empty table gives no rows;
repeated rows count each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.tokens import token_lengths

#: Lengths in one block of the running sums.
BLOCK = 2048


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Documents by encoded length: n_tokens, n_docs."""
    return token_lengths(docs, path).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def with_sums(lengths: DataFrame) -> DataFrame:
    """Totals up to and beyond each length of a histogram.

    docs_upto, tokens_upto: documents of at most this length, and their tokens;
    docs_beyond: longer documents; truncated_tokens: tokens kept when every document is
    truncated to this length; total_docs, total_tokens: of all; quantile: share of
    documents of at most this length.
    """
    rows = lengths.withColumns(
        {"_tokens": F.col("n_tokens") * F.col("n_docs"), "_block": F.floor(F.col("n_tokens") / BLOCK)}
    )
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    over = Window.orderBy("_block")
    blocks = blocks.select(
        "_block",
        (F.sum("_d").over(over) - F.col("_d")).alias("_docs_before"),
        (F.sum("_t").over(over) - F.col("_t")).alias("_tokens_before"),
        F.sum("_d").over(Window.partitionBy()).alias("total_docs"),
        F.sum("_t").over(Window.partitionBy()).alias("total_tokens"),
    )
    within = Window.partitionBy("_block").orderBy("n_tokens")
    joined = rows.join(blocks, "_block").withColumns(
        {
            "docs_upto": F.col("_docs_before") + F.sum("n_docs").over(within),
            "tokens_upto": F.col("_tokens_before") + F.sum("_tokens").over(within),
        }
    )
    beyond = F.col("total_docs") - F.col("docs_upto")
    return joined.select(
        "n_tokens", "n_docs", "docs_upto", "tokens_upto", beyond.alias("docs_beyond"),
        (F.col("tokens_upto") + beyond * F.col("n_tokens")).alias("truncated_tokens"),
        "total_docs", "total_tokens", (F.col("docs_upto") / F.col("total_docs")).alias("quantile"),
    )


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: tokens kept and documents cut when texts are truncated to ``limit``."""
    upto = F.col("n_tokens") <= limit
    docs, tokens = (F.coalesce(F.max(F.when(upto, F.col(c))), F.lit(0)) for c in ("docs_upto", "tokens_upto"))
    total = F.coalesce(F.max("total_docs"), F.lit(0))
    return sums.agg(
        (tokens + (total - docs) * limit).alias("kept_tokens"), (total - docs).alias("cut_docs")
    )


def length_quantile(sums: DataFrame, share: float | Column) -> DataFrame:
    """One row: the smallest length that at least this share of documents does not exceed."""
    return sums.filter(F.col("docs_upto") >= F.lit(share) * F.col("total_docs")).agg(
        F.min("n_tokens").alias("length")
    )


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The histogram of the documents with its sums; the texts are encoded once."""
    stage = Stage(docs.sparkSession, "lengths")
    return with_sums(stage.table(histogram(docs, path), "histogram"))
