"""The operators of this subpackage over the given tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casametra.llm import (
    archives,
    importance,
    language,
    length_histogram,
    minhash,
    mixing,
    neighbours,
    oracle,
    packing,
    phrases,
    quality,
    simhash,
    substrings,
    toxicity,
)
from casametra.llm.common import Stage, id_crc, read

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    remainder = id_crc("doc_id") % 5
    found = language.identify_languages(docs, learn=remainder != 0)
    return found.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read(spark, sf, "documents"), capacity=1024, end=2)


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    remainder = id_crc("doc_id") % 3
    found = quality.quality_scores(read(spark, sf, "documents"), read(spark, sf, "labels"), learn=remainder != 1)
    return found.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf, "documents"))


def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.edited_fingerprints(read(spark, sf, "documents"))


def op6_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf, "documents"), size=2, percent=80)


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return length_histogram.token_counts(read(spark, sf, "documents"))


def op8_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf, "embeddings"), is_query=F.col("vec_id") % 100 == 0, k=10)


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = substrings.remove_repeated(read(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = Stage(spark, "warc").path("archives")
    records = archives.archive_pages(read(spark, sf, "pages"), path)
    return records.select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(read(spark, sf, "documents"), least=30, subsumed_percent=80, first=2000)


def op12_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    remainder = id_crc("doc_id") % 4
    found = toxicity.toxicity_scores(read(spark, sf, "documents"), read(spark, sf, "labels"), learn=remainder != 2)
    held_out = F.coalesce(remainder == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted", "threshold", "toxic")


def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    drawn = importance.resample(read(spark, sf, "documents"), read(spark, sf, "benchmark"), share=0.05, min_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_best_fit_packing,
        op3_quality,
        op4_mix_sources,
        op5_simhash,
        op6_minhash_dedup,
        op7_token_counts,
        op8_neighbours,
        op9_substring_dedup,
        op10_warc,
        op11_collocations,
        op12_toxicity,
        op13_importance_resampling,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op11_collocations": oracle.PHRASE_COLLOCATIONS,
    "op13_importance_resampling": oracle.IMPORTANCE_RESAMPLING,
}
