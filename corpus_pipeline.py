"""Corpus preparation: quality, near-copies, repeated passages, mixing, packing.

Each stage takes the documents that the stage before it kept and returns those it keeps,
with the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casametra.llm.common import id_crc, ship
from casametra.llm.minhash import representatives
from casametra.llm.mixing import mixed_documents
from casametra.llm.packing import pack
from casametra.llm.quality import accepted
from casametra.llm.substrings import documents_without_repeats
from casametra.staging import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return accepted(docs, labels, learn=id_crc("doc_id") % 3 != 1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-copies."""
    return representatives(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    return documents_without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024 tokens."""
    return pack(docs, capacity=1024, end=2)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages learn, hash and tokenize, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each over the written rows of the one before."""
    root = scratch_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
