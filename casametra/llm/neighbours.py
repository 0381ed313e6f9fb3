"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned from a bounded sample (principal axes, then iterative quantisation)
turns each vector into a code of 64 bits, cut into four substrings. Two codes within a
Hamming radius R agree in one substring up to R/4 flips (pigeonhole), so every code within
the radius is met in the index of some substring. The index of a substring is dealt by the
leading bits of its value; a query goes to each part that a value within R/4 flips can be
in. There, values too far away are passed over, full codes are compared, and what lies within
R is ranked by exact distances of the original vectors. A pair is looked at only in the
first substring that brings it together. The radius comes from the sample: it holds for
``COVERED`` of the sample's own nearest neighbours, which are farther apart than those
among all vectors. Queries that find too few within R are asked again without a radius.

Equal vectors are one entry, with their smallest ids, and ask once. Parts of the index that
many codes fall into are cut further, and queries go to each piece.

Defined cases: vectors that are null, zero or have a null or non-finite component, and
those whose length is not the most frequent one, take no part; nor do rows without an
id; repeated rows are one; equal distances are ranked by id; without vectors or queries
there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage

BITS, SUBSTRINGS = 64, 4
SUBSTRING_BITS = BITS // SUBSTRINGS
#: Vectors that the rotation and the radius are learned from, at most.
SAMPLE = 4096
#: Rounds of iterative quantisation.
ROUNDS = 30
#: Share of the sample's nearest neighbours within the radius.
COVERED = 0.97
#: Entries of a part of the index, about.
PART = 8192
#: Queries compared with a part at a time.
BLOCK = 64


class Codes(NamedTuple):
    mean: np.ndarray
    projection: np.ndarray
    radius: int


def fitted(sample: np.ndarray, k: int) -> Codes:
    """Rotation and radius from sample vectors."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:BITS].T
    rng = np.random.default_rng(5)
    if axes.shape[1] < BITS:
        axes = np.hstack([axes, rng.standard_normal((sample.shape[1], BITS - axes.shape[1]))])
    projected = centred @ axes
    turn, _ = np.linalg.qr(rng.standard_normal((BITS, BITS)))
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(projected @ turn > 0, 1.0, -1.0).T @ projected)
        turn = (left @ right).T
    codes = Codes(mean, axes @ turn, BITS)
    code = coded(codes, sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // 512))
    far = []
    for i in asked:
        near = np.argsort(((sample - sample[i]) ** 2).sum(axis=1), kind="stable")[1 : k + 1]
        far.append(np.bitwise_count(code[near] ^ code[i]))
    flat = np.concatenate(far) if far else np.zeros(0)
    radius = int(np.quantile(flat, COVERED, method="higher")) if len(flat) else BITS
    return codes._replace(radius=radius)


def coded(codes: Codes, vectors: np.ndarray) -> np.ndarray:
    bits = (vectors - codes.mean) @ codes.projection > 0
    return np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64)


def substring(code: np.ndarray, s: int) -> np.ndarray:
    shift = np.uint64(BITS - SUBSTRING_BITS * (s + 1))
    return (code >> shift) & np.uint64((1 << SUBSTRING_BITS) - 1)


# --- vectors ----------------------------------------------------------------


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Distinct rows (id, vec) that take part: vec is an array of doubles."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    fine = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & fine).distinct()
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (sizes["n"] if sizes else 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: vid (its smallest id), vec and its k + 1 smallest ids."""
    nth = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    return (
        rows.withColumn("_nth", nth).filter(F.col("_nth") <= k + 1)
        .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("vid"), "vec", "ids")
    )


def with_codes(distinct: DataFrame, codes: Codes) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = coded(codes, _matrix(batch.column("vec"))) if batch.num_rows else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values.view(np.int64))], [*batch.schema.names, "code"])

    return distinct.select("vid", "vec").mapInArrow(code, "vid long, vec array<double>, code long")


# --- index and probing ------------------------------------------------------


def index_parts(coded_vectors: DataFrame, lead: int) -> DataFrame:
    """Entries of every substring's index: s, part (its leading bits), vid, vec, code."""
    return coded_vectors.select(
        F.explode(F.array(*[F.struct(F.lit(s).alias("s"), _lead(s, lead).alias("part")) for s in range(SUBSTRINGS)])).alias("_at"),
        "vid", "vec", "code",
    ).select("_at.s", "_at.part", "vid", "vec", "code")


def _lead(s: int, lead: int) -> Column:
    shift = BITS - SUBSTRING_BITS * s - lead
    bits = F.shiftrightunsigned("code", shift) if shift < BITS else F.lit(0).cast("long")
    return bits.bitwiseAND(F.lit((1 << lead) - 1)).cast("int")


def probes(queries: DataFrame, lead: int, flips: int) -> DataFrame:
    """For each query and substring, the parts that values within so many flips can be in."""
    masks = np.arange(1 << lead)
    near = masks[np.bitwise_count(masks) <= flips].tolist()
    at = index_parts(queries, lead)
    reached = F.array(*[F.col("part").bitwiseXOR(F.lit(m)) for m in near])
    return at.withColumn("part", F.explode(reached))


def search(coded_vectors: DataFrame, queries: DataFrame, radius: int, k: int, lead: int) -> DataFrame:
    """The k + 1 nearest entries of each query among those within the radius: qid, vid, score."""
    flips = radius // SUBSTRINGS
    index = index_parts(coded_vectors, lead)
    sizes = index.groupBy("s", "part").agg(F.ceil(F.count("*") / PART).cast("int").alias("_pieces"))
    index = index.join(sizes, ["s", "part"]).withColumn("piece", F.pmod(F.xxhash64("vid"), F.col("_pieces")).cast("int"))
    asked = probes(queries, lead, flips).join(sizes, ["s", "part"]).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
    )
    keys = ["s", "part", "piece"]
    # new names on either side, as both come from the same table
    index = index.select(*keys, "vid", "vec", "code").toDF("s", "part", "piece", "vid", "vec", "code")
    asked = asked.select(*keys, "vid", "vec", "code").toDF("s", "part", "piece", "qid", "qvec", "qcode")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        qid, vid, score = [], [], []
        if left.num_rows and right.num_rows:
            s = left.column("s")[0].as_py()
            ids, vectors = left.column("vid").to_numpy(), _matrix(left.column("vec"))
            code = left.column("code").to_numpy().view(np.uint64)
            q_ids, q_vectors = right.column("qid").to_numpy(), _matrix(right.column("qvec"))
            q_code = right.column("qcode").to_numpy().view(np.uint64)
            for low in range(0, len(q_ids), BLOCK):
                block = q_code[low : low + BLOCK, None]
                near = np.bitwise_count(substring(block, s) ^ substring(code, s)) <= flips
                for before in range(s):
                    near &= np.bitwise_count(substring(block, before) ^ substring(code, before)) > flips
                near &= np.bitwise_count(block ^ code) <= radius
                for row in range(len(block)):
                    found = np.flatnonzero(near[row])
                    if len(found):
                        apart = np.sqrt(((vectors[found] - q_vectors[low + row]) ** 2).sum(axis=1))
                        best = np.lexsort((ids[found], apart))[: k + 1]
                        qid.append(np.full(len(best), q_ids[low + row]))
                        vid.append(ids[found[best]])
                        score.append(apart[best])
        empty = np.zeros(0, dtype=np.int64)
        return pa.table({
            "qid": np.concatenate([empty, *qid]), "vid": np.concatenate([empty, *vid]),
            "score": np.concatenate([empty.astype(float), *score]),
        })

    met = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        meet, "qid long, vid long, score double"
    )
    nth = F.row_number().over(Window.partitionBy("qid").orderBy("score", "vid"))
    return met.withColumn("_nth", nth).filter(F.col("_nth") <= k + 1).drop("_nth")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest found of each query: query_id, rank, the candidate's id and score."""
    stage = Stage(vectors.sparkSession, "neighbours")
    rows = stage.table(usable(vectors, id_column, vector), "rows")
    distinct = stage.table(entries(rows, k), "entries")
    asking = rows.withColumnRenamed("id", id_column).filter(is_query).select(F.col(id_column).alias("query_id"), "vec")
    # the vector that each query asks for
    asking = stage.table(asking.join(distinct.select("vid", "vec"), "vec").select("query_id", F.col("vid").alias("qid")), "asking")
    total = distinct.count()
    sample = distinct.select("vec").orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE).collect() if total else []
    if not sample:
        return asking.select("query_id", F.lit(0).alias("rank"), F.col("qid").alias(id_column), F.lit(0.0).alias("score")).limit(0)
    codes = fitted(np.array([r["vec"] for r in sample]), k)
    lead = int(np.clip(np.ceil(np.log2(max(total / PART, 1))), 0, SUBSTRING_BITS))

    coded_vectors = stage.table(with_codes(distinct, codes), "codes")
    queries = coded_vectors.join(asking.select(F.col("qid").alias("vid")).distinct(), "vid", "left_semi")
    found = stage.table(search(coded_vectors, queries, codes.radius, k, lead), "found")
    met = found.groupBy(F.col("qid").alias("vid")).agg(F.count("*").alias("_n"))
    few = queries.join(met, "vid", "left").filter(F.coalesce("_n", F.lit(0)) < min(k + 1, total)).select("vid", "vec", "code")
    few = stage.table(few, "few")
    if not few.isEmpty():
        again = search(coded_vectors, few, BITS, k, lead)
        found = found.join(few.select(F.col("vid").alias("qid")), "qid", "left_anti").unionByName(again)

    listed = found.join(distinct.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("id"))
    nth = F.row_number().over(Window.partitionBy("qid").orderBy("score", "id"))
    listed = listed.withColumn("_nth", nth).filter(F.col("_nth") <= k + 1).drop("_nth")
    matched = asking.join(listed, "qid").filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return matched.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_column), "score"
    )
