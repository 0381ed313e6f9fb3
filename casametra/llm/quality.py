"""Quality by the votes of the nearest labelled documents in a latent-semantic space.

A text becomes counts of hashed terms: its words, the shapes of its words (runs of
lower case, upper case, digits and each sign drawn together), immediate repetitions,
and how much of it repeats itself. Term weights from the labelled sample and a truncated
singular value decomposition of it give a space of few dimensions. The labelled vectors
(at most ``SAMPLE`` of them, so a few MB) are broadcast. Every document is compared with
all of them, in blocks of exact cosine products, and the labels of its nearest
neighbours vote with weights that grow with the similarity.

Defined cases: null, empty and blank texts have a term of their own, so they get a score
like others; without any labelled text every score is 0.5; a null doc_id is never
learned from; repeated rows score alike; a document with two labels counts once with each;
no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casametra.llm.words import row_groups, text_windows, word_hashes, words_of

#: Labelled documents of each label that are learned from, at most.
SAMPLE = 2048
#: Buckets of hashed terms, and dimensions of the latent space.
TERMS, DIMENSIONS = 4096, 48
#: Buckets for words and for shapes; the last ones are for single figures of a text.
WORD_TERMS, SHAPE_TERMS = 2560, 1408
#: Neighbours that vote, and the power of the similarity that is their weight.
NEIGHBOURS, POWER = 24, 1
#: Documents compared with the labelled ones at a time.
ROWS = 256

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")


class Model(NamedTuple):
    """Term weights, basis of the space, labelled unit vectors, their labels and weights."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


def term_counts(texts: pa.Array) -> np.ndarray:
    """Weighted counts of the hashed terms of each text, without the weights of the terms."""
    n = len(texts)
    words = words_of(texts)
    start, end, owner = words.start, words.end, words.text
    # shapes: the classes of a word's bytes, each run of one class drawn together
    classes = _CLASS[words.data]
    within = np.zeros(len(classes) + 1, dtype=np.int32)
    within[start] += 1
    np.add.at(within, end, -1)
    inside = np.cumsum(within[:-1]) > 0
    turn = inside.copy()
    turn[1:] &= classes[1:] != classes[:-1]
    turn[start] = True
    at = np.r_[0, np.cumsum(turn)]
    shapes = word_hashes(classes[turn], at[start], at[end], seed=3)
    total = np.maximum(np.bincount(owner, minlength=n), 1)

    out = np.zeros((n, TERMS), dtype=np.float32)
    flat = out.reshape(-1)
    base = owner * TERMS
    for hashes, low, size in ((words.hash, 0, WORD_TERMS), (shapes, WORD_TERMS, SHAPE_TERMS)):
        keys, counts = np.unique(base + low + (hashes % np.uint64(size)).astype(np.int64), return_counts=True)
        flat[keys] = counts
    figures = WORD_TERMS + SHAPE_TERMS
    again = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    repeated = np.bincount(owner[1:][again], minlength=n)
    windows, place = text_windows(words, n, 5, seed=4)
    order = np.lexsort((windows, owner[place]))
    w, o = windows[order], owner[place][order]
    same = np.bincount(o[1:][(w[1:] == w[:-1]) & (o[1:] == o[:-1])], minlength=n)
    for k, figure in enumerate((repeated, same)):
        level = np.minimum(np.ceil(8 * figure / total).astype(int), 8)
        hit = np.flatnonzero(figure)
        out[hit, figures + 16 * k + level[hit]] = total[hit] * 0.5
    out[np.bincount(owner, minlength=n) == 0, TERMS - 1] = 1
    return np.sqrt(out / total[:, None].astype(np.float32))


def fitted(counts: np.ndarray, labels: np.ndarray, share: np.ndarray) -> Model:
    """The model of labelled documents; ``share`` is the weight of each, by its label."""
    present = (counts > 0).sum(axis=0)
    idf = np.log((1 + len(counts)) / (1 + present)).astype(np.float32)
    weighted = counts * idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    rng = np.random.default_rng(7)
    size = min(DIMENSIONS, *weighted.shape)
    probe = weighted.T @ (weighted @ rng.standard_normal((TERMS, min(size + 16, TERMS))).astype(np.float32))
    for _ in range(4):
        probe, _ = np.linalg.qr(probe)
        probe = weighted.T @ (weighted @ probe)
    probe, _ = np.linalg.qr(probe)
    _, _, right = np.linalg.svd(weighted @ probe, full_matrices=False)
    basis = (probe @ right[:size].T).astype(np.float32)
    return Model(idf, basis, unit(weighted @ basis), labels.astype(np.float32), share.astype(np.float32))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def embedded(model: Model, counts: np.ndarray) -> np.ndarray:
    weighted = counts * model.idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    return unit(weighted @ model.basis)


def votes(model: Model, vectors: np.ndarray) -> np.ndarray:
    """Share of label 1 in the weighted votes of the nearest labelled vectors."""
    cosines = vectors @ model.vectors.T
    k = min(NEIGHBOURS, len(model.labels))
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-3) ** POWER * model.weights[near]
    return (weight * model.labels[near]).sum(axis=1) / weight.sum(axis=1)


# --- on Spark ---------------------------------------------------------------


def labelled_sample(labels: DataFrame, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """At most ``SAMPLE`` labelled ids of each label, by hash, and how many there are of each."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & learn).select(
        "doc_id", F.col("quality").cast("int").alias("quality")
    )
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    picked = [
        usable.filter(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for label in (0, 1)
    ]
    return picked[0].union(picked[1]), counts


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model | None:
    """A model of the labelled documents for which ``learn`` holds; None without any."""
    sample, counts = labelled_sample(labels, learn)
    known = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "quality")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            terms = term_counts(batch.column("text"))
            rows = [np.flatnonzero(row) for row in terms]
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array([r.astype(np.uint16).tobytes() for r in rows], pa.binary()),
                 pa.array([terms[k][r].tobytes() for k, r in enumerate(rows)], pa.binary())],
                ["quality", "terms", "counts"],
            )

    # at most 2 * SAMPLE rows of at most TERMS entries
    rows = known.mapInArrow(sparse, "quality int, terms binary, counts binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["quality"], bytes(r["terms"]), bytes(r["counts"])))
    matrix = np.zeros((len(rows), TERMS), dtype=np.float32)
    for k, row in enumerate(rows):
        matrix[k, np.frombuffer(row["terms"], np.uint16)] = np.frombuffer(row["counts"], np.float32)
    label = np.array([r["quality"] for r in rows])
    found = np.bincount(label, minlength=2)
    share = np.array([counts.get(q, 0) / max(found[q], 1) for q in (0, 1)])
    return fitted(matrix, label, share[label])


def row_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_groups(batches, "text"):
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows with their columns in ``row``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in row_slices(batches):
            if model is None:
                value = np.full(batch.num_rows, 0.5)
            else:
                value = np.clip(votes(model, embedded(model, term_counts(batch.column("text")))).astype(np.float64), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(value), pa.array((value >= 0.5).astype(np.int32))], ["row", "score", "predicted"]
            )

    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(score, f"row {kind}, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """Per row: doc_id, score and predicted (1 from a score of 0.5 on)."""
    model = fit(docs, labels, learn)
    return scored(docs.select("doc_id", "text"), model).select("row.doc_id", "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    return scored(docs, fit(docs, labels, learn)).filter("predicted = 1").select("row.*")
