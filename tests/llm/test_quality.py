import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casametra.llm import quality
from casametra.llm.common import id_crc
from tests.llm.cases import ODD, no_documents, odd_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.quality_scores(docs, labels, learn=id_crc("doc_id") % 3 != 1)
    assert found.count() == docs.count()
    judged = found.join(labels, "doc_id").filter(id_crc("doc_id") % 3 == 1)
    right, n = judged.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 100 and right >= 0.95
    assert found.filter("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.5 AS INT)").isEmpty()
    kept = quality.accepted(docs, labels, learn=id_crc("doc_id") % 3 != 1)
    assert kept.columns == docs.columns
    assert kept.count() == found.filter("predicted = 1").count()


def test_votes_against_plain_neighbours():
    rng = np.random.default_rng(2)
    vectors = quality.unit(rng.standard_normal((200, 8))).astype(np.float32)
    labels, weights = rng.integers(0, 2, 200).astype(np.float32), rng.random(200).astype(np.float32)
    model = quality.Model(None, None, vectors, labels, weights)
    asked = quality.unit(rng.standard_normal((20, 8))).astype(np.float32)
    for query, share in zip(asked, quality.votes(model, asked)):
        cosine = vectors @ query
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 1e-3) ** quality.POWER * weights[near]
        assert share == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-4)


def test_terms_of_shapes_and_repetitions():
    texts = pa.array(["plain words here", "PLAIN!! WORDS!! HERE!!", "same same same same", "", None])
    counts = quality.term_counts(texts)
    assert counts.shape == (5, quality.TERMS) and np.isfinite(counts).all()
    shapes = counts[:, quality.WORD_TERMS : quality.WORD_TERMS + quality.SHAPE_TERMS]
    assert (shapes[0] > 0).sum() == 1 and (shapes[1] > 0).sum() == 1 and (shapes[0] != shapes[1]).any()
    assert counts[2, quality.WORD_TERMS + quality.SHAPE_TERMS :].any()
    assert (counts[3] == counts[4]).all() and counts[3, -1] == 1


def test_odd_documents_and_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 0, "x"), (2, 1, "x"), (6, 0, "x"), (7, 0, "x"), (None, 1, "x"), (9, None, "x"), (10, 5, "x"), (77, 1, "x")],
        "doc_id long, quality int, text string",
    )
    found = quality.quality_scores(odd_documents(spark), labels, learn=F.lit(True)).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    unlabelled = quality.quality_scores(odd_documents(spark), labels.limit(0), learn=F.lit(True)).collect()
    assert {(r.score, r.predicted) for r in unlabelled} == {(0.5, 1)}
    assert quality.quality_scores(no_documents(spark), labels, learn=F.lit(True)).collect() == []
