import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casametra.llm import minhash, mixing, quality
from casametra.llm.common import id_crc
from tests.llm.test_minhash import components
from tests.llm.test_substrings import brute_force

SF = "/root/testdata/sf0.001"
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append(docs)
    return out


def test_every_stage_against_its_input(spark, stages):
    docs, good, single, unique, mixed, packed = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixing", "packing"]
    assert all(df.columns == DOCUMENT for df in stages[:-1])

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = quality.quality_scores(docs, labels, learn=id_crc("doc_id") % 3 != 1)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.filter("predicted = 1").collect()}

    sets = {r.doc_id: minhash.exact_set(r.text, 5) for r in good.collect()}
    groups = components(sets)
    assert {r.doc_id for r in single.collect()} == {i for i, root in groups.items() if i == root}

    rows = [(r.doc_id, r.text) for r in single.collect()]
    expected = {i: (removed, kept) for i, _, removed, kept in brute_force(rows)}
    for r in unique.collect():
        removed, kept = expected[r.doc_id]
        assert r.text == (kept if removed else dict(rows)[r.doc_id]) and r.n_chars == len(r.text)
    assert unique.count() == single.count()

    copies = {r.doc_id: r.copies for r in mixing.mix_sources(unique).collect()}
    counted = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in copies.items() if n}

    places = {}
    for r in packed.collect():
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        found.sort()
        assert [o for o, _ in found] == [0, *np.cumsum([n for _, n in found])[:-1].tolist()] and sum(n for _, n in found) <= 1024
    first = packed.filter("piece = 0").groupBy("doc_id").count()
    assert {r.doc_id: r["count"] for r in first.collect()} == counted


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(key).collect())) == sorted(map(tuple, stages[-1].select(key).collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_clean_documents_are_kept(spark, stages):
    """What is labelled good and resembles nothing goes on to the mix."""
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    docs, good = stages[0], stages[1]
    n = docs.join(labels, "doc_id", "left_semi").count()
    assert good.join(labels, "doc_id", "left_semi").filter(F.col("text").isNotNull()).count() >= 0.97 * n
