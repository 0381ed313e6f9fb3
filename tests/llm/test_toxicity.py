from hashlib import md5

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casametra.llm import toxicity
from casametra.llm.common import id_crc
from tests.llm.cases import ODD, no_documents, odd_documents


def small_network(rng):
    net = toxicity.new_network(rng)
    return net._replace(table=(net.table * 4).astype(np.float64), filters={w: f.astype(np.float64) for w, f in net.filters.items()},
                        biases=rng.normal(0, 0.1, len(net.biases)), output=net.output.astype(np.float64))


def plain_logit(net, rows):
    """One text, place by place and filter by filter."""
    vectors = [net.table[r].sum(axis=0) for r in rows]
    best = np.zeros(len(net.biases))
    for i in range(len(rows)):
        for k, (width, weight) in enumerate(net.filters.items()):
            for f in range(toxicity.FILTERS):
                out = net.biases[k * toxicity.FILTERS + f]
                for j in range(width):
                    if i + j < len(rows):
                        out += vectors[i + j] @ weight[j][:, f]
                best[k * toxicity.FILTERS + f] = max(best[k * toxicity.FILTERS + f], out)
    return best @ net.output + net.constant


TEXTS = ["One two three, one!", "", None, "été", "a b", "!!! ...", "w " * 70 + "x y z"]


def test_responses_against_plain_loops(monkeypatch):
    net = small_network(np.random.default_rng(3))
    rows, owner = toxicity.word_rows(pa.array(TEXTS))
    expected = [plain_logit(net, rows[owner == k]) for k in range(len(TEXTS))]
    for chunk in (toxicity.CHUNK, 7):
        monkeypatch.setattr(toxicity, "CHUNK", chunk)
        assert toxicity.logits(net, rows, owner, len(TEXTS)) == pytest.approx(expected, rel=1e-5)


def test_words_and_their_beginnings():
    rows, owner = toxicity.word_rows(pa.array(["Word wordy, WORD-word", None, "wordier"]))
    assert owner.tolist() == [0, 0, 0, 0, 2]
    assert (rows[0] == rows[2]).all() and (rows[0] == rows[3]).all()
    assert rows[0][2] == rows[1][2] == rows[4][2] and rows[0][0] != rows[1][0]


def test_gradients_against_differences():
    net = small_network(np.random.default_rng(4))
    rows, owner = toxicity.word_rows(pa.array(TEXTS))
    toxic = np.array([1, 0, 1, 0, 1, 0, 1])

    def loss(n):
        p = toxicity.sigmoid(toxicity.logits(n, rows, owner, len(toxic)))
        return -np.mean(toxic * np.log(p) + (1 - toxic) * np.log(1 - p))

    # pooling in single precision is too coarse for differences
    def pooled(n, r, o, size):
        out = np.zeros((size, len(n.biases)))
        found = toxicity.responses(n, n.table[r].sum(axis=1), o, len(r))
        np.maximum.at(out, o, found)
        return out

    original, toxicity.pooled = toxicity.pooled, pooled
    try:
        of_filters, bias, output, constant, at, step = toxicity.gradients(net, rows, owner, toxic)
        eps = 1e-6
        for width in toxicity.WIDTHS:
            for place in ((0, 0, 0), (width - 1, 3, 5)):
                higher = {w: f.copy() for w, f in net.filters.items()}
                higher[width][place] += eps
                rate = (loss(net._replace(filters=higher)) - loss(net)) / eps
                assert of_filters[width][place] == pytest.approx(rate, rel=1e-2, abs=1e-4)
        for k in (0, 9, 20):
            higher = net.output.copy()
            higher[k] += eps
            assert output[k] == pytest.approx((loss(net._replace(output=higher)) - loss(net)) / eps, rel=1e-2, abs=1e-4)
        table = net.table.copy()
        table[at[0], 2] += eps
        rate = (loss(net._replace(table=table)) - loss(net)) / eps
        assert step[at == at[0]].sum(axis=0)[2] == pytest.approx(rate, rel=1e-2, abs=1e-4)
        assert constant == pytest.approx((loss(net._replace(constant=net.constant + eps)) - loss(net)) / eps, rel=1e-2)
    finally:
        toxicity.pooled = original


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 1.0, 2.0, 0.0]), np.array([1, 0, 1, 0])) == 1.5
    assert toxicity.best_cut(np.array([1.0, 1.0, 0.0]), np.array([1, 0, 0])) == 0.5


def planted(spark, n=600):
    """Invented words; a toxic text has one of a few words somewhere, by language."""
    rng = np.random.default_rng(6)
    vocabulary = [f"w{k}" for k in range(3000)]
    bad = {"en": ["vileword", "nasty"], "fr": ["méchantmot"]}
    docs, labels = [], []
    for k in range(n):
        lang = "en" if k % 2 else "fr"
        words = list(rng.choice(vocabulary, rng.integers(3, 200)))
        toxic = int(k % 3 == 0)
        if toxic:
            words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad[lang])) + ",")
        docs.append((k, " ".join(words), lang))
        labels.append((k, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(
        labels, "doc_id long, toxic int"
    )


def test_held_out_accuracy(spark):
    docs, labels = planted(spark)
    found = toxicity.toxicity_scores(docs, labels, learn=id_crc("doc_id") % 4 != 2)
    judged = found.join(labels, "doc_id").filter(id_crc("doc_id") % 4 == 2)
    row = judged.agg(
        F.avg((F.col("predicted") == labels["toxic"]).cast("int")).alias("right"),
        F.avg((found["toxic"] == labels["toxic"]).cast("int")).alias("by_language"), F.count("*").alias("n"),
    ).first()
    assert row.n > 100 and row.right >= 0.97 and row.by_language >= 0.97
    assert found.filter("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.3 AS INT)").isEmpty()
    again = toxicity.toxicity_scores(docs.repartition(3), labels, learn=id_crc("doc_id") % 4 != 2)
    assert found.select("doc_id", "score").exceptAll(again.select("doc_id", "score")).isEmpty()
    # the language is no input of the score
    other = toxicity.scored(docs.withColumn("lang", F.lit("xx")), toxicity.fit(docs, labels, id_crc("doc_id") % 4 != 2))
    assert other.select("row.doc_id", "score").exceptAll(found.select("doc_id", "score")).isEmpty()


def test_learns_from_every_labelled_document(spark):
    """More of each label than 2,048, each toxic one by words of its own, which only it can teach."""
    own = [md5(str(k).encode()).hexdigest() for k in range(6000)]
    docs = spark.createDataFrame(
        [(k, f"plain {own[k][:12]} {own[k][12:24]} text" if k % 2 else f"plain text {k % 40}") for k in range(6000)],
        "doc_id long, text string",
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    found = toxicity.toxicity_scores(docs, labels, learn=F.lit(True)).join(labels.withColumnRenamed("toxic", "label"), "doc_id")
    caught, left = found.agg(F.avg(F.when(F.col("label") == 1, F.col("predicted"))),
                             F.avg(F.when(F.col("label") == 0, 1 - F.col("predicted")))).first()
    # a fifth is kept back; a sample of 2,048 has taught 0.55 of them at most
    assert caught >= 0.7 and left >= 0.95


def test_learns_from_long_documents(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(500)]
    long = [" ".join([*rng.choice(vocabulary, 20_000), "vileword"]) for _ in range(4)]
    short = [" ".join(rng.choice(vocabulary, 300)) for _ in range(30)]
    docs = spark.createDataFrame([*enumerate([*long, *short, "a word here"])], "doc_id long, text string")
    labels = docs.filter("doc_id < 34").select("doc_id", (F.col("doc_id") < 4).cast("int").alias("toxic"))
    found = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, labels, learn=F.lit(True)).orderBy("doc_id").collect()}
    assert [k for k in found if found[k]] == [0, 1, 2, 3]


def test_shards_and_rounds(spark, monkeypatch):
    """Many shards find the same, however the rows lie."""
    monkeypatch.setattr(toxicity, "SHARD", 60)
    docs, labels = planted(spark)
    learn = id_crc("doc_id") % 4 != 2
    found = toxicity.toxicity_scores(docs, labels, learn).select("doc_id", "score", "predicted").cache()
    judged = found.join(labels, "doc_id").filter(~learn)
    assert judged.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0] >= 0.95
    again = toxicity.toxicity_scores(docs.repartition(3), labels, learn).select("doc_id", "score", "predicted")
    assert found.exceptAll(again).isEmpty()


def test_best_cut_of_counts():
    value, toxic, documents = np.array([3.0, 2.0, 1.0]), np.array([2, 1, 0]), np.array([2, 2, 3])
    plain = toxicity.best_cut(np.repeat(value, documents), np.array([1, 1, 1, 0, 0, 0, 0]))
    assert toxicity.best_cut(value, toxic, documents) == plain == 1.5


def test_given_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.filter("doc_id IS NOT NULL")
    found = toxicity.toxicity_scores(docs, labels, learn=id_crc("doc_id") % 4 != 2).drop("toxic")
    judged = found.join(labels, "doc_id").filter(id_crc("doc_id") % 4 == 2)
    caught, left = judged.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, 1 - F.col("predicted")))
    ).first()
    assert caught >= 0.75 and left >= 0.97


def test_odd_documents_and_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1, "x"), (1, 0, "x"), (2, 1, "x"), (6, 0, "x"), (7, 0, "x"), (None, 1, "x"), (9, None, "x"), (10, 5, "x"), (77, 1, "x")],
        "doc_id long, toxic int, text string",
    )
    found = toxicity.toxicity_scores(odd_documents(spark), labels, learn=F.lit(True)).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    blank = {r.score for r in found if r.doc_id in (3, 4, 5)}
    assert len(blank) == 1
    for none in (labels.limit(0), labels.filter("doc_id = 7")):
        unlabelled = toxicity.toxicity_scores(odd_documents(spark), none, learn=F.lit(True)).collect()
        assert {(r.score, r.predicted) for r in unlabelled} == {(0.0, 0)}
    assert toxicity.toxicity_scores(no_documents(spark), labels, learn=F.lit(True)).collect() == []
    without = odd_documents(spark).drop("lang")
    assert toxicity.toxicity_scores(without, labels, learn=F.lit(True)).count() == len(ODD)
