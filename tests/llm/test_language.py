import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casametra.llm import language
from casametra.llm.common import id_crc
from tests.llm.cases import ODD, no_documents, odd_documents

SF = "/root/testdata/sf0.001"


def known_pieces():
    import base64

    with open(language.default_vocabulary(), "rb") as file:
        listed = {base64.b64decode(line.split()[0]) for line in file if line.strip()}
    return sorted(listed | {bytes([b]) for b in range(256)})


def plain_log(word, number, p):
    """Log of the sum over all segmentations, by sums of logarithms."""
    longest = max(map(len, number))
    logs = [0.0]
    for end in range(1, len(word) + 1):
        parts = [
            logs[start] + math.log(p[number[word[start:end]]])
            for start in range(max(0, end - longest), end) if word[start:end] in number
        ]
        top = max(parts)
        logs.append(top + math.log(sum(math.exp(x - top) for x in parts)))
    return logs[-1]


#: Words of scripts that no language here has, one of them without a blank for long.
SCRIPTS = [
    "ᏣᎳᎩᎦᏬᏂᎯᏍᏗ" * 3, "བོད་སྐད་ཡིག་གི་སློབ་ཚན", "ភាសាខ្មែរជាភាសាផ្លូវការ", "မြန်မာဘာသာစကား", "ქართულიენა", "አማርኛቋንቋ",
    "ภาษาไทยเป็นภาษาราชการ" * 9, "日本語の文章" * 40, "한국어문장", "עבריתשפה", "ελληνικάγλώσσα", "русскийязык" * 30,
]


def test_forward_sums_all_segmentations(monkeypatch):
    table = language.pieces(language.default_vocabulary())
    known = known_pieces()
    assert len(known) == len(table.lengths) and table.longest > 8
    number = {piece: k for k, piece in enumerate(known)}
    rng = np.random.default_rng(1)
    p = np.full((len(known), 2), 1e-12)
    p[rng.integers(0, len(known), 9000), 0] = rng.random(9000) / 1000
    p[[number[b" the"], number[b" "], number[b"t"]], 1] = 0.1
    weights = language.scaled(p, table.lengths)
    texts = ["the window", "Über", "zz9", "thethethe international", "=" * 300, " ".join(SCRIPTS),
             *("".join(map(chr, rng.integers(33, 700, 90))) for _ in range(30))]
    words = language.spelled(pa.array(texts))
    for block in (language.BLOCK, 1):
        monkeypatch.setattr(language, "BLOCK", block)
        scores = language.word_scores(table, words, weights)
        assert np.isfinite(scores).all()
        for k in range(len(words.start)):
            word = b" " + words.data[words.start[k] : words.end[k]].tobytes()
            for lang in (0, 1):
                assert scores[k, lang] == pytest.approx(plain_log(word, number, p[:, lang]), rel=1e-9, abs=1e-9)


def test_expected_counts_against_single_segmentations(spark):
    known = known_pieces()
    number = {piece: k for k, piece in enumerate(known)}
    rng = np.random.default_rng(2)
    p = rng.dirichlet(np.ones(len(known)), 2).T
    words = [("x", "the", 3), ("x", "över", 2), ("y", "the", 5), ("y", "international", 1)]
    df = spark.createDataFrame([(lang, w.encode(), n) for lang, w, n in words], "lang string, word binary, n long")
    table = language.pieces(language.default_vocabulary())
    found = language.expected_counts(df, language.default_vocabulary(), ["x", "y"], language.scaled(p, table.lengths))

    def spellings(text):
        if not text:
            yield []
        for k in range(1, len(text) + 1):
            if text[:k] in number:
                for rest in spellings(text[k:]):
                    yield [number[text[:k]], *rest]

    expected = np.zeros_like(found)
    for lang, word, n in words:
        k = "xy".index(lang)
        ways = list(spellings(b" " + word.encode()))
        weight = [math.prod(p[i, k] for i in way) for way in ways]
        for way, w in zip(ways, weight):
            for i in way:
                expected[i, k] += n * w / sum(weight)
    assert found == pytest.approx(expected, abs=1e-9)


def test_unlearned_scripts_random_bytes_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    odd = [*SCRIPTS, *("".join(map(chr, rng.integers(0x100, 0xD000, 200))) for _ in range(5)), "字" * 20_000]
    docs = [(k, f"the house and the garden number {k}", "en") for k in range(30)]
    docs += [(100 + k, f"das haus und der garten nummer {k}", "de") for k in range(30)]
    docs += [(1000 + k, text, None) for k, text in enumerate(odd)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    for name in ("hash", "nth", "_hash", "_cut", "count"):
        df = df.withColumn(name, F.lit(1))
    found = language.identify_languages(df, learn=F.lit(True)).collect()
    assert len(found) == len(docs)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de") for r in found)
    assert all(r.lang_pred == ("en" if r.doc_id < 100 else "de") for r in found if r.doc_id < 1000)


def test_every_single_byte_is_a_piece():
    table = language.pieces(language.default_vocabulary())
    h = np.array([language._hash_bytes(bytes([b])) for b in range(256)], dtype=np.uint64)
    assert (language.find_pieces(table, h) < len(table.lengths)).all()
    assert (language.find_pieces(table, h + np.uint64(12345)) == len(table.lengths)).mean() > 0.9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held_out = id_crc("doc_id") % 5 == 0
    found = language.identify_languages(docs, learn=~held_out).join(docs.select("doc_id", "lang"), "doc_id")
    row = found.filter(id_crc("doc_id") % 5 == 0).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert row[0] >= 0.95
    assert found.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()


def test_odd_documents(spark):
    found = language.identify_languages(odd_documents(spark), learn=F.lit(True)).collect()
    assert len(found) == len(ODD)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (3, 4, 5, 10)] == [("und", 0.0)] * 4
    assert {by_id[i].lang_pred for i in (1, 6, 7, 9)} <= {"en", "fr", "de"}
    assert all(0 <= r.score <= 1 for r in found)
    untaught = language.identify_languages(odd_documents(spark), learn=F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert language.identify_languages(no_documents(spark), learn=F.lit(True)).collect() == []
