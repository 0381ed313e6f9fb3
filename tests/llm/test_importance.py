import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casametra.llm import importance
from casametra.llm.common import Stage
from tests.llm.cases import ODD, no_documents, odd_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_buckets(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % importance.BUCKETS for g in grams]


def plain_resampling(docs, target, percent, min_words):
    """Rows of (doc_id, n_features, weight, score, rank) by the definition, in no order."""
    counted = []
    for texts in ([t for _, t in docs], target):
        n = [0] * importance.BUCKETS
        for text in texts:
            for bucket in plain_buckets(text)[1]:
                n[bucket] += 1
        counted.append(n)
    s, t = counted
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000))))
        for b in range(importance.BUCKETS)
    ]
    rows = []
    for doc_id, text in docs:
        n_words, buckets = plain_buckets(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(buckets), weight, weight + noise, None, n_words])
    eligible = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(eligible[: len(eligible) * percent // 100], start=1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def found(docs, target, **settings):
    rows = importance.resample(docs, target, **settings).select("doc_id", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in rows.collect()), key=str)


TEXTS = ["The First, text é Ünï x", "", None, "a", "a b", "  9 7 b-a the the the the the", "Z" * 300 + " q " * 5, "日本 語 a\x00b"]


def test_buckets_of_whole_and_sliced_arrays():
    for texts in (pa.array(TEXTS), pa.array(["ABé x " * 50] * 3000 + TEXTS).slice(3000), pa.array(TEXTS, pa.large_string())):
        got = importance.features(texts)
        for row, text in enumerate(TEXTS):
            n_words, expected = plain_buckets(text)
            ours = np.concatenate([b[o == row] for b, o in zip(got.buckets, got.owners)])
            assert ours.tolist() == expected and got.words[row] == n_words


def test_moved_checksums():
    rng = np.random.default_rng(5)
    for length in (0, 1, 7, 255, 256, 5000):
        head, tail = rng.bytes(11), rng.bytes(length)
        crc = importance.moved(np.array([zlib.crc32(head)], np.uint32), np.array([length])) ^ np.uint32(zlib.crc32(tail))
        assert crc[0] == zlib.crc32(head + tail)


def test_resampling_against_plain_python(spark):
    rng = np.random.default_rng(8)
    docs = [(int(k), " ".join(rng.choice(list("abcdefgh"), rng.integers(0, 60)))) for k in rng.permutation(400)]
    docs += docs[:40]  # repeated rows tie in everything
    target = ["a b c a b c a b c", "c b a"]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, least in ((5, 20), (50, 1), (100, 0), (1, 59)):
        assert found(df, goal, share=percent / 100, min_words=least) == plain_resampling(docs, target, percent, least)


def test_ranges_of_equal_scores(spark):
    """A third of the rows has one score, over several ranges or not."""
    rows = [(k, 5 if k % 3 else k) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, score long").repartition(5)
    ranked = importance.ranked(df, Stage(spark, "ranks")).orderBy("rank").collect()
    assert [(r.doc_id, r.score) for r in ranked] == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r["rank"] for r in ranked] == list(range(1, 3001))


def test_odd_tables(spark):
    benchmark = spark.createDataFrame([("the first text", 1.0), (None, None)], "text string, score double")
    docs = [(r[0], r[1]) for r in ODD]
    assert found(odd_documents(spark), benchmark, share=0.5, min_words=1) == plain_resampling(
        docs, ["the first text", None], 50, 1
    )
    assert found(odd_documents(spark), benchmark.limit(0), share=0.05) == plain_resampling(docs, [], 5, 20)
    assert importance.resample(no_documents(spark), benchmark).collect() == []


def test_only_a_few_rows_are_ordered(spark):
    """The level that bounds the candidates leaves out what can't be drawn."""
    scored = spark.range(100_000).withColumn("score", F.col("id") - 50_000)
    level = importance.lowest_level(scored, 5000)
    kept = scored.filter(importance._level(F.col("score")) >= level).count()
    assert 5000 <= kept <= 6500
