import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from casametra.llm import neighbours

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def brute_force(ids, vectors, queries, k):
    out = {}
    for q in queries:
        i = ids.index(q)
        order = sorted((math.dist(vectors[i], v), other) for other, v in zip(ids, vectors) if other != q)
        out[q] = order[:k]
    return out


def shown(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        found = out.setdefault(r.query_id, [])
        assert r["rank"] == len(found) + 1
        found.append((r.score, r.vec_id))
    return out


def test_recall_on_given_embeddings(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = shown(neighbours.nearest(table, F.col("vec_id") % 10 == 0))
    rows = table.orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], [tuple(map(float, r.embedding)) for r in rows]
    expected = brute_force(ids, vectors, [i for i in ids if i % 10 == 0], 10)
    assert set(found) == set(expected)
    hits = sum(len({i for _, i in found[q]} & {i for _, i in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(len(x) for x in expected.values())
    of = dict(zip(ids, vectors))
    for q, near in found.items():
        assert near == sorted(near) and all(s == pytest.approx(math.dist(of[q], of[i]), abs=1e-12) for s, i in near)


def test_ties_copies_and_unusable_vectors(spark):
    nan = float("nan")
    base = [float(k % 7 - 3) for k in range(16)]
    rows = [(k, base, 0, 0.0, 0) for k in range(40)]  # one vector that many rows have
    rows += [(100 + k, [x + (k // 2 + 1) for x in base], 0, 0.0, 0) for k in range(30)]
    rows += [(200, None, 0, 0.0, 0), (300, [0.0] * 16, 0, 0.0, 0), (400, [nan] + base[1:], 0, 0.0, 0),
             (500, [None] + base[1:], 0, 0.0, 0), (600, [float("inf")] + base[1:], 0, 0.0, 0),
             (700, base[:3], 0, 0.0, 0), (None, base, 0, 0.0, 0), rows[0]]
    found = shown(neighbours.nearest(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 100 == 0))
    usable = {r[0]: r[1] for r in rows if r[0] is not None and (r[0] < 200)}
    expected = brute_force(list(usable), list(usable.values()), [0, 100], 10)
    assert set(found) == {0, 100}
    for q in found:
        assert [i for _, i in found[q]] == [i for _, i in expected[q]]
        assert [s for s, _ in found[q]] == pytest.approx([s for s, _ in expected[q]])


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, 0.0, 0), (5, [0.0, 1.0], 0, 0.0, 0), (6, [1.0, 1.0], 0, 0.0, 0)], SCHEMA)
    assert shown(neighbours.nearest(few, F.col("vec_id") % 100 == 0)) == {0: [(1.0, 6), (pytest.approx(math.sqrt(2)), 5)]}
    one = few.filter("vec_id = 0")
    assert shown(neighbours.nearest(one, F.col("vec_id") % 100 == 0)) == {}
    none = few.limit(0)
    out = neighbours.nearest(none, F.col("vec_id") % 100 == 0)
    assert out.collect() == [] and out.columns == ["query_id", "rank", "vec_id", "score"]


def test_every_code_within_the_radius_is_met_once(spark):
    """The index with its probing against all pairs of codes, whatever the parts."""
    rng = np.random.default_rng(6)
    code = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    code[75:] = code[:75] ^ (np.uint64(1) << rng.integers(0, 60, 75).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 60, 75).astype(np.uint64))
    vectors = rng.standard_normal((150, 4))
    rows = [(k, vectors[k].tolist(), int(code[k].astype(np.int64))) for k in range(150)]
    table = spark.createDataFrame(rows, "vid long, vec array<double>, code long")
    for lead in (0, 3):
        met = neighbours.search(table, table.filter("vid % 3 = 0"), 9, 150, lead).collect()
        pairs = [(r.qid, r.vid) for r in met]
        expected = {(q, v) for q in range(0, 150, 3) for v in range(150) if int(np.bitwise_count(code[q] ^ code[v])) <= 9}
        assert len(pairs) == len(set(pairs)) and set(pairs) == expected
