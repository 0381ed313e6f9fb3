import random

import numpy as np
import pyarrow as pa
import pytest

from casametra.llm import minhash
from tests.llm.cases import ODD, no_documents, odd_documents


def components(sets, percent=80):
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    return {i: find(i) for i in ids}


def families(seed=2, n=12):
    """Groups of texts whose members differ by a few words, many near the limit."""
    rng = random.Random(seed)
    vocabulary = [f"q{k}" for k in range(3000)]
    rows, number = [], 0
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(rng.choice([1, 3, 14])):
            w = list(base)
            for _ in range(int(len(w) * rng.choice([0, 0.03, 0.06, 0.1]))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((number, " ".join(w).title() if number % 3 else " ".join(w), "en", "s"))
            number += 1
    return rows


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        n = int(rng.integers(5, 900))
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        common = int(2 * n * 0.8 / 1.8)
        a, b = pool[:n], np.r_[pool[:common], pool[n : 2 * n - common]]
        s = minhash.super_minhash(np.r_[a, b], np.r_[np.zeros(n, int), np.ones(len(b), int)], 2)
        errors.append((s[0] == s[1]).mean() - common / (2 * n - common))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def test_levels_equal_the_definition():
    """Against the element-by-element form, without early stopping."""
    slots, elements = 16, np.random.default_rng(3).integers(0, 1 << 63, 9, dtype=np.uint64)
    fast = minhash.super_minhash(elements, np.zeros(9, int), 1, slots)[0]
    golden = np.uint64(0x9E3779B97F4A7C15)
    slow = np.full(slots, np.inf)
    for e in elements:
        order = list(range(slots))
        for level in range(slots):
            with np.errstate(over="ignore"):
                seed = minhash.mix(np.array([e + golden * np.uint64(2 * level + 1)]))
                rank = level + minhash._uniform(minhash.mix(seed + golden))[0]
            pick = level + int(minhash._uniform(seed)[0] * (slots - level))
            order[level], order[pick] = order[pick], order[level]
            slow[order[level]] = min(slow[order[level]], rank)
    assert (fast == slow).all()


@pytest.mark.parametrize("size", [2, 5])
def test_families_against_all_pairs(spark, size):
    rows = families()
    found = minhash.near_duplicates(odd_documents(spark, rows).repartition(3), size).collect()
    sets = {r[0]: minhash.exact_set(r[1], size) for r in rows}
    assert {r.doc_id: r.component_id for r in found} == components(sets)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_cells_are_whole_however_small(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 3)
    monkeypatch.setattr(minhash, "PAIRS", 5)
    monkeypatch.setattr(minhash, "BIT_PAIRS", 4)
    rows = families(seed=9, n=8)
    found = minhash.near_duplicates(odd_documents(spark, rows), 2).collect()
    assert {r.doc_id: r.component_id for r in found} == components({r[0]: minhash.exact_set(r[1], 2) for r in rows})


def test_odd_documents(spark):
    found = minhash.near_duplicates(odd_documents(spark)).collect()
    assert len(found) == len(ODD)
    rows = {r.doc_id: r for r in found if r.doc_id is not None}
    assert rows[2].component_id == 1 and not rows[2].kept and rows[1].kept
    assert [(rows[i].n_shingles, rows[i].component_id, rows[i].kept) for i in (3, 4, 5)] == [(0, 3, True), (0, 4, True), (0, 5, True)]
    assert (rows[6].n_shingles, rows[6].component_id) == (1, 6)
    # its words hold no-break spaces, which do not part words
    assert rows[8].component_id == 7 and rows[11].n_shingles == 1
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    assert minhash.near_duplicates(no_documents(spark)).collect() == []


def test_representatives_keep_columns_and_one_row_a_group(spark):
    docs = odd_documents(spark)
    kept = minhash.representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 9, 10, 11]


def test_components_of_long_chains(spark):
    from casametra.llm.common import Stage

    chain = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (105, 101), (200, 200)]
    edges = spark.createDataFrame(chain, "a long, b long")
    roots = {r.node: r.root for r in minhash.components(edges, Stage(spark, "chain"), "c").collect()}
    assert roots == {k: 0 for k in range(61)} | {100: 100, 101: 100, 105: 100, 200: 200}


def test_short_texts_are_one_element():
    hashes, text, _ = minhash.shingle_sets(pa.array(["One two", "one", "ONE", None, "two one"]), 5)
    assert text.tolist() == [0, 1, 2, 4]
    assert hashes[1] == hashes[2] and len(set(hashes.tolist())) == 3
