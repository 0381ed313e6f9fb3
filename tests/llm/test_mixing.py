import random

import pytest

from casametra.llm import mixing
from tests.llm.cases import ODD, no_documents, odd_documents


def fill(sizes, weights, stop=3.0):
    """Shares by weight, stopped sources' excess shared again, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full = float(sum(sizes.values())), {}
    while True:
        rest = [s for s in order if s not in full]
        level = (budget - sum(full.values())) / sum(weight[s] for s in rest) if rest else 0
        above = [s for s in rest if weight[s] * level > stop * sizes[s]]
        if not above:
            return {s: full.get(s, weight[s] * level) for s in order}
        full |= {s: stop * sizes[s] for s in above}


def documents(seed, n=400):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", None, "tiny"]
    rows = []
    for k in range(n):
        source = rng.choices(sources, [50, 20, 10, 10, 5, 1])[0]
        rows.append((k, "w " * int(rng.lognormvariate(3, 1.2)), "en", source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_choice(spark, seed):
    rows = documents(seed)
    found = mixing.mix_sources(odd_documents(spark, rows).repartition(3)).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    targets = fill(sizes, (5, 2, 1))
    source_of = {r[0]: r[3] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        source = source_of[r.doc_id]
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source])
        assert r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(0.03 * target, 5), source
    again = mixing.mix_sources(odd_documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mixed_documents_are_repeated_as_taken(spark):
    rows = documents(3, 120)
    docs = odd_documents(spark, rows)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counted = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {k: v for k, v in copies.items() if v}


def test_odd_documents(spark):
    found = mixing.mix_sources(odd_documents(spark)).collect()
    assert len(found) == len(ODD)
    assert all(r.taken == 0 for r in found if r.size == 0)
    assert len({tuple(r) for r in found if r.doc_id == 1}) == 1
    assert mixing.mix_sources(no_documents(spark)).collect() == []
    nothing = odd_documents(spark, [(1, None, None, "a"), (2, " ", None, "b")])
    assert [(r.size, r.taken, r.target) for r in mixing.mix_sources(nothing).collect()] == [(0, 0, 0.0)] * 2
