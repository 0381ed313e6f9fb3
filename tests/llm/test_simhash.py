import hashlib
import random

from pyspark.sql import functions as F

from casametra.llm import simhash
from tests.llm.cases import ODD, no_documents, odd_documents


def bits_of(f1, f2):
    return (f1 & (2**64 - 1)) << 64 | (f2 & (2**64 - 1))


def test_votes_against_plain_counting(spark):
    texts = ["a bb ccc a bb", "one", "", "to be or not to be that is"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    found = {r.k: (r.f1, r.f2) for r in simhash.voted(rows, ["k"], "t").collect()}
    for k, text in enumerate(texts):
        words = text.split()
        terms = list(zip(words, [*words[1:], None]))
        pairs = spark.createDataFrame(terms or [(None, None)], "w string, v string")
        hashed = pairs.select(
            (F.coalesce(F.length("w"), F.lit(0)) + F.coalesce(F.length("v"), F.lit(0))).alias("n"),
            F.xxhash64(F.lit(11), "w", "v").alias("a"), F.xxhash64(F.lit(23), "w", "v").alias("b"),
        ).collect()
        weights = [min(r.n, simhash.HEAVIEST) for r in hashed]
        for half, column in enumerate("ab"):
            expected = 0
            for bit in range(64):
                votes = sum(w for r, w in zip(hashed, weights) if (r[column] >> bit) & 1)
                expected |= (2 * votes > sum(weights)) << bit
            assert found[k][half] & (2**64 - 1) == expected
    assert found[2] == (0, 0)


def edited(texts):
    """texts in descending id order."""
    out = []
    for k, text in enumerate(texts):
        half = len(text) // 2
        out.append(text[: len(text) - half] + texts[(k + 1) % len(texts)][:half])
    return out


def test_odd_documents(spark):
    found = simhash.edited_fingerprints(odd_documents(spark)).collect()
    assert len(found) == len(ODD)
    distinct = {(r[0], r[1] or "") for r in ODD if r[0] is not None}
    order = sorted(distinct, reverse=True)
    texts = [t for _, t in order]
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for (doc_id, text), new in list(zip(order, edited(texts)))[:-1]:  # ids without one follow the last
        r = by_id[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and len(r.fingerprint) == 32
    assert by_id[1].fingerprint == by_id[2].fingerprint and by_id[3].fingerprint == "0" * 32 == by_id[4].fingerprint
    assert by_id[8].near_next > 0.9 and by_id[2].near_next == 1.0
    assert simhash.edited_fingerprints(no_documents(spark)).collect() == []
    plain = {r.doc_id: r.fingerprint for r in simhash.fingerprints(odd_documents(spark)).collect() if r.doc_id is not None}
    assert plain == {k: r.fingerprint for k, r in by_id.items()}


def test_one_document_follows_itself(spark):
    (row,) = simhash.edited_fingerprints(odd_documents(spark, [(5, "abcd efgh", "en", "a")])).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest()


def test_order_across_ranges(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(rng.randrange(12))), "en", "a") for k in rng.sample(range(10**6), 90)]
    found = {r.doc_id: r.edited_sha256 for r in simhash.edited_fingerprints(odd_documents(spark, rows).repartition(6)).collect()}
    order = sorted(rows, reverse=True)
    for row, new in zip(order, edited([r[1] for r in order])):
        assert found[row[0]] == hashlib.sha256(new.encode()).hexdigest()


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(128) for _ in range(60)]
    for v in values[:30]:
        for flips in range(1, 6):
            near = v
            for bit in rng.sample(range(128), flips):
                near ^= 1 << bit
            values.append(near)

    def signed(x):
        return x - (1 << 64) if x >= 1 << 63 else x

    rows = [(signed(v >> 64), signed(v & (2**64 - 1))) for v in values]
    prints = spark.createDataFrame(rows + rows[:5], "f1 long, f2 long")
    for radius in (0, 3):
        found = simhash.within_radius(prints.limit(20), prints, radius).collect()
        got = {(bits_of(r.q1, r.q2), bits_of(r.f1, r.f2)): r.distance for r in found}
        expected = {
            (a, b): (a ^ b).bit_count() for a in values[:20] for b in values if (a ^ b).bit_count() <= radius
        }
        assert got == expected and len(found) == len(got)


def test_plan_is_native(spark):
    plan = simhash.edited_fingerprints(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
