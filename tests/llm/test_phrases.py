import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casametra.llm import phrases
from tests.llm.cases import LONG, ODD, no_documents, odd_documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain_collocations(docs, least, percent=80, first=2000):
    """Rows by the definition, over (text, lang) pairs."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            f.update((lang, words[i : i + m]) for m in range(1, 5) for i in range(len(words) - m + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    rows = []
    for (lang, w), a in candidates.items():
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [
            b for (other, v), b in candidates.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
        ]
        if not any(100 * b >= percent * a for b in longer):
            rows.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    out = []
    for lang in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, rank, *r[1:]) for rank, r in enumerate(mine[:first], start=1)]
    return sorted(out)


def found(docs, **settings):
    return sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(docs, **settings).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(5)


def random_documents(n, seed):
    rng = np.random.default_rng(seed)
    signs = ["", "", "", "", ".", ",", "\n", "\t", " ", "!"]
    words = ["The", "of", "a", "état", "New", "york", "city", "x"]
    return [
        (
            " ".join(f"{rng.choice(words, p=[.3, .2, .1, .1, .1, .1, .05, .05])}{rng.choice(signs)}" for _ in range(rng.integers(0, 40)))
            + (" new york city hall" if k % 3 == 0 else ""),
            [None, "en", "und", "fr"][k % 4],
        )
        for k in range(n)
    ]


def test_collocations_against_plain_python(spark):
    docs = random_documents(300, 3)
    for least, percent, first in ((30, 80, 2000), (1, 80, 2000), (5, 50, 7)):
        assert found(table(spark, docs), least=least, subsumed_percent=percent, first=first) == plain_collocations(
            docs, least, percent, first
        )


def known_as(bits, hot=()):
    return phrases.Known(np.full(1 << (phrases.FILTER_BITS - 6), bits, np.int64), np.sort(np.array(hot, np.uint64)))


def test_maps_and_parts_change_no_count(spark):
    """A map that lets everything pass, one that lets nothing pass, and hot prefixes in parts."""
    docs = random_documents(200, 4)
    counted = Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            counted.update((lang or "und", " ".join(words[i : i + 3])) for i in range(len(words) - 2))
    expected = sorted((*key, n) for key, n in counted.items() if n >= 2)
    hot = phrases.phrase_hashes(pa.array(["the of", "of the"]), pa.array(["en", "fr"]), 2)
    for known in (known_as(-1), known_as(-1, hot)):
        assert sorted(map(tuple, phrases.merged_stripes(table(spark, docs), 3, known, 2).collect())) == expected
    assert phrases.merged_stripes(table(spark, docs), 3, known_as(0), 2).isEmpty()


def test_hot_stripes_are_cut_into_parts():
    texts, langs = pa.array(["the a the b the c the d the e of f"] * 3), pa.array(["en"] * 3)
    seen = phrases.tokens(texts, langs)
    hot = phrases.phrase_hashes(pa.array(["the"]), pa.array(["en"]), 1)
    rows = phrases.stripes_of(seen, 2, known_as(-1, hot)).to_pylist()
    assert len([r for r in rows if r["prefix"] == "the"]) > 1
    assert [r["part"] for r in rows if r["prefix"] == "of"] == [0]
    counted = {(r["prefix"], w): n for r in rows for w, n in zip(r["words"].split(" "), map(int, r["counts"].split(" ")))}
    assert counted["the", "a"] == 3 and counted["of", "f"] == 3 and sum(counted.values()) == 33


def test_hashes_of_phrases_equal_those_of_occurrences():
    texts, langs = pa.array(["x Été new york, city", None, "b c"]), pa.array(["fr", "en", None])
    seen = phrases.tokens(texts, langs)
    assert [seen.words[int(t)].as_py() for t in seen.token] == ["x", "Été", "new", "york", "city", "b", "c"]
    assert len(set(seen.piece.tolist())) == 3
    at_place = phrases.window_hashes(seen.hashes[seen.token], 2)
    assert at_place[2] == phrases.phrase_hashes(pa.array(["new york"]), pa.array(["fr"]), 2)[0]
    assert at_place[5] == phrases.phrase_hashes(pa.array(["b c"]), pa.array(["und"]), 2)[0]


def test_products_beyond_64_bits(spark):
    """Counts that no test table could hold, straight into the scores."""
    big = 9_000_000_000_000_000
    counts = [("en", "a", big), ("en", "b", big - 1), ("en", "a b", big - 2), ("en", "c", 7), ("en", "b c", 5), ("en", "a b c", 5)]
    scored = phrases.best_cuts(spark.createDataFrame(counts, "lang string, phrase string, n long"), 3 * big)
    rows = {r.phrase: (r.a, r.l, r.r, r.score) for r in scored.collect()}
    assert rows["a b"] == (big - 2, big, big - 1, 2_000_000 * (big - 2) // (2 * big - 1))
    # both cuts of "a b c" score 0, so the first counts
    assert rows["a b c"] == (5, big, 5, 0) and rows["b c"] == (5, big - 1, 7, 0)


def test_odd_tables(spark):
    docs = [(r[1], r[2]) for r in ODD]
    assert found(odd_documents(spark), least=2) == plain_collocations(docs, 2)
    assert phrases.collocations(no_documents(spark)).collect() == []
    # one long text in one group of rows
    texts = [(LONG + ".", "de")]
    assert found(table(spark, texts), least=30, first=50) == plain_collocations(texts, 30, first=50)
    clashing = odd_documents(spark).withColumns({"phrase": F.lit("x"), "n": F.lit(1)})
    assert found(clashing, least=2) == plain_collocations(docs, 2)
