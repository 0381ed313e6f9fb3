import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from casametra.llm import substrings, words
from tests.llm.cases import ODD, no_documents, odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é \n\t\x1c ", max_size=40)), max_size=8))
@settings(max_examples=80, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    found = words.words_of(pa.array(texts, pa.string()))
    expected = [(k, w) for k, t in enumerate(texts) for w in WORD.findall(t or "")]
    shown = [(int(k), found.data[s:e].tobytes().decode()) for k, s, e in zip(found.text, found.start, found.end)]
    assert shown == expected
    by_hash = {}
    for h, (_, w) in zip(found.hash, expected):
        assert by_hash.setdefault(int(h), w) == w


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    text = pa.array([" ".join("x" * (k % 50 + 1) for k in range(400))])
    whole = words.words_of(text).hash
    monkeypatch.setattr(words, "PIECE_BYTES", 64)
    words._powers.cache_clear()
    assert (words.words_of(text).hash == whole).all()
    words._powers.cache_clear()


def brute_force(rows):
    first = {}
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        for k in range(len(w) - 12):
            if doc_id is not None:
                key = tuple(w[k : k + 13])
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        keep = [True] * len(w)
        for k in range(len(w) - 12):
            if doc_id is not None and first[tuple(w[k : k + 13])] < doc_id:
                keep[k : k + 13] = [False] * 13
        out.append((doc_id, len(w), len(w) - sum(keep), " ".join(x for x, y in zip(w, keep) if y)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def planted(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(n)] for n in (13, 20, 60)]
    rows = []
    for i in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 80))]
        for p in passages:
            if rng.random() < 0.4:
                at = rng.randrange(len(w) + 1)
                w[at:at] = p
        rows.append((i, " \n".join(w), "en", "s"))
    rows += [(100 + k, rows[3][1], "en", "s") for k in range(20)]
    return rows


def test_odd_documents_against_brute_force(spark):
    assert found(substrings.remove_repeated(odd_documents(spark))) == brute_force(ODD)
    assert substrings.remove_repeated(no_documents(spark)).collect() == []


def test_planted_passages_against_brute_force(spark, monkeypatch):
    rows = planted()
    docs = odd_documents(spark, rows).repartition(5)
    assert found(substrings.remove_repeated(docs)) == brute_force(rows)


def test_documents_keep_their_columns_and_layout(spark):
    rows = planted()
    docs = odd_documents(spark, rows)
    out = {r.doc_id: r for r in substrings.documents_without_repeats(docs).collect()}
    expected = {r[0]: r for r in brute_force(rows)}
    assert substrings.documents_without_repeats(docs).columns == docs.columns
    for doc_id, text, *_ in rows:
        _, _, removed, kept = expected[doc_id]
        assert out[doc_id].text == (kept if removed else text)
        assert out[doc_id].n_chars == len(out[doc_id].text) and out[doc_id].size == 7


def test_sketch_never_counts_too_low(spark):
    rows = planted()
    docs = odd_documents(spark, rows).repartition(4)
    merged = {r.segment: r.bits for r in substrings.merged_sketch(substrings.partial_sketches(docs)).collect() if r.segment >= 0}
    table = pa.table({"text": [r[1] for r in rows]})
    w = words.words_of(table.column("text").combine_chunks())
    hashes, _ = words.text_windows(w, len(rows), 13)
    values, counts = np.unique(hashes, return_counts=True)
    for h in values[counts > 1]:
        cell = int(h) >> (64 - substrings.CELL_BITS)
        segment, low = cell >> substrings.SEGMENT_BITS, cell & 0xFFFF
        assert merged[segment][low >> 3] >> (7 - (low & 7)) & 1
