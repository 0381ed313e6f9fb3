import zlib

import numpy as np
from pyspark.sql import functions as F
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casametra.llm import length_histogram, packing, tokens
from tests.llm.cases import LONG, ODD, no_documents, odd_documents

SF = "/root/testdata/sf0.001"


def held(configs):
    out = {}
    for config, copies in configs:
        for length, n in config:
            out[length] = out.get(length, 0) + n * copies
    return out


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
@settings(max_examples=40, deadline=None)
def test_plan_holds_every_piece_once(counts):
    configs = packing.plan(counts, 64)
    assert held(configs) == counts
    assert all(sum(length * n for length, n in c) <= 64 and k > 0 for c, k in configs)
    runs = packing.places(configs)
    assert len(runs) == sum(len(c) for c, _ in configs)


@pytest.mark.parametrize("n", [500, 20_000])
def test_plan_is_close_to_the_bound(n):
    lengths = np.random.default_rng(n).integers(1, 1025, n)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    used = sum(k for _, k in packing.plan(counts, 1024))
    bound = max(-(-int(lengths.sum()) // 1024), int((lengths > 512).sum()))
    assert used <= 1.01 * bound + 5


def test_encoder_equals_the_tokenizer_of_the_file():
    from tokenizers import Tokenizer

    path = tokens.default_vocabulary()
    other = Tokenizer.from_file(path)
    odd = ["a" * 5000, "x  \n\n  y", "hi<|endoftext|>there", "été à 12 345!!", "日本語 text", "  ", LONG[:9000], "don't I'll"]
    for text in odd:
        assert tokens.encode(path, text).tolist() == other.encode(text, add_special_tokens=False).ids


def test_runs_of_blanks_are_cut_as_the_pattern_does():
    from tokenizers import Tokenizer

    path = tokens.default_vocabulary()
    other = Tokenizer.from_file(path)
    rng = np.random.default_rng(1)
    signs = [*"ab '\n\t \u3000\x85\x1c \xe91!s\u2028\u200b", "  ", "<|endoftext|>", "'s", "\n\n"]
    for _ in range(1500):
        text = "".join(rng.choice(signs, rng.integers(0, 30)))
        assert tokens.encode(path, text).tolist() == other.encode(text, add_special_tokens=False).ids
    n = 300_000
    for text in (" " * n, "\n" * n, "\t" * n + "x", "a" * n, ("a  b\n\n" + " " * 50) * (n // 55)):
        assert tokens.encode(path, text).tolist() == other.encode(text, add_special_tokens=False).ids


def test_texts_of_millions_of_blanks_are_packed_and_counted(spark):
    n = 5_000_000
    texts = [" " * n, "\n" * n + "end", "a" * n, "x \t " * (n // 5), "a few words"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    path = tokens.default_vocabulary()
    sizes = [len(tokens.encode(path, t)) for t in texts]
    packed = packing.pack(docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {k: size + 1 for k, size in enumerate(sizes)}
    counted = length_histogram.token_counts(docs).collect()
    assert {r.n_tokens: r.n_docs for r in counted} == {size: sizes.count(size) for size in sizes}


def check_packed(rows, texts, capacity):
    path = tokens.default_vocabulary()
    expected = sorted(tuple(np.append(tokens.encode(path, t), [2]).tolist()) for t in texts)
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for found in by_sequence.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == [0, *np.cumsum([r.length for r in found])[:-1].tolist()]
        assert sum(r.length for r in found) <= capacity
    assert sum(r.length for r in rows) == sum(map(len, expected))
    assert sorted(len(x) for x in expected if len(x) <= capacity) == sorted(
        r.length for r in rows if r.piece == 0 and len(by_doc.get((r.doc_id, 1), [])) == 0
    )
    return len(by_sequence)


def test_odd_documents_are_packed(spark):
    rows = packing.pack(odd_documents(spark), capacity=1024, keep_ids=True).collect()
    check_packed(rows, [r[1] for r in ODD], 1024)
    later = [r for r in rows if r.piece > 0]
    assert later and all(r.length == 1024 for r in later)
    assert {r.piece for r in rows if r.doc_id == 7} == set(range(max(r.piece for r in rows if r.doc_id == 7) + 1))
    whole = packing.sequences(packing.pack(odd_documents(spark), keep_ids=True)).collect()
    assert all(len(r.ids) == r.length <= 1024 for r in whole)
    assert packing.pack(no_documents(spark)).collect() == []


def test_pieces_of_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack(docs, keep_ids=True).collect()
    used = check_packed(rows, [r.text for r in docs.select("text").collect()], 1024)
    assert used <= 1.02 * sum(r.length for r in rows) / 1024 + 2


def test_length_histogram_against_plain_counts(spark):
    path = tokens.default_vocabulary()
    lengths = np.array([len(tokens.encode(path, r[1])) for r in ODD])
    sums = length_histogram.token_counts(odd_documents(spark))
    rows = {r.n_tokens: r for r in sums.collect()}
    assert sorted(rows) == sorted(set(lengths.tolist()))
    for n, r in rows.items():
        assert (r.n_docs, r.docs_upto, r.docs_beyond) == ((lengths == n).sum(), (lengths <= n).sum(), (lengths > n).sum())
        assert (r.tokens_upto, r.truncated_tokens) == (lengths[lengths <= n].sum(), np.minimum(lengths, n).sum())
        assert (r.total_docs, r.total_tokens) == (len(lengths), lengths.sum())
    for limit in (0, 1, 10, 5000, 10**7):
        row = length_histogram.truncated_total(sums, limit).first()
        assert (row.kept_tokens, row.cut_docs) == (np.minimum(lengths, limit).sum(), (lengths > limit).sum())
    for share in (0.0, 0.3, 0.5, 0.99, 1.0):
        found = length_histogram.length_quantile(sums, share).first().length
        assert found == min(n for n in lengths if (lengths <= n).sum() >= share * len(lengths))
    assert length_histogram.token_counts(no_documents(spark)).collect() == []
    assert tuple(length_histogram.truncated_total(length_histogram.token_counts(no_documents(spark)), 5).first()) == (0, 0)
