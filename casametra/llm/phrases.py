"""Phrases whose words occur together far more often than apart, by stripes.

Each task gathers stripes: for a prefix of one to three words, an associative counter of the
words that follow it. Stripes of one prefix meet in one place and are merged elementwise.
What is wanted follows from that one structure: an entry is the count of a phrase one
word longer than its prefix, the count of a prefix is an entry of a shorter one, and the
greatest entry around a phrase says whether a longer phrase holds most of its occurrences.

The lengths are counted in turn. A phrase can only be frequent if both phrases one word
shorter inside it are, so a stripe of the next length takes an occurrence only if a
bit map of hashes lets both pass. The bit map has ``FILTER_BITS`` bits, whatever the input.
It never loses a frequent phrase; what it lets through in error is counted exactly
and dropped then. Words and phrases are compared as text, never by hash.

Prefixes that hold a thousandth of all occurrences or more, of which there are a thousand
at most, have their stripes cut into parts by the next word, and their joins
into as many.

Defined cases: a null or empty text has no word; a null lang is ``und``, the same as one
spelled so; repeated rows count as often as they occur; an empty table gives no rows; ids
take no part; ties of score and count go to the phrase that is first in byte order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.words import mix, row_groups, text_bytes, window_hashes, word_hashes

#: Words of the longest phrase.
LONGEST = 4
#: Bits of the map that says which shorter phrases may be frequent: 8 MB.
FILTER_BITS = 26
#: A prefix with this share of all occurrences is cut into ``PARTS``.
HOT_SHARE, PARTS = 1024, 64
#: Bytes of text of one group of rows; one longer text may exceed it.
GROUP = 1 << 23

_SPACE = pa.scalar(" ", pa.large_string())
_BLANK, _END = 1, 2
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class Tokens(NamedTuple):
    """Words of a group of texts: token of each, its piece; word, language and hash of a token."""

    token: np.ndarray
    piece: np.ndarray
    words: pa.Array
    langs: pa.Array
    hashes: np.ndarray


def _encoded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = pc.dictionary_encode(values)
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def _spelled_hashes(names: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(names)
    return word_hashes(data, offsets[:-1], offsets[1:], seed=11)


def token_hashes(words: pa.Array, langs: pa.Array) -> np.ndarray:
    """Hash of each word in its language."""
    return mix(_spelled_hashes(words) ^ mix(_spelled_hashes(langs)))


def tokens(texts: pa.Array, langs: pa.Array) -> Tokens:
    """The words of all texts, A-Z in lower case, and the pieces that they are in."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    kind = _KIND[data]
    solid = kind == 0
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(offsets, start, side="right") - 1
    # a piece ends at its sign, and with its text
    piece = np.cumsum(kind == _END)[start] + owner if len(start) else start
    bounds = np.r_[0, np.cumsum(end - start)]
    spelled = pa.Array.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[solid])]
    )
    word, names = _encoded(spelled)
    of_text, lang_names = _encoded(pc.fill_null(langs.cast(pa.large_string()), "und"))
    token, pairs = _encoded(pa.array(of_text[owner] * max(len(names), 1) + word))
    pairs = pairs.to_numpy(zero_copy_only=False)
    token_words = names.take(pa.array(pairs % max(len(names), 1)))
    token_langs = lang_names.take(pa.array(pairs // max(len(names), 1)))
    return Tokens(
        token, piece, token_words.cast(pa.large_string()), token_langs, token_hashes(token_words, token_langs)
    )


# --- stripes ----------------------------------------------------------------


class Known(NamedTuple):
    """What is known of the phrases one word shorter: the bit map, and hashes of hot ones."""

    bits: np.ndarray
    hot: np.ndarray

    def may_be_frequent(self, hashes: np.ndarray) -> np.ndarray:
        cell = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        return (self.bits[cell >> 6] >> (cell & 63)) & 1 == 1


def _rows(lang: pa.Array, prefix: pa.Array, part: np.ndarray, bounds: np.ndarray, words: pa.Array, counts: np.ndarray):
    offsets = pa.array(bounds.astype(np.int32))

    def joined(values: pa.Array) -> pa.Array:
        # as one text, an entry takes its own bytes in the shuffle and no more
        return pc.binary_join(pa.ListArray.from_arrays(offsets, values.cast(pa.string())), " ")

    return pa.RecordBatch.from_arrays(
        [lang.cast(pa.string()), prefix.cast(pa.string()), pa.array(part.astype(np.int32)),
         joined(words), joined(pa.array(counts))],
        ["lang", "prefix", "part", "words", "counts"],
    )


def stripes_of(found: Tokens, length: int, known: Known) -> pa.RecordBatch | None:
    """Stripes of the phrases of ``length`` words: their prefixes, next words and counts."""
    n = len(found.token) - length + 1
    if n <= 0:
        return None
    shorter = window_hashes(found.hashes[found.token], length - 1)
    passes = known.may_be_frequent(shorter)
    at = np.flatnonzero(
        (found.piece[:n] == found.piece[length - 1 :]) & passes[:n] & passes[1 : n + 1]
    )
    if not len(at):
        return None
    size = len(found.words)
    prefix, spelled = found.token[at], found.words
    lang = found.langs.take(pa.array(prefix))
    for k in range(1, length - 1):
        prefix, pairs = _encoded(pa.array(prefix * size + found.token[at + k]))
        pairs = pairs.to_numpy(zero_copy_only=False)
        spelled = pc.binary_join_element_wise(
            spelled.take(pa.array(pairs // size)), found.words.take(pa.array(pairs % size)), _SPACE
        )
    last = found.token[at + length - 1]
    hot = np.isin(shorter[at], known.hot)
    part = np.where(hot, (found.hashes[last] % np.uint64(PARTS)).astype(np.int64), 0)
    codes, sample, counts = np.unique((prefix * PARTS + part) * size + last, return_index=True, return_counts=True)
    stripe = codes // size
    begins = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]])
    return _rows(
        lang.take(pa.array(sample[begins])),
        spelled.take(pa.array(stripe[begins] // PARTS)),
        stripe[begins] % PARTS,
        np.r_[begins, len(codes)],
        found.words.take(pa.array(codes % size)),
        counts,
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    for batch in row_groups(batches, "text", GROUP):
        yield tokens(batch.column("text"), batch.column("lang"))


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """Words of each language with their counts; those below ``least`` together as a null word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _groups(batches):
            n = np.bincount(found.token, minlength=len(found.words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [found.langs.cast(pa.string()), found.words.cast(pa.string()), pa.array(n)], ["lang", "phrase", "n"]
            )

    counted = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(
        count, "lang string, phrase string, n long"
    ).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    named = F.when(F.col("n") >= least, F.col("phrase"))
    return counted.groupBy("lang", named.alias("phrase")).agg(F.sum("n").alias("n"))


def merged_stripes(docs: DataFrame, length: int, known: Known, least: int) -> DataFrame:
    """Frequent phrases of a length, from stripes merged elementwise: lang, phrase, n."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _groups(batches):
            rows = stripes_of(found, length, shared.value)
            if rows is not None:
                yield rows

    partial = docs.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(
        gather, "lang string, prefix string, part int, words string, counts string"
    )
    entries = partial.repartition("lang", "prefix", "part").select(
        "lang", "prefix", "part",
        F.inline(F.arrays_zip(F.split("words", " ").alias("words"), F.split("counts", " ").alias("counts"))),
    )
    return (
        entries.groupBy("lang", "prefix", "part", F.col("words").alias("word"))
        .agg(F.sum(F.col("counts").cast("long")).alias("n"))
        .filter(F.col("n") >= least)
        .select("lang", F.concat_ws(" ", "prefix", "word").alias("phrase"), "n")
    )


# --- what is known of shorter phrases ---------------------------------------


def phrase_hashes(phrases: pa.Array, langs: pa.Array, length: int) -> np.ndarray:
    """Hashes of phrases of one length, equal to those of their occurrences in a text."""
    words = pc.list_flatten(pc.split_pattern(phrases.cast(pa.large_string()), " "))
    of_word = langs.cast(pa.large_string()).take(pa.array(np.repeat(np.arange(len(phrases)), length)))
    return window_hashes(token_hashes(words, of_word), length)[::length]


def known_phrases(frequent: DataFrame, length: int, total: int) -> Known:
    """The bit map of the frequent phrases of a length, and the hot ones among them."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = phrase_hashes(batch.column("phrase"), batch.column("lang"), length)
            cell = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell)], ["cell"])

    spelled = frequent.filter(F.col("phrase").isNotNull()).select("lang", "phrase", "n")
    bit = F.expr("shiftleft(1L, CAST(cell & 63 AS INT))")
    # at most 2**FILTER_BITS / 64 rows, whatever the input
    found = (
        spelled.select("lang", "phrase").mapInArrow(cells, "cell long")
        .groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    bits[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    # shares add up to one, so there are at most HOT_SHARE rows
    hot = spelled.filter(F.col("n") >= max(-(-total // HOT_SHARE), 1)).toArrow()
    hashes = phrase_hashes(hot.column("phrase").combine_chunks(), hot.column("lang").combine_chunks(), length)
    return Known(bits, np.sort(hashes))


# --- scores -----------------------------------------------------------------


def _joined(words: Column, start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def best_cuts(phrases: DataFrame, total: int) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, phrase, a, l, r, score.

    ``phrases`` has lang, phrase, n of all frequent phrases of any length.
    """
    hot = F.col("n") >= max(-(-total // HOT_SHARE), 1)
    everywhere = F.sequence(F.lit(0), F.lit(PARTS - 1))
    parts = phrases.select(
        "lang", F.col("phrase").alias("of"), F.col("n").alias("of_n"),
        F.explode(F.when(hot, everywhere).otherwise(F.array(F.lit(0)))).alias("piece"),
    )
    # at most HOT_SHARE rows of each length
    frequent = F.broadcast(phrases.filter(hot).select("lang", F.col("phrase").alias("of"), F.lit(True).alias("is_hot")))
    words = F.split("phrase", " ")
    cut = phrases.withColumn("words", words).filter(F.size("words") > 1).select(
        "lang", "phrase", F.col("n").alias("a"), "words",
        F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"),
    )
    sides = cut.select(
        "lang", "phrase", "a", "k",
        F.inline(F.array(
            F.struct(F.lit(True).alias("left"), _joined(F.col("words"), F.lit(1), F.col("k")).alias("of")),
            F.struct(F.lit(False).alias("left"), _joined(F.col("words"), F.col("k") + 1, F.size("words") - F.col("k")).alias("of")),
        )),
    )
    spread = F.when(F.col("is_hot"), F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).cast("int")).otherwise(0)
    sized = sides.join(frequent, ["lang", "of"], "left").withColumn("piece", spread).join(parts, ["lang", "of", "piece"])
    cuts = sized.groupBy("lang", "phrase", "a", "k").agg(
        F.sum(F.when(F.col("left"), F.col("of_n"))).alias("l"), F.sum(F.when(~F.col("left"), F.col("of_n"))).alias("r")
    )
    # decimals: the product may pass 64 bits
    score = F.expr("CAST(2000000 AS decimal(7, 0)) * CAST(a AS decimal(20, 0)) div CAST(l + r AS decimal(20, 0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("best")).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score"
    )


def held_by_longer(phrases: DataFrame) -> DataFrame:
    """The greatest count of a phrase one word longer around each phrase: lang, phrase, most.

    Longer ones still occur no more often than the phrase between.
    """
    words = F.split("phrase", " ")
    around = phrases.withColumn("words", words).filter(F.size("words") > 2)
    inner = F.size("words") - 1
    return around.select(
        "lang", "n",
        F.explode(F.array(_joined(F.col("words"), F.lit(1), inner), _joined(F.col("words"), F.lit(2), inner))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, least: int = 30, subsumed_percent: int = 80, first: int = 2000) -> DataFrame:
    """The ``first`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A candidate is left out if a longer one around it has ``subsumed_percent`` of its count.
    ``least`` must be at least 1; a longer phrase below ``least`` is no candidate.
    """
    stage = Stage(docs.sparkSession, "phrases")
    words = stage.table(word_counts(docs, least), "length-1")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    total = words.agg(F.sum("n")).first()[0] or 0
    of_length = [words.filter(F.col("phrase").isNotNull())]
    for length in range(2, LONGEST + 1):
        known = known_phrases(of_length[-1], length - 1, total)
        of_length.append(stage.table(merged_stripes(docs, length, known, least), f"length-{length}"))
    phrases = of_length[0].unionByName(of_length[1])
    for more in of_length[2:]:
        phrases = phrases.unionByName(more)

    most = F.coalesce(F.col("most"), F.lit(0)).cast("decimal(20, 0)")
    kept = best_cuts(phrases, total).join(held_by_longer(phrases), ["lang", "phrase"], "left").filter(
        most * 100 < F.col("a").cast("decimal(20, 0)") * subsumed_percent
    ).drop("most")
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    # first within parts of a language, so that no task orders all its candidates
    some = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    near = kept.withColumn("_part", some).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    ).filter(F.col("_place") <= first)
    placed = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return placed.filter(F.col("rank") <= first).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
