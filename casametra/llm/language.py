"""Language of a text by unigrams of pieces, over all segmentations.

Each language has a probability for every piece of a fixed public byte-level vocabulary
(single bytes are added, so that every text has a segmentation). The probability of a
word, with the blank before it, is the sum over all ways to cut it into pieces. A
forward pass over its bytes adds them up; it keeps the sums of as many bytes as the longest
piece has, so a word may have any length, and brings them back to one at times, in each language
by itself, so that none of them ever reaches zero. A text's score is the sum over its
words, and the language with the best posterior is predicted.

The piece probabilities are learned from at most ``SAMPLE`` documents of each language:
Spark counts their words (those of up to ``LEARNED_BYTES`` bytes), and each round of
expectation maximisation is a job over these counts whose expected piece counts, one row per
language and piece, come back. Words that occur often are scored once per group of rows.
Letters are lower-cased as far as Latin-1.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is
everything if no language is given to learn from; a null doc_id is never learned from; of
rows with one id and language, the first text in byte order is learned from; repeated
rows are predicted alike; text in a script that was not learned has a finite score.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.words import mix, row_groups, text_bytes, words_of

#: Documents of each language that are learned from, at most.
SAMPLE = 1500
#: Rounds of expectation maximisation.
ROUNDS = 2
#: Longest word that is learned from; any word is scored.
LEARNED_BYTES = 256
#: Pieces up to this size are looked up everywhere, longer ones where they can begin.
SHORT = 8
#: Bytes after which the sums of a forward pass are brought back to one.
RESCALED = 32
#: Bytes of a word whose pieces are looked up at a time.
BLOCK = 4096
#: Expected counts added to every piece, in all, spread like the pieces of all languages.
SMOOTHING = 50.0
#: Powers of two per byte that keep the sums of a forward pass near one.
SCALE = 6.0
#: Sums span many orders of magnitude within one piece's length; this type holds them all.
REAL = np.longdouble
if np.finfo(REAL).maxexp < 16000:
    raise ImportError("the forward pass needs extended-precision floats")

_TABLE_BITS = 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Pieces(NamedTuple):
    """A hash table of the pieces: hash and number at each place, a few in a second table.

    ``begins`` has the hashes, in order, of what longer pieces begin with, from ``SHORT`` bytes on.
    """

    lengths: np.ndarray
    keys: tuple[np.ndarray, np.ndarray]
    numbers: tuple[np.ndarray, np.ndarray]
    begins: np.ndarray

    @property
    def longest(self) -> int:
        return int(self.lengths.max())


def _slot(hashes: np.ndarray, table: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(hashes + np.uint64(table)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The pieces of a vocabulary file of base64 pieces and ranks, one a line."""
    with open(path, "rb") as file:
        all_pieces = [base64.b64decode(line.split()[0]) for line in file if line.strip()]
    kept = sorted({p for p in all_pieces if p} | {bytes([b]) for b in range(256)})
    hashes = np.array([_hash_bytes(p) for p in kept], dtype=np.uint64)
    keys, numbers = [], []
    left = np.arange(len(kept))
    for table in (0, 1):
        slots, first = np.unique(_slot(hashes[left], table), return_index=True)
        key, number = np.zeros(1 << _TABLE_BITS, dtype=np.uint64), np.full(1 << _TABLE_BITS, len(kept), dtype=np.int32)
        key[slots], number[slots] = hashes[left[first]], left[first]
        keys.append(key)
        numbers.append(number)
        left = np.setdiff1d(left, left[first])
    if len(left):
        raise ValueError("pieces do not fit the tables")
    begins = {_hash_bytes(p[:n]) for p in kept for n in range(SHORT, len(p))}
    return Pieces(
        np.array([len(p) for p in kept]), tuple(keys), tuple(numbers), np.array(sorted(begins), dtype=np.uint64)
    )


def _hash_bytes(piece: bytes) -> int:
    value = 0
    for b in piece:
        value = (value * int(_BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def find_pieces(table: Pieces, hashes: np.ndarray) -> np.ndarray:
    """Piece number of each hash; the number of pieces where there is none."""
    shape, hashes = hashes.shape, hashes.reshape(-1)
    slot = _slot(hashes, 0)
    same = table.keys[0][slot] == hashes
    found = np.where(same, table.numbers[0][slot], len(table.lengths))
    other = np.flatnonzero(~same & (table.numbers[0][slot] < len(table.lengths)))
    if len(other):
        slot = _slot(hashes[other], 1)
        found[other] = np.where(table.keys[1][slot] == hashes[other], table.numbers[1][slot], len(table.lengths))
    return found.reshape(shape)


#: Pieces that end at one place of equally long words: size, words (all if None), numbers.
Found = tuple[int, np.ndarray | None, np.ndarray]


def _is_among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(values.shape, dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def matches(table: Pieces, letters: np.ndarray) -> Iterator[list[Found]]:
    """For equally long words (rows of bytes): the pieces that end after each byte in turn."""
    n, length = letters.shape
    longest = min(table.longest, length)
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(longest, _BASE, dtype=np.uint64)])
        carried = np.zeros((1, n), dtype=np.uint64)  # hashes of beginnings, up to the block
        for low in range(0, length, max(BLOCK // max(n, 1), longest)):
            high = min(low + max(BLOCK // max(n, 1), longest), length)
            prefix = np.empty((len(carried) + high - low, n), dtype=np.uint64)
            prefix[: len(carried)] = carried
            for i in range(low, high):
                k = len(carried) + i - low
                prefix[k] = prefix[k - 1] * _BASE + letters[:, i] + np.uint64(1)
            base = low - len(carried) + 1  # the byte count that the first row belongs to
            ends: list[list[Found]] = [[] for _ in range(low, high)]
            for size in range(1, min(SHORT, high) + 1):
                first = max(low + 1, size) - base
                numbers = find_pieces(table, prefix[first:] - prefix[first - size : len(prefix) - size] * power[size])
                hit = (numbers < len(table.lengths)).any(axis=1)
                for k in np.flatnonzero(hit):
                    ends[first + k + base - low - 1].append((size, None, numbers[k]))
            if longest > SHORT and len(prefix) > SHORT:
                whole = prefix[SHORT:] - prefix[:-SHORT] * power[SHORT]
                start, word = np.nonzero(_is_among(whole, table.begins))
                for size in range(SHORT + 1, longest + 1):
                    keep = start + size < len(prefix)
                    start, word = start[keep], word[keep]
                    if not len(start):
                        break
                    hashes = prefix[start + size, word] - prefix[start, word] * power[size]
                    numbers = find_pieces(table, hashes)
                    hit = np.flatnonzero((numbers < len(table.lengths)) & (start + size + base > low))
                    for end, group in _grouped(start[hit] + size + base - low - 1, hit):
                        ends[end].append((size, word[group], numbers[group]))
                    on = _is_among(hashes, table.begins)
                    start, word = start[on], word[on]
            carried = prefix[-min(len(prefix), longest) :]
            yield from ends


def _grouped(keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    distinct, low = np.unique(keys[order], return_index=True)
    yield from zip(distinct.tolist(), np.split(values[order], low[1:]))


def forward(found: list[list[Found]], n: int, weights: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each beginning: (length + 1, words, languages)."""
    sums = np.zeros((len(found) + 1, n, weights.shape[1]), dtype=REAL)
    sums[0] = 1
    for end, pieces_here in enumerate(found, start=1):
        for size, words, numbers in pieces_here:
            at = slice(None) if words is None else words
            sums[end, at] += sums[end - size, at] * weights[numbers]
    return sums


def log_sums(table: Pieces, letters: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all segmentations of each of some equally long words."""
    n, length = letters.shape
    kept = min(table.longest, length) + 1
    sums = np.zeros((kept, n, weights.shape[1]), dtype=REAL)
    sums[0] = 1
    moved = np.zeros((n, weights.shape[1]), dtype=REAL)
    for end, pieces_here in enumerate(matches(table, letters), start=1):
        total = np.zeros_like(sums[0])
        for size, words, numbers in pieces_here:
            before = sums[(end - size) % kept]
            if words is None:
                total += before * weights[numbers]
            else:
                total[words] += before[words] * weights[numbers]
        sums[end % kept] = total
        if end % RESCALED == 0:
            sums /= total
            moved += np.log(total)
    return (np.log(sums[length % kept]) + moved).astype(np.float64)


def scaled(probabilities: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities (pieces, languages) times a power of two per byte; a last row of zeros."""
    weights = probabilities.astype(REAL) * np.exp2((SCALE * lengths).astype(REAL))[:, None]
    return np.vstack([weights, np.zeros((1, probabilities.shape[1]), dtype=REAL)])


class Spelled(NamedTuple):
    """Distinct words of some texts, and for each word of the texts its text and number."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    number: np.ndarray


def spelled(texts: pa.Array) -> Spelled:
    data, offsets = text_bytes(texts)
    lower = _LOWER[data]
    accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    lower[accented] += 32
    words = words_of(pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(lower)]))
    _, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
    return Spelled(lower, words.start[first], words.end[first], words.text, number)


def by_length(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of each length in turn: their indexes, and their bytes after a blank."""
    size = end - start
    order = np.argsort(size, kind="stable")
    sizes, low = np.unique(size[order], return_index=True)
    for k, length in enumerate(sizes.tolist()):
        rows = order[low[k] : low[k + 1] if k + 1 < len(low) else None]
        letters = np.empty((len(rows), length + 1), dtype=np.uint8)
        letters[:, 0] = 0x20
        letters[:, 1:] = data[start[rows][:, None] + np.arange(length)]
        yield rows, letters


def word_scores(table: Pieces, words: Spelled, weights: np.ndarray) -> np.ndarray:
    """Log probability of each distinct word in each language."""
    out = np.empty((len(words.start), weights.shape[1]))
    for rows, letters in by_length(words.data, words.start, words.end):
        out[rows] = log_sums(table, letters, weights) - SCALE * np.log(2) * letters.shape[1]
    return out


# --- learning ---------------------------------------------------------------


class Model(NamedTuple):
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


def counted_words(sample: DataFrame) -> DataFrame:
    """Words of the sample by language: lang, word (bytes), n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            langs = batch.column("lang").to_pylist()
            for lang in sorted(set(langs)):
                part = batch.column("text").filter(pa.array([x == lang for x in langs]))
                words = spelled(part)
                n = np.bincount(words.number, minlength=len(words.start))
                short = np.flatnonzero(words.end - words.start <= LEARNED_BYTES)
                spelled_out = [words.data[s:e].tobytes() for s, e in zip(words.start[short], words.end[short], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(short), pa.string()), pa.array(spelled_out, pa.binary()), pa.array(n[short], pa.int64())],
                    ["lang", "word", "n"],
                )

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, word binary, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def expected_counts(words: DataFrame, path: str, languages: list[str], weights: np.ndarray | None) -> np.ndarray:
    """Expected piece counts (pieces, languages); without weights, plain counts of all substrings."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        total = np.zeros((len(table.lengths) + 1, len(languages)))
        for batch in batches:
            data, offsets = text_bytes(batch.column("word"))
            lang = np.array([languages.index(x) for x in batch.column("lang").to_pylist()], dtype=np.int64)
            n = batch.column("n").to_numpy()
            for rows, letters in by_length(data, offsets[:-1], offsets[1:]):
                length, k = letters.shape[1], lang[rows]
                found = list(matches(table, letters))
                if weights is None:
                    for _, words_, number in (x for here in found for x in here):
                        at = slice(None) if words_ is None else words_
                        np.add.at(total, (number, k[at]), n[rows][at])
                    continue
                sums = np.take_along_axis(forward(found, len(rows), weights), k[None, :, None], axis=2)[:, :, 0]
                after = np.zeros_like(sums)
                after[length] = 1
                for end in range(length, 0, -1):
                    for size, words_, number in found[end - 1]:
                        at = slice(None) if words_ is None else words_
                        after[end - size, at] += weights[number, k[at]] * after[end, at]
                for end in range(1, length + 1):
                    for size, words_, number in found[end - 1]:
                        at = slice(None) if words_ is None else words_
                        share = sums[end - size, at] * weights[number, k[at]] * after[end, at] / sums[length, at]
                        np.add.at(total, (number, k[at]), (share * n[rows][at]).astype(np.float64))
        piece, k = np.nonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(piece), pa.array(total[piece, k])], ["k", "piece", "n"])

    rows = words.mapInArrow(expect, "k long, piece long, n double").groupBy("k", "piece").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((len(pieces(path).lengths), len(languages)))
    out[rows["piece"], rows["k"]] = rows["n"]
    return out


def probabilities(counts: np.ndarray) -> np.ndarray:
    """Smoothed probabilities of the pieces in each language."""
    common = (counts.sum(axis=1, keepdims=True) + 0.1) / (counts.sum() + 0.1 * len(counts))
    counts = counts + SMOOTHING * common
    return counts / counts.sum(axis=0, keepdims=True)


def fit(docs: DataFrame, learn: Column, path: str | None = None) -> Model | None:
    """A model of the documents with a language for which ``learn`` holds; None without any."""
    path = path or default_vocabulary()
    stage = Stage(docs.sparkSession, "language")
    usable = docs.filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & learn
    ).select("doc_id", F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id").alias("hash"))
    totals = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not totals:
        return None
    languages = sorted(totals)
    # a hash bound keeps about twice the sample; only those ids are ranked, each once
    share = F.create_map(*[F.lit(v) for x in languages for v in (x, min(2.0 * SAMPLE / totals[x], 1.0))])
    below = (F.pmod("hash", F.lit(1 << 32)) / float(1 << 32)) < share[F.col("lang")]
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    few = usable.filter(below).select("lang", "hash", "doc_id").distinct()
    picked = few.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= SAMPLE).select("lang", "doc_id")
    # at most SAMPLE ids a language are broadcast; texts are filtered where they are read
    chosen = stage.table(picked, "picked")
    sample = usable.filter(below).join(F.broadcast(chosen), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    words = stage.table(counted_words(sample).repartition(8), "words")
    table = pieces(path)
    weights = scaled(probabilities(expected_counts(words, path, languages, None)), table.lengths)
    for _ in range(ROUNDS):
        weights = scaled(probabilities(expected_counts(words, path, languages, weights)), table.lengths)
    prior = np.array([totals[x] for x in languages], dtype=float)
    return Model(languages, np.log(prior / prior.sum()), weights)


def predicted(docs: DataFrame, model: Model | None, path: str | None = None) -> DataFrame:
    """Per row: doc_id, lang_pred and score, the posterior probability of that language."""
    path = path or default_vocabulary()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = shared.value, pieces(path)
        for batch in row_groups(batches, "text", 4 << 20):
            n = batch.num_rows
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            if model is None:
                best, score, lettered, names = np.zeros(n, int), np.zeros(n), np.zeros(n, bool), ["und"]
            else:
                words, names = spelled(batch.column("text")), model.languages
                scores = word_scores(table, words, model.weights)
                total = np.stack(
                    [np.bincount(words.text, weights=scores[words.number, k], minlength=n) for k in range(len(names))], axis=1
                ) + model.prior
                best = total.argmax(axis=1)
                score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            lang = [names[b] if has else "und" for b, has in zip(best.tolist(), lettered.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.where(lettered, score, 0.0))],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", lettered.alias("lettered")).mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double"
    )


def identify_languages(docs: DataFrame, learn: Column, path: str | None = None) -> DataFrame:
    """Learn from the rows for which ``learn`` holds and predict all rows."""
    return predicted(docs, fit(docs, learn, path), path)
