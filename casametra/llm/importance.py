"""Resampling documents towards a target distribution by hashed n-gram importance.

A text is lower-cased (A-Z only) and split into words by Arrow kernels; a group of rows is
one flat array of words, encoded by dictionary. Pairs and triples of neighbouring words
are pairs of shifted dictionary indices, encoded in turn, so that each distinct n-gram of
the group is hashed once. Its CRC follows from the CRCs of its words: the checksum of a
concatenation is the first part's, moved on by the length of the second, XOR the second's.

One pass counts the features of both tables by bucket; the gains (a table of
``BUCKETS`` integers, whatever the input) are broadcast, and a second pass takes each
feature's gain and adds them up by document. Scores get Gumbel noise from the id, so that
the highest of them are a draw without replacement. The draw needs no global sort of
the table: a histogram of scores bounds the candidates, and only those are put in order,
over ranges of equal size.

Defined cases: a null or empty text, or one without a word, has no features and weight 0;
repeated rows score alike, each is drawn or not by itself; ties go to the smaller doc_id,
null last; a null doc_id has the noise of an empty id; an empty target table gives gains
by the smoothing alone; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.words import row_groups

BUCKETS = 10_000
#: Longest n-gram in words.
NGRAM = 3
#: What lies between words, after A-Z have been lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text of one group of rows; one longer text may exceed it.
GROUP = 1 << 22


class Features(NamedTuple):
    """Bucket of each n-gram, by length, and the row that it is in; words of each row."""

    buckets: list[np.ndarray]
    owners: list[np.ndarray]
    words: np.ndarray


# --- checksums of concatenations --------------------------------------------


@lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    """The CRC-32 register after one zero byte, for each value of its low byte."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1).astype(np.uint32)
    return value


@lru_cache(maxsize=40)
def _move_tables(power: int) -> np.ndarray:
    """What 2**power zero bytes make of a register, for each value of each of its bytes."""
    if power == 0:
        table = np.arange(256, dtype=np.uint32)
        rows = [table << np.uint32(8 * k) for k in range(4)]
        step = _byte_table()
        return np.stack([step[r & 0xFF] ^ (r >> np.uint32(8)) for r in rows])
    half = _move_tables(power - 1)
    return np.stack([_moved_by(half, row) for row in half])


def _moved_by(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (
        tables[0][crc & 0xFF]
        ^ tables[1][(crc >> np.uint32(8)) & 0xFF]
        ^ tables[2][(crc >> np.uint32(16)) & 0xFF]
        ^ tables[3][crc >> np.uint32(24)]
    )


def moved(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs moved on by so many bytes each."""
    out = crc.copy()
    for power in range(int(length.max()).bit_length() if len(length) else 0):
        at = np.flatnonzero((length >> power) & 1)
        out[at] = _moved_by(_move_tables(power), out[at])
    return out


# --- features of a group of rows --------------------------------------------


def _encoded(codes: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = pc.dictionary_encode(codes)
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def features(texts: pa.Array, longest: int = NGRAM) -> Features:
    """Buckets of all n-grams of the texts, one entry for each occurrence."""
    # a copy of its own: the kernel misreads slices that begin within a larger buffer
    own = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))
    lists = pc.split_pattern_regex(pc.ascii_lower(own), SEPARATORS)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, "")
    flat, owner = flat.filter(full), owner.filter(full).to_numpy(zero_copy_only=False)
    counts = np.bincount(owner, minlength=len(texts))
    if not len(flat):
        none = np.zeros(0, dtype=np.int64)
        return Features([none] * longest, [none] * longest, counts)
    word, names = _encoded(flat)
    spelled = names.cast(pa.large_binary())
    size = pc.binary_length(spelled).to_numpy(zero_copy_only=False).astype(np.int64)
    of_word = np.fromiter((zlib.crc32(w) for w in spelled.to_pylist()), np.uint32, len(spelled))
    # a word with a blank before it, as it continues an n-gram
    blank = np.full(len(size), zlib.crc32(b" "), dtype=np.uint32)
    continued = moved(blank, size) ^ of_word

    gram, crc, at = word, of_word, np.arange(len(word))
    buckets, owners = [(crc % BUCKETS)[gram].astype(np.int64)], [owner]
    for n in range(2, longest + 1):
        # n-grams that begin and end in one row: the shorter one, and the word after it
        within = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
        head = _spread(gram, at, len(owner))
        gram, pairs = _encoded(pa.array(head[within] * len(names) + word[within + n - 1]))
        pairs = pairs.to_numpy(zero_copy_only=False)
        first, last = pairs // len(names), pairs % len(names)
        crc = moved(crc[first], size[last] + 1) ^ continued[last]
        buckets.append((crc % BUCKETS)[gram].astype(np.int64))
        owners.append(owner[within])
        at = within
    return Features(buckets, owners, counts)


def _spread(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The values at their places among ``n``."""
    out = np.zeros(n, dtype=np.int64)
    out[at] = values
    return out


# --- on Spark ---------------------------------------------------------------


def bucket_counts(texts: DataFrame) -> DataFrame:
    """Features by bucket, added up within each task first: bucket, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in row_groups(batches, "text", GROUP):
            for buckets in features(batch.column("text")).buckets:
                total += np.bincount(buckets, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket; at most ``BUCKETS`` counts of each table come to the driver."""
    counted = []
    for texts in (corpus, target):
        n = np.zeros(BUCKETS, dtype=np.int64)
        for row in bucket_counts(texts).collect():
            n[row["bucket"]] = row["n"]
        counted.append(n)
    s, t = counted
    ratio = (t + 1.0) * (s.sum() + float(BUCKETS)) / ((s + 1.0) * (t.sum() + float(BUCKETS)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = NGRAM) -> DataFrame:
    """Per row: doc_id, n_words, n_features and weight, the sum of its features' gains."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_bucket = pa.array(shared.value)
        for batch in row_groups(batches, "text", GROUP):
            found = features(batch.column("text"), longest)
            n, weight = np.zeros((2, batch.num_rows), dtype=np.int64)
            for buckets, owner in zip(found.buckets, found.owners, strict=True):
                if not len(owner):
                    continue
                taken = of_bucket.take(pa.array(buckets)).to_numpy()
                begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                n[owner[begins]] += np.diff(np.r_[begins, len(owner)])
                weight[owner[begins]] += np.add.reduceat(taken, begins)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.words.astype(np.int64)), pa.array(n), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long")


def gumbel_noise(seed: int) -> Column:
    """Noise in thousandths from the seed and the id; the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _level(score: Column) -> Column:
    """A number that never decreases as the score grows; a few thousand of them at most."""
    return F.floor(F.signum(score) * F.log1p(F.abs(score).cast("double")) * 64).cast("int")


def lowest_level(scored: DataFrame, wanted: int) -> int:
    """The level that holds the last of the ``wanted`` highest scores."""
    levels = scored.groupBy(_level(F.col("score")).alias("level")).agg(F.count("*").alias("n"))
    above = Window.orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, 0)
    upto = levels.withColumn("upto", F.sum("n").over(above))
    return upto.filter(F.col("upto") - F.col("n") < wanted).agg(F.min("level")).first()[0]


def ranked(candidates: DataFrame, stage: Stage) -> DataFrame:
    """The candidates with their ``rank`` by score, ties to the smaller doc_id.

    Ranges of scores are ordered each in a task of its own. A row's rank is its place in
    the range and the number of rows in the ranges before it.
    """
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    placed = stage.table(
        candidates.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "placed",
    ).select("*", F.shiftright("_place", 33).cast("int").alias("_range"))
    in_range = F.col("_place").bitwiseAND((1 << 33) - 1)
    # one row for each range: as many as there are partitions
    sizes = stage.table(placed.groupBy("_range").agg(F.count("*").alias("_n")), "ranges")
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    return placed.join(offsets, "_range").withColumn("rank", in_range + F.col("_before") + 1).drop(
        "_range", "_place", "_before"
    )


def resample(
    docs: DataFrame, target: DataFrame, share: float = 0.05, min_words: int = 20, seed: int = 42
) -> DataFrame:
    """Per row: doc_id, n_words, n_features, weight, score, and rank where it is drawn.

    ``share`` of the rows with at least ``min_words`` words is drawn.
    """
    stage = Stage(docs.sparkSession, "importance")
    weighed = weights(docs, gains(docs, target))
    scored = stage.table(weighed.withColumn("score", F.col("weight") + gumbel_noise(seed)), "scored")
    eligible = scored.filter(F.col("n_words") >= min_words)
    wanted = eligible.count() * round(share * 1_000_000) // 1_000_000
    undrawn = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", undrawn)
    candidate = (F.col("n_words") >= min_words) & (_level(F.col("score")) >= lowest_level(eligible, wanted))
    in_order = ranked(scored.filter(candidate), stage)
    drawn = in_order.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return scored.filter(~candidate).select("*", undrawn).unionByName(drawn)
