"""Substring dedup: words covered by a window that an earlier document also has.

A window is a run of words. Three passes over the texts:

1. Count-min sketch. Each task hashes its windows to the cells of a sketch and writes
   its partial sketch, segment by segment, as sorted cells (twice where it saw more).
   Partial sketches of a segment are added up; a cell counts as repeated from two on.
   Counts are never too low, so no repeated window is lost. The sketch has a fixed
   number of cells, so the repeated cells are a bit map of fixed size (64 MB), which
   is broadcast. Beyond some hundred million windows the map fills up; then more
   windows go to the second pass than need to, and the result stays the same.
2. Exact groups. Windows in repeated cells are grouped by 96 hash bits. A task first
   groups its own: in all but its smallest document the window goes, and only that
   smallest document's entry is shuffled. So a window that a third of all documents
   share sends one entry per task, and no group collects its copies.
3. Removal. The positions to remove meet the texts again in groups of documents of a
   bounded number of bytes, and covered words are left out.

Blocks of entries are binary columns, so a row is a block, not a window.

Defined cases: a null text has no words; documents with fewer words than a window keep
all; rows without doc_id keep all their words and remove none elsewhere; repeated rows
have one id, so none of them is smaller, and all are treated alike; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.words import mix, row_groups, text_windows, window_hashes, words_of

#: Words in a window.
WINDOW = 13
#: Bits of a cell number in the sketch: 2^29 cells, a bit map of 64 MB.
CELL_BITS = 29
#: Bits of a cell number within a segment.
SEGMENT_BITS = 16
#: Segments that are added up together.
SEGMENTS_TOGETHER = 128
#: Windows that a task holds before it writes a block.
BLOCK_WINDOWS = 1_500_000
#: Windows in one part of the second pass.
PART_WINDOWS = 500_000
#: Bytes of text in one group of the third pass.
GROUP_OF_TEXT = 2 << 20

SEGMENTS = 1 << (CELL_BITS - SEGMENT_BITS)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary array whose elements are runs of the values, ``counts`` long."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


# --- pass 1: the sketch -----------------------------------------------------


def _sketch_rows(hashes: list[np.ndarray]) -> pa.RecordBatch:
    cells = np.sort((np.concatenate(hashes) >> np.uint64(64 - CELL_BITS)).astype(np.uint32))
    # a cell is kept once or twice, which is all that the total needs
    kept = np.ones(len(cells), dtype=bool)
    kept[2:] = cells[2:] != cells[:-2]
    windows, cells = len(cells), cells[kept]
    segment, count = np.unique(cells >> np.uint32(SEGMENT_BITS), return_counts=True)
    n = np.zeros(len(segment), dtype=np.int64)
    n[:1] = windows
    return pa.RecordBatch.from_arrays(
        [pa.array((segment // SEGMENTS_TOGETHER).astype(np.int32)), pa.array(segment.astype(np.int32)),
         _binary((cells & np.uint32((1 << SEGMENT_BITS) - 1)).astype(np.uint16), count), pa.array(n)],
        ["part", "segment", "cells", "windows"],
    )


def partial_sketches(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Partial sketches of the tasks: part, segment, cells, windows."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in row_groups(batches, "text"):
            hashes, _ = text_windows(words_of(batch.column("text")), batch.num_rows, window)
            held.append(hashes)
            size += len(hashes)
            if size >= BLOCK_WINDOWS:
                yield _sketch_rows(held)
                held, size = [], 0
        if size:
            yield _sketch_rows(held)

    return docs.select("text").mapInArrow(sketch, "part int, segment int, cells binary, windows long")


def merged_sketch(partial: DataFrame) -> DataFrame:
    """Segments with the bits of their repeated cells, and the windows counted."""
    parts = max(1, SEGMENTS // SEGMENTS_TOGETHER)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        windows = 0
        for batch in batches:
            windows += int(batch.column("windows").to_numpy().sum())
            for segment, cells in zip(batch.column("segment").to_pylist(), batch.column("cells"), strict=True):
                once, more = counts.setdefault(segment, np.zeros((2, 1 << SEGMENT_BITS), dtype=bool))
                cells = np.frombuffer(cells.as_buffer(), dtype=np.uint16)
                again = cells[1:][cells[1:] == cells[:-1]]
                more[cells[once[cells]]] = True
                more[again] = True
                once[cells] = True
        rows = [(s, np.packbits(c[1]).tobytes()) for s, c in counts.items() if c[1].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *(s for s, _ in rows)], pa.int32()), pa.array([b"", *(b for _, b in rows)], pa.binary()),
             pa.array([windows, *[0] * len(rows)], pa.int64())],
            ["segment", "bits", "windows"],
        )

    return partial.repartition(parts, "part").select("segment", "cells", "windows").mapInArrow(
        merge, "segment int, bits binary, windows long"
    )


# --- pass 2: exact groups ---------------------------------------------------


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Number of the run that each row of sorted keys is in."""
    new = np.zeros(len(keys[0]), dtype=np.int64)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.cumsum(new)


def _split(hash1: np.ndarray, hash2: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple:
    """Order by window then document; whether each entry is of its window's smallest document."""
    order = np.lexsort((at, doc, hash2, hash1))
    hash1, hash2, doc, at = hash1[order], hash2[order], doc[order], at[order]
    if not len(doc):
        return hash1, hash2, doc, at, np.zeros(0, dtype=bool)
    run = _runs(hash1, hash2)
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    return hash1, hash2, doc, at, doc == doc[first][run]


def _removal_rows(doc: np.ndarray, at: np.ndarray, groups: int) -> pa.RecordBatch:
    """Windows to remove, in one block for each group of documents."""
    group = group_of(doc, groups)
    order = np.lexsort((at, doc, group))
    group, doc, at = group[order], doc[order], at[order]
    key, count = np.unique(group, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(key), _binary(doc, count), _binary(at.astype(np.uint32), count)], ["group", "docs", "at"]
    )


def group_of(doc: np.ndarray, groups: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(doc.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(groups)).astype(np.int64)


def candidate_blocks(docs: DataFrame, sketch, parts: int, groups: int, window: int = WINDOW) -> DataFrame:
    """Windows in repeated cells, as blocks by part.

    Blocks without a group hold entries still to compare; blocks with one hold windows
    known to go, as a smaller document of the same task has them.
    """

    def blocks(docs_: list, hash1: list, hash2: list, at: list) -> Iterator[pa.RecordBatch]:
        h1, h2, doc, where, smallest = _split(*map(np.concatenate, (hash1, hash2, docs_, at)))
        gone = _removal_rows(doc[~smallest], where[~smallest], groups)
        n = gone.num_rows
        if n:
            none = pa.nulls(n, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(gone.column(0).to_numpy() % parts), gone.column(0), none, none, gone.column(1), gone.column(2)], NAMES
            )
        h1, h2, doc, where = h1[smallest], h2[smallest], doc[smallest], where[smallest]
        part = (h2 % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((where, doc, part))
        key, count = np.unique(part, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.nulls(len(key), pa.int64()), _binary(h1[order], count),
             _binary((h2[order] >> np.uint64(32)).astype(np.uint32), count), _binary(doc[order], count),
             _binary(where[order].astype(np.uint32), count)],
            NAMES,
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        held, size = ([], [], [], []), 0
        for batch in row_groups(batches, "text"):
            words = words_of(batch.column("text"))
            hashes, at = text_windows(words, batch.num_rows, window)
            cells = (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)
            repeated = (bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
            picked = np.flatnonzero(repeated)
            second = window_hashes(words.hash, window, seed=2)[at[picked]]
            number = words.first(batch.num_rows)
            text = words.text[at[picked]]
            doc = batch.column("doc_id").cast(pa.int64()).to_numpy(zero_copy_only=False)
            for into, values in zip(held, (doc[text].astype(np.int64), hashes[picked], second, at[picked] - number[text]), strict=True):
                into.append(values)
            size += len(picked)
            if size >= BLOCK_WINDOWS // 2:
                yield from blocks(*held)
                held, size = ([], [], [], []), 0
        if size:
            yield from blocks(*held)

    return docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(
        find, "part long, group long, hash1 binary, hash2 binary, docs binary, at binary"
    )


NAMES = ["part", "group", "hash1", "hash2", "docs", "at"]


def compared(blocks: DataFrame, parts: int, groups: int) -> DataFrame:
    """Windows of the parts that a smaller document has: group, docs, at.

    Blocks of windows known to go pass through, so that blocks are shuffled, not stored.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], []]
        for batch in batches:
            known = pa.compute.is_valid(batch.column("group"))
            yield batch.filter(known).select(["group", "docs", "at"])
            batch = batch.filter(pa.compute.invert(known))
            for into, name, kind in zip(held, NAMES[2:], (np.uint64, np.uint32, np.int64, np.uint32), strict=True):
                into += [np.frombuffer(x.as_buffer(), dtype=kind) for x in batch.column(name)]
        if held[0]:
            _, _, doc, at, smallest = _split(*map(np.concatenate, held))
            yield _removal_rows(doc[~smallest], at[~smallest], groups)

    return blocks.repartition(parts, "part").select(*NAMES[1:]).mapInArrow(
        compare, "group long, docs binary, at binary"
    )


# --- pass 3: removal --------------------------------------------------------


def kept_words(text: str | None, starts: np.ndarray, window: int, keep_layout: bool) -> tuple[str | None, int, int]:
    """The kept words joined by one space, the number of words and of those removed."""
    words = (text or "").encode().split()
    if not len(starts):
        return text if keep_layout else b" ".join(words).decode(), len(words), 0
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join(compress(words, keep)).decode(), len(words), int(len(words) - keep.sum())


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept_text, the kept words joined by one space."""
    return _removed(docs.select("doc_id", "text"), window, keep_layout=False).select(
        "doc_id", "n_words", "n_removed", F.col("text").alias("kept_text")
    )


def documents_without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns and what is kept of their texts.

    Texts that lose nothing stay as they are; ``n_chars``, if there is such a column, follows
    the text.
    """
    out = _removed(docs, window, keep_layout=True).drop("n_words", "n_removed")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _removed(docs: DataFrame, window: int, keep_layout: bool) -> DataFrame:
    """The columns of the documents, the text less its repeated words, n_words and n_removed."""
    spark = docs.sparkSession
    stage = Stage(spark, "substrings")
    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = {c: f"_c{k}" for k, c in enumerate(carried)}
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", *[docs[f"`{c}`"].alias(n) for c, n in names.items()]
    )
    kinds = "".join(f", {n} {docs.schema[n].dataType.simpleString()}" for n in names.values())
    sketch = stage.table(merged_sketch(partial_sketches(docs, window)), "sketch")
    totals = sketch.agg(F.sum("windows")).first()[0] or 0
    bits = np.zeros((SEGMENTS, (1 << SEGMENT_BITS) // 8), dtype=np.uint8)
    # at most 2^CELL_BITS / 8 bytes, whatever the input
    for row in sketch.filter("segment >= 0").select("segment", "bits").toLocalIterator():
        bits[row["segment"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast(bits.reshape(-1))
    del bits
    parts = max(8, totals // PART_WINDOWS)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(32, size // GROUP_OF_TEXT)

    removals = compared(candidate_blocks(docs, shared, parts, groups, window), parts, groups)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc_id")
            known_id = doc.fill_null(0).to_numpy()
            group = np.where(doc.is_null().to_numpy(zero_copy_only=False), np.arange(len(doc)) % groups, group_of(known_id, groups))
            yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns], ["group", *batch.schema.names])

    grouped = docs.mapInArrow(number, "group long, doc_id long, text string" + kinds)

    def remove(texts: pa.Table, found: pa.Table) -> pa.Table:
        doc = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x.as_buffer(), np.int64) for x in found.column("docs"))])
        at = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(x.as_buffer(), np.uint32) for x in found.column("at"))])
        order = np.argsort(doc, kind="stable")
        doc, at = doc[order], at[order].astype(np.int64)
        ids = texts.column("doc_id").to_pylist()
        wanted = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        low, high = np.searchsorted(doc, wanted, "left"), np.searchsorted(doc, wanted, "right")
        text, n_words, n_removed = [], [], []
        for k, value in enumerate(texts.column("text")):
            starts = at[low[k] : high[k]] if ids[k] is not None else at[:0]
            kept, n, gone = kept_words(value.as_py(), starts, window, keep_layout)
            text.append(kept)
            n_words.append(n)
            n_removed.append(gone)
        columns = {"doc_id": texts.column("doc_id"), "text": pa.array(text, pa.string())}
        columns |= {n: texts.column(n) for n in names.values()}
        return pa.table(columns | {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())})

    done = grouped.groupBy("group").cogroup(removals.groupBy("group")).applyInArrow(
        remove, f"doc_id long, text string{kinds}, n_words long, n_removed long"
    )
    return done.select("doc_id", "text", *[F.col(n).alias(c) for c, n in names.items()], "n_words", "n_removed")
