"""MinHash near-duplicate groups with SuperMinHash signatures.

A document's set is that of its two-word shingles (A-Z lower-cased). SuperMinHash gives
each element a random order of the signature's slots and ranks that grow along it, so
that slots are met by different elements: ranks of one element are correlated, and the
variance is lower than with independent hashes. Level ``j`` offers each element's
``j``-th slot the rank ``j + r``; once every slot of a document is below the next
level, no later level can change it, and the document is done. Levels are worked
through for all elements of many documents at once.

Steps:

1. One row per distinct set, under a 128-bit digest, keeps the smallest id. A group of
   equal documents is one row from here on.
2. Signatures are cut into bands; equal bands make a bucket. Each member is paired with
   the bucket's smallest id (no pairs within the bucket), and the pairs are confirmed on
   the full sets. Union-find over the confirmed pairs gives first groups.
3. A bucket may still hold members of different groups. The signatures of its members
   outside the group of its smallest id are held against those of its other groups, block
   by block; pairs that set sizes allow and whose signatures agree in ``ALIKE`` of the
   slots are confirmed too. So every pair in a bucket is tested unless both are in
   one group already, and only pairs that resemble each other leave a task.

With 32 bands of 4 slots, a pair at a similarity of 0.8 shares a bucket with a probability
of 1 - 5e-8; its signatures agree in fewer slots than ``ALIKE`` with one of about 1e-7.

Defined cases: null, empty and blank texts have an empty set and link with nothing; fewer
words than a shingle make one element, all of them; rows without doc_id link by their
set like others but have no id to give, so a group of such rows alone has a null
component; repeated rows are in one group and kept alike; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.words import Words, mix, row_groups, text_windows, words_of

BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
#: Share of equal slots from which a pair is confirmed on the full sets.
ALIKE = 0.62
#: Members of a bucket that are held against each other in one task, about.
CELL = 2048
#: Pairs of signatures compared at a time.
PAIRS = 50_000
#: Pairs whose sets share one set of bit maps.
BIT_PAIRS = 16_384
#: Elements whose levels are worked through together.
ELEMENTS = 100_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- sets -------------------------------------------------------------------


def lowered(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased, byte by byte."""
    from casametra.llm.words import text_bytes

    data, offsets = text_bytes(texts)
    return pa.Array.from_buffers(
        pa.large_binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[data])]
    )


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, Words]:
    """Distinct shingle hashes of each text, ordered by text and hash, and the text of each."""
    words = words_of(lowered(texts))
    n = len(texts)
    hashes, at = text_windows(words, n, size)
    text = words.text[at]
    first = words.first(n)
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if len(short):
        whole = np.array([_sequence_hash(words.hash[first[k] : first[k + 1]]) for k in short], dtype=np.uint64)
        hashes, text = np.r_[hashes, whole], np.r_[text, short]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    if len(hashes):
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])]
        hashes, text = hashes[new], text[new]
    return hashes, text, words


def _sequence_hash(hashes: np.ndarray) -> int:
    """Hash of a whole, short sequence of words."""
    odd = np.arange(1, 2 * len(hashes), 2, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return int(mix((mix(hashes) * odd).sum(dtype=np.uint64, keepdims=True))[0])


# --- signatures -------------------------------------------------------------


def _uniform(seed: np.ndarray) -> np.ndarray:
    return (seed >> np.uint64(11)).astype(np.float64) * 2.0**-53


def super_minhash(elements: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (n x slots) of sets given as elements and their owners.

    Elements are in order of owner. Sets without elements keep infinite ranks.
    """
    out = np.full((n, slots), np.inf)
    counts = np.bincount(owner, minlength=n)
    ends = np.cumsum(counts)
    low = 0
    while low < n:
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + ELEMENTS, side="right")))
        part = slice(before, ends[high - 1])
        _levels(elements[part], owner[part] - low, out[low:high], slots)
        low = high
    return out


def _levels(elements: np.ndarray, owner: np.ndarray, out: np.ndarray, slots: int) -> None:
    orders: np.ndarray | None = None
    flat = out.reshape(-1)
    golden = np.uint64(0x9E3779B97F4A7C15)
    for level in range(slots):
        if not len(elements):
            return
        with np.errstate(over="ignore"):
            seed = mix(elements + golden * np.uint64(2 * level + 1))
            rank = level + _uniform(mix(seed + golden))
        pick = level + (_uniform(seed) * (slots - level)).astype(np.int64)
        if level == 0:
            slot = pick
        else:
            rows = np.arange(len(elements))
            slot = orders[rows, pick].astype(np.int64)
            orders[rows, pick] = orders[rows, level]
        np.minimum.at(flat, owner * slots + slot, rank)
        # a document whose slots are all below the next level is done
        open_ = out.max(axis=1) > level + 1
        keep = open_[owner]
        if level == 0:
            elements, owner, first = elements[keep], owner[keep], pick[keep]
            orders = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
            orders[np.arange(len(elements)), first] = 0
        elif not keep.all():
            elements, owner, orders = elements[keep], owner[keep], orders[keep]


# --- union-find grouping ----------------------------------------------------


def components(edges: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Smallest node reachable from each node of the edges (a, b): node, root.

    Each round hangs every root below the smallest root that one of its nodes is joined to,
    and then follows roots (union by smallest id, path halving), until nothing changes. The tables of a
    round are written, so a lost executor costs one round's task at most.
    """
    both = stage.table(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges"
    )
    roots = stage.table(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), f"{name}-0")
    step = 0
    while True:
        step += 1
        # the hook of a root: the smallest root that one of its members sees
        seen = roots.select(F.col("node").alias("b"), F.col("root").alias("_near"))
        hooks = (
            both.join(roots.withColumnRenamed("node", "a"), "a").join(seen, "b")
            .groupBy("root").agg(F.min("_near").alias("_hook"))
        )
        hooked = roots.join(hooks, "root").select(
            "node", F.least("root", "_hook").alias("root"), (F.col("_hook") < F.col("root")).alias("_moved")
        )
        hooked = stage.table(hooked, f"{name}-h{step}")
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        roots = stage.table(hooked.join(jump, "root", "left").select("node", F.least("root", F.coalesce("_up", "root")).alias("root")), f"{name}-{step}")
        if not hooked.agg(F.max("_moved")).first()[0]:
            return roots


# --- the operator -----------------------------------------------------------


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, n_shingles, digest of the set, band hashes, one byte of each slot."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            n = batch.num_rows
            hashes, text, _ = shingle_sets(batch.column("text"), size)
            count = np.bincount(text, minlength=n)
            with np.errstate(over="ignore"):
                digest = np.zeros((n, 2), dtype=np.uint64)
                for k, salt in enumerate((0x51, 0x7F4A7C15)):
                    sums = np.r_[np.uint64(0), np.cumsum(mix(hashes + np.uint64(salt)), dtype=np.uint64)]
                    ends = np.cumsum(count)
                    digest[:, k] = mix(sums[ends] - sums[ends - count])
                ranks = super_minhash(hashes, text, n)
                bits = ranks.view(np.uint64).reshape(n, BANDS, ROWS)
                bands = np.zeros((n, BANDS), dtype=np.uint64)
                for r in range(ROWS):
                    bands = mix(bands + bits[:, :, r] + np.uint64(2 * r + 1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1).view(np.int64)))
            prints = (mix(bits.reshape(n, SLOTS)) >> np.uint64(56)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count.astype(np.int64)), pa.array(digest[:, 0].view(np.int64)),
                 pa.array(digest[:, 1].view(np.int64)), lists, pa.array([x.tobytes() for x in prints], pa.binary())],
                ["doc_id", "n_shingles", "_d1", "_d2", "_bands", "_print"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, n_shingles long, _d1 long, _d2 long, _bands array<long>, _print binary"
    )


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, set()
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("_left").to_pylist(), batch.column("_right").to_pylist(), strict=True):
                x = exact_set(left, size)
                if right != last:
                    last, y = right, exact_set(right, size)
                both = len(x & y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_left"))
    right = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_right"))
    return pairs.select("a", "b").join(left, "b").join(right, "a").select("a", "b", "_left", "_right").mapInArrow(
        check, "a long, b long"
    )


def exact_set(text: str, size: int) -> set:
    words = text.encode().translate(_LOWER.tobytes()).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


CELL_KEY = ("band", "value", "piece", "chunk")
_MEMBER = "band int, value long, piece int, chunk int, node long, n long, root long, outside boolean, asks boolean"


def cells(members: DataFrame) -> DataFrame:
    """Members of buckets with several groups, dealt to cells of a bounded size.

    ``members``: band, value, node, n, root, outside. A pair to test has one side outside
    the group of its bucket's smallest id; that side asks, in each piece of the bucket.
    """
    key = ["band", "value"]
    sizes = members.groupBy(*key).agg(F.count("*").alias("_all"), F.count_if("outside").alias("_out"))
    sizes = sizes.filter("_all > 1 AND _out > 0").select(
        *key, F.ceil(F.col("_all") / CELL).cast("int").alias("_pieces"), F.ceil(F.col("_out") / CELL).cast("int").alias("_chunks")
    )
    rows = members.join(sizes, key)
    own = F.xxhash64("node")
    partners = rows.select(
        *members.columns, F.lit(False).alias("asks"), F.pmod(own, "_pieces").cast("int").alias("piece"),
        F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("chunk"),
    )
    asking = rows.filter("outside").select(
        *members.columns, F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("piece"),
        F.pmod(own, "_chunks").cast("int").alias("chunk"),
    )
    return asking.unionByName(partners)


def by_cell(rows: DataFrame, work, schema: str) -> DataFrame:
    """Whole cells handed to ``work(table, first rows of the cells)``, which yields batches."""
    dealt = rows.repartition(*CELL_KEY).sortWithinPartitions(*CELL_KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            starts = _cells(table)
            if starts[-1:].any():
                yield from work(table.slice(0, starts[-1]), starts[:-1])
            left = table.slice(starts[-1]) if len(starts) else None
        if left is not None and left.num_rows:
            yield from work(left, np.zeros(1, dtype=np.int64))

    return dealt.mapInArrow(run, schema)


def _cells(table: pa.Table) -> np.ndarray:
    """First row of each cell of sorted rows."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in CELL_KEY:
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _pairs_of(table: pa.Table, starts: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (x, y) of each cell whose pair is to be tested, some at a time."""
    node, n, root = (table.column(c).to_numpy() for c in ("node", "n", "root"))
    asks, outside = (table.column(c).to_numpy() for c in ("asks", "outside"))
    number = np.zeros(table.num_rows, dtype=np.int64)
    number[starts[1:]] = 1
    number = np.cumsum(number)
    partners = np.flatnonzero(~asks)
    first = np.searchsorted(number[partners], np.arange(len(starts) + 1))
    rows = np.flatnonzero(asks)
    many = np.diff(first)[number[rows]]
    ends = np.cumsum(many)
    low = 0
    while low < len(rows):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + PAIRS, side="right")))
        part, count = rows[low:high], many[low:high]
        x = np.repeat(part, count)
        nth = np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
        y = partners[np.repeat(first[number[part]], count) + nth]
        near = (root[x] != root[y]) & ((node[x] < node[y]) | ~outside[y])
        near &= 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        yield x[near], y[near]
        low = high


def unequal_bytes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of bytes in which rows of 64-bit words differ."""
    low, high = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
    apart = x ^ y
    marks = (((apart & low) + low) | apart) & high
    return np.bitwise_count(marks).sum(axis=1, dtype=np.int64)


def resembling(members: DataFrame, prints: DataFrame, percent: int) -> DataFrame:
    """Members of cells whose signature agrees with that of a partner in ``ALIKE`` of the slots."""

    def compare(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        prints = np.frombuffer(b"".join(table.column("_print").to_pylist()), dtype=np.uint64).reshape(-1, SLOTS // 8)
        met = np.zeros(table.num_rows, dtype=bool)
        for x, y in _pairs_of(table, starts, percent):
            alike = SLOTS - unequal_bytes(prints[x], prints[y]) >= ALIKE * SLOTS
            met[x[alike]] = met[y[alike]] = True
        yield from table.drop_columns(["_print"]).filter(pa.array(met)).combine_chunks().to_batches()

    columns = [f.split(" ")[0] for f in _MEMBER.split(", ")]
    return by_cell(cells(members).join(prints, "node").select(*columns, "_print"), compare, _MEMBER)


def hashed_sets(texts: DataFrame, size: int) -> DataFrame:
    """32-bit hashes of each text's shingles, as a binary column: node, set.

    Equal shingles have equal hashes, so what sets have in common is never too small.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            shingles, text, _ = shingle_sets(batch.column("text"), size)
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            short = (shingles >> np.uint64(32)).astype(np.uint32)
            sets = [short[ends[k] : ends[k + 1]].tobytes() for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], ["node", "set"])

    return texts.select(F.col("doc_id").alias("node"), "text").mapInArrow(hashed, "node long, set binary")


def overlapping(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of cells whose hashed sets are similar enough; a superset of the true ones.

    The sets of a block of rows are bit maps over their own shingles, so a pair costs a few
    operations on words, and only pairs that are similar enough leave the task.
    """

    def compare(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        sets = [np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in table.column("set")]
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        for x, y in _pairs_of(table, starts, percent):
            for low in range(0, len(x), BIT_PAIRS):
                i, j = x[low : low + BIT_PAIRS], y[low : low + BIT_PAIRS]
                rows, at = np.unique(np.r_[i, j], return_inverse=True)
                shingles, column = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
                owner = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
                width = len(shingles) // 64 + 1
                words = np.zeros(len(rows) * width, dtype=np.uint64)
                np.bitwise_or.at(words, owner * width + (column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
                words = words.reshape(-1, width)
                common = np.empty(len(i), dtype=np.int64)
                for part in range(0, len(i), 512):
                    p = slice(part, part + 512)
                    common[p] = np.bitwise_count(words[at[: len(i)][p]] & words[at[len(i) :][p]]).sum(axis=1)
                good = 100 * common >= percent * (n[i] + n[j] - common)
                a, b = node[i[good]], node[j[good]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return by_cell(members.join(sets, "node").select(*members.columns, "set"), compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id of its group) and kept."""
    stage = Stage(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage.table(signatures(docs, size), "signed")
    sets = stage.table(
        signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        .groupBy("_d1", "_d2").agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n")),
        "sets",
    )
    # bands of one row per set: that of its smallest id (repeated rows of an id are one)
    members = stage.table(
        signed.select("doc_id", "_d1", "_d2", "_bands").join(
            sets.select("_d1", "_d2", F.col("node").alias("doc_id"), "n"), ["doc_id", "_d1", "_d2"]
        ).dropDuplicates(["doc_id", "_d1", "_d2"])
        .select(F.col("doc_id").alias("node"), "n", F.posexplode("_bands").alias("band", "value")),
        "members",
    )
    buckets = members.groupBy("band", "value").agg(F.min("node").alias("first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    full = stage.table(members.join(buckets, ["band", "value"]), "buckets")

    found = stage.table(
        full.filter(F.col("node") != F.col("first")).select("node", "n", "first").distinct()
        .join(sets.select(F.col("node").alias("first"), F.col("n").alias("_m")), "first")
        .filter(size_allows(F.col("n"), F.col("_m"), percent))
        .select(F.col("first").alias("a"), F.col("node").alias("b")),
        "allowed",
    )
    nodes = full.select(F.col("node").alias("doc_id")).distinct()
    texts = stage.table(docs.join(nodes, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    edges = stage.table(confirmed(found, texts, size, percent), "edges")
    groups = components(edges, stage, "first")

    # members outside the group of their bucket's smallest id, against the rest of the bucket
    labelled = full.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first_root = groups.select(F.col("node").alias("first"), F.col("root").alias("_first_root"))
    labelled = labelled.join(first_root, "first", "left").filter(F.col("node") != F.col("first"))
    labelled = stage.table(
        labelled.withColumn("outside", F.col("root") != F.coalesce("_first_root", "first")).drop("_first_root", "first"), "labelled"
    )
    prints = signed.select(F.col("doc_id").alias("node"), "_print").dropDuplicates(["node"])
    alike = stage.table(resembling(labelled, prints, percent), "alike")
    involved = alike.select(F.col("node").alias("doc_id")).distinct()
    short = stage.table(hashed_sets(texts.join(involved, "doc_id", "left_semi"), size), "short")
    more = stage.table(overlapping(alike, short, percent).distinct().join(found, ["a", "b"], "left_anti"), "more")
    further = stage.table(confirmed(more, texts, size, percent), "further")
    # the further pairs join groups, so their roots are the nodes of a small second round
    root_of = groups.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    joined = further.join(groups.withColumnRenamed("node", "a"), "a", "left").join(root_of, "b", "left").select(
        F.coalesce("root", "a").alias("a"), F.coalesce("_rb", "b").alias("b")
    )
    merged = components(joined, stage, "all")
    upper = merged.select(F.col("node").alias("_old"), F.col("root").alias("_new"))
    lone = merged.join(groups.select("node"), "node", "left_anti")
    groups = groups.join(upper, F.col("root") == F.col("_old"), "left").select(
        "node", F.coalesce("_new", "root").alias("root")
    ).unionByName(lone)

    by_set = sets.join(groups, "node", "left").select("_d1", "_d2", F.coalesce("root", "node").alias("_root"))
    return signed.join(by_set, ["_d1", "_d2"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("_root")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, that stand for their group: its smallest id.

    Of repeated rows one stays. Rows without an id can't be told apart and all stay.
    """
    kept = near_duplicates(docs, size, percent).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    known = docs.filter(F.col("doc_id").isNotNull()).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return known.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def size_allows(n: Column, m: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)
