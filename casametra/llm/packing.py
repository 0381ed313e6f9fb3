"""Best-fit packing of token pieces into sequences of a fixed number of tokens.

Texts are encoded and cut on Spark; only the histogram of piece lengths, with at most
one row per length up to the capacity, comes to the driver. Over it runs the
configuration linear program: a configuration is a multiset of lengths that fits one
sequence, and few sequences shall cover all pieces. Multiplicative weights price the
lengths by how far they are covered, and a knapsack dynamic program finds the best
configuration at these prices. The fractional counts are rounded to whole sequences
that the remaining pieces can fill; what is left over is solved again, and at last
placed by best fit. All of this works on counts, so its cost depends on the capacity,
not on the number of documents.

Each piece then looks up its place by its length and its rank among the pieces of that
length. Ranks come from counts by (length, salt), so that a length which many pieces
share is not one sort.

Defined cases: a null or empty text is one piece with the end token alone; repeated
rows are packed each; a null doc_id is packed like others; no documents, no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.tokens import default_vocabulary, encode

#: Steps of the multiplicative weights in one solution of the linear program.
STEPS = 64
#: Lengths that take their best completion in one step.
WIDTH = 64
#: Solutions; each works on what the one before left over, with more room allowed.
SOLUTIONS = 3
#: How sharply coverage lowers a length's price.
RATE = 1.0
#: Exponent of the first prices; above 1 it favours few long pieces.
BIAS = 6.0
#: Parts of each length when ranks are dealt.
SALTS = 1024

Config = tuple[tuple[int, int], ...]


# --- the plan, on counts ----------------------------------------------------


class Pricing:
    """The knapsack table for given prices: the most valuable multiset for every room."""

    def __init__(self, value: np.ndarray, most: np.ndarray, capacity: int):
        self.items: list[tuple[int, int]] = []
        for length in np.flatnonzero(most > 0).tolist():
            left, step = int(min(most[length], capacity // length)), 1
            while left > 0:
                take = min(step, left)
                self.items.append((length, take))
                left, step = left - take, step * 2
        self.best = np.zeros(capacity + 1)
        self.kept = np.zeros((len(self.items), capacity + 1), dtype=bool)
        for k, (length, take) in enumerate(self.items):
            size = length * take
            other = self.best[:-size] + value[length] * take
            np.greater(other, self.best[size:], out=self.kept[k, size:])
            np.maximum(self.best[size:], other, out=self.best[size:])

    def config(self, room: int) -> dict[int, int]:
        """The multiset found for this room."""
        counts: dict[int, int] = {}
        k = len(self.items)
        while room > 0 and k > 0:
            column = self.kept[:k, room]
            k = k - 1 - int(np.argmax(column[::-1])) if column.any() else 0
            if k == 0 and not self.kept[0, room]:
                break
            length, take = self.items[k]
            counts[length] = counts.get(length, 0) + take
            room -= length * take
        return counts


def fractional_solution(left: np.ndarray, capacity: int) -> list[tuple[Config, float]]:
    """Configurations with fractional counts that cover the pieces in ``left`` about once.

    Prices start a little more than proportional to the length, so that few long pieces
    are preferred to many short ones, and rise where coverage lags. Each pricing gives
    the best completion of every length; the dearest lengths take theirs.
    """
    lengths = np.arange(len(left))
    open_ = left.astype(float)
    present = left > 0
    base = (lengths / capacity) ** BIAS
    found: list[tuple[Config, float]] = []
    for step in range(STEPS):
        covered = 1 - open_ / np.maximum(left, 1)
        lag = (step + 1) / STEPS - covered
        value = base * np.exp(RATE * lag)
        most = np.floor(open_ + 1e-9).astype(np.int64)
        pricing = Pricing(value, most, capacity)
        wanted = np.flatnonzero(present & (most > 0) & (lag > 0))[::-1]
        for length in wanted[np.argsort(-lag[wanted], kind="stable")][: WIDTH].tolist():
            if open_[length] < 1 - 1e-9:
                continue
            counts = pricing.config(capacity - length)
            counts[length] = counts.get(length, 0) + 1
            units = min(max(1.0, left[length] * lag[length]), *(open_[x] / n for x, n in counts.items()))
            if units < 1 - 1e-9:
                continue
            for x, n in counts.items():
                open_[x] -= units * n
            found.append((tuple(sorted(counts.items(), reverse=True)), units))
    return found


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[Config, int]]:
    """Longest first, each into the fullest sequence that it fits; equal sequences go together."""
    by_room: dict[int, list[tuple[Config, int]]] = {}
    for length in np.flatnonzero(left)[::-1]:
        length, n = int(length), int(left[length])
        while n:
            room = next((r for r in range(length, capacity) if by_room.get(r)), capacity)
            config, copies = by_room[room].pop() if room < capacity else ((), n)
            fits = room // length
            full = min(copies, n // fits)
            if full < copies and room < capacity:
                by_room[room].append((config, copies - max(full, 1)))
                if not by_room[room][-1][1]:
                    by_room[room].pop()
            take, used = (fits, full) if full else (n, 1)
            by_room.setdefault(room - take * length, []).append((config + ((length, take),), used))
            n -= take * used
    return [x for group in by_room.values() for x in group]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Configurations with whole counts that hold exactly the pieces counted by length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[Config, int]] = [(((capacity, 1),), int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    lengths = np.arange(capacity + 1)
    for k in range(SOLUTIONS):
        before = int(lengths @ left)
        if not before:
            break
        slack = (1 << k) - 1
        for config, units in fractional_solution(left, capacity):
            # sequences with more room than this are for a later solution, or for best fit
            if sum(length * n for length, n in config) < capacity - slack:
                continue
            copies = min(int(np.ceil(units - 1e-9)), *(int(left[length]) // n for length, n in config))
            if copies > 0:
                for length, n in config:
                    left[length] -= copies * n
                out.append((config, copies))
    return out + best_fit(left, capacity)


def places(configs: list[tuple[Config, int]]) -> np.ndarray:
    """Runs of ranks: length, first rank, first sequence, pieces of it in a sequence, offset."""
    rows, rank, sequence = [], {}, 0
    for config, copies in configs:
        offset = 0
        for length, n in config:
            start = rank.get(length, 0)
            rows.append((length, start, sequence, n, offset))
            rank[length] = start + n * copies
            offset += length * n
        sequence += copies
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


# --- on Spark ---------------------------------------------------------------


def pieces(docs: DataFrame, capacity: int = 1024, end: int = 2, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Encoded texts cut into pieces: doc_id, piece, start, length, ids_crc32 (and ids).

    A text longer than the capacity is cut from its end, so that only its first piece is shorter.
    """
    path = path or default_vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(batch.column(1)):
                tokens = np.append(encode(path, text.as_py()), [end]).astype("<u4")
                low, high, n = 0, (len(tokens) - 1) % capacity + 1, 0
                while low < len(tokens):
                    part = tokens[low:high]
                    row.append(k)
                    piece.append(n)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        ids.append(part.astype(np.int32))
                    low, high, n = high, high + capacity, n + 1
            columns = [
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, capacity: int = 1024, end: int = 2, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence each goes to and its offset there."""
    stage = Stage(docs.sparkSession, "packing")
    cut = stage.table(pieces(docs, capacity, end, path, keep_ids), "pieces")
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)))
    parts = stage.table(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")), "parts")
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = places(plan(counts, capacity))
    key = (runs[:, 0] << 48) + runs[:, 1]

    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")
    first = parts.select("length", "_salt", before.alias("_first"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")
    ranked = salted.join(first, ["length", "_salt"]).withColumn("_rank", F.col("_first") + F.row_number().over(order) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            _, start, sequence, n, offset = runs[np.searchsorted(key, (length << 48) + rank, side="right") - 1].T
            nth = rank - start
            kept = batch.drop_columns(["_rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence + nth // n), pa.array(offset + length * (nth % n))],
                [*kept.schema.names, "sequence_id", "offset"],
            )

    return ranked.select(*cut.columns, "_rank").mapInArrow(
        place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces with their ids: sequence_id, ids, length."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"), F.sum("length").alias("length")
    )
