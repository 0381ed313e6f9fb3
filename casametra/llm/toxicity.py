"""Toxicity by a small convolutional network over hashed word embeddings.

A word is lower-cased; its embedding is the sum of four rows of one table, found by
two hashes of the whole word and one of each of two beginnings, so that neither a collision nor
an unseen ending decides alone. Filters one, two and three words wide slide over the whole
text; of each, the greatest response counts, wherever it is. A logistic unit weighs
them.

The network learns from all labelled documents, whole, in rounds: the documents are dealt
to shards by a hash of their ids, of each shard a task makes a network by gradients
through the places of greatest response, and the next round begins with the mean of
these networks. A task holds at most ``HELD_WORDS`` words or one document. A fifth of the
documents is kept back from learning if that is enough of both labels. On all labelled
documents, those kept back among them, the scores are moved so that ``CUT`` divides the
labels best, and a threshold is found for each language that has enough of both labels.
Among the learned ones the network mostly leaves a gap, in which those kept back decide. The language
takes no part in a score, only in the choice of the threshold.

Defined cases: null, empty and blank texts and texts without letters or digits have no
response and so all the same score; without labelled texts of both labels every score is
0; a null doc_id is never learned from; repeated rows score alike; a document with two
labels counts once with each; a null or unlearned lang has the common threshold; no rows,
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casametra.llm.common import Stage
from casametra.llm.words import mix, row_groups, text_bytes, word_hashes

#: Labelled documents that a copy of the network learns from, at least, if there are as many.
SHARD = 4096
#: Rounds of learning; steps of one copy in all of them, about, at least, and passes for them at most.
ROUNDS, STEPS, PASSES = 3, 600, 40
#: Bits of the map of labelled ids: 4 MB.
ID_BITS = 1 << 25
#: Words of learned documents held at a time.
HELD_WORDS = 1 << 22
#: Rows of the embedding table and their size: 8 MB.
ROWS, SIZE = 1 << 18, 8
#: Words under a filter, and filters of each width.
WIDTHS, FILTERS = (1, 2, 3), 8
#: Bytes of a word's beginnings.
BEGINNINGS = (4, 6)
#: The score from which a document counts as toxic.
CUT = 0.3
#: Documents in a step.
BATCH = 32
#: Rows of the table that are averaged together.
BLOCK = 4096
#: Logits are counted in steps of a part of 1, up to a size.
LOGIT_STEPS, MOST_LOGIT = 1024, 32
#: Labelled documents of either label that a language's own threshold needs.
ENOUGH = 10
#: Documents of either label kept back, without which all are learned from.
ENOUGH_BACK = 30
#: Words worked through at a time.
CHUNK = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("a") : ord("z") + 1] = True
_IN_WORD[ord("0") : ord("9") + 1] = True
_IN_WORD[128:] = True


class Network(NamedTuple):
    """Embeddings, filters (by width and place under the filter), their biases, output unit."""

    table: np.ndarray
    filters: dict[int, np.ndarray]
    biases: np.ndarray
    output: np.ndarray
    constant: float


class Model(NamedTuple):
    network: Network
    thresholds: dict[str, float]


def word_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the table for each word, four a word, and the text that it is in."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    solid = _IN_WORD[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | first[1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(offsets, start, side="right") - 1
    whole = word_hashes(data, start, end, seed=21)
    begun = [word_hashes(data, start, np.minimum(end, start + n), seed=22) for n in BEGINNINGS]
    hashes = np.stack([whole, mix(whole ^ np.uint64(0x9E3779B97F4A7C15)), *begun], axis=1)
    return (hashes % np.uint64(ROWS)).astype(np.int32), owner


# --- the network ------------------------------------------------------------


def new_network(rng: np.random.Generator) -> Network:
    return Network(
        rng.normal(0, 0.05, (ROWS, SIZE)).astype(np.float32),
        {w: rng.normal(0, 0.4, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS},
        np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32),
        np.abs(rng.normal(0.5, 0.1, len(WIDTHS) * FILTERS)).astype(np.float32),
        -1.0,
    )


def _times(vectors: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A product whose rows do not depend, in the last bit, on the rows around them."""
    out = vectors[:, :1] * weight[0]
    for k in range(1, len(weight)):
        out += vectors[:, k : k + 1] * weight[k]
    return out


def responses(network: Network, vectors: np.ndarray, owner: np.ndarray, n: int, times=_times) -> np.ndarray:
    """Responses of all filters at the first ``n`` words; beyond its text a filter sees zeros."""
    parts = []
    for width, weight in network.filters.items():
        out = times(vectors[:n], weight[0])
        for k in range(1, width):
            upto = min(n, len(vectors) - k)
            if upto <= 0:
                continue
            out[:upto] += times(vectors[k : k + upto], weight[k]) * (owner[k : k + upto] == owner[:upto])[:, None]
        parts.append(out)
    return np.concatenate(parts, axis=1) + network.biases


def pooled(network: Network, rows: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """The greatest response of each filter in each text, zero at least."""
    out = np.zeros((n_texts, len(network.biases)), dtype=np.float32)
    for low in range(0, len(rows), CHUNK):
        n = min(CHUNK, len(rows) - low)
        seen = slice(low, low + n + max(WIDTHS) - 1)
        vectors = network.table[rows[seen]].sum(axis=1)
        found = responses(network, vectors, owner[seen], n)
        of = owner[low : low + n]
        begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        out[of[begins]] = np.maximum(out[of[begins]], np.maximum.reduceat(found, begins, axis=0))
    return out


def logits(network: Network, rows: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    return (pooled(network, rows, owner, n_texts).astype(np.float64) * network.output).sum(axis=1) + network.constant


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def strongest(network: Network, rows: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and size of the greatest response of each filter in each text; a size of 0 where none is above."""
    place = np.zeros((n_texts, len(network.biases)), dtype=np.int64)
    best = np.zeros((n_texts, len(network.biases)), dtype=np.float32)
    filters = np.arange(len(network.biases))
    for low in range(0, len(rows), CHUNK):
        n = min(CHUNK, len(rows) - low)
        seen = slice(low, low + n + max(WIDTHS) - 1)
        found = responses(network, network.table[rows[seen]].sum(axis=1), owner[seen], n, np.matmul)
        of = owner[low : low + n]
        begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        for a, b in zip(begins, np.r_[begins[1:], n], strict=True):
            at = a + found[a:b].argmax(axis=0)
            k, value = of[a], found[at, filters]
            better = value > best[k]
            place[k, better], best[k, better] = low + at[better], value[better]
    return place, best


def gradients(network: Network, rows: np.ndarray, owner: np.ndarray, toxic: np.ndarray, share: np.ndarray | None = None):
    """Gradients of the cross entropy of documents, their mean or their sum by ``share``.

    For the filters by width, biases, output, constant, and, for the table, the rows and
    their gradients.
    """
    share = 1 / len(toxic) if share is None else share
    bounds = np.searchsorted(owner, np.arange(len(toxic) + 1))
    place, best = strongest(network, rows, owner, len(toxic))
    error = ((sigmoid(best @ network.output + network.constant) - toxic) * share).astype(np.float32)
    at_filter = error[:, None] * network.output * (best > 0)
    of_filters, touched, steps = {}, [], []
    for k, (width, weight) in enumerate(network.filters.items()):
        part = slice(k * FILTERS, (k + 1) * FILTERS)
        of_filters[width] = np.zeros_like(weight)
        for j in range(width):
            word = np.minimum(place[:, part] + j, len(rows) - 1)
            inside = (place[:, part] + j < bounds[1:, None]) & (best[:, part] > 0)
            step = np.where(inside, at_filter[:, part], 0)
            of_filters[width][j] = np.einsum("df,dfs->sf", step, network.table[rows[word]].sum(axis=2))
            touched.append(rows[word[inside]])
            steps.append(step[inside][:, None] * weight[j].T[np.nonzero(inside)[1]])
    table_rows = np.concatenate(touched).reshape(-1)
    table_steps = np.repeat(np.concatenate(steps), rows.shape[1], axis=0)
    return of_filters, at_filter.sum(axis=0), best.T @ error, float(error.sum()), table_rows, table_steps


class Training:
    """A network with the state of its training: Adam's for the weights, Adagrad's for the table."""

    def __init__(self, table: np.ndarray, history: np.ndarray, weights: np.ndarray):
        #: ``weights`` has the weights in one row, Adam's two moments and the number of steps.
        self.table, self.history, self.weights = table, history, weights

    @classmethod
    def new(cls, seed: int = 12) -> Training:
        net = new_network(np.random.default_rng(seed))
        weights = np.concatenate([*(net.filters[w].ravel() for w in WIDTHS), net.biases, net.output, [net.constant]])
        rows = np.zeros((4, len(weights)))
        rows[0] = weights
        return cls(net.table, np.zeros(ROWS, dtype=np.float32), rows)

    def copy(self) -> Training:
        return Training(self.table.copy(), self.history.copy(), self.weights.copy())

    def network(self) -> Network:
        weights, at, filters = self.weights[0].astype(np.float32), 0, {}
        for w in WIDTHS:
            filters[w] = weights[at : at + w * SIZE * FILTERS].reshape(w, SIZE, FILTERS)
            at += filters[w].size
        n = len(WIDTHS) * FILTERS
        return Network(self.table, filters, weights[at : at + n], weights[at + n : at + 2 * n], float(weights[-1]))

    def step(self, documents: list[np.ndarray], toxic: np.ndarray, times: np.ndarray) -> None:
        """One step by a batch with each document so many times, at most ``CHUNK`` words or one document at a time."""
        network, gradient, touched, steps = self.network(), 0.0, [], []
        total = np.cumsum([len(d) for d in documents])
        if not total[-1]:
            return
        for part in np.split(np.arange(len(documents)), np.flatnonzero(np.diff(total // CHUNK)) + 1):
            rows = np.concatenate([documents[k] for k in part])
            if len(rows):
                owner = np.repeat(np.arange(len(part)), [len(documents[k]) for k in part])
                of_filters, *of_units, change, at, step = gradients(network, rows, owner, toxic[part], times[part] / times.sum())
                gradient = gradient + np.concatenate([*(of_filters[w].ravel() for w in WIDTHS), *of_units, [change]])
                touched.append(at)
                steps.append(step)
        weights, first, second, n = self.weights
        n += 1
        first[...] = 0.9 * first + 0.1 * gradient
        second[...] = 0.999 * second + 0.001 * gradient**2
        weights -= 0.01 * (first / (1 - 0.9**n)) / (np.sqrt(second / (1 - 0.999**n)) + 1e-8)
        output = weights[-1 - len(network.output) : -1]
        output[...] = np.maximum(output, 0)
        weights[-1] = min(weights[-1], -0.5)
        # the table by Adagrad, in the rows that the step touches
        touched, inverse = np.unique(np.concatenate(touched), return_inverse=True)
        total = np.zeros((len(touched), SIZE), dtype=np.float32)
        np.add.at(total, inverse, np.concatenate(steps))
        self.history[touched] += (total**2).mean(axis=1)
        self.table[touched] -= 0.1 * total / (np.sqrt(self.history[touched])[:, None] + 1e-6)

    def learn(self, documents: list[np.ndarray], toxic: np.ndarray, passes: int, seed: tuple[int, ...]) -> None:
        """Learn every document ``passes`` times at least, given as the table rows of its words.

        Each step has as many documents of one label as of the other; those of the rarer
        label come again in turn.
        """
        rng = np.random.default_rng(seed)
        sides = [side for label in (0, 1) if len(side := np.flatnonzero(toxic == label))]
        n_steps = max(-(-len(side) // (BATCH // 2)) for side in sides)
        for _ in range(passes):
            turns = [np.resize(rng.permutation(side), (n_steps, BATCH // 2)) for side in sides]
            for batch in np.concatenate(turns, axis=1):
                chosen, times = np.unique(batch, return_counts=True)
                self.step([documents[k] for k in chosen], toxic[chosen], times)


def best_cut(logit: np.ndarray, toxic: np.ndarray, documents: np.ndarray | None = None) -> float:
    """The logit that divides the labels best (by F1), midway between its neighbours.

    With ``documents``, each value stands for so many documents, ``toxic`` of them toxic.
    """
    order = np.argsort(-logit, kind="stable")
    value, hit = logit[order], np.cumsum(toxic[order])
    n = np.arange(1, len(value) + 1) if documents is None else np.cumsum(documents[order])
    score = 2 * hit / (n + toxic.sum())
    # only between unlike values
    score[:-1][value[:-1] == value[1:]] = -1
    k = int(score.argmax())
    return float((value[k] + value[k + 1]) / 2 if k + 1 < len(value) else value[k] - 1)


# --- on Spark ---------------------------------------------------------------


def labelled_ids(labels: DataFrame, learn: Column) -> DataFrame:
    """All usable labels: doc_id, toxic, order (a hash of the id), kept_back."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & learn).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic")
    )
    order = F.xxhash64("doc_id", F.lit(12))
    return usable.dropDuplicates().withColumn("order", order).withColumn("kept_back", F.pmod("order", F.lit(5)) == 0)


def likely_labelled(docs: DataFrame, usable: DataFrame) -> DataFrame:
    """The documents whose ids are set in a bitmap of the hashes of labelled ids, and so few others.

    The bitmap has ``ID_BITS`` bits however many labels there are; it only spares texts a shuffle.
    """
    mark = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(ID_BITS))
    bits = usable.select(mark.alias("mark")).groupBy(F.expr("mark div 64").alias("slot")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(mark % 64 AS INT)))").alias("bits")
    )
    found = docs.withColumn("mark", mark).withColumn("slot", F.expr("mark div 64")).join(F.broadcast(bits), "slot")
    return found.filter("(shiftright(bits, CAST(mark % 64 AS INT)) & 1L) = 1").drop("mark", "slot", "bits")


class Learner:
    """Learns a shard whose documents come one after another, holding ``HELD_WORDS`` words or one document."""

    def __init__(self, start: Training, shard: int, passes: int, turn: int):
        self.start, self.state, self.shard, self.passes, self.seed = start, start.copy(), shard, passes, [turn, shard, 0]
        self.documents, self.toxic, self.words = [], [], 0

    def add(self, document: np.ndarray, toxic: int) -> None:
        if self.words and self.words + len(document) > HELD_WORDS:
            self.learn()
        self.documents.append(document)
        self.toxic.append(toxic)
        self.words += len(document)

    def learn(self) -> None:
        self.state.learn(self.documents, np.array(self.toxic), self.passes, tuple(self.seed))
        self.seed[2] += 1
        self.documents, self.toxic, self.words = [], [], 0

    def changes(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """Block of the table, shard, rows and their changes; the weights are block -1."""
        if self.documents:
            self.learn()
        moved = np.flatnonzero((self.state.table != self.start.table).any(axis=1))
        by = np.c_[self.state.table[moved] - self.start.table[moved], self.state.history[moved] - self.start.history[moved]]
        for part in np.split(np.arange(len(moved)), np.flatnonzero(np.diff(moved // BLOCK)) + 1):
            if len(part):
                rows = (moved[part] % BLOCK).astype(np.int32)
                yield int(moved[part[0]] // BLOCK), self.shard, rows.tobytes(), by[part].astype(np.float32).tobytes()
        yield -1, self.shard, b"", self.state.weights.tobytes()


_CHANGES = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("rows", pa.binary()), ("values", pa.binary())])


def _one_by_one(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)


def after_round(examples: DataFrame, start: Training, passes: int, turn: int) -> Training:
    """The mean of the networks that all shards make of ``start``; of a table row, of those that move it.

    ``examples`` has the shards one after another within partitions, each in one.
    """
    shared = examples.sparkSession.sparkContext.broadcast(start)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = None
        for batch in row_groups(batches, "text"):
            rows, owner = word_rows(batch.column("text"))
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            shards, toxic = (batch.column(c).to_pylist() for c in ("shard", "toxic"))
            for k in range(batch.num_rows):
                if learner is None or shards[k] != learner.shard:
                    if learner is not None:
                        yield from _one_by_one(learner.changes(), _CHANGES)
                    learner = Learner(shared.value, shards[k], passes, turn)
                learner.add(rows[bounds[k] : bounds[k + 1]].copy(), toxic[k])
        if learner is not None:
            yield from _one_by_one(learner.changes(), _CHANGES)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            block, total, n = None, None, None
            for batch in batches:
                for at, rows, values in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "values")), strict=True):
                    if at != block:
                        if block is not None:
                            yield block, (total / np.maximum(n, 1)[:, None]).tobytes()
                        block = at
                        total = np.zeros_like(shared.value.weights if at < 0 else np.empty((BLOCK, SIZE + 1)))
                        n = np.zeros(len(total))
                    where = np.frombuffer(rows, np.int32) if at >= 0 else np.arange(len(total))
                    total[where] += np.frombuffer(values, np.float32 if at >= 0 else np.float64).reshape(len(where), -1)
                    n[where] += 1
            if block is not None:
                yield block, (total / np.maximum(n, 1)[:, None]).tobytes()

        return _one_by_one(blocks(), pa.schema([("block", pa.int32()), ("mean", pa.binary())]))

    # bounded: the blocks of one table and its weights
    changes = examples.select("shard", "toxic", "text").mapInArrow(learn, "block int, shard int, rows binary, values binary")
    found = changes.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(means, "block int, mean binary")
    out = start.copy()
    for row in found.collect():
        mean = np.frombuffer(row["mean"]).reshape(-1, out.weights.shape[1] if row["block"] < 0 else SIZE + 1)
        if row["block"] < 0:
            out.weights[...] = mean
        else:
            part = slice(row["block"] * BLOCK, (row["block"] + 1) * BLOCK)
            out.table[part] += mean[:, :SIZE].astype(np.float32)
            out.history[part] += mean[:, SIZE].astype(np.float32)
    shared.unpersist()
    return out


def trained(examples: DataFrame, n_steps: float) -> Network:
    """A network fitted to all examples; a pass of a shard has about ``n_steps`` steps."""
    shards = examples.select("shard").distinct().limit(2).count()
    rounds = ROUNDS if shards > 1 else 1
    passes = max(ROUNDS // rounds, min(PASSES, int(np.ceil(STEPS / rounds / n_steps))))
    state = Training.new()
    for turn in range(rounds):
        state = after_round(examples, state, passes, turn)
    return state.network()


def calibrated(network: Network, examples: DataFrame) -> Model:
    """The network moved so that ``CUT`` divides the examples best, with thresholds by language.

    All examples are counted, by logits in steps of 1 / ``LOGIT_STEPS``.
    """
    shared = examples.sparkSession.sparkContext.broadcast(network)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            found = logits(shared.value, *word_rows(batch.column("text")), batch.num_rows)
            step = np.floor(np.clip(found, -MOST_LOGIT, MOST_LOGIT) * LOGIT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("toxic"), pa.array(step)], ["lang", "toxic", "step"])

    sums = F.sum("toxic").alias("toxic"), F.sum("documents").alias("documents")
    found = examples.select("lang", "toxic", "text").mapInArrow(steps, "lang string, toxic int, step int")
    counts = Stage(examples.sparkSession, "toxicity").table(
        found.withColumn("documents", F.lit(1).cast("long")).groupBy("lang", "step").agg(*sums), "counts"
    )

    def cut(rows: pa.Table) -> float:
        step, toxic, documents = (rows.column(c).to_numpy() for c in ("step", "toxic", "documents"))
        return best_cut((step + 0.5) / LOGIT_STEPS, toxic, documents)

    def of_language(rows: pa.Table) -> pa.Table:
        return pa.table({"lang": rows.column("lang").slice(0, 1), "cut": pa.array([cut(rows)], pa.float64())})

    # groups have a row for each step of the logit at most
    move = float(np.log(CUT / (1 - CUT))) - cut(counts.groupBy("step").agg(*sums).orderBy("step").toArrow())
    enough = counts.groupBy("lang").agg(*sums).filter(
        F.col("lang").isNotNull() & (F.least("toxic", F.col("documents") - F.col("toxic")) >= ENOUGH)
    )
    cuts = counts.join(enough.select("lang"), "lang", "left_semi").groupBy("lang").applyInArrow(of_language, "lang string, cut double")
    thresholds = {r["lang"]: float(sigmoid(np.array(r["cut"] + move))) for r in cuts.collect()}
    shared.unpersist()
    return Model(network._replace(constant=network.constant + move), thresholds)


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model | None:
    """A model of all labelled documents for which ``learn`` holds; None without both labels."""
    usable = labelled_ids(labels, learn)
    found = docs.select("doc_id").join(usable, "doc_id").groupBy("toxic", "kept_back").count().collect()
    n = {(r["toxic"], r["kept_back"]): r["count"] for r in found}
    of_label = [n.get((label, True), 0) + n.get((label, False), 0) for label in (0, 1)]
    if not all(of_label):
        return None
    # too few to do without, or none beside them
    all_learned = any(n.get((label, True), 0) < ENOUGH_BACK or not n.get((label, False)) for label in (0, 1))
    learned = of_label if all_learned else [n[label, False] for label in (0, 1)]
    shards = max(1, sum(learned) // SHARD)
    lang = docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    shard = F.pmod(F.xxhash64("order", F.lit(shards)), F.lit(shards)).cast("int")
    # read once a round: a copy on the executors' disks; so many partitions that few have two shards
    examples = (
        likely_labelled(docs.select("doc_id", "text", lang.alias("lang")), usable).join(usable.hint("merge"), "doc_id")
        .select("order", "kept_back", "toxic", "lang", "text", shard.alias("shard"), F.xxhash64("text").alias("of_text"))
        .repartition(4 * shards, "shard").sortWithinPartitions("shard", "order", "toxic", "of_text")
        .persist(StorageLevel.DISK_ONLY)
    )
    try:
        network = trained(examples if all_learned else examples.filter("NOT kept_back"), max(learned) / shards / (BATCH // 2))
        return calibrated(network, examples)
    finally:
        examples.unpersist()


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows with their columns in ``row``, ``score`` and the ``threshold`` of their language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in row_groups(batches, "text"):
            n = batch.num_rows
            if model is None:
                value, threshold = np.zeros(n), [CUT] * n
            else:
                value = sigmoid(logits(model.network, *word_rows(batch.column("text")), n))
                threshold = [model.thresholds.get(x, CUT) for x in batch.column("lang").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(value), pa.array(threshold, pa.float64())], ["row", "score", "threshold"]
            )

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"), lang.alias("lang"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(score, f"row {kind}, score double, threshold double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """Per row: doc_id, score, predicted (1 from ``CUT`` on), threshold, toxic.

    ``toxic`` compares the score with the threshold of the document's language.
    """
    model = fit(docs, labels, learn)
    wanted = ["doc_id", "text", *(["lang"] if "lang" in docs.columns else [])]
    return scored(docs.select(*wanted), model).select(
        "row.doc_id", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold",
        (F.col("score") >= F.col("threshold")).cast("int").alias("toxic"),
    )
