"""SimHash fingerprints of 128 bits, out of DataFrame functions alone.

The terms of a text are its pairs of neighbouring words (and the last word alone), each
with the weight of its length, as longer words are rarer. Every term votes with its
weight on the 128 bits of its hash: bits that the hash sets go up, others down. A bit of the
fingerprint is set if more than half of the text's weight voted for it. Votes are sums of
two bits at a time, in the two halves of a long, so a text may weigh up to 2^32. Texts
become rows of terms within a task and are summed there before the shuffle.

``within_radius`` finds all fingerprints within a Hamming radius of given ones. It cuts
the bits into ``radius + 2`` blocks. Two fingerprints within the radius agree on two
blocks at least, so a table for each pair of blocks, keyed by their bits, meets them all;
only distinct fingerprints are compared.

Defined cases: a null text is empty; a text without words has the fingerprint zero; equal
texts have equal fingerprints; repeated rows (equal id and text) are one document in the
order and are returned as often as they come; a null id is the smallest; a single
document is followed by itself; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casametra.llm.common import Stage, WORD

BITS = 128
#: Weight of a term: its characters, at most this.
HEAVIEST = 16
#: Hamming radius of near fingerprints.
RADIUS = 3

#: Stands for a null id, below every other.
NO_ID = -(1 << 63)
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def voted(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Fingerprints by key: the keys, and the halves ``f1`` and ``f2``."""
    listed = rows.select(*keys, F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias("_words"))
    pairs = F.arrays_zip(F.col("_words").alias("w"), F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("v"))
    spread = listed.select(*keys, F.inline_outer(pairs).alias("_w", "_v"))
    letters = F.coalesce(F.length("_w"), F.lit(0)) + F.coalesce(F.length("_v"), F.lit(0))
    weight = F.least(letters, F.lit(HEAVIEST)).cast("long")
    hashed = spread.select(
        *keys,
        weight.alias("_weight"),
        F.xxhash64(F.lit(11), "_w", "_v").alias("_h1"),
        F.xxhash64(F.lit(23), "_w", "_v").alias("_h2"),
    )
    lanes = [
        F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES)) * F.col("_weight")).alias(f"_{h[2]}_{j}")
        for h in ("_h1", "_h2")
        for j in range(32)
    ]
    sums = hashed.groupBy(*keys).agg(F.sum("_weight").alias("_total"), *lanes)

    def half(n: str) -> Column:
        bits = []
        for j in range(32):
            low = F.col(f"_{n}_{j}").bitwiseAND(F.lit(_LOW))
            high = F.shiftrightunsigned(f"_{n}_{j}", 32)
            bits.append(F.when(2 * low > F.col("_total"), F.lit(1 << j)).otherwise(F.lit(0)).cast("long"))
            top = 1 << (j + 32)
            bits.append(F.when(2 * high > F.col("_total"), F.lit(top if top < 1 << 63 else top - (1 << 64))).otherwise(F.lit(0)).cast("long"))
        while len(bits) > 1:
            bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
        return bits[0]

    return sums.select(*keys, half("1").alias("f1"), half("2").alias("f2"))


def as_text(f1: Column | str, f2: Column | str) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(*(F.lpad(F.hex(f), 16, "0") for f in (f1, f2))))


def likeness(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Share of equal bits of two fingerprints."""
    return 1 - distance(a, b) / F.lit(float(BITS))


def distance(a: tuple[str, str], b: tuple[str, str]) -> Column:
    return sum((F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(a, b, strict=True)), F.lit(0))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).withColumns(
        {"n_chars": F.length("_text").cast("long"), "_th": F.xxhash64("_text"), "_tk": F.xxhash64(F.lit(5), "_text")}
    )
    halves = voted(rows.groupBy("doc_id", "_th", "_tk", "n_chars", "_text").agg(F.count("*").alias("_n")), ["doc_id", "_th", "_tk", "n_chars", "_n"], "_text")
    return halves.select("doc_id", "n_chars", as_text("f1", "f2").alias("fingerprint"), "f1", "f2", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int")))).drop("col")


# --- documents and what follows them ----------------------------------------


def followed(keys: DataFrame, stage: Stage) -> DataFrame:
    """Each key (_k, _th) with the next in descending order (_nk, _nth), the last with the first.

    Keys are dealt by range; within a range the next is a window away, at its end it is
    the first of the next range. Only the ranges' first keys are ordered in one task.
    """
    ranged = stage.table(
        keys.repartitionByRange(F.desc("_k"), F.desc("_th")).withColumn("_range", F.spark_partition_id()), "keys"
    )
    first = F.max(F.struct("_k", "_th")).alias("_first")
    firsts = ranged.groupBy("_range").agg(first)
    across = Window.orderBy("_range")
    heads = firsts.select(
        "_range", F.lead("_first").over(across).alias("_after"), F.first("_first").over(across).alias("_top")
    )
    within = Window.partitionBy("_range").orderBy(F.desc("_k"), F.desc("_th"))
    nearest = ranged.withColumn("_next", F.lead(F.struct("_k", "_th")).over(within)).join(heads, "_range")
    following = F.coalesce("_next", "_after", "_top")
    return nearest.select("_k", "_th", "_n", "_chars", following["_k"].alias("_nk"), following["_th"].alias("_nth"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: fingerprints of the text and of its edited text, and likenesses.

    The edited text has its last floor(n/2) characters replaced by the first as many (or
    all) of the next document in descending doc_id order; the last is followed by the first.
    """
    stage = Stage(docs.sparkSession, "simhash")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_k"), F.xxhash64(text).alias("_th"), text.alias("_text")
    )
    keys = rows.groupBy("_k", "_th").agg(F.count("*").alias("_n"), F.max(F.length("_text")).alias("_chars"))
    pairs = stage.table(followed(keys, stage), "pairs")

    wanted = pairs.select(
        F.col("_nk").alias("_k"), F.col("_nth").alias("_th"), F.col("_k").alias("_rk"), F.col("_th").alias("_rth"),
        F.floor(F.col("_chars") / 2).cast("int").alias("_half"),
    )
    heads = (
        rows.join(wanted, ["_k", "_th"])
        .select(F.col("_rk").alias("_k"), F.col("_rth").alias("_th"), F.left("_text", "_half").alias("_head"))
        .dropDuplicates(["_k", "_th"])
    )
    chars = F.length("_text")
    both = rows.join(heads, ["_k", "_th"]).select(
        "_k", "_th", "_text", F.concat(F.left("_text", chars - F.floor(chars / 2).cast("int")), "_head").alias("_edited")
    )
    sha = F.unhex(F.sha2("_edited", 256))
    stacked = both.select(
        "_k", "_th",
        F.inline(F.array(
            F.struct(F.lit(0).alias("_which"), F.unhex(F.lit("")).alias("_sha"), F.col("_text").alias("_body")),
            F.struct(F.lit(1).alias("_which"), sha.alias("_sha"), F.col("_edited").alias("_body")),
        )),
    )
    found = stage.table(voted(stacked, ["_k", "_th", "_which", "_sha"], "_body"), "fingerprints")

    own = found.filter("_which = 0").select("_k", "_th", "f1", "f2")
    edited = found.filter("_which = 1").select("_k", "_th", "_sha", F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    following = own.select(F.col("_k").alias("_nk"), F.col("_th").alias("_nth"), F.col("f1").alias("n1"), F.col("f2").alias("n2"))
    joined = pairs.join(own, ["_k", "_th"]).join(edited, ["_k", "_th"]).join(following, ["_nk", "_nth"])
    return joined.select(
        F.when(F.col("_k") != NO_ID, F.col("_k")).alias("doc_id"),
        F.col("_chars").cast("long").alias("n_chars"),
        F.lower(F.hex("_sha")).alias("edited_sha256"),
        as_text("f1", "f2").alias("fingerprint"),
        as_text("e1", "e2").alias("edited_fingerprint"),
        likeness(("f1", "f2"), ("e1", "e2")).alias("near_edited"),
        likeness(("f1", "f2"), ("n1", "n2")).alias("near_next"),
        F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))).alias("_copy"),
    ).drop("_copy")


# --- search -----------------------------------------------------------------


def _block(number: int, blocks: int) -> Column:
    """Bits of one of the blocks of a fingerprint (f1, f2), as text."""
    low, high = BITS * number // blocks, BITS * (number + 1) // blocks
    parts = []
    for name, base in (("f1", 0), ("f2", 64)):
        start, end = max(low, base) - base, min(high, base + 64) - base
        if start < end:
            mask = (1 << (end - start)) - 1
            bits = F.shiftrightunsigned(name, start)
            parts.append(bits.bitwiseAND(F.lit(mask)) if mask < 1 << 63 else bits)
    return F.concat_ws("-", *(F.hex(p) for p in parts))


def block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """The columns of ``prints`` once for each table of two blocks: table and key."""
    blocks = radius + 2
    tables = [
        F.struct(F.lit(t).alias("table"), F.xxhash64(F.lit(t), _block(i, blocks), _block(j, blocks)).alias("key"))
        for t, (i, j) in enumerate(combinations(range(blocks), 2))
    ]
    return prints.select("*", F.inline(F.array(*tables)))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints within the radius of the queries': q1, q2, f1, f2, distance."""
    asked = block_tables(queries.select("f1", "f2").distinct(), radius).select(
        F.col("f1").alias("q1"), F.col("f2").alias("q2"), "table", "key"
    )
    known = block_tables(prints.select("f1", "f2").distinct(), radius)
    return (
        asked.join(known, ["table", "key"])
        .withColumn("distance", distance(("q1", "q2"), ("f1", "f2")))
        .filter(F.col("distance") <= radius)
        .select("q1", "q2", "f1", "f2", "distance").distinct()
    )
