"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary file is read once per worker process. Ids are those of the file's own
tokenizer; the encoder used here applies the same ranks and splitting pattern several
times faster (the tests hold the two against each other). Spelled-out special tokens
in a text become their ids, as in the file's tokenizer.

The pattern's rule for blanks (all of a run but the last, all of it at the end) is the one
that makes a pattern engine go back step by step, which stops it on very long runs. So runs of
two blanks or more are cut out by that rule here, in every text, and the pattern sees
what lies between them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> "Encoder":
    """An encoder with the ranks of the vocabulary file."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(printable))}
    special = {t["content"]: t["id"] for t in content["added_tokens"]}
    ranks = {
        bytes(byte_of[c] for c in piece): i
        for piece, i in content["model"]["vocab"].items()
        if piece not in special
    }

    def with_pattern(name: str, pattern: str) -> tiktoken.Encoding:
        return tiktoken.Encoding(f"{path} {name}", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    marks = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
    return Encoder(with_pattern("text", public_tokenizers.PATTERN), with_pattern("run", r"[\s\S]+"), special, marks)


# The characters with the Unicode property White_Space.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"[{_BLANKS}]{{2,}}")


class Encoder(NamedTuple):
    """Encoders of text and of a run of blanks as one piece; special tokens and their places."""

    of_text: object
    of_run: object
    special: dict[str, int]
    marks: re.Pattern | None

    def encode(self, text: str) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for part in self.marks.split(text) if self.marks else (text,):
            if part in self.special:
                out.append(np.array([self.special[part]], dtype=np.uint32))
            elif part:
                self._between_marks(part, out)
        return out

    def _between_marks(self, text: str, out: list[np.ndarray]) -> None:
        at = 0
        for run in _RUN.finditer(text):
            start, end = run.span()
            # the last blank goes with what follows, if anything does
            end -= end < len(text)
            if start > at:
                out.append(self._ids(self.of_text, text[at:start]))
            out.append(self._ids(self.of_run, text[start:end]))
            at = end
        if at < len(text):
            out.append(self._ids(self.of_text, text[at:]))

    @staticmethod
    def _ids(encoding, text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, disallowed_special=())


def encode(path: str, text: str | None) -> np.ndarray:
    """Ids of one text, without an end token; null is empty."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    parts = encoder(path).encode(text)
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def token_lengths(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of tokens of each text: the id column and ``n_tokens``. Null has none."""
    path = path or default_vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(encode(path, x.as_py())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["id", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(docs[id_column].alias("id"), docs[text].alias("text")).mapInArrow(
        count, f"id {kind}, n_tokens long"
    ).withColumnRenamed("id", id_column)
