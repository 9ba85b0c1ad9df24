"""Byte-level BPE encoding and decoding as reductions over a tree of text pieces.

Encoded text is a monoid: an element holds a piece and its tokens; joining two neighbours gives
the element of their joined text. No match of the split pattern reaches over a place between a
character and white space behind it, nor over one between a letter and a punctuation mark behind
it, and where a match ends there depends on nothing that follows those two characters. So such
places are certain: the tokens on either side of them are the same in a piece and in any text
that holds the piece. A join looks back from the edge for a certain place, and ahead for one, in
windows that grow until they hold one (or are the whole piece), encodes what lies between them
anew, and keeps all tokens outside.

A text is cut into leaves of ``leaf_chars``, these are encoded one by one, and joined pairwise
level by level; decoding spells out leaves of tokens and concatenates their bytes up such a tree.
Each document is one row, so it takes one Python step in the task that reads it, and no shuffle.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import Held, picked

LEAF_CHARS, LEAF_IDS = 1024, 1024
WINDOW = 32
_CERTAIN = r"(?<=[^\s\x1c-\x1f])(?=[ \t\n\r])|(?<=\p{L})(?=\p{P})"
_AHEAD, _BACK = regex.compile(_CERTAIN), regex.compile("(?r)" + _CERTAIN)


@lru_cache(maxsize=4)
def vocabulary(ranks: str, pattern: str) -> tuple[tiktoken.Encoding, list[bytes], np.ndarray]:
    """The encoder of a file of ranks, the bytes of each id, and their number."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    spelled = [b""] * (max(table.values(), default=-1) + 1)
    for token, rank in table.items():
        spelled[rank] = token
    encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return encoder, spelled, np.array([len(x) for x in spelled], np.int64)


def encoded(encoder: tiktoken.Encoding, text: str) -> np.ndarray:
    return encoder.encode_to_numpy(text, disallowed_special=()).astype(np.int32) if text else np.zeros(0, np.int32)


def _tokens_of(ids: np.ndarray, size: int, sizes: np.ndarray) -> int:
    """How many of the first ids spell ``size`` bytes; a token ends there."""
    taken = 16
    while True:
        ends = np.cumsum(sizes[ids[:taken]])
        if taken >= len(ids) or ends[-1] >= size:
            return int(np.searchsorted(ends, size)) + 1 if size else 0
        taken *= 4


def _certain(search: Callable, piece: str, window: int, from_end: bool) -> int:
    """The certain place of a piece that is nearest to its start (its end); the other end of the piece if it has none."""
    while True:
        part = piece[-window:] if from_end else piece[:window]
        found = search(part)
        if found is not None:
            return found.start() + (len(piece) - len(part) if from_end else 0)
        if len(part) == len(piece):
            return 0 if from_end else len(piece)
        window *= 4


@dataclass(frozen=True)
class Encoded:
    """A piece of text with its tokens."""

    text: str
    ids: np.ndarray

    @classmethod
    def of(cls, text: str, ranks: str, pattern: str) -> Encoded:
        return cls(text, encoded(vocabulary(ranks, pattern)[0], text))

    def join(self, right: Encoded, ranks: str, pattern: str, window: int = WINDOW) -> Encoded:
        if not self.text or not right.text:
            return right if not self.text else self
        encoder, _, sizes = vocabulary(ranks, pattern)
        base, meet = _certain(_BACK.search, self.text, window, True), _certain(_AHEAD.search, right.text, window, False)
        tail, head = self.text[base:], right.text[:meet]
        kept = len(self.ids) - _tokens_of(self.ids[::-1], len(tail.encode()), sizes)
        skipped = _tokens_of(right.ids, len(head.encode()), sizes)
        ids = np.concatenate([self.ids[:kept], encoded(encoder, tail + head), right.ids[skipped:]])
        return Encoded(self.text + right.text, ids)


def up_the_tree(nodes: list, join: Callable):
    """Neighbours joined level by level."""
    while len(nodes) > 1:
        nodes = [join(nodes[i], nodes[i + 1]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return nodes[0]


def reduced(nodes: list[Encoded], ranks: str, pattern: str) -> Encoded:
    return up_the_tree(nodes, lambda a, b: a.join(b, ranks, pattern))


def _ids(text: str, ranks: str, pattern: str, leaf: int) -> np.ndarray:
    if len(text) <= leaf:
        return encoded(vocabulary(ranks, pattern)[0], text)
    return reduced([Encoded.of(text[i : i + leaf], ranks, pattern) for i in range(0, len(text), leaf)], ranks, pattern).ids


def _bytes(ids: np.ndarray, spelled: list[bytes], leaf: int = LEAF_IDS) -> bytes:
    leaves = [b"".join(map(spelled.__getitem__, ids[i : i + leaf].tolist())) for i in range(0, len(ids), leaf)]
    return up_the_tree(leaves, bytes.__add__) if leaves else b""


def _texts(column: pa.Array) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def _kinds(frame: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)


def _encoding(batches: Iterator[pa.RecordBatch], at: int, ranks: str, pattern: str, leaf: int, decoding: bool) -> Iterator[pa.RecordBatch]:
    """The rows with ids and, when ``decoding``, the bytes of these ids instead of the text."""
    spelled = vocabulary(ranks, pattern)[1]
    for batch in batches:
        for piece in words.pieces(batch, at):
            ids = [_ids(x, ranks, pattern, leaf) for x in _texts(piece.column(at))]
            column = words.lists(pa.array(np.concatenate(ids)), np.array([len(x) for x in ids]))
            kept = [i for i in range(piece.num_columns) if i != at or not decoding]
            columns, names = [*(piece.column(i) for i in kept), column], [*(piece.schema.names[i] for i in kept), "ids"]
            if decoding:
                columns, names = [*columns, pa.array([_bytes(x, spelled) for x in ids], pa.binary())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)


def encode(docs: DataFrame, ranks: str, pattern: str, leaf_chars: int = LEAF_CHARS, text: str = "text") -> DataFrame:
    """The documents with ``ids``: the tokens of their whole texts, as one call of the library on each text gives them.

    Null and empty texts have no ids. Rows stay as they are, repeated ones and all columns
    too; a column named ids is replaced. Bytes that are not UTF-8 count as U+FFFD. No
    special tokens: their strings are ordinary text. ``ranks`` is a path that every
    executor can open.
    """
    held = Held(docs)
    run = partial(_encoding, at=held.frame.columns.index(held[text]), ranks=ranks, pattern=pattern, leaf=leaf_chars, decoding=False)
    return held.restored(held.frame.mapInArrow(run, _kinds(held.frame) + "ids array<int>"), {"ids": F.col("ids")})


def decode(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the ids' bytes, one after the other; null ids decode to nothing.

    A column named decoded is replaced; all others stay. An id that the vocabulary lacks
    is an error.
    """
    held = Held(tokens)
    frame, at = held.frame, held.names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = vocabulary(ranks, pattern)[1]
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                made = [_bytes(x, spelled) for x in _values(piece.column(at))]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(made, pa.binary())], [*piece.schema.names, "decoded"])

    out = frame.mapInArrow(run, _kinds(frame) + "decoded binary")
    return held.restored(out, {"decoded": F.col("decoded")})


def _values(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The lists of a column; a null one is empty."""
    offsets, flat = column.offsets.to_numpy(), column.values
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        yield flat.slice(a, b - a if column[i].is_valid else 0).to_numpy(zero_copy_only=False)


def digests(docs: DataFrame, ranks: str, pattern: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """Encoded and decoded again, in one pass: per row the count of tokens and the digests of ids and decoded bytes."""
    rows = picked(docs, doc_id="doc_id", text="text")
    run = partial(_encoding, at=1, ranks=ranks, pattern=pattern, leaf=leaf_chars, decoding=True)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
