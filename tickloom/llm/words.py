"""Words of whole batches of text as 64-bit hashes, without a Python object per word.

A batch's text is one byte buffer. Word edges come from a table of byte classes (every
byte of a multi-byte character is of one class), and hashes from eight bytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES, PIECE_ROWS = 2 << 20, 4096
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x * _MULTIPLY
    x ^= x >> np.uint64(29)
    x *= _SECOND
    x ^= x >> np.uint64(32)
    return x


@dataclass(frozen=True)
class Alphabet:
    """``word[b]``: whether byte b belongs to words; ``lower[b]``: b with A-Z lower-cased."""

    word: np.ndarray
    lower: np.ndarray

    @classmethod
    def of(cls, is_word) -> Alphabet:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        return cls(np.array([bool(is_word(b)) for b in lower.tolist()]), lower)


#: Digits, letters a-z and everything beyond ASCII.
ALPHANUMERIC = Alphabet.of(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
#: Everything but the ASCII white space.
UNSPACED = Alphabet.of(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


@dataclass(frozen=True)
class Words:
    """Words of some texts in order: ``hashes``; text i has words ``first[i]`` up to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes and the n + 1 offsets of its texts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    inside = alphabet.word[data]
    text = np.zeros(len(data) + 8, np.uint8)
    text[: len(data)] = alphabet.lower[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(hashes_of(text, starts, ends), np.searchsorted(starts, offsets), starts, ends, text)


def hashes_of(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    eights = np.ndarray(shape=(len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))
    left = ends - starts
    value = eights[starts] & _MASKS[np.minimum(left, 8)]
    hashes = mixed(value + left.astype(np.uint64) * _SECOND)
    more = np.flatnonzero(left > 8)
    done = 8
    while len(more):
        value = eights[starts[more] + done] & _MASKS[np.minimum(left[more] - done, 8)]
        hashes[more] = mixed(hashes[more] ^ value)
        done += 8
        more = more[left[more] > done]
    return hashes


def shingle_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each ``length`` neighbouring words, by the place of the first of them."""
    count = max(0, len(hashes) - length + 1)
    out = hashes[:count].copy()
    for i in range(1, length):
        out = mixed(out) + hashes[i : i + count]
    return mixed(out)


def held_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Places of the values that are in the sorted ``among``: a bit table first, then a search for those it lets through."""
    if not len(among):
        return np.zeros(0, np.int64)
    table = np.zeros(1 << 20, bool)
    table[among >> np.uint64(44)] = True
    left = np.flatnonzero(table[values >> np.uint64(44)])
    place = np.minimum(np.searchsorted(among, values[left]), len(among) - 1)
    return left[among[place] == values[left]]


def pieces(batch: pa.RecordBatch, column: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of up to PIECE_ROWS rows whose texts have about ``limit`` bytes at most; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, at + PIECE_ROWS)
        yield batch.slice(at, to - at)
        at = to


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """One list per row, of that many values each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
