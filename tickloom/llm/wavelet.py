"""Token ids in files of wavelet matrices.

Documents are encoded in the order of their ids and cut into shards of about
``SHARD_TOKENS`` tokens. A shard's ids become a wavelet matrix: one bit plane for each bit of
the ids, highest first, each plane in the order that sorting by the planes above gives.
Counts of ones at every 512th bit make rank and select quick, and with them access to any
token, counts of any id, and the places of its occurrences, all from the shard's file alone.

A file is one row of a Parquet dataset, written by Spark's committer, so that a lost
executor leaves no half file: ``part`` and ``shard`` (its place in order), the documents' ids,
and ``file``, the bytes: a header of 40 bytes (magic, bits, tokens, documents), the count of
zeros of each plane, the documents' ends, the planes, compressed by zstandard.

Texts are encoded by the tokenizers library, each distinct word once per worker. That gives
the ids of whole texts: the tokenizer's normalizer and pattern neither join nor look across
ASCII white space, which itself has no token, nor in words of ASCII letters and signs across
the edge between the two kinds. Texts that hold one of the tokenizer's added tokens,
such as "<|endoftext|>", are encoded whole, as the library finds those tokens before it
normalizes and cuts.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import picked

SHARD_TOKENS = 2 << 20
END_ID = 1
_MAGIC = 0x31764D57
_BLOCK = 512
_SPACED = words.Alphabet(words.UNSPACED.word, np.arange(256, dtype=np.uint8))


@dataclass
class WaveletMatrix:
    """``planes``: the bits of each level, 8 to a byte; ``zeros``: how many of each are 0; ``ends``: where documents end."""

    count: int
    bits: int
    zeros: np.ndarray
    ends: np.ndarray
    planes: np.ndarray

    def __post_init__(self):
        whole = -(-self.count // _BLOCK)
        padded = np.zeros((self.bits, whole * (_BLOCK // 8)), np.uint8)
        padded[:, : self.planes.shape[1]] = self.planes
        ones = np.bitwise_count(padded).reshape(self.bits, whole, _BLOCK // 8).sum(axis=2, dtype=np.int64)
        self._ranks = np.concatenate([np.zeros((self.bits, 1), np.int64), np.cumsum(ones, axis=1)], axis=1)

    @classmethod
    def of(cls, ids: np.ndarray, ends: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max(initial=0)).bit_length())
        left = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = np.zeros((bits, -(-len(ids) // 8)), np.uint8), np.zeros(bits, np.int64)
        for level in range(bits):
            ones = (left >> (bits - 1 - level)) & 1 != 0
            planes[level] = np.packbits(ones, bitorder="little")
            low = left[~ones]
            zeros[level] = len(low)
            left = np.concatenate([low, left[ones]])
        return cls(len(ids), bits, zeros, np.asarray(ends, np.int64), planes)

    def to_bytes(self) -> bytes:
        header = np.array([_MAGIC, self.bits, self.count, len(self.ends), self.planes.shape[1]], "<i8")
        parts = (header, self.zeros.astype("<i8"), self.ends.astype("<i8"), self.planes)
        return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in parts))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        raw = zstandard.ZstdDecompressor().decompress(data)
        magic, bits, count, documents, width = np.frombuffer(raw, "<i8", 5).tolist()
        if magic != _MAGIC:
            raise ValueError("not a wavelet matrix file")
        zeros = np.frombuffer(raw, "<i8", bits, 40)
        ends = np.frombuffer(raw, "<i8", documents, 40 + 8 * bits)
        planes = np.frombuffer(raw, np.uint8, bits * width, 40 + 8 * (bits + documents)).reshape(bits, width)
        return cls(count, bits, zeros, ends, planes)

    def tokens(self) -> np.ndarray:
        """All ids in order: the planes are undone from the lowest up."""
        values = np.zeros(self.count, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.count, bitorder="little").view(bool)
            back = np.empty_like(values)
            back[~ones] = values[: self.zeros[level]]
            back[ones] = values[self.zeros[level] :] | values.dtype.type(1 << (self.bits - 1 - level))
            values = back
        return values

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """How many of the level's first i bits are 1."""
        block, at = divmod(i, _BLOCK)
        start = block * (_BLOCK // 8)
        rest = self.planes[level, start : start + -(-at // 8)]
        held = np.unpackbits(rest, bitorder="little")[:at]
        return int(self._ranks[level, block]) + int(held.sum())

    def _place(self, level: int, bit: int, k: int) -> int:
        """Where the level's k-th bit (from 0) of that value stands."""
        ranks = self._ranks[level]
        below = ranks if bit else np.arange(len(ranks)) * _BLOCK - ranks
        block = int(np.searchsorted(below, k, side="right")) - 1
        start = block * (_BLOCK // 8)
        held = np.unpackbits(self.planes[level, start : start + _BLOCK // 8], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(held == bit)[k - int(below[block])])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, to: int) -> tuple[int, int]:
        low, high = 0, to
        if token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (self.bits - 1 - level) & 1:
                low, high = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, to: int | None = None) -> int:
        """How often the id occurs before the place ``to`` (in the whole shard by default)."""
        low, high = self._range(token, self.count if to is None else to)
        return high - low

    def select(self, token: int, k: int) -> int:
        """The place of the id's k-th occurrence, from 0."""
        low, high = self._range(token, self.count)
        if not 0 <= k < high - low:
            raise IndexError(f"token {token} occurs {high - low} times")
        i = low + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            i = self._place(level, bit, i - int(self.zeros[level]) if bit else i)
        return i


class _WordIds:
    """Ids of words; each distinct word is encoded once while it stays in the table of up to ``limit`` words.

    The table is sorted arrays: the words' hashes, and where their ids stand in one array.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        added = sorted(x.content for x in self.encoder.get_added_tokens_decoder().values())
        #: An added token in any case and form: the library looks for some of them after its normalizer.
        self.added = re.compile("|".join(re.escape(x) for x in added).encode(), re.IGNORECASE) if added else None
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.start, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, spelled: list[bytes]) -> None:
        sizes, ids = [], []
        for at in range(0, len(spelled), 4096):
            some = [x.decode("utf-8", "replace") for x in spelled[at : at + 4096]]
            made = [x.ids for x in self.encoder.encode_batch_fast(some, add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in made], np.int32))
            ids.append(np.array([i for x in made for i in x], np.int32))
        size = np.concatenate(sizes)
        start = len(self.ids) + np.cumsum(size, dtype=np.int64) - size
        self.ids = np.concatenate([self.ids, *ids])
        where = np.searchsorted(self.hashes, hashes)
        self.start, self.size = np.insert(self.start, where, start), np.insert(self.size, where, size)
        self.hashes = np.insert(self.hashes, where, hashes)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and how many each text has."""
        whole = self._whole(data, offsets)
        if not whole:
            return self._by_units(data, offsets)
        made, sizes, done = [], np.zeros(len(offsets) - 1, np.int64), 0
        for i in [*whole, len(offsets) - 1]:
            if i > done:
                low, high = offsets[done], offsets[i]
                ids, sizes[done:i] = self._by_units(data[low:high], offsets[done : i + 1] - low)
                made.append(ids)
            if i < len(sizes):
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
                ids = np.array(self.encoder.encode(text, add_special_tokens=False).ids, np.int32)
                sizes[i] = len(ids)
                made.append(ids)
            done = i + 1
        return np.concatenate(made), sizes

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The texts that hold an added token."""
        if self.added is None:
            return []
        raw = data.tobytes()
        places = np.array([x.start() for x in self.added.finditer(raw, 0, int(offsets[-1]))], np.int64)
        return np.unique(np.searchsorted(offsets, places[places >= offsets[0]], side="right") - 1).tolist()

    def _by_units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = _units(data, offsets)
        hashes, one, which = np.unique(found.hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > self.limit:
            self._clear()
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        new = np.flatnonzero(self.hashes[place] != hashes) if len(self.hashes) else np.arange(len(hashes))
        if len(new):
            raw = found.text.tobytes()
            self._learn(hashes[new], [raw[found.starts[i] : found.ends[i]] for i in one[new].tolist()])
        if not len(hashes):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        at = np.searchsorted(self.hashes, hashes)[which]
        n, begin = self.size[at].astype(np.int64), self.start[at]
        total = np.concatenate([[0], np.cumsum(n)])
        return self.ids[np.repeat(begin - total[:-1], n) + np.arange(total[-1])], np.diff(total[found.first])


def _units(data: np.ndarray, offsets: np.ndarray) -> words.Words:
    """The texts cut where tokens never cross: at ASCII white space and, in words of ASCII
    letters and signs alone (no digit, no apostrophe), between letters and signs. Such words
    are in lower case, as the tokenizer has them; all others keep their bytes."""
    whole = words.words_of(data, offsets, _SPACED)
    odd = np.concatenate([[0], np.cumsum(_KIND[data] == 2)])
    plain = odd[whole.ends] == odd[whole.starts]
    step = np.zeros(len(data) + 1, np.int8)
    step[whole.starts[plain]] = 1
    step[whole.ends[plain]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    text = whole.text
    text[:-8][inside] = words.UNSPACED.lower[data[inside]]
    cut = np.zeros(len(data), bool)
    cut[1:] = inside[1:] & inside[:-1] & (_KIND[data[1:]] != _KIND[data[:-1]])
    cut[whole.starts] = True
    starts = np.flatnonzero(cut)
    last = np.searchsorted(starts, whole.starts[1:]) - 1  # the last unit of each word but the last word
    ends = np.append(starts[1:], 0)
    ends[last] = whole.ends[:-1]
    if len(starts):
        ends[-1] = whole.ends[-1]
    ends = ends[: len(starts)]
    return words.Words(words.hashes_of(text, starts, ends), np.searchsorted(starts, offsets), starts, ends, text)


#: Kinds of bytes: letters 0, signs 1, others (digits, apostrophe, beyond ASCII, control characters) 2.
_KIND = np.array([0 if chr(b).isascii() and chr(b).isalpha() else 1 if 0x21 <= b <= 0x7E and not chr(b).isdigit() and b != 0x27 else 2 for b in range(256)], np.uint8)


@lru_cache(maxsize=1)
def _word_ids(path: str) -> _WordIds:
    return _WordIds(path)


def shards(docs: DataFrame, vocabulary: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' tokens as shard files: (part, shard, ids, tokens, before, file).

    Ascending by id (nulls first), then by the text's hash; ``end_id`` follows each document,
    also null and empty ones; repeated rows are documents of their own. ``before`` counts the
    tokens of the part's earlier shards. A document is never cut: one longer than
    ``shard_tokens`` is a shard of its own.
    """
    source = picked(docs, id=key, text=text).withColumn("tie", F.xxhash64("text"))
    ordered = source.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text").select("id", "text")
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _word_ids(vocabulary), TaskContext.get().partitionId()
        number, before, held, pending = 0, 0, 0, []

        def made() -> pa.RecordBatch:
            names = pa.chunked_array([p[0] for p in pending]).combine_chunks()
            tokens, sizes = np.concatenate([p[1] for p in pending]), np.concatenate([p[2] for p in pending])
            file = WaveletMatrix.of(tokens, np.cumsum(sizes)).to_bytes()
            lists = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            columns = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), lists, pa.array([len(tokens)]), pa.array([before]), pa.array([file], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "shard", "ids", "tokens", "before", "file"])

        for batch in batches:
            for piece in words.pieces(batch, 1):
                ids, sizes = encoder(*words.text_bytes(piece.column(1)))
                ends = np.cumsum(sizes)
                pending.append((piece.column(0), np.insert(ids, ends, end_id).astype(np.uint32, copy=False), sizes + 1))
                held += int(sizes.sum()) + len(sizes)
                if held >= shard_tokens:
                    yield made()
                    number, before, held, pending = number + 1, before + held, 0, []
        if pending:
            yield made()

    return ordered.mapInArrow(run, f"part int, shard int, ids array<{kind}>, tokens bigint, before bigint, file binary")


def write(docs: DataFrame, path: str, vocabulary: str, **options) -> None:
    """The shard files as a dataset at ``path``."""
    shards(docs, vocabulary, **options).write.parquet(path)


def _starts(files: DataFrame) -> DataFrame:
    """``(part, base)``: the tokens of all earlier parts; as many rows as the files had partitions."""
    totals = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files at ``path``: its id, ``start`` (ids of all documents before it), ``tokens``."""
    return documents(spark.read.parquet(path), key)


def documents(files: DataFrame, key: str = "doc_id") -> DataFrame:
    kind = files.schema["ids"].dataType.elementType.simpleString()
    placed = files.join(F.broadcast(_starts(files)), "part").select("ids", (F.col("base") + F.col("before")).alias("start"), "file")  # a row per part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(2)[i].as_py())
                tokens, begin = matrix.tokens().astype(np.int32), np.concatenate([[0], matrix.ends[:-1]])
                start = batch.column(1)[i].as_py()
                names = batch.column(0).slice(i, 1).flatten()
                for at in range(0, len(names), 1000):
                    own = slice(at, at + 1000)
                    low, high = int(begin[own][0]), int(matrix.ends[own][-1])
                    lists = words.lists(pa.array(tokens[low:high]), matrix.ends[own] - begin[own])
                    yield pa.RecordBatch.from_arrays([names.slice(at, 1000), pa.array(start + begin[own]), lists], [key, "start", "tokens"])

    return placed.mapInArrow(run, f"`{key}` {kind}, start bigint, tokens array<int>")


def occurrences(files: DataFrame, token: int, key: str = "doc_id") -> DataFrame:
    """Where the id occurs: (document's id, offset in the document), found by rank and select alone."""
    kind = files.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(1)[i].as_py())
                places = np.array([matrix.select(token, k) for k in range(matrix.rank(token))], np.int64)
                document = np.searchsorted(matrix.ends, places, side="right")
                begin = np.concatenate([[0], matrix.ends[:-1]])[document]
                names = batch.column(0).slice(i, 1).flatten().take(pa.array(document))
                yield pa.RecordBatch.from_arrays([names, pa.array(places - begin)], [key, "offset"])

    return files.select("ids", "file").mapInArrow(run, f"`{key}` {kind}, offset bigint")


def digests(files: DataFrame) -> DataFrame:
    """Per document, read back from the files: start, count and crc32 of its ids as little-endian 32-bit numbers."""
    back = documents(files)
    kind = back.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            sizes = np.diff(offsets).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return back.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
