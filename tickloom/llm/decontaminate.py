"""Benchmark decontamination: suffix arrays over shards of the training text, searched with every test suffix.

A shard is a run of documents with a few MB of text. Its suffix array holds, in the order of
their words, all suffixes that begin as some test window begins (no other suffix can match);
they are ordered to the depth of the longest window. Every test suffix of a window's length
is found in it by binary search, all suffixes of the benchmark at once. Neighbouring windows
on one diagonal join into the longest verbatim matches, with their places.

The test side goes to the tasks in blocks of bounded size (``BLOCK_BYTES`` of text), one at a
time however long the benchmark is. A benchmark of one block takes one pass, and documents
are never shuffled or joined. With more blocks the documents are written once with row
numbers; each pass but the last writes what it found in the documents it found anything in,
gives its block back, and the last pass takes these findings up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import Held, picked, written

WINDOW = 10
BLOCK_BYTES = 8 << 20
_ANCHOR = 4
_FOUND = "n_words long, spans array<struct<first:int,last:int>>, matches array<struct<item:string,words:int,doc_word:int,item_word:int>>"


@dataclass(frozen=True)
class Suffixes:
    """The test side: distinct windows, and where items hold them.

    Window u has the words ``hashes[at[u] : at[u] + length[u]]``; items hold it at
    ``places[first[u] : first[u + 1]]``, as item numbers and word offsets.
    """

    hashes: np.ndarray
    at: np.ndarray
    length: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    names: list[str]
    anchors: dict[int, np.ndarray]

    @classmethod
    def of(cls, items: list[tuple[str, str]], window: int) -> Suffixes:
        texts = pa.array([text or "" for _, text in items], pa.large_string())
        found = words.words_of(*words.text_bytes(texts), words.ALPHANUMERIC)
        counts = found.counts()
        number = np.repeat(np.arange(len(items)), np.maximum(0, np.where(counts >= window, counts - window + 1, counts > 0)))
        offset = np.arange(len(number)) - np.searchsorted(number, number)
        at, length = found.first[:-1][number] + offset, np.minimum(counts[number], window)
        keys = np.zeros((len(number), window + 1), np.uint64)
        keys[:, window] = length
        for d in range(window):
            has = d < length
            keys[has, d] = found.hashes[at[has] + d]
        _, one, which = np.unique(keys, axis=0, return_index=True, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        first = np.searchsorted(which.ravel()[order], np.arange(len(one) + 1))
        at, size = at[one], length[one]
        anchors = {}
        for n in np.unique(np.minimum(size, _ANCHOR)).tolist():
            starts = at[np.minimum(size, _ANCHOR) == n]
            anchors[n] = np.unique(words.shingle_hashes(found.hashes, n)[starts])
        return cls(found.hashes, at, size, first, number[order], offset[order], [name for name, _ in items], anchors)


def _bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, key: np.ndarray, after: bool) -> np.ndarray:
    """Within each [low, high) of a column sorted there: the first place with a value not before (not up to) its key."""
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        middle = (low[open_] + high[open_]) >> 1
        value = column[middle]
        right = value <= key[open_] if after else value < key[open_]
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
    return low


def _search(shard: words.Words, test: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """All (shard word, window) with the window standing at that word, inside one document."""
    none = np.zeros(0, np.int64)
    starts = []
    for n, anchors in test.anchors.items():
        if len(shard.hashes) >= n:
            starts.append(words.held_in(words.shingle_hashes(shard.hashes, n), anchors))
    suffix = np.unique(np.concatenate(starts)) if starts else none
    if not len(suffix):
        return none, none
    ends = shard.first[1:][np.searchsorted(shard.first, suffix, side="right") - 1]
    depth = int(test.length.max())
    columns = []
    for d in range(depth):
        inside = suffix + d < ends
        columns.append(np.where(inside, shard.hashes[np.minimum(suffix + d, len(shard.hashes) - 1)], 0))
    order = np.lexsort([*columns[::-1]])
    suffix, ends = suffix[order], ends[order]
    low, high = np.zeros(len(test.at), np.int64), np.full(len(test.at), len(suffix))
    for d in range(depth):
        live = np.flatnonzero((test.length > d) & (low < high))
        key, column = test.hashes[test.at[live] + d], columns[d][order]
        low[live], high[live] = _bound(column, low[live], high[live], key, False), _bound(column, low[live], high[live], key, True)
    count = np.maximum(0, high - low)
    window = np.repeat(np.arange(len(count)), count)
    place = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(window))
    whole = suffix[place] + test.length[window] <= ends[place]
    return suffix[place][whole], window[whole]


def _covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def _runs(covered: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of covered words, cut at the documents' ends."""
    before, after = np.zeros(len(covered), bool), np.zeros(len(covered), bool)
    before[1:], after[:-1] = covered[:-1], covered[1:]
    inner = first[(first > 0) & (first < len(covered))]
    before[inner], after[inner - 1] = False, False
    return np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after) + 1


def _longest(place: np.ndarray, window: np.ndarray, test: Suffixes, first: np.ndarray):
    """For each (document, item) with a window in common: its longest match as (document, item, words, place, offset)."""
    count = test.first[window + 1] - test.first[window]
    index = np.repeat(test.first[window] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    place, length = np.repeat(place, count), np.repeat(test.length[window], count)
    item, offset = test.item[index], test.offset[index]
    document = np.searchsorted(first, place, side="right") - 1
    order = np.lexsort([place, place - offset, item, document])
    document, item, place, offset, length = document[order], item[order], place[order], offset[order], length[order]
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(document) != 0) | (np.diff(item) != 0) | (np.diff(place - offset) != 0) | (np.diff(place) != 1)
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(place))) - 1 + length[heads]
    document, item, place, offset = document[heads], item[heads], place[heads], offset[heads]
    order = np.lexsort([offset, place, -size, item, document])
    document, item = document[order], item[order]
    best = np.ones(len(order), bool)
    best[1:] = (np.diff(document) != 0) | (np.diff(item) != 0)
    keep = order[best]
    return document[best], item[best], size[keep], place[keep], offset[keep]


def _shard(batch: pa.RecordBatch, text: int, test: Suffixes, earlier: tuple[int, int] | None) -> list[pa.Array]:
    """n_words, spans and matches of the batch's documents, one shard."""
    shard = words.words_of(*words.text_bytes(batch.column(text)), words.ALPHANUMERIC)
    first, counts = shard.first, shard.counts()
    place, window = _search(shard, test)
    starts, lengths = place, test.length[window]
    found = _longest(place, window, test, first) if len(place) else (np.zeros(0, np.int64),) * 5
    rows = [found[0], [test.names[i] for i in found[1].tolist()], found[2], found[3] - first[found[0]], found[4]]
    if earlier is not None:
        spans, matches = batch.column(earlier[0]), batch.column(earlier[1])
        row, flat = pa.compute.list_parent_indices(spans).to_numpy(), pa.compute.list_flatten(spans)
        begin, end = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
        starts = np.concatenate([starts, first[row] + begin])
        lengths = np.concatenate([lengths, end - begin])
        flat = pa.compute.list_flatten(matches)
        rows = [
            np.concatenate([rows[0], pa.compute.list_parent_indices(matches).to_numpy()]),
            rows[1] + flat.field(0).to_pylist(),
            *(np.concatenate([rows[i + 1], flat.field(i).to_numpy()]) for i in (1, 2, 3)),
        ]
        order = np.argsort(rows[0], kind="stable")
        rows = [rows[0][order], [rows[1][i] for i in order.tolist()], *(x[order] for x in rows[2:])]
    begin, end = _runs(_covered(len(shard.hashes), starts, lengths), first)
    owner = np.searchsorted(first, begin, side="right") - 1
    spans = pa.StructArray.from_arrays([pa.array((x - first[owner]).astype(np.int32)) for x in (begin, end)], ["first", "last"])
    matches = pa.StructArray.from_arrays(
        [pa.array(rows[1], pa.string()), *(pa.array(np.asarray(x).astype(np.int32)) for x in rows[2:])],
        ["item", "words", "doc_word", "item_word"],
    )
    n = len(counts)
    return [words.longs(counts), words.lists(spans, np.bincount(owner, minlength=n)), words.lists(matches, np.bincount(rows[0], minlength=n))]


def _pass(frame: DataFrame, text: str, held: Broadcast, again: bool) -> DataFrame:
    """One block of the benchmark against all documents; ``again``: the frame holds findings of other blocks."""
    kept = [c for c in frame.columns if not (again and c in ("spans", "matches"))]
    at = frame.columns.index(text)
    earlier = (frame.columns.index("spans"), frame.columns.index("matches")) if again else None
    keep = [frame.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, at):
                made = _shard(piece, at, held.value, earlier)
                yield pa.RecordBatch.from_arrays([*(piece.column(i) for i in keep), *made], [*kept, "n_words", "spans", "matches"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields if f.name in kept)
    return frame.mapInArrow(run, f"{kinds}, {_FOUND}")


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's items as (item_id as text, text), in blocks of about ``limit`` bytes of text.

    Blocks come one by one, so that the caller holds no more than it keeps; an item longer
    than ``limit`` is not cut.
    """
    items = picked(benchmark, item="item_id", text="text").select(
        F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"), "text"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // limit)
    for part in range(parts):
        one = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        if rows := [tuple(row) for row in one.distinct().collect()]:
            yield rows


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, text: str = "text") -> DataFrame:
    """The documents, with the benchmark's windows found in them.

    Adds ``n_words``; ``spans``: word ranges [first, last) covered by windows, merged; and
    ``matches``: for every item with a window in the document its longest verbatim match
    (``words``) and the word offsets where it stands in document and item (the smallest ones
    at ties). Rows stay as they are, repeated ones too. A null or wordless text has 0 words
    and no match; so has every document when the benchmark is empty. A null item id counts
    as the text "null"; rows of one item id are one item. Columns of those three names are
    replaced, all others stay whatever their names.
    """
    held = Held(docs)
    text, frame, spark = held[text], held.frame, docs.sparkSession
    found, last = [], []
    for items in blocks(benchmark, block_bytes):
        if last:
            if not found:
                frame = written(frame.withColumn("row", F.monotonically_increasing_id()), "numbered")
            block = spark.sparkContext.broadcast(Suffixes.of(last, window))  # BLOCK_BYTES of text
            hits = _pass(frame.select("row", text), text, block, False).where(F.size("spans") > 0)
            found.append(written(hits.select("row", "spans", "matches"), "found"))
            block.destroy()
        last = items
    if found:
        hits = reduce(DataFrame.union, found).groupBy("row")
        hits = hits.agg(*(F.flatten(F.collect_list(name)).alias(name) for name in ("spans", "matches")))
        frame = frame.join(hits, "row", "left")
        none = {name: F.coalesce(name, F.array().cast(hits.schema[name].dataType)) for name in ("spans", "matches")}
        frame = frame.withColumns(none).drop("row")
    frame = _pass(frame, text, spark.sparkContext.broadcast(Suffixes.of(last, window)), bool(found))
    added = {name: F.col(name) for name in ("n_words", "spans", "matches")}
    return held.restored(frame, added)


def hit_words(spans: Column) -> Column:
    """How many words the spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def items(matches: Column) -> Column:
    """The ids of the items matched, sorted as texts."""
    return F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["item"])))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit, items, the items' digest, and whether any word is hit."""
    found = search(picked(docs, doc_id="doc_id", text="text"), benchmark, window)
    names = items(F.col("matches"))
    hit = hit_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])), F.lit(0)).alias("longest"),
    )


def removed(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without those that hold a window of the benchmark; columns as they were."""
    held = Held(docs)
    found = search(held.frame, benchmark, window, text=held["text"]).where(F.size("spans") == 0)
    return found.select(*held.columns()).toDF(*held.names)
