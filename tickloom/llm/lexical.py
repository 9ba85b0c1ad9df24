"""Ranked lexical search with bag deduplication.

Documents are restricted to the items' vocabulary: a bag is the vector of term numbers and term
frequencies, without any shuffle. Documents whose bag and length measure ``m`` are equal score
alike for every item, so they form a class: bags are hashed, and grouped by hash and the whole
vector, which verifies them. Each class is scored once against all items; a task keeps the best
classes of each item. Only the classes that win are expanded to their members, by ascending id.

Items come in blocks of bounded size. One block at a time is with driver and executors; for each
block the documents are read once. With one block, as usual, everything happens once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import picked, written

TOP = 50
#: A block holds about so many (item, term) entries: some 20 MB.
BLOCK_ENTRIES = 500_000
#: Cells of scores that a task has in memory at a time.
_CELLS = 1 << 21
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = np.iinfo(np.int64).max


def item_terms(items: DataFrame, entries: int = BLOCK_ENTRIES) -> tuple[DataFrame, int]:
    """``(item, term, block)`` for the distinct terms of each item id, as a written table, and the number of blocks."""
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(_TERM), F.lit(0)))
    terms = written(items.select("item", F.explode(found).alias("term")).distinct(), "item-terms")
    blocks = max(1, -(-terms.count() // entries))
    return terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), blocks


@dataclass(frozen=True)
class Vocabulary:
    """A block's terms in the order of their hashes; term number i is the i-th."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    @classmethod
    def of(cls, terms: list[str]) -> tuple[Vocabulary, np.ndarray]:
        """The vocabulary, and the place of each given term in it."""
        data, offsets = words.text_bytes(pa.array(terms, pa.string()))
        text = np.zeros(len(data) + 8, np.uint8)
        text[: len(data)] = data
        hashes = words.hashes_of(text, offsets[:-1], offsets[1:])
        order = np.argsort(hashes, kind="stable")
        if (np.diff(hashes[order]) == 0).any():
            raise ValueError("two terms of one block share a 64-bit hash; use smaller blocks")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(hashes[order], offsets[:-1][order], offsets[1:][order], text), place

    def numbers(self, found: words.Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms, byte for byte, and their term numbers."""
        hit = words.held_in(found.hashes, self.hashes)
        number = np.searchsorted(self.hashes, found.hashes[hit])
        a, left = found.starts[hit], found.ends[hit] - found.starts[hit]
        b = self.starts[number]
        same = left == self.ends[number] - b
        eights = [np.ndarray(shape=(len(x) - 7,), dtype="<u8", buffer=x, strides=(1,)) for x in (found.text, self.text)]
        done, open_ = 0, np.flatnonzero(same)
        while len(open_):
            mask = words._MASKS[np.minimum(left[open_] - done, 8)]
            equal = ((eights[0][a[open_] + done] ^ eights[1][b[open_] + done]) & mask) == 0
            same[open_[~equal]] = False
            done += 8
            open_ = open_[equal & (left[open_] > done)]
        return hit[same], number[same]


def bags(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms with repeats, and the bag over the vocabulary; documents without a term are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most BLOCK_ENTRIES terms, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        size = max(1, len(known.hashes))
        for batch in batches:
            for piece in words.pieces(batch, 1):
                found = words.words_of(*words.text_bytes(piece.column(1)), words.ALPHANUMERIC)
                count = found.counts()
                place, number = known.numbers(found)
                row = np.searchsorted(found.first, place, side="right") - 1
                key, tf = np.unique(row * size + number, return_counts=True)
                own = np.bincount(key // size, minlength=len(count))
                columns = [piece.column(0), words.longs(count), *(words.lists(pa.array(x.astype(np.int32)), own) for x in (key % size, tf))]
                made = pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])
                yield made.filter(pa.array(count > 0))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def classes(bagged: DataFrame) -> DataFrame:
    """One row per (m, bag): its hash ``h``, members and smallest id; bags without a term are left out."""
    with_terms = bagged.where(F.size("terms") > 0)
    grouped = with_terms.groupBy("h", "m", "terms", "tfs").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first_doc"))
    return grouped.withColumn("class", F.monotonically_increasing_id())


@dataclass(frozen=True)
class Postings:
    """Term number t weighs ``weight[t]`` and is in the items ``item[first[t]:first[t + 1]]``."""

    weight: np.ndarray
    first: np.ndarray
    item: np.ndarray
    n_items: int


def _scores(postings: Postings, row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """Rows x items: the summed worth of each row's terms for each item."""
    degree = postings.first[term + 1] - postings.first[term]
    ends = np.cumsum(degree)
    entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(postings.first[term] - ends + degree, degree)
    out = np.zeros(rows * postings.n_items, np.int64)
    np.add.at(out, np.repeat(row * postings.n_items, degree) + postings.item[entry], np.repeat(value, degree))
    return out.reshape(rows, postings.n_items)


class _Best:
    """The best classes of each item so far: by score, then by smallest id, then by class."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least = top, np.ones(n_items, np.int64)
        self.held = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, first_doc, class

    def add(self, scores: np.ndarray, first_doc: np.ndarray, own: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        fresh = item, scores[row, item], first_doc[row], own[row]
        held = [np.concatenate(x) for x in zip(self.held, fresh)]
        order = np.lexsort([held[3], held[2], -held[1], held[0]])
        held = [x[order] for x in held]
        begin = np.searchsorted(held[0], held[0])
        kept = np.arange(len(order)) - begin < self.top
        full = np.arange(len(order)) - begin == self.top - 1
        self.least[held[0][full]] = held[1][full]
        self.held = [x[kept] for x in held]


def best_classes(table: DataFrame, postings: Postings, items: pa.Array, kind: str, top: int = TOP) -> DataFrame:
    """``(item, score, first_doc, class)``: for each task and item its ``top`` best classes."""
    shared = table.sparkSession.sparkContext.broadcast((postings, items))  # at most BLOCK_ENTRIES entries, about

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = shared.value
        best, most = _Best(known.n_items, top), max(1, _CELLS // max(1, known.n_items))
        size = min(64, most)  # the first rows set the bar
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size)
                at, size = at + size, min(2 * size, most)
                own, m, first_doc = (part.column(i).fill_null(_LAST).to_numpy() for i in range(3))
                terms = part.column(3)
                count = pa.compute.list_value_length(terms).to_numpy()
                row = np.repeat(np.arange(len(own)), count)
                term, tf = (pa.compute.list_flatten(part.column(i)).to_numpy().astype(np.int64) for i in (3, 4))
                value = known.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
                # A row reaches each entry of the postings once at most; rows are taken so that cells and entries stay bounded.
                reach = np.cumsum(known.first[term + 1] - known.first[term])
                edges = np.append(0, np.cumsum(count))
                a = 0
                while a < len(own):
                    before = reach[edges[a] - 1] if edges[a] else 0
                    done = np.append(0, reach)[edges[a + 1 :]] - before
                    b = a + max(1, int(np.searchsorted(done, 2 * _CELLS, side="right")))
                    cut = slice(edges[a], edges[b])
                    best.add(_scores(known, row[cut] - a, term[cut], value[cut], b - a), first_doc[a:b], own[a:b])
                    a = b
        item, score, first_doc, own = best.held
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(item)), pa.array(score), pa.array(first_doc, mask=first_doc == _LAST), pa.array(own)], ["item", "score", "first_doc", "class"]
        )

    columns = table.select("class", "m", F.col("first_doc").cast("long").alias("first_doc"), "terms", "tfs")
    return columns.mapInArrow(run, f"item {kind}, score long, first_doc long, class long")


def _top(frame: DataFrame, key: str, number: str, *order) -> DataFrame:
    return frame.withColumn(number, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col(number) <= TOP)


def _block(docs: DataFrame, terms: DataFrame, block: int) -> DataFrame:
    entries = terms.where(F.col("block") == block).select("item", "term").toArrow()  # about BLOCK_ENTRIES rows
    items = entries.column("item").combine_chunks().dictionary_encode("encode")
    spelled = entries.column("term").combine_chunks().dictionary_encode()
    vocabulary, place = Vocabulary.of(spelled.dictionary.to_pylist())
    bagged = written(bags(docs, vocabulary), "bags")
    n_docs, n_terms = bagged.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bagged = bagged.withColumn("m", F.expr(f"50 + (50L * n * {n_docs}L) div {max(1, n_terms)}L"))
    bagged = bagged.withColumn("h", F.xxhash64("m", "terms", "tfs"))
    found = written(classes(bagged), "classes")

    frequency = found.select(F.explode("terms").alias("term"), "members").groupBy("term").agg(F.sum("members").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1)))
    weighed = frequency.select("term", weight.cast("long").alias("w")).toArrow()  # at most the vocabulary
    weights = np.zeros(len(place), np.int64)
    weights[weighed.column("term").to_numpy()] = weighed.column("w").to_numpy()

    term, item = place[spelled.indices.to_numpy()], items.indices.to_numpy().astype(np.int64)
    order = np.argsort(term, kind="stable")
    first = np.searchsorted(term[order], np.arange(len(place) + 1))
    postings = Postings(weights, first, item[order], len(items.dictionary))
    kind = terms.schema["item"].dataType.simpleString()
    scored = best_classes(found, postings, items.dictionary, kind)
    winners = written(_top(scored, "item", "place", F.desc("score"), F.asc_nulls_last("first_doc"), "class").drop("place"), "winners")

    # TOP classes per item at most; as a table its size is known, so Spark broadcasts it only where it is small.
    won = written(winners.select("class").distinct().join(found, "class").select("class", "h", "m", "terms", "tfs"), "won")
    members = bagged.join(won, ["h", "m", "terms", "tfs"]).select("class", "doc_id")
    members = _top(members, "class", "place", F.asc_nulls_last("doc_id")).drop("place")
    ranked = _top(winners.join(members, "class"), "item", "rank", F.desc("score"), F.asc_nulls_last("doc_id"))
    return ranked.select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's 50 best documents with a score above 0.

    Equal scores go by ascending id, null ids last; every row is a document of its own, repeated
    ones too. Rows of one item id are one item with all their terms, a null id among them.
    Null texts have no terms; items without terms, or whose terms no document holds, have no rows.
    """
    docs = picked(docs, doc_id="doc_id", text="text")
    terms, blocks = item_terms(picked(items, item="item_id", text="text"), entries)
    made = None
    for block in range(blocks):
        rows = written(_block(docs, terms, block), "ranked")  # one block's broadcasts are over before the next
        made = rows if made is None else made.unionByName(rows)
    return made.withColumnRenamed("item", "item_id")
