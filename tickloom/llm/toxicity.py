"""Toxicity: a linear classifier over word and word-start features, made even-handed by counterfactuals.

A document's features are the distinct words in it and their first 3 to 6 bytes. Training
documents that name a group of people also exist with every such term swapped for another
of its list, and the loss holds the square of the score's change: a group's name alone must
not move a score. Feature choice counts all rows of the sample in Spark; the weights of the
chosen features are fitted on the driver, from rows that hold just those features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import labelled, words
from tickloom.llm.common import Held, picked, written

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
FEATURES = 4096
STARTS = (3, 4, 5, 6)
EVENNESS = 5.0
RIDGE = 1e-3
#: Terms for groups of people; a swap takes the next one of the same list.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("transgender", "cisgender"),
    ("gay", "lesbian", "straight", "bisexual", "queer"), ("black", "white", "asian", "latino", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrants", "refugees", "foreigners", "natives"), ("american", "african", "mexican", "chinese", "indian", "european"),
    ("old", "young"), ("disabled", "blind", "deaf"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("étrangers", "immigrés"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("extranjeros", "inmigrantes"),
)


def _features(found: words.Words) -> np.ndarray:
    """One row per kind of feature (the word, then its starts), one column per word; 0 where a word is too short."""
    out = np.zeros((1 + len(STARTS), len(found.hashes)), np.uint64)
    if not len(found.hashes):
        return out
    out[0] = found.hashes | np.uint64(1)
    eights = np.ndarray(shape=(len(found.text) - 7,), dtype="<u8", buffer=found.text, strides=(1,))[found.starts]
    size = found.ends - found.starts
    for i, n in enumerate(STARTS, 1):
        start = words.mixed((eights & np.uint64((1 << 8 * n) - 1)) + np.uint64(n << 56)) | np.uint64(1)
        out[i] = np.where(size > n, start, 0)
    return out


def _swaps() -> tuple[np.ndarray, np.ndarray]:
    """The terms' word hashes, sorted, and the features of the term that each is swapped for."""
    terms = [t for group in IDENTITY_TERMS for t in group]
    partners = [t for group in IDENTITY_TERMS for t in group[1:] + group[:1]]
    own = words.words_of(*words.text_bytes(pa.array(terms)), words.ALPHANUMERIC).hashes
    theirs = _features(words.words_of(*words.text_bytes(pa.array(partners)), words.ALPHANUMERIC))
    order = np.argsort(own)
    return own[order], theirs[:, order]


def identity_features() -> np.ndarray:
    made = np.unique(_swaps()[1])
    return made[made != 0]


def _distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort([value, row])
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (value[1:] != value[:-1])
    return row[new], value[new]


def _row_features(features: np.ndarray, row: np.ndarray, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature), only those in the sorted ``among`` if given."""
    rows, values = [], []
    for kind in features:
        at = np.flatnonzero(kind) if among is None else words.held_in(kind, among)
        rows.append(row[at])
        values.append(kind[at])
    return _distinct(np.concatenate(rows), np.concatenate(values))


def featured(rows: DataFrame, among: np.ndarray | None = None) -> DataFrame:
    """``(label, features, swapped)`` of rows ``(label, text)``; swapped is null where no term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, partners = _swaps()
        for batch in batches:
            for piece in words.pieces(batch, 1):
                found = words.words_of(*words.text_bytes(piece.column(1)), words.ALPHANUMERIC)
                features, row = _features(found), np.repeat(np.arange(piece.num_rows), found.counts())
                own = _row_features(features, row, among)
                named = words.held_in(found.hashes, terms)
                features[:, named] = partners[:, np.searchsorted(terms, found.hashes[named])]
                other = _row_features(features, row, among)
                lists = [words.lists(words.longs(v), np.bincount(r, minlength=piece.num_rows)) for r, v in (own, other)]
                swapped = np.isin(np.arange(piece.num_rows), row[named])
                lists[1] = pa.compute.if_else(pa.array(swapped), lists[1], pa.scalar(None, lists[1].type))
                yield pa.RecordBatch.from_arrays([piece.column(0), *lists], ["label", "features", "swapped"])

    return rows.select("label", "text").mapInArrow(run, "label int, features array<bigint>, swapped array<bigint>")


def _chosen(rows: DataFrame, count: int) -> np.ndarray:
    """The features whose shares among toxic and other rows differ most surely, and those of the terms; sorted."""
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")).first()
    if not totals.n or not totals.k or totals.k == totals.n:
        return identity_features()
    counts = rows.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k"))
    share = F.lit(totals.k / totals.n)
    surely = (F.abs(F.col("k") - share * F.col("n")) - 0.5) / F.sqrt(share * (1 - share) * F.col("n"))
    best = counts.where("n >= 3").orderBy(surely.desc(), "feature").limit(count).select("feature")
    found = np.array([r[0] for r in best.collect()], np.int64).view(np.uint64)
    return np.unique(np.concatenate([found, identity_features()]))


@dataclass(frozen=True)
class Model:
    """``weights`` of the sorted ``features``, and the score of a document without any of them."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def _matrix(lists: pa.ChunkedArray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each feature held."""
    column = lists.combine_chunks()
    row = pa.compute.list_parent_indices(column).to_numpy()
    return row, np.searchsorted(features, pa.compute.list_flatten(column).to_numpy().view(np.uint64))


def _fitted(table: pa.Table, features: np.ndarray, evenness: float, rounds: int = 400) -> Model:
    """Logistic loss with a ridge, and ``evenness`` times the mean square of the swapped documents' score changes."""
    label = table.column("label").to_numpy().astype(np.float64)
    n, width = len(label), len(features)
    if not n or label.min() == label.max():
        share = float(label.mean()) if n else 0.0
        return Model(features, np.zeros(width), float(np.log((share * n + 0.5) / ((1 - share) * n + 0.5))))
    row, col = _matrix(table.column("features"), features)
    pairs = table.filter(pa.compute.is_valid(table.column("swapped")))
    m = max(1, pairs.num_rows)
    a, b = _matrix(pairs.column("features"), features), _matrix(pairs.column("swapped"), features)
    change = (np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.concatenate([np.ones(len(a[0])), -np.ones(len(b[0]))]))
    weights, bias = np.zeros(width), float(np.log(label.mean() / (1 - label.mean())))
    moment, square, moment0, square0 = np.zeros(width), np.zeros(width), 0.0, 0.0
    for step in range(1, rounds + 1):
        miss = (labelled.sigmoid(np.bincount(row, weights[col], minlength=n) + bias) - label) / n
        slope = np.bincount(col, miss[row], minlength=width) + RIDGE * weights
        if len(change[0]):
            moved = np.bincount(change[0], change[2] * weights[change[1]], minlength=m)
            slope += 2 * evenness / m * np.bincount(change[1], change[2] * moved[change[0]], minlength=width)
        slope0 = miss.sum()
        moment, square = 0.9 * moment + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        moment0, square0 = 0.9 * moment0 + 0.1 * slope0, 0.999 * square0 + 0.001 * slope0**2
        even, scale = 1 - 0.9**step, 1 - 0.999**step
        rate = 0.05 * (1 - 0.9 * step / rounds)
        weights = weights - rate * (moment / even) / (np.sqrt(square / scale) + 1e-8)
        bias -= rate * (moment0 / even) / ((square0 / scale) ** 0.5 + 1e-8)
    return Model(features, weights, bias)


def train(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS, evenness: float = EVENNESS, count: int = FEATURES) -> Model:
    """A model from ``rows`` labelled documents at most, none of them of the held-out fold.

    Without labels, or with labels of one kind only, every document gets one score.
    """
    sample = written(labelled.sample(docs, labels, "toxic", FOLDS, HELD_OUT, rows), "toxic-rows")
    features = _chosen(featured(sample), count)
    return _fitted(featured(sample, features).toArrow(), features, evenness)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with ``score``: the probability that their whole text is toxic.

    Null and wordless texts get the model's bias alone. Rows and columns stay as they are;
    a column named score is replaced.
    """
    held = Held(docs)
    frame, at = held.frame, held.frame.columns.index(held[text])
    shared = frame.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = shared.value.features, shared.value.weights, shared.value.bias
        for batch in batches:
            for piece in words.pieces(batch, at):
                found = words.words_of(*words.text_bytes(piece.column(at)), words.ALPHANUMERIC)
                row, value = _row_features(_features(found), np.repeat(np.arange(piece.num_rows), found.counts()), features)
                total = np.bincount(row, weights[np.searchsorted(features, value)], minlength=piece.num_rows) + bias
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(labelled.sigmoid(total))], [*piece.schema.names, "score"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)
    return held.restored(frame.mapInArrow(run, kinds + "score double"), {"score": F.col("score")})


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether its fold is held out, its score, and the prediction."""
    scored = score(picked(docs, doc_id="doc_id", text="text"), train(docs, labels))
    held_out = F.coalesce(labelled.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold; columns as they were."""
    held = Held(docs)
    scored = score(held.frame, train(docs, labels), held["text"]).where(F.col("score") < threshold)
    return scored.select(*held.columns()).toDF(*held.names)
