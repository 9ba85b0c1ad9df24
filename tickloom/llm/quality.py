"""Document quality by Bradley-Terry ranking.

Measures of the whole text (kinds of characters, word and line shapes, repetition) become a
document's features, each also as steps between quantiles of the sample. Preference pairs
set good labelled documents against bad ones; the loss is logistic on the difference of
features, so that the weights order documents by a strength. The cut is a quantile of the
strengths of all documents that are scored, at the level that parts the labelled sample with
the fewest errors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import labelled, words
from tickloom.llm.common import Held, picked, written

FOLDS, HELD_OUT = 3, 1
PAIRS_PER_ROW = 16
STEPS = 12
RIDGE = 1e-4
#: So many quantiles of all documents are tried as the cut; their ranks are off by one in ``ACCURACY`` at most.
LEVELS = 2000
ACCURACY = 100_000
#: Bytes whose rate among the bytes is a measure of its own.
MARKS = b"!?.,;:|*$#%&=_-'\"()[]{}<>/\\@+~^`"


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many places of each text the mask holds."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)


def _different(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort([values, row])
    row, values = row[order], values[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (values[1:] != values[:-1])
    return np.bincount(row[new], minlength=n).astype(np.float64)


def measures(column: pa.Array) -> np.ndarray:
    """One row of measures for each text; those of an empty text are 0."""
    data, offsets = words.text_bytes(column)
    n, size = len(column), np.diff(offsets).astype(np.float64)
    found = words.words_of(data, offsets, words.UNSPACED)
    count, row = found.counts().astype(np.float64), np.repeat(np.arange(n), found.counts())
    rate = lambda x, of: x / np.maximum(of, 1)
    upper, lower = _per_text((data >= 65) & (data <= 90), offsets), _per_text((data >= 97) & (data <= 122), offsets)
    high = _per_text(data >= 128, offsets)
    lines = _per_text(data == 10, offsets)
    histogram = [rate(_per_text(data == mark, offsets), size) for mark in MARKS]
    letters = upper + lower + high
    length = (found.ends - found.starts).astype(np.float64)
    spread = np.bincount(row, length**2, minlength=n)
    again = np.zeros(len(row), bool)
    again[1:] = (found.hashes[1:] == found.hashes[:-1]) & (row[1:] == row[:-1])
    threes = words.shingle_hashes(found.hashes, 3)
    inside = row[: len(threes)] == row[len(row) - len(threes) :] if len(threes) else np.zeros(0, bool)
    three_rows = row[: len(threes)][inside]
    text_lines = words.words_of(data, offsets, _LINES)
    line_row = np.repeat(np.arange(n), text_lines.counts())
    mean = rate(np.bincount(row, length, minlength=n), count)
    out = [
        np.log1p(size), np.log1p(count), mean, np.sqrt(np.maximum(0, rate(spread, count) - mean**2)),
        rate(upper, letters), rate(high, size), rate(_per_text((data >= 48) & (data <= 57), offsets), size),
        rate(size - letters, size), rate(lines, count), rate(_different(text_lines.hashes, line_row, n), text_lines.counts()),
        rate(_different(found.hashes, row, n), count), rate(_different(threes[inside], three_rows, n), np.bincount(three_rows, minlength=n)),
        rate(np.bincount(row[again], minlength=n), count), rate(_per_text(data < 9, offsets), size), *histogram,
    ]
    return np.stack(out, axis=1)


_LINES = words.Alphabet.of(lambda b: b != 10)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures of ``text`` as one array instead of it; other columns stay."""
    at, names = docs.columns.index("text"), [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, at):
                made = measures(piece.column(at))
                column = words.lists(pa.array(made.ravel()), np.full(len(made), made.shape[1]))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), column], [*names, "measures"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(run, kinds + "measures array<double>")


@dataclass(frozen=True)
class Model:
    """Weights of the scaled measures and of the steps past ``edges``, and the sorted strengths of the sample's ``good`` and ``bad`` rows."""

    middle: np.ndarray
    scale: np.ndarray
    edges: np.ndarray
    weights: np.ndarray
    good: np.ndarray
    bad: np.ndarray

    def features(self, measures: np.ndarray) -> np.ndarray:
        plain = np.clip((measures - self.middle) / self.scale, -8, 8)
        steps = (measures[:, :, None] > self.edges[None]).reshape(len(measures), -1)
        return np.concatenate([plain, steps], axis=1)

    def strength(self, measures: np.ndarray) -> np.ndarray:
        return self.features(measures) @ self.weights


def preferences(label: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (good row, bad row): each row is in ``PAIRS_PER_ROW`` of them at least."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    random = np.random.default_rng(seed)
    first = np.concatenate([np.repeat(good, PAIRS_PER_ROW), random.choice(good, len(bad) * PAIRS_PER_ROW)])
    second = np.concatenate([random.choice(bad, len(good) * PAIRS_PER_ROW), np.repeat(bad, PAIRS_PER_ROW)])
    return first, second


def fit(measures: np.ndarray, label: np.ndarray, rounds: int = 500, seed: int = 7) -> Model:
    """Bradley-Terry weights from preference pairs, with a small ridge."""
    middle, scale = measures.mean(axis=0), measures.std(axis=0) + 1e-9
    edges = np.quantile(measures, (np.arange(STEPS) + 0.5) / STEPS, axis=0).T
    model = Model(middle, scale, edges, np.zeros(measures.shape[1] * (1 + STEPS)), np.zeros(0), np.zeros(0))
    x = model.features(measures)
    first, second = preferences(label, seed)
    weights, moment, square = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    for step in range(1, rounds + 1):
        score = x @ weights
        pull = labelled.sigmoid(score[second] - score[first]) / len(first)
        by_row = np.bincount(second, pull, minlength=len(x)) - np.bincount(first, pull, minlength=len(x))
        slope = x.T @ by_row + RIDGE * weights
        moment, square = 0.9 * moment + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        rate = 0.05 * (1 - 0.9 * step / rounds)
        weights = weights - rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    score = x @ weights
    return Model(middle, scale, edges, weights, np.sort(score[label == 1]), np.sort(score[label == 0]))


def train(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS) -> Model | float:
    """A model from ``rows`` labelled documents at most, none of the held-out fold.

    With labels of one kind only there is no pair: the score is that label's (smoothed)
    share for all documents, and 0.5 without labels.
    """
    sample = labelled.sample(docs, labels, "quality", FOLDS, HELD_OUT, rows).select("label", "text")
    table = measured(sample).toArrow()
    label = table.column("label").to_numpy()
    if not len(label) or label.min() == label.max():
        return (float(label.sum()) + 0.5) / (len(label) + 1)
    values = table.column("measures").combine_chunks()
    return fit(pa.compute.list_flatten(values).to_numpy().reshape(len(label), -1), label)


def ranked(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``strength``: the higher, the likelier a document is preferred; no bounds.

    Null and empty texts get the strength of measures of 0. Rows and columns stay as they
    are; a column named strength is replaced.
    """
    held = Held(docs)
    frame, at = held.frame, held.frame.columns.index(held["text"])
    shared = frame.sparkSession.sparkContext.broadcast(model)  # some hundreds of weights, SAMPLE_ROWS strengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        for batch in batches:
            for piece in words.pieces(batch, at):
                strength = pa.array(made.strength(measures(piece.column(at))))
                yield pa.RecordBatch.from_arrays([*piece.columns, strength], [*piece.schema.names, "strength"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)
    return held.restored(frame.mapInArrow(run, kinds + "strength double"), {"strength": F.col("strength")})


def cut(ranks: DataFrame, model: Model) -> float:
    """The quantile of the strengths of all rows that parts the labelled sample with the fewest errors.

    ``LEVELS`` levels are tried, and the middle one of those with the fewest errors is taken.
    Rows at the cut are above it. Without rows it is 0.
    """
    levels = (np.arange(1, LEVELS + 1) / LEVELS).tolist()
    marks = ranks.agg(F.percentile_approx("strength", levels, ACCURACY)).first()[0]
    if not marks:
        return 0.0
    wrong = np.searchsorted(model.good, marks) + len(model.bad) - np.searchsorted(model.bad, marks)
    best = np.flatnonzero(wrong == wrong.min())
    return marks[int(best[(len(best) - 1) // 2])]


def _logistic(at: float) -> Column:
    return (F.tanh((F.col("strength") - F.lit(at)) / 2) + 1) / 2


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """The documents with ``score``: near 1 for good whole texts, 0.5 at the cut.

    The cut is taken over all of ``docs``; their strengths are written once for it, beside
    their other columns. Null and empty texts are scored by measures of 0. A model of one
    number is the score of every document. Rows and columns stay as they are; a column
    named score is replaced.
    """
    held = Held(docs)
    if isinstance(model, float):
        return held.restored(held.frame, {"score": F.lit(model)})
    frame = held.frame.withColumnRenamed(held["text"], "text")
    frame = written(ranked(frame, model).withColumnRenamed("text", held["text"]), "strengths")
    return held.restored(frame, {"score": _logistic(cut(frame, model))})


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether its fold is held out, its score, and the prediction."""
    model, table = train(docs, labels), picked(docs, doc_id="doc_id", text="text")
    if isinstance(model, Model):
        table = written(ranked(table, model).select("doc_id", "strength"), "strengths")
        scored = table.withColumn("score", _logistic(cut(table, model)))
    else:
        scored = table.withColumn("score", F.lit(model))
    held_out = F.coalesce(labelled.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
