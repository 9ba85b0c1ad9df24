"""Quality rules: gradient-boosted trees over document statistics, scored from flat node arrays.

Counts of the whole text (words, symbols, repeated lines, repeated word windows) decide the fixed
rules; rates made of them and of further counts are the features of the trees. The trees are
boosted on the logistic loss over quantile bins of the features, with second-order gains. On
chosen features the score never rises with the value: a split there must order its children, and
bounds handed down keep every leaf below it in order. The fitted trees are one array each of
features, thresholds, children and values; a batch of rows walks down all trees at once.
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
from tickloom.llm.common import Held, picked

FOLDS, HELD_OUT = 3, 1
#: Documents whose score is below this go; the score is the chance of label 1.
CUT = 0.5
TREES, DEPTH, BINS, RATE, RIDGE, MIN_ROWS = 120, 4, 48, 0.1, 1.0, 5
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_BLANKS = b" \t\n\x0b\x0c\r"
_EXACT = words.Alphabet(words.UNSPACED.word, np.arange(256, dtype=np.uint8))
#: Names of the features; -1 marks those in which the score never rises, +1 would mark those in which it never falls.
FEATURES = {
    "symbol_rate": -1, "dup_line_share": -1, "repeat_share": -1, "top_word_share": -1, "control_rate": -1, "log_words": 0, "mean_word": 0,
    "long_word_share": 0, "distinct_share": 0, "upper_share": 0, "digit_rate": 0, "high_rate": 0, "mark_rate": 0, "stop_rate": 0, "exclaim_rate": 0,
    "comma_rate": 0, "bracket_rate": 0, "words_per_line": 0, "same_neighbours": 0, "letterless_share": 0, "distinct_pairs": 0, "bytes_entropy": 0,
}


def _by_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _runs(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, key), and whether each ordered place differs from the one before."""
    order = np.lexsort([keys, row])
    new = np.ones(len(order), bool)
    new[1:] = (row[order[1:]] != row[order[:-1]]) | (keys[order[1:]] != keys[order[:-1]])
    return order, new


def _repeated_words(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Per text the words in windows of WINDOW words that occur twice or more in it."""
    size = len(hashes) - WINDOW + 1
    if size < 2:
        return np.zeros(n, np.int64)
    inside = np.flatnonzero(row[:size] == row[WINDOW - 1 :])
    order, new = _runs(words.shingle_hashes(hashes, WINDOW)[inside], row[inside])
    place = inside[order]
    same = ~new
    for k in range(WINDOW):  # windows are equal when their words are
        same[1:] &= hashes[place[1:] + k] == hashes[place[:-1] + k]
    again = same.copy()
    again[:-1] |= same[1:]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, place[again], 1)
    np.add.at(edge, place[again] + WINDOW, -1)
    return np.bincount(row[np.cumsum(edge[:-1]) > 0], minlength=n)


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text the COUNTS (whole numbers) and the FEATURES; all of them are 0 for an empty text."""
    data, offsets = words.text_bytes(column)
    n, size = len(column), np.diff(offsets)
    found = words.words_of(data, offsets, _EXACT)
    count = found.counts()
    row = np.repeat(np.arange(n), count)
    raw = data.tobytes()
    lines, dups = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(n):
        kept = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip(_BLANKS)]
        lines[i], dups[i] = len(kept), len(kept) - len(set(kept))
    symbols, repeated = _by_text(_SYMBOLS[data], offsets), _repeated_words(found.hashes, row, n)
    head = (data & 0xC0) != 0x80
    chars = _by_text(_EXACT.word[data] & head, offsets)
    counts = np.stack([count, chars, symbols, dups, repeated], axis=1)

    rate = lambda x, of: x / np.maximum(of, 1)
    upper, lower = _by_text((data >= 65) & (data <= 90), offsets), _by_text((data >= 97) & (data <= 122), offsets)
    high, digits = _by_text(data >= 0xC0, offsets), _by_text((data >= 48) & (data <= 57), offsets)
    length = found.ends - found.starts
    letter = np.zeros(len(data) + 1, np.int64)
    np.cumsum(((data | 0x20) >= 97) & ((data | 0x20) <= 122) | (data >= 0x80), out=letter[1:])
    plain = letter[found.ends] == letter[found.starts]
    order, new = _runs(found.hashes, row)
    first = np.flatnonzero(new)
    often = np.zeros(n, np.int64)
    np.maximum.at(often, row[order[first]], np.diff(np.append(first, len(order))))
    neighbours = np.zeros(len(row), bool)
    neighbours[1:] = (found.hashes[1:] == found.hashes[:-1]) & (row[1:] == row[:-1])
    pairs = words.shingle_hashes(found.hashes, 2)
    inside = np.flatnonzero(row[:-1] == row[1:]) if len(row) > 1 else np.zeros(0, np.int64)
    pair_order, pair_new = _runs(pairs[inside], row[inside])
    different_pairs = np.bincount(row[inside[pair_order[pair_new]]], minlength=n)
    mark = lambda x: _by_text(np.isin(data, np.frombuffer(x, np.uint8)), offsets)
    features = np.stack([
        rate(symbols, count), rate(dups, lines), rate(repeated, count), rate(often, count) * (count >= 20), rate(_by_text(data < 9, offsets), size),
        np.log1p(count), rate(chars, count), rate(np.bincount(row[length > 20], minlength=n), count), rate(np.bincount(row[order[first]], minlength=n), count),
        rate(upper, upper + lower), rate(digits, size), rate(high, size), rate(size - upper - lower - digits, size), rate(mark(b"."), count),
        rate(mark(b"!?"), count), rate(mark(b",;:"), count), rate(mark(b"()[]{}/\\=_~^@+"), count), rate(count, lines),
        rate(np.bincount(row[neighbours], minlength=n), count), rate(np.bincount(row[plain], minlength=n), count),
        rate(different_pairs, np.bincount(row[inside], minlength=n)), _entropy(data, offsets),
    ], axis=1)
    return counts, features


def _entropy(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits per byte of each text under its own byte frequencies."""
    out = np.zeros(len(offsets) - 1)
    for i in range(len(out)):
        size = offsets[i + 1] - offsets[i]
        if size:
            share = np.bincount(data[offsets[i] : offsets[i + 1]], minlength=1) / size
            share = share[share > 0]
            out[i] = -(share * np.log2(share)).sum()
    return out


def base_failed(counts: np.ndarray) -> np.ndarray:
    """The fixed rules: fewer than 10 words, or more than a fifth of the words in repeated windows."""
    n_words, repeated = counts[:, 0], counts[:, 4]
    return (n_words < 10) | (100 * repeated > 20 * n_words)


@dataclass(frozen=True)
class Trees:
    """All trees' nodes one after the other. A leaf is its own child; ``roots`` are the trees' first nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, features: np.ndarray) -> np.ndarray:
        out, rows = np.empty(len(features)), max(1, 400_000 // max(1, len(self.roots)))
        for a in range(0, len(features), rows):
            x = features[a : a + rows]
            node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            for _ in range(self.depth):
                below = np.take_along_axis(x, self.feature[node], axis=1) <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            out[a : a + rows] = self.start + self.value[node].sum(axis=1)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return labelled.sigmoid(self.margin(features))


class _Growing:
    """Node arrays under construction."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value, self.roots = [], [], [], [], [], []

    def leaf(self, value: float) -> int:
        at = len(self.value)
        for column, x in ((self.feature, 0), (self.threshold, np.inf), (self.left, at), (self.right, at), (self.value, value)):
            column.append(x)
        return at

    def split(self, at: int, feature: int, threshold: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[at], self.threshold[at] = feature, threshold
        self.left[at], self.right[at] = children = self.leaf(values[0]), self.leaf(values[1])
        return children


def _best_split(slope, curve, rows, low, high, signs):
    """Best (feature, bin, value left, value right) of each node from its histograms (nodes x features x bins), and the gain."""
    left_g, left_h, left_n = (np.cumsum(x, axis=2)[:, :, :-1] for x in (slope, curve, rows))
    total = [x.sum(axis=2)[:, :, None] for x in (slope, curve, rows)]
    right_g, right_h, right_n = total[0] - left_g, total[1] - left_h, total[2] - left_n
    bounds = low[:, None, None], high[:, None, None]
    value = lambda g, h: np.clip(-g / (h + RIDGE), *bounds)
    gain_of = lambda g, h, w: -(g * w + 0.5 * (h + RIDGE) * w * w)
    a, b = value(left_g, left_h), value(right_g, right_h)
    gain = gain_of(left_g, left_h, a) + gain_of(right_g, right_h, b) - gain_of(total[0], total[1], value(total[0], total[1]))
    allowed = (left_n >= MIN_ROWS) & (right_n >= MIN_ROWS) & (signs[None, :, None] * (b - a) >= 0)
    gain = np.where(allowed, gain, -np.inf).reshape(len(gain), -1)
    best = gain.argmax(axis=1)
    nodes = np.arange(len(gain))
    feature, cut = np.divmod(best, left_g.shape[2])
    return feature, cut, a[nodes, feature, cut], b[nodes, feature, cut], gain[nodes, best]


def fit(features: np.ndarray, label: np.ndarray, signs: np.ndarray | None = None, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Trees for the chance of label 1; ``signs`` holds -1, 0 or +1 per feature (never rising, free, never falling)."""
    signs = np.array(list(FEATURES.values())) if signs is None else np.asarray(signs)
    n, width = features.shape
    edges = np.quantile(features, np.arange(1, BINS) / BINS, axis=0).T
    bins = np.stack([np.searchsorted(edges[f], features[:, f]) for f in range(width)], axis=1)  # bin b: at most edges[b]
    cell = bins + np.arange(width) * BINS
    share = (label.sum() + 0.5) / (n + 1)
    start = float(np.log(share / (1 - share)))
    margin, made = np.full(n, start), _Growing()
    for _ in range(trees):
        chance = labelled.sigmoid(margin)
        slope, curve = chance - label, chance * (1 - chance)
        whole = -slope.sum() / (curve.sum() + RIDGE)
        open_nodes, low, high = np.array([made.leaf(RATE * whole)]), np.array([-np.inf]), np.array([np.inf])
        made.roots.append(int(open_nodes[0]))
        where = np.zeros(n, np.int64)  # each row's place among the open nodes, -1 in a closed one
        final = np.full(n, open_nodes[0])
        for _ in range(depth):
            live = np.flatnonzero(where >= 0)
            key = (where[live, None] * (width * BINS) + cell[live]).ravel()
            shape = (len(open_nodes), width, BINS)
            sums = [
                np.bincount(key, None if x is None else np.repeat(x[live], width), minlength=np.prod(shape)).reshape(shape) for x in (slope, curve, None)
            ]
            feature, cut, a, b, gain = _best_split(*sums, low, high, signs)
            splits = np.flatnonzero(gain > 1e-6)
            if not len(splits):
                break
            place, opened, lows, highs = np.full(len(open_nodes), -1), [], [], []
            for s in splits:
                place[s] = len(opened)
                opened += made.split(int(open_nodes[s]), int(feature[s]), float(edges[feature[s], cut[s]]), (RATE * a[s], RATE * b[s]))
                middle, sign = (a[s] + b[s]) / 2, signs[feature[s]]
                lows += [middle if sign < 0 else low[s], middle if sign > 0 else low[s]]
                highs += [middle if sign > 0 else high[s], middle if sign < 0 else high[s]]
            own = where[live]
            right = bins[live, feature[own]] > cut[own]
            where[live] = np.where(place[own] >= 0, place[own] + right, -1)
            open_nodes, low, high = np.array(opened), np.array(lows), np.array(highs)
            still = where >= 0
            final[still] = open_nodes[where[still]]
        margin = margin + np.array(made.value)[final]
    columns = (np.array(made.feature), np.array(made.threshold), np.array(made.left), np.array(made.right), np.array(made.value), np.array(made.roots))
    return Trees(*columns, depth, start)


def train(docs: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS) -> Trees | float:
    """Trees from ``rows`` labelled documents at most (``labels.quality``), none of the held-out fold.

    With labels of one kind only the score is that label's (smoothed) share for all documents, and 0.5 without labels.
    """
    sample = labelled.sample(docs, labels, "quality", FOLDS, HELD_OUT, rows).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, 1):
                made = statistics(piece.column(1))[1]
                column = words.lists(pa.array(made.ravel()), np.full(len(made), made.shape[1]))
                yield pa.RecordBatch.from_arrays([piece.column(0), column], ["label", "features"])

    table = sample.mapInArrow(run, "label int, features array<double>").toArrow()
    label = table.column("label").to_numpy()
    if not len(label) or label.min() == label.max():
        return (float(label.sum()) + 0.5) / (len(label) + 1)
    values = pa.compute.list_flatten(table.column("features")).to_numpy().reshape(len(label), -1)
    order = np.lexsort([*values.T, label])  # the fit doesn't depend on the order of arrival
    return fit(values[order], label[order])


def judged(docs: DataFrame, model: Trees | float, cut: float = CUT, text: str = "text") -> DataFrame:
    """The documents with the COUNTS of their whole texts, ``base_failed``, ``score`` and ``kept``.

    A null text has no words, so it fails, as do empty ones. Words and lines are compared as
    they stand. Rows and columns stay as they are; columns of the added names are replaced.
    """
    held = Held(docs)
    name = held[text]
    frame, at = held.frame, held.frame.columns.index(name)
    shared = frame.sparkSession.sparkContext.broadcast(model)  # at most TREES * 2 ** (DEPTH + 1) nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = shared.value
        for batch in batches:
            for piece in words.pieces(batch, at):
                counts, features = statistics(piece.column(at))
                scores = np.full(len(counts), made) if isinstance(made, float) else made.score(features)
                failed = base_failed(counts)
                added = [*(pa.array(c) for c in counts.T.copy()), pa.array(failed), pa.array(scores), pa.array(~failed & (scores >= cut))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *added], [*piece.schema.names, *COUNTS, "base_failed", "score", "kept"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)
    out = frame.mapInArrow(run, kinds + "".join(f"{c} long, " for c in COUNTS) + "base_failed boolean, score double, kept boolean")
    return held.restored(out, {c: F.col(c) for c in (*COUNTS, "base_failed", "score", "kept")})


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that rules and trees keep; columns as they were."""
    held = Held(docs)
    frame = judged(held.frame, train(docs, labels), text=held["text"])
    return frame.where("kept").select(*held.columns()).toDF(*held.names)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: its counts, the fixed rules' outcome, the score and the verdict."""
    made = judged(picked(docs, doc_id="doc_id", text="text"), train(docs, labels))
    held_out = F.coalesce(labelled.fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return made.select("doc_id", *COUNTS, "base_failed", "kept", "score", held_out.alias("held_out"))
