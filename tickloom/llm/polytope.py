"""Near-duplicate vectors by cross-polytope hashing.

A table of hashes rotates the vectors (three rounds of random signs and a Hadamard
transform, which take d log d steps) and takes the nearest signed axis; ``CODES`` such codes
and the label make a bucket key. Each vector also goes to the buckets where one code is the
second nearest axis (multiprobe). Vectors that share a bucket, at home for one of them, are
candidates, and the cosine in double precision decides.

Equal vectors are one class from the start. Crowded buckets are cut into blocks by a hash,
and a task holds two blocks at a time. Out of a block come no pairs: for each vector come
the number of its links that this block is the first to see (by the smallest bucket key that
the two have in common), and the smallest vector it reaches inside the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import picked, written
from tickloom.llm.components import components

TABLES, CODES = 12, 3
BLOCK = 256


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def _axes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second nearest signed axis of each row."""
    size = np.abs(x)
    best = size.argmax(axis=1)
    rows = np.arange(len(x))
    code = lambda at: 2 * at + (x[rows, at] < 0)
    first = code(best)
    if x.shape[1] == 1:
        return first, first
    size[rows, best] = -1
    return first, code(size.argmax(axis=1))


def bucket_keys(vectors: np.ndarray, salt: np.ndarray, tables: int, codes: int) -> np.ndarray:
    """Keys of shape (vectors, tables, 1 + codes): the home bucket first, then one probe for each code."""
    n, d = vectors.shape
    width = 1 << max(0, int(np.ceil(np.log2(max(1, d)))))
    padded = np.zeros((n, width))
    padded[:, :d] = vectors
    out = np.zeros((n, tables, 1 + codes), np.uint64)
    for t in range(tables):
        pairs = []
        for c in range(codes):
            random, x = np.random.default_rng([t, c, width]), padded
            for _ in range(3):
                x = _hadamard(x * random.choice([-1.0, 1.0], width))
            pairs.append(_axes(x))
        for probe in range(1 + codes):
            key = words.mixed(salt + np.uint64(t))
            for c in range(codes):
                key = words.mixed(key + pairs[c][1 if probe == c + 1 else 0].astype(np.uint64))
            out[:, t, probe] = key
    return out


def _units(batch: pa.RecordBatch, vectors: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows hold comparable vectors, and these in double precision."""
    column = batch.column(vectors)
    values = pa.compute.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components turn to NaN
    ends = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy())])
    rows = [values[a:b] for a, b in zip(ends, ends[1:])]
    good = np.array([len(v) > 0 and bool(np.isfinite(v).all()) and bool(v.any()) for v in rows], bool)
    return good, rows


def _hashed(frame: DataFrame, tables: int, codes: int) -> DataFrame:
    """``(id, label, vector, salt)`` with ``keys``, salted by the label's hash: home keys and probe keys by turns, null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, rows = _units(batch, 2)
            good &= pa.compute.is_valid(batch.column(1)).to_numpy(zero_copy_only=False)
            keys, sizes = np.zeros((batch.num_rows, tables * (1 + codes)), np.uint64), np.array([len(v) for v in rows])
            for d in np.unique(sizes[good]).tolist():
                at = np.flatnonzero(good & (sizes == d))
                x = np.stack([rows[i] for i in at.tolist()])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                salt = batch.column(3).take(pa.array(at)).to_numpy().view(np.uint64)
                keys[at] = bucket_keys(x, words.mixed(salt + np.uint64(d << 40)), tables, codes).reshape(len(at), -1)
            lists = words.lists(words.longs(keys[good].ravel()), good * keys.shape[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "keys"])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in frame.schema.fields)
    return frame.mapInArrow(run, kinds + "keys array<bigint>")


def _linked(own: np.ndarray, low: int, high: int, x: np.ndarray, keys: np.ndarray, key: int, width: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of one cell that are links and of which ``key`` is the smallest common bucket key."""
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    cosine = x[left] @ x[right].T
    a, b = np.nonzero(cosine >= threshold)
    a, b = left[a], right[b]
    if low == high:
        a, b = a[a < b], b[a < b]
    for start in range(0, len(a), 4096):
        i, j = a[start : start + 4096], b[start : start + 4096]
        mine, theirs = keys[i], keys[j]
        smallest = np.full(len(i), np.iinfo(np.int64).max)
        for column in range(keys.shape[1]):
            table = column - column % width
            for other in range(table, table + width):
                same = mine[:, column] == theirs[:, other]
                smallest[same] = np.minimum(smallest[same], mine[same, column])
        yield i[smallest == key], j[smallest == key]


def _roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    """The smallest node that each node reaches."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def _cells(classes: DataFrame, threshold: float, width: int, kind: str) -> DataFrame:
    """``(id, links, reached)`` from each cell: a bucket's pair of blocks."""
    slots = classes.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    sizes = slots.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slots = slots.join(sizes.select("key", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("parts")), "key")
    slots = slots.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    slots = slots.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = slots.select("id", "key", low.alias("low"), high.alias("high"), "own").join(classes.select("id", "n", "vector", "keys"), "id")
    dealt = dealt.select("key", "low", "high", "own", "id", "n", "vector", "keys").repartition("key", "low", "high")
    dealt = dealt.sortWithinPartitions("key", "low", "high", "id")

    def compared(rows: list[tuple]) -> Iterator[tuple]:
        key, low, high = rows[0][:3]
        x = np.array([r[6] for r in rows], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        own, count, keys = np.array([r[3] for r in rows]), np.array([r[5] for r in rows]), np.array([r[7] for r in rows])
        links, pairs = np.zeros(len(rows), np.int64), []
        for i, j in _linked(own, low, high, x, keys, key, width, threshold):
            np.add.at(links, i, count[j])
            np.add.at(links, j, count[i])
            pairs.extend(zip(i.tolist(), j.tolist()))
        if pairs:
            for i, root in enumerate(_roots(len(rows), pairs)):
                if links[i]:
                    yield rows[i][4], int(links[i]), rows[root][4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out = None, [], []
        schema = None
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field(4).type), ("links", pa.int64()), ("reached", batch.schema.field(4).type)])
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    out.extend(compared(rows) if len(rows) > 1 else ())
                    at, rows = row[:3], []
                rows.append(row)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema)
            out = []
        out.extend(compared(rows) if len(rows) > 1 else ())
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in out], schema)

    return dealt.mapInArrow(run, f"id {kind}, links bigint, reached {kind}")


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, tables: int = TABLES, codes: int = CODES,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Per row: its id, ``n_links``, ``component_id`` and ``kept``.

    Links join vectors of one label (of any simple type) and one length with a cosine of
    ``threshold`` or more, as far as hashing proposes them. Vectors that are null, empty,
    zero, or hold null or non-finite components, and rows with a null label or id, link
    with nothing. ``n_links`` counts the other rows linked directly, copies too. Rows that
    share an id are one node, and each counts as a row. A row with a null id has no
    component and is kept.
    """
    source = picked(vectors, id=key, label=label, vector=vector)
    if source.schema["label"].dataType.typeName() in ("float", "double"):
        source = source.withColumn("label", F.col("label") + F.lit(0.0))  # -0.0 is 0.0
    source = source.withColumn("label", F.col("label").cast("string")).withColumn("salt", F.xxhash64("label"))
    kind = source.schema["id"].dataType.simpleString()
    hashed = written(_hashed(source, tables, codes), "hashed")
    usable = hashed.where((F.size("keys") > 0) & F.col("id").isNotNull())
    same = ["label", "vector"]
    groups = usable.groupBy(*same).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.min("keys").alias("keys"))
    groups = written(groups.withColumn("id", F.xxhash64("label", "vector", "rep")), "vector-classes")
    cells = written(_cells(groups.select("id", "n", "vector", "keys"), threshold, 1 + codes, "bigint"), "cells")
    counted = cells.groupBy("id").agg(F.sum("links").alias("links"))
    rows = usable.join(groups.select(*same, F.col("id").alias("node"), "n"), same).select("id", "node", "n")
    rows = rows.groupBy("id", "node", "n").agg(F.count(F.lit(1)).alias("copies"))
    one_id = rows.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    one_id = rows.join(one_id.select("id", "a"), "id").select("a", F.col("node").alias("b"))
    grouped = components(cells.select(F.col("id").alias("a"), F.col("reached").alias("b")).union(one_id))
    placed = groups.select(F.col("id").alias("node"), "rep", *same, "n").join(grouped, "node", "left")
    placed = placed.join(counted.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.min("rep").alias("name"))
    placed = placed.join(names, "component").select(*same, (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "name")
    usable_row = F.when((F.size("keys") > 0) & F.col("id").isNotNull(), F.col("label"))
    out = hashed.withColumn("label", usable_row).join(placed, same, "left")
    name = F.when(F.col("id").isNotNull(), F.coalesce("name", "id"))
    return out.select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), name.alias("component_id"),
        name.eqNullSafe(F.col("id")).alias("kept"),
    )
