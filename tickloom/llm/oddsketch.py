"""MinHash near-duplicates with odd sketches.

Each text's distinct word shingles give MinHash samples. Bands of samples propose pairs;
the samples, folded by parity into a bitmap (the odd sketch), decide which pairs are worth
a look: the bits in which two sketches differ count the samples in which the sets differ. A
second bitmap folds the whole set; two of these never differ in more bits than the sets
differ in shingles, so it excludes pairs for certain. Pairs that pass are confirmed on the
full sets, so no link is ever made by an estimate.

Texts of equal sets are one class from the start. Within a bucket every class is first held
against the bucket's smallest one, then, where the links so far leave several components in
the bucket, against other members chosen by a hash. All pairs of different components that
are left after that are proposed in blocks of bounded size; links inside a component change
nothing. So a group of many near copies costs about as many checks as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import words
from tickloom.llm.common import Held, picked, written
from tickloom.llm.components import components

BANDS, ROWS = 24, 5
SKETCH_BITS, SET_BITS = 512, 2048
_BYTES = (SKETCH_BITS + SET_BITS) // 8
BLOCK = 256
#: After the first hubs, other members of the split buckets are hubs so many times.
TURNS = 1
#: How many standard deviations an estimate may fall short of the threshold.
SLACK = 5.5


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = words.mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:count] | np.uint64(1), seeds[count:]


def _sets(texts: words.Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, one text after the other, and the n + 1 offsets."""
    counts, first = texts.counts(), texts.first
    n = np.where(counts >= length, counts - length + 1, 0)
    hashes = words.shingle_hashes(texts.hashes, length)
    row = np.repeat(np.arange(len(counts)), n)
    place = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(row)) if len(row) else np.zeros(0, np.int64)
    row_hash = hashes[place]
    for k in range(1, length):  # too few words: all of them are the one shingle
        few = np.flatnonzero(counts == k)
        if len(few):
            whole = words.mixed(words.shingle_hashes(texts.hashes, k)[first[few]] + np.uint64(k))
            row, row_hash = np.concatenate([row, few]), np.concatenate([row_hash, whole])
    order = np.lexsort([row_hash, row])
    row, row_hash = row[order], row_hash[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (row_hash[1:] != row_hash[:-1])
    row, row_hash = row[new], row_hash[new]
    return row_hash, np.searchsorted(row, np.arange(len(counts) + 1))


def _samples(hashes: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """MinHash samples of each non-empty set: one row of ``count`` values per set."""
    multiply, add = _permutations(count)
    out = np.empty((len(offsets) - 1, count), np.uint64)
    for i in range(count):
        value = hashes * multiply[i]
        value += add[i]
        value ^= value >> np.uint64(31)
        value *= multiply[count - 1 - i]
        out[:, i] = np.minimum.reduceat(value, offsets[:-1])
    return out


def _folded(row: np.ndarray, values: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The parity bitmap of each row's values, as bytes; ``row`` ascends. A few hundred rows are spread out at a time."""
    spots, out = (values % np.uint64(bits)).astype(np.int64), np.empty((n, bits // 8), np.uint8)
    for start in range(0, n, 512):
        count = min(512, n - start)
        low, high = np.searchsorted(row, [start, start + count])
        places = (row[low:high] - start) * bits + spots[low:high]
        odd = (np.bincount(places, minlength=count * bits) & 1).astype(np.uint8)
        out[start : start + count] = np.packbits(odd.reshape(count, bits), axis=1)
    return out


def _prints(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Two fingerprints of each set; those of the empty set are 0."""
    full = np.flatnonzero(np.diff(offsets))
    prints = np.zeros((2, len(offsets) - 1), np.uint64)
    if len(full):
        prints[0, full] = np.add.reduceat(words.mixed(hashes), offsets[full])
        prints[1, full] = np.add.reduceat(words.mixed(words.mixed(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))), offsets[full])
    return prints


def _signed(batch: pa.RecordBatch, text: int, alphabet: words.Alphabet, length: int, bands: int, rows: int) -> list[pa.Array]:
    """Size, two fingerprints, band keys and odd sketch of each text's set; no keys for empty sets."""
    hashes, offsets = _sets(words.words_of(*words.text_bytes(batch.column(text)), alphabet), length)
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    starts = np.append(offsets[full], len(hashes))
    prints = _prints(hashes, offsets)
    keys, sketch = np.zeros((0, bands), np.uint64), np.zeros((0, _BYTES), np.uint8)
    if len(full):
        samples = _samples(hashes, starts, bands * rows)
        grouped = words.mixed(samples).reshape(len(full), bands, rows)
        keys = np.zeros((len(full), bands), np.uint64)
        for i in range(rows):
            keys = words.mixed(keys + grouped[:, :, i])
        keys = words.mixed(keys + np.arange(bands, dtype=np.uint64))
        sampled = words.mixed(samples + np.arange(bands * rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        row = np.repeat(np.arange(len(full)), size[full])
        sketch = np.concatenate(
            [_folded(np.repeat(np.arange(len(full)), bands * rows), sampled.ravel(), len(full), SKETCH_BITS), _folded(row, words.mixed(hashes), len(full), SET_BITS)],
            axis=1,
        )
    held = np.zeros(len(size), np.int64)
    held[full] = 1
    sketches = np.zeros((len(size), _BYTES), np.uint8)
    sketches[full] = sketch
    fixed = pa.array([row.tobytes() for row in sketches], pa.binary())
    return [words.longs(size), words.longs(prints[0]), words.longs(prints[1]), words.lists(words.longs(keys.ravel()), held * bands), fixed]


def _most_differing(threshold: float, samples: int, bits: int = SKETCH_BITS) -> int:
    """The number of differing bits above which a pair's sets can be taken as less alike than the threshold.

    At the threshold t = samples * (1 - threshold) samples differ on average, each of which
    flips two bits; 2 t flips leave (1 - (1 - 2 / bits) ** (2 t)) / 2 of the bits set. The
    count of bits varies with t and with the flips that cancel out: SLACK standard
    deviations are allowed.
    """
    t = samples * (1 - threshold)
    left = (1 - 2 / bits) ** (2 * t)
    by_samples = 2 * (t * threshold) ** 0.5 * left
    by_chance = 2 * t * (2 / bits) ** 0.5
    return int(bits * (1 - left) / 2 + SLACK * (by_samples**2 + by_chance**2) ** 0.5)


def _possible(left: np.ndarray, right: np.ndarray, m: np.ndarray, n: np.ndarray, percent: int, most: int) -> np.ndarray:
    """Which pairs of sketches (rows of 64-bit words) of sets with m and n shingles may be links."""
    differ = np.bitwise_count(left ^ right)
    cut = SKETCH_BITS // 64
    apart = (100 - percent) * (m + n) // (100 + percent)  # no link differs in more shingles
    return (differ[:, :cut].sum(axis=1) <= most) & (differ[:, cut:].sum(axis=1) <= apart) & (100 * np.minimum(m, n) >= percent * np.maximum(m, n))


def _rows_of_words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _node() -> Column:
    """One number for both fingerprints of a set: equal for equal sets only."""
    one = F.lpad(F.conv(F.hex("one"), 16, 10), 20, "0")
    two = F.lpad(F.pmod("two", F.lit(10**18)).cast("string"), 18, "0")
    return F.concat(one, two).cast("decimal(38,0)")


def _full_sets(docs: DataFrame, alphabet: words.Alphabet, length: int) -> DataFrame:
    """``(one, two, shingles)``: fingerprints and sets of rows ``(id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, 1):
                hashes, offsets = _sets(words.words_of(*words.text_bytes(piece.column(1)), alphabet), length)
                one, two = _prints(hashes, offsets)
                made = [words.longs(one), words.longs(two), words.lists(words.longs(hashes), np.diff(offsets))]
                yield pa.RecordBatch.from_arrays(made, ["one", "two", "shingles"])

    return docs.select("id", "text").mapInArrow(run, "one bigint, two bigint, shingles array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets with 100 * common >= percent * united."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    united = F.size("left") + F.size("right") - F.col("common")
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("common"), "left", "right")
        .where(100 * F.col("common").cast("long") >= percent * united.cast("long")).select("a", "b")
    )


def _promising(pairs: DataFrame, sketches: DataFrame, percent: int, most: int) -> DataFrame:
    """The pairs whose sizes and sketches leave a link possible."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("left"), F.col("size").alias("m"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("right"), F.col("size").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m, n = (batch.column(i).to_numpy() for i in (4, 5))
                good = _possible(_rows_of_words(batch.column(2)), _rows_of_words(batch.column(3)), m, n, percent, most)
                yield batch.select([0, 1]).filter(pa.array(good))

    sized = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", "m", "n")
    return sized.mapInArrow(run, "a decimal(38,0), b decimal(38,0)")


def _split_buckets(slots: DataFrame, links: DataFrame) -> DataFrame:
    """``(key, node, component)`` of the buckets whose members the links leave in more than one component."""
    members = slots.join(components(links), "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    members = written(members, "members")
    split = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    return members.join(split, "key", "left_semi")


def _to_hubs(members: DataFrame, turn: int) -> DataFrame:
    """Each bucket's members outside the component of one of them, chosen by a hash, paired with that one."""
    order = F.xxhash64("key", "node", F.lit(turn))
    hubs = members.groupBy("key").agg(F.min(F.struct(order.alias("order"), "node", "component")).alias("hub"))
    pairs = members.join(hubs, "key").where(F.col("component") != F.col("hub.component"))
    return pairs.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def _cross(members: DataFrame, most: int, percent: int) -> DataFrame:
    """Pairs of different components that sizes and sketches leave possible, among the members of each bucket.

    ``members``: (key, node, component, sketch, size). Buckets are cut into blocks of about
    BLOCK members by a hash, and a task holds two blocks at a time.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = members.join(sizes, "key").select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select("key", low.alias("low"), high.alias("high"), "own", "node", "component", "sketch", "size")
    dealt = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    kind = pa.decimal128(38, 0)

    def compared(rows: list[tuple]) -> Iterator[tuple]:
        sketch = np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1).view(np.uint64)
        low, high, own = rows[0][1], rows[0][2], np.array([r[3] for r in rows])
        labels = {x: i for i, x in enumerate(dict.fromkeys(r[5] for r in rows))}
        component, size = np.array([labels[r[5]] for r in rows]), np.array([r[7] for r in rows])
        for i in np.flatnonzero(own == low).tolist():
            can = (own == high) & (component != component[i])
            if low == high:
                can[: i + 1] = False
            others = np.flatnonzero(can)
            for j in others[_possible(sketch[others], sketch[i], size[others], size[i], percent, most)].tolist():
                yield min(rows[i][4], rows[j][4]), max(rows[i][4], rows[j][4])

    def table(pairs: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], kind) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != at:
                    out.extend(compared(rows) if len(rows) > 1 else ())
                    at, rows = row[:3], []
                    if len(out) > 10_000:
                        yield table(out)
                        out = []
                rows.append(row)
        out.extend(compared(rows) if len(rows) > 1 else ())
        if out:
            yield table(out)

    return dealt.mapInArrow(run, "a decimal(38,0), b decimal(38,0)").distinct()


def near_duplicates(
    docs: DataFrame, length: int = 5, percent: int = 80, alphabet: words.Alphabet = words.UNSPACED,
    bands: int = BANDS, rows: int = ROWS, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per row of the documents: its id, ``n_shingles``, ``component_id``, ``kept``.

    Links join texts whose sets of ``length``-word shingles have 100 * common >= ``percent``
    * united. A text of fewer words has all of them as its one shingle; null, empty and
    wordless texts have no shingle and no link. An id names one document: rows that share an
    id (repeated rows, or other texts) are one node. ``component_id`` is the smallest id
    reachable; a row with a null id links with nothing, has no component and is kept.
    """
    source = picked(docs, id=key, text=text)
    kind = source.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch, 1):
                made = _signed(piece, 1, alphabet, length, bands, rows)
                yield pa.RecordBatch.from_arrays([piece.column(0), *made], ["id", "size", "one", "two", "keys", "sketch"])

    signed = source.mapInArrow(sign, f"id {kind}, size bigint, one bigint, two bigint, keys array<bigint>, sketch binary")
    signed = written(signed.withColumn("node", _node()).drop("one", "two"), "signed")
    full = signed.where((F.col("size") > 0) & F.col("id").isNotNull())
    equal = full.groupBy("node").agg(F.min("id").alias("id"), F.min(F.struct("size", "keys", "sketch")).alias("set"))
    classes = written(equal.select("node", "id", "set.*"), "classes")
    slots = classes.select("node", F.explode("keys").alias("key"))
    crowded = slots.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1").select("key", "hub")
    slots = written(slots.join(crowded, "key"), "slots")
    sketches = classes.select("node", "sketch", "size")
    most = _most_differing(percent / 100, bands * rows)

    involved = classes.join(slots.select("node").distinct(), "node", "left_semi").select("node", "id")
    texts = source.join(involved.select("id").distinct(), "id", "left_semi")
    sets = _full_sets(texts, alphabet, length).withColumn("node", _node()).drop("one", "two")
    sets = written(sets.join(involved, "node", "left_semi").dropDuplicates(["node"]), "sets")

    checked = lambda pairs: written(_confirmed(_promising(pairs, sketches, percent, most), sets, percent), "confirmed")
    links = checked(slots.where("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    for turn in range(TURNS):
        links = links.union(checked(_to_hubs(_split_buckets(slots, links), turn)))
    rest = checked(_cross(_split_buckets(slots, links).join(sketches, "node"), most, percent))

    owners = full.select("id", "node").distinct()
    lowest = owners.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("top")).where("a < top").select("id", "a")
    one_id = owners.join(lowest, "id").select("a", F.col("node").alias("b"))
    grouped = components(links.union(rest).union(one_id))
    placed = written(
        signed.select("id", "size", "node").join(grouped, "node", "left")
        .select("id", "size", F.when(F.col("size") > 0, F.coalesce("component", "node")).alias("group")),
        "placed",
    )
    names = placed.where("group is not null").groupBy("group").agg(F.min("id").alias("name"))
    name = F.when(F.col("id").isNotNull(), F.coalesce("name", "id"))
    return placed.join(names, "group", "left").select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"), name.alias("component_id"), name.eqNullSafe(F.col("id")).alias("kept")
    )


def without_duplicates(docs: DataFrame, length: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one of each group of near duplicates (the smallest id); columns as they were.

    Repeated rows of a kept id stay as they are: they are one document.
    """
    held = Held(docs)
    named = held.frame.withColumn("id", F.col(held[key]))
    dropped = near_duplicates(docs, length, percent, key=key, text=text).where(~F.col("kept")).select(F.col(key).alias("id")).distinct()
    return named.join(dropped, "id", "left_anti").select(*held.columns()).toDF(*held.names)
