"""Previous and next value per key over raw, not yet de-duplicated rows.

A plain window puts all rows of a key into one task. Raw rows have no bound per key
(every row without a symbol shares ``UNKNOWN``). Keys are dealt into a fixed number of parts by
their hash and the parts counted, from the key and the order alone. Keys of parts with few
rows, all of them in order, take the plain window: one shuffle. The others take a split scan:

    rows -> (key, day, block) -> (key, day) -> (key)

Each level looks up its neighbours inside its own group and takes what lies beyond
the group's edge from the next level, so the result equals the plain window. Group
sizes are bounded by the rows of a block, the blocks of the input and the days of
the calendar in turn.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordering import position

# Parts into which keys are dealt, and the most rows of a part that takes the plain window.
PARTS = 1 << 16
PLAIN_ROWS = 200_000


def with_neighbours(
    rows: DataFrame,
    key: str,
    day: str,
    order: Sequence[str],
    block: Column,
    value: str,
    previous: str | None = None,
    following: str | None = None,
    last_known: str | None = None,
    plain_rows: int = PLAIN_ROWS,
) -> DataFrame:
    """Add the requested neighbours of ``value`` in (``day``, ``order``) sequence per ``key``.

    ``previous`` and ``following`` name the value of the adjacent row, null included;
    ``last_known`` names the latest non-null value strictly before the row. ``order``
    must sort rows inside a day, and ``block`` must be non-decreasing along ``order``.
    ``key`` and ``day`` group null like any other value.
    """
    wanted = {"previous": previous, "following": following, "last_known": last_known}
    wanted = {kind: name for kind, name in wanted.items() if name}
    if not order:
        raise ValueError("rows of one day need an order")
    part = F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")
    unordered = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in order])
    placed = rows.withColumn("_part", part)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.max(unordered).alias("_unordered"))
    crowded = F.broadcast(sizes.where((F.col("_n") > plain_rows) | F.col("_unordered")).select("_part"))  # at most PARTS rows
    plain = _plain_window(placed.join(crowded, "_part", "left_anti").drop("_part"), key, day, order, value, wanted)
    split = _split_scan(placed.join(crowded, "_part", "left_semi").drop("_part"), key, day, order, block, value, wanted)
    return plain.unionByName(split)


def _plain_window(rows: DataFrame, key: str, day: str, order: Sequence[str], value: str, wanted: dict[str, str]) -> DataFrame:
    sequence = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_first(), *order)
    before = sequence.rowsBetween(Window.unboundedPreceding, -1)
    neighbours = {
        "previous": F.lag(value).over(sequence),
        "following": F.lead(value).over(sequence),
        "last_known": F.last(value, ignorenulls=True).over(before),
    }
    return rows.withColumns({name: neighbours[kind] for kind, name in wanted.items()})


def _beyond(groups: DataFrame, within: str, place: Column) -> DataFrame:
    """What lies just outside each group, looked up among its siblings. Every group has a row, so a
    sibling's edge is there even where its value is null: the flags tell a null from no sibling."""
    sequence = Window.partitionBy(within).orderBy(place)
    before = sequence.rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumns(
        {
            "_left": F.lag("_last").over(sequence),
            "_has_left": F.lag(F.lit(True), 1, False).over(sequence),
            "_right": F.lead("_first").over(sequence),
            "_has_right": F.lead(F.lit(True), 1, False).over(sequence),
            "_left_known": F.last("_known", ignorenulls=True).over(before),
        }
    )


_OUTSIDE = ("_left", "_has_left", "_right", "_has_right", "_left_known")


def _outer(level: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Fill edges that have no sibling from the parent level."""
    outside = parent.select(on, *[F.col(name).alias(f"_p{name}") for name in _OUTSIDE])
    filled = {
        "_left": F.when(F.col("_has_left"), F.col("_left")).otherwise(F.col("_p_left")),
        "_right": F.when(F.col("_has_right"), F.col("_right")).otherwise(F.col("_p_right")),
        "_has_left": F.col("_has_left") | F.col("_p_has_left"),
        "_has_right": F.col("_has_right") | F.col("_p_has_right"),
        "_left_known": F.coalesce("_left_known", "_p_left_known"),
    }
    return level.join(outside, on).withColumns(filled).drop(*[f"_p{name}" for name in _OUTSIDE])


def _split_scan(rows, key, day, order, block, value, wanted) -> DataFrame:
    place = position(order)
    known_place = F.when(F.col(value).isNotNull(), place)
    # Groups are structs: unlike bare columns they join on plain equality with nulls inside,
    # so the shuffle of the row windows also serves the join with the block summaries. Those
    # are aggregated before their own, much narrower shuffle; plain values of fixed width
    # keep the aggregates hash based.
    in_block = F.struct(F.col(key).alias("key"), F.col(day).alias("day"), block.alias("block"))
    placed = rows.withColumn("_in_block", in_block)

    blocks = placed.groupBy("_in_block").agg(
        F.min_by(value, place).alias("_first"), F.max_by(value, place).alias("_last"), F.max_by(value, known_place).alias("_known")
    )
    blocks = blocks.withColumn("_in_day", F.struct("_in_block.key", "_in_block.day"))
    at = F.col("_in_block.block")
    days = blocks.groupBy("_in_day").agg(
        F.min_by("_first", at).alias("_first"), F.max_by("_last", at).alias("_last"),
        F.max_by("_known", F.when(F.col("_known").isNotNull(), at)).alias("_known"),
    )
    days = _beyond(days.withColumn("_of_key", F.struct("_in_day.key")), "_of_key", F.col("_in_day.day").asc_nulls_first())
    blocks = _outer(_beyond(blocks, "_in_day", at), days, "_in_day")

    sequence = Window.partitionBy("_in_block").orderBy(*order)
    before = sequence.rowsBetween(Window.unboundedPreceding, -1)
    inside = {
        "_left": F.lag(value).over(sequence),
        "_has_left": F.lag(F.lit(True), 1, False).over(sequence),
        "_right": F.lead(value).over(sequence),
        "_has_right": F.lead(F.lit(True), 1, False).over(sequence),
        "_left_known": F.last(value, ignorenulls=True).over(before),
    }
    found = _outer(placed.withColumns(inside), blocks, "_in_block")
    results = {"previous": "_left", "following": "_right", "last_known": "_left_known"}
    return found.select(*rows.columns, *[F.col(results[kind]).alias(name) for kind, name in wanted.items()])
