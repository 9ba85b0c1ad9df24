"""Whole-table profile, exact quantiles and correlations."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTILES = (0.25, 0.5, 0.75)
CORRELATED = ("open", "high", "low", "close", "volume", "daily_pct_change")
EXACT_ROWS = 100_000  # most values one exact percentile buffer may hold
_SPLITS = 200  # slices per round
_ACCURACY = 1000


def _as_number(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.DateType):
        return F.datediff(F.col(field.name), F.lit("1970-01-01").cast("date")).cast("double")
    return F.col(field.name).cast("double")


def _is_measured(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.NumericType, T.DateType))


def profile(table: DataFrame, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """One row per column: counts, moments and quartiles of numbers and dates (dates as
    days since 1970, without a deviation), distinct count and most frequent text of strings.
    """
    fields = table.schema.fields
    measured = [field for field in fields if _is_measured(field)]
    texts = [field for field in fields if isinstance(field.dataType, T.StringType)]
    numbers = table.select(*[_as_number(field).alias(field.name) for field in measured])
    parts = []
    if measured:
        numbers.persist()  # several passes follow; all of them end here
        try:
            moments = _number_profile(numbers, measured).collect()  # one row per column
            sizes = {row["column"]: row["count"] for row in moments}
            quartiles = exact_quantiles(numbers, list(sizes), QUARTILES, exact_rows, sizes)
        finally:
            numbers.unpersist()
        found = table.sparkSession.createDataFrame(
            [tuple(row) for row in moments],
            "column string, count bigint, mean double, std double, min double, max double",
        )
        parts.append(found.join(F.broadcast(quartiles), "column", "left"))
    if texts:
        parts.append(_text_profile(table, [field.name for field in texts]))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts).select(
        "column", "count", "unique", "top", "freq", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def _number_profile(numbers: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """A single pass; the one result row is then turned into a row per column."""
    entries = []
    for field in fields:
        value = F.col(field.name)
        spread = F.lit(None).cast("double") if isinstance(field.dataType, T.DateType) else F.stddev_samp(value)
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.count(value).alias("count"),
                F.avg(value).alias("mean"),
                spread.alias("std"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
            )
        )
    return numbers.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def _text_profile(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """All text columns in one pass, counted by grouping: a mode aggregate would hold every
    value of a column in one buffer."""
    entries = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).alias("value")) for name in names])
    counts = (
        table.select(F.inline(entries))
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counts.groupBy("column").agg(
        F.sum("rows").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.max("rows").alias("freq"),
        F.min_by("value", F.struct(-F.col("rows"), F.col("value"))).alias("top"),
    )


@dataclass
class _Target:
    """One wanted rank of one column and the value range it is known to lie in."""

    column: str
    rank: int
    total: int
    low: float = -math.inf  # inclusive
    high: float = math.inf  # inclusive
    value: float | None = None

    @property
    def slot(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high

    def inside(self) -> Column:
        v = F.col(self.column)
        return F.when((v >= F.lit(self.low)) & (v <= F.lit(self.high)), v)


def exact_quantiles(
    numbers: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    exact_rows: int = EXACT_ROWS,
    sizes: dict[str, int] | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles of double columns: (column, q25, q50, ...).

    Spark's exact ``percentile`` merges all distinct values into one buffer, so it only
    ever sees ``exact_rows`` values here. Columns of every size are narrowed first:
    approximate quantiles cut the value range into slices, a count per slice tells which one
    holds the wanted rank, and only that slice is looked at again. Each round is two
    aggregations for all columns together, and only slice edges and counts reach the driver.
    """
    sizes = sizes or numbers.agg(*[F.count(name).alias(name) for name in columns]).collect()[0].asDict()
    targets: dict[tuple[str, int], _Target] = {}
    places = {(name, p): p * (sizes[name] - 1) for name in columns if sizes[name] for p in probabilities}
    for (name, _), place in places.items():
        for rank in {math.floor(place), math.ceil(place)}:
            targets.setdefault((name, rank), _Target(name, rank, sizes[name]))
    wide = list(targets.values())
    while wide:
        _narrow(numbers, wide)
        wide = [t for t in targets.values() if t.value is None and t.total > exact_rows]
    _finish(numbers, [t for t in targets.values() if t.value is None])

    def interpolated(name: str, p: float) -> float | None:
        if (name, p) not in places:
            return None
        place = places[name, p]
        low, high = targets[name, math.floor(place)].value, targets[name, math.ceil(place)].value
        return low + (high - low) * (place - math.floor(place))

    names = [f"q{round(p * 100):d}" for p in probabilities]
    schema = T.StructType([T.StructField("column", T.StringType())] + [T.StructField(n, T.DoubleType()) for n in names])
    rows = [(name, *[interpolated(name, p) for p in probabilities]) for name in columns]
    return numbers.sparkSession.createDataFrame(rows, schema)


def _narrow(numbers: DataFrame, targets: Sequence[_Target]) -> None:
    """Move every target into one slice of its range."""
    slots = {t.slot: t for t in targets}
    cuts = [i / _SPLITS for i in range(_SPLITS + 1)]
    found = numbers.agg(*[F.percentile_approx(t.inside(), cuts, _ACCURACY).alias(f"s{i}") for i, t in enumerate(slots.values())])
    splits, inputs = {}, {}
    for i, (slot, edges) in enumerate(zip(slots, found.collect()[0])):
        # Every edge gets a slice of its own, so a value that fills a slice ends the search.
        cut = sorted({e for edge in edges for e in (edge, math.nextafter(edge, math.inf))})
        splits[slot] = [-math.inf, *cut, math.inf]
        inputs[slot] = slots[slot].inside().alias(f"v{i}")
    order = list(slots)
    bucketizer = Bucketizer(
        splitsArray=[splits[slot] for slot in order],
        inputCols=[f"v{i}" for i in range(len(order))],
        outputCols=[f"b{i}" for i in range(len(order))],
        handleInvalid="keep",
    )
    sliced = bucketizer.transform(numbers.select(*[inputs[slot] for slot in order]))
    entries = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(f"b{i}").alias("slice")) for i in range(len(order))])
    counted = sliced.select(F.inline(entries)).groupBy("slot", "slice").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[int, dict[int, int]] = {i: {} for i in range(len(order))}
    for row in counted:
        if row["slice"] is not None and row["slice"] < len(splits[order[row["slot"]]]) - 1:
            counts[row["slot"]][int(row["slice"])] = row["n"]
    for target in targets:
        number = order.index(target.slot)
        edges, sizes = splits[target.slot], counts[number]
        for part in sorted(sizes):
            if target.rank < sizes[part]:
                break
            target.rank -= sizes[part]
        target.total = sizes[part]
        target.low = max(target.low, edges[part])
        target.high = min(target.high, math.nextafter(edges[part + 1], -math.inf) if edges[part + 1] < math.inf else math.inf)
        if target.low == target.high:
            target.value = target.low


def _finish(numbers: DataFrame, targets: Sequence[_Target]) -> None:
    """The exact ranks of ranges that are small by now, in one aggregation."""
    slots: dict[tuple[str, float, float], list[_Target]] = {}
    for target in targets:
        slots.setdefault(target.slot, []).append(target)
    if not slots:
        return
    asked = [
        F.percentile(group[0].inside(), F.array(*[F.lit(t.rank / (t.total - 1) if t.total > 1 else 0.0) for t in group]))
        for group in slots.values()
    ]
    for group, values in zip(slots.values(), numbers.agg(*asked).collect()[0]):
        for target, value in zip(group, values):
            target.value = value


def correlation_matrix(table: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pairwise-complete Pearson correlation, long form (x, y, correlation); null where a
    column does not vary over the pair's rows. One pass computes every pair.

    Constant means min = max. A deviation is no test for it: merged from partial buffers,
    that of a constant may come out as a residue, depending on how rows are partitioned.
    """
    nullable = {field.name for field in table.schema.fields if field.nullable}

    def guarded(left: str, right: str) -> tuple[Column, Column]:
        # A column without nulls needs no guard; its deviation is then shared by all its pairs.
        x, y = F.col(left).cast("double"), F.col(right).cast("double")
        both = [F.col(name).isNotNull() for name in {left, right} if name in nullable]
        if both:
            complete = reduce(lambda a, b: a & b, both)
            x, y = F.when(complete, x), F.when(complete, y)
        return x, y

    def pair(left: str, right: str) -> Column:
        x, y = guarded(left, right)
        varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
        if left == right:
            return F.when(varies, F.lit(1.0))
        value = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
        return F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value)))

    pairs = [(name, name) for name in columns] + list(combinations(columns, 2))
    row = table.agg(*[pair(left, right).alias(f"c{i}") for i, (left, right) in enumerate(pairs)])
    entries = []
    for i, (left, right) in enumerate(pairs):
        for x, y in {(left, right), (right, left)}:
            entries.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"c{i}").alias("correlation")))
    return row.select(F.inline(F.array(*entries)))
