"""Types of text columns, found by one aggregate over all rows, and the typed table.

Every value has a kind, a bit; a column's bits are or-ed, which no order or partitioning of the
rows can change; and the set of kinds that were seen decides the type:

    nothing -> null;  whole numbers -> long;  any other numbers -> double;  days -> date
    days and times -> timestamp;  anything else, or numbers beside days -> text
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG, DOUBLE, DATE, TIMESTAMP, TEXT = (1 << i for i in range(5))
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
_SPELLED = {"long": "bigint", "double": "double", "date": "date", "timestamp": "timestamp", "text": "string", "null": "string"}


def kind(text: Column) -> Column:
    """The kind of one value as a bit; 0 for null and blank ones. Blanks around a value don't count."""
    value = F.trim(text)
    whole = value.rlike(_WHOLE) & value.try_cast("bigint").isNotNull()
    return (
        F.when(value.isNull() | (value == ""), 0).when(whole, LONG).when(value.rlike(_NUMBER), DOUBLE)
        .when(value.rlike(_DAY) & value.try_cast("date").isNotNull(), DATE)
        .when(value.rlike(_TIME) & value.try_cast("timestamp").isNotNull(), TIMESTAMP).otherwise(TEXT)
    )


def merged(kinds: Column) -> Column:
    """The type that holds all kinds seen."""
    numbers, days = kinds.bitwiseAND(LONG | DOUBLE) != 0, kinds.bitwiseAND(DATE | TIMESTAMP) != 0
    return (
        F.when(kinds == 0, "null").when((kinds.bitwiseAND(TEXT) != 0) | (numbers & days), "text")
        .when(days, F.when(kinds == DATE, "date").otherwise("timestamp")).when(kinds == LONG, "long").otherwise("double")
    )


def inferred_types(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, type, filled): one row per column; ``filled`` counts its values that are neither null nor blank."""
    bits = table.select(*[kind(F.col(name)).alias(f"_{i}") for i, name in enumerate(columns)])
    whole = bits.agg(*[f(c).alias(f"{n}{c}") for c in bits.columns for n, f in (("kinds", F.bit_or), ("filled", _filled))])
    entries = [F.struct(F.lit(name).alias("column"), F.coalesce(f"kinds_{i}", F.lit(0)).alias("kinds"), F.col(f"filled_{i}").alias("filled")) for i, name in enumerate(columns)]
    rows = whole.select(F.explode(F.array(*entries)).alias("c"))
    return rows.select("c.column", merged(F.col("c.kinds")).alias("type"), "c.filled")


def _filled(name: str) -> Column:
    return F.count_if(F.col(name) != 0)


def typed(table: DataFrame, types: DataFrame) -> DataFrame:
    """The table with each column of ``inferred_types`` in its type; blank values are null. All rows fit by construction."""
    known = {row["column"]: row["type"] for row in types.collect()}  # one row per column
    value = {name: F.nullif(F.trim(name), F.lit("")) for name in known}
    return table.withColumns({name: value[name] if kind in ("text", "null") else value[name].cast(_SPELLED[kind]) for name, kind in known.items()})
