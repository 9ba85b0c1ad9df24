"""What must hold for each row of a table, and what happens to rows for which it doesn't.

``warn``    the row stays, the breach is counted
``divert``  the row goes to quarantine, with the names of all expectations it breaks
``reject``  a single such row, and the whole table isn't taken

A condition that is null (a value isn't there) counts as broken.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIONS = ("warn", "divert", "reject")
KEPT, DIVERTED = "kept", "diverted"


@dataclass(frozen=True)
class Expectation:
    """A condition by name, with what is done where it doesn't hold."""

    name: str
    holds: Column
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {', '.join(ACTIONS)}, not {self.action!r}")


@dataclass(frozen=True)
class Finding:
    """How many rows break an expectation."""

    name: str
    action: str
    rows: int


def distinct_names(expectations: Sequence[Expectation]) -> None:
    names = [x.name for x in expectations]
    if len(set(names)) < len(names):
        raise ValueError("each expectation needs a name of its own")


def judged(table: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """The rows with ``broken``, the names of the expectations they break, and ``standing``: kept or diverted.

    Each condition is evaluated once a row. Columns of those two names are not allowed.
    """
    distinct_names(expectations)
    if taken := {"broken", "standing"} & {name.lower() for name in table.columns}:
        raise ValueError(f"the table has a column named {sorted(taken)[0]}")
    breaches = [F.when(~F.coalesce(x.holds, F.lit(False)), F.lit(x.name)) for x in expectations]
    listed = F.array_compact(F.array(*breaches)) if breaches else F.array().cast("array<string>")
    diverting = F.array(*(F.lit(x.name) for x in expectations if x.action == "divert")).cast("array<string>")
    named = table.withColumn("broken", listed)
    return named.withColumn("standing", F.when(F.arrays_overlap("broken", diverting), DIVERTED).otherwise(KEPT))


def counts(expectations: Sequence[Expectation]) -> list[Column]:
    """Aggregates over judged rows: rows, diverted rows, and for each expectation the rows that break it."""
    broken = [F.count_if(F.array_contains("broken", x.name)).alias(f"broken_{i}") for i, x in enumerate(expectations)]
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("standing") == DIVERTED).alias("diverted"), *broken]


def findings(expectations: Sequence[Expectation], counted: dict[str, int]) -> list[Finding]:
    return [Finding(x.name, x.action, counted[f"broken_{i}"]) for i, x in enumerate(expectations)]
