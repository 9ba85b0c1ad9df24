"""Input order of rows as an expression for first-and-last aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def position(order: Sequence[str]) -> Column:
    """One sortable value for the order columns. A single numeric order column is used as
    it is, which keeps the aggregate hash based; several become a struct."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)
