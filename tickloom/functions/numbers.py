"""Number parsing and per-row arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.dates import stripped

_PLAIN_DECIMAL = r"^[+-]?\d+(\.\d+)?$"
_ANY_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_FRACTION = r"^[+-]?\d+\.\d*$"


def _comma_to_point(text: Column) -> Column:
    """With a comma present every dot is a thousands mark and the comma is the decimal point."""
    swapped = F.translate(F.translate(text, ".", ""), ",", ".")
    return F.when(text.contains(","), swapped).otherwise(text)


def strict_decimal(text: Column) -> Column:
    """Plain signed decimals only; exponents, a bare ``.5`` and words are null.
    ``1,234.56`` reads as 1.23456 because the comma always marks the decimals."""
    cleaned = _comma_to_point(F.trim(text))
    return F.when(cleaned.rlike(_PLAIN_DECIMAL), cleaned.try_cast("double"))


def lenient_decimal(text: Column, places: int = 6) -> Column:
    """Same comma rule, any finite decimal notation, rounded to ``places``."""
    cleaned = _comma_to_point(stripped(text))
    return F.round(F.when(cleaned.rlike(_ANY_DECIMAL), cleaned.try_cast("double")), places)


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_long(text: Column) -> Column:
    """Whole numbers; a decimal text loses its fraction; other text is null."""
    trimmed = F.trim(text.cast("string"))
    whole = F.when(trimmed.rlike(_FRACTION), F.regexp_extract(trimmed, r"^([+-]?\d+)\.", 1)).otherwise(trimmed)
    return whole.try_cast("bigint")


def number_column(column: Column, kind: str) -> Column:
    """Double of a column that may already be numeric, with NaN read as missing."""
    if kind == "string":
        return F.when(F.trim(column).rlike(_ANY_DECIMAL), F.trim(column).try_cast("double"))
    as_double = column.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def implied_hundredths(text: Column) -> Column:
    """Digits with two implied decimals as an exact decimal; blank is zero, anything else
    that is no integer is null."""
    digits = F.trim(text)
    whole = F.when(digits == "", F.lit("0")).when(digits.rlike(r"^[+-]?\d+$"), digits)
    return (whole.try_cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def whole_or_zero(text: Column) -> Column:
    digits = F.trim(text)
    return F.when(digits == "", F.lit(0).cast("bigint")).otherwise(digits.try_cast("bigint"))


def percent_change(value: Column, previous: Column) -> Column:
    """Null where there is no previous value or it is zero."""
    usable = F.when(previous != 0, previous)
    return (value - usable) / usable * F.lit(100)


def millions(value: Column) -> Column:
    return value.cast("double") / F.lit(1e6)
