"""Date parsing. Every parser is total: text it does not accept becomes null, so
nothing here can stop a job under ANSI mode.

A text's shape (its digits replaced by 9) is compared with fixed shapes and its parts
are put in ISO order for Spark's own date cast. That stays inside codegen and, unlike
pattern formatters, raises no exception per bad row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_DAY = "1970-01-01"
_CLOCK = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
_DAY_FIRST = r"^\?(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"
_YEAR_FIRST = r"^\?(\d{4})(?:[-/.](\d{1,2})[-/.](\d{1,2})|(\d{2})(\d{2}))$"
#: White space of any kind at a text's edges, and a zone behind a clock time.
_EDGES = r"^[\s\u00A0\u2000-\u200A\u202F\u3000]+|[\s\u00A0\u2000-\u200A\u202F\u3000]+$"
_ZONE = r"(:[0-9]{2}(?:\.[0-9]+)?) ?(?:Z|UTC|[+-][0-9]{2}:?[0-9]{2})$"


# English month names and their short forms.
MONTHS = (
    ("january", "jan"), ("february", "feb"), ("march", "mar"), ("april", "apr"), ("may",), ("june", "jun"), ("july", "jul"),
    ("august", "aug"), ("september", "sep", "sept"), ("october", "oct"), ("november", "nov"), ("december", "dec"),
)
_DAY_NAMED = r"^\?(\d{1,2})[ ./-]*([A-Za-z]{3,9})[., /-]*(\d{4})$"
_NAMED_DAY = r"^\?([A-Za-z]{3,9})[. /-]*(\d{1,2})[, /.-]+(\d{4})$"


def stripped(text: Column) -> Column:
    """The text without white space of any kind at its edges."""
    return F.regexp_replace(text, _EDGES, "")


def _shape(text: Column) -> Column:
    return F.translate(text, "0123456789", "9999999999")


def _iso(text: Column, year: int, month: int, day: int | None) -> Column:
    """ISO text from the one-based positions of the parts; no day means the first."""
    last = F.lit("01") if day is None else F.substring(text, day, 2)
    return F.concat_ws("-", F.substring(text, year, 4), F.substring(text, month, 2), last)


def _as_day(iso: Column) -> Column:
    return iso.try_cast("date")


def ohlcv_date(text: Column) -> Column:
    """ISO day, or YYYYMM read as the first of the month; any other shape is the epoch day.
    A text of the right shape that is no calendar day (2024-13-45) is null."""
    shape = _shape(text)
    return _as_day(
        F.when(shape == "9999-99-99", text).when(shape == "999999", _iso(text, 1, 5, None)).otherwise(EPOCH_DAY)
    )


def strict_date(text: Column) -> Column:
    """Full days in four fixed shapes after trimming; YYYYMM is null on purpose."""
    trimmed = F.trim(text)
    shape = _shape(trimmed)
    return _as_day(
        F.when(shape == "9999-99-99", trimmed)
        .when(shape == "99999999", _iso(trimmed, 1, 5, 7))
        .when(shape == "99/99/9999", _iso(trimmed, 7, 4, 1))
        .when(shape == "9999/99/99", _iso(trimmed, 1, 6, 9))
    )


def _unclocked(trimmed: Column) -> Column:
    """The text without a clock time after a blank or T, marked by a leading ``?``. The mark
    goes away when a later pattern rewrites the whole text; a text that keeps it is no date."""
    bare = F.when(trimmed.contains(":"), F.regexp_replace(trimmed, _CLOCK, "")).otherwise(trimmed)
    return F.concat(F.lit("?"), bare)


def lenient_date(text: Column) -> Column:
    """Day first unless the text starts with a year; a clock time may follow and is dropped.

    Accepts ``-``, ``/`` and ``.`` between the parts. A day-first text whose month slot
    is no month (01/15/2024) is read month first. The month may also be an English name or its
    short form, behind the day or before it (2 Jan 2024, January 2, 2024).
    """
    day_first, month_first = _both_readings(text)
    spelled = F.coalesce(_as_day(F.regexp_replace(day_first, _YEAR_FIRST, "$1-$2$4-$3$5")), _as_day(month_first), _named_day(text))
    return _by_shape(text, spelled, ((7, 4, 1), (7, 1, 4)))


def month_first_date(text: Column) -> Column:
    """As ``lenient_date``, but 01/02/2024 is 2 January; where that is no day, it is read day first."""
    day_first, month_first = _both_readings(text)
    spelled = F.coalesce(_as_day(F.regexp_replace(month_first, _YEAR_FIRST, "$1-$2$4-$3$5")), _as_day(day_first), _named_day(text))
    return _by_shape(text, spelled, ((7, 1, 4), (7, 4, 1)))


def _by_shape(text: Column, spelled: Column, readings: tuple[tuple[int, int, int], ...]) -> Column:
    """Days of the common fixed shapes without patterns, by the places of year, month and day in each reading;
    any other text goes through ``spelled``, which gives the same for these shapes at several times the cost."""
    trimmed = F.trim(text)
    shape = _shape(trimmed)
    return (
        F.when(shape == "9999-99-99", _as_day(trimmed))
        .when(shape.isin("9999/99/99", "9999.99.99"), _as_day(_iso(trimmed, 1, 6, 9)))
        .when(shape == "99999999", _as_day(_iso(trimmed, 1, 5, 7)))
        .when(shape.isin("99/99/9999", "99.99.9999", "99-99-9999"), F.coalesce(*[_as_day(_iso(trimmed, *places)) for places in readings]))
        .when(shape == "999999", F.lit(None).cast("date"))
        .otherwise(spelled)
    )


def _both_readings(text: Column) -> tuple[Column, Column]:
    marked = _unclocked(F.regexp_replace(stripped(text), _ZONE, "$1"))
    day_first = F.regexp_replace(marked, _DAY_FIRST, "$3-$2-$1")
    month_first = F.regexp_replace(marked, _DAY_FIRST, "$3-$1-$2")
    return day_first, month_first


def _named_day(text: Column) -> Column:
    """Day of a text with a month's name in it; only texts with letters are looked at."""
    marked = _unclocked(F.regexp_replace(stripped(text), _ZONE, "$1"))
    turned = F.regexp_replace(marked, _NAMED_DAY, "?$2 $1 $3")
    part = lambda place: F.regexp_extract(turned, _DAY_NAMED, place)
    numbers = F.create_map(*[F.lit(x) for i, names in enumerate(MONTHS, 1) for spelled in names for x in (spelled, f"{i:02d}")])
    month = F.try_element_at(numbers, F.lower(part(2)))
    iso = F.concat_ws("-", part(3), month, F.lpad(part(1), 2, "0"))
    return F.when(text.rlike("[A-Za-z]{3}") & turned.rlike(_DAY_NAMED) & month.isNotNull(), _as_day(iso))


def training_date(text: Column) -> Column:
    """ISO day, YYYYMM (first of the month) or yyyyMMdd."""
    shape = _shape(text)
    return _as_day(
        F.when(shape == "9999-99-99", text)
        .when(shape == "999999", _iso(text, 1, 5, None))
        .when(shape == "99999999", _iso(text, 1, 5, 7))
    )


def padded_date(text: Column) -> Column:
    """Six characters get ``01`` appended; then a year-first day, where a clock time may follow."""
    trimmed = F.trim(text)
    padded = F.when(F.length(trimmed) == 6, F.concat(trimmed, F.lit("01"))).otherwise(trimmed)
    return _as_day(F.regexp_replace(_unclocked(padded), _YEAR_FIRST, "$1-$2$4-$3$5"))


def compact_date(text: Column) -> Column:
    """yyyyMMdd only."""
    return _as_day(F.when(_shape(text) == "99999999", _iso(text, 1, 5, 7)))


def as_date(column: Column, kind: str) -> Column:
    """Date of a column that may already be a date or timestamp (``kind`` is its Spark type
    name); text is read month first."""
    if kind == "date":
        return column
    if kind.startswith("timestamp"):
        return column.cast("date")
    return month_first_date(column.cast("string"))


def display_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
