"""File-safe names and column-name matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header names accepted for each logical column, in order of preference.
DATE_NAMES = ("Date", "date", "trade_date", "trade_date_fmt", "Data")
CLOSE_NAMES = ("Close", "close", "Adj Close", "adj_close", "Fechamento")
SYMBOL_NAMES = ("symbol", "Symbol", "ticker", "Ticker", "Ativo", "ativo", "codigo", "Codigo")
MODEL_NAMES = {
    "ticker": ("ticker", "symbol"),
    "date": ("date", "data"),
    "close": ("close", "fechamento"),
    "high": ("high", "máxima", "maxima"),
    "low": ("low", "mínima", "minima"),
    "volume": ("volume",),
}
DEFAULT_SLUG = "dados"
DEFAULT_FILE_PREFIX = "forecast"


class MissingColumn(ValueError):
    """A required logical column has no match among the header names."""


def find_column(
    columns: Sequence[str],
    candidates: Sequence[str],
    label: str,
    required: bool = True,
    exact_first: bool = False,
) -> str | None:
    """Header name for a logical column: the earliest candidate wins, then the last header.

    Case and outer blanks do not count; with ``exact_first`` literal matches of any
    candidate come before all others.
    """
    plain = [candidate.strip().lower() for candidate in candidates]

    def rank(place: int) -> tuple[bool, int, int] | None:
        name = columns[place]
        if exact_first and name in candidates:
            return False, list(candidates).index(name), -place
        bare = name.strip().lower()
        return (True, plain.index(bare), -place) if bare in plain else None

    ranked = [(found, columns[place]) for place in range(len(columns)) if (found := rank(place))]
    if ranked:
        return min(ranked)[1]
    if required:
        raise MissingColumn(f"required column not found: {label}")
    return None


def slug(text: Column, default: str = DEFAULT_SLUG) -> Column:
    """Runs of anything but ASCII letters and digits become one underscore."""
    joined = F.regexp_replace(text, "[^A-Za-z0-9]+", "_")
    return _or_default(F.regexp_replace(joined, "^_+|_+$", ""), default)


def file_prefix(text: Column, default: str = DEFAULT_FILE_PREFIX) -> Column:
    """Keeps ``-``, ``_`` and every Unicode letter or digit; other characters become underscores."""
    replaced = F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_")
    return _or_default(F.regexp_replace(replaced, "^_+|_+$", ""), default)


def _or_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def slug_text(text: str, default: str = DEFAULT_SLUG) -> str:
    """The same rule for one driver-side name, such as an output folder."""
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in text)
    return "_".join(kept.split()) or default
