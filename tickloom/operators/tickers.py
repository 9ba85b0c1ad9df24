"""Which symbols a table holds, and filters on them. All of it is partial aggregation
followed by small top-n steps; no row is ever gathered per symbol."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordering import position

# The distinct ticker that is dropped, and the number of symbols charted.
DROPPED_POSITION = 7
TOP_SYMBOLS = 6


def first_seen(table: DataFrame, order: Sequence[str], symbol: str = "symbol") -> DataFrame:
    """Distinct symbols with the input position of their first row, earliest first."""
    return _first_positions(table, F.col(symbol), order).orderBy(*order, "symbol")


def _first_positions(table: DataFrame, symbol: Column, order: Sequence[str]) -> DataFrame:
    return (
        table.groupBy(symbol.alias("symbol"))
        .agg(F.min(position(order)).alias("_first"))
        .select("symbol", F.col("_first").alias(order[0]) if len(order) == 1 else F.col("_first.*"))
    )


def _ticker_text(symbol: str) -> Column:
    """Missing tickers count as one more ticker, spelled ``nan``."""
    return F.coalesce(F.trim(F.col(symbol)), F.lit("nan"))


def nth_symbol(
    table: DataFrame, order: Sequence[str], n: int = DROPPED_POSITION, symbol: str = "symbol"
) -> DataFrame:
    """The n-th distinct ticker by first appearance: one row, or none when there are fewer."""
    leading = _first_positions(table, _ticker_text(symbol), order).orderBy(*order, "symbol").limit(n)
    position = F.row_number().over(Window.orderBy(*order, "symbol"))  # over at most n rows
    return leading.withColumn("_position", position).where(F.col("_position") == n).select("symbol")


def drop_nth_symbol(
    table: DataFrame, order: Sequence[str], n: int = DROPPED_POSITION, symbol: str = "symbol"
) -> DataFrame:
    """Every row except those of the n-th distinct ticker."""
    dropped = nth_symbol(table, order, n, symbol).select(F.col("symbol").alias("_dropped"))
    # One row at most, so the broadcast has a fixed size.
    return table.join(F.broadcast(dropped), _ticker_text(symbol) == F.col("_dropped"), "left_anti")


def symbol_counts(table: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows per symbol, largest first, ties by name. Rows without a symbol do not count."""
    return _counts(table, symbol).orderBy(F.desc("count"), "symbol")


def _counts(table: DataFrame, symbol: str) -> DataFrame:
    return (
        table.where(F.col(symbol).isNotNull())
        .groupBy(F.col(symbol).alias("symbol"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def top_symbols(table: DataFrame, n: int = TOP_SYMBOLS, symbol: str = "symbol") -> DataFrame:
    return symbol_counts(table, symbol).limit(n)


def only_top_symbols(table: DataFrame, n: int = TOP_SYMBOLS, symbol: str = "symbol") -> DataFrame:
    """Rows of the ``n`` symbols with most rows (``n`` rows are broadcast)."""
    leading = top_symbols(table, n, symbol).select(F.col("symbol").alias("_top"))
    return table.join(F.broadcast(leading), F.col(symbol) == F.col("_top"), "left_semi")


def only_primary_symbol(table: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows of the single most frequent symbol, the smallest name on ties."""
    return only_top_symbols(table, 1, symbol)


def ticker_summary(table: DataFrame, source: Sequence[str] = (), symbol: str = "symbol") -> DataFrame:
    """Number of distinct non-blank tickers per source. Distinct pairs are formed before
    the count, so a source with many rows shuffles only its tickers."""
    named = F.nullif(F.trim(F.col(symbol)), F.lit(""))
    pairs = table.select(*source, named.alias("_ticker")).distinct()
    return pairs.groupBy(*source).agg(F.count("_ticker").alias("tickers"))


def tickers_of(table: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Sorted distinct non-blank tickers, one per row."""
    named = F.nullif(F.trim(F.col(symbol)), F.lit(""))
    return table.select(named.alias("symbol")).where(F.col("symbol").isNotNull()).distinct().orderBy("symbol")
