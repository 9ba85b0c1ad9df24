"""Data-quality gates. By default problems become rows of a report; ``raise_on`` turns
the ones the caller names into errors."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators import series, tickers

REPORT_COLUMNS = ("symbol", "check", "severity", "observed", "message")


def _finding(rows: DataFrame, check: str, severity: str, observed: Column, *message: Column | str) -> DataFrame:
    parts = [F.lit(part) if isinstance(part, str) else part.cast("string") for part in message]
    return rows.select(
        F.col("symbol"),
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        observed.cast("bigint").alias("observed"),
        F.concat(*parts).alias("message"),
    )


def series_report(
    parsed: DataFrame,
    order: Sequence[str],
    min_rows: int = series.MIN_RECOMMENDED_ROWS,
    max_period_days: int = series.MAX_PERIOD_DAYS,
) -> DataFrame:
    """Findings per symbol over rows from ``series.parse_series``.

    ``dropped_rows``   rows without a usable date or close
    ``no_valid_rows``  a symbol with nothing left (error)
    ``small_series``   fewer valid days than recommended
    ``trimmed``        history reaches back beyond the look-back
    """
    # Per (symbol, date) first: partial aggregation makes a hot symbol at most one row a day.
    daily = parsed.groupBy("symbol", series.valid_day().alias("day")).agg(F.count(F.lit(1)).alias("rows"))
    return report_of_days(daily, min_rows, max_period_days)


def report_of_days(
    days: DataFrame, min_rows: int = series.MIN_RECOMMENDED_ROWS, max_period_days: int = series.MAX_PERIOD_DAYS
) -> DataFrame:
    """The same findings from rows counted per symbol and day (``series.days``)."""
    totals = days.groupBy("symbol").agg(
        F.count("day").alias("days"),
        F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col("rows"))), F.lit(0)).alias("dropped"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
    )
    # All findings of a symbol come from its one totals row, so the input is read once.
    findings = [
        (F.col("dropped") > 0, "dropped_rows", "info", F.col("dropped"), "rows without a usable date or close"),
        (F.col("days") == 0, "no_valid_rows", "error", F.col("days"), "no valid row after converting date and close"),
        (
            (F.col("days") > 0) & (F.col("days") < min_rows),
            "small_series", "warning", F.col("days"), "few valid rows; metrics may be unstable",
        ),
        (
            F.col("first") < F.date_sub("last", max_period_days),
            "trimmed", "warning", F.datediff("last", "first"), f"series limited to the last {max_period_days} days",
        ),
    ]
    entries = F.array(
        *[
            F.when(
                condition,
                F.struct(
                    F.lit(check).alias("check"),
                    F.lit(severity).alias("severity"),
                    observed.cast("bigint").alias("observed"),
                    F.lit(message).alias("message"),
                ),
            )
            for condition, check, severity, observed, message in findings
        ]
    )
    return totals.select("symbol", F.inline(F.filter(entries, lambda entry: entry.isNotNull())))


def ticker_findings(table: DataFrame, source: str, symbol: str = "symbol") -> DataFrame:
    """Sources that hold more than one ticker; ``symbol`` carries the source's name."""
    crowded = tickers.ticker_summary(table, [source], symbol).where(F.col("tickers") > 1)
    named = crowded.select(F.col(source).cast("string").alias("symbol"), "tickers")
    return _finding(
        named, "several_tickers", "error", F.col("tickers"), "source holds ", F.col("tickers"), " tickers"
    )


def separator_findings(separators: DataFrame) -> DataFrame:
    """Files whose separator is not ``;`` (input columns: path, separator)."""
    other = separators.where(F.col("separator") != ";").select(F.col("path").alias("symbol"), "separator")
    return _finding(
        other, "separator", "warning", F.lit(1), "file uses separator '", F.col("separator"), "'; read accordingly"
    )


def dropped_ticker_findings(table: DataFrame, order: Sequence[str], n: int = tickers.DROPPED_POSITION) -> DataFrame:
    """What ``tickers.drop_nth_symbol`` removes, or that there was no n-th ticker to remove."""
    key = F.coalesce(F.trim(F.col("symbol")), F.lit("nan"))
    counts = table.groupBy(key.alias("symbol")).agg(F.count(F.lit(1)).alias("rows"))
    nth = tickers.nth_symbol(table, order, n).select(F.col("symbol").alias("_nth"))
    removed = counts.join(F.broadcast(nth), F.col("symbol") == F.col("_nth"), "inner")
    total = counts.agg(F.count(F.lit(1)).alias("found")).where((F.col("found") > 1) & (F.col("found") < n))
    kept_all = total.select(F.lit("*").alias("symbol"), F.col("found"))
    return _finding(
        removed, "ticker_removed", "warning", F.col("rows"), f"ticker number {n} removed with ", F.col("rows"), " rows"
    ).unionByName(
        _finding(
            kept_all, "tickers_found", "warning", F.col("found"), F.col("found"),
            f" tickers found; none removed because there is no ticker number {n}",
        )
    )


def raise_on(report: DataFrame, checks: Iterable[str]) -> None:
    """Raise the first finding of the given checks, if any."""
    worst = report.where(F.col("check").isin(*checks)).orderBy("check", "symbol").limit(1).collect()
    if worst:
        row = worst[0]
        raise series.SeriesError(f"{row['symbol']}: {row['message']} ({row['observed']})")


def require_single_ticker(table: DataFrame, symbol: str | None, count_missing: bool) -> None:
    """Error when a table meant to hold one ticker has several. With ``count_missing`` the
    text is taken as it is and a missing ticker counts as one more."""
    if symbol is None:
        return
    text = series.quoted(symbol).cast("string")
    if not count_missing:
        text = F.nullif(F.trim(text), F.lit(""))
    found = table.select(text.alias("ticker")).distinct()
    if not count_missing:
        found = found.where(F.col("ticker").isNotNull())
    number = found.count()
    if number > 1:
        raise series.SeriesError(f"the input holds {number} tickers; it must hold exactly one")
