import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions.names import MissingColumn
from tickloom.operators import quality, series, tickers
from tickloom.plans import etl


def _table(spark, columns, rows):
    return spark.createDataFrame(
        [(*row, i) for i, row in enumerate(rows)], ", ".join(f"`{c}` string" for c in columns) + ", n bigint"
    )


def _treat(spark, columns, rows, **options):
    return etl.treat_table(_table(spark, columns, rows), input_order=["n"], **options)


def _checks(result):
    return {row["check"] for row in result.findings.collect()}


def test_mixed_dates_and_decimals_last_row_wins(spark):
    rows = [("2021-09-30", "3,25"), ("15/10/2021", "4"), ("2021-09-30", "3.5"), ("15/10/2021", "4,75")]
    result = _treat(spark, ["Date", "Close"], rows, single_symbol=True)
    found = result.frame.orderBy("date").collect()
    assert [(r["date"], r["close"]) for r in found] == [("2021-09-30", 3.5), ("2021-10-15", 4.75)]
    assert "small_series" in _checks(result)


def test_an_unreadable_later_duplicate_does_not_win(spark):
    result = _treat(spark, ["Date", "Close"], [("2024-01-01", "1"), ("2024-01-01", "x")])
    assert [r["close"] for r in result.frame.collect()] == [1.0]


def test_several_tickers_are_rejected_or_kept(spark):
    rows = [(f"T{i}", f"2024-01-0{i}", "1") for i in range(1, 9)]
    with pytest.raises(series.SeriesError, match="8 tickers"):
        _treat(spark, ["symbol", "Date", "Close"], rows, single_symbol=True)
    with pytest.raises(series.SeriesError):
        _treat(spark, ["symbol", "Date", "Close"], rows[:3], single_symbol=True, mode="lenient")
    assert _treat(spark, ["symbol", "Date", "Close"], rows).frame.count() == 8


def test_missing_ticker_counts_only_in_strict_mode(spark):
    rows = [("A", "2024-01-01", "1"), (None, "2024-01-02", "2")]
    with pytest.raises(series.SeriesError):
        _treat(spark, ["symbol", "Date", "Close"], rows, single_symbol=True)
    assert _treat(spark, ["symbol", "Date", "Close"], rows, single_symbol=True, mode="lenient").frame.count() == 2


@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_long_history_is_trimmed_with_a_warning(spark, mode):
    result = _treat(spark, ["Date", "Close"], [("2018-01-01", "1"), ("2024-01-01", "2")], single_symbol=True, mode=mode)
    assert [r["date"] for r in result.frame.collect()] == ["2024-01-01"]
    assert "trimmed" in _checks(result)


def test_look_back_includes_its_first_day(spark):
    result = _treat(spark, ["Date", "Close"], [("2023-01-01", "1"), ("2024-01-01", "2")])
    assert result.frame.count() == 2 and "trimmed" not in _checks(result)


def test_no_valid_row_is_an_error(spark):
    with pytest.raises(series.SeriesError):
        _treat(spark, ["Date", "Close"], [("not-a-date", "not-a-number")], single_symbol=True)
    with pytest.raises(series.SeriesError, match="empty"):
        _treat(spark, ["Date", "Close"], [], single_symbol=True)
    assert "no_valid_rows" in _checks(_treat(spark, ["Date", "Close"], [("x", "y")]))


def test_required_columns(spark):
    with pytest.raises(MissingColumn):
        _treat(spark, ["Date", "price"], [])
    with pytest.raises(MissingColumn):
        _treat(spark, ["when", "Close"], [])


def test_header_with_blanks_and_dots(spark):
    result = _treat(spark, [" data ", "Adj Close", "a.b"], [("2024-01-01", "3", "z")])
    assert [r["close"] for r in result.frame.collect()] == [3.0]


def test_history_between_includes_both_ends(spark):
    day = dt.date
    prices = spark.createDataFrame(
        [("AAA", day(2024, 1, d), float(d)) for d in (1, 2, 3)] + [("BBB", day(2024, 1, 2), 9.0)], "symbol string, date date, close double"
    )
    rows = series.between(prices, [" aaa "], "2024-01-01", "2024-01-02").orderBy("date").collect()
    assert [r["close"] for r in rows] == [1.0, 2.0]
    for tickers_, start, end in [([" "], "2024-01-01", "2024-01-02"), (["A"], "2024-01-03", "2024-01-02"), (["A"], "x", "2024-01-02")]:
        with pytest.raises(series.SeriesError):
            series.between(prices, tickers_, start, end)


def test_the_seventh_ticker_is_dropped(spark):
    rows = [(f"T{i % 9}", "2024-01-01", "1") for i in range(27)]
    table = _table(spark, ["symbol", "Date", "Close"], rows).repartition(3)
    kept = {r["symbol"] for r in tickers.drop_nth_symbol(table, ["n"]).collect()}
    assert kept == {f"T{i}" for i in range(9)} - {"T6"}
    found = quality.dropped_ticker_findings(table, ["n"]).collect()
    assert [(r["symbol"], r["observed"]) for r in found] == [("T6", 3)]
    few = table.where(F.col("symbol") < "T3")
    assert tickers.drop_nth_symbol(few, ["n"]).count() == 9
    assert [r["check"] for r in quality.dropped_ticker_findings(few, ["n"]).collect()] == ["tickers_found"]


def test_symbol_order_counts_and_ties(spark):
    table = _table(spark, ["symbol"], [("b",), ("a",), ("b",), ("a",), ("c",), (None,)]).repartition(4)
    assert [r["symbol"] for r in tickers.first_seen(table, ["n"]).collect()] == ["b", "a", "c", None]
    assert [(r["symbol"], r["count"]) for r in tickers.symbol_counts(table).collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert {r["symbol"] for r in tickers.only_primary_symbol(table).collect()} == {"a"}
    assert [r["symbol"] for r in tickers.tickers_of(table).collect()] == ["a", "b", "c"]
