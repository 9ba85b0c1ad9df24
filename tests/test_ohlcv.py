import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions.names import MissingColumn
from tickloom.operators import ohlcv
from tickloom.operators.neighbours import with_neighbours

RAW = "symbol string, trade_date string, open string, high string, low string, close string, volume string, n bigint"


def _raw(spark, rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], RAW)


def test_change_skips_missing_closes(spark):
    raw = _raw(
        spark,
        [
            ("ZED3", "2019-06-10", "7.5", "9", "7", "8", "40"),
            ("ZED3", "2019-06-11", "8", None, "6", None, "x"),
            ("ZED3", "2019-06-12", None, None, None, None, None),
            ("ZED3", "2019-06-13", "8", "11", "8", "10", "55"),
        ],
    )
    rows = ohlcv.curate(raw, ["n"], F.lit(0)).orderBy("trade_date_fmt").collect()
    assert [r["close"] for r in rows] == [8.0, 0.0, 0.0, 10.0] and [r["volume"] for r in rows] == [40, 0, 0, 55]
    assert [r["prev_close"] for r in rows] == [None, 8.0, 8.0, 8.0]
    assert [r["daily_pct_change"] for r in rows] == [0.0, 0.0, 0.0, pytest.approx(25.0)]
    assert rows[3]["trade_date_fmt"] == "2019-06-13"


def test_defaults_and_bad_text(spark):
    raw = _raw(spark, [(None, None, "x", "1", "1", "0", "n/a"), (None, "202401", "1", "1", "1", "5", "7")])
    rows = ohlcv.curate(raw, ["n"], F.lit(0)).orderBy("trade_date_fmt").collect()
    assert {r["symbol"] for r in rows} == {"UNKNOWN"}
    assert [r["trade_date_fmt"] for r in rows] == ["1970-01-01", "2024-01-01"]
    assert (rows[0]["open"], rows[0]["volume"]) == (0.0, 0)
    assert rows[1]["prev_close"] == 0.0 and rows[1]["daily_pct_change"] == 0.0


def test_missing_raw_column_is_an_error(spark):
    with pytest.raises(MissingColumn):
        ohlcv.curate(_raw(spark, []).drop("open"), ["n"], F.lit(0))


def _crowd(spark, seed):
    """One symbol with most rows, one day with most of those, and some missing values."""
    draw = random.Random(seed)
    rows = []
    for n in range(400):
        symbol = "HOT" if draw.random() < 0.7 else draw.choice(["A", "B", None])
        day = 1 if draw.random() < 0.5 else draw.choice([None, 2, 3, 9])
        rows.append((symbol, day, n, None if draw.random() < 0.3 else float(draw.randrange(50))))
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "symbol string, day int, n bigint, close double").repartition(5)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("block", [1, 16, 1000])
def test_split_scan_equals_the_plain_window(spark, seed, block):
    rows = _crowd(spark, seed)
    wanted = {"previous": "before", "following": "after", "last_known": "known"}

    made = with_neighbours(rows, "symbol", "day", ["n"], F.floor(F.col("n") / block), "close", **wanted)
    sequence = Window.partitionBy("symbol").orderBy(F.col("day").asc_nulls_first(), "n")
    plain = rows.withColumns(
        {
            "before": F.lag("close").over(sequence),
            "after": F.lead("close").over(sequence),
            "known": F.last("close", ignorenulls=True).over(sequence.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    by_place = lambda table: sorted(table.collect(), key=lambda r: r["n"])
    assert by_place(plain) == by_place(made) and made.count() == 400


@pytest.mark.parametrize("plain_rows", [0, 60, 200_000])
def test_plain_window_and_split_scan_agree(spark, plain_rows):
    rows = _crowd(spark, 5)
    made = with_neighbours(
        rows, "symbol", "day", ["n"], F.floor(F.col("n") / 8), "close",
        previous="before", following="after", last_known="known", plain_rows=plain_rows,
    )
    sequence = Window.partitionBy("symbol").orderBy(F.col("day").asc_nulls_first(), "n")
    known = F.last("close", ignorenulls=True).over(sequence.rowsBetween(Window.unboundedPreceding, -1))
    plain = rows.withColumns({"before": F.lag("close").over(sequence), "after": F.lead("close").over(sequence), "known": known})
    by_place = lambda table: sorted(table.collect(), key=lambda r: r["n"])
    assert by_place(plain) == by_place(made)


def test_keys_with_few_rows_are_shuffled_once(spark):
    rows = _crowd(spark, 5)
    made = with_neighbours(rows, "symbol", "day", ["n"], F.floor(F.col("n") / 8), "close", previous="before")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan


def test_rows_of_one_day_need_an_order(spark):
    with pytest.raises(ValueError):
        with_neighbours(_crowd(spark, 1), "symbol", "day", [], F.lit(0), "close", previous="before")


def test_split_scan_matches_a_loop(spark):
    rows = _crowd(spark, 7)
    made = with_neighbours(rows, "symbol", "day", ["n"], F.floor(F.col("n") / 8), "close", last_known="known")
    order = lambda r: (r["symbol"] or "", r["day"] is not None, r["day"] or 0, r["n"])
    last = {}
    for row in sorted(made.collect(), key=order):
        assert row["known"] == last.get(row["symbol"])
        if row["close"] is not None:
            last[row["symbol"]] = row["close"]


def test_training_rows_have_a_next_close(spark):
    raw = _raw(
        spark,
        [
            ("A", "2024-01-01", "1", "1", "1", "10", "5"),
            ("A", "20240102", "1", "1", "1", "11", "5"),
            ("A", "202402", "1", "1", "1", "12", "5"),
            ("B", "2024-01-01", "1", "1", "1", "7", "5"),
        ],
    )
    rows = ohlcv.training_rows(raw, ["n"], F.lit(0)).orderBy("trade_date_fmt").collect()
    assert [(r["symbol"], r["prev_close"], r["next_close"]) for r in rows] == [("A", None, 11.0), ("A", 10.0, 12.0)]
