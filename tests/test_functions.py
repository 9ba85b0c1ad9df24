import datetime as dt
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import dates, names, numbers, scores

D = dt.date
TEXTS = ["2024-01-02", "20240102", "02/01/2024", "2024/01/02", " 2024-01-02 ", "202401", "2024-13-45", None, "x", ""]


def test_ohlcv_date_falls_back_to_the_epoch(values):
    epoch = D(1970, 1, 1)
    assert values(dates.ohlcv_date, TEXTS) == [
        D(2024, 1, 2), epoch, epoch, epoch, epoch, D(2024, 1, 1), None, epoch, epoch, epoch,
    ]


def test_strict_date(values):
    day = D(2024, 1, 2)
    assert values(dates.strict_date, TEXTS) == [day, day, day, day, day, None, None, None, None, None]


def test_lenient_date_agrees_with_pandas(values):
    texts = [
        "2024-01-02", "2024-01-02 10:30", "2024-01-02T10:30:00", "2024-13-45", "20240102", "02/01/2024", "2/1/2024",
        "01/15/2024", "15/01/2024 10:00", "2024/01/02", "2024/1/5", "15-01-2024", "15.01.2024", "1.2.2024", "202401",
        "2024-01-02junk", "nan", "", "31/02/2024", "2024-02-30", "2 Jan 2024", "Jan 2, 2024", "02-Jan-2024", "2 January 2024", "January 2 2024",
        "31 Feb 2024", "Foo 2, 2024", "MAY 5, 2024", "Sept 3, 2024", "2 jan 2024 10:30", "12 Marchy 2024", "29 Feb 2024",
    ]
    expected = []
    for text in texts:
        iso = bool(re.match(r"^\d{4}-\d{2}-\d{2}", text))
        parsed = pd.to_datetime(pd.Series([text]), format="mixed", dayfirst=not iso, errors="coerce").iloc[0]
        expected.append(None if pd.isna(parsed) else parsed.date())
    assert values(dates.lenient_date, texts) == expected


def test_training_and_padded_dates(values):
    texts = ["2024-01-02", "202401", "20240102", "02/01/2024", None, "2024-13-45", "999999"]
    assert values(dates.training_date, texts) == [D(2024, 1, 2), D(2024, 1, 1), D(2024, 1, 2), None, None, None, None]
    assert values(dates.padded_date, ["202507", "2025-07-02", " 202507 ", "x", "20250702", "2025-07-02 01:02:03"]) == [
        D(2025, 7, 1), D(2025, 7, 2), D(2025, 7, 1), None, D(2025, 7, 2), D(2025, 7, 2),
    ]


def test_display_and_iso_text(values):
    assert values(dates.display_date, [D(2024, 2, 1)], "date") == ["01/02/2024"]
    assert values(dates.iso_text, [D(2024, 2, 1)], "date") == ["2024-02-01"]


def test_strict_decimal_keeps_its_known_traps(values):
    texts = ["10,5", "1.234,56", "1,234.56", "1e5", ".5", "+3.25", "-4", " 7.5 ", "", None, "x", "1.2.3"]
    assert values(numbers.strict_decimal, texts) == [
        10.5, 1234.56, 1.23456, None, None, 3.25, -4.0, 7.5, None, None, None, None,
    ]


def test_lenient_decimal_agrees_with_pandas(values):
    texts = ["10,5", "1.234,56", "1e5", ".5", "5.", "1.5d", "0.12345678", "", "x", "-3"]
    expected = []
    for text in texts:
        clean = text.replace(".", "").replace(",", ".") if "," in text else text
        number = pd.to_numeric(pd.Series([clean]), errors="coerce").round(6).iloc[0]
        expected.append(None if pd.isna(number) else float(number))
    assert values(numbers.lenient_decimal, texts) == expected


def test_longs_and_implied_decimals(values):
    assert values(numbers.to_long, ["12", " 7 ", "12.9", "x", None, "-3.5"]) == [12, 7, 12, None, None, -3]
    shown = values(lambda c: numbers.implied_hundredths(c).cast("string"), ["0000000001501", "   ", "12x", "5"])
    assert shown == ["15.01", "0.00", None, "0.05"]
    assert values(numbers.whole_or_zero, ["0000000001493", " ", "x"]) == [1493, 0, None]


def test_percent_change_has_no_value_without_a_base(spark):
    rows = spark.createDataFrame([(11.0, 10.0), (1.0, 0.0), (1.0, None)], "c double, p double")
    found = [r[0] for r in rows.select(numbers.percent_change(F.col("c"), F.col("p"))).collect()]
    assert found == [pytest.approx(10.0), None, None]


def test_slugs(values):
    assert values(names.slug, ["PETR4.SA", "__a  b__", "***", "ação"]) == ["PETR4_SA", "a_b", "dados", "a_o"]
    assert values(names.file_prefix, ["ação-1_x", "a b!", "***"]) == ["ação-1_x", "a_b", "forecast"]
    assert names.slug_text("PETR4.SA") == "PETR4_SA" and names.slug_text("!!") == "dados"


def test_find_column_prefers_candidate_order():
    columns = [" adj close ", "CLOSE", "Data"]
    assert names.find_column(columns, names.CLOSE_NAMES, "Close") == "CLOSE"
    assert names.find_column(columns, names.DATE_NAMES, "Date") == "Data"
    assert names.find_column(["close", "Close"], names.CLOSE_NAMES, "Close", exact_first=True) == "Close"
    assert names.find_column(columns, names.SYMBOL_NAMES, "symbol", required=False) is None
    with pytest.raises(names.MissingColumn):
        names.find_column(columns, names.SYMBOL_NAMES, "symbol")


def test_scores(spark):
    rows = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 2.0), ("c", 5.0, 4.0), ("c", 5.0, 6.0)], "g string, y double, p double")
    y, p = F.col("y"), F.col("p")
    found = {
        r["g"]: (r["rmse"], r["mae"], r["r2"])
        for r in rows.groupBy("g").agg(scores.rmse(y, p).alias("rmse"), scores.mae(y, p).alias("mae"), scores.r2(y, p).alias("r2")).collect()
    }
    assert found == {"a": (1.0, 1.0, 0.0), "c": (1.0, 1.0, 1.0)}


def test_distance_to_band(values):
    assert values(scores.distance_to_band, [0.5, 0.7, 0.9], "double") == [pytest.approx(0.1), 0.0, pytest.approx(0.1)]
    assert values(scores.in_band, [0.5, 0.6, 0.8, 0.81], "double") == [False, True, True, False]


def test_common_shapes_need_no_patterns(values):
    texts = [" 2024-02-03 ", "2024/02/03", "2024.02.03", "20240203", "02/03/2024", "13.02.2024", "2024-13-45", "202402", None, "3 Feb 2024"]
    days = values(lambda x: dates._by_shape(x, F.lit("1900-01-01").cast("date"), ((7, 1, 4), (7, 4, 1))), texts)
    assert [d and d.isoformat() for d in days] == [
        *["2024-02-03"] * 5, "2024-02-13", None, None, "1900-01-01", "1900-01-01"
    ]
    whole = values(dates.month_first_date, texts)
    assert [d and d.isoformat() for d in whole] == [*["2024-02-03"] * 5, "2024-02-13", None, None, None, "2024-02-03"]
