import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import scores
from tickloom.operators import charts, profile


@pytest.fixture(scope="module")
def numbers():
    draw = np.random.default_rng(3)
    size = 3000
    return pd.DataFrame(
        {
            "normal": draw.normal(0, 1, size),
            "heavy": np.where(draw.random(size) < 0.9, 5.0, draw.normal(0, 100, size)),
            "long_tail": np.exp(draw.normal(0, 8, size)),
            "constant": 2.0,
        }
    )


@pytest.mark.parametrize("exact_rows", [10, 500, 100_000])
def test_narrowed_quantiles_are_exact(spark, numbers, exact_rows):
    table = spark.createDataFrame(numbers)
    found = {r["column"]: r for r in profile.exact_quantiles(table, list(numbers), (0.0, 0.25, 0.5, 0.75, 1.0), exact_rows).collect()}
    for name in numbers:
        expected = np.quantile(numbers[name], [0.0, 0.25, 0.5, 0.75, 1.0])
        np.testing.assert_allclose([found[name][q] for q in ("q0", "q25", "q50", "q75", "q100")], expected, rtol=1e-12)


def test_quantiles_of_columns_with_nulls(spark):
    table = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    found = {r["column"]: r["q50"] for r in profile.exact_quantiles(table, ["a", "b"], (0.5,)).collect()}
    assert found == {"a": 2.0, "b": None}


def test_profile_matches_describe(spark):
    frame = pd.DataFrame({"symbol": ["b", "a", "b", "a", "c"], "close": [1.0, 2.0, 4.0, 8.0, 16.0], "volume": [1, 2, 3, 4, 5]})
    table = spark.createDataFrame(frame).withColumn("day", F.expr("date_add(date'2024-01-01', cast(volume as int))"))
    found = {r["column"]: r for r in profile.profile(table).collect()}
    expected = frame.describe()
    for name in ("close", "volume"):
        row = found[name]
        shown = [row["count"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]]
        np.testing.assert_allclose(shown, expected[name].to_numpy())
    assert (found["symbol"]["unique"], found["symbol"]["top"], found["symbol"]["freq"]) == (3, "a", 2)
    assert found["day"]["std"] is None and found["day"]["q50"] == (pd.Timestamp("2024-01-04") - pd.Timestamp("1970-01-01")).days


def test_correlations_are_pairwise_complete(spark):
    draw = np.random.default_rng(2)
    frame = pd.DataFrame(draw.normal(size=(50, 6)), columns=list(profile.CORRELATED))
    frame["volume"] = 1.0
    frame.loc[::7, "open"] = None
    found = profile.correlation_matrix(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"{c} double" for c in frame))).collect()
    expected = frame.corr()
    for row in found:
        want = expected.loc[row["x"], row["y"]]
        assert row["correlation"] is None if math.isnan(want) else row["correlation"] == pytest.approx(want)
    assert len(found) == 36


@pytest.mark.parametrize("parts", [1, 3, 8])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_constants_have_no_correlation_however_partitioned(spark, parts, adaptive):
    draw = np.random.default_rng(8)
    frame = pd.DataFrame({"open": 0.1, "high": draw.normal(size=999), "low": 1e15 + 0.3})
    table = spark.createDataFrame(frame).repartition(parts)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        found = {(r["x"], r["y"]): r["correlation"] for r in profile.correlation_matrix(table, ["open", "high", "low"]).collect()}
        label = {r["label"] for r in charts.correlation_chart(table, ["high"]).collect()}
        row = table.select(scores.r2(F.col("open"), F.col("high")).alias("r2")).collect()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert {pair for pair, value in found.items() if value is not None} == {("high", "high")}
    assert found["high", "high"] == 1.0 and label == {"1.00"} and row["r2"] == 1.0


def test_chart_frames(spark):
    rows = [("A", "2024-01-01", 1.0, 2_000_000), ("A", "2024-01-01", 3.0, 0), ("B", None, 1.0, 1)]
    table = spark.createDataFrame(rows, "symbol string, d string, close double, volume bigint").select(
        "symbol", F.to_date("d").alias("date"), "close", "volume", *[F.col("close").alias(c) for c in ("open", "high", "low")]
    )
    assert charts.trend(table, "close", 1).collect()[0]["close"] == 2.0
    assert [r["volume_millions"] for r in charts.symbol_frame(table, "A").collect()] == [2.0, 0.0]
    assert charts.symbol_frame(table, "B").count() == 0
    with pytest.raises(ValueError):
        charts.symbol_frame(table, "C")
