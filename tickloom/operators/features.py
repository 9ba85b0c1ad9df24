"""Model input: temporal features per series, the temporal split and the naive baseline.

The input is a treated series (one row per symbol and day), so every per-symbol window
is bounded by the calendar. All windows share one (symbol, date) ordering and the
frames below keep it: one shuffle and one sort serve the whole module.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions import dates, names, numbers
from tickloom.operators.ordering import position
from tickloom.operators.series import UNKNOWN_SYMBOL, quoted

# The model's inputs and its row minimums.
FEATURES = (
    "t", "t2", "log_t", "lag_1", "lag_2", "lag_3", "rolling_mean_7", "rolling_std_7", "momentum_5",
)
MIN_ROWS = 10
MIN_FEATURE_ROWS = 14
TEST_FRACTION = 0.2


def _whole() -> WindowSpec:
    """All rows of the series, in the same order as ``_days`` so that both share an operator."""
    return _days().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _days() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def model_input(table: DataFrame, default_ticker: str = "", order: Sequence[str] = ()) -> DataFrame:
    """(symbol, date, close, high, low, volume) from any table with recognisable headers.

    Missing optional columns are null; a blank ticker becomes the upper-cased default; text
    dates are read month first. ``order`` names the columns, without nulls and different for every
    row, by which the last row of a symbol and day wins. A table that has one row for each (a treated series) can go without.
    """
    kinds = {name.strip().lower(): kind for name, kind in table.dtypes}
    headers = {
        logical: names.find_column(table.columns, candidates, logical, required=logical in ("date", "close"))
        for logical, candidates in names.MODEL_NAMES.items()
    }

    def number(logical: str) -> Column:
        header = headers[logical]
        if header is None:
            return F.lit(None).cast("double")
        return numbers.number_column(quoted(header), kinds[header.strip().lower()])

    fallback = default_ticker.strip().upper() or UNKNOWN_SYMBOL
    ticker = F.lit("") if headers["ticker"] is None else F.trim(quoted(headers["ticker"]).cast("string"))
    day_header = headers["date"]
    measures = ("close", "high", "low", "volume")
    found = table.select(
        F.coalesce(F.nullif(ticker, F.lit("")), F.lit(fallback)).alias("symbol"),
        dates.as_date(quoted(day_header), kinds[day_header.strip().lower()]).alias("date"),
        *[number(logical).alias(logical) for logical in measures],
        *[quoted(name).alias(f"_order{i}") for i, name in enumerate(order)],
    )
    if not order:
        return found.dropna(subset=["date", "close"])
    # The last row with a close wins. What is no date or close goes after the grouping, by aggregates:
    # a filter before it would parse every text once more, outside the projection that shares its parts.
    usable = F.when(F.col("close").isNotNull(), position([f"_order{i}" for i in range(len(order))]))
    last = [F.max_by(name, usable).alias(name) for name in measures]
    days = found.groupBy("symbol", "date").agg(*last, F.max("date").alias("_day"))
    return days.where(F.col("_day").isNotNull() & F.col("close").isNotNull()).select("symbol", "date", *measures)


def split_size(rows: Column, held_out: float) -> Column:
    """Training rows of a temporal split: at least one row stays on either side."""
    return F.greatest(F.lit(1), F.least(F.floor(rows * F.lit(1.0 - held_out)), rows - 1))


def day_index(series: DataFrame) -> DataFrame:
    return series.withColumn("day_index", F.datediff("date", F.min("date").over(_whole())).cast("double"))


def temporal_split(series: DataFrame, held_out: float = TEST_FRACTION) -> DataFrame:
    """Add ``part``: the first rows of each symbol are ``train``, the rest ``test``."""
    place, size = F.row_number().over(_days()), F.count(F.lit(1)).over(_whole())
    return (
        series.withColumns({"_place": place, "_size": size})
        .withColumn("part", F.when(F.col("_place") <= split_size(F.col("_size"), held_out), "train").otherwise("test"))
        .drop("_place", "_size")
    )


def temporal_features(series: DataFrame, held_out: float = TEST_FRACTION) -> DataFrame:
    """Feature rows of every series, split into train and test.

    Adds the nine features, ``log_close`` (the label), the time ``scale`` (last training
    day of the raw split), ``first_date`` and ``last_date`` of the series, the number of
    its ``rows``, the feature row's ``place`` among ``feature_rows``, the mean log close
    ``center`` of those, and the ``naive`` prediction. Rows without a full set of lags are
    gone.
    """
    shift = _days().rowsBetween(-7, -1)
    raw = series.withColumns(
        {
            "log_close": F.log1p("close"),
            "_place": F.row_number().over(_days()),
            "rows": F.count(F.lit(1)).over(_whole()),
            "first_date": F.min("date").over(_whole()),
            "last_date": F.max("date").over(_whole()),
        }
    ).withColumn("day_index", F.datediff("date", "first_date").cast("double"))
    in_training = F.col("_place") <= split_size(F.col("rows"), held_out)
    known = F.count("log_close").over(shift)
    built = raw.withColumns(
        {
            "scale": F.greatest(F.max(F.when(in_training, F.col("day_index"))).over(_whole()), F.lit(1.0)),
            "lag_1": F.lag("log_close", 1).over(_days()),
            "lag_2": F.lag("log_close", 2).over(_days()),
            "lag_3": F.lag("log_close", 3).over(_days()),
            "_lag_6": F.lag("log_close", 6).over(_days()),
            "rolling_mean_7": F.when(known >= 2, F.avg("log_close").over(shift)),
            "rolling_std_7": F.when(known >= 2, F.stddev_samp("log_close").over(shift)),
        }
    )
    built = built.withColumn("t", F.col("day_index") / F.col("scale")).withColumns(
        {
            "t2": F.col("t") * F.col("t"),
            "log_t": F.log1p("t"),
            "momentum_5": F.col("lag_1") - F.col("_lag_6"),
        }
    )
    complete = built.dropna(subset=[*FEATURES, "log_close"]).drop("_place", "_lag_6")
    numbered = complete.withColumns(
        {
            "place": F.row_number().over(_days()),
            "feature_rows": F.count(F.lit(1)).over(_whole()),
            "center": F.avg("log_close").over(_whole()),
            "naive": naive_prediction(),
        }
    )
    part = F.when(F.col("place") <= split_size(F.col("feature_rows"), held_out), "train").otherwise("test")
    return numbered.withColumn("part", part)


def trainable(features: DataFrame) -> DataFrame:
    """Feature rows of the series long enough to model."""
    return features.where((F.col("rows") >= MIN_ROWS) & (F.col("feature_rows") >= MIN_FEATURE_ROWS))


def series_status(series: DataFrame, features: DataFrame) -> DataFrame:
    """Per symbol whether it can be modelled, and if not which minimum it misses."""
    rows = series.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    built = features.groupBy("symbol").agg(F.count(F.lit(1)).alias("feature_rows"))
    feature_rows = F.coalesce("feature_rows", F.lit(0))
    status = (
        F.when(F.col("rows") < MIN_ROWS, "too_few_rows")
        .when(feature_rows < MIN_FEATURE_ROWS, "too_few_feature_rows")
        .otherwise("ok")
    )
    return rows.join(built, "symbol", "left").select(
        "symbol", "rows", feature_rows.alias("feature_rows"), status.alias("status")
    )


def naive_prediction(actual: str = "close") -> Column:
    """Yesterday's value; over train and test together, so that the first test row gets
    the last training value."""
    return F.lag(actual).over(_days())
