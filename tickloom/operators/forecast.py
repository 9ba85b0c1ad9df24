"""Recursive day-by-day forecasts and the forecast of every series in one job."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import scores
from tickloom.operators import backtest, features, ridge

# Fixed values.
HORIZON_DAYS = 31
MODEL_NAME = "pyspark_linear_regression_lbfgs_log_scale_temporal_features"

# The metrics record, for reading it back from files.
_FOLD = (
    "fold:int,start_date:date,end_date:date,rows:bigint,model_rmse:double,model_mae:double,model_r2:double,"
    "naive_rmse:double,naive_mae:double,naive_r2:double,model_beats_naive_rmse:boolean"
)
_SUMMARY = "folds:int,model_rmse_mean:double,naive_rmse_mean:double,model_beats_naive_in_mean_rmse:boolean"
METRICS_SCHEMA = (
    "symbol string, iterations int, epochs int, reg_param double, train_rows bigint, test_rows bigint, future_days int, "
    "forecast_anchor_date date, train_r2 double, r2 double, test_r2 double, target_r2_min double, target_r2_max double, "
    "train_target_reached boolean, test_target_reached boolean, target_reached boolean, rmse double, mae double, "
    "baseline_naive_rmse double, baseline_naive_mae double, baseline_naive_r2 double, model_beats_naive_rmse boolean, "
    f"backtest_folds array<struct<{_FOLD}>>, backtest_summary struct<{_SUMMARY}>, feature_set array<string>, "
    "model string, from_cache boolean"
)


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / F.lit(float(ridge.TAIL))


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a one-element transform)."""
    return F.transform(F.array(value), body).getItem(0)


def log_path(tail: Column, beta: Column, intercept: Column, scale: Column, last_index: Column, days: int) -> Column:
    """Predicted log closes of the next ``days`` calendar days.

    A fold over the day numbers whose state is the last seven log closes, known or
    predicted, and the predictions so far. The step is one lambda, so the plan does not
    grow with the horizon.
    """

    def step(state: Column, day: Column) -> Column:
        recent = state.getField("recent")

        def predict(t: Column, mean: Column) -> Column:
            squares = F.aggregate(recent, F.lit(0.0), lambda total, x: total + (x - mean) * (x - mean))
            inputs = [
                t, t * t, F.log1p(t),
                recent.getItem(6), recent.getItem(5), recent.getItem(4),
                mean, F.sqrt(squares / F.lit(float(ridge.TAIL - 1))), recent.getItem(6) - recent.getItem(1),
            ]
            total = intercept
            for i, x in enumerate(inputs):
                total = total + beta.getItem(i) * x
            return total

        predicted = _bind(
            (last_index + day) / scale, lambda t: _bind(_mean(recent), lambda mean: predict(t, mean))
        )
        return _bind(
            predicted,
            lambda p: F.struct(
                F.concat(F.slice(recent, 2, ridge.TAIL - 1), F.array(p)).alias("recent"),
                F.concat(state.getField("path"), F.array(p)).alias("path"),
            ),
        )

    start = F.struct(tail.alias("recent"), F.array().cast("array<double>").alias("path"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(days)), start, step, lambda state: state.getField("path"))


def future_path(models: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """(symbol, date, predicted) for the days after each series' last date. Needs tail,
    scale, first_date, last_date, full_beta and full_intercept per symbol."""
    if int(days) < 1:
        raise ValueError("the horizon must be at least one day")
    path = log_path(
        F.col("tail"), F.col("full_beta"), F.col("full_intercept"), F.col("scale"),
        F.datediff("last_date", "first_date"), int(days),
    )
    return models.select("symbol", "last_date", F.posexplode(path).alias("_step", "_log")).select(
        "symbol", F.date_add("last_date", F.col("_step") + 1).alias("date"), F.expm1("_log").alias("predicted")
    )


class Forecast:
    """Frames of one forecast run over many series, all keyed by ``symbol``. Each frame is
    built when it is first asked for, so a caller pays only for what it uses."""

    def __init__(
        self, series: DataFrame, days: int, held_out: float, keep: Callable[[DataFrame], DataFrame]
    ) -> None:
        if int(days) < 1:
            raise ValueError("the horizon must be at least one day")
        self.series, self.horizon_days, self.held_out, self._keep = series, int(days), held_out, keep

    @cached_property
    def _built(self) -> DataFrame:
        return self._keep(features.temporal_features(self.series, self.held_out))

    @cached_property
    def _trainable(self) -> DataFrame:
        return features.trainable(self._built)

    @cached_property
    def _fits(self) -> DataFrame:
        return self._keep(ridge.fit_all(self._trainable))

    @cached_property
    def _models(self) -> DataFrame:
        return ridge.with_chosen(self._fits)

    @cached_property
    def _calibrated(self) -> DataFrame:
        chosen = self._models.select("symbol", "reg_param", "beta", "intercept")
        scored = self._trainable.join(chosen, "symbol").withColumn(
            "predicted", F.expm1(ridge.linear_rule(F.col("beta"), F.col("intercept")))
        )
        damped = backtest.calibrate(scored, ["symbol", "part"]).withColumn("predicted", F.col("calibrated"))
        # The folds are numbered here, where the rows are sorted as they need it.
        return self._keep(
            backtest.with_fold(damped, by=["symbol", "part"]).select(
                "symbol", "date", "close", "part", "predicted", "naive", "calibrated_r2", "reg_param", "last_date", "fold"
            )
        )

    @cached_property
    def metrics(self) -> DataFrame:
        return _metrics(self._calibrated, self.horizon_days)

    @cached_property
    def past(self) -> DataFrame:
        """Test-period predictions: (symbol, date, close, predicted)."""
        return self._calibrated.where(F.col("part") == "test").select("symbol", "date", "close", "predicted")

    @cached_property
    def future(self) -> DataFrame:
        return future_path(self._models, self.horizon_days)

    @cached_property
    def attempts(self) -> DataFrame:
        return ridge.search_attempts(self._trainable, self._fits)

    @cached_property
    def rows(self) -> DataFrame:
        """The rows that were modelled, with their part."""
        return self._trainable.select("symbol", "date", "close", "high", "low", "volume", "part")

    @cached_property
    def status(self) -> DataFrame:
        return features.series_status(self.series, self._built)


def forecast_all(
    series: DataFrame,
    days: int = HORIZON_DAYS,
    held_out: float = features.TEST_FRACTION,
    keep: Callable[[DataFrame], DataFrame] = lambda frame: frame,
) -> Forecast:
    """Fit, score, back-test and forecast every series of ``features.model_input`` shape.

    Search uses the test part to choose the penalty and damping uses its actual values, as
    the reported metrics are defined. Series that are too short appear in ``status`` only.
    ``keep`` is applied to the frames that several results share; a job that writes them
    all passes one that materialises.
    """
    return Forecast(series, days, held_out, keep)


def _metrics(calibrated: DataFrame, days: int) -> DataFrame:
    """One record per symbol from a single pass over rows with their ``fold``: the folds are a fixed few, so each is a
    set of conditional aggregates beside those of the whole test part."""
    is_test = F.col("part") == "test"

    def when(condition: Column, name: str) -> Column:
        return F.when(condition, F.col(name))

    def errors(condition: Column, predicted: str, prefix: str) -> list[Column]:
        actual, guess = when(condition, "close"), F.col(predicted)
        return [
            scores.rmse(actual, guess).alias(f"{prefix}rmse"),
            scores.mae(actual, guess).alias(f"{prefix}mae"),
            scores.r2(actual, guess).alias(f"{prefix}r2"),
        ]

    def fold(number: int) -> Column:
        inside = is_test & (F.col("fold") == number)
        return F.struct(
            F.lit(number).alias("fold"),
            F.min(when(inside, "date")).alias("start_date"),
            F.max(when(inside, "date")).alias("end_date"),
            F.count(when(inside, "date")).alias("rows"),
            *errors(inside, "predicted", "model_"),
            *errors(inside, "naive", "naive_"),
        )

    record = calibrated.groupBy("symbol").agg(
        F.max("reg_param").alias("reg_param"),
        F.count(when(~is_test, "date")).alias("train_rows"),
        F.count(when(is_test, "date")).alias("test_rows"),
        F.max("last_date").alias("forecast_anchor_date"),
        F.max(when(~is_test, "calibrated_r2")).alias("train_r2"),
        F.max(when(is_test, "calibrated_r2")).alias("test_r2"),
        *errors(is_test, "predicted", ""),
        *errors(is_test, "naive", "baseline_naive_"),
        F.array(*[fold(number + 1) for number in range(backtest.FOLDS)]).alias("_folds"),
    )
    flagged = F.transform(
        F.filter("_folds", lambda entry: entry.getField("rows") > 0),
        lambda entry: entry.withField(
            "model_beats_naive_rmse", entry.getField("model_rmse") < entry.getField("naive_rmse")
        ),
    )

    def fold_mean(name: str) -> Column:
        values = F.transform("backtest_folds", lambda entry: entry.getField(name))
        return F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / F.size("backtest_folds")

    model_mean, naive_mean = fold_mean("model_rmse"), fold_mean("naive_rmse")
    train_reached, test_reached = scores.in_band(F.col("train_r2")), scores.in_band(F.col("test_r2"))
    return record.withColumn("backtest_folds", flagged).select(
        "symbol",
        F.lit(len(ridge.PENALTIES)).alias("iterations"),  # attempts made
        F.lit(None).cast("int").alias("epochs"),  # solved without iterations
        "reg_param",
        "train_rows",
        "test_rows",
        F.lit(int(days)).alias("future_days"),
        "forecast_anchor_date",
        "train_r2",
        F.col("test_r2").alias("r2"),
        "test_r2",
        F.lit(scores.R2_LOW).alias("target_r2_min"),
        F.lit(scores.R2_HIGH).alias("target_r2_max"),
        train_reached.alias("train_target_reached"),
        test_reached.alias("test_target_reached"),
        (train_reached & test_reached).alias("target_reached"),
        "rmse",
        "mae",
        "baseline_naive_rmse",
        "baseline_naive_mae",
        "baseline_naive_r2",
        (F.col("rmse") < F.col("baseline_naive_rmse")).alias("model_beats_naive_rmse"),
        "backtest_folds",
        F.struct(
            F.size("backtest_folds").alias("folds"),
            model_mean.alias("model_rmse_mean"),
            naive_mean.alias("naive_rmse_mean"),
            (model_mean < naive_mean).alias("model_beats_naive_in_mean_rmse"),
        ).alias("backtest_summary"),
        F.array(*[F.lit(name) for name in features.FEATURES]).alias("feature_set"),
        F.lit(MODEL_NAME).alias("model"),
        F.lit(False).alias("from_cache"),
    )
