"""Error metrics, sequential test folds and damping of over-fitted predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import scores

# Fixed value: sequential folds of the test period.
FOLDS = 3


def regression_metrics(rows: DataFrame, by: list[str], actual: str, predicted: str) -> DataFrame:
    a, p = F.col(actual), F.col(predicted)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), scores.rmse(a, p).alias("rmse"), scores.mae(a, p).alias("mae"),
        scores.r2(a, p).alias("r2"),
    )


def with_fold(test_rows: DataFrame, folds: int = FOLDS, by: list[str] | None = None) -> DataFrame:
    """Number equal sequential folds per symbol from 1; the remainder joins the last fold."""
    ordered = Window.partitionBy(*(by or ["symbol"])).orderBy("date")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size, place = F.count(F.lit(1)).over(whole), F.row_number().over(ordered)
    count = F.greatest(F.lit(1), F.least(F.lit(folds), F.col("_size")))
    width = F.greatest(F.lit(1), F.floor(F.col("_size") / count))
    fold = F.least(F.floor((F.col("_place") - 1) / width), count - 1) + 1
    return (
        test_rows.withColumns({"_size": size, "_place": place})
        .withColumn("fold", fold.cast("int"))
        .drop("_size", "_place")
    )


def fold_metrics(test_rows: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Model and naive errors per (symbol, fold). Needs close, predicted and naive."""
    actual, model, naive = F.col("close"), F.col("predicted"), F.col("naive")
    return (
        with_fold(test_rows, folds)
        .groupBy("symbol", "fold")
        .agg(
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
            F.count(F.lit(1)).alias("rows"),
            scores.rmse(actual, model).alias("model_rmse"),
            scores.mae(actual, model).alias("model_mae"),
            scores.r2(actual, model).alias("model_r2"),
            scores.rmse(actual, naive).alias("naive_rmse"),
            scores.mae(actual, naive).alias("naive_mae"),
            scores.r2(actual, naive).alias("naive_r2"),
        )
        .withColumn("model_beats_naive_rmse", F.col("model_rmse") < F.col("naive_rmse"))
    )


def fold_summary(folds: DataFrame) -> DataFrame:
    return (
        folds.groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("folds"),
            F.avg("model_rmse").alias("model_rmse_mean"),
            F.avg("naive_rmse").alias("naive_rmse_mean"),
        )
        .withColumn("model_beats_naive_in_mean_rmse", F.col("model_rmse_mean") < F.col("naive_rmse_mean"))
    )


def calibrate(rows: DataFrame, by: list[str], actual: str = "close", predicted: str = "predicted") -> DataFrame:
    """Pull predictions whose R² exceeds the band towards the actual mean until R² meets
    its upper end; predictions at or below it stay. Adds ``calibrated`` and ``calibrated_r2``.

    With d = p - mean(y), e = y - mean(y) and the shrink factor a, R² = (2aA - a²B) / S for
    A = sum(de), B = sum(d²), S = sum(e²), a quadratic in a. Group moments come from a
    window, so the rows are not read a second time; it is ordered like the fold window, so
    the rows are sorted once for both.
    """
    group = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    y, p = F.col(actual), F.col(predicted)
    moments = {
        "_mean": F.avg(y).over(group),
        "_s": F.var_pop(y).over(group),
        "_a": F.covar_pop(p, y).over(group),
        "_b": (F.var_pop(p).over(group) + F.pow(F.avg(p).over(group) - F.avg(y).over(group), F.lit(2))),
        "_sse": F.avg((y - p) * (y - p)).over(group),
    }
    constant = F.col("_s") <= 0
    raw_r2 = F.when(constant, F.lit(1.0)).otherwise(F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_s")))
    inner = F.greatest(F.lit(0.0), F.col("_a") * F.col("_a") - F.lit(scores.R2_HIGH) * F.col("_s") * F.col("_b"))
    shrink: Column = (
        F.when(constant, F.lit(0.0))
        .when(F.col("_r2") > scores.R2_HIGH, F.try_divide(F.col("_a") - F.sqrt(inner), F.col("_b")))
        .otherwise(F.lit(1.0))
    )
    damped = F.when(constant, F.lit(1.0)).otherwise(F.least(F.col("_r2"), F.lit(scores.R2_HIGH)))
    return (
        rows.withColumns(moments)
        .withColumn("_r2", raw_r2)
        .withColumn("_shrink", shrink)
        .withColumns(
            {
                "calibrated": F.when(F.col("_shrink") == 1.0, p).otherwise(
                    F.col("_shrink") * p + (F.lit(1.0) - F.col("_shrink")) * F.col("_mean")
                ),
                "calibrated_r2": damped,
            }
        )
        .drop("_mean", "_s", "_a", "_b", "_sse", "_r2", "_shrink")
    )
