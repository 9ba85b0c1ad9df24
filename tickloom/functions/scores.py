"""Regression error measures as aggregate columns, and the target band for R²."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted range of R².
R2_LOW = 0.60
R2_HIGH = 0.80


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def r2(actual: Column, predicted: Column) -> Column:
    """1 - SSE/SST; a constant actual series scores 1. Constant means min = max: a deviation
    merged from partial buffers need not come out as 0."""
    sst = F.var_pop(actual)
    sse = F.avg((actual - predicted) * (actual - predicted))
    return F.when(F.min(actual) == F.max(actual), F.lit(1.0)).otherwise(F.lit(1.0) - F.try_divide(sse, sst))


def distance_to_band(score: Column) -> Column:
    return F.greatest(F.lit(R2_LOW) - score, score - F.lit(R2_HIGH), F.lit(0.0))


def in_band(score: Column) -> Column:
    return score.between(R2_LOW, R2_HIGH)
