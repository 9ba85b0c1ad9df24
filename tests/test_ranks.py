import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import ranks

COLUMNS = "day date, symbol string, x double"


def _rows(seed, size):
    draw = random.Random(seed)
    days = [None, *(dt.date(2024, 1, d) for d in range(1, 9))]
    return [(draw.choice(days), draw.choice(["A", "B", None]), draw.choice([None, 1.0, 2.5, -3.0])) for _ in range(size)]


def _key(row):
    return [(value is not None, value) if value is not None else (False,) for value in row]


@pytest.mark.parametrize("partitions", [1, 7])
def test_ranks_follow_the_total_order(spark, partitions):
    rows = _rows(partitions, 600)
    got = ranks.ranked(spark.createDataFrame(rows, COLUMNS).repartition(partitions), ["day"]).collect()
    in_order = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in in_order] == list(range(1, 601))
    assert [tuple(r)[:3] for r in in_order] == sorted(rows, key=_key)


def test_equal_rows_are_neither_lost_nor_doubled_nor_gathered(spark):
    same = spark.range(50_000).select(F.lit(dt.date(2024, 1, 5)).alias("day"), F.lit("HOT").alias("symbol"), F.lit(1.0).alias("x"))
    other = spark.createDataFrame(_rows(3, 500), COLUMNS)
    placed = ranks.ranked(same.unionByName(other), ["day"])
    found = placed.agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()
    assert tuple(found) == (50_500, 50_500, 1, 50_500)
    hot = placed.where("symbol = 'HOT'").agg(F.count("*"), (F.max("rank") - F.min("rank") + 1)).first()
    assert tuple(hot) == (50_000, 50_000)


def test_hot_value_spreads_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = spark.range(40_000).select(F.lit(1).alias("day"))
        placed = ranks.in_order(same, ["day"])
        sizes = [r["n"] for r in placed.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 4 and max(sizes) < 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table_and_own_rank_name(spark):
    empty = ranks.ranked(spark.createDataFrame([], COLUMNS), ["symbol"], "place")
    assert empty.columns == ["day", "symbol", "x", "place"] and empty.collect() == []
