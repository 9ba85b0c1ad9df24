import os

import pytest
from pyspark.sql import functions as F

from tickloom.operators import quality, series
from tickloom.operators.expectations import Expectation, judged
from tickloom.plans import etl
from tickloom.sources import guarded

ROWS = [("A", "2024-01-02", "1,5"), ("A", "2024-01-03", "x"), (None, "no day", "x"), ("B", "2024-01-02", "-1"), ("B", None, "2"), ("A", "2024-01-02", "1,5")]


def _quotes(spark, rows):
    return spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "symbol string, date string, close string, n bigint")


def test_rows_are_kept_diverted_and_counted_in_one_write(spark, tmp_path):
    path = str(tmp_path / "quotes")
    table = _quotes(spark, ROWS)
    made = etl.write_quotes(table, path, input_order=["n"])
    assert (made.rows, made.diverted) == (6, 3)
    assert {x.name: x.rows for x in made.findings} == {"day_known": 2, "close_known": 2, "symbol_known": 1, "close_positive": 3}
    parsed = series.parse_series(table, ["n"])
    kept = guarded.read(parsed, made.path)
    assert kept.columns == parsed.columns and [r.n for r in kept.orderBy("n").collect()] == [0, 3, 5]
    away = {r.n: r.broken for r in guarded.read(parsed, made.quarantine, quarantined=True).collect()}
    assert away == {1: ["close_known", "close_positive"], 2: ["day_known", "close_known", "symbol_known", "close_positive"], 4: ["day_known"]}
    dropped = quality.series_report(parsed, ["n"]).where("check = 'dropped_rows'").agg(F.sum("observed")).first()[0]
    assert dropped == made.diverted
    assert sorted(os.listdir(tmp_path)) == ["quotes", "quotes_quarantine"]


def test_a_rejected_table_leaves_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t")
    rule = [Expectation("small", F.col("x") < 10, "reject"), Expectation("even", F.col("x") % 2 == 0, "divert")]
    before = spark.createDataFrame([(2,), (3,)], "x int")
    guarded.write(before, path, rule)
    with pytest.raises(guarded.Rejected, match="small .2 rows") as seen:
        guarded.write(spark.createDataFrame([(4,), (11,), (None,)], "x int"), path, rule)
    assert {x.name: x.rows for x in seen.value.findings} == {"small": 2, "even": 2}
    assert [r.x for r in guarded.read(before, path).collect()] == [2]
    assert [r.x for r in guarded.read(before, f"{path}_quarantine", True).collect()] == [3]
    assert sorted(os.listdir(tmp_path)) == ["t", "t_quarantine"]
    guarded.write(spark.createDataFrame([(6,)], "x int"), path, rule)  # replaces both
    assert [r.x for r in guarded.read(before, path).collect()] == [6]
    assert guarded.read(before, f"{path}_quarantine", True).count() == 0


def test_a_write_that_fails_leaves_no_draft(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("x"))
    with pytest.raises(Exception, match="lost"):
        guarded.write(table, path, [])
    assert os.listdir(tmp_path) == []


def test_empty_tables_partitions_and_no_expectations(spark, tmp_path):
    empty = spark.createDataFrame([], "x int, y string")
    made = guarded.write(empty, str(tmp_path / "none"), [Expectation("known", F.col("x").isNotNull(), "reject")])
    assert (made.rows, made.diverted, guarded.read(empty, made.path).count()) == (0, 0, 0)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "b")], empty.schema)
    made = guarded.write(rows, str(tmp_path / "parts"), [], by=["y"])
    assert made.findings == [] and sorted(map(str, guarded.read(rows, made.path).collect())) == sorted(map(str, rows.collect()))
    assert {"y=a", "y=b"} <= set(os.listdir(made.path))


def test_wrong_expectations(spark):
    with pytest.raises(ValueError, match="action"):
        Expectation("a", F.lit(True), "drop")
    table = spark.range(1)
    with pytest.raises(ValueError, match="name of its own"):
        judged(table, [Expectation("a", F.lit(True)), Expectation("a", F.lit(False))])
    with pytest.raises(ValueError, match="broken"):
        judged(table.withColumnRenamed("id", "Broken"), [])


def test_findings_and_rows_read_the_source_once(spark, tmp_path):
    _quotes(spark, [r for r in ROWS if r[0]]).write.parquet(str(tmp_path / "source"))
    table = spark.read.parquet(str(tmp_path / "source"))
    treated = etl.treat_table(table, input_order=["n"], store=True)
    for frame in (treated.frame, treated.findings):
        assert all("/days-" in name for name in frame.inputFiles())
    plain = etl.treat_table(table, input_order=["n"])
    assert sorted(treated.frame.collect()) == sorted(plain.frame.collect())
    assert sorted(treated.findings.collect()) == sorted(plain.findings.collect())
