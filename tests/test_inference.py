import itertools

import pytest
from pyspark.sql import functions as F

from tickloom.operators import inference

VALUES = {
    inference.LONG: ["1", "-7", " +12 ", "9223372036854775807"],
    inference.DOUBLE: ["1.5", ".5", "3.", "1e3", "9223372036854775808", "-2E-4"],
    inference.DATE: ["2024-02-29", "0001-01-01"],
    inference.TIMESTAMP: ["2024-01-01 10:00:00", "2024-01-01T23:59:59.123456"],
    inference.TEXT: ["x", "2023-02-29", "2024-01-01 25:00:00", "1,5", "NaN", "1e", "--1", "2024-1-1"],
    0: [None, "", "   "],
}


def test_kinds_of_values(values):
    for kind, texts in VALUES.items():
        assert values(inference.kind, texts) == [kind] * len(texts)


def _expected(kinds):
    kinds = set(kinds) - {0}
    if not kinds:
        return "null"
    if kinds <= {inference.LONG}:
        return "long"
    if kinds <= {inference.LONG, inference.DOUBLE}:
        return "double"
    if kinds == {inference.DATE}:
        return "date"
    return "timestamp" if kinds <= {inference.DATE, inference.TIMESTAMP} else "text"


@pytest.mark.parametrize("partitions", [1, 5])
def test_every_mixture_has_its_type_under_any_partitioning(spark, partitions):
    mixtures = [m for n in range(1, 4) for m in itertools.combinations(VALUES, n)]
    columns = {f"c{i}": [v for k in m for v in VALUES[k]] for i, m in enumerate(mixtures)}
    size = max(map(len, columns.values()))
    rows = list(zip(*(x + [None] * (size - len(x)) for x in columns.values())))
    table = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(partitions)
    found = {r["column"]: (r["type"], r["filled"]) for r in inference.inferred_types(table, list(columns)).collect()}
    filled = lambda texts: sum(bool(t and t.strip()) for t in texts)
    assert found == {c: (_expected(m), filled(columns[c])) for c, m in zip(columns, mixtures)}


def test_typed_table_keeps_every_value(spark):
    rows = [("1", "2024-01-01", "x", " "), (" 2 ", "2024-01-02 03:04:05", "", None), (None, "", "7", "")]
    table = spark.createDataFrame(rows, "a string, b string, c string, d string")
    made = inference.typed(table, inference.inferred_types(table, table.columns))
    assert [f.dataType.simpleString() for f in made.schema] == ["bigint", "timestamp", "string", "string"]
    assert [(r["a"], r["c"], r["d"]) for r in made.collect()] == [(1, "x", None), (2, None, None), (None, "7", None)]
    assert made.select(F.count("b")).first()[0] == 2
    empty = inference.inferred_types(table.where("1 = 0"), ["a"])
    assert [tuple(r) for r in empty.collect()] == [("a", "null", 0)]
