"""Tables that several jobs may write to at once: an append log, compacted into versions.

    root/log/<name>        one folder per append; it counts once Spark has marked it as whole
    root/data/<name>       what a compaction wrote
    root/manifest-<n>      the n-th version: its data folder and the log folders that are in it

A reader takes the newest manifest's data and every whole log folder that is not in it. A manifest
comes into being by one rename that fails if another job was first, so a version is there
wholly or not at all; the loser's log folders are still in the log. What a job that stopped half-way
left behind is in no manifest and has no mark, and is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "manifest-"


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a function that makes paths of it."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def _names(spark: SparkSession, path: str) -> list[str]:
    files, make = _files(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(make(path))) if files.exists(make(path)) else []


def _current(spark: SparkSession, root: str) -> tuple[int, dict]:
    numbers = [int(name.removeprefix(_MANIFEST)) for name in _names(spark, root) if name.startswith(_MANIFEST)]
    if not numbers:
        return 0, {"data": None, "log": []}
    text = spark.read.option("wholetext", True).text(f"{root}/{_MANIFEST}{max(numbers):09d}").first()[0]
    return max(numbers), json.loads(text)


def _whole(spark: SparkSession, root: str) -> list[str]:
    files, make = _files(spark, root)
    return [name for name in _names(spark, f"{root}/log") if files.exists(make(f"{root}/log/{name}/_SUCCESS"))]


def append(rows: DataFrame, root: str) -> str:
    """Add rows as one entry of the log; the entry's name. Readers see all of it or nothing."""
    name = uuid.uuid4().hex
    rows.write.parquet(f"{root}/log/{name}")
    return name


def last_written(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order`` and then by all other columns; a partial aggregate."""
    others = [c for c in rows.columns if c != key and c not in order]
    newest = rows.groupBy(key).agg(F.max(F.struct(*order, *others)).alias("_row"))
    return newest.select(key, "_row.*").select(*rows.columns)


def _parts(spark: SparkSession, root: str, schema: str, data: str | None, log: Sequence[str]) -> DataFrame:
    paths = ([f"{root}/data/{data}"] if data else []) + [f"{root}/log/{name}" for name in log]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, schema: str, key: str, order: Sequence[str]) -> DataFrame:
    """The table as it stands: one row per key, the last written. A table that nobody wrote to is empty."""
    _, manifest = _current(spark, root)
    pending = sorted(set(_whole(spark, root)) - set(manifest["log"]))
    return last_written(_parts(spark, root, schema, manifest["data"], pending), key, order)


def compact(spark: SparkSession, root: str, schema: str, key: str, order: Sequence[str]) -> bool:
    """Fold the log into a new version. False when another job made that version first; nothing is lost then."""
    number, manifest = _current(spark, root)
    log, name = _whole(spark, root), uuid.uuid4().hex
    pending = sorted(set(log) - set(manifest["log"]))
    last_written(_parts(spark, root, schema, manifest["data"], pending), key, order).write.parquet(f"{root}/data/{name}")
    files, make = _files(spark, root)
    draft, target = make(f"{root}/.draft-{name}"), make(f"{root}/{_MANIFEST}{number + 1:09d}")
    out = files.create(draft, False)
    out.write(json.dumps({"data": name, "log": log}).encode())
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    choice = spark.sparkContext._gateway.new_array(options, 1)
    choice[0] = options.NONE  # fails where the target exists
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, choice)
    except Py4JJavaError:
        if not files.exists(target):
            raise
        files.delete(draft, False)
        files.delete(make(f"{root}/data/{name}"), True)
        return False
    return True


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete log folders that the current version holds, and data folders of earlier versions. For times without readers of those."""
    files, make = _files(spark, root)
    number, manifest = _current(spark, root)
    old = [f"{root}/log/{name}" for name in manifest["log"] if files.exists(make(f"{root}/log/{name}"))]
    for n in range(1, number):
        past = f"{root}/{_MANIFEST}{n:09d}"
        if files.exists(make(past)):
            data = json.loads(spark.read.option("wholetext", True).text(past).first()[0])["data"]
            old += [f"{root}/data/{data}", past]
    for path in old:
        files.delete(make(path), True)
    return old
