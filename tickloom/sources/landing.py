"""Raw files kept byte for byte, as numbered pieces with offset and digest.

Every piece is read by its own range of the file, so a file of any size is landed by many tasks
and none holds more than a piece. Pieces of one file in order are the file again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.names import slug
from tickloom.sources.folder import file_system, listed_files

PIECE_BYTES = 4 << 20
_PIECES = "path string, length long, number long, content binary"


def _ranges(piece_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                path, number = row.column(0)[0].as_py(), row.column(2)[0].as_py()
                system, inner = file_system(path)
                with system.open_input_file(inner) as source:
                    source.seek(number * piece_bytes)
                    content = source.read(piece_bytes)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([content], pa.binary())], ["path", "length", "number", "content"])

    return run


def pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(path, length, number, at, content, sha256) of listed files: piece ``number`` begins at byte ``at``."""
    last = F.ceil(F.col("length") / piece_bytes) - 1
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("number"))
    read = ranges.repartition("path", "number").mapInArrow(_ranges(piece_bytes), _PIECES)
    return read.select("path", "length", "number", (F.col("number") * piece_bytes).alias("at"), "content", _digest().alias("sha256"))


def _digest() -> Column:
    return F.sha2("content", 256)


def land_raw(
    spark: SparkSession, path: str, root: str, source_name: str, piece_bytes: int = PIECE_BYTES, pattern: str = "*", recursive: bool = False
) -> str:
    """A file, or a folder's files, as pieces under the source's slug; what was landed before stays."""
    named = pieces(listed_files(spark, path, pattern, recursive), piece_bytes).withColumn("source_slug", slug(F.lit(source_name)))
    named.write.mode("append").partitionBy("source_slug").parquet(root)
    return root


def faults(landed: DataFrame) -> DataFrame:
    """(path, fault) for files that don't come back whole: changed, missing or repeated pieces."""
    size = F.octet_length("content")
    seen = landed.groupBy("path").agg(
        F.count_if(_digest() != F.col("sha256")).alias("changed"), F.countDistinct("number").alias("different"), F.count(F.lit(1)).alias("n"),
        F.max("number").alias("last"), F.sum(size).alias("bytes"), F.max("length").alias("length"),
    )
    fault = (
        F.when(F.col("changed") > 0, "changed piece").when(F.col("n") > F.col("different"), "repeated piece")
        .when((F.col("different") <= F.col("last")) | (F.col("bytes") != F.col("length")), "missing piece")
    )
    return seen.select("path", fault.alias("fault")).where("fault is not null")


def restored(landed: DataFrame, folder: str) -> DataFrame:
    """Writes the landed files back and reports (path, target, bytes, sha256) for each.

    A file is written by one task, piece by piece, under a name of its own that is changed
    when it is whole; a task that runs again replaces it. Files of one name from different
    folders don't meet: a digest of the path is the folder below ``folder``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, writer, digest, size = None, None, None, 0

        def whole() -> pa.RecordBatch:
            writer.close()
            target = f"{folder}/{hashlib.sha256(path.encode()).hexdigest()[:12]}/{path.rsplit('/', 1)[-1]}"
            system, inner = file_system(target)
            system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            system.move(part, inner)
            arrays = [[path], [target], [size], [digest.hexdigest()]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["path", "target", "bytes", "sha256"])

        for batch in batches:
            for i in range(batch.num_rows):
                own, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer()
                if own != path:
                    if writer is not None:
                        yield whole()
                    path, digest, size = own, hashlib.sha256(), 0
                    system, root = file_system(folder)
                    system.create_dir(root, recursive=True)
                    part = f"{root}/{hashlib.sha256(path.encode()).hexdigest()[:12]}.{id(batch)}.part"
                    writer = system.open_output_stream(part)
                writer.write(content)
                digest.update(content)
                size += content.size
        if writer is not None:
            yield whole()

    in_order = landed.select("path", "number", "content").repartition("path").sortWithinPartitions("path", "number").select("path", "content")
    return in_order.mapInArrow(run, "path string, target string, bytes long, sha256 string")
