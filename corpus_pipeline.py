"""From raw documents to tokens: five stages, each over all that the one before kept.

A stage is (name, function of (spark, docs, sf_dir)). ``run`` applies them to ``documents``;
each stage's result is written as Parquet and read again as the next one's documents. All
stages but the last return the columns of ``documents``. Stages take empty tables, null,
empty and very long texts, repeated rows and further columns as their operators do.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, decontaminate, linededup, oddsketch, toxicity
from tickloom.llm.common import written
from tickloom.llm.tables import read


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; it learns from the labelled ones."""
    return toxicity.accepted(docs, read(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of runs of lines are cut out of the texts; documents of which nothing is left go."""
    return linededup.deduplicated(docs, keep_emptied=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: three-word shingles, similarity 0.85 or more, as in op10."""
    return oddsketch.without_duplicates(docs, length=3, percent=85)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontaminate.removed(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: count and digest of its tokens, and the digest of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", contaminated),
    ("byte_bpe", tokens),
]

#: The toxicity stage is a trained model and the last stage a tokenizer: SQL has neither.
#: tests/llm/test_pipeline.py holds the pipeline against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
