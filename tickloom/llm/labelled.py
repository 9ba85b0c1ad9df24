"""Labelled rows to learn from, and small helpers of the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import picked

#: The classifiers learn from so many labelled rows at most, chosen by a hash of the id.
SAMPLE_ROWS = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, held_out: int, limit: int = SAMPLE_ROWS) -> DataFrame:
    """``(doc_id, label, text)``: labelled documents outside the held-out fold, ``limit`` of them at most.

    Several labels of one id count as the largest, several texts as the smallest one; null
    labels and ids are no labels. The ids are chosen by a hash, so every kind of row has
    the same chance.
    """
    known = picked(labels, doc_id="doc_id", label=target).where("doc_id is not null and label is not null")
    known = known.groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    known = known.where(fold(F.col("doc_id"), folds) != held_out)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = picked(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen), "doc_id")  # limit rows, by the limit above
    return texts.groupBy("doc_id").agg(F.max("label").alias("label"), F.min(F.coalesce("text", F.lit(""))).alias("text"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x)))
