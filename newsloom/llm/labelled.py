"""Labelled rows for training: the folds and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import text_of

MAX_LABELLED = 20_000


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, held: Column, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text and label of at most ``limit`` labelled rows outside the held-out fold.

    Rows are taken in the order of a hash of the id, so a repeated run takes the same ones.
    A row without an id or a label is not used; of several labels of one id the lowest counts,
    of several texts of one id the one with the lowest hash.
    The ids are broadcast: there are at most ``limit``.
    """
    order = F.xxhash64("doc_id")
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held)
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).orderBy(order, "doc_id").limit(limit)
    )
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(known), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
