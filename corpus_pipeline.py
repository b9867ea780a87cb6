"""A training corpus from ``documents``: stages that each work on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` writes each stage's result to the shared folder and
reads it again as the next one's input, so a lost executor repeats one stage at most.

1. quality: documents that the rule ensemble rejects go (operator 10)
2. near duplicates: one document of each class stays (operator 7)
3. repeated substrings: bytes of strings of 400 bytes that occur elsewhere go (operator 1)
4. decontamination: documents that hold benchmark passages go (operator 3)
5. tokens: ids of every document that is left, and their decoded text (operator 4)
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import bpe, decontamination, minhash, quality_rules, suffix_dedup
from newsloom.llm.arrays import written
from newsloom.llm.labelled import held_out

# The stages are iterative or learned; the tests compare them with brute force instead.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.good_documents(docs, _table(spark, sf_dir, "labels"), held_out(3, 1))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.kept_documents(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, _table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeated_substrings", repeated_substrings),
    ("decontamination", clean_of_benchmark), ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), spark, name)
    return STAGES[-1][1](spark, docs, sf_dir)
