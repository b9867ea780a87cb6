"""The queries of this subpackage, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    bpe, decontamination, hnsw, host_rules, id_files, minhash, periodic_runs, prefix_trie, quality_rules, sentence_spans, suffix_dedup, token_counts,
    toxicity,
)
from newsloom.llm.labelled import held_out
from newsloom.llm.oracle import ORACLE as SQL
from newsloom.session import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = dict(SQL)
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_suffix_dedup(spark, folder):
    return suffix_dedup.removal_report(table(spark, folder, "documents"))


@query
def op2_id_files(spark, folder):
    target = work_folder(spark, "ids")
    id_files.write_ids(table(spark, folder, "documents"), VOCABULARY, target)
    return id_files.read_documents(spark, target)


@query
def op3_decontamination(spark, folder):
    found = decontamination.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), decontamination.n_hit().cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


@query
def op4_bpe(spark, folder):
    return bpe.encode(table(spark, folder, "documents"), VOCABULARY)


def _scored(scored: DataFrame, held, threshold: float) -> DataFrame:
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


@query
def op5_token_counts(spark, folder):
    """Token counts before and after private strings are replaced."""
    return token_counts.count_edits(table(spark, folder, "documents"), VOCABULARY)


@query
def op6_sentence_spans(spark, folder):
    return sentence_spans.removal_report(table(spark, folder, "documents"))


@query
def op6_passages(spark, folder):
    """Operator 6 with clauses: passages that repeat inside sentences go as well."""
    return sentence_spans.removal_report(table(spark, folder, "documents"), clauses=True)


@query
def op7_minhash(spark, folder):
    """Documents with the class of their near-duplicates; one of each class is kept."""
    found = minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(F.col("doc").alias("doc_id"), "class_id", F.col("stays").alias("kept"))


@query
def op8_hnsw(spark, folder):
    return hnsw.linked_vectors(table(spark, folder, "embeddings"))


@query
def op9_toxicity(spark, folder):
    docs, held = table(spark, folder, "documents"), held_out(4, 2)
    model = toxicity.train(docs, table(spark, folder, "labels"), held)
    return _scored(toxicity.score(docs, model, ["doc_id"]), held, 0.3)


@query
def op10_quality_rules(spark, folder):
    docs, held = table(spark, folder, "documents"), held_out(3, 1)
    model = quality_rules.train(docs, table(spark, folder, "labels"), held)
    return _scored(quality_rules.score(docs, model, ["doc_id"]), held, 0.5)


@query
def op11_prefix_trie(spark, folder):
    return prefix_trie.trie_report(table(spark, folder, "conversations"))


@query
def op12_periodic_runs(spark, folder):
    return periodic_runs.run_report(periodic_runs.with_planted_runs(table(spark, folder, "documents")))


@query
def op13_host_rules(spark, folder):
    return host_rules.host_report(table(spark, folder, "documents"))
