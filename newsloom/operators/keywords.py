"""Keyword counting over whole articles."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as T
from newsloom.functions.dates import format_day

RESULT = ["ngay", "nguon", "chu_de", "tu_khoa"]
COUNT = "so_lan_xuat_hien"


def explode_keywords(
    articles: DataFrame,
    text: Column,
    keep: list[Column | str],
    *,
    min_length: int = 2,
    stopwords: Iterable[str] = (),
    compat: bool = False,
    tokenizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row ``tu_khoa`` per keyword occurrence.

    Tokens are filtered after the explode, as rows, which stays in generated code
    where a filter inside an array would not. ``keep`` is worked out before, once an article. ``tokenizer``
    takes the cleaned, lowered text and returns a token array.
    """
    if tokenizer is None:
        rows = articles.select(*keep, text.alias("_text"))
        kept = [c for c in rows.columns if c != "_text"]
        # the tokens are no column of their own: Spark would filter on its size, and split each text twice
        rows = rows.select(*kept, F.explode(T.word_tokens(F.col("_text"), compat)).alias("tu_khoa"))
    else:
        # a row of its own for the text: Spark does not run a Python function on what holds lambda functions
        cleaned = F.array(T.trim_space(F.lower(T.clean_text(text, compat))))
        rows = articles.select(*keep, F.explode(cleaned).alias("_text"))
        kept = [c for c in rows.columns if c != "_text"]
        rows = rows.select(*kept, F.explode(tokenizer(F.col("_text"))).alias("tu_khoa"))
    if compat and tokenizer is None:
        rows = rows.withColumn("tu_khoa", F.lower("tu_khoa"))
    return rows.where(T.is_keyword(F.col("tu_khoa"), min_length, stopwords))


def trending_words(
    articles: DataFrame,
    *,
    min_length: int = 2,
    stopwords: Iterable[str] | DataFrame = (),
    compat: bool = False,
    tokenizer: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Keyword occurrences per day, source and category.

    Reads ``publish_date, source, chu_de, title, content``. Articles without a
    date are left out. Stopwords in a DataFrame (one column) are taken out after
    counting, when each keyword is one row per group however often it occurs.
    """
    in_frame = isinstance(stopwords, DataFrame)
    keep = [format_day(F.col("publish_date")).alias("ngay"), F.col("source").alias("nguon"), "chu_de"]
    words = explode_keywords(
        articles.where(format_day(F.col("publish_date")).isNotNull()),
        T.full_text(F.col("title"), F.col("content")), keep,
        min_length=min_length, stopwords=() if in_frame else stopwords,
        compat=compat, tokenizer=tokenizer,
    )
    counted = words.groupBy(*RESULT).agg(F.count("*").alias(COUNT))
    if in_frame:
        stop = stopwords.select(F.col(stopwords.columns[0]).alias("_stop")).distinct()
        spaced = F.replace(F.col("tu_khoa"), F.lit("_"), F.lit(" "))
        counted = counted.join(stop, spaced == F.col("_stop"), "left_anti")
    return counted


def trending_tokens_raw(articles: DataFrame, *, tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Token counts of the content as it stands: case kept, nothing filtered.

    Nulls count as empty strings, empty content is skipped and the day is not parsed.
    """
    blank = F.lit("")
    column = lambda name: F.coalesce(F.col(name), blank)
    rows = articles.where(column("content") != "").select(
        column("publish_date").alias("ngay"), column("source").alias("nguon"),
        column("chu_de").alias("chu_de"), column("content").alias("content"),
    )
    tokens = F.split("content", T.ASCII_SPACE_RUN) if tokenizer is None else tokenizer(F.col("content"))
    rows = rows.select("ngay", "nguon", "chu_de", F.explode(tokens).alias("tu_khoa"))
    return (
        rows.where(F.col("tu_khoa") != "")
        .withColumn("tu_khoa", T.phrase_of(F.col("tu_khoa")))
        .groupBy(*RESULT).agg(F.count("*").alias(COUNT))
    )


def sort_by_count(table: DataFrame) -> DataFrame:
    """Most frequent first, ties in key order."""
    return table.orderBy(F.desc(COUNT), *RESULT)


def count_token_classes(articles: DataFrame, text: str = "content") -> DataFrame:
    """Occurrences of each token class; every distinct token is classified once."""
    tokens = articles.select(F.explode(T.tokenize(F.col(text))).alias("token"))
    distinct = tokens.groupBy("token").agg(F.count("*").alias("n")).withColumn("shape", T.token_shape(F.col("token")))
    return (
        distinct.groupBy(T.token_class(F.col("token"), F.col("shape")).alias("token_class"))
        .agg(F.sum("n").alias("occurrences"), F.count("*").alias("distinct_tokens"))
    )
