"""Joining the words of known phrases (``new york`` -> ``new_york``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text as T


def merge_phrases(articles: DataFrame, lexicon: DataFrame, *, row_id: str = "article_id", text: str = "content") -> DataFrame:
    """Text with leftmost-longest lexicon phrases of two words and more joined.

    Each two neighbouring words become one hash of their codes, and no string is built for them. The hashes are
    joined with those of the first two words of the phrases, so an article carries only the phrases that may
    begin in it. Spark picks the join by the size of the lexicon; a hot pair is split by its skew join. Which
    phrases are there, word by word, and which of them count is then decided inside each article.
    """
    phrase = T.tokenize(F.lower(F.col(lexicon.columns[0])))
    known = lexicon.select(phrase.alias("words")).where(F.size("words") > 1).distinct()
    heads = known.select(_head(F.xxhash64(F.get("words", F.lit(0))), F.xxhash64(F.get("words", F.lit(1)))).alias("head"), "words")
    codes = F.transform(T.tokenize(F.col(text)), lambda w: F.xxhash64(F.lower(w)))
    starts = articles.select(row_id, F.posexplode(T.let(codes, _heads)).alias("at", "head"))
    found = starts.join(heads, "head").select(row_id, F.struct((F.col("at") + 1).alias("at"), F.size("words").alias("n"), "words").alias("hit"))
    listed = articles.join(found.groupBy(row_id).agg(F.collect_list("hit").alias("_hits")), row_id, "left")
    listed = listed.withColumn("_tokens", T.tokenize(F.col(text)))
    # named twice, so that Spark does not move the splitting of the text into the functions
    lowered = lambda h: F.transform(F.slice("_tokens", h["at"], h["n"]), F.lower)
    real = F.when(F.size("_tokens") > 0, F.filter("_hits", lambda h: lowered(h) == h["words"]))
    # by place, the longest first
    ordered = F.array_sort(F.transform(real, lambda h: F.struct(h["at"].alias("at"), (-h["n"]).alias("short"))))
    listed = listed.withColumn("_order", F.coalesce(ordered, F.array().cast("array<struct<at:int,short:int>>")))
    listed = listed.withColumn("_taken", _taken(F.col("_order")))
    joined = F.when(F.size("_taken") == 0, F.array_join("_tokens", " ")).otherwise(_joined(F.col("_tokens"), F.col("_taken")))
    return listed.withColumn(text, F.when(F.col(text).isNotNull(), joined)).select(*articles.columns)


def _head(first: Column, second: Column) -> Column:
    return F.xxhash64(first, second)


def _heads(codes: Column) -> Column:
    """The hash of each two neighbouring codes."""
    each = F.sequence(F.lit(0), F.size(codes) - 2)
    heads = F.transform(each, lambda i: _head(F.get(codes, i), F.get(codes, i + 1)))
    return F.when(F.size(codes) > 1, heads).otherwise(F.array().cast("array<bigint>"))


def _taken(order: Column) -> Column:
    """The hits that begin after the last one taken, as (at, end) with the end not included."""
    empty = F.array().cast("array<struct<at:int,end:int>>")

    def take(state: Column, hit: Column) -> Column:
        end = (hit["at"] - hit["short"]).cast("int")
        taken = F.struct(end.alias("next"), F.array_append(state["taken"], F.struct(hit["at"].alias("at"), end.alias("end"))).alias("taken"))
        return F.when(hit["at"] >= state["next"], taken).otherwise(state)

    start = F.struct(F.lit(1).cast("int").alias("next"), empty.alias("taken"))
    return F.aggregate(order, start, take, lambda s: s["taken"])


def _joined(tokens: Column, taken: Column) -> Column:
    """The tokens as a text, those of a taken hit joined by "_"; each token is copied once."""
    part = lambda first, end, mark: F.array_join(F.slice(tokens, first, end - first), mark)
    ends = F.concat(F.array(F.lit(1)), F.transform(taken, lambda t: t["end"]))
    starts = F.concat(F.transform(taken, lambda t: t["at"]), F.array(F.size(tokens) + 1))
    plain = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda z: part(z["a"], z["b"], " "))
    phrases = F.transform(taken, lambda t: part(t["at"], t["end"], "_"))
    both = F.transform(F.arrays_zip(plain.alias("p"), phrases.alias("q")), lambda z: F.concat_ws(" ", F.nullif(z["p"], F.lit("")), z["q"]))
    return F.array_join(F.filter(both, lambda x: x != ""), " ")
