"""Duplicate articles: same feed, same calendar day, same normalised title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import day_of
from newsloom.functions.text import normalize_title
from newsloom.operators.matching import attach_by_key, keep_first

KEY = ["_feed", "_day", "_title"]
NONE = "none"


def _or_none(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(NONE))


def with_key(articles: DataFrame, published: str = "published_at") -> DataFrame:
    """The articles with their key columns, which are never null.

    A missing feed or day is a value like any other, in grouping and in joins alike:
    undated copies of one feed and title are duplicates of each other.
    """
    return articles.withColumns({
        "_feed": _or_none(F.col("feed_source_id")), "_day": _or_none(day_of(F.col(published))),
        "_title": normalize_title(F.col("title")),
    })


def first_wins(articles: DataFrame, article_id: str = "article_id", published: str = "published_at") -> DataFrame:
    """First article of every key, by id."""
    return keep_first(with_key(articles, published), KEY, article_id).select(*articles.columns)


def mark_duplicates(articles: DataFrame, article_id: str = "article_id", published: str = "published_at") -> DataFrame:
    """Every article, with ``is_duplicate`` and the id of the first one of its key."""
    keyed = with_key(articles, published)
    firsts = keyed.groupBy(*KEY).agg(F.min(article_id).alias("_first"))
    later = F.col("_first") < F.col(article_id)
    return attach_by_key(keyed, firsts, KEY, article_id).select(
        *articles.columns,
        F.coalesce(later, F.lit(False)).alias("is_duplicate"),
        F.when(later, F.col("_first")).alias("duplicate_of_id"),
    )


def duplicate_of(
    items: DataFrame, stored: DataFrame, item_id: str = "item_id",
    stored_id: str = "article_id", published: str = "published_at",
) -> DataFrame:
    """Every item, with whether it is stored already and the lowest matching stored id."""
    known = with_key(stored, published).groupBy(*KEY).agg(F.min(stored_id).alias("duplicate_id"))
    return attach_by_key(with_key(items, published), known, KEY, item_id).select(
        *items.columns, F.col("duplicate_id").isNotNull().alias("is_duplicate"), "duplicate_id"
    )


def new_items(
    items: DataFrame, stored: DataFrame, item_id: str = "item_id", published: str = "published_at",
    compat: bool = False,
) -> DataFrame:
    """Items not stored yet; within the batch the first of a key wins.

    ``compat`` checks against the stored articles only and keeps in-batch copies.
    """
    if compat:
        return duplicate_of(items, stored.withColumn("_id", F.lit(0)), item_id, "_id", published).where(
            ~F.col("is_duplicate")
        ).select(*items.columns)
    firsts = with_key(items, published).groupBy(*KEY).agg(F.min(item_id).alias(item_id))
    known = with_key(stored, published).select(*KEY).distinct()
    fresh = firsts.join(known, KEY, "left_anti").select(item_id)
    return items.join(fresh, item_id, "left_semi").select(*items.columns)


def same_day_candidates(
    items: DataFrame, stored: DataFrame, stored_id: str = "article_id", published: str = "published_at"
) -> DataFrame:
    """Stored articles of a feed and day that an item also has.

    Each stored article comes once; comparing pairs is left to the title key.
    """
    keys = ["_feed", "_day"]
    days = with_key(items, published).select(*keys).distinct()
    keyed = with_key(stored, published)
    found = attach_by_key(keyed, days.withColumn("_found", F.lit(True)), keys, stored_id)
    return found.where("_found").select(*stored.columns)


def own_key(name: str, row_id: str) -> Column:
    """A column as a key in which a null stands for itself, so such rows spread by id instead of meeting."""
    return F.coalesce(F.concat(F.lit("="), name), F.concat(F.lit("#"), F.col(row_id).cast("string")))


def unique_links(items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """First item of every link, then of every guid; a null link or guid matches no other."""
    by_link = keep_first(items.withColumn("_link", own_key("link", item_id)), ["_link"], item_id)
    by_guid = by_link.withColumn("_guid", own_key("guid", item_id))
    return keep_first(by_guid, ["_guid"], item_id).select(*items.columns)


def duplicate_pairs(marked: DataFrame, article_id: str = "article_id") -> DataFrame:
    """Each duplicate beside its original, one row per duplicate."""
    originals = marked.select(
        F.col(article_id).alias("duplicate_of_id"), F.col("title").alias("original_title"),
        F.col("published_at").alias("original_published_at"),
    )
    copies = marked.where("is_duplicate").select(article_id, "title", "published_at", "duplicate_of_id")
    return attach_by_key(copies, originals, ["duplicate_of_id"], article_id)
