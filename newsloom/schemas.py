"""Schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


RAW_ARTICLE = T.StructType(_strings("publish_date", "source", "title", "content"))

RAW_ARTICLE_ARRAY = T.StructType(_strings(
    "id", "title", "content", "source", "category", "publish_date", "url", "author", "created_at",
))

RSS_ITEM = T.StructType(_strings(
    "title", "link", "description", "guid", "pubDate", "author", "slash:comments",
))

CATEGORY = T.StructType([
    T.StructField("id", T.IntegerType()), *_strings("name", "slug"),
    T.StructField("created_at", T.TimestampNTZType()),
])

FEED = T.StructType([
    T.StructField("id", T.IntegerType()), *_strings("name", "url"),
    T.StructField("category_id", T.IntegerType()), T.StructField("is_active", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("last_fetched_at", T.TimestampNTZType()),
])

ARTICLE = T.StructType([
    T.StructField("id", T.LongType()),
    *_strings("title", "slug", "description", "content_html", "link", "guid", "author"),
    T.StructField("published_date", T.TimestampNTZType()),
    T.StructField("fetched_date", T.TimestampNTZType()),
    T.StructField("feed_source_id", T.IntegerType()), T.StructField("category_id", T.IntegerType()),
    T.StructField("comment_count", T.IntegerType()), T.StructField("is_duplicate", T.BooleanType()),
    T.StructField("duplicate_of_id", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType()),
])

INGESTION_LOG = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("feed_source_id", T.IntegerType()),
    *_strings("status"),
    T.StructField("articles_fetched", T.LongType()), T.StructField("articles_saved", T.LongType()),
    T.StructField("duplicates_found", T.LongType()), T.StructField("dropped", T.LongType()), *_strings("error_message"),
    T.StructField("execution_time_ms", T.LongType()),
    T.StructField("started_at", T.TimestampNTZType()), T.StructField("completed_at", T.TimestampNTZType()),
])

TRENDING = T.StructType([
    *_strings("ngay", "nguon", "chu_de"),
    T.StructField("tu_khoa", T.StringType(), nullable=False),
    T.StructField("so_lan_xuat_hien", T.LongType(), nullable=False),
])

REJECTED = T.StructType([
    T.StructField("feed_source_id", T.IntegerType()), *_strings("path", "record"), T.StructField("cycle_id", T.LongType()),
])
