"""Queries over the result table and the ingestion logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def keywords_per_category(table: DataFrame) -> DataFrame:
    return table.groupBy("chu_de").agg(F.count("*").alias("so_luong_tu_khoa"))


def top_keywords(table: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` keywords with the highest totals, ties by keyword."""
    totals = table.groupBy("tu_khoa").agg(F.sum("so_lan_xuat_hien").alias("tong"))
    return totals.orderBy(F.desc("tong"), "tu_khoa").limit(n)


def category_keywords(table: DataFrame) -> DataFrame:
    """Keyword totals per category, highest first inside each."""
    totals = table.groupBy("chu_de", "tu_khoa").agg(F.sum("so_lan_xuat_hien").alias("tong"))
    return totals.orderBy("chu_de", F.desc("tong"), "tu_khoa")


def top_rows(table: DataFrame, n: int = 10) -> DataFrame:
    """The preview of the result: its ``n`` most frequent rows."""
    return table.orderBy(F.desc("so_lan_xuat_hien"), "ngay", "nguon", "chu_de", "tu_khoa").limit(n)


def row_counts(**relations: DataFrame) -> DataFrame:
    """One row per relation with its row count."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
              for name, df in relations.items()]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total


def filter_logs(logs: DataFrame, feed_source_id: int | None = None, status: str | None = None) -> DataFrame:
    """Optional equality filters; 0 and "" mean no filter."""
    if feed_source_id:
        logs = logs.where(F.col("feed_source_id") == feed_source_id)
    if status:
        logs = logs.where(F.col("status") == status)
    return logs


def logs_page(
    logs: DataFrame, limit: int = 50, offset: int = 0,
    feed_source_id: int | None = None, status: str | None = None,
) -> DataFrame:
    """One page of logs, newest first, with the total before paging in ``total``."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be 1 to 1000 and offset 0 or more")
    matching = filter_logs(logs, feed_source_id, status)
    total = matching.agg(F.count("*")).scalar()
    page = matching.orderBy(F.desc("started_at"), F.desc("log_id")).offset(offset).limit(limit)
    return page.withColumn("total", total)


def store_log_pages(logs: DataFrame, path: str) -> None:
    """Logs for paging: range partitioned, newest first, with an index of the rows of every part.

    The index counts a part's rows by feed and status, so a page finds its parts, and the total of any
    filter, without a look at the logs.
    """
    order = [F.desc("started_at"), F.desc("log_id")]
    parts = logs.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    parts.sortWithinPartitions(*order).write.mode("overwrite").partitionBy("part").parquet(f"{path}/logs")
    stored = logs.sparkSession.read.parquet(f"{path}/logs")
    index = stored.groupBy("part", "feed_source_id", "status").agg(F.count("*").alias("n"), F.min("started_at").alias("oldest"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def stored_logs_page(
    spark: SparkSession, path: str, limit: int = 50, offset: int = 0, feed_source_id: int | None = None, status: str | None = None,
    after: tuple | None = None,
) -> DataFrame:
    """A page of ``store_log_pages``, newest first, with the total of the filter in ``total``.

    Only the parts that hold rows of the page are read, however deep it is; there are ``limit`` at most, and
    their numbers come to the driver. ``after`` (started_at, log_id of the last row seen) goes on from there:
    rows that came meanwhile do not move the page.
    """
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be 1 to 1000 and offset 0 or more")
    if offset and after is not None:
        raise ValueError("a page begins at an offset or after a row")
    index, logs = spark.read.parquet(f"{path}/index"), filter_logs(spark.read.parquet(f"{path}/logs"), feed_source_id, status)
    counts = filter_logs(index, feed_source_id, status).groupBy("part").agg(F.sum("n").alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    parts, skipped = [], 0
    if after is not None:
        at, log_id = F.lit(after[0].isoformat(sep=" ")).cast("timestamp_ntz"), F.lit(after[1])
        logs = logs.where((F.col("started_at") < at) | ((F.col("started_at") == at) & (F.col("log_id") < log_id)))
        first = index.where(F.col("oldest") <= at).agg(F.min("part")).first()[0]
        if first is not None:
            parts, counts = [first], counts.where(F.col("part") > first)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    placed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = placed.where((F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)).collect()
    if after is None:
        skipped = min((r.before for r in found), default=0)
    rows = logs.where(F.col("part").isin([*parts, *(r.part for r in found)])).drop("part")
    page = rows.orderBy(F.desc("started_at"), F.desc("log_id")).offset(offset - skipped).limit(limit)
    return page.withColumn("total", total)


def latest_log(logs: DataFrame) -> DataFrame:
    return logs.orderBy(F.desc("started_at"), F.desc("log_id")).limit(1)


def logs_with_feeds(logs: DataFrame, feeds: DataFrame) -> DataFrame:
    """Log rows with the name of their feed; rows without a known feed stay."""
    names = feeds.select(F.col("id").alias("feed_source_id"), F.col("name").alias("feed_name"))
    return logs.join(names, "feed_source_id", "left")


def enrich_articles(articles: DataFrame, feeds: DataFrame, categories: DataFrame) -> DataFrame:
    """Articles with the names of their feed and its category."""
    named = feeds.join(
        categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name")), "category_id"
    ).select(F.col("id").alias("feed_source_id"), F.col("name").alias("feed_name"), "category_id", "category_name")
    return articles.join(named, "feed_source_id")


def resolve_feed_categories(feeds: DataFrame, categories: DataFrame) -> DataFrame:
    """Feeds with the id of their category slug; a feed of an unknown slug is left out."""
    ids = categories.select(F.col("slug").alias("category_slug"), F.col("id").alias("category_id"))
    return feeds.join(ids, "category_slug").drop("category_slug")
