"""News-shaped views over the given tables, in Spark and as the same SQL text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Short function words of the languages in the documents.
STOPWORDS = (
    "and", "are", "be", "by", "das", "de", "der", "des", "die", "du", "el", "en", "es",
    "et", "for", "ich", "in", "is", "it", "la", "las", "le", "les", "los", "mit", "nicht",
    "of", "on", "para", "por", "que", "the", "to", "und", "une", "was", "with",
)
LANGUAGES = {"de": "German", "en": "English", "es": "Spanish", "fr": "French"}
BATCH_TIME = "2024-03-01 00:00:00"
PARTED = "éñüçÄ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _published(title, doc_id):
    days = F.make_dt_interval(F.length(title) % 28, F.lit(0), F.lit(0), (doc_id % 86400).cast("decimal(18,6)"))
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + days


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return articles_of(table(spark, folder, "documents"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The articles for work on whole texts: the given tables are single files of one row group."""
    return articles_of(table(spark, folder, "documents").repartition("doc_id"))


def grouped(news: DataFrame) -> DataFrame:
    """Articles dealt out by day, source and category, so that a word of a group is counted in few tasks.

    Groups that are too large for a task are split by adaptive execution.
    """
    return news.hint("rebalance", "publish_date", "source", "chu_de")


def articles_of(documents: DataFrame) -> DataFrame:
    """Documents as articles: the first line is the title, its length sets the day.

    Every seventh has some letters in two characters, as text from other systems may.
    """
    parted = F.col("text")
    for letter in PARTED:
        parted = F.replace(parted, F.lit(letter), F.lit(unicodedata.normalize("NFD", letter)))
    text = F.when(F.col("doc_id") % 7 == 0, parted).otherwise(F.col("text"))
    documents = documents.withColumn("text", text)
    title = F.substring_index("text", "\n", 1)
    published = _published(title, F.col("doc_id"))
    return documents.select(
        F.col("doc_id").alias("article_id"), title.alias("title"), F.col("text").alias("content"),
        "source", F.col("lang").alias("category"), F.col("lang").alias("chu_de"),
        F.expr("substring(source, 4)").cast("int").alias("feed_source_id"),
        published.alias("published_at"), F.date_format(published, "yyyy-MM-dd").alias("publish_date"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return items_of(articles(spark, folder))


def items_of(news: DataFrame) -> DataFrame:
    """The articles as raw feed items, with date strings in several forms.

    Some titles hold no-break spaces, some descriptions entities by number and name, and some
    items have no link.
    """
    at, doc = F.col("published_at"), F.col("article_id")
    forms = "E, d MMM yyyy HH:mm:ss +0700|yyyy-MM-dd'T'HH:mm:ss'Z'|yyyyMMdd|yyyy-MM-dd"
    form = F.split_part(F.date_format(at, forms), F.lit("|"), (doc % 4 + 1).cast("int"))
    dates = F.when(doc % 50 == 49, "not a date").otherwise(form)
    body = F.concat(F.lit('<p class="lead">'), F.replace("content", F.lit("\n"), F.lit("<br/>")), F.lit("</p>"))
    title = F.when(doc % 9 == 4, F.concat(F.lit("\u3000"), F.replace("title", F.lit(" "), F.lit("\xa0 ")))).otherwise(F.col("title"))
    body = F.when(doc % 8 == 5, F.concat(F.lit("Vi&#7879;t&nbsp;&agrave; &amp;lt; "), body)).otherwise(body)
    link = F.concat(F.lit("https://example.com/"), "source", F.lit("/"), F.md5("title"))
    return news.select(
        doc.alias("item_id"), "feed_source_id", title.alias("title"),
        F.when(doc % 31 != 30, link).alias("link"),
        F.when(doc % 17 != 0, body).alias("description"),
        F.when(doc % 3 != 0, F.md5("content")).alias("guid"),
        F.concat(F.lit(" Desk "), "category").alias("author"),
        dates.alias("pub_date"),
        F.when(doc % 13 == 0, None).when(doc % 11 == 0, "n/a").otherwise((doc % 7).cast("string")).alias("comments"),
    )


def categories(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("r_name")
    return table(spark, folder, "region").select(
        F.col("r_regionkey").alias("id"), name.alias("name"), F.lower(F.replace(name, F.lit(" "), F.lit("-"))).alias("slug"),
    )


def feeds(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        key.alias("id"), F.col("n_name").alias("name"),
        F.concat(F.lit("https://example.com/rss/"), F.lower("n_name")).alias("url"),
        F.col("n_regionkey").alias("category_id"), (key % 5 != 0).alias("is_active"),
        F.when(key % 2 == 0, F.lit("2024-02-01 00:00:00")).cast("timestamp_ntz").alias("last_fetched_at"),
    )


def logs(spark: SparkSession, folder: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    ms = F.round(F.col("value") * 1000).cast("long")
    got = F.floor("value").cast("long")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("log_id"), (F.col("user_id") % 25).cast("int").alias("feed_source_id"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.lit(0)).otherwise(got).cast("long").alias("articles_fetched"),
        F.when(failed, F.lit("Failed to fetch feed")).alias("error_message"),
        F.col("ts").alias("started_at"),
        F.timestamp_add("MILLISECOND", ms, F.col("ts")).alias("completed_at"),
    )


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").repartition("page_id")


def is_stored(rows: DataFrame, spark: SparkSession, folder: str, row_id: str) -> DataFrame:
    """The rows whose document has a label: these count as stored already."""
    known = table(spark, folder, "labels").select(F.col("doc_id").alias(row_id))
    return rows.join(known, row_id, "left_semi")


# The same views as SQL. Each names the views it is built on.
SQL_VIEWS = {
    "articles": ((), """
        WITH documents AS (SELECT * REPLACE (CASE WHEN doc_id % 7 = 0
            THEN replace(replace(replace(replace(replace(text, 'é', 'e' || chr(769)), 'ñ', 'n' || chr(771)), 'ü', 'u' || chr(776)),
                 'ç', 'c' || chr(807)), 'Ä', 'A' || chr(776)) ELSE text END AS text) FROM documents)
        SELECT doc_id AS article_id, split_part(text, chr(10), 1) AS title, text AS content, source,
               lang AS category, lang AS chu_de, CAST(substr(source, 4) AS INTEGER) AS feed_source_id,
               TIMESTAMP '2024-01-01 00:00:00'
                 + to_days(CAST(length(split_part(text, chr(10), 1)) % 28 AS INTEGER))
                 + to_seconds(CAST(doc_id % 86400 AS INTEGER)) AS published_at,
               strftime(TIMESTAMP '2024-01-01 00:00:00'
                 + to_days(CAST(length(split_part(text, chr(10), 1)) % 28 AS INTEGER))
                 + to_seconds(CAST(doc_id % 86400 AS INTEGER)), '%Y-%m-%d') AS publish_date
        FROM documents"""),
    "items": (("articles",), """
        SELECT article_id AS item_id, feed_source_id,
               CASE WHEN article_id % 9 = 4 THEN chr(12288) || replace(title, ' ', chr(160) || ' ')
                    ELSE title END AS title,
               CASE WHEN article_id % 31 <> 30
                    THEN 'https://example.com/' || source || '/' || md5(articles.title) END AS link,
               CASE WHEN article_id % 17 <> 0
                    THEN CASE WHEN article_id % 8 = 5 THEN 'Vi&#7879;t&nbsp;&agrave; &amp;lt; ' ELSE '' END || '<p class="lead">' || replace(content, chr(10), '<br/>') || '</p>' END AS description,
               CASE WHEN article_id % 3 <> 0 THEN md5(content) END AS guid,
               ' Desk ' || category AS author,
               CASE WHEN article_id % 50 = 49 THEN 'not a date'
                    WHEN article_id % 4 = 0 THEN strftime(published_at, '%a, %-d %b %Y %H:%M:%S') || ' +0700'
                    WHEN article_id % 4 = 1 THEN strftime(published_at, '%Y-%m-%dT%H:%M:%S') || 'Z'
                    WHEN article_id % 4 = 2 THEN strftime(published_at, '%Y%m%d')
                    ELSE strftime(published_at, '%Y-%m-%d') END AS pub_date,
               CASE WHEN article_id % 13 = 0 THEN NULL WHEN article_id % 11 = 0 THEN 'n/a'
                    ELSE CAST(article_id % 7 AS VARCHAR) END AS comments
        FROM articles"""),
    "dated": (("items",), """
        SELECT *, try_strptime(regexp_extract(pub_date, '^[A-Za-z]+, ([0-9]+ [A-Za-z]+ [0-9]+ [0-9:]+)', 1),
                               '%d %b %Y %H:%M:%S') AS rfc,
               coalesce(try_strptime(pub_date, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(pub_date, '%Y%m%d'),
                        try_strptime(pub_date, '%Y-%m-%d')) AS iso
        FROM items"""),
    "parsed": (("dated",), f"""
        SELECT item_id, feed_source_id, nullif(trim(title, chr(12288) || chr(160) || E' \\n\\t\\r'), '') AS title, link,
               nullif(trim(description, E' \\n\\t\\r'), '') AS description, guid, trim(author) AS author,
               coalesce(rfc, iso) AS published_date, coalesce(TRY_CAST(comments AS INTEGER), 0) AS comment_count
        FROM dated"""),
    "categories": ((), """
        SELECT r_regionkey AS id, r_name AS name, lower(replace(r_name, ' ', '-')) AS slug FROM region"""),
    "feeds": ((), """
        SELECT n_nationkey AS id, n_name AS name, 'https://example.com/rss/' || lower(n_name) AS url,
               n_regionkey AS category_id, n_nationkey % 5 <> 0 AS is_active,
               CASE WHEN n_nationkey % 2 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' END AS last_fetched_at
        FROM nation"""),
    "logs": ((), """
        SELECT event_id AS log_id, CAST(user_id % 25 AS INTEGER) AS feed_source_id,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
               CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS articles_fetched,
               CASE WHEN event_type = 'error' THEN 'Failed to fetch feed' END AS error_message,
               ts AS started_at, ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) AS completed_at
        FROM events"""),
}


def with_views(body: str, *names: str) -> str:
    """A query with the views it needs as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in SQL_VIEWS[name][0]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    views = ",\n".join(f"{name} AS ({SQL_VIEWS[name][1]})" for name in ordered)
    if not views:
        return body
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {views},\n{body.lstrip()[5:]}"
    return f"WITH {views}\n{body}"
