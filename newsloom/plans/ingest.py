"""The ingest cycle: parsed feed items to stored articles and one log row per feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from newsloom import schemas
from newsloom.functions import text as T
from newsloom.functions.dates import elapsed_ms, parse_date
from newsloom.functions.html import (
    absolute_link, article_of, html_text, is_plain, without_noise,
)
from newsloom.functions.python_udfs import find_body_html, sanitize_html
from newsloom.operators import history, quality
from newsloom.operators.dedup import KEY, with_key
from newsloom.operators.matching import attach_by_key
from newsloom.operators.numbering import assign_ids
from newsloom.session import ensure_checkpoint_dir
from newsloom.sources.parts import FAN, Parts, Table

MIN_BODY = 50
# Fixed value: the message of a feed without items.
EMPTY_FEED = "Failed to fetch feed"


def active_feeds(feeds: DataFrame) -> DataFrame:
    return feeds.where("is_active")


def parse_items(items: DataFrame) -> DataFrame:
    """Feed items with trimmed text, parsed date and numeric comment count."""
    return items.withColumns({
        **{n: T.blank_to_null(F.col(n)) for n in ("title", "link", "description", "guid", "author")},
        "published_date": parse_date(T.blank_to_null(F.col("pub_date"))),
        "comment_count": T.comment_count(F.col("comments")),
    }).drop("pub_date", "comments")


def to_articles(valid: DataFrame) -> DataFrame:
    """Article records of valid items."""
    slug = F.nullif(T.create_slug(F.col("title")), F.lit(""))
    return valid.withColumns({
        "slug": F.coalesce(slug, T.link_tail(F.col("link"))),
        "content_html": F.coalesce(F.col("description"), F.lit("")),
        "description": T.truncate_text(T.strip_html(F.col("description"))),
    })


def extract_bodies(pages: DataFrame, sanitized: bool = False) -> DataFrame:
    """``pages`` with the main element in ``main_html``; null where there is none.

    Pages with one plain article stay native. Only the text of the others goes to a
    parser, in Arrow batches. Sanitising needs the parser for all pages.
    """
    # one step a column: each is used more than once, so Spark computes it once and keeps it
    found = pages.withColumn("_clean", without_noise(F.col("html"))).withColumn("_found", article_of(F.col("_clean")))
    found = found.withColumn("_article", F.when(is_plain(F.col("_clean"), F.col("_found")), F.col("_found")))
    rest = F.when(F.col("_article").isNull(), F.col("html"))
    found = found.withColumn("main_html", F.coalesce("_article", find_body_html(rest))).drop("_clean", "_found", "_article")
    if sanitized:
        found = found.withColumn("main_html", sanitize_html("main_html", "url"))
    return found


def page_text(pages: DataFrame, whole_references: bool = False) -> DataFrame:
    """``pages`` with the plain text of the main element in ``page_text``.

    ``whole_references`` leaves references that end without a semicolon as they stand.
    """
    return extract_bodies(pages).withColumn("page_text", html_text(F.col("main_html"), whole_references)).drop("main_html")


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page, in page order, as an absolute url."""
    anchors = F.regexp_extract_all(
        without_noise(F.col("html")), F.lit(r"""(?i)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), 1
    )
    found = pages.select("page_id", "url", F.posexplode(anchors).alias("position", "_quoted"))
    link = T.decode_entities(F.btrim("_quoted", F.lit("\"' ")))
    return found.select("page_id", "position", absolute_link(link, F.col("url")).alias("link"))


def substantial(body: str) -> Column:
    return F.length(T.trim_space(F.col(body))) > MIN_BODY


def with_crawled_body(items: DataFrame, crawled: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Replace the feed's description by the crawled body of the same link, if it has one.

    The body is sanitised HTML, and its length counts with its tags. ``crawled`` holds ``url, content``; when a url was landed twice the longest body counts.
    """
    # The rule sits in the order of the aggregate, which skips nulls. As a filter it
    # would be pushed down to the pages and extract every body a second time.
    order = F.when(substantial("content"), F.struct(F.length("content"), "content"))
    bodies = crawled.groupBy(F.col("url").alias("link")).agg(F.max_by("content", order).alias("_body"))
    joined = attach_by_key(items, bodies, ["link"], item_id)
    return joined.select(*[
        F.coalesce("_body", "content_html").alias("content_html") if n == "content_html" else F.col(n)
        for n in items.columns
    ])


def narrow_items(items: DataFrame, feeds: DataFrame, compat: bool = False) -> DataFrame:
    """item_id, feed_source_id, category_id, ``valid`` and the digests of its three keys, for the items of active feeds.

    All that accepting and counting need, so that the texts are parsed once for both.
    """
    active = active_feeds(feeds).select(F.col("id").alias("feed_source_id"), "category_id")
    parsed = with_key(parse_items(items).join(active, "feed_source_id"), "published_date")
    return parsed.select("item_id", "feed_source_id", "category_id", *_checked(compat))


def stored_items(items: DataFrame, compat: bool = False) -> DataFrame:
    """item_id and the digests of the valid ones among raw items that count as stored.

    The items are checkpointed as parsed: a filter on parsed columns would move below the shuffle that
    deals out the texts, and parse them there a second time, for every reader.
    """
    ensure_checkpoint_dir(items.sparkSession)
    parsed = with_key(parse_items(items), "published_date")
    return parsed.select("item_id", *_checked(compat)).checkpoint().where("valid").drop("valid")


def _checked(compat: bool) -> list[Column]:
    """``valid`` and the digests of parsed items."""
    return [quality.reject_reason(compat).isNull().alias("valid"), *_digests()]


def _digests() -> list[Column]:
    """The digests of the title key, the link and the guid; rows come from ``with_key``."""
    return [
        history.digest("title", *map(F.col, KEY)).alias("title_key"), history.digest("link", F.col("link")).alias("link_key"),
        history.digest("guid", F.col("guid")).alias("guid_key"),
    ]


ITEM_KEYS = ["title_key", "link_key", "guid_key"]


def all_digests(rows: DataFrame) -> DataFrame:
    """The three digests of each row as rows, without nulls."""
    return rows.select(F.explode(F.array(*ITEM_KEYS)).alias("digest")).where("digest is not null")


def stored_digests(stored: DataFrame) -> DataFrame:
    return all_digests(with_key(stored, "published_date").select(*_digests()))


def decide(narrow: DataFrame, known: DataFrame) -> DataFrame:
    """item_id, feed_source_id and ``outcome``: dropped, duplicate or saved.

    Saved is the first of each (feed, day, title), then of each link, then of each guid, where a key whose
    digest is in ``known`` counts as taken. Each level is one hash aggregation of digests and ids, so copies of one
    article collapse map-side. A missing link or guid stands for itself.
    """
    left = narrow.where("valid").select("item_id", *ITEM_KEYS)
    for name in ITEM_KEYS:
        own = F.coalesce(name, F.col("item_id").cast("string").cast("binary"))
        firsts = left.groupBy(own.alias("digest")).agg(F.min("item_id").alias("item_id"))
        free = firsts.join(known, "digest", "left_anti").select("item_id")
        left = left.join(free, "item_id", "left_semi")
    saved = left.select("item_id", F.lit(True).alias("_saved"))
    outcome = F.when(~F.col("valid"), "dropped").when(F.col("_saved"), "saved").otherwise("duplicate")
    return narrow.join(saved, "item_id", "left").select("item_id", "feed_source_id", outcome.alias("outcome"))


OUTCOMES = ("saved", "duplicate", "dropped")


def cycle_stats(decided: DataFrame) -> DataFrame:
    """Counts of each outcome by feed and over all (``feed_source_id`` null), in one pass."""
    counts = [F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]
    return decided.rollup("feed_source_id").agg(*counts, F.grouping("feed_source_id").alias("whole"))


@dataclass
class Cycle:
    articles: DataFrame
    log: DataFrame
    feeds: DataFrame
    narrow: DataFrame
    decided: DataFrame
    metrics: dict


def checked_items(
    items: DataFrame, feeds: DataFrame, known: Callable[[DataFrame], DataFrame], compat: bool = False,
) -> tuple[DataFrame, DataFrame, dict]:
    """The narrow items, what becomes of each, and the totals of all outcomes.

    All are checkpointed, the known digests too: articles, log and index must agree on them, and none then
    repeats the parsing or the joins. The totals are observed while the outcomes are stored.
    """
    ensure_checkpoint_dir(items.sparkSession)
    narrow, seen = narrow_items(items, feeds, compat).checkpoint(), Observation("cycle")
    decided = decide(narrow, known(narrow).checkpoint())
    decided = decided.observe(seen, *[F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES]).checkpoint()
    return narrow, decided, seen.get


def ingest_cycle(
    items: DataFrame, feeds: DataFrame, stored: DataFrame | None, crawled: DataFrame, now: datetime,
    *, compat: bool = False, known: Callable[[DataFrame], DataFrame] | None = None, last: int | DataFrame | None = None,
) -> Cycle:
    """New articles with ids, the log and the updated feeds of one cycle.

    What is stored comes as a table, or as ``known``, which gives those digests of the narrow items that are
    stored, and the ``last`` id, a number or a one-row frame. Numbers are given to the ids alone, so no text is
    sorted, and only the items that are saved are parsed whole.
    """
    narrow, decided, metrics = checked_items(items, feeds, known or (lambda _: stored_digests(stored)), compat)
    accepted = decided.where("outcome = 'saved'").select("item_id")
    start = stored.agg(F.max("id")) if last is None else last
    numbers = assign_ids(accepted, ["item_id"], start=start)
    category = narrow.select("item_id", "category_id")
    parsed = parse_items(items.join(numbers.join(category, "item_id"), "item_id"))
    own = ["id", "category_id"]
    articles = to_articles(parsed.select(*[c for c in parsed.columns if c not in own], *own))
    articles = quality.apply_defaults(with_crawled_body(articles, crawled), now).drop("item_id")
    log = ingestion_log(cycle_stats(decided), feeds, now)
    return Cycle(articles, log, update_last_fetched(feeds, log, now), narrow, decided, metrics)


def store_of(spark: SparkSession, base: str, feeds: DataFrame, fan: int = FAN) -> Parts:
    """The tables of a store: articles, logs, feeds as they are, unreadable records, and the index of stored keys."""
    cycle = StructField("cycle_id", LongType())
    return Parts(spark, base, history.TABLES | {
        "articles": Table(schemas.ARTICLE), "logs": Table(StructType([*schemas.INGESTION_LOG.fields, cycle])),
        "feeds": Table(feeds.schema, replaced=True), "rejects": Table(schemas.REJECTED),
    }, fan)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def store_cycle(
    store: Parts, items: DataFrame, feeds: DataFrame, crawled: DataFrame, run: str, cycle_id: int,
    *, clock: Callable[[], datetime] = utc_now, compat: bool = False, rejects: DataFrame | None = None,
) -> dict:
    """Run a cycle against all that is stored and commit it; gives the totals of its outcomes.

    Articles, log, feeds, index and ``rejects`` (records that could not be read) are written one after the other
    and become visible together. A cycle that
    was committed before is not run again. ``feeds`` count until a cycle has stored them. Only buckets of
    the index are read that hold a key of the items. Log ids hold the number of the commit and the feed.
    """
    started, version = clock(), store.version()
    if store.done(run, cycle_id, version):
        return {}
    if any(p.table == "feeds" for p in version.parts):
        feeds = store.read("feeds", version)
    known = lambda narrow: history.known_digests(all_digests(narrow.where("valid")), store, version)
    cycle = ingest_cycle(items, feeds, None, crawled, started, compat=compat, known=known, last=version.last)
    name = f"{run}-{cycle_id}"
    parts = [store.write("articles", cycle.articles, name)]
    saved = cycle.narrow.join(cycle.decided.where("outcome = 'saved'").select("item_id"), "item_id", "left_semi")
    parts += [store.write(table, rows, name) for table, rows in history.index_tables(all_digests(saved)).items()]
    if rejects is not None:
        parts.append(store.write("rejects", rejects.withColumn("cycle_id", F.lit(cycle_id)), name))
    completed, number = clock(), version.number + 1
    log = ingestion_log(cycle_stats(cycle.decided), feeds, completed, started).withColumns({
        "id": F.shiftleft(F.lit(number).cast("long"), 32) + F.col("feed_source_id"), "cycle_id": F.lit(cycle_id),
    })
    parts += [store.write("logs", log, name), store.write("feeds", cycle.feeds, name)]
    store.publish(run, cycle_id, parts, last=version.last + cycle.metrics["saved"])
    return cycle.metrics


def ingestion_log(stats: DataFrame, feeds: DataFrame, completed: datetime, started: datetime | None = None) -> DataFrame:
    """One row per active feed, from ``cycle_stats``; a feed without items is failed and took no time.

    ``dropped`` are items without title, link or date, which count as neither fetched nor duplicate.
    """
    stamp = lambda at: F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")
    count = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("long")
    got = count("saved") + count("duplicate")
    rows = active_feeds(feeds).select(F.col("id").alias("feed_source_id")).join(stats.where("whole = 0"), "feed_source_id", "left")
    log = rows.select(
        "feed_source_id", F.when(got > 0, "success").otherwise("failed").alias("status"),
        got.alias("articles_fetched"), count("saved").alias("articles_saved"), count("duplicate").alias("duplicates_found"),
        count("dropped").alias("dropped"), F.when(got == 0, EMPTY_FEED).alias("error_message"), stamp(completed).alias("completed_at"),
    )
    if started is None:
        return log
    took = F.when(F.col("status") == "success", elapsed_ms(stamp(started), F.col("completed_at"))).otherwise(0)
    return log.withColumns({"started_at": stamp(started), "execution_time_ms": took.cast("long")})


def cycle_totals(stats: DataFrame) -> DataFrame:
    """The totals of a cycle: the row over all feeds of ``cycle_stats``."""
    total = lambda *names: sum(F.coalesce(F.col(n), F.lit(0)) for n in names).cast("long")
    return stats.where("whole = 1").select(
        total("saved", "duplicate").alias("total_fetched"), total("saved").alias("total_saved"),
        total("duplicate").alias("total_found"), total("dropped").alias("total_dropped"),
    )


def update_last_fetched(feeds: DataFrame, log: DataFrame, now: datetime) -> DataFrame:
    """Feeds with ``last_fetched_at`` moved to ``now`` where the cycle succeeded."""
    done = log.where("status = 'success'").select(
        F.col("feed_source_id").alias("id"), F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz").alias("_now")
    )
    return feeds.join(done, "id", "left").select(*[
        F.coalesce("_now", "last_fetched_at").alias(n) if n == "last_fetched_at" else F.col(n)
        for n in feeds.columns
    ])
