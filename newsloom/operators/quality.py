"""Row rules: required fields, defaults and width limits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column widths of the tables, and the required columns of articles.
WIDTHS = {"title": 500, "slug": 500, "link": 500, "guid": 500, "author": 255}
LOG_WIDTHS = {"status": 20}
FEED_WIDTHS = {"name": 100, "url": 500}
CATEGORY_WIDTHS = {"name": 50, "slug": 50}
RESULT_WIDTHS = {"ngay": 8, "nguon": 100, "chu_de": 100, "tu_khoa": 255}
REQUIRED = ("title", "slug", "link", "published_date")


def reject_reason(compat: bool = False) -> Column:
    """Why a parsed item cannot be an article, else null. ``compat`` also needs a description."""
    reason = (
        F.when(F.col("title").isNull(), "missing title")
        .when(F.col("link").isNull(), "missing link")
        .when(F.col("published_date").isNull(), "bad date")
    )
    return reason.when(F.col("description").isNull(), "missing description") if compat else reason


def valid_items(parsed: DataFrame, compat: bool = False) -> DataFrame:
    return parsed.where(reject_reason(compat).isNull())


def quarantine(parsed: DataFrame, compat: bool = False) -> DataFrame:
    """The items that ``valid_items`` drops, with the reason."""
    return parsed.withColumn("reason", reject_reason(compat)).where("reason is not null")


def violations(widths: dict[str, int] = WIDTHS, required: tuple[str, ...] = REQUIRED) -> Column:
    """Broken limits of a row, by default an article, as ``name:rule`` joined by commas; "" where none."""
    too_long = [F.when(F.length(name) > n, F.lit(f"{name}:length")) for name, n in widths.items()]
    missing = [F.when(F.col(name).isNull(), F.lit(f"{name}:null")) for name in required]
    return F.concat_ws(",", *too_long, *missing)


def apply_defaults(articles: DataFrame, now: datetime) -> DataFrame:
    """Fill counters, flags and audit times; ``now`` is one literal for the whole batch."""
    stamp = _stamp(now)
    return _filled(articles, {
        "fetched_date": stamp, "comment_count": F.lit(0), "is_duplicate": F.lit(False),
        "duplicate_of_id": F.lit(None).cast("long"), "created_at": stamp, "updated_at": stamp,
    })


def feed_defaults(feeds: DataFrame, now: datetime) -> DataFrame:
    """New feeds are active."""
    return _filled(feeds, {"is_active": F.lit(True), "created_at": _stamp(now), "updated_at": _stamp(now)})


def log_defaults(logs: DataFrame, now: datetime) -> DataFrame:
    """Counters start at 0, and a log at ``now``."""
    counters = ("articles_fetched", "articles_saved", "duplicates_found")
    return _filled(logs, {n: F.lit(0).cast("long") for n in counters} | {"started_at": _stamp(now)})


def _stamp(now: datetime) -> Column:
    return F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")


def _filled(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    return rows.withColumns({n: F.coalesce(F.col(n), v) if n in rows.columns else v for n, v in defaults.items()})
