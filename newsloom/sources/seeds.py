"""Seed rows of the two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.plans.serving import resolve_feed_categories

# The seed categories and feeds.
CATEGORIES = (
    (1, "Giải Trí", "giai-tri"),
    (2, "Công Nghệ", "cong-nghe"),
    (3, "Sức Khỏe", "suc-khoe"),
)
FEEDS = (
    (1, "Vietnamnet - Giải Trí", "https://vietnamnet.vn/rss/giai-tri.rss", "giai-tri"),
    (2, "Thanh Niên - Giải Trí", "https://thanhnien.vn/rss/giai-tri.rss", "giai-tri"),
    (3, "Tuổi Trẻ - Giải Trí", "https://tuoitre.vn/rss/giai-tri.rss", "giai-tri"),
    (4, "Vietnamnet - Công Nghệ", "https://vietnamnet.vn/rss/cong-nghe.rss", "cong-nghe"),
    (5, "Thanh Niên - Công Nghệ", "https://thanhnien.vn/rss/cong-nghe.rss", "cong-nghe"),
    (6, "Tuổi Trẻ - Nhịp Sống Số", "https://tuoitre.vn/rss/nhip-song-so.rss", "cong-nghe"),
    (7, "Vietnamnet - Sức Khỏe", "https://vietnamnet.vn/rss/suc-khoe.rss", "suc-khoe"),
    (8, "Thanh Niên - Sức Khỏe", "https://thanhnien.vn/rss/suc-khoe.rss", "suc-khoe"),
    (9, "Tuổi Trẻ - Sức Khỏe", "https://tuoitre.vn/rss/suc-khoe.rss", "suc-khoe"),
)


def seed_categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "id int, name string, slug string")


def seed_feeds(spark: SparkSession) -> DataFrame:
    raw = spark.createDataFrame(FEEDS, "id int, name string, url string, category_slug string")
    return resolve_feed_categories(raw, seed_categories(spark)).withColumns({
        "is_active": F.lit(True), "last_fetched_at": F.lit(None).cast("timestamp_ntz"),
    })
