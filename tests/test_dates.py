from datetime import datetime
from email.utils import parsedate_to_datetime

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates as D


def run(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def stdlib_rfc(text):
    try:
        return parsedate_to_datetime(text).replace(tzinfo=None)
    except (TypeError, ValueError):
        return None


def stdlib_iso(text):
    try:
        return datetime.fromisoformat(text.replace("Z", "+00:00") if "T" in text else text).replace(tzinfo=None)
    except (TypeError, ValueError):
        return None


RFC = [
    "Tue, 26 May 2026 08:30:00 +0700", "26 May 2026 08:30:00 GMT", "Tue, 26 May 2026 08:30 +0000",
    "26 May 26 08:30:00", "1 Jan 69 00:00:00", "1 Jan 68 00:00:00", "31 Feb 2026 08:30:00", "junk",
    "Sun, 01 Mar 2026 23:59:59 -0500", "Tue, 26 May 2026 25:00:00", "26 december 1999 1:02:03", "2026-05-26",
]
ISO = [
    "2026-05-26T08:00:00Z", "2026-05-26T08:00:00+07:00", "2026-05-26", "20260531", "2026-05-26 08:00:00",
    "2026-05-26T08:00", "2026-05-26T08:00:00.123", "2026-02-30", "2026-05", "2026", "junk", "2026-05-26T24:30:00",
    "20260526T080000", "2026-05-26T08:00:00.123456-03:30", "2026-0526", "Tue, 26 May 2026 08:30:00 +0700",
]


def test_rfc2822_equals_the_standard_library(spark):
    assert run(spark, RFC, D.parse_rfc2822) == [stdlib_rfc(v) for v in RFC]


def test_iso_equals_the_standard_library(spark):
    assert run(spark, ISO, D.parse_iso) == [stdlib_iso(v) for v in ISO]


def test_cascade_and_nulls(spark):
    values = RFC + ISO + [None, ""]
    assert run(spark, values, D.parse_date) == [(v and (stdlib_rfc(v) or stdlib_iso(v))) or None for v in values]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Ho_Chi_Minh"])
def test_session_zone_does_not_matter(spark, zone):
    values = ["Sun, 08 Mar 2026 02:30:00 +0000", "2026-03-08T02:30:00Z"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = run(spark, values, lambda c: F.date_format(D.parse_date(c), "yyyyMMdd HH:mm"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days[1] == days[0]
    assert days[0].startswith("20260308")


def test_format_day(spark):
    values = ["2026-05-26", "20260526", "2026-05-26T23:59:59Z", "junk", None]
    assert run(spark, values, D.format_day) == ["20260526", "20260526", "20260526", None, None]


def test_elapsed_ms(spark):
    df = spark.sql("select timestamp_ntz'2026-01-01 00:00:00' a, timestamp_ntz'2026-01-01 00:00:01.5' b")
    assert df.select(D.elapsed_ms(F.col("a"), F.col("b"))).first()[0] == 1500


def test_week_dates_equal_the_standard_library(spark):
    weeks = [f"{y}{d}W{w:02d}{tail}" for y in (1999, 2004, 2009, 2015, 2020, 2024, 2026) for d in ("", "-") for w in (0, 1, 9, 52, 53, 54)
             for tail in ("", f"{d}1", f"{d}5", f"{d}7", f"{d}0", f"{d}8")]
    weeks += ["2024-W09-5T10:30", "2024W095T103000", "2024-W09T08:00:00Z", "2024-W9-5", "W09", "2024-W09-", "Wed"]
    assert run(spark, weeks, D.parse_iso) == [stdlib_iso(v) for v in weeks]
    assert any(run(spark, weeks, D.parse_iso))


def test_month_first_dates_equal_the_standard_library(spark):
    dates = [f"{day}{month} {d}{comma} {rest}" for day in ("", "Tue, ", "Tue ") for month in ("May", "dec") for d in (1, 26)
             for comma in ("", ",") for rest in ("2026 08:30:00", "2026 08:30:00 +0700", "08:30:00 2026", "2026 8:30")]
    dates += ["May 2026 08:30:00", "Foo 26 2026 08:30:00", "May 32 2026 08:30:00"]
    assert run(spark, dates, D.parse_rfc2822) == [stdlib_rfc(v) for v in dates]
    assert all(run(spark, dates[:-3], D.parse_rfc2822))
