"""Date functions. Offsets are dropped, never converted: results are wall-clock times.

Each parser rewrites the text into the form that a cast to ``timestamp_ntz``
reads, so no step depends on the session time zone. A step refers to the one
before it only once, which keeps the plan small where Spark inlines a parsed
column into filters and keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import let

# English month names, three letters each.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# Put before a rewritten text, to tell it from one that did not match.
MATCHED = "\x01"

# Day, month, year, hour, minute, second; weekday and zone are optional.
RFC2822 = (
    r"(?i)^\s*(?:[a-z]+,?\s+)?(\d{1,2})\s+"
    r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+"
    r"(\d{4}|\d{2})\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\s.*)?$"
)
# Month before day, after a weekday or not; and the year after the time
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
MONTH_FIRST = rf"(?i)^\s*(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?{_MONTH}[a-z]*\s+(\d{{1,2}}),?\s+"
YEAR_LAST = rf"(?i)^(\d{{1,2}} {_MONTH} )(\d{{1,2}}:[\d:]+)\s+(\d{{4}})(?=\s|$)"
# Year, dash, week, day and what follows; the day is Monday where there is none
ISO_WEEK = r"^(\d{4})(-?)W(\d{2})(?:\2(\d))?([T ].*)?$"
# Year, dash, month, day, hour, minute, second; time and zone are optional.
ISO8601 = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2}(?:\.\d+)?))?)?"
    r"(?:Z|[+-]\d{2}(?::?\d{2})?(?::?\d{2})?)?)?$"
)


def _rewritten(text: Column, pattern: str, form: str) -> Column:
    """The text in another form, or "" where the pattern does not match."""
    return F.split_part(F.regexp_replace(text, pattern, MATCHED + form), F.lit(MATCHED), F.lit(2))


def parse_rfc2822(text: Column) -> Column:
    """``[Tue,] 26 May 2026 08:30[:00] [zone]`` as a time without zone, else null.

    The month may come first, and the year last. Two-digit years from 69 are of the last century.
    """
    day_first = F.regexp_replace(F.regexp_replace(text, MONTH_FIRST, "$2 $1 "), YEAR_LAST, "$1$4 $3")
    form = F.lower(_rewritten(day_first, RFC2822, "$3-$2-$1 $4:$5:$6"))
    for number, name in enumerate(MONTHS, 1):
        form = F.replace(form, F.lit(name), F.lit(str(number)))
    form = F.regexp_replace(F.regexp_replace(form, "^(69|[7-9][0-9])-", "19$1-"), "^([0-9]{2})-", "20$1-")
    return F.rtrim(form, F.lit(":")).try_cast("timestamp_ntz")


def _week_as_day(text: Column) -> Column:
    """A week date as year, month and day, null if there is no such week; other texts as they are."""
    def day(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, ISO_WEEK, i)
        year, week = part(1).try_cast("int"), part(3).try_cast("int")
        weekday = F.coalesce(F.nullif(part(4), F.lit("")), F.lit("1")).cast("int")
        fourth = F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))  # is always in week 1
        monday = F.date_add(F.date_sub(fourth, F.weekday(fourth)), 7 * (week - 1))
        exists = (F.weekofyear(monday) == week) & weekday.between(1, 7)
        return F.when(exists, F.concat(F.date_add(monday, weekday - 1).cast("string"), part(5)))

    return F.when(text.rlike("^[0-9]{4}-?W"), let(text, day)).otherwise(text)


def parse_iso(text: Column) -> Column:
    """ISO 8601 date or week date, or one of them and a time, dashed or compact, else null."""
    form = _rewritten(F.translate(_week_as_day(text), ",", "."), ISO8601, "$1-$3-$4 $5:$6:$7")
    return F.rtrim(form, F.lit(" :")).try_cast("timestamp_ntz")


def parse_date(text: Column) -> Column:
    """RFC 2822 first, then ISO 8601."""
    return F.coalesce(parse_rfc2822(text), parse_iso(text))


def format_day(text: Column) -> Column:
    """Date string as ``yyyyMMdd``; null where it is no date."""
    return F.date_format(F.coalesce(text.try_cast("timestamp_ntz"), parse_iso(text)), "yyyyMMdd")


def day_of(stamp: Column) -> Column:
    return F.to_date(stamp)


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", start, end)
