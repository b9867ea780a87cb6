"""Operator 13: quality rules judged by host, with column functions only.

Each document is measured natively (``text_stats``). Its rule failures are counted by host; a host's
failure rate is shrunk towards a beta prior that is fitted to the rates of all hosts by their moments:
``(failed + a) / (n + a + b)``. So a host with few documents is judged by what is usual, one with many by
its own. Hosts whose shrunk rate is over ``HOST_LIMIT`` are rejected, and the verdict is joined back to
their documents. A document is kept if it passes the base rules and its host is not rejected.

The host is ``source`` in lower case; of a URL, its host without "www.". Documents are
aggregated by host map-side, and the way back splits a hot host by the document ids.

Words are compared by 64-bit hashes inside one text: two different windows of a text of n words
are confused with a chance of about n²/2⁶⁵.

Edge cases: a null text is empty and fails the base rules; a null or empty source is no host, so
nothing but the base rules counts; where the rates of the hosts differ by no more than
chance makes them (one host included), every host has the mean rate; repeated rows count once each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import ASCII_SPACE, ASCII_SPACE_RUN
from newsloom.llm.arrays import text_of, written
from newsloom.operators.matching import attach_by_key

WINDOW = 5
SYMBOLS = "#*$%&|<>"
HOST_LIMIT = 0.5
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null."""
    bare = F.btrim(text, F.lit(ASCII_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, ASCII_SPACE_RUN))


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """How many words lie in windows of ``size`` words that the array holds twice or more."""
    def windows(hashes: Column) -> Column:
        each = F.sequence(F.lit(0), F.size(hashes) - size)
        return F.transform(each, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))

    def covered(names: Column) -> Column:
        placed = F.sort_array(F.transform(names, lambda name, at: F.struct(name.alias("name"), at.alias("at"))))
        name = lambda z, i: F.get(z, i)["name"]
        twice = lambda z: F.transform(
            F.sequence(F.lit(0), F.size(z) - 1),
            lambda i: F.when((name(z, i) == name(z, i - 1)) | (name(z, i) == name(z, i + 1)), F.get(z, i)["at"]),
        )
        starts = F.sort_array(F.filter(let(placed, twice), lambda at: at.isNotNull()))
        # a window adds the words up to the next repeated one, the last one all of its words
        lengths = lambda s: F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.least(F.lit(size), F.coalesce(b - a, F.lit(size))))
        return F.aggregate(let(starts, lengths), F.lit(0), lambda total, n: total + n)

    # texts without a repeated window, most of them, need no sorting
    found = lambda names: F.when(F.size(F.array_distinct(names)) == F.size(names), 0).otherwise(covered(names))
    counted = lambda hashes: F.when(F.size(hashes) <= size, 0).otherwise(let(windows(hashes), found))
    return let(F.transform(words, lambda w: F.xxhash64(w)), counted)


def text_stats(text: Column) -> Column:
    """The base counts of a text as one struct, with ``n_lines``, the lines that hold a word."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(ASCII_SPACE)) != "")
    counted = let(words_of(text), lambda w: F.struct(
        F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("repeated"),
    ))
    lined = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("copies")))
    parts = let(F.struct(counted.alias("words"), lined.alias("lines")), lambda s: F.struct(
        s["words"]["n"].cast("long").alias("n_words"),
        s["words"]["chars"].cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        s["lines"]["copies"].cast("long").alias("n_dup_lines"),
        s["words"]["repeated"].cast("long").alias("n_repeat_words"),
        s["lines"]["n"].cast("long").alias("n_lines"),
    ))
    return parts


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_failed() -> Column:
    """Whether a document fails any rule: the base rules, word length, symbols or repeated lines."""
    length = (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 10 * F.col("n_words"))
    symbols = 10 * F.col("n_symbols") > F.col("n_words")
    lines = 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")
    return base_failed() | length | symbols | lines


def host_of(source: Column) -> Column:
    """The host of a source or URL; null where there is none."""
    name = F.lower(F.btrim(source.cast("string")))
    found = F.regexp_replace(name, "^[a-z][a-z0-9+.-]*://", "")
    found = F.regexp_replace(F.regexp_replace(found, "[/?#].*$", ""), "^(?:[^@]*@)?(?:www\\.)?|:[0-9]+$", "")
    return F.nullif(found, F.lit(""))


def host_verdicts(stats: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, n, failed, rate (shrunk) and rejected; ``stats`` has host and failed."""
    hosts = stats.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failed"),
    )
    # moments of the hosts' rates; what chance alone makes of the variance is taken off
    rate = F.col("failed") / F.col("n")
    moments = hosts.agg(F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"), F.avg(1 / F.col("n")).alias("noise"))
    inside = F.col("mean") * (1 - F.col("mean"))
    excess = F.col("spread") - inside * F.col("noise")
    prior = moments.select("mean", F.when((excess > 0) & (inside > F.col("spread")), (inside - F.col("spread")) / excess).alias("weight"))
    mean, weight = prior.select("mean").scalar(), prior.select("weight").scalar()
    shrunk = F.when(weight.isNull(), mean).otherwise((F.col("failed") + mean * weight) / (F.col("n") + weight))
    return hosts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") > limit)


def judged(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, the counts, base_failed, host, rejected (of the host) and kept, one row per document."""
    measured = docs.select("doc_id", host_of(F.col("source")).alias("host"), text_stats(text_of()).alias("s"))
    stats = measured.select("doc_id", "host", "s.*").withColumns({"base_failed": base_failed(), "failed": rule_failed()})
    stats = written(stats, docs.sparkSession, "stats")
    verdicts = host_verdicts(stats, limit).select("host", "rejected")
    found = attach_by_key(stats, verdicts, ["host"], "doc_id").withColumn("rejected", F.coalesce("rejected", F.lit(False)))
    return found.select("doc_id", *STATS, "base_failed", "host", "rejected", (~F.col("base_failed") & ~F.col("rejected")).alias("kept"))


def host_report(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The documents' verdicts without the hosts."""
    return judged(docs, limit).drop("host", "rejected")
