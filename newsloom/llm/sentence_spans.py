"""Operator 6: substring dedup by sliding spans of sentences.

A sentence ends at a line break or at ``.``, ``!`` or ``?`` before white space. Every run of three
sentences of a document, and every run of two with at least ``PAIR_WORDS`` words, is hashed by its
lowered words, if it has ``SPAN_WORDS`` words or more.
With ``clauses`` any passage of 51 words is found as well, also inside one sentence: sentences are
parted into clauses, which begin at the word with the smallest hash of every ``WINDOW`` words in a row
(the last, if several), so the places depend on these words alone and a clause has at most ``WINDOW``
words. From each clause on, and back from the end of each sentence, the shortest run of clauses with
``PAIR_WORDS`` words or more is hashed.
The first 6 and the last 6 words of a passage may part differently by what stands around; of
the 39 between, one of the first 7 begins a clause, and its run has at most 30 words.

Runs are joined globally on the hash; the first occurrence, in the order of document id and
place, stays, and all bytes covered by a later one are removed.

Only hashes are counted first; the join back carries the repeated runs alone. The counting is
pre-aggregated and the join is on the hash, which Spark splits where a passage is hot.

Edge cases: a null or empty text has no sentences; sentences without words part nothing and
are kept; a sentence counts as removed if all of it is; runs that overlap inside one
document repeat each other; repeated rows of one id and text keep their first occurrences
alike; null ids come first; an empty table gives no rows; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import Rolling, Words, map_batches, mix, ranges, text_of, utf8, written

SPAN = 3
PAIR_WORDS = 24
SPAN_WORDS = 8
WINDOW = 7
STOPS = np.zeros(256, bool)
STOPS[[33, 46, 63]] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def sentence_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places where sentences begin: at texts, after line breaks, at white space after a stop."""
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets[:-1]] = True
    begins[1:][data == 10] = True
    begins[1:-1] |= STOPS[data[:-1]] & SPACE[data[1:]]
    return np.flatnonzero(begins[: len(data)])


def clause_starts(words: Words) -> np.ndarray:
    """The words with the smallest hash of some ``WINDOW`` words of one text."""
    n = len(words.hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    order = mix(words.hashes)
    least, place = order[WINDOW - 1 :].copy(), np.full(n, WINDOW - 1)
    for k in range(WINDOW - 2, -1, -1):
        smaller = order[k : k + n] < least
        least[smaller], place[smaller] = order[k : k + n][smaller], k
    first = ranges(words.rows[:-1], np.maximum(np.diff(words.rows) - WINDOW + 1, 0))
    return np.unique(first + place[first])


def spans(column: pa.Array, clauses: bool = False) -> tuple[np.ndarray, ...]:
    """Row, first byte, end and hash of every run; bytes count from 0 in each row."""
    data, offsets = utf8(column)
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, none, none.astype(np.uint64)
    starts = sentence_starts(data, offsets)
    words = Words(data, offsets)
    at = np.searchsorted(words.starts, np.append(starts, len(data)))
    # sentences with words, numbered as in the text
    used = np.flatnonzero(np.diff(at) > 0)
    row = np.searchsorted(offsets, starts[used], side="right") - 1
    ends = np.append(starts[1:], len(data))
    rolling = Rolling(words.hashes, 0x9E3779B97F4A7C15 | 1)
    out = []
    for size in (2, SPAN):
        if len(used) < size:
            continue
        a, b = np.arange(len(used) - size + 1), np.arange(size - 1, len(used))
        n = at[used[b] + 1] - at[used[a]]
        kept = (row[a] == row[b]) & (n >= (PAIR_WORDS if size == 2 else SPAN_WORDS))
        a, b = a[kept], b[kept]
        hashes = mix(rolling.hash(at[used[a]], at[used[b] + 1]) + np.uint64(size))
        out.append((row[a], starts[used[a]], ends[used[b]], hashes))
    if clauses and len(used):
        first = np.union1d(at[used], clause_starts(words))
        places = np.union1d(first, words.rows[1:])
        end = places[np.minimum(np.searchsorted(places, first + PAIR_WORDS), len(places) - 1)]
        # and back from the ends of sentences, so that a copy goes up to its end
        back = first[np.maximum(np.searchsorted(first, at[used + 1] - PAIR_WORDS, side="right") - 1, 0)]
        first, end = np.append(first, back), np.append(end, at[used + 1])
        of_row = np.searchsorted(words.rows, first, side="right") - 1
        kept = (end - first >= PAIR_WORDS) & (end <= words.rows[of_row + 1])
        first, end, of_row = first[kept], end[kept], of_row[kept]
        # a clause that begins or ends a sentence takes what stands there besides words
        begins, until = words.starts.copy(), np.append(words.starts[1:], len(data))
        begins[at[used]], until[at[used + 1] - 1] = starts[used], ends[used]
        hashes = mix(rolling.hash(first, end) + np.uint64(1))
        out.append((of_row, begins[first], until[end - 1], hashes))
    out = [(r, a - offsets[r], b - offsets[r], h) for r, a, b, h in out]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (none, none, none, none.astype(np.uint64))


def later_spans(docs: DataFrame, clauses: bool = False) -> DataFrame:
    """key, first, end: the runs that occurred before, in bytes; ``docs`` has doc, key and text."""
    spark = docs.sparkSession

    def work(batch: pa.RecordBatch) -> dict:
        row, first, end, hashes = spans(batch.column("text"), clauses)
        of = lambda c: batch.column(c).take(pa.array(row))
        return {"doc": of("doc"), "key": of("key"), "first": first, "end": end, "span": hashes.view(np.int64)}

    found = written(map_batches(docs, work, "doc long, key long, first int, end int, span long"), spark, "spans")
    repeated = found.groupBy("span").agg(F.count("*").alias("times")).where("times > 1").select("span")
    found = written(found.join(repeated, "span"), spark, "repeated")
    place = F.struct("doc", "key", "first")
    earliest = found.groupBy("span").agg(F.min(place).alias("earliest"))
    joined = found.join(earliest, "span")
    return joined.where(~place.eqNullSafe(F.col("earliest"))).select("key", "first", "end")


def _with_spans(docs: DataFrame, kept, clauses: bool) -> DataFrame:
    text = text_of()
    doc = F.col("doc_id").cast("long")
    keyed = docs.select(kept.alias("kept"), doc.alias("doc"), text.alias("text"), F.xxhash64(doc, text).alias("key"))
    lists = later_spans(keyed.select("doc", "key", "text"), clauses).groupBy("key").agg(F.collect_set(F.struct("first", "end")).alias("spans"))
    return keyed.join(lists, "key", "left").select("kept", "text", "spans")


def _cut(batch: pa.RecordBatch):
    """Each row's number of sentences, number removed, and kept bytes."""
    data, offsets = utf8(batch.column("text"))
    starts = sentence_starts(data, offsets)
    rows = np.searchsorted(starts, offsets)
    lists = batch.column("spans")
    found = lists.flatten()
    row = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
    first, end = (np.asarray(found.field(c), dtype=np.int64) + offsets[row] for c in ("first", "end"))
    size = len(data) + 1
    gone = (np.bincount(first, minlength=size) - np.bincount(end, minlength=size)).cumsum()[:-1] > 0
    before = np.append(0, np.cumsum(gone))
    edges = np.append(starts, len(data))
    whole = np.append(0, np.cumsum(before[edges[1:]] - before[edges[:-1]] == np.diff(edges)))
    for i in range(len(lists)):
        a, b = offsets[i], offsets[i + 1]
        yield int(rows[i + 1] - rows[i]), int(whole[rows[i + 1]] - whole[rows[i]]), data[a:b][~gone[a:b]].tobytes()


def removal_report(docs: DataFrame, clauses: bool = False) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_bytes kept and kept_sha256 of every document."""

    def work(batch: pa.RecordBatch) -> dict:
        rows = [(n, gone, len(kept), hashlib.sha256(kept).hexdigest()) for n, gone, kept in _cut(batch)]
        return {"doc_id": batch.column("kept")} | dict(zip(("n_sentences", "n_removed", "n_bytes", "kept_sha256"), map(list, zip(*rows))))

    found = _with_spans(docs, F.col("doc_id").cast("long"), clauses)
    return map_batches(found, work, "doc_id long, n_sentences long, n_removed long, n_bytes long, kept_sha256 string")


def deduplicated(docs: DataFrame, clauses: bool = False) -> DataFrame:
    """doc_id and the text without repeated spans."""

    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("kept"), "text": [kept.decode() for *_, kept in _cut(batch)]}

    return map_batches(_with_spans(docs, F.col("doc_id").cast("long"), clauses), work, "doc_id long, text string")
