"""Operator 1: repeated substrings by fingerprints of growing strings at sampled positions.

This stands in for prefix doubling: no pairs of ranks are sorted, names are hashes of longer strings (see README).

Wanted is every byte inside a string of ``length`` bytes that also starts elsewhere. Ranking
every byte position at every doubling would move many times the input, so the ranked
positions are sampled: the anchor of a window of ``length`` bytes is the smallest hash among
its substrings of ``FIRST`` bytes (the leftmost of equal ones). Equal windows have equal
anchors at equal distances, so two windows need comparing only where their anchors rank alike.

Each round ranks strings around the live positions, longer strings each time:

* a node is an anchor and a range of distances from the window's start to it. Its *core*
  is the string that all windows of the range share, its *span* the string that they
  cover together. Names of strings are 64-bit hashes of their bytes, so a name of any
  length comes from one pass over the text, without a join for the second half of a pair.
* Spark groups the pairs (core, span). A core that occurs once retires its node: none
  of its windows repeats. A span that occurs twice settles its node: all windows repeat.
* what is left is split into narrower ranges, and cores grow from ``FIRST`` bytes towards
  ``length``; at width 1 core and span are the window itself, and all is decided.

Of the nodes with one span only one goes on to the next round, to answer for the others, so
large groups of copies cost one row each per round and never meet in a task: all
steps are grouped counts and joins on a name, which Spark splits where a name is hot.
After the first round only short strings around the live anchors are kept, not the texts.

Edge cases: a null text is empty; texts shorter than ``length`` have no windows; repeated rows
repeat each other; overlapping repeats inside one text count; rows with a null id are handled
like others; an empty table gives no rows; other columns are kept apart and clash with nothing.
Two different strings would have to share a 64-bit name to be taken for equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import BYTE_CODES, Rolling, binary, map_batches, mix, ranges, schema_of, text_of, utf8, written

LENGTH = 400
FIRST = 64
PLACE_BITS = 22
WIDTHS = (24, 1)
NODE = "doc long, place int, low int, high int, core long, span long"


def _window_anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` neighbouring hashes, the leftmost of equal ones.

    A place goes into the low bits of its hash. Long inputs are ranked block by block, so
    that the bits are the same everywhere and equal windows have equal anchors.
    """
    low = np.uint64((1 << PLACE_BITS) - 1)
    count, step = len(grams) - width + 1, (1 << PLACE_BITS) - width
    out = np.empty(max(count, 0), np.int64)
    for start in range(0, count, step):
        n = min(step, count - start)
        part = mix(grams[start : start + n + width - 1])
        blocks = -(-len(part) // width)
        table = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        table[: len(part)] = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        table = table.reshape(blocks, width)
        ahead = np.minimum.accumulate(table, 1).reshape(-1)
        behind = np.minimum.accumulate(table[:, ::-1], 1)[:, ::-1].reshape(-1)
        out[start : start + n] = start + (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)
    return out


def anchors(column: pa.Array, length: int) -> dict[str, np.ndarray]:
    """The nodes of the first round: row, place of the anchor, range of distances, names."""
    data, offsets = utf8(column)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    starts = ranges(offsets[:-1], counts)
    if not len(starts):
        return {k: np.zeros(0, np.int64) for k in ("row", "place", "low", "high", "core", "span")}
    rolling = Rolling(BYTE_CODES[data])
    anchor = _window_anchors(rolling.grams(FIRST), length - FIRST + 1)[starts]
    row = np.repeat(np.arange(len(counts)), counts)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    place = anchor[first]
    low, high = place - starts[last], place - starts[first]
    span = rolling.hash(starts[first], starts[last] + length)
    return {
        "row": row[first], "place": place - offsets[row[first]], "low": low, "high": high,
        "core": _signed(rolling.hash(place, place + FIRST)), "span": _signed(_with_range(span, low, high, length)),
    }


def _with_range(span: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    return mix(span + high.astype(np.uint64) * np.uint64(length + 1) + low.astype(np.uint64))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def ranked(nodes: DataFrame) -> DataFrame:
    """The nodes whose core repeats, with ``settled`` (the span repeats) and ``goes_on``."""
    ident = F.xxhash64("doc", "place", "low")
    pairs = nodes.groupBy("core", "span").agg(F.count("*").alias("n"), F.min(ident).alias("speaker"))
    cores = pairs.groupBy("core").agg(F.sum("n").alias("total"), F.count("*").alias("spans")).where("total > 1")
    live = pairs.join(cores.select("core", "spans"), "core")
    several = F.col("spans") > 1
    return nodes.join(live, ["core", "span"]).select(
        "doc", "place", "low", "high", (F.col("n") > 1).alias("settled"),
        (several & ((F.col("n") == 1) | (ident == F.col("speaker")))).alias("goes_on"),
    )


def _around(length: int) -> Callable[[pa.RecordBatch], dict]:
    """Cut the strings around the live anchors out of the texts."""

    def work(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("text"))
        nodes = batch.column("nodes")
        row = np.repeat(np.arange(batch.num_rows), np.asarray(nodes.value_lengths()))
        flat = nodes.flatten()
        place, low, high = (np.asarray(flat.field(i)).astype(np.int64) for i in range(3))
        begin = offsets[row] + place - high
        size = length + high - low
        cuts = np.concatenate([[0], np.cumsum(size)])
        docs = np.asarray(batch.column("doc"))[row]
        return {"doc": docs, "place": place, "low": low, "high": high, "around": binary(data[ranges(begin, size)], cuts)}

    return work


def _split(length: int, width: int) -> Callable[[pa.RecordBatch], dict]:
    """Nodes of ranges of ``width`` distances out of wider ones; their strings lie in ``around``."""

    def work(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("around"))
        parts = batch.column("parts")
        row = np.repeat(np.arange(batch.num_rows), np.asarray(parts.value_lengths()))
        flat = parts.flatten()
        low, high = (np.asarray(flat.field(i)).astype(np.int64) for i in range(2))
        first, count = low // width, high // width - low // width + 1
        cell, row = ranges(first, count), np.repeat(row, count)
        low = np.maximum(np.repeat(low, count), cell * width)
        high = np.minimum(np.repeat(high, count), cell * width + width - 1)
        # the anchor's place in ``around`` is its greatest distance from a window's start
        anchor = offsets[row] + np.asarray(batch.column("high")).astype(np.int64)[row]
        rolling = Rolling(BYTE_CODES[data])
        # cores of one cell are compared whatever part of the cell a node has
        core = rolling.hash(anchor - cell * width, anchor + length - np.minimum(cell * width + width - 1, length - FIRST))
        span = rolling.hash(anchor - high, anchor + length - low)
        salt = mix(cell.astype(np.uint64) + np.uint64(width << 20))
        of = lambda name: np.asarray(batch.column(name))[row]
        return {
            "doc": of("doc"), "place": of("place"), "low": low, "high": high, "core": _signed(core ^ salt),
            "span": _signed(_with_range(span, low, high, length)),
        }

    return work


def repeated_windows(docs: DataFrame, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """doc, first, last: ranges of window starts that repeat; ``docs`` has doc (long) and text."""
    if widths[-1] != 1 or length < FIRST:
        raise ValueError("the last width must be 1 and length at least FIRST")
    spark = docs.sparkSession

    def first_nodes(batch: pa.RecordBatch) -> dict:
        found = anchors(batch.column("text"), length)
        return found | {"doc": np.asarray(batch.column("doc"))[found["row"]]}

    nodes = written(map_batches(docs, first_nodes, NODE), spark, "anchors")
    live = written(ranked(nodes), spark, "ranked")
    done = [live.where("settled")]
    packed = live.where("goes_on").groupBy("doc").agg(F.collect_list(F.struct("place", "low", "high")).alias("nodes"))
    texts = docs.join(packed, "doc").select("doc", "text", "nodes")
    strings = written(
        map_batches(texts, _around(length), "doc long, place int, low int, high int, around binary"), spark, "around",
    )
    strings = strings.dropDuplicates(["doc", "place"])
    parts = strings.select("*", F.array(F.struct("low", "high")).alias("parts"))
    for width in widths:
        nodes = written(map_batches(parts, _split(length, width), NODE), spark, f"nodes-{width}")
        live = ranked(nodes)
        if width > 1:
            live = written(live, spark, f"ranked-{width}")
            left = live.where("goes_on").groupBy("doc", "place").agg(F.collect_list(F.struct("low", "high")).alias("parts"))
            parts = strings.join(left, ["doc", "place"])
        done.append(live.where("settled"))
    spans = [d.select("doc", (F.col("place") - F.col("high")).alias("first"), (F.col("place") - F.col("low")).alias("last")) for d in done]
    out = spans[0]
    for other in spans[1:]:
        out = out.unionByName(other)
    return out


def removed_runs(windows: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte runs that the windows cover."""
    out: list[list[int]] = []
    for first, last in sorted(windows):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last + length)
        else:
            out.append([first, last + length])
    return [(a, b) for a, b in out]


def _cut(batch: pa.RecordBatch, length: int):
    """Each row's bytes, removed runs and kept bytes."""
    data, offsets = utf8(batch.column("text"))
    for row, windows in enumerate(batch.column("windows").to_pylist()):
        raw = data[offsets[row] : offsets[row + 1]].tobytes()
        runs = removed_runs([(w["first"], w["last"]) for w in windows or ()], length)
        edges = [0, *(x for run in runs for x in run), len(raw)]
        yield raw, runs, b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def with_windows(docs: DataFrame, kept: Column, length: int = LENGTH) -> DataFrame:
    """kept, text and windows of every document.

    A document is known by a hash of its id and text; rows that agree in both
    are copies of each other, have the same windows and count as many times as they come.
    """
    text = text_of()
    keyed = docs.select(kept.alias("kept"), text.alias("text"), F.xxhash64("doc_id", text).alias("doc"))
    found = repeated_windows(keyed.select("doc", "text"), length)
    lists = found.groupBy("doc").agg(F.collect_set(F.struct("first", "last")).alias("windows"))
    return keyed.join(lists, "doc", "left").select("kept", "text", "windows")


def removal_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""

    def work(batch: pa.RecordBatch) -> dict:
        rows = [(len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()) for raw, runs, kept in _cut(batch, length)]
        return {"doc_id": batch.column("kept")} | dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256"), map(list, zip(*rows))))

    found = with_windows(docs, F.col("doc_id").cast("long"), length)
    return map_batches(found, work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without their repeated bytes, all columns kept; a letter that is cut apart goes."""

    def work(batch: pa.RecordBatch) -> dict:
        return {"kept": batch.column("kept"), "text": [kept.decode(errors="ignore") for *_, kept in _cut(batch, length)]}

    columns = docs.columns
    found = with_windows(docs, F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"]), length)
    done = map_batches(found, work, schema_of("text string", kept=found.schema["kept"].dataType))
    return done.select(*[F.col("text") if c == "text" else F.col("kept").getField(c).alias(c) for c in columns])
