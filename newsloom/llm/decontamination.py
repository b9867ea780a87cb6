"""Operator 3: benchmark decontamination with a broadcast set of hashed word windows.

Words are runs of digits, letters and characters beyond ASCII, with A-Z lowered. Every run
of ``SIZE`` words of a benchmark item is a window; a shorter item is one window. A sorted
array of window hashes goes to all tasks; documents are scanned batch by batch with
rolling hashes, and each hash hit is verified on the words themselves.

The items are sent in slices of about ``SLICE_BYTES`` of text each, by the measured size of
the benchmark, and a document passes through one scan per slice. Between two slices the scanned documents are
written to the shared folder and the broadcast is released, so the driver and the tasks hold one slice at
a time. There is no shuffle at all.

Edge cases: a null or empty document has no words and no hits; a null or empty item has no
window; items with equal windows all count; an item without an id marks words but
is not listed; an empty benchmark marks nothing; repeated documents are marked each;
an empty table gives no rows; other columns, such as one called n_words, are dropped
unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import Words, map_batches, ranges, text_of, utf8, written

SIZE = 13
SLICE_BYTES = 8 << 20
SPANS = "array<struct<start:int,end:int>>"


class WindowIndex:
    """The windows of some items: hashes in order, and the words to verify with."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        self.names = [i for i, _ in items]
        data, offsets = utf8(pa.array([t for _, t in items], pa.large_string()))
        words = Words(data, offsets)
        self.text, self.places = joined_words(words)
        counts = np.diff(words.rows)
        self.sizes = {}
        for m in {size, *counts[(counts > 0) & (counts < size)].tolist()}:
            first, hashes = words.runs(m)
            row = np.searchsorted(words.rows, first, side="right") - 1
            chosen = counts[row] >= size if m == size else counts[row] == m
            order = np.argsort(hashes[chosen], kind="stable")
            hashes, first, row = hashes[chosen][order], first[chosen][order], row[chosen][order]
            if len(hashes):
                bits = np.zeros(1 << 20, bool)
                bits[(hashes >> np.uint64(44)).astype(np.int64)] = True
                self.sizes[m] = hashes, first, row, bits

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words and item of every verified occurrence in the texts."""
        found = [np.zeros((0, 3), np.int64)]
        for m, (hashes, first, row, bits) in self.sizes.items():
            at, own = words.runs(m)
            near = bits[(own >> np.uint64(44)).astype(np.int64)]
            at, own = at[near], own[near]
            low, high = np.searchsorted(hashes, own, "left"), np.searchsorted(hashes, own, "right")
            entry = ranges(low, high - low)
            place = np.repeat(at, high - low)
            if len(entry):
                text, places = joined_words(words, place, m)
                same = [
                    text[a : b] == self.text[self.places[f] : self.places[f + m] - 1]
                    for a, b, f in zip(places[:-1].tolist(), (places[1:] - 1).tolist(), first[entry].tolist())
                ]
                place, entry = place[same], entry[same]
                found.append(np.stack([place, np.full(len(place), m), row[entry]], 1))
        return tuple(np.concatenate(found).T)


def joined_words(words: Words, first: np.ndarray | None = None, size: int = 1) -> tuple[bytes, np.ndarray]:
    """Runs of words, each word with one space after it, and where each run begins."""
    chosen = np.arange(len(words.starts)) if first is None else ranges(first, np.full(len(first), size))
    lengths = words.ends[chosen] - words.starts[chosen]
    places = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = np.full(places[-1], 32, np.uint8)
    out[ranges(places[:-1], lengths)] = words.data[ranges(words.starts[chosen], lengths)]
    return out.tobytes(), places if first is None else places[::size] if len(places) > 1 else places


_workers: dict[str, WindowIndex] = {}


def _index(data: bytes, size: int) -> WindowIndex:
    key = f"{size} {hashlib.md5(data).hexdigest()}"
    if key not in _workers:
        _workers.clear()
        _workers[key] = WindowIndex(pickle.loads(data), size)
    return _workers[key]


def _slices(benchmark: DataFrame, slice_bytes: int) -> Iterator[tuple[bytes, bool]]:
    """The distinct items in slices of about ``slice_bytes``, each of which may be broadcast, and whether it is the last."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_of().alias("text")).where("text <> ''").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // slice_bytes))
    part = F.pmod(F.xxhash64("text", "item_id"), F.lit(count))
    for i in range(count):
        rows = items.where(part == i).collect()
        yield pickle.dumps(sorted(((r.item_id, r.text) for r in rows), key=lambda x: (x[0] or "", x[1]))), i == count - 1


def scan(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, keep: list[str] | None = None, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The columns ``keep`` of the documents, with n_words, hit_words and hit_bytes (spans) and items."""
    keep = keep or ["doc_id"]
    context = docs.sparkSession.sparkContext
    kept = F.struct(*[F.col(c) for c in keep]).alias("kept")
    none = F.array().cast(SPANS)
    df = docs.select(
        kept, text_of().alias("text"), F.lit(0).alias("n_words"), none.alias("hit_words"), none.alias("hit_bytes"),
        F.array().cast("array<string>").alias("items"),
    )
    for data, last in _slices(benchmark, slice_bytes):
        sent = context.broadcast(data)
        df = map_batches(df, _scanner(sent, size), df.schema)
        if not last:
            df = written(df, docs.sparkSession, "scanned")
            sent.unpersist()
    return df.select("kept.*", "n_words", "hit_words", "hit_bytes", "items")


def _scanner(items, size: int):
    def work(batch: pa.RecordBatch) -> dict:
        index = _index(items.value, size)
        data, offsets = utf8(batch.column("text"))
        words = Words(data, offsets)
        place, length, item = index.hits(words)
        row = np.searchsorted(words.rows, place, side="right") - 1
        listed, spans, cuts = batch.column("items").to_pylist(), batch.column("hit_words").to_pylist(), batch.column("hit_bytes").to_pylist()
        for r in np.unique(row).tolist():
            mine = row == r
            names = {index.names[i] for i in item[mine].tolist()} - {None}
            listed[r] = sorted(names.union(listed[r]))
            pairs = list(zip((place[mine] - words.rows[r]).tolist(), (place[mine] + length[mine] - words.rows[r]).tolist()))
            spans[r] = merged([*pairs, *((s["start"], s["end"]) for s in spans[r])])
            first, start = words.rows[r], offsets[r]
            cuts[r] = [{"start": words.starts[first + s["start"]] - start, "end": words.ends[first + s["end"] - 1] - start} for s in spans[r]]
        return {
            "kept": batch.column("kept"), "text": batch.column("text"), "n_words": np.diff(words.rows).astype(np.int32),
            "hit_words": spans, "hit_bytes": cuts, "items": listed,
        }

    return work


def merged(spans: list[tuple[int, int]]) -> list[dict]:
    """Maximal runs of the spans' union."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": a, "end": b} for a, b in out]


def n_hit() -> Column:
    """Words inside hits, of a scan."""
    return F.aggregate("hit_words", F.lit(0), lambda n, s: n + s["end"] - s["start"])


def contaminated() -> Column:
    """Whether at least a twentieth of the words are hit."""
    return (n_hit() > 0) & (20 * n_hit().cast("long") >= F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    columns = [f"`{c}`" for c in docs.columns]
    scanned = scan(docs.select(F.struct(*columns).alias("_doc"), "text"), benchmark, keep=["_doc"])
    return scanned.where(~contaminated()).select("_doc.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id and the text without the hit words."""
    scanned = scan(docs, benchmark, keep=["doc_id", "text"])
    raw = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<binary>").alias("parts"))
    cut = lambda a, s: F.struct(
        s["end"].alias("at"), F.concat(a["parts"], F.array(F.substring(raw, a["at"] + 1, s["start"] - a["at"]))).alias("parts"),
    )
    done = F.aggregate("hit_bytes", first, cut)
    rest = F.substring(raw, done["at"] + 1, F.octet_length(raw))
    text = F.aggregate(done["parts"], F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p))
    return scanned.select("doc_id", F.decode(F.concat(text, rest), "utf-8").alias("text"))
