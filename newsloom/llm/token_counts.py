"""Operator 5: token counts that follow edits.

A document's pieces (see ``bpe.pieces_of``; every pre-token lies in one) are the leaves of a
segment tree of token counts. An edit replaces a range of bytes. It touches the pieces it
overlaps or borders on; with one more piece on each side as context, these are re-encoded,
and the sums above them are renewed. Nothing else of the text is encoded again: the
context pieces are unchanged, so the cuts outside them are too.

The encoder is the rank array of operator 4. All touched regions of a batch are encoded
together, and each distinct piece once.

Edits are ranges of bytes of the original text with a replacement, cut at letters. They are taken in
order of their start; one that starts before the end of an earlier one is ignored, and
ends beyond the text are its end. Edge cases: a null text is empty; a null list has no edits; a null
replacement deletes; edits of an empty text insert; repeated rows are counted each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import map_batches, text_of
from newsloom.llm.bpe import cut_pieces, rank_array_cache, read_vocabulary

EDITS = "array<struct<start:int,end:int,text:string>>"
# Mail addresses, network addresses and numbers of five digits and more
PRIVATE = re.compile(rb"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+|[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{5,}")


class CountTree:
    """Segment tree of the token counts of a document's pieces."""

    def __init__(self, counts: np.ndarray):
        size = 1 << max(0, int(len(counts) - 1).bit_length()) if len(counts) else 1
        level = np.zeros(size, np.int64)
        level[: len(counts)] = counts
        self.levels = [level]
        while len(level) > 1:
            level = level[::2] + level[1::2]
            self.levels.append(level)

    @property
    def total(self) -> int:
        return int(self.levels[-1][0])

    def replace(self, first: int, last: int, total: int) -> None:
        """The leaves ``first`` to ``last`` together have ``total`` tokens now, kept at the first."""
        self.levels[0][first : last + 1] = 0
        self.levels[0][first] = total
        for below, level in zip(self.levels, self.levels[1:]):
            first, last = first // 2, last // 2
            level[first : last + 1] = below[2 * first : 2 * last + 2 : 2] + below[2 * first + 1 : 2 * last + 2 : 2]


def regions(starts: np.ndarray, size: int, edits: list[tuple[int, int, bytes]], text: bytes) -> list[tuple[int, int, bytes]]:
    """First leaf, last leaf and new bytes of the regions that the edits touch, merged where they meet."""
    if not len(starts):
        at, out = 0, b""
        for a, b, new in edits:
            out, at = out + text[at:a] + new, b
        return [(0, 0, out + text[at:])]
    ends = np.append(starts[1:], size)  # white space after a piece goes with it
    found: list[list] = []
    for a, b, new in edits:
        first = max(0, int(np.searchsorted(ends, a, side="left")) - 1)
        last = min(len(starts) - 1, int(np.searchsorted(starts, b, side="right")))
        if found and first <= found[-1][1] + 1:
            found[-1][1] = max(found[-1][1], last)
            found[-1][2].append((a, b, new))
        else:
            found.append([first, last, [(a, b, new)]])
    out = []
    for first, last, own in found:
        at, parts = 0 if first == 0 else int(starts[first]), []
        for a, b, new in own:
            parts += [text[at:a], new]
            at = b
        out.append((first, last, b"".join([*parts, text[at : int(ends[last])]])))
    return out


def ordered(edits: list[dict] | None, size: int) -> list[tuple[int, int, bytes]]:
    out: list[tuple[int, int, bytes]] = []
    for e in sorted(edits or (), key=lambda e: (e["start"], e["end"])):
        a, b = max(0, min(e["start"], size)), min(max(e["start"], e["end"]), size)
        if not out or a >= out[-1][1]:
            out.append((a, b, (e["text"] or "").encode()))
    return out


def edited(text: bytes, edits: list[tuple[int, int, bytes]]) -> bytes:
    """The text after the edits, the plain way."""
    at, parts = 0, []
    for a, b, new in edits:
        parts += [text[at:a], new]
        at = b
    return b"".join([*parts, text[at:]])


def count_edits(docs: DataFrame, path: str, edits: str | None = None) -> DataFrame:
    """doc_id, n_before, n_edits, n_after, n_encoded: token counts before and after the edits.

    ``edits`` names a column of edits; without it, private strings are replaced (``PRIVATE``).
    ``n_encoded`` is the number of bytes that were encoded again.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def work(batch: pa.RecordBatch) -> dict:
        encoder = rank_array_cache(vocabulary.value)
        cut = cut_pieces(batch.column("text"))
        counts = np.array([x[0] for x in encoder.get(cut.pieces)], np.int64)[cut.which] if len(cut.which) else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(counts)])
        before = total[cut.rows[1:]] - total[cut.rows[:-1]]
        after, n_edits, encoded = before.copy(), np.zeros_like(before), np.zeros_like(before)
        given = batch.column("edits").to_pylist() if edits else [None] * batch.num_rows
        trees, places = {}, []
        for row in range(batch.num_rows):
            a, b = int(cut.offsets[row]), int(cut.offsets[row + 1])
            text = cut.data[a:b].tobytes()
            own = ordered(given[row], b - a) if edits else [(m.start(), m.end(), b"[private]") for m in PRIVATE.finditer(text)]
            if own:
                leaves = slice(cut.rows[row], cut.rows[row + 1])
                trees[row] = CountTree(counts[leaves])
                n_edits[row] = len(own)
                places += [(row, *r) for r in regions(cut.starts[leaves] - a, b - a, own, text)]
        if places:
            again = cut_pieces(pa.array([p[3] for p in places], pa.large_binary()))
            new = np.array([x[0] for x in encoder.get(again.pieces)], np.int64)[again.which] if len(again.which) else np.zeros(0, np.int64)
            new = np.concatenate([[0], np.cumsum(new)])
            for n, (row, first, last, region) in enumerate(places):
                trees[row].replace(first, last, int(new[again.rows[n + 1]] - new[again.rows[n]]))
                encoded[row] += len(region)
            for row, tree in trees.items():
                after[row] = tree.total
        return {"doc_id": batch.column("doc_id"), "n_before": before, "n_edits": n_edits, "n_after": after, "n_encoded": encoded}

    columns = [F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")]
    if edits:
        columns.append(F.col(edits).cast(EDITS).alias("edits"))
    return map_batches(docs.select(*columns), work, "doc_id long, n_before long, n_edits long, n_after long, n_encoded long")
