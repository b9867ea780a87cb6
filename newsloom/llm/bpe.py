"""Operator 4: BPE encoding and decoding with a contiguous rank array per word.

A text is cut into pieces at places that no pre-token crosses (see ``pieces_of``), so a
piece's ids do not depend on its neighbours: each distinct piece of a batch is encoded
once and its ids are gathered for all its occurrences.

Encoding follows the steps of the vocabulary's file: special tokens, NFC, lower case,
the split pattern, bytes, merges. The merges of short words run on a matrix with one
row per word: part ids, and next to them the ranks of adjacent parts. Each round finds
the smallest rank of every row, deletes that boundary and refreshes the two ranks beside it.
Words beyond ``SHORT`` bytes use a heap instead, as a scan would be quadratic.

Edge cases: a null text is empty; an empty text has no ids, and the hashes of the empty
string; repeated rows give repeated results; an empty table gives no rows; columns other
than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from newsloom.llm.arrays import map_batches, text_of, utf8

SHORT = 48
NO_RANK = np.int32(2**31 - 1)
CACHED_PIECES = 300_000
MAX_VOCABULARY_BYTES = 64 << 20


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file, to be broadcast: its size is checked."""
    data = Path(path).read_bytes()
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes, more than {MAX_VOCABULARY_BYTES}")
    return data


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class RankArrayBpe:
    """Encoder for a byte-level BPE vocabulary with word ends."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        vocabulary: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocabulary.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.specials.items()}
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.specials, key=len, reverse=True)) or "(?!)")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(f"{split}|\n")
        letters = byte_letters()
        self.inner = np.array([vocabulary[x] for x in letters], np.int32)
        self.final = np.array([vocabulary[x + end] for x in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        codes = np.array([(vocabulary[a] << 32) | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.rank_of = codes[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.rank_of[at], NO_RANK)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, the words alone."""
        out: list[np.ndarray | None] = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            if len(word) > SHORT:
                out[i] = self._long(word)
            else:
                by_size.setdefault(len(word), []).append(i)
        for size, chosen in by_size.items():
            for start in range(0, len(chosen), 1 << 14):
                part = chosen[start : start + (1 << 14)]
                raw = np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), size)
                for i, ids in zip(part, self._short(raw)):
                    out[i] = ids
        return out

    def _short(self, raw: np.ndarray) -> list[np.ndarray]:
        count, size = raw.shape
        ids = self.inner[raw]
        ids[:, -1] = self.final[raw[:, -1]]
        parts = np.full(count, size)
        done = ids.copy()
        ranks = np.full((count, size), NO_RANK, np.int32)
        ranks[:, : size - 1] = self.ranks(ids[:, :-1], ids[:, 1:])
        row = np.arange(count)
        while len(row):
            at = ranks.argmin(1)
            line = np.arange(len(row))
            least = ranks[line, at]
            live = least < NO_RANK
            if not live.all():
                done[row[~live], : ids.shape[1]] = ids[~live]
                row, ids, ranks, at, least = row[live], ids[live], ranks[live], at[live], least[live]
                line = np.arange(len(row))
            if not len(row):
                break
            ids[line, at] = self.merged[least]
            column = np.arange(ids.shape[1] - 1)
            shift = column[None, :] + (column[None, :] > at[:, None])
            ids = np.take_along_axis(ids, shift, 1)
            ranks = np.take_along_axis(ranks, column[None, :] + (column[None, :] >= at[:, None]), 1)
            parts[row] -= 1
            # the two ranks beside the deleted boundary
            left = at > 0
            ranks[line[left], at[left] - 1] = self.ranks(ids[line[left], at[left] - 1], ids[line[left], at[left]])
            right = at + 1 < parts[row]
            ranks[line[right], at[right]] = self.ranks(ids[line[right], at[right]], ids[line[right], at[right] + 1])
            ranks[line[~right], at[~right]] = NO_RANK
        return [done[i, : parts[i]] for i in range(count)]

    def _long(self, word: bytes) -> np.ndarray:
        raw = np.frombuffer(word, np.uint8)
        ids = self.inner[raw].tolist()
        ids[-1] = int(self.final[raw[-1]])
        start = self.ranks(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(start) if r != NO_RANK]
        heapq.heapify(heap)
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]

        def offer(i: int) -> None:
            j = after[i]
            code = (ids[i] << 32) | ids[j]
            at = int(np.searchsorted(self.codes, code))
            if at < len(self.codes) and self.codes[at] == code:
                heapq.heappush(heap, (int(self.rank_of[at]), i, ids[i], ids[j]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else -1
            if j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces without ASCII white space."""
        plan: list[list] = []
        plain: list[str] = []
        for piece in pieces:
            steps, last = [], 0
            if "<" in piece:
                for m in self.special.finditer(piece):
                    steps += [(len(plain), None), (None, self.specials[m[0]])]
                    plain.append(piece[last : m.start()])
                    last = m.end()
            steps.append((len(plain), None))
            plain.append(piece[last:])
            plan.append(steps)
        joined = unicodedata.normalize("NFC", "\n".join(plain))
        lower = joined.lower() if "Σ" not in joined else "".join(c.lower() for c in joined)
        groups: list[list[str]] = [[]]
        for word in self.words.findall(lower):
            if word == "\n":
                groups.append([])
            else:
                groups[-1].append(word)
        distinct = {w: i for i, w in enumerate(dict.fromkeys(w for g in groups for w in g))}
        coded = [x.tolist() for x in self.encode_words([w.encode() for w in distinct])]
        ids = [[t for w in g for t in coded[distinct[w]]] for g in groups]
        return [[t for at, special in steps for t in ([special] if at is None else ids[at])] for steps in plan]


class PieceCache:
    """What was computed for the pieces seen in this worker.

    Two generations of at most ``limit`` pieces: when the newer one is full it becomes
    the older one, and pieces met again move over, so that frequent ones stay.
    """

    def __init__(self, compute, limit: int = CACHED_PIECES):
        self.compute, self.limit, self.new, self.old = compute, limit, {}, {}

    def get(self, pieces: list[str]) -> list:
        if len(self.new) > self.limit:
            self.new, self.old = {}, self.new
        new, old = self.new, self.old
        again = [p for p in pieces if p not in new]
        missing = [p for p in again if p not in old]
        new.update((p, old[p]) for p in again if p in old)
        if missing:
            new.update(zip(missing, self.compute(missing)))
        return [new[p] for p in pieces]


def _breaks() -> tuple[np.ndarray, np.ndarray]:
    """Classes of bytes, and between which two classes a piece may end."""
    other, space, letter, digit, mark = range(5)
    kinds = np.full(256, other, np.uint8)
    for b in range(33, 127):
        c = chr(b)
        kinds[b] = letter if c.isalpha() else digit if c.isdigit() else other if c in "'<|>" else mark
    kinds[[9, 10, 11, 12, 13, 32]] = space
    table = np.zeros((5, 5), bool)
    table[space, :] = True
    for a in (letter, digit, mark):
        for b in (letter, digit, mark):
            table[a, b] = a != b or a == digit
    table[:, space] = False
    return kinds, table.reshape(-1)


KINDS, BREAKS = _breaks()
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def pieces_of(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces, the number of each occurrence's piece, and where each row's occurrences begin.

    Cut at ASCII white space and between ASCII letters, digits and marks, where every
    pattern used here ends a pre-token. Apostrophes and the characters of special tokens
    never part a piece. Letters are lowered unless a special token may be there.
    """
    found = cut_pieces(column)
    return found.pieces, found.which, found.rows


class CutPieces(NamedTuple):
    pieces: list[str]  # distinct
    which: np.ndarray  # the piece of each occurrence
    rows: np.ndarray  # where each row's occurrences begin
    starts: np.ndarray  # first byte of each occurrence, over all rows
    offsets: np.ndarray  # first byte of each row
    data: np.ndarray  # the bytes of all rows


def cut_pieces(column: pa.Array) -> CutPieces:
    """The pieces of ``pieces_of`` with their places."""
    raw, offsets = utf8(column)
    data = raw
    if not len(data):
        return CutPieces([], np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), offsets, raw)
    if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
        data = ASCII_LOWER[data]
    kinds = KINDS[data]
    begins = np.empty(len(data), bool)
    begins[0] = kinds[0] != 1
    begins[1:] = BREAKS[kinds[:-1] * np.uint8(5) + kinds[1:]]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = kinds[first] != 1
    kept = kinds != 1
    starts = np.flatnonzero(begins)
    place = np.cumsum(kept) - kept
    text = data[kept]
    strings = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(place[starts], len(text)).astype(np.int64)), pa.py_buffer(text),
    )
    coded = strings.dictionary_encode()
    return CutPieces(coded.dictionary.to_pylist(), np.asarray(coded.indices), np.searchsorted(starts, offsets), starts, offsets, raw)


def gathered(parts: list[bytes], which: np.ndarray, rows: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The parts of all occurrences, one after the other, and where each row begins."""
    taken = pa.array(parts, pa.large_binary()).take(pa.array(which))
    _, places, data = taken.buffers()
    at = np.frombuffer(places, np.int64)[: len(which) + 1] if len(which) else np.zeros(1, np.int64)
    return memoryview(data) if data is not None else memoryview(b""), at[rows]


_workers: dict[str, PieceCache] = {}


def _coded(bpe: RankArrayBpe, pieces: list[str]) -> list[tuple[int, bytes, bytes]]:
    out = []
    for ids in bpe.encode_pieces(pieces):
        out.append((
            len(ids), "".join(f"{i} " for i in ids).encode(), "".join(f"{bpe.tokens[i]} " for i in ids).encode(),
        ))
    return out


def rank_array_cache(data: bytes) -> PieceCache:
    """The encoder of this worker process, built once per vocabulary."""
    key = "rank " + hashlib.md5(data).hexdigest()
    if key not in _workers:
        bpe = RankArrayBpe(data)
        _workers[key] = PieceCache(lambda pieces: _coded(bpe, pieces))
    return _workers[key]


def encode(docs: DataFrame, path: str, digests: bool = True) -> DataFrame:
    """Ids and decoded text of every document.

    With ``digests``: doc_id, n_tokens, ids_sha256 (decimal ids joined by a space) and
    decoded_sha256; otherwise doc_id, ids and decoded. Decoding joins the tokens by a space.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def work(batch: pa.RecordBatch) -> dict:
        pieces, which, rows = pieces_of(batch.column("text"))
        found = rank_array_cache(vocabulary.value).get(pieces)
        counts = np.array([x[0] for x in found], np.int64)
        total = np.concatenate([[0], np.cumsum(counts[which])]) if len(which) else np.zeros(1, np.int64)
        n_tokens = total[rows[1:]] - total[rows[:-1]]
        ids, id_rows = gathered([x[1] for x in found], which, rows)
        decoded, word_rows = gathered([x[2] for x in found], which, rows)
        cut = lambda data, at, i: data[at[i] : max(at[i], at[i + 1] - 1)]  # noqa: E731  without the last space
        doc_id, every = batch.column("doc_id"), range(batch.num_rows)
        if digests:
            digest = lambda data, at: [hashlib.sha256(cut(data, at, i)).hexdigest() for i in every]
            return {"doc_id": doc_id, "n_tokens": n_tokens, "ids_sha256": digest(ids, id_rows), "decoded_sha256": digest(decoded, word_rows)}
        return {
            "doc_id": doc_id, "ids": [[int(x) for x in bytes(cut(ids, id_rows, i)).split()] for i in every],
            "decoded": [str(cut(decoded, word_rows, i), "utf-8") for i in every],
        }

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    return map_batches(docs.select("doc_id", text_of().alias("text")), work, f"doc_id long, {columns}")
