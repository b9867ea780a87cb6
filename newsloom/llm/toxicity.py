"""Operator 9: toxicity by a subsequence string kernel and a support vector machine.

Words are compared by the bytes they share in order, gaps allowed: all subsequences of three
bytes within a span of five and of four bytes within a span of six, each weighted by
``DECAY`` to the power of its span. An insult with inserted or dropped letters, other
endings, or marks between its letters still shares most of its subsequences.
The machine is linear in the Nyström features of a set of landmark words, so its
decision is one weight per subsequence of the landmarks: a fixed table that goes to all tasks.

The machine is trained on single words of labelled documents: those that occur in far more toxic than
clean documents against words of clean documents. No subsequence crosses a space, so an insult of several ordinary
words is not learned.
A sentence scores as its highest word, a document by its two highest words, by
how many sentences score high and by its length, through a logistic curve fitted on the
same training documents. At most ``labelled.MAX_LABELLED`` documents, ``MAX_WORDS``
words a side and ``LANDMARKS`` landmarks are used, a documented bound; scoring covers whole texts.

Letters parted by spaces ("i d i o t") are joined, marks inside a word are dropped.
Edge cases: a null or empty text has no words and gets the curve's value for none; without
labels, or with labels of one class, every score is the smoothed share of label 1; repeated
rows get equal scores; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import LOWER, map_batches, mix, schema_of, text_of, utf8, written
from newsloom.llm.labelled import training_rows

DECAY = 0.7
PATTERNS = [(0, *c) for c in combinations(range(1, 5), 2)] + [(0, *c) for c in combinations(range(1, 6), 3)]
LANDMARKS = 400
COST = 30.0
MAX_WORDS = 6_000
TABLE_BITS = 18

KEPT = np.zeros(256, bool)
KEPT[48:58] = KEPT[97:123] = KEPT[128:] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
STOP = np.zeros(256, bool)
STOP[[10, 33, 46, 63]] = True


def sentence_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Words, the sentence of each, and where each row's words begin."""
    low = LOWER[data]
    kept = KEPT[low]
    inside = ~SPACE[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = offsets[:-1][np.diff(offsets) > 0]
    begins[rows] = inside[rows]
    starts = np.flatnonzero(begins)
    count = np.concatenate([[0], np.cumsum(kept)])
    ends = np.append(starts[1:], len(low))
    letters = count[ends] - count[starts]
    starts, letters = starts[letters > 0], letters[letters > 0]
    # single letters after single letters belong to the word before
    row = np.searchsorted(offsets, starts, side="right") - 1
    alone = letters == 1
    new = np.ones(len(starts), bool)
    new[1:] = ~(alone[1:] & alone[:-1]) | (row[1:] != row[:-1])
    starts, row = starts[new], row[new]
    places = np.append(count[starts], count[-1])
    text = low[kept]
    stops = np.concatenate([[0], np.cumsum(STOP[low])])
    before = stops[starts] + row  # a new row is a new sentence
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(text)],
    )
    return words, before, np.searchsorted(starts, offsets)


def with_start(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with a mark before the first byte, so that beginnings count in the kernel."""
    out = np.full(len(data) + len(places) - 1, 1, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, len(places)), np.diff(places))] = data
    return out, places + np.arange(len(places))


def subsequences(data: np.ndarray, places: np.ndarray):
    """For each pattern: its weight, the words and the codes of its occurrences."""
    data, places = with_start(data, places)
    word = np.repeat(np.arange(len(places) - 1), np.diff(places))
    end = places[1:][word]
    at = np.arange(len(data))
    wide = data.astype(np.uint64)
    for number, pattern in enumerate(PATTERNS):
        own = at[at + pattern[-1] < end]
        code = np.full(len(own), len(pattern), np.uint64)
        for step in pattern:
            code = (code << np.uint64(8)) | wide[own + step]
        yield number, DECAY ** (pattern[-1] + 1), word[own], code


def norms(places: np.ndarray) -> np.ndarray:
    """Length of a word's vector, from the number of places of each pattern."""
    length = np.diff(places) + 1  # with the mark at the start
    total = np.zeros(len(length))
    for pattern in PATTERNS:
        total += np.maximum(length - pattern[-1], 0) * DECAY ** (2 * (pattern[-1] + 1))
    return np.sqrt(np.maximum(total, 1e-12))


def vectors(words: list[bytes], codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Normalised vectors of some words, over their own codes or the given ones."""
    data = np.frombuffer(b"".join(words), np.uint8)
    places = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    found = list(subsequences(data, places))
    if codes is None:
        codes = np.unique(np.concatenate([c for *_, c in found]))
    out = np.zeros((len(words), len(codes)), np.float32)
    for _, weight, word, code in found:
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        known = codes[at] == code
        np.add.at(out, (word[known], at[known]), weight)
    return out / norms(places)[:, None].astype(np.float32), codes


@dataclass
class ToxicityModel:
    codes: np.ndarray  # subsequences of the landmarks, in order
    weights: np.ndarray
    bias: float
    curve: tuple[float, ...]

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Filter bits by hash, then the codes and weights."""
        bits = np.zeros(1 << TABLE_BITS, bool)
        bits[slots(self.codes)] = True
        return bits, self.codes, self.weights

    def word_scores(self, words: pa.Array) -> np.ndarray:
        data, places = utf8(words)
        total = np.zeros(len(words))
        if len(self.codes):
            bits, codes, weights = self.table()
            for _, weight, word, code in subsequences(data, places):
                near = bits[slots(code)]
                word, code = word[near], code[near]
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                total += np.bincount(word, np.where(codes[at] == code, weights[at] * weight, 0), len(words))
        return total / norms(places) + self.bias

    def features(self, column: pa.Array) -> np.ndarray:
        """Highest and second word score, number of high sentences, and length of each text."""
        data, offsets = utf8(column)
        out = np.zeros((len(offsets) - 1, 4))
        out[:, :2] = -2.0
        out[:, 3] = np.log1p(np.diff(offsets))
        if not len(data):
            return out
        words, sentence, rows = sentence_words(data, offsets)
        coded = words.dictionary_encode()
        scores = self.word_scores(coded.dictionary)[np.asarray(coded.indices)]
        row = np.repeat(np.arange(len(out)), np.diff(rows))
        order = np.lexsort((-scores, row))
        rank = np.arange(len(row)) - np.repeat(rows[:-1], np.diff(rows))
        for place in (0, 1):
            chosen = rank == place
            out[row[chosen], place] = scores[order][chosen]
        high = scores > 0
        pairs = np.unique(np.stack([row[high], sentence[high]], 1), axis=0) if high.any() else np.zeros((0, 2), int)
        out[:, 2] = np.log1p(np.bincount(pairs[:, 0], minlength=len(out)))
        out[:, :2] = np.clip(out[:, :2], -2.0, 2.0)
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(column) @ np.array(self.curve[1:]) + self.curve[0], -40, 40)))


def slots(code: np.ndarray) -> np.ndarray:
    return (mix(code) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def pick_landmarks(words: list[bytes], count: int) -> list[bytes]:
    """The first words of the list that are not near an earlier choice in the kernel's space."""
    x, _ = vectors(words)
    near, chosen = np.zeros(len(x)), []
    for i in range(len(x)):
        if near[i] < 0.85 and len(chosen) < count:
            chosen.append(i)
            near = np.maximum(near, x @ x[i])
    return [words[i] for i in chosen]


def with_gaps(words: list[bytes]) -> list[bytes]:
    """Forms of the words with one byte inserted."""
    filler = b"xaeiou0123"
    out = []
    for n, w in enumerate(words):
        at = 1 + n % max(1, len(w) - 1)
        out.append(w[:at] + filler[n % len(filler) :][:1] + w[at:])
    return out


def machine(positive: list[tuple[bytes, int]], negative: list[tuple[bytes, int]], rounds: int = 30) -> tuple[np.ndarray, np.ndarray, float]:
    """Subsequence weights and bias: Nyström features, squared hinge loss by Newton steps.

    Each side is a list of words and numbers of documents, the most telling word first.
    A word weighs as many times as it has documents; both sides weigh the same.
    """
    good, bad = ([w for w, _ in side] for side in (positive, negative))
    marks = [*pick_landmarks(good, LANDMARKS // 2), *pick_landmarks(bad[:1500], LANDMARKS // 2)]
    words = [*good, *with_gaps(good), *bad]
    y = np.where(np.arange(len(words)) < 2 * len(good), 1.0, -1.0)
    share = np.array([*(n for _, n in positive), *(n / 2 for _, n in positive), *(n for _, n in negative)], float)
    for side in (y > 0, y < 0):
        share[side] *= len(y) * COST / share[side].sum()
    base, codes = vectors(marks)
    values, axes = np.linalg.eigh(base @ base.T + 1e-3 * np.eye(len(marks)))
    root = axes / np.sqrt(np.maximum(values, 1e-6))
    blocks = [vectors(words[i : i + 2000], codes)[0] @ base.T @ root for i in range(0, len(words), 2000)]
    z = np.column_stack([np.concatenate(blocks), np.ones(len(words))]).astype(float)
    w, keep = np.zeros(z.shape[1]), np.eye(z.shape[1])
    keep[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (z @ w) < 1
        zi, ci = z[inside], share[inside]
        new = np.linalg.solve(keep + (zi * ci[:, None]).T @ zi, (zi * ci[:, None]).T @ y[inside])
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return codes, (base.T @ root @ w[:-1]).astype(float), float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[float, ...]:
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
        w += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def word_counts(rows: DataFrame) -> DataFrame:
    """word, toxic and clean: the labelled documents of each class that hold the word."""

    def work(batch: pa.RecordBatch) -> dict:
        data, offsets = utf8(batch.column("text"))
        if not len(data):
            return {"word": pa.array([], pa.binary()), "toxic": [], "clean": []}
        words, _, places = sentence_words(data, offsets)
        coded = words.dictionary_encode()
        row = np.repeat(np.arange(batch.num_rows), np.diff(places))
        pairs = np.unique(row * len(coded.dictionary) + np.asarray(coded.indices))
        toxic = np.asarray(batch.column("label"))[pairs // len(coded.dictionary)] > 0
        which, size = pairs % len(coded.dictionary), len(coded.dictionary)
        return {
            "word": coded.dictionary.cast(pa.binary()), "toxic": np.bincount(which[toxic], minlength=size),
            "clean": np.bincount(which[~toxic], minlength=size),
        }

    counts = map_batches(rows.select("text", "label"), work, "word binary, toxic long, clean long")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def credited(rows: DataFrame, marked: list[tuple[bytes, float]]) -> list[tuple[bytes, int]]:
    """The marked words that are the most telling word of some toxic texts, and of how many.

    Copies of a toxic text make all its words look telling; the insult in it explains them away.
    """
    order = {w: i for i, (w, _) in enumerate(marked)}
    sent = rows.sparkSession.sparkContext.broadcast(order)

    def work(batch: pa.RecordBatch) -> dict | None:
        data, offsets = utf8(batch.column("text"))
        if not len(data):
            return None
        words, _, places = sentence_words(data, offsets)
        coded, none = words.dictionary_encode(), len(sent.value)
        rank = np.array([sent.value.get(w, none) for w in coded.dictionary.to_pylist()], np.int64)[np.asarray(coded.indices)]
        best = np.full(batch.num_rows, none)
        np.minimum.at(best, np.repeat(np.arange(batch.num_rows), np.diff(places)), rank)
        return {"best": best[best < none]}

    best = map_batches(rows.where("label > 0").select("text"), work, "best long").groupBy("best").count()
    counts = {r["best"]: r["count"] for r in best.collect()}
    return [(w, counts[i]) for i, (w, _) in enumerate(marked) if i in counts]


def train(docs: DataFrame, labels: DataFrame, held: Column) -> ToxicityModel:
    rows = training_rows(docs, labels, "toxic", held).groupBy("text").agg(F.max("label").alias("label"))
    rows = written(rows, docs.sparkSession, "toxic-rows")
    n = {bool(r.toxic): r.n for r in rows.groupBy((F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    share = (n.get(True, 0) + 1) / (sum(n.values()) + 2)
    none = ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.0, (math.log(share / (1 - share)), 0.0, 0.0, 0.0, 0.0))
    if len(n) < 2:
        return none
    counts = word_counts(rows).where(F.octet_length("word").between(3, 40))
    total, expected = F.col("toxic") + F.col("clean"), n[True] / (n[True] + n[False])
    excess = F.col("toxic") * F.log(F.col("toxic") / (total * expected))
    counts = counts.withColumn("excess", F.when(F.col("toxic") / n[True] > 8 * F.col("clean") / n[False], excess))
    rank = F.xxhash64("word")
    # a word must stand out beyond what chance gives among all words of a class
    marked = counts.where((F.col("excess") > 9) & (F.col("toxic") > 3)).orderBy(F.desc("excess"), "word").limit(MAX_WORDS)
    usual = counts.where("clean > 0 and (excess is null or excess < 1)")
    frequent = usual.orderBy(F.desc("clean"), "word").limit(MAX_WORDS // 2)
    mixed = usual.orderBy(rank, "word").limit(MAX_WORDS // 2)
    side = lambda df, n: [(bytes(r.word), r[n]) for r in df.select("word", n).collect()]
    positive = credited(rows, side(marked, "excess"))
    negative = list(dict(side(frequent, "clean") + side(mixed, "clean")).items())
    if not positive or not negative:
        return none
    model = ToxicityModel(*machine(positive, negative), none.curve)
    found = features(rows, model, ["label"]).toArrow().to_pydict()
    x = np.stack([np.array(found[c]) for c in ("best", "second", "many", "length")], 1)
    model.curve = logistic(x, (np.array([k["label"] for k in found["kept"]]) > 0).astype(float))
    return model


def features(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    df = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), text_of().alias("text"))

    def work(batch: pa.RecordBatch) -> dict:
        x = sent.value.features(batch.column("text"))
        p = 1 / (1 + np.exp(-np.clip(x @ np.array(sent.value.curve[1:]) + sent.value.curve[0], -40, 40)))
        return {"kept": batch.column("kept"), "best": x[:, 0], "second": x[:, 1], "many": x[:, 2], "length": x[:, 3], "score": p}

    columns = "best double, second double, many double, length double, score double"
    return map_batches(df, work, schema_of(columns, kept=df.schema["kept"].dataType))


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``score``, 0 to 1."""
    return features(docs, model, keep).select("kept.*", "score")
