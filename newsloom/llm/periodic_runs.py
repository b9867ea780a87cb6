"""Operator 12: periodic runs of words, found by seeds on the diagonals of a text against itself.

A run is a stretch of words with smallest period q (words q apart are identical), of at least
``LEAST`` words and ``REPEATS`` periods, that cannot be longer. Each run of a text goes, but for its
first q words.

Words q apart agree in a run on at least ``max(24, 3q) - q`` places in a row, which is never under 16, so
the runs of periods up to 16 are indexed by grams of 16 words, and those of periods in (k/2, k] by
grams of k = 32, 64, ... words. For these k, the next occurrence of a gram that begins a run of period q lies
exactly q words further on: a nearer one would overlap it by a period's length at least and so give
the run a smaller period (Fine and Wilf). So only neighbouring occurrences are enumerated as
(place, lag), at most one a place, and not all pairs. They are taken by lag and place with the furthest
place that the lag's stretch has covered: a seed inside it starts nothing, one beyond it a new
stretch. Each stretch is then compared word by word, so no run rests on a hash. Grams of
2k words are only looked at where both of their halves occur again.

A text's words get numbers within its Arrow slice; a text is whole in one task, in memory of
its own size. No row meets another, so nothing is shuffled and no key can be hot.

Edge cases: a null text is empty and has no words; a text without runs is returned with its words
joined by one space; repeated rows are treated alike; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import Rolling, map_batches, mix, schema_of, text_of

LEAST, REPEATS = 24, 3
GRAM = 16  # the least number of places that agree: max(LEAST, REPEATS * q) - q for any q


def seeds(codes: np.ndarray, offsets: np.ndarray, size: int, live: np.ndarray, grams: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and lags of neighbouring equal grams inside a text, and the places whose gram occurs again."""
    text = np.searchsorted(offsets, live, side="right") - 1
    name = mix(grams.hash(live, live + size) + np.uint64(0x9E3779B97F4A7C15) * text.astype(np.uint64))
    order = np.argsort(name, kind="stable")
    place, name, text = live[order], name[order], text[order]
    again = (name[1:] == name[:-1]) & (text[1:] == text[:-1])
    first, lag = place[:-1][again], np.diff(place)[again]
    twice = np.zeros(len(codes) + 1, bool)
    twice[first] = True
    twice[first + lag] = True
    return first, lag, twice


def stretches(first: np.ndarray, lag: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lag, start and end of the stretches that seeds cover, the end without its last ``lag`` words."""
    order = np.lexsort((first, lag))
    first, lag = first[order], lag[order]
    covered = first + size  # the furthest place of a lag, as its seeds come in order
    new = np.ones(len(first), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (first[1:] > covered[:-1])
    starts = np.flatnonzero(new)
    lasts = np.append(starts[1:], len(first))[: len(starts)] - 1
    return lag[starts], first[starts], covered[lasts]


def exact(codes: np.ndarray, lag: int, start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a stretch that agree word by word; one part unless hashes were confused."""
    alike = codes[start:end] == codes[start + lag : end + lag]
    if alike.all():
        return [(start, end)]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], alike, [False]])))
    return [(start + int(a), start + int(b)) for a, b in zip(edges[::2], edges[1::2])]


def find_runs(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start, length and period of every run, by start and period; ``codes`` are the words of all texts."""
    sizes = np.diff(offsets)
    grams = Rolling(mix(codes.astype(np.uint64) + np.uint64(1)))
    room = lambda size: np.repeat(offsets[1:] - size, sizes)
    places = np.arange(len(codes))
    live, size, found = places[places <= room(GRAM)], GRAM, []
    while len(live):
        first, lag, twice = seeds(codes, offsets, size, live, grams)
        fits = (lag <= size) & ((lag > size // 2) | (size == GRAM))
        for q, start, end in zip(*(x.tolist() for x in stretches(first[fits], lag[fits], size))):
            if end + q - start >= max(LEAST, REPEATS * q):
                for a, b in exact(codes, q, start, end):
                    if b + q - a >= max(LEAST, REPEATS * q):
                        found.append((a, b + q - a, q))
        both = live[twice[live] & twice[np.minimum(live + size, len(codes))]]
        live, size = both[both <= room(2 * size)[both]], 2 * size
    out = np.array(found, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Which words some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) > 0


def _work(batch: pa.RecordBatch) -> dict:
    texts = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64, int(offsets[-1]))
    runs = find_runs(codes, offsets)
    gone = dropped(runs, len(codes))
    cuts = np.searchsorted(runs[:, 0], offsets)
    place = runs[:, 0] - np.repeat(offsets[:-1], np.diff(cuts))
    kept = []
    for words, a, b, c, d in zip(texts, offsets, offsets[1:], cuts, cuts[1:]):
        if c < d:
            words = [w for w, out in zip(words, gone[a:b].tolist()) if not out]
        kept.append(b" ".join(words).decode())
    lists = lambda values: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int64()))
    return {
        "doc_id": batch.column("doc_id"), "n_words": np.diff(offsets), "starts": lists(place),
        "lengths": lists(runs[:, 1]), "periods": lists(runs[:, 2]), "collapsed": kept,
    }


def collapsed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and the text without their repetitions, one row per document."""
    rows = docs.select("doc_id", text_of().alias("text"))
    schema = schema_of("n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string", doc_id=rows.schema["doc_id"].dataType)
    found = map_batches(rows, _work, schema)
    zipped = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda z: F.struct(
        z["starts"].alias("start"), z["lengths"].alias("length"), z["periods"].alias("period"),
    ))
    return found.select("doc_id", "n_words", zipped.alias("runs"), "collapsed")


def strongest(runs: Column) -> Column:
    """The run of most periods, the first of several; null where there is none."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.aggregate(runs, none, lambda best, r: F.when(more(best, r), r).otherwise(best))


def run_report(docs: DataFrame) -> DataFrame:
    """Number of runs, the strongest one and hashes of all runs and of the collapsed text."""
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = collapsed(docs).withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents as the contract wants them: where h = crc32(doc_id) leaves 0 by 10, words from a place
    ``a`` on repeat the first ``p`` words there."""
    from newsloom.llm.host_rules import let, words_of

    g = F.floor(F.crc32(F.col("doc_id").cast("string")) / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        each = lambda spot: F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < spot["a"], i).otherwise(spot["a"] + (i - spot["a"]) % spot["p"])),
        )
        return F.when(n > 0, F.array_join(let(F.struct(a.alias("a"), p.alias("p")), each), " ")).otherwise("")

    chosen = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return docs.select("doc_id", F.when(chosen, let(words_of(text_of()), planted)).otherwise(text_of()).alias("text"))
