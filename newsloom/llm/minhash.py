"""Operator 7: near-duplicates by consistent weighted sampling over TF-IDF shingles.

A text is the bag of its runs of five words (a shorter text is one run). A run weighs its
count times ``1 + ln(documents / documents that hold it)``, where one document counts as two; the
documents of every run are counted, however rare it is. Documents are dealt by key to slices; a slice sends each of its different runs
once, with the number of its documents that hold it, to the part of the runs' hashes it falls
in, packed in one row for slice and part, and gets the sums back in the same order. So a
hot run is one number a slice, and the counts stay beside the sketches for the exact comparison.
Runs are counted by the upper 56 bits of their hashes.

Improved consistent weighted sampling (Ioffe) draws ``SAMPLES`` samples of each bag; texts
whose ``ROWS`` samples of a band agree are candidates. Candidates are verified by exact
weighted Jaccard similarity of at least ``SIMILARITY``, and components are united.

Equal texts are one node from the sketches on. In a bucket, texts are first compared with
``HUBS`` hubs and not with each other, and the components found are united: a large
group of near copies falls together after members times hubs comparisons. Buckets
that still hold several components are then decided whole, in pairs of blocks of bounded
size: a task holds two blocks, bounds all similarities between them by a product of
matrices, verifies what may reach the limit, and returns only the links that unite different
components. So every pair of texts that share a bucket is decided, and no list of pairs
is ever written.

Edge cases: a null text is empty; texts without words match only their equals; the class id is
the smallest document id of the class, null ids last; repeated rows are in one class; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.arrays import Words, batches_of, byte_slices, map_batches, mix, ranges, text_of, utf8, written
from newsloom.llm.components import components
from newsloom.session import ship_package

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
HUBS = 2
TEXT_BYTES = 1 << 20  # the hashes of one part take about 50 times as much for a moment
BLOCK_ROWS, BLOCK_BYTES = 512, 2 << 20
PAIR_ROWS = 256  # pairs of texts in an Arrow batch
DRAWS = 16  # bits
SLICE_BYTES, PART_BYTES = 4 << 20, 8 << 20
SLICES, PARTS = 256, 256  # at least


def bags(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each different run of words, in this order; few texts at a time are split into words."""
    found, rows = [], 0
    for part in byte_slices(pa.record_batch([column], ["text"]), TEXT_BYTES):
        row, hashes, counts = _bags(part.column("text"), size)
        found.append((row + rows, hashes, counts))
        rows += part.num_rows
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else none


def _bags(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = utf8(column)
    words = Words(data, offsets)
    counts = np.diff(words.rows)
    first, hashes = words.runs(size)
    row = np.searchsorted(words.rows, first, side="right") - 1
    for m in range(1, size):
        if (counts == m).any():
            at, short = words.runs(m)
            own = np.searchsorted(words.rows, at, side="right") - 1
            row, hashes = np.append(row, own[counts[own] == m]), np.append(hashes, short[counts[own] == m])
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return row[first], hashes[first], np.diff(np.append(first, len(row)))


def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Random numbers of the sampling, by 16 hash bits, and an odd factor for each sample."""
    at = np.arange(1 << DRAWS, dtype=np.uint64)
    uniform = lambda n: ((mix(at + np.uint64(n << 32)) >> np.uint64(11)).astype(float) + 0.5) / 2**53
    gamma = lambda n: -np.log(uniform(n)) - np.log(uniform(n + 1))
    factors = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
    return gamma(1), np.log(gamma(3)), uniform(5), factors


R, LOG_C, BETA, FACTORS = _draws()


def _ranked(log_weight, at) -> np.ndarray:
    """The value whose minimum is sampled, as an ordered whole number."""
    r = R[at]
    level = np.floor(log_weight / r + BETA[at]) - BETA[at]
    return ((LOG_C[at] - r * level - r + 64) * (1 << 24)).astype(np.int64) << 32


def samples(row: np.ndarray, hashes: np.ndarray, weights: np.ndarray, rows: int, usual: float) -> np.ndarray:
    """``SAMPLES`` samples of each row's bag; rows are in order, a row without a bag has zeros.

    Most runs have the weight ``usual``: theirs is a look-up in a table.
    """
    out = np.zeros((rows, SAMPLES), np.int64)
    if not len(row):
        return out
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    every = np.arange(1 << DRAWS)
    table = _ranked(math.log(usual), every)
    other = np.flatnonzero(np.abs(weights - usual) > 1e-12)
    log_weight = np.log(weights[other])
    for k in range(SAMPLES):
        drawn = hashes * FACTORS[k]
        drawn ^= drawn >> np.uint64(29)
        drawn *= np.uint64(0xBF58476D1CE4E5B9)
        at = (drawn >> np.uint64(64 - DRAWS)).astype(np.int64)
        values = table[at]
        values[other] = _ranked(log_weight, at[other])
        values |= (drawn & np.uint64(0xFFFFFFFF)).view(np.int64)
        out[row[first], k] = np.minimum.reduceat(values, first)
    return out


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers by bytes of equal place, which compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(np.uint64)[:, 0]


def _held(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different runs of a slice in order, their documents, and each given run's place among them."""
    runs, place, n = np.unique(hashes >> np.uint64(8), return_inverse=True, return_counts=True)
    return runs, n, place


def document_counts(dealt: DataFrame, parts: int) -> DataFrame:
    """slice, part and held: how many documents hold each run of a slice; ``dealt`` has slice, key and text."""
    ship_package(dealt.sparkSession)

    def ask(slice_: pa.Table) -> pa.Table:
        _, hashes, _ = bags(slice_.column("text").combine_chunks())
        runs, n, _ = _held(hashes)
        part = ((runs >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(24)
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(runs)) if len(runs) else np.zeros(1, int)
        own = [slice(i, j) for i, j in zip(cuts, cuts[1:])]
        return pa.table({
            "slice": pa.array([slice_.column("slice")[0].as_py()] * len(own), pa.int32()),
            "part": pa.array(part[cuts[:-1]].astype(np.int32)),
            "runs": pa.array([_planes(np.diff(runs[i], prepend=np.uint64(0))) for i in own], pa.binary()),
            "held": pa.array([_planes(n[i].astype(np.uint64)) for i in own], pa.binary()),
        })

    def answer(part: pa.Table) -> pa.Table:
        runs = [np.cumsum(_numbers(x), dtype=np.uint64) for x in part.column("runs").to_pylist()]
        held = np.concatenate([_numbers(x) for x in part.column("held").to_pylist()]).astype(np.int64)
        every = np.concatenate(runs)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        total = np.empty(len(every), np.uint64)
        total[order] = np.repeat(np.add.reduceat(held[order], first), np.diff(np.append(first, len(every)))).astype(np.uint64)
        cuts = np.cumsum([0, *map(len, runs)])
        found = pa.array([_planes(total[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())
        return pa.table({"slice": part.column("slice"), "part": part.column("part"), "held": found})

    asked = dealt.groupBy("slice").applyInArrow(ask, "slice int, part int, runs binary, held binary")
    return asked.groupBy("part").applyInArrow(answer, "slice int, part int, held binary")


def idf(held: np.ndarray, documents: int) -> np.ndarray:
    """The weight of runs that so many documents hold; one counts as two."""
    return 1 + np.log(documents / np.maximum(held, 2))


def _weights(counts: np.ndarray, held: pa.Array | list, documents: int) -> np.ndarray:
    """The weights of the bags of texts, from each bag's document counts in the order of the bag."""
    texts = held.to_pylist() if isinstance(held, pa.Array) else held
    return counts * idf(np.concatenate([np.zeros(0, np.uint64), *map(_numbers, texts)]), documents)


def sketches(docs: DataFrame, documents: int, size: int) -> DataFrame:
    """doc, key, name (of the text), bands and held; a text without words has no bands.

    ``held`` are the document counts of the text's runs, in the order of ``bags``; the texts
    are ``documents`` of ``size`` bytes together.
    """
    slices, parts = max(SLICES, math.ceil(size / SLICE_BYTES)), max(PARTS, math.ceil(size / PART_BYTES))
    dealt = docs.withColumn("slice", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(slices)).cast("int"))

    def work(texts: pa.Table, counted: pa.Table) -> pa.Table:
        rows = texts.num_rows
        row, hashes, counts = bags(texts.column("text").combine_chunks())
        _, _, place = _held(hashes)
        answers = sorted(zip(counted.column("part").to_pylist(), counted.column("held").to_pylist()))
        held = np.concatenate([np.zeros(0, np.uint64), *(_numbers(x) for _, x in answers)])[place]
        drawn = samples(row, hashes, counts * idf(held, documents), rows, float(idf(np.ones(1), documents)[0]))
        full = np.bincount(row, minlength=rows) > 0
        band = np.zeros((rows, BANDS), np.uint64)
        for k in range(ROWS):
            band = mix(band + drawn.reshape(-1, BANDS, ROWS)[:, :, k].view(np.uint64))
        band = mix(band + np.arange(BANDS, dtype=np.uint64)[None, :])
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]), pa.int32()), pa.array(band[full].view(np.int64).reshape(-1)),
        )
        cuts = np.searchsorted(row, np.arange(rows + 1))
        each = pa.array([_planes(held[i:j]) for i, j in zip(cuts, cuts[1:])], pa.binary())
        own = {c: texts.column(c) for c in ("doc", "key", "name")}
        return pa.table(own | {"bands": lists, "held": each})

    both = dealt.groupBy("slice").cogroup(document_counts(dealt, parts).groupBy("slice"))
    return both.applyInArrow(work, "doc long, key long, name string, bands array<long>, held binary")


def verified(pairs: DataFrame, documents: int, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs a, b of texts whose weighted Jaccard similarity reaches ``similarity``."""

    def work(batch: pa.RecordBatch) -> dict:
        n, sides = batch.num_rows, []
        for side in "ab":
            r, h, c = bags(batch.column(f"text_{side}"))
            sides.append((r, h, _weights(c, batch.column(f"held_{side}"), documents)))
        row, hashes, weight = (np.concatenate(x) for x in zip(*sides))
        order = np.lexsort((hashes, row))
        row, hashes, weight = row[order], hashes[order], weight[order]
        twice = np.flatnonzero((row[1:] == row[:-1]) & (hashes[1:] == hashes[:-1])) if len(row) else np.zeros(0, int)
        shared = np.bincount(row[twice], np.minimum(weight[twice], weight[twice + 1]), n)
        whole = np.bincount(row, weight, n) - shared
        alike = (whole > 0) & (shared >= similarity * whole * (1 - 1e-12))
        return {"a": batch.column("a").filter(pa.array(alike)), "b": batch.column("b").filter(pa.array(alike))}

    return map_batches(pairs.select("a", "b", "text_a", "held_a", "text_b", "held_b"), work, "a long, b long")


def block_links(
    nodes: list[int], component: list[int], texts: list[str], held: list[bytes], first: int, documents: int, similarity: float,
) -> list[tuple[int, int]]:
    """Links that unite the components of some texts; two texts at or after ``first`` are not compared.

    ``first`` is the number of texts for one block, or where the second block begins.
    """
    n = len(nodes)
    row, hashes, counts = bags(pa.array(texts, pa.large_string()))
    weight = _weights(counts, held, documents)
    total = np.bincount(row, weight, n)
    _, column, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times[column] > 1
    row_s, column_s, weight_s = row[shared], np.unique(column[shared], return_inverse=True)[1], weight[shared]
    bound = np.zeros((n, n), np.float32)
    order = np.argsort(column_s, kind="stable")
    row_s, column_s, root = row_s[order], column_s[order], np.sqrt(weight_s[order])
    for start in range(0, int(column_s[-1]) + 1 if len(column_s) else 0, 4096):
        a, b = np.searchsorted(column_s, [start, start + 4096])
        part = np.zeros((n, min(4096, int(column_s[-1]) + 1 - start)), np.float32)
        part[row_s[a:b], column_s[a:b] - start] = root[a:b]
        bound += part @ part.T  # the sum of the smaller weights is at most that of the geometric means
    label = {c: c for c in component}

    def find(c: int) -> int:
        while label[c] != c:
            label[c] = label[label[c]]
            c = label[c]
        return c

    places, out = np.searchsorted(row, np.arange(n + 1)), []
    for i in range(min(first, n)):
        near = bound[i] >= similarity * (total[i] + total - bound[i]) * (1 - 1e-4)
        near[: i + 1] = False
        for j in np.flatnonzero(near).tolist():
            u, v = find(component[i]), find(component[j])
            if u == v or not total[j]:
                continue
            _, x, y = np.intersect1d(hashes[places[i] : places[i + 1]], hashes[places[j] : places[j + 1]], True, True)
            least = np.minimum(weight[places[i] + x], weight[places[j] + y]).sum()
            if least >= similarity * (total[i] + total[j] - least) * (1 - 1e-12):
                label[max(u, v)] = min(u, v)
                out.append((nodes[i], nodes[j]))
    return out


def linked_blocks(live: DataFrame, bodies: DataFrame, documents: int, similarity: float) -> DataFrame:
    """a, b: links between components of a bucket; ``live`` has bucket, node and component."""
    members = live.join(bodies, "node")
    size = F.greatest(F.count("*") / BLOCK_ROWS, F.sum(F.octet_length("text")) / BLOCK_BYTES)
    blocks = members.groupBy("bucket").agg(F.ceil(size).cast("int").alias("blocks"))
    member = F.struct("node", "component", "text", "held")
    placed = members.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), "blocks").cast("int"))
    packed = written(placed.groupBy("bucket", "block").agg(F.collect_list(member).alias("members")), live.sparkSession, "blocks")
    pairs = blocks.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumn("b", F.explode(F.sequence("a", F.col("blocks") - 1))).select("bucket", "a", "b")
    side = lambda s: packed.select("bucket", F.col("block").alias(s), F.col("members").alias(f"members_{s}"))
    rows = pairs.join(side("a"), ["bucket", "a"]).join(side("b"), ["bucket", "b"]).select(
        "members_a", F.when(F.col("a") != F.col("b"), F.col("members_b")).alias("members_b"),
    )

    def work(batch: pa.RecordBatch) -> dict:
        links = []
        for a, b in zip(batch.column("members_a").to_pylist(), batch.column("members_b").to_pylist()):
            every = a + (b or [])
            column = lambda name: [m[name] for m in every]  # noqa: B023, E731
            links += block_links(column("node"), column("component"), column("text"), column("held"), len(a), documents, similarity)
        return {"a": [x for x, _ in links], "b": [x for _, x in links]}

    with batches_of(live.sparkSession, 1):
        return written(map_batches(rows, work, "a long, b long"), live.sparkSession, "blocks_near")


def near_links(texts: DataFrame, bodies_of, documents: int, similarity: float = SIMILARITY) -> DataFrame:
    """node, component of the texts that are near another.

    ``texts`` has node and bands; ``bodies_of`` gives node, text and held of some of its rows.
    """
    spark = texts.sparkSession
    buckets = texts.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = written(buckets.join(shared, "bucket"), spark, "buckets")
    used = texts.join(buckets.select("node").distinct(), "node")
    bodies = written(bodies_of(used), spark, "bodies")
    # hubs are the texts with the lowest hashes; a first cut by hash keeps the window small
    order = F.pmod(F.xxhash64("node", "bucket"), F.lit(1 << 30))
    likely = buckets.where(order <= F.lit(64.0 * (1 << 30)) / F.col("n"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(order, "node"))
    hubs = likely.withColumn("place", place).where(F.col("place") <= HUBS).select("bucket", F.col("node").alias("hub"))
    met = buckets.join(hubs, "bucket").where("node <> hub")
    pairs = met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    body = lambda s: bodies.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"), F.col("held").alias(f"held_{s}"))
    with batches_of(spark, PAIR_ROWS):
        links = written(verified(pairs.join(body("a"), "a").join(body("b"), "b"), documents, similarity), spark, "near")
    united = components(links)
    live = buckets.join(united, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    several = live.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    live = written(live.join(several.select("bucket"), "bucket"), spark, "live")
    return components(links.unionByName(linked_blocks(live, bodies, documents, similarity)))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc, key, class_id and stays; the class id is the smallest document id of the class.

    ``key`` is a hash of id and text; one text of each class stays, the one with the class
    id (of several, the one with the lowest hash).
    """
    spark = docs.sparkSession
    doc, text = F.col("doc_id").cast("long"), text_of()
    texts = docs.select(doc.alias("doc"), text.alias("text"), F.md5(text).alias("name"), key_of(docs).alias("key"))
    documents, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    drawn = written(sketches(texts, documents, size), spark, "sketches")
    best = F.min(F.struct(F.col("doc").isNull(), "doc", "key")).alias("best")
    distinct = drawn.groupBy("name").agg(best, F.any_value("bands").alias("bands"), F.any_value("held").alias("held"))
    distinct = distinct.select(F.xxhash64("name").alias("node"), "name", "best.doc", "best.key", "bands", "held")
    distinct = written(distinct, spark, "texts")

    def bodies_of(some: DataFrame) -> DataFrame:
        return texts.select("key", "text").join(some.select("node", "key", "held"), "key").select("node", "text", "held").dropDuplicates(["node"])

    united = near_links(distinct.select("node", "key", "bands", "held"), bodies_of, documents, similarity)
    placed = distinct.join(united, "node", "left").withColumn("component", F.coalesce("component", "node"))
    best = F.min(F.struct(F.col("doc").isNull(), "doc", "key")).alias("best")
    smallest = placed.groupBy("component").agg(best).select("component", "best.doc", "best.key")
    smallest = smallest.select("component", F.col("doc").alias("class_id"), F.col("key").alias("class_key"))
    classes = written(placed.join(smallest, "component").select("name", "class_id", "class_key"), spark, "classes")
    found = drawn.select("doc", "key", "name").join(classes, "name")
    return found.select("doc", "key", "class_id", (F.col("key") == F.col("class_key")).alias("stays"))


def key_of(docs: DataFrame):
    """A document's key: a hash of its id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_of())


def kept_documents(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns; of rows equal in id and text one stays."""
    keys = near_duplicates(docs, similarity).where("stays").select("key").distinct()
    rows = docs.select(key_of(docs).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(keys, "key").dropDuplicates(["key"]).select("row.*")
