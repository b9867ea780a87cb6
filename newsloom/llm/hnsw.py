"""Operator 8: embedding near-duplicates by navigable small-world graphs, one per shard.

Vectors of one label (and length) are dealt by hash to shards of about ``SHARD`` vectors. Each
shard gets a hierarchical small-world graph, and the vectors of every shard of the
label are searched in every graph of the label, in blocks of one shard against one graph. Beams
are as wide as they must be: a query whose beam is full of links is searched again with
a wider one, and in every block a sample of queries is compared with all vectors of the shard. The sample
grows until it has seen ``SEEN`` true links; where all queries have too few, all are compared. The
block is searched again with wider beams until the sample's recall reaches ``RECALL``, at last
over all vectors. Candidates are verified by their cosine in double precision.

Equal vectors are one node with a number of copies, so copies are never linked one by one.
Links become components, and each component is known by its smallest id.

Edge cases: a vector that is null, empty or zero, holds a null or a component that is not finite,
or has no label, links with nothing; vectors of different lengths are not compared; rows with
the same id and vector count as copies of each other; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import map_batches, mix, written
from newsloom.llm.components import components

SIMILARITY = 0.93
SHARD = 2048
DEGREE = 16
BEAM = 32
AUDITED = 64
SEEN = 200  # true links, so that the sample tells a recall of RECALL
RECALL = 0.99
EXPANDED = 4
QUERIES = 1024
SCAN = 8  # a beam of an eighth of the shard costs more than comparing all


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    scale = np.abs(wide).max(1, keepdims=True)
    wide = wide / scale
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _diverse(unit: np.ndarray, near: np.ndarray, score: np.ndarray, degree: int) -> np.ndarray:
    """At most ``degree`` candidates a row, each nearer to the row than to those chosen before.

    ``near`` is in falling order of ``score``; -1 is no candidate.
    """
    points = unit[np.maximum(near, 0)]
    between = np.einsum("qid,qjd->qij", points, points)
    chosen = np.zeros(near.shape, bool)
    for i in range(near.shape[1]):
        blocked = (chosen & (between[:, i] > score[:, i : i + 1])).any(1)
        chosen[:, i] = (near[:, i] >= 0) & ~blocked & (chosen.sum(1) < degree)
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :degree]
    return np.where(np.take_along_axis(chosen, order, 1), np.take_along_axis(near, order, 1), -1)


class Graph:
    """Layers of neighbour tables over the unit vectors of one shard; the last is the base."""

    def __init__(self, unit: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.unit, self.layers = unit, layers

    @classmethod
    def build(cls, unit: np.ndarray, degree: int = DEGREE) -> "Graph":
        n = len(unit)
        levels = [np.arange(n)]
        rank = np.argsort(mix(np.arange(n, dtype=np.uint64)), kind="stable")
        while len(levels[-1]) > 2 * degree:
            levels.append(rank[: len(levels[-1]) // degree])
        graph = cls(unit, [])
        for number, members in enumerate(reversed(levels)):
            base = number == len(levels) - 1
            graph._insert(members if not base else rank, degree, 2 * degree if base else degree)
        return graph

    def _insert(self, members: np.ndarray, degree: int, most: int) -> None:
        """A layer that holds ``members``: inserted in batches that double its size."""
        table = np.full((len(self.unit), most), -1, np.int32)
        upper = self.layers
        first = members[: 4 * degree]
        self._link(table, first, first, degree)
        done = len(first)
        while done < len(members):
            new = members[done : 2 * done]
            self.layers = [*upper, (table, members[:done])]
            near = np.concatenate([self.search(self.unit[new[i : i + QUERIES]], 2 * degree)[0] for i in range(0, len(new), QUERIES)])
            self._link(table, new, new, degree, near)
            done += len(new)
        self.layers = [*upper, (table, members)]

    def _link(self, table: np.ndarray, new: np.ndarray, peers: np.ndarray, degree: int, near: np.ndarray | None = None) -> None:
        """Join new nodes to the best of their candidates, both ways, and prune full rows."""
        unit, most = self.unit, table.shape[1]
        k = min(2 * degree, len(peers) - 1)
        for start in range(0, len(new), QUERIES):
            part = new[start : start + QUERIES]
            score = unit[part] @ unit[peers].T
            score[part[:, None] == peers[None, :]] = -2
            best = np.argpartition(-score, max(0, k - 1), axis=1)[:, :k] if k > 0 else np.zeros((len(part), 0), int)
            lists = [peers[best]] + ([near[start : start + QUERIES]] if near is not None else [])
            near_all = np.concatenate(lists, 1)
            own = np.einsum("qd,qnd->qn", unit[part], unit[np.maximum(near_all, 0)])
            own[near_all < 0] = -2
            order = np.argsort(-own, 1)
            picked = _diverse(unit, np.take_along_axis(near_all, order, 1), np.take_along_axis(own, order, 1), degree)
            table[part, : picked.shape[1]] = picked
        # the way back: old and new neighbours of every touched node, the most diverse kept
        source = np.repeat(new, table.shape[1])
        target = table[new].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        touched = np.unique(target)
        has = table[touched]
        a = np.concatenate([source, has[has >= 0]])
        b = np.concatenate([target, np.repeat(touched, (has >= 0).sum(1))])
        pairs = np.unique(np.stack([b, a], 1), axis=0)
        score = np.einsum("nd,nd->n", unit[pairs[:, 0]], unit[pairs[:, 1]])
        order = np.lexsort((-score, pairs[:, 0]))
        pairs, score = pairs[order], score[order]
        begin = np.searchsorted(pairs[:, 0], touched)
        place = np.arange(len(pairs)) - np.repeat(begin, np.diff(np.append(begin, len(pairs))))
        width = 2 * most
        kept = place < width
        row = np.searchsorted(touched, pairs[:, 0])
        near_all = np.full((len(touched), width), -1, np.int64)
        own = np.full((len(touched), width), -2, np.float32)
        near_all[row[kept], place[kept]] = pairs[kept, 1]
        own[row[kept], place[kept]] = score[kept]
        full = (near_all >= 0).sum(1) > most
        table[touched[~full]] = near_all[~full, :most]
        rows = np.flatnonzero(full)
        for start in range(0, len(rows), QUERIES):
            r = rows[start : start + QUERIES]
            table[touched[r]] = _diverse(unit, near_all[r], own[r], most)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes found for each query, with their cosines; -1 is none."""
        start = None
        for number, (table, members) in enumerate(self.layers):
            last = number == len(self.layers) - 1
            if start is None:
                start = np.repeat(members[None, : 4 * EXPANDED], len(queries), 0)
            start, score = self._layer(queries, start, table, beam if last else EXPANDED)
        return start, score

    def _layer(self, queries: np.ndarray, start: np.ndarray, table: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        unit, count = self.unit, len(queries)
        beam = max(beam, 1)
        seen = np.zeros((count, len(unit) + 1), bool)
        ids = np.full((count, beam), -1, np.int64)
        score = np.full((count, beam), -2.0, np.float32)
        open_ = np.zeros((count, beam), bool)
        rows, fresh = np.arange(count), start
        while True:
            fresh = np.sort(fresh, 1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            fresh = np.where(seen[rows[:, None], fresh], -1, fresh)  # column -1 is never seen
            seen[rows[:, None], fresh] = True
            seen[:, -1] = False
            own = np.einsum("qd,qnd->qn", queries[rows], unit[np.maximum(fresh, 0)])
            own[fresh < 0] = -2
            all_ids = np.concatenate([ids[rows], fresh], 1)
            all_score = np.concatenate([score[rows], own], 1)
            all_open = np.concatenate([open_[rows], fresh >= 0], 1)
            best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
            ids[rows], score[rows], open_[rows] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_score, all_open))
            rows = rows[open_[rows].any(1)]
            if not len(rows):
                break
            ranked = np.where(open_[rows], score[rows], -3)
            take = np.argsort(-ranked, 1)[:, :EXPANDED]
            live = np.take_along_axis(open_[rows], take, 1)
            open_[rows[:, None], take] = False
            nodes = np.where(live, np.take_along_axis(ids[rows], take, 1), -1)
            fresh = np.where(nodes[:, :, None] >= 0, table[np.maximum(nodes, 0)], -1).reshape(len(rows), -1)
        return ids, score


def links_between(graph: Graph, own: np.ndarray, other: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Queries ``own`` and nodes of the graph over ``other`` whose cosine reaches ``similarity``; the audited recall."""
    queries = _unit(own)
    slack = similarity - 1e-4
    found: list[tuple[np.ndarray, np.ndarray]] = []
    order = np.argsort(mix(np.arange(len(queries), dtype=np.uint64) + np.uint64(len(other))))
    sample, truth = order[:0], np.zeros((0, len(other)), bool)
    while len(sample) < len(queries) and truth.sum() < SEEN:
        more = order[len(sample) : max(AUDITED, 2 * len(sample))]
        sample, truth = np.append(sample, more), np.concatenate([truth, queries[more] @ graph.unit.T >= slack])
    beam, recall = BEAM, 1.0
    q, node = np.nonzero(truth)
    q = sample[q]  # of all queries, if links are few
    while len(sample) < len(queries):
        beam = min(beam, len(other))
        pending, found = np.arange(len(queries)), []
        width = beam
        while len(pending):
            again = []
            for start in range(0, len(pending), QUERIES):
                part = pending[start : start + QUERIES]
                if width * SCAN >= len(other):
                    q, node = np.nonzero(queries[part] @ graph.unit.T >= slack)
                    found.append((part[q], node))
                    continue
                ids, score = graph.search(queries[part], width)
                full = (score >= slack).all(1)  # a beam full of links may hide more
                q, at = np.nonzero((score >= slack) & ~full[:, None])
                found.append((part[q], ids[q, at]))
                again.append(part[full])
            pending, width = (np.concatenate(again) if again else np.zeros(0, int)), min(4 * width, len(other))
        q, node = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
        got = np.zeros((len(queries), len(other)), bool) if len(queries) * len(other) < 1 << 27 else None
        if got is not None:
            got[q, node] = True
            recall = (got[sample] & truth).sum() / truth.sum()
        else:
            pairs = set(zip(q.tolist(), node.tolist()))
            recall = sum((int(sample[i]), int(j)) in pairs for i, j in zip(*np.nonzero(truth))) / max(1, truth.sum())
        if recall >= RECALL or beam * SCAN >= len(other):
            break
        beam *= 2
    a, b = own[q].astype(np.float64), other[node].astype(np.float64)
    norm = lambda x: np.sqrt(np.einsum("nd,nd->n", x, x))
    cosine = np.einsum("nd,nd->n", a, b) / (norm(a) * norm(b))
    good = cosine >= similarity
    return q[good], node[good], float(recall)


def _vectors(lists: pa.Array) -> np.ndarray:
    values = np.asarray(lists.flatten(), np.float64)
    return values.reshape(len(lists), -1)


def usable(name: str = "embedding"):
    """Whether a vector can be compared: finite, complete and not zero."""
    wide = F.col(name).cast("array<double>")
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(name) > 0) & finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def linked_vectors(vectors: DataFrame, similarity: float = SIMILARITY, shard_size: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    spark = vectors.sparkSession
    good = usable() & F.col("label").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(good, F.col("embedding").cast("array<double>")).alias("embedding"), "label",
    )
    node = F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")).alias("node")
    rows = written(rows.select("vec_id", node, "label", "embedding"), spark, "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("label").alias("label"),
        F.any_value("embedding").alias("embedding"),
    ).withColumn("dim", F.size("embedding"))
    nodes = written(nodes, spark, "nodes")
    shards = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_size).cast("int").alias("shards"))
    placed = nodes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node", F.lit(1)), "shards").cast("int"))
    packed = placed.groupBy("label", "dim", "shard").agg(F.collect_list(F.struct("node", "embedding")).alias("members"))
    graphs = written(map_batches(packed, _build, GRAPH), spark, "graphs")
    pairs = shards.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    pairs = pairs.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select("label", "dim", "a", "b")
    asked = graphs.select("label", "dim", F.col("shard").alias("a"), F.col("nodes").alias("nodes_a"), F.col("vectors").alias("vectors_a"))
    graph = graphs.select("label", "dim", F.col("shard").alias("b"), F.col("nodes").alias("nodes_b"), F.col("vectors").alias("vectors_b"), "sizes", "tables")
    blocks = pairs.join(asked, ["label", "dim", "a"]).join(graph, ["label", "dim", "b"])
    links = map_batches(blocks, _searcher(similarity), "a long, b long").where("a <> b")
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), spark, "vector-links")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("linked"))
    united = nodes.select("node", "first", "copies").join(components(edges), "node", "left").join(degree, "node", "left")
    united = united.withColumn("component", F.coalesce("component", "node"))
    smallest = united.groupBy("component").agg(F.min("first").alias("component_id"))
    found = united.join(smallest, "component").select("node", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = written(found, spark, "linked")
    out = rows.select("vec_id", "node").join(found, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


GRAPH = "label int, dim int, shard int, nodes array<long>, vectors binary, sizes array<int>, tables binary"


def _build(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {k: [] for k in ("nodes", "vectors", "sizes", "tables")}
    for members in batch.column("members"):
        order = np.argsort(np.asarray(members.values.field("node")))  # the same graph however rows arrive
        vectors = _vectors(members.values.field("embedding"))[order]
        graph = Graph.build(_unit(vectors))
        out["nodes"].append(np.asarray(members.values.field("node"))[order])
        out["vectors"].append(vectors.tobytes())
        out["sizes"].append([x for table, members_ in graph.layers for x in (table.shape[1], len(members_))])
        out["tables"].append(b"".join(table.tobytes() + members_.astype(np.int32).tobytes() for table, members_ in graph.layers))
    return {k: batch.column(k) for k in ("label", "dim", "shard")} | out


def _read(nodes: int, dim: int, vectors: bytes, sizes: list[int], tables: bytes) -> tuple[Graph, np.ndarray]:
    own = np.frombuffer(vectors, np.float64).reshape(nodes, dim)
    flat, at, layers = np.frombuffer(tables, np.int32), 0, []
    for width, count in zip(sizes[::2], sizes[1::2]):
        table = flat[at : at + nodes * width].reshape(nodes, width)
        at += nodes * width
        layers.append((table, flat[at : at + count]))
        at += count
    return Graph(_unit(own), layers), own


def _searcher(similarity: float):
    def work(batch: pa.RecordBatch) -> dict:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(batch.num_rows):
            of = lambda name: batch.column(name)[i]  # noqa: B023, E731
            dim = of("dim").as_py()
            nodes_a, nodes_b = (np.asarray(of(c).values) for c in ("nodes_a", "nodes_b"))
            graph, other = _read(len(nodes_b), dim, of("vectors_b").as_py(), of("sizes").as_py(), of("tables").as_py())
            own = np.frombuffer(of("vectors_a").as_py(), np.float64).reshape(len(nodes_a), dim)
            q, node, _ = links_between(graph, own, other, similarity)
            a.append(nodes_a[q])
            b.append(nodes_b[node])
        return {"a": np.concatenate(a), "b": np.concatenate(b)}

    return work
