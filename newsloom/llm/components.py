"""Connected components by local contraction and alternating large-star and small-star steps.

An edge table is rewritten until nothing changes; then every node points at the smallest
node of its component. Each round first contracts the edges in tasks of ``TASK_EDGES`` at most to
stars around their smallest nodes. Contraction is repeated while it lets the table fit
fewer tasks; what one task holds is then done. Otherwise a large-star and a small-star step follow. They group by node
and take a minimum, so a hub's edges are pre-aggregated and never collected; the
join back is on the node, which Spark splits where it is hot. Every round's table is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.arrays import written
from newsloom.session import ship_package


TASK_EDGES = 1 << 20


def smallest_of(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node that each is connected with."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches]
    if parts:
        node, root = smallest_of(*(np.concatenate(x) for x in zip(*parts)))
        other = node != root
        yield pa.RecordBatch.from_pydict({"u": node[other], "v": root[other]})


def _tasks(links: DataFrame, task_edges: int) -> int:
    return max(1, -(-links.count() // task_edges))


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """node, component: for all nodes of the edges ``a``, ``b``; self-links and nulls are ignored."""
    spark = edges.sparkSession
    ship_package(spark)
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = written(links, spark, "links")
    state = None
    while True:
        tasks, before = _tasks(links, task_edges), None
        while tasks != before:
            links = written(links.coalesce(tasks).mapInArrow(_contract, "u long, v long"), spark, "links")
            tasks, before = (_tasks(links, task_edges) if tasks > 1 else 1), tasks
        if tasks == 1:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), spark, "links")
        # the links are the same as before when their number and the sum of their hashes are
        found = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            break
        state = tuple(found)
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return roots.unionByName(links.select(F.col("u").alias("node"), F.col("v").alias("component")))
