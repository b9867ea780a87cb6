import numpy as np
import pytest

from newsloom.llm import hnsw, registry
from newsloom.llm.components import components
from tests.llm.cases import save

SF = "/root/testdata/sf0.01"


def brute(rows, similarity=0.93):
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i in range(len(rows))}
    for n, i in enumerate(good):
        for j in good[:n]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= similarity:
                links[i].add(j)
                links[j].add(i)
    seen, out = {}, {}
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        for j in group:
            seen[j] = min(rows[k][0] for k in group)
    for i, (vec_id, *_) in enumerate(rows):
        out[vec_id] = (len(links[i]), seen[i], vec_id == seen[i])
    return out


def run(spark, folder):
    return {r.vec_id: tuple(r)[1:] for r in registry.op8_hnsw(spark, folder).collect()}


def test_given_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    expected = brute(rows)
    assert run(spark, SF) == expected


def test_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    vectors = [
        None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 0.0], [1.0, 0.0], [2.0, 0.1], [1.0, 0.0, 0.0], [-1.0, 0.0], [1e-30, 0.0], [1e30, 1e28],
    ]
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)] + [(20, [1.0, 0.0], None, "x"), (21, [1.0, 0.0], 2, "x"), (22, [1.0, 0.01], 2, "x")]
    save(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component string"), tmp_path, "embeddings")
    assert run(spark, str(tmp_path)) == brute([r[:3] for r in rows])


def test_clusters_over_several_shards(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    points = [(centres[rng.integers(30)] + rng.normal(size=16) * rng.choice([0.05, 0.15])).tolist() for _ in range(900)] + [centres[0].tolist()] * 300
    rows = [(i, v, 1) for i, v in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: tuple(r)[1:] for r in hnsw.linked_vectors(df, shard_size=200).collect()}
    expected = brute(rows)
    assert sum(n for n, *_ in got.values()) >= 0.99 * sum(n for n, *_ in expected.values())
    assert all(got[i][0] <= expected[i][0] for i in got)


@pytest.mark.parametrize("n", [1, 2, 3, 40, 500])
def test_graph_search(n):
    rng = np.random.default_rng(n)
    vectors = rng.normal(size=(n, 8))
    graph = hnsw.Graph.build(hnsw._unit(vectors))
    ids, score = graph.search(graph.unit, min(n, 32))
    true = np.sort(graph.unit @ graph.unit.T, 1)[:, ::-1][:, : min(n, 10)]
    found = np.sort(score, 1)[:, ::-1][:, : min(n, 10)]
    assert (np.abs(true - found) < 1e-5).mean() > 0.95


@pytest.mark.parametrize("task_edges", [1 << 20, 25])
def test_components(spark, task_edges):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long").repartition(6), task_edges).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[202] == 200


def test_empty_table(spark, tmp_path):
    save(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), tmp_path, "embeddings")
    assert run(spark, str(tmp_path)) == {}


def test_sparse_pairs_over_graphs(spark):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(4000, 64))
    points[3800:] = points[:200] + 0.3 * rng.normal(size=(200, 64))
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(points.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in hnsw.linked_vectors(df, shard_size=1000).collect()}
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    expected = (unit @ unit.T >= 0.93).sum(1) - 1
    assert expected.sum() > 300
    assert got == dict(enumerate(expected.tolist()))


def test_links_that_the_graph_misses_are_found():
    class Blind(hnsw.Graph):
        def search(self, queries, beam):
            return np.full((len(queries), beam), -1), np.full((len(queries), beam), -2.0, np.float32)

    rng = np.random.default_rng(9)
    other, own = rng.normal(size=(1000, 64)), rng.normal(size=(1000, 64))
    own[::400] = other[::400] + 0.1
    q, node, recall = hnsw.links_between(Blind(hnsw._unit(other), []), own, other, 0.93)
    assert sorted(zip(q.tolist(), node.tolist())) == [(0, 0), (400, 400), (800, 800)] and recall == 1
