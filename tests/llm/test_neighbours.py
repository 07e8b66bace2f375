"""Approximate neighbours against brute force: scores, order, recall, odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from pairforge.llm import neighbours
from pairforge.llm.queries import QUERIES


def brute(rows, asked, k):
    """{query: [(rank, id, score)]} over (id, vector) rows, by cosine, then id."""
    out = {}
    for query, q in asked:
        scored = []
        for i, v in rows:
            if i != query and len(v) == len(q):
                a, b = np.array(q, float), np.array(v, float)
                scored.append((-float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), i))
        scored.sort()
        out[query] = [(r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def answers(frame):
    got: dict = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


@pytest.fixture(scope="module")
def cloud(spark):
    x = np.random.default_rng(1).normal(size=(6000, 24))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def recall(got, want):
    hit = sum(len({i for _, i, _ in got.get(q, ())} & {i for _, i, _ in rows}) for q, rows in want.items())
    return hit / sum(map(len, want.values()))


def test_query_recall_and_scores(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = answers(QUERIES["op13_nearest_neighbours"](spark, sf_dir))
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        exact = {i: s for _, i, s in brute(rows, [(q, dict(rows)[q])], len(rows))[q]}
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in found)
        assert [s for _, _, s in found] == sorted((s for _, _, s in found), reverse=True)


def test_descent_mends_the_graph(spark, cloud, monkeypatch):
    """The rounds of NN-descent find edges that the first blocks missed."""
    monkeypatch.setattr(neighbours, "TREES", 2)  # one alone has no edge that leaves a block
    x, frame = cloud
    nodes = neighbours.nodes_of(neighbours.usable_vectors(frame, "vec_id", "embedding"), 6)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = np.argsort(-(unit @ unit.T), axis=1)[:, 1:11]
    of_node = {r["node"]: r["members"][0] for r in nodes.select("node", "members").collect()}

    def share(edges):
        found: dict = {}
        for r in edges.collect():
            found.setdefault(of_node[r["node"]], set()).add(of_node[r["id"]])
        return np.mean([len(found.get(i, set()) & set(near[i].tolist())) / 10 for i in range(len(x))])

    first = neighbours.first_edges(nodes)
    before, after = share(first), share(neighbours.descend(nodes, first, 3))
    assert before < 0.8 and after > before + 0.1, (before, after)


def test_recall_over_all(spark, cloud):
    x, frame = cloud
    vectors = neighbours.usable_vectors(frame, "vec_id", "embedding")
    got = answers(neighbours.nearest(vectors.where("id % 100 = 0"), vectors, 10))
    rows = list(enumerate(x))
    assert recall(got, brute(rows, rows[::100], 10)) >= 0.9


def test_hot_vector_and_foreign_queries(spark):
    """A third of the rows hold one vector; queries need not be in the table."""
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(7)
    hot = answers(neighbours.nearest(frame.where("id in (0, 9, 900)"), frame, 5))
    assert [i for _, i, _ in hot[0]] == [3, 6, 9, 12, 15]
    assert [i for _, i, _ in hot[9]] == [0, 3, 6, 12, 15]
    assert [i for _, i, _ in hot[900]] == [0, 3, 6, 9, 12]
    foreign = [(-5, [1.0, 2.0, 3.1]), (10**6, rng.normal(size=3).tolist())]
    got = answers(neighbours.nearest(spark.createDataFrame(foreign, "id long, v array<double>"), frame, 5))
    assert [i for _, i, _ in got[-5]] == [i for _, i, _ in brute(rows, foreign[:1], 5)[-5]]
    assert recall(got, brute(rows, foreign, 5)) >= 0.9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.0, 1.0], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1),
        (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [2.0, 0.1], 1), (8, [2.0, 0.1], 1), (8, [2.0, 0.1], 1), (9, [1.0, 1.0, 1.0], 1), (10, [1e200, 1e200], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int")
    vectors = neighbours.usable_vectors(frame, "vec_id", "embedding")
    assert sorted(r["id"] for r in vectors.collect()) == [0, 0, 7, 8, 8, 9, 10]
    got = answers(neighbours.nearest(vectors, vectors, 3))
    assert [i for _, i, _ in got[0]] == [7, 8, 8]
    assert [i for _, i, _ in got[7]] == [8, 8, 0]
    assert [i for _, i, _ in got[8]] == [7, 0, 10]
    assert 9 not in got and abs(got[10][0][2] - 2**-0.5) < 0.1
    none = vectors.where("false")
    assert neighbours.nearest(vectors, none, 3).count() == 0
    assert neighbours.nearest(none, vectors, 3).count() == 0
