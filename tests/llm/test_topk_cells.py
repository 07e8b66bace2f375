"""Top-k search by cells: exact scores, hot rows, plans, one tree a shard."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pairforge.llm import topk


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, min(max(-s, topk.LEAST), topk.MOST)) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def answer(frame, k):
    return sorted(map(tuple, topk.top_k(frame.where("id % 50 = 0"), frame, k).collect()))


@pytest.mark.parametrize("scale", [1, 1 << 24, 1 << 29])
def test_scores_are_exact_at_every_size(spark, monkeypatch, scale):
    """Up to 2^53, up to 2^63, and neighbours that differ in the last unit only."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 30)
    monkeypatch.setattr(topk, "GROUP_SHARDS", 2)
    draw = random.Random(scale)
    rows = [(i, [float(scale * draw.choice([1, -1, 2]) + draw.randrange(-2, 3)) for _ in range(4)]) for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, v array<double>")
    assert answer(frame, 5) == brute(rows, rows[::50], 5)


def test_scores_beyond_64_bits_are_the_ends_of_the_range(spark):
    rows = [(0, [2.0**60, 0.0]), (1, [2.0**60, 1.0]), (2, [-(2.0**60), 0.0]), (3, [2.0**61, 0.0]), (4, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "id long, v array<double>")
    assert answer(frame, 4) == [(0, 1, 1, topk.MOST), (0, 2, 3, topk.MOST), (0, 3, 4, 2**60), (0, 4, 2, topk.LEAST)]


def test_a_third_of_all_rows_is_one_row(spark, monkeypatch):
    """Equal rows count each, though no more than k of them are ever moved."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 20)
    rows = [(i, [float(i % 7), float(i % 11)]) for i in range(200)] + [(77, [9.0, 9.0])] * 100
    frame = spark.createDataFrame(rows, "id long, v array<double>")
    assert answer(frame, 3) == brute(rows, rows[:200:50], 3)


def test_queries_without_candidates_of_their_length(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0]), (50, [1.0, 1.0])], "id long, v array<double>")
    assert answer(frame, 5) == [(50, 1, 1, 3)]
    assert answer(frame.where("id = 0"), 5) == []


def test_no_exchange_by_vector_length_alone(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    plans, built = [], []
    stored = topk.stored

    def watched(frame, *by):
        text = frame._jdf.queryExecution().toString()
        plans.append(text)
        back = stored(frame, *by)
        if "tree" in frame.columns:
            built.append(back.select("dims", "shard").count() == back.select("dims", "shard").distinct().count() > 10)
        return back

    monkeypatch.setattr(topk, "stored", watched)
    frame = spark.createDataFrame([(i, [float(i % 13), float(i % 17)]) for i in range(600)], "id long, v array<double>")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert topk.top_k(frame.where("id % 50 = 0"), frame, 5).count() == 12 * 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    text = "\n".join(plans)
    assert built == [True]
    assert "hashpartitioning(dims#" in text
    assert not [line for line in text.split("\n") if "hashpartitioning(dims#" in line and "block#" not in line and "shard#" not in line]


def test_pruning_skips_nodes():
    """With a floor from elsewhere, far nodes are never scored."""
    draw = np.random.default_rng(4)
    near, far = draw.integers(900, 1000, (2048, 8)).astype(float), draw.integers(-1000, -900, (2048, 8)).astype(float)
    tree = topk.BallTree(np.arange(4096), np.vstack([near, far]))
    seen = []
    inner = topk.inner
    topk.inner = lambda a, b: seen.append(len(b)) or inner(a, b)
    try:
        tree.search(np.array([-1]), np.full((1, 8), 5.0), 5, np.array([topk.NONE]))
    finally:
        topk.inner = inner
    assert sum(seen) <= 2048
