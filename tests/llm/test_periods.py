"""Periodic runs against a definition-by-definition search."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairforge.llm import periods
from pairforge.llm.queries import QUERIES


def brute(words: list, exponent: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, exponent * q):
                out.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((a, size, q) for (a, size), q in out.items())


def ours(docs: list[list]) -> list[list[tuple[int, int, int]]]:
    words = [[str(w).encode() for w in doc] for doc in docs]
    return [[tuple(r) for r in rows.tolist()] for rows in periods._batch_runs(words, 4, 6)]


def test_runs_equal_brute_force():
    rng = random.Random(5)
    docs = [[], ["x"], ["x"] * 6, ["x"] * 5, list("ab") * 4, list("abc") * 4 + list("ab")]
    for _ in range(400):
        doc: list = []
        for _ in range(rng.randint(1, 5)):
            unit = [rng.choice("abc") if rng.random() < 0.5 else rng.randint(0, 40) for _ in range(rng.choice([1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64]))]
            times = rng.choice([1, 2, 3, 4, 5, 9])
            doc += (unit * times)[: len(unit) * times - rng.randint(0, len(unit) - 1)]
        docs.append(doc)
    docs += [[rng.choice("ab") for _ in range(rng.randint(1, 300))] for _ in range(100)]
    assert ours(docs) == [brute(doc) for doc in docs]


def test_every_scale_finds_its_periods():
    rng = random.Random(6)
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 255, 256, 257]:
        unit = [rng.randint(0, 10**9) for _ in range(q)]
        for extra in (0, 1):
            doc = [-1] + unit * 4 + unit[:extra] + [-2] * 3
            want = brute(doc)
            assert (1, 4 * q + extra, q) in want or q == 1
            assert ours([doc]) == [want]


def test_minimizers_are_needed(monkeypatch):
    """Without seeds only the lags that are scanned find runs."""
    unit = list(range(20))
    monkeypatch.setattr(periods, "_seeds", lambda names, scale: (np.empty(0, int), np.empty(0, int)))
    assert ours([unit * 5, list("abc") * 5]) == [[], [(0, 15, 3)]]


def test_one_long_document():
    rng = random.Random(7)
    unit = [rng.randint(0, 50) for _ in range(30_000)]
    doc = [rng.randint(0, 50) for _ in range(1000)] + unit * 4 + ["z"] * 20
    found = ours([doc])[0]
    assert (1000, 120_000, 30_000) in found
    assert found[-1][1:] == (20, 1)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "x x x x x x x", "c"), (2, "é é é é é é", None), (2, "é é é é é é", None), (4, " \t\n", "d"), (5, "x x " * 6, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = periods.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    out = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect())
    assert out == [
        (0, 7, [(0, 7, 1)], "x"),
        (1, 0, [], ""),
        (2, 0, [], ""),
        (2, 6, [(0, 6, 1)], "é"),
        (2, 6, [(0, 6, 1)], "é"),
        (4, 0, [], ""),
        (5, 6, [(0, 6, 1)], "x x"),
    ]
    assert periods.periodic_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periods.runs_of(np.arange(9), np.arange(9), 9, exponent=3)


def test_planted_tail(spark, sf_dir):
    """The query's own damage, and what comes out of it, over whole documents."""
    import hashlib
    import re
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    planted = 0
    for row in docs.select("doc_id", F.col("text")).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute(words)
        drop = {i for a, size, q in runs for i in range(a + q, a + size)}
        r = got[row["doc_id"]]
        text = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
        left = " ".join(w for i, w in enumerate(words) if i not in drop)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["n_runs"] == len(runs)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(left.encode()).hexdigest()
    assert planted > 5
