"""Vocabulary token counts and learned abbreviations against plain Python."""

from __future__ import annotations

import collections
import math
import random
import re

from pairforge.operators.abbreviations import abbreviations, sentences_with_abbreviations
from pairforge.operators.vocabulary import vocabulary_token_counts


def greedy(word, pieces):
    at = n = 0
    while at < len(word):
        at += max((len(p) for p in pieces if p and word.startswith(p, at)), default=1)
        n += 1
    return n


def test_longest_match_counts(spark):
    draw = random.Random(5)
    texts = [" ".join("".join(draw.choice("abcñ") for _ in range(draw.randint(1, 9))) for _ in range(30)) for _ in range(40)]
    texts += ["", None, " .!", "abc" * 900 + " ab", "AB ab Ab", "日本語🙂 日本"]
    pieces = ["a", "ab", "abc", "bca", "cab", "ñ", "aab", "日本", "", "ab", None, "bcabcabcab"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    vocabulary = spark.createDataFrame([(p,) for p in pieces], "piece string")
    known = [p for p in pieces if p]
    for table, used in ((vocabulary, known), (vocabulary.limit(0), [])):
        got = {r["k"]: (r["n_words"], r["n_tokens"]) for r in vocabulary_token_counts(docs, ["k"], table).collect()}
        want = {}
        for k, text in enumerate(texts):
            said = re.findall(r"[^\W_]+", (text or "").lower())
            want[k] = (len(said), sum(greedy(w, used) for w in said))
        assert got == want
    assert vocabulary_token_counts(docs.limit(0), ["k"], vocabulary).isEmpty()


def test_pieces_across_blocks(spark):
    """A word of many blocks: pieces that begin in one and end in the next count."""
    word = "abcdefg" * 300
    docs = spark.createDataFrame([(1, word), (2, word + " " + word)], "k long, text string")
    vocabulary = spark.createDataFrame([("abcdefg",)], "piece string")
    got = {r["k"]: r["n_tokens"] for r in vocabulary_token_counts(docs, ["k"], vocabulary).collect()}
    assert got == {1: 300, 2: 600}


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b")], "k long, text string")
    vocabulary = spark.createDataFrame([("a",)], "piece string")
    for frame in (vocabulary_token_counts(docs, ["k"], vocabulary), abbreviations(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


SEEDED = ["El dr. Pino dice hola al equipo. Usa sal, p.ej. la fina, y ya.", "Vive aquí la sra. Paz desde hoy? No. Sí."]


def corpus(spark):
    draw = random.Random(3)
    words = [f"palabra{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(10)]
    texts = []
    for _ in range(400):
        said = [draw.choice(words) for _ in range(12)]
        said.insert(draw.randrange(11), draw.choice(["dr.", "p.ej.", "sra."]))
        texts.append(" ".join(said) + ".")
    return spark.createDataFrame(list(enumerate([*texts, *SEEDED, "", None, "...", "1.5 y 2.5"])), "k long, text string")


def test_seeded_abbreviations_are_found(spark):
    docs = corpus(spark)
    got = {r["word"]: r for r in abbreviations(docs).collect()}
    assert set(got) == {"dr", "p.ej", "sra"}
    counts = collections.Counter()
    for r in docs.where("text is not null").collect():
        counts.update((t.rstrip("."), t.endswith(".")) for t in re.findall(r"[^\W_][\w.]*", r["text"].lower()))
    share = sum(n for (_, dot), n in counts.items() if dot) / sum(counts.values())
    for word, inner in (("dr", 0), ("p.ej", 1), ("sra", 0)):
        k, plain = counts[word, True], counts[word, False]
        ratio = 2 * (k * math.log(0.99) + plain * math.log(0.01) - k * math.log(share) - plain * math.log(1 - share))
        chars = len(word) - inner
        want = ratio * math.exp(-chars) * (inner + 1) * chars ** -plain
        assert (got[word]["n_period"], got[word]["n_plain"]) == (k, plain)
        assert math.isclose(got[word]["score"], want, rel_tol=1e-9)
    assert abbreviations(docs.limit(0)).isEmpty()


def test_no_split_at_abbreviations(spark):
    texts = [*SEEDED, "", None, "...", "Mide 1.5 m. y pesa. Fin", "a dr.", "dr. dr. x. y", "Fin... dr.. z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    found = sentences_with_abbreviations(docs, ["k"], abbreviations(corpus(spark)))
    got = collections.defaultdict(list)
    for r in found.orderBy("k", "sentence").collect():
        assert r["sentence"] == len(got[r["k"]])
        got[r["k"]].append(r["body"])
    assert got == {
        0: ["El dr. Pino dice hola al equipo.", "Usa sal, p.ej. la fina, y ya."],
        1: ["Vive aquí la sra. Paz desde hoy?", "No.", "Sí."],
        5: ["Mide 1.5 m.", "y pesa.", "Fin"],
        6: ["a dr."],
        7: ["dr. dr. x.", "y"],
        8: ["Fin...", "dr..", "z"],
    }


def test_split_of_very_long_texts(spark):
    texts = ["word " * 40_000, "x" * 70_000 + ".", "1." * 30_000 + "1. b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    known = spark.createDataFrame([("dr",)], "word string")
    sizes = {r["k"]: r["n"] for r in sentences_with_abbreviations(docs, ["k"], known).groupBy("k").count().withColumnRenamed("count", "n").collect()}
    assert sizes == {0: 1, 1: 1, 2: 2}


def test_pieces_of_one_frequent_word_are_spread(spark):
    docs = spark.createDataFrame([(i, f"a dr. b{i} dr. c. d") for i in range(50)], "k long, text string")
    found = sentences_with_abbreviations(docs, ["k"], spark.createDataFrame([("dr",), ("dr",), (None,)], "word string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[_word#\d+, _part#\d+\]", plan)
    got = {(r["k"], r["sentence"]): r["body"] for r in found.collect()}
    assert got == {(i, n): b for i in range(50) for n, b in enumerate([f"a dr. b{i} dr. c.", "d"])}
