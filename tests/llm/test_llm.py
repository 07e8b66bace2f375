"""The training-data operators against brute force, round trips and held-out rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairforge.llm import blocks, counts, decontam, factorization, jaccard, packing, quality, repeats, shingles, topk, toxicity, warc
from pairforge.llm.components import components
from pairforge.llm.queries import ORACLE, QUERIES
from pairforge.llm.tokens import load
from tests.compare import connect, difference, spark_rows, sql_rows

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, k string, t string, row int, score double"  # extra columns clash with inner names
ODD = [
    "",
    " \n\t",
    "a\x1cb it's I'LL x<|endoftext|>y <|startoftext|>",
    "¼ İstanbul ΣΑΣ ẞ ﬁ 日本語　テキスト 🙂👍🏽 é a\xa0b",
    "word " * 40_000,
    "x" * 70_000,
    None,
]


def documents(spark, texts, first=0):
    rows = [(first + i, t, "k", "t", 1, 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a row repeated as a whole, a repeated key, and a null key."""
    again = [(2, ODD[2], "k", "t", 1, 0.5), (1, "other", "k", "t", 1, 0.5), (None, "no key", "k", "t", 1, 0.5)]
    return documents(spark, ODD).unionByName(spark.createDataFrame(again, DOCS)).coalesce(2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def encoded(path, texts):
    library = load(path)
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_counts(spark, odd, empty):
    rows = counts.token_counts(odd, WORD, limit=100).collect()
    want = collections.Counter()
    for key, text in odd.select("doc_id", "text").collect():
        n = len(encoded(WORD, [text])[0])
        want[key, len((text or "").encode()), n, n > 100] += 1
    assert collections.Counter(map(tuple, rows)) == want
    assert counts.token_counts(empty, WORD).count() == 0


def test_chunk_maps_compose():
    counter, text = counts.TokenCounter(WORD), "  Ab cdé's<|endoftext|>,  xyz\nlonger words HERE 42 "
    want = len(encoded(WORD, [text])[0])
    for size in (1, 2, 3, 7, 19):
        assert counter._long([text[i : i + size] for i in range(0, len(text), size)]) == want


def test_token_blocks(spark, odd, empty):
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 1000):
        for top in (1, 2, 300, 2**32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            assert (blocks.unpack(blocks.pack(ids)) == ids).all()
    rows = blocks.read_token_blocks(blocks.write_token_blocks(odd, BYTE)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in odd.collect()), key=lambda x: (x is not None, x or 0))
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows[:-1]]).tolist()
    want = collections.Counter((k, crc(encoded(BYTE, [t])[0] + [0])) for k, t in odd.select("doc_id", "text").collect())
    assert collections.Counter((r["doc_id"], r["ids_crc32"]) for r in rows) == want
    assert blocks.read_token_blocks(blocks.write_token_blocks(empty, BYTE)).count() == 0


def check_packing(rows, texts, limit):
    place = collections.defaultdict(list)
    for r in rows:
        place[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in place.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts[:-1]]).tolist()
        assert sum(n for _, n in parts) <= limit
    want = collections.Counter()
    for key, text in texts:
        ids = encoded(WORD, [text])[0] + [0]
        for p in range(0, len(ids), limit):
            want[key, p // limit, p, len(ids[p : p + limit]), crc(ids[p : p + limit])] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    return len(place)


def test_packing(spark, odd, empty, sf_dir):
    check_packing(packing.packed_documents(odd, WORD, limit=50).collect(), odd.select("doc_id", "text").collect(), 50)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.packed_documents(docs, WORD).collect()
    bins = check_packing(rows, docs.select("doc_id", "text").collect(), 2048)
    assert bins <= -(-sum(r["length"] for r in rows) // 2048) + 1
    assert packing.packed_documents(empty, WORD).count() == 0


def test_genes_are_whole_bins():
    draw = random.Random(5)
    lengths = [draw.randint(1, 60) for _ in range(300)]
    a, b = (packing.best_fit([], draw.sample(range(300), 300), lengths, 100) for _ in range(2))
    child = packing.crossover(a, b, lengths, 100, draw)
    assert sorted(i for g in child for i in g) == list(range(300))
    assert all(sum(lengths[i] for i in g) <= 100 for g in child)
    best = packing.evolve([], lengths, 100, draw)[0]
    assert len(best) <= len(a) and packing._as_bins(packing._as_bytes(best, 300)) is not None


def brute_classes(rows, words, threshold):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    label = list(range(len(rows)))
    for _ in rows:  # to a fixed point
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) and label[a] != label[b]:
                    old, new = max(label[a], label[b]), min(label[a], label[b])
                    label = [new if x == old else x for x in label]
        break
    out = collections.Counter()
    for (key, _), s, mine in zip(rows, sets, label, strict=True):
        keys = [k for (k, _), x in zip(rows, label, strict=True) if x == mine and k is not None]
        out[key, len(s), min(keys) if s and keys else key] += 1
    return out


@pytest.mark.parametrize("leaf", [1024, 17])
def test_near_duplicates(spark, odd, empty, monkeypatch, leaf):
    monkeypatch.setattr(jaccard, "LEAF_POINTS", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    draw = random.Random(2)
    base = [f"w{draw.randint(0, 500)}" for _ in range(60)]
    texts = []
    for i in range(70):  # one group of near copies, around the threshold
        copy = list(base)
        for _ in range(draw.randint(0, 3)):
            copy[draw.randrange(60)] = f"x{draw.randint(0, 30)}"
        texts.append(" ".join(copy) if i % 9 else " ".join(draw.sample(base, 20)))
    docs = documents(spark, texts, 100).unionByName(odd)
    for words, threshold in ((4, 85), (5, 80)):
        got = collections.Counter(map(tuple, jaccard.near_duplicates(docs, words, threshold).collect()))
        assert got == brute_classes(docs.select("doc_id", "text").collect(), words, threshold)
    kept = jaccard.one_of_each_class(docs, 5, 80)
    assert kept.columns == docs.columns and kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    assert jaccard.near_duplicates(empty, 4, 85).count() == 0


def test_triangle_window():
    """A linked point is in the window of the other's nearest pivot."""
    draw = np.random.default_rng(3)
    sets = [frozenset(draw.choice(60, 40, replace=False).tolist()) for _ in range(60)]
    far = lambda a, b: 1 - len(a & b) / len(a | b)
    pivots = sets[:6]
    for x in sets:
        for y in sets:
            if far(x, y) <= 0.35:
                home = min(pivots, key=lambda p: far(x, p))
                assert far(y, home) <= min(far(y, p) for p in pivots) + 0.7 + 1e-9


def test_shingle_sets_match_words():
    texts = [b"A b\x0bC  d e", b"a B c D E ", b"", None, b"one two", b"ONE\ttwo", b"two one"]
    sets = [set(s.tolist()) for s in shingles.shingle_sets(texts, 4)]
    assert sets[0] == sets[1] and len(sets[0]) == 2 and not sets[2] and not sets[3]
    assert sets[4] == sets[5] != sets[6]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 5), (200, 201), (202, 201), (300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 1 for i in [*range(1, 41), 100]) and got[202] == got[201] == got[200] == 200


def brute_hits(rows, items, size):
    split = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = collections.defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    out = collections.Counter()
    for key, text in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out[key, len(w), len(hit), tuple(sorted(found))] += 1
    return out


def test_contamination(spark, odd, empty):
    draw = random.Random(4)
    word = lambda: f"w{draw.randint(0, 6)}"
    items = [(i, " ".join(word() for _ in range(draw.randint(0, 6)))) for i in range(25)] + [(25, None), (26, "w1 ZZ"), (26, "q")]
    texts = [" ".join(word() for _ in range(draw.randint(0, 60))) + draw.choice(["", " Q", "-zz w1!zz"]) for _ in range(80)]
    docs = documents(spark, texts, 100).unionByName(odd)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contamination(docs, bench, window=4)
    size = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    got = collections.Counter((r[0], r[1], r[2], tuple(r[3])) for r in found.select("doc_id", "n_words", size, "items").collect())
    assert got == brute_hits(docs.select("doc_id", "text").collect(), items, 4)
    cut = decontam.texts_without_hits(docs, bench, window=4)
    assert cut.columns == docs.columns and cut.where("doc_id is null").count() == 1
    assert decontam.contamination(empty, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).where("size(items) > 0").count() == 0


def test_fm_index_ranks_and_locates():
    draw = np.random.default_rng(6)
    symbols = np.append(draw.integers(0, 5, 400), 0)
    index = decontam.FMIndex(symbols, 7)
    windows = np.array([[1, 2], [4, 4], [7, 1], [3, 1]])
    low, high = index.search(windows)
    for w, a, b in zip(windows, low, high, strict=True):
        want = [i for i in range(400) if symbols[i : i + 2].tolist() == w.tolist()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute_repeats(rows, length):
    texts = [(k, (t or "").encode()) for k, t in rows]
    seen = collections.Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = collections.Counter()
    for key, t in texts:
        cover = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                cover[p : p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, cover, strict=True) if not c)
        out[key, len(t), len(re.findall(rb"\x01+", bytes(cover))), hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize(("group", "shard"), [(1024, 1 << 21), (2, 200)])
def test_repeats(spark, empty, monkeypatch, group, shard):
    monkeypatch.setattr(repeats, "SMALL_GROUP", group)
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard)
    draw = random.Random(3)
    base = ["".join(draw.choice("abc") for _ in range(40)) for _ in range(3)]
    texts = ["".join(draw.choice(base)[draw.randint(0, 5) : draw.randint(20, 40)] + draw.choice(["", "x", "yz"]) for _ in range(draw.randint(0, 3))) for _ in range(60)]
    texts += ["", None, "a" * 50, "é" * 30, "aé" * 30, texts[3]]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.where("doc_id = 7")).unionByName(spark.createDataFrame([(None, texts[9], "k", "t", 1, 0.5)], DOCS))
    for length in (12, 21):
        rows = repeats.without_repeats(docs, length, anchor=4).collect()
        got = collections.Counter((r["doc_id"], r["n_bytes"], len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)
        assert got == brute_repeats(docs.select("doc_id", "text").collect(), length)
    cut = repeats.texts_without_repeats(docs, 21)
    assert cut.columns == docs.columns and cut.where("text is null").count() == 1
    assert repeats.without_repeats(empty).count() == 0


@pytest.mark.parametrize("length", [12, 90])
def test_repeats_in_pieces(spark, monkeypatch, length):
    """What stands once is no repeat where a long text is cut; what stands twice is."""
    monkeypatch.setattr(repeats, "PIECE", 300)
    draw = random.Random(5)
    long = ["".join(draw.choice("abcdefgh") for _ in range(n)) for n in (599, 601, 1500, 2000)]
    texts = [*long, long[2][250:400] + "zz" + long[3][550:950], long[3] + long[3][:700], "é" * 700]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.where("doc_id = 1"))
    for frame in (docs, documents(spark, long[2:])):
        rows = repeats.without_repeats(frame, length, anchor=8).collect()
        got = collections.Counter((r["doc_id"], r["n_bytes"], len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)
        assert got == brute_repeats(frame.select("doc_id", "text").collect(), length)


def test_run_index_in_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 100)
    draw = random.Random(8)
    text = "".join(draw.choice("ab") for _ in range(900)).encode()
    whole = set(zip(*(x.tolist() for x in repeats.anchors([text], 20, 6)[1:]), strict=True))
    parts = set()
    for low, a, b, piece in repeats._pieces(text, 20):
        for place, s, e, x, y in zip(*(v.tolist() for v in repeats.anchors([piece], 20, 6)[1:]), strict=True):
            if low + place + 6 > a and low + place < b + 20:
                parts.add((low + place, low + s, low + e, x, y))
    assert whole <= parts


def test_archives(spark):
    cut = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nz\r\n\r\n" * 9
    rows = [(1, "http://WWW.a.com:80/x?y#z", "<p>hi</p>" * 20), (2, None, "<p>hi</p>" * 20), (3, "http://b.org", None), (4, "b.org/\r\nX: y", cut), (5, "q", "\r\n\r\n"), (6, "q", "é\r\n\r\n"), (7, "q", ""), (8, "u", cut), (None, "u", "é" * 60), (9, "u", "é" * 60), (9, "u", "é" * 60), (10, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: ")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    back = warc.read_archives(spark, warc.write_archives(pages)).collect()
    kinds = sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in back)
    assert len(back) == 12 and ("2", "revisit", 1) in kinds and ("8", "revisit", 4) in kinds and ("None", "revisit", 9) in kinds
    assert sum(k == ("9", "response", None) for k in kinds) == 1 == sum(k == ("9", "revisit", 9) for k in kinds)
    payloads = {(k, h or "") for k, _, h in rows}
    for r in back:
        if r["record_type"] == "response":
            assert (r["page_id"], r["payload"]) in payloads
            assert r["payload_digest"] == hashlib.sha256(r["payload"].encode()).hexdigest() and r["payload_bytes"] == len(r["payload"].encode())
    index = warc.capture_index(warc.read_archives(spark, warc.write_archives(pages))).collect()
    order = [(r["url_key"], r["captured_at"], r["page_id"] is not None, r["page_id"] or 0) for r in index]
    assert order == sorted(order) and len(order) == 12
    assert warc.capture_index(warc.read_archives(spark, warc.write_archives(pages.limit(0)))).count() == 0


def test_archives_of_raw_records(spark):
    """Payloads that form the cut together with the end of their own header."""
    raw = warc.BEGIN + "response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    texts = [raw, "\r\n" + raw, warc.END + raw, raw + raw, warc.BEGIN, warc.BEGIN[:-1], "plain", "\r\n"]
    pages = spark.createDataFrame([(i, "u", t) for i, t in enumerate(texts)], "page_id long, url string, html string").repartition(2)
    back = warc.read_archives(spark, warc.write_archives(pages)).collect()
    assert sorted((r["page_id"], r["payload"]) for r in back) == list(enumerate(texts))


def test_loser_tree():
    draw = random.Random(1)
    for k in (0, 1, 2, 3, 7, 12):
        runs = [sorted(draw.randint(0, 9) for _ in range(draw.randint(0, 8))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    draw = random.Random(9)
    rows = [(i, [draw.choice([-0.5, 0.25, 0.0078, 0.01]) for _ in range(3 if i % 5 else 4)]) for i in range(500)]
    rows += [(500, None), (501, []), (502, [1.0, None, 2.0]), (503, [1.0, float("nan"), 0.0]), (504, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]), (50, rows[50][1])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, v string")
    vectors = topk.integer_vectors(frame, "vec_id", "embedding")
    got = collections.defaultdict(list)
    for r in topk.top_k(vectors.where("id % 50 = 0"), vectors, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows[:500] + rows[-1:]]
    for q, v in good[:500:50]:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v))
        assert got[q] == [(i, -s) for s, i in scored[:5]]
    assert topk.top_k(vectors.limit(0), vectors, 5).count() == 0 == topk.top_k(vectors, vectors.limit(0), 5).count()


def test_machine_learns_pairs():
    """Only both terms together make a row positive."""
    draw = np.random.default_rng(2)
    rows = [np.flatnonzero(draw.random(12) < 0.5).astype(np.int32) for _ in range(3000)]
    y = np.array([float(1 in r and 2 in r) for r in rows])
    held = slice(2400, None)
    wrong = {}
    for factors in (0, 8):
        model = factorization.FactorizationMachine(16, factors, epochs=40).fit(rows[:2400], y[:2400])
        wrong[factors] = ((model.scores(rows[held]) >= 0.5) != (y[held] > 0.5)).mean()
    assert wrong[8] <= wrong[0] and wrong[8] < 0.05


def held_rates(spark, frame, sf_dir, label, column):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = frame.where("held_out").join(labels, "doc_id").select(F.col(column).cast("int"), label).collect()
    hits = sum(a == b for a, b in rows)
    return hits / len(rows), len(rows)


def test_toxicity_on_held_out_rows(spark, odd, empty):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    right, n = held_rates(spark, toxicity.toxicity_scores(docs, model), sf_dir, "toxic", "predicted")
    assert n > 500 and right > 0.96
    assert toxicity.toxicity_scores(odd, model).where("score between 0 and 1 and predicted in (0, 1)").count() == odd.count()
    assert toxicity.toxicity_scores(empty, model).count() == 0
    none = toxicity.fit_toxicity(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.toxicity_scores(odd, none).where("score = 0.5").count() == odd.count()
    assert toxicity.without_toxic(odd, none, 0.6).columns == odd.columns


def test_long_rows_are_fitted():
    """Rows of 13 million terms together: each of them reaches the fit."""
    row, n = np.arange(130_000, dtype=np.int32), 100
    batches = (pa.RecordBatch.from_arrays([pa.array([i % 2], pa.int32()), pa.array([row[i:].tobytes()], pa.binary())], names=["y", "terms"]) for i in range(n))
    with toxicity.sampled_rows(batches) as (rows, y):
        assert [len(r) for r in rows] == [len(row) - i for i in range(n)] and y.tolist() == [i % 2 for i in range(n)]
        assert all((r == row[i:]).all() for i, r in enumerate(rows))
    with toxicity.sampled_rows(iter(())) as (rows, y):
        assert not rows and not len(y)


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    right, n = held_rates(spark, quality.quality_scores(docs, model), sf_dir, "quality", "keep")
    assert n > 500 and right > 0.97
    bare = spark.createDataFrame([(None, None, None, None, None, "x")], "doc_id long, text string, lang string, source string, n_chars long, size string")
    assert quality.quality_scores(bare, model).where("score between 0 and 1").count() == 1
    nothing = quality.fit_quality(bare.limit(0), spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.quality_scores(bare, nothing).count() == 1


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twins(spark, sf_dir, name):
    assert difference(spark_rows(QUERIES[name](spark, sf_dir)), sql_rows(connect(sf_dir), ORACLE[name])) is None


def test_pipeline_stages(spark, sf_dir):
    """Each stage against what brute force keeps of its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = f"{spark.sparkContext.getCheckpointDir()}/stage-{len(frames)}-{random.random()}"
        stage(spark, frames[-1], sf_dir).write.parquet(path)
        frames.append(spark.read.parquet(path))
    texts = [{r["doc_id"]: r["text"] for r in f.collect()} for f in frames[:-1]]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert texts[1].items() <= texts[0].items() and len(texts[1]) > 0.8 * len(texts[0])
    classes = brute_classes(sorted(texts[1].items()), 5, 80)
    assert set(texts[2]) == {least for _, _, least in classes}
    for key, _, _, kept in brute_repeats(sorted(texts[2].items()), corpus_pipeline.REPEAT_BYTES):
        if key in texts[3] and all(ord(c) < 128 for c in texts[2][key]):
            assert hashlib.sha256(texts[3][key].encode()).hexdigest() == kept
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    clean = {key for key, _, hit, _ in brute_hits(sorted(texts[3].items()), items, 10) if not hit}
    assert all(texts[4][k] == texts[3][k] for k in clean)
    check_packing(frames[-1].collect(), sorted(texts[4].items()), 2048)
