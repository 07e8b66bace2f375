"""Rows that repeat a key, column names that clash, and words made to collide."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from pairforge.llm import common, decontam, jaccard, packing, repeats, toxicity
from pairforge.llm.common import BATCH_BYTES, bound_batches, by_flag
from pairforge.llm.shingles import shingle_sets, word_hashes
from pairforge.llm.tokens import _KEPT, PieceMemo, WordEncoder, kept_encoder, load

A = " ".join(f"w{i}" for i in range(60))
NEAR_A = A.replace("w59", "other")
B = " ".join(f"v{i}" for i in range(60))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, component long, k string")
    found = jaccard.one_of_each_class(docs, 5, 80)
    assert found.columns == docs.columns
    return sorted((r["doc_id"] or -1, r["text"]) for r in found.collect())


def test_clean_text_of_a_repeated_key_stays(spark):
    rows = [(1, A, 0, "x"), (5, NEAR_A, 0, "x"), (5, B, 0, "x"), (9, B, 0, "x")]
    assert kept(spark, rows) == [(1, A), (5, B)]


def test_repeated_rows_and_texts_of_one_key(spark):
    rows = [(1, A, 0, "x"), (1, A, 1, "y"), (1, B, 0, "x"), (2, None, 0, "x"), (2, "", 0, "x"), (None, A, 0, "x"), (None, A, 0, "x")]
    found = kept(spark, [r for r in rows if r[1] is not None])
    assert len(found) == 4 and found[:2] == [(-1, A), (-1, A)] and found[2][1] in (A, B) and found[3] == (2, "")
    hashes = {t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] for t in (A, B)}
    assert found[2] == (1, min(hashes, key=hashes.get))
    two_near = kept(spark, [(1, A, 0, "x"), (1, NEAR_A, 0, "x"), (3, A, 0, "x")])
    assert len(two_near) == 1 and two_near[0][0] == 1
    assert kept(spark, []) == []


def test_words_made_to_collide_differ():
    """The Thue-Morse word and its complement meet under any polynomial modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one = bytes(b"ab"[b] for b in bits)
    two = bytes(b"ba"[b] for b in bits)
    sets = shingle_sets([one, two, one, b"x " * 3 + one], 4)
    assert sets[0] != sets[1] and sets[0] == sets[2] and len(sets[3]) == 1


def test_hashes_tell_words_apart():
    words = [f"{i:b}".encode() for i in range(5000)] + [b"z" * n for n in (1, 2, 3, 70_000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - np.array([len(w) for w in words])
    assert len(np.unique(word_hashes(data, starts, ends))) == len(words)
    assert len(word_hashes(data, starts[:0], ends[:0])) == 0


def test_toxicity_with_clashing_names(spark):
    names = ["label_key", "y", "row", "document_key", "toxic", "terms", "t"]
    text = F.when(F.col("doc_id") % 2 == 0, "good words of a calm page").otherwise("vile insult of a group")
    docs = spark.range(400).withColumnRenamed("id", "doc_id").withColumn("text", text)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    wide = docs.withColumns({n: F.lit("?") for n in names})
    model = toxicity.fit_toxicity(wide, labels.withColumn("label_key", F.lit(0)))
    scored = toxicity.toxicity_scores(wide, model)
    assert scored.where("predicted <> doc_id % 2").isEmpty()
    left = toxicity.without_toxic(wide, model)
    assert left.columns == wide.columns and left.where("doc_id % 2 = 1").isEmpty() and left.count() == 200
    empty = wide.limit(0)
    assert toxicity.without_toxic(empty, model).isEmpty()


def test_flags_part_the_rows(spark):
    rows = spark.range(1000).select("id", F.xxhash64("id").alias("h"), F.lit("text").alias("flag"))
    flags = np.zeros(1 << 20, bool)
    for r in rows.where("id < 10").collect():
        flags[(r["h"] % (1 << 64)) >> 44] = True
    some, others = by_flag(rows, "h", flags, True), by_flag(rows, "h", flags, False)
    assert some.columns == rows.columns and some.where("id < 10").count() == 10
    assert some.count() + others.count() == 1000 and others.where("id < 10").isEmpty()


def test_contexts_without_shared_longer_strings_go(spark, monkeypatch):
    """A line of 100 bytes in many texts, its surroundings all different: too short
    for a repeat of 400 bytes, so no context is fetched for it."""
    draw = random.Random(3)
    line = "".join(draw.choice("abcdefgh ") for _ in range(100))

    def words():
        return "".join(draw.choice("klmnopqrst ") for _ in range(500))

    twice = words()
    rows = [(i, words() + line + words()) for i in range(30)] + [(30 + i, words() + twice + words()) for i in range(2)]
    asked, contents = [], repeats._contents
    monkeypatch.setattr(repeats, "_contents", lambda source, contexts, kind: contents(source, asked.append(contexts) or contexts, kind))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in repeats.without_repeats(docs).collect()}
    assert {r["k"] for r in asked[0].collect()} == {30, 31}
    assert got == {i: [(500, 1000)] if i >= 30 else [] for i in range(32)}


def test_parts_of_a_grown_string_are_one_row(spark, monkeypatch):
    """A passage in many texts, met from several anchors and grown in several ways:
    the part around a string at one place goes on once."""
    monkeypatch.setattr(repeats, "SMALL_GROUP", 2)
    written, stored = [], repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda frame, *by: written.append(stored(frame, *by)) or written[-1])
    draw = random.Random(5)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(430))
    around = ["".join(draw.choice("klmnopqrst ") for _ in range(300)) for _ in range(12)]
    docs = spark.createDataFrame([(i, a + passage + a[::-1]) for i, a in enumerate(around)], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in repeats.without_repeats(docs).collect()}
    assert all(len(s) == 1 and 290 < s[0][0] <= 300 and 730 <= s[0][1] < 740 for s in got.values())  # letters beside it may agree
    parts = [frame for frame in written if {"same", "low"} <= set(frame.columns)]
    assert len(parts) > 5
    for frame in parts:
        places = frame.selectExpr("k", "start + low as place")
        assert places.count() == places.distinct().count()


def test_only_shared_sides_of_an_anchor_go_on(spark, monkeypatch):
    """Passages a little too short, in many texts: a string grown to the side where
    the texts differ makes no row."""
    monkeypatch.setattr(repeats, "SMALL_GROUP", 2)
    written, stored = [], repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda frame, *by: written.append(stored(frame, *by)) or written[-1])
    draw = random.Random(6)

    def words(n):
        return "".join(draw.choice("abcdefgh ") for _ in range(n))

    passages = [words(380) for _ in range(8)]
    docs = spark.createDataFrame([(i, "".join(words(300) + p for p in passages) + words(300)) for i in range(6)], "doc_id long, text string")
    assert all(r["spans"] == [] for r in repeats.without_repeats(docs).collect())
    first = next(frame for frame in written if {"same", "low"} <= set(frame.columns))
    assert first.count() > 6 and first.groupBy("group").count().where("count = 1").isEmpty()


def test_rows_without_repeats_skip_python(spark):
    """Only rows that may have repeats go through Python, the others stay as they are."""
    docs = spark.createDataFrame([(1, "é" * 3, 3), (2, None, None), (None, "", 0)], "doc_id long, text string, n_chars int")
    plan = repeats.without_repeats(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("MapInArrow")[0].count("Union") == 1
    got = {r["doc_id"]: (r["n_bytes"], r["spans"], bytes(r["kept"])) for r in repeats.without_repeats(docs).collect()}
    assert got == {1: (6, [], "ééé".encode()), 2: (0, [], b""), None: (0, [], b"")}
    assert sorted(map(str, repeats.texts_without_repeats(docs, 200).collect())) == sorted(map(str, docs.collect()))


def test_batches_are_bounded_in_bytes(spark):
    """10,000 long texts are no batch."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        bound_batches(spark)
        long = spark.range(0, 9000, 1, 1).select(F.expr("repeat('word ', 1000)").alias("t"))
        assert max(r["n"] for r in long.mapInArrow(sizes, "n long").collect()) < 2 * BATCH_BYTES
        spark.conf.set(name, "1m")
        bound_batches(spark)
        assert spark.conf.get(name).startswith("1")
    finally:
        spark.conf.set(name, before)


def test_a_worker_keeps_its_encoder():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = kept_encoder(path)
    first = encoder.encode(["some words, it's 12", "éé\x1c  \n x"])
    asked = []
    encoder.plain.one = lambda piece: asked.append(piece) or b""
    assert kept_encoder(path) is encoder and encoder.encode(["some words, it's 12"]) == first[:1] and not asked
    _KEPT.clear()


def test_texts_are_looked_up_one_at_a_time():
    """The pieces of a text are let go before the next text is cut."""
    encoder, order = WordEncoder(public_tokenizers.path("byte_bpe_50k.json")), []
    cut, one = encoder.pieces.plain, encoder.plain.one
    encoder.pieces.plain = lambda text: order.append("cut") or cut(text)
    encoder.plain.one = lambda piece: order.append(piece) or one(piece)
    texts = ["qqa é", "\tno plain\t text", "qqb é"]
    want = [e.ids for e in encoder.pieces.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert order == ["cut", "qqa", " é", "cut", "cut", "qqb"]


def test_distinct_pieces_are_looked_up_once():
    """op2_best_fit_packing: however often a piece stands in the texts of a batch."""
    asked = []

    class Counted(PieceMemo):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = WordEncoder(path)
    encoder.plain = Counted(encoder._plain)
    texts = ["some Words, " * 200, "it's some 12 words\n" * 100, ""]
    found = encoder.encode(texts)
    assert sorted(asked) == sorted({"some", "words", ",", "it", "'s", "1", "2"})
    library = load(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_of_a_batch_are_those_of_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library, draw = WordEncoder(path), load(path), random.Random(7)
    letters = "stmdrevlaxyz'' \n.,!?0123ÀéßÞÿSTMRELVD"
    texts = ["", "'", " ", "'s", "''s", "it's", "'LL'RE'x", "x'", "x''d'd 1'st", "\n\n'", "é's's", "日本 x's", "a\tb 'll", "a\x1cb"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(2000)]
    texts += [f"it's {t} there" for t in encoder.pieces.special]
    found = encoder.encode(texts)
    for t, x in zip(texts, found, strict=True):
        assert np.frombuffer(x, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert encoder.encode([]) == [] and encoder.encode(["", " \n"]) == [b"", b""]


def test_a_task_hands_back_what_it_has_freed(spark, monkeypatch):
    """pipeline: idle workers count for their executor, so a task's own objects are
    gone, and what they held is handed back, before its worker is idle."""
    events = []

    class Table:
        def __del__(self):
            events.append("freed")

    def run(batches):
        table = Table()
        for batch in batches:
            events.append(batch)
            yield batch
        assert table

    common.hand_back()
    monkeypatch.setattr(common, "hand_back", lambda: events.append("handed back"))
    assert list(common.lean(run)(iter([1, 2]))) == [1, 2] and events == [1, 2, "freed", "handed back"]

    wrapped, lean = [], common.lean
    for module in (decontam, jaccard, packing, repeats):
        monkeypatch.setattr(module, "lean", lambda run: wrapped.append(run) or lean(run))
    docs = spark.createDataFrame([(1, A), (2, A), (3, B)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")
    left = repeats.texts_without_repeats(decontam.texts_without_hits(jaccard.one_of_each_class(docs, 5, 80), items), 200)
    assert packing.packed_documents(left, public_tokenizers.path("word_bpe_49k.json")).count() == 2
    assert {f.__qualname__.split(".")[0] for f in wrapped} >= {"texts_without_hits", "_points", "_firsts", "repeated_spans", "texts_without_repeats", "token_pieces"}


def first_shingles(sets, threshold):
    """(shingle, point, kind) of sets of numbers, in the order of the numbers."""
    rows = []
    for point, s in enumerate(sets):
        for i, w in enumerate(sorted(s)[: jaccard._in_first(len(s), threshold)]):
            rows.append((w, point, 2 * jaccard.size_class(len(s)) + (i < jaccard._in_first_of_smaller(len(s), threshold))))
    return tuple(np.array(column, kind) for column, kind in zip(zip(*rows, strict=True), (np.uint64, np.int64, np.uint8), strict=True))


def test_linked_sets_meet_and_others_stay_out():
    draw = random.Random(11)
    for threshold in (60, 80, 85, 100):
        sets = []
        for _ in range(60):
            base = draw.sample(range(400), draw.randint(1, 60))
            sets += [base, [x if draw.random() < 0.95 else draw.randrange(400) for x in base]]
        sets = [frozenset(s) for s in sets]
        shingle, point, kind = first_shingles(sets, threshold)
        twice = [np.concatenate([x, x]) for x in (shingle, point, kind)]  # copies
        region, member = jaccard.meeting(*twice, jaccard.classes_apart(threshold))
        regions = {}
        for r, p in zip(region.tolist(), member.tolist(), strict=True):
            regions.setdefault(r, set()).add(p)
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) and sets[a] != sets[b]:
                    assert any({a, b} <= found for found in regions.values())
        assert len(regions) and len(member) < len(point)
    small, large = frozenset(range(30)), frozenset(range(300))  # share a first shingle, not their size
    assert not len(jaccard.meeting(*first_shingles([small, large], 80), jaccard.classes_apart(80))[0])


def test_packed_first_shingles_come_back():
    draw = np.random.default_rng(4)
    shingle, point = draw.integers(0, 1 << 64, 3000, np.uint64), draw.integers(-1 << 62, 1 << 62, 3000)
    kind = draw.integers(0, 254, 3000).astype(np.uint8)
    bucket, parts = jaccard.pack_firsts(shingle, point, kind, 7)
    assert bucket.tolist() == list(range(7)) and sum(map(len, parts)) == 3000 * jaccard.FIRST_BYTES
    found = [np.concatenate(x) for x in zip(*map(jaccard.unpack_firsts, parts), strict=True)]
    wanted = zip((shingle & np.uint64((1 << 40) - 1)).tolist(), point.tolist(), kind.tolist(), strict=True)
    assert sorted(zip(*(x.tolist() for x in found), strict=True)) == sorted(wanted)


def test_first_shingles_move_once_and_packed(spark):
    texts = [" ".join(f"{c}{i}" for i in range(400)) for c in "abcdefgh"]
    source = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    packed = jaccard._firsts(source, 5, 80, np.zeros(1 << jaccard.FREQUENCY_BITS, np.int64), 3).collect()
    assert len(packed) <= 2 * 3 and sum(len(row["firsts"]) for row in packed) == 8 * 80 * jaccard.FIRST_BYTES
    assert not jaccard._members(spark.createDataFrame(packed), 80).count()


def test_points_that_meet_in_several_regions_go_on_once(spark):
    sets = {p: np.arange(300, dtype=np.uint64) + np.uint64(q) for p, q in ((5, 0), (6, 1), (9, 900), (-3, 2000), (-2, 3000))}
    one = spark.createDataFrame([(p, len(s), bytearray(jaccard.sketch(s))) for p, s in sets.items()], "point long, n long, sketch binary")
    rows = [(-3, 5), (-3, 6), (-3, -3), (-2, 5), (-2, 6), (-2, -2), (5, 5), (5, 6)]
    members = spark.createDataFrame(rows, "region long, point long")
    one = one.withColumn("sketch", F.when(F.col("point") < 0, F.lit(bytearray(b"\x09" * 256))).otherwise(F.col("sketch")))
    found = jaccard._with_partner(members, one, 80).collect()
    assert sorted(map(tuple, found)) == [(5, 5, 300), (5, 6, 300)]


def test_texts_that_stay_are_not_moved(spark, monkeypatch):
    """Only rows whose hash is flagged go into the join with what is dropped."""
    seen, old = [], jaccard._parted
    monkeypatch.setattr(jaccard, "_parted", lambda *given: seen.append(old(*given)) or seen[-1])
    rows = [(1, A, 0, "x"), (5, NEAR_A, 0, "x"), (5, B, 0, "x"), (9, B, 0, "x"), *((20 + i, f"alone {i}", 0, "x") for i in range(200))]
    found = kept(spark, rows)
    assert len(found) == 202 and found[:2] == [(1, A), (5, B)]
    sure, rest = (frame.count() for frame in seen[0])
    assert sure + rest == len(rows) and rest <= 5


def test_flags_of_other_widths(spark):
    hashes = spark.range(500).select(F.xxhash64("id").alias("h"))
    for bits in (8, 23):
        flags = common.hash_flags(hashes.where("h % 5 = 0"), bits)
        assert len(flags) == 1 << bits and flags.any()
        some, none = by_flag(hashes, "h", flags, True), by_flag(hashes, "h", flags, False)
        assert some.count() + none.count() == 500 and some.where("h % 5 = 0").count() == hashes.where("h % 5 = 0").count()
