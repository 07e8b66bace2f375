"""Golden rows and properties of the table operators."""

from __future__ import annotations

import collections
import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge import schemas
from pairforge.operators import lengths, ordering, pages, pairs, questions, recipes, split, summary, video

META = (1, "R", "basic_recipe", "conceptual", "beginner", "N/A", "Ecuador")
CHAT = [("system", "s"), ("user", "u")]


def pair(messages=CHAT, chosen="c" * 50, rejected="r" * 20, metadata=META):
    return (messages, chosen, rejected, metadata)


CASES = {
    "ok": (pair(), []),
    "short_chosen": (pair(chosen="c" * 49), ["short_chosen"]),
    "short_rejected": (pair(rejected="r" * 19), ["short_rejected"]),
    "same": (pair(chosen="x" * 60, rejected="x" * 60), ["same_reply"]),
    "three": (pair(messages=[*CHAT, ("user", "v")]), ["bad_messages"]),
    "swapped": (pair(messages=CHAT[::-1]), ["bad_messages"]),
    "no_messages": (pair(messages=None), ["no_messages", "bad_messages"]),
    "null_chosen": (pair(chosen=None), ["no_chosen"]),
    "no_id": (pair(metadata=(None, *META[1:])), ["incomplete_metadata"]),
    "no_metadata": (pair(metadata=None), ["no_metadata", "incomplete_metadata"]),
}


def test_pair_validation(spark):
    frame = spark.createDataFrame([case[0] for case in CASES.values()], schemas.DPO_PAIR)
    got = [row["defects"] for row in pairs.pair_defects(frame).collect()]
    assert got == [case[1] for case in CASES.values()]
    assert pairs.valid_pairs(frame).count() == 1


def test_map_metadata_needs_only_the_key(spark):
    full = {"recipe_id": None, "recipe_name": "R", "category": "c", "context": "x"}
    rows = [pair(metadata=full), pair(metadata={k: v for k, v in full.items() if k != "recipe_id"})]
    frame = spark.createDataFrame(rows, schemas.DPO_PAIR_MAP)
    assert pairs.valid_pairs(frame, metadata="map").count() == 1


def test_conversations_round_trip_through_training_rows(spark):
    frame = spark.createDataFrame([pair(), pair(chosen="otra " * 20)], schemas.DPO_PAIR)
    rows = pairs.preference_rows(pairs.to_conversations(frame))
    assert {(r["chosen"], r["rejected"]) for r in rows.collect()} == {
        (r["chosen"], r["rejected"]) for r in frame.collect()
    }


def test_invalid_preference_rows_stay_as_empty_text(spark):
    say = [("user", "q"), ("assistant", "r")]
    rows = [(1, say, say), (2, [], say), (3, say, say[1:]), (4, say[::-1], say), (5, None, say)]
    kind = "array<struct<role:string,content:string>>"
    frame = spark.createDataFrame(rows, f"id int, chosen {kind}, rejected {kind}")
    got = {r["id"]: (r["prompt"], r["chosen"], r["rejected"]) for r in pairs.preference_rows(frame).collect()}
    prompt = "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n"
    assert got == {1: (prompt, "r", "r")} | {i: ("", "", "") for i in (2, 3, 4, 5)}
    assert pairs.preference_rows(frame, drop_invalid=True).count() == 1


def test_multi_turn_filter_keeps_unmarked_rows(spark):
    rows = [(1, "multi_turn"), (2, "single_turn"), (3, None)]
    frame = spark.createDataFrame(rows, "id int, kind string").withColumnRenamed("kind", "metadata.type")
    assert {r["id"] for r in pairs.drop_multi_turn(frame).collect()} == {2, 3}


def test_one_conversation_with_most_turns_is_split_into_blocks(spark):
    turns = spark.range(10_000).select(
        F.when(F.col("id") < 4000, 0).otherwise(F.col("id")).alias("conv_id"),
        F.when(F.col("id") < 4000, F.col("id")).otherwise(0).alias("turn"),
        F.lit("user").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    folded = pairs.fold_turns(turns, block_size=500)
    hot = folded.filter("conv_id = 0").orderBy("block").collect()
    assert [r["block"] for r in hot] == list(range(8))
    assert [m["content"] for r in hot for m in r["conversation"]] == [str(i) for i in range(4000)]
    assert folded.filter("conv_id <> 0").count() == 6000


def test_hot_recipe_joins_and_blocks(spark):
    bank = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).alias("recipe_id"),
        F.concat(F.lit("q"), F.col("id").cast("string")).alias("questions"),
        F.lit("General").alias("questions_category"),
        F.lit("conceptual").alias("question_type"),
        F.floor(F.col("id") / 3).alias("position"),
    )
    recipe = spark.createDataFrame([(1, "R"), (None, "N"), (0, "Z"), (5, "Q")], "id long, nombre string")
    assert recipes.recipe_questions(recipe, bank).count() == 3000
    assert recipes.estimated_pairs(recipe, bank).first()[0] == 3000
    assert [r["id"] for r in recipes.recipes_without_questions(recipe, bank).collect()] == [5]
    blocks = questions.questions_by_recipe(bank, block_size=1000).filter("recipe_id = 1").orderBy("block")
    assert [r["n_questions"] for r in blocks.collect()] == [1000, 1000, 1000]


def test_missing_replies_fall_back_to_text_that_passes_validation(spark):
    asked = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d")], "recipe_id long, question string")
    said = spark.createDataFrame(
        [(1, "a", "x" * 60, "y" * 30), (1, "b", None, "y"), (2, "c", "x", None)],
        "recipe_id long, question string, chosen string, rejected string",
    )
    got = {r["question"]: r for r in recipes.attach_responses(asked, said).collect()}
    assert [got[q]["is_fallback"] for q in "abcd"] == [False, True, True, True]
    assert (got["d"]["chosen"], got["d"]["rejected"]) == (K.FALLBACK_CHOSEN, K.FALLBACK_REJECTED)
    assert (len(K.FALLBACK_CHOSEN), len(K.FALLBACK_REJECTED)) == (65, 67)


def test_transcripts_and_votes(spark):
    recipe = spark.createDataFrame(
        [(1, ""), (2, "https://x.test/"), (3, "https://youtu.be/aa"), (4, "https://youtu.be/bb"), (5, None)],
        "id long, youtube_url string",
    )
    parts = spark.createDataFrame([("aa", i, f"s{i}") for i in range(5)], "video_id string, seq int, text string")
    told = video.attach_transcripts(recipe, parts, block_size=2)
    got = [(r["id"], r["transcript_block"], r["youtube_transcript"]) for r in told.collect()]
    assert sorted(got) == [
        (1, 0, K.NO_VIDEO_URL),
        (2, 0, K.BAD_VIDEO_URL),
        (3, 0, "s0 s1"),
        (3, 1, "s2 s3"),
        (3, 2, "s4"),
        (4, 0, f"{K.TRANSCRIPT_ERROR}: bb."),
        (5, 0, K.NO_VIDEO_URL),
    ]
    seen = spark.createDataFrame([("aa", '"likes":7'), (None, '"likes":9')], "video_id string, html string")
    votes = {r["id"]: r["votos"] for r in video.attach_votes(recipe, seen).collect()}
    assert votes == {1: None, 2: 0, 3: 7, 4: 0, 5: None}


def test_length_report_counts_blank_and_long_rows(spark):
    def talk(words):
        return None if words is None else [("user", "w " * words)]

    rows = [(1, talk(5), talk(5)), (2, talk(30), talk(5)), (3, talk(30), talk(40)), (4, None, None), (5, None, talk(3))]
    kind = "array<struct<role:string,content:string>>"
    measured = lengths.with_lengths(spark.createDataFrame(rows, f"id int, chosen {kind}, rejected {kind}"))
    report = lengths.length_report(measured, 20).first().asDict()
    assert report == {
        "analyzed": 4, "skipped": 1, "exceeding": 2, "exceeding_pct": 40.0, "within_limit": 2,
        "within_pct_reported": 60.0, "within_pct_exact": 40.0, "chosen_exceeds": 2, "rejected_exceeds": 1,
        "both_exceed": 1,
    }
    kept = {r["id"] for r in lengths.length_filter(measured, 20).collect()}
    long_ones = {r["index"] for r in lengths.long_examples(measured, "id", 20).collect()}
    blanks = {r["id"] for r in lengths.blank_pairs(measured).collect()}
    assert (kept, long_ones, blanks) == ({1, 5}, {2, 3}, {4})
    assert [r["index"] for r in lengths.sample_long(measured, "id", 20).collect()] == [2, 3]


# --- summaries, by brute force ---------------------------------------------------


def brute_summary(value, k, stop):
    if not value or value.startswith(("Error", K.TRANSCRIPT_MISSING)):
        return value
    parts = [s.strip() for s in re.findall(r"[^.!?]+[.!?]*", value)]
    parts = [s for s in parts if s]
    if len(parts) <= k:
        return value

    def tokens(s):
        return [w for w in re.findall(r"[^\W_]+", s.lower()) if w not in stop]

    freq = collections.Counter(w for s in parts for w in tokens(s))
    scores = {i: sum(freq[w] for w in tokens(s)) for i, s in enumerate(parts) if tokens(s)}
    best = sorted(sorted(scores), key=lambda i: -scores[i])[:k]
    return " ".join(parts[i] for i in sorted(best))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab cd.!? \n", max_size=80), min_size=1, max_size=12))
def test_summary_equals_brute_force(spark, texts):
    rows = list(enumerate([*texts, "Error a. b. c. d.", "", "a. a. b. b. c. c.", "z z. y. x. w. v."]))
    frame = spark.createDataFrame(rows, "id int, text string")
    got = summary.extractive_summary(frame, ["id"], "text", 2, ["a"]).collect()
    assert {r["id"]: r["summary"] for r in got} == {i: brute_summary(t, 2, {"a"}) for i, t in rows}


def test_default_stop_words(spark):
    assert {"de", "la", "que"} <= set(summary.default_stop_words())


# --- splits and packing ----------------------------------------------------------


@pytest.mark.parametrize(("n", "size"), [(0, 0), (1, 1), (19, 1), (20, 1), (21, 2), (1000, 50)])
def test_exact_split_sizes(spark, n, size):
    rows = split.train_test_split(spark.range(n), "id", 0.05).collect()
    assert sum(r["split"] == "test" for r in rows) == size == math.ceil(n * 0.05 - 1e-9)
    assert len(rows) == n


def test_packing_fills_every_block_but_the_last(spark):
    texts = [(i, " ".join(f"t{i}x{j}" for j in range(i % 17))) for i in range(300)]
    pieces = split.pack_sequences(spark.createDataFrame(texts, "id int, text string"), "id", "text", 64)
    blocks = split.packed_blocks(pieces).orderBy("block").collect()
    total = sum(i % 17 for i in range(300))
    assert [b["n_tokens"] for b in blocks] == [64] * (total // 64) + [total % 64]
    whole = {}
    for row in pieces.orderBy("key", "token_from").collect():
        whole.setdefault(row["key"], []).append(row["piece"])
    assert {k: "".join(v) for k, v in whole.items()} == {i: t for i, t in texts if t}


# --- pages -----------------------------------------------------------------------

FULL = """<!DOCTYPE html><html><head><meta property="og:image" content="http://x/og.png"></head><body>
<div class="featured-image"><p><img src="/feat.png"></p></div><h1 class="big entry-title"> Tarta &amp; pan </h1>
<div class="entry-content x"><p>Intro <a href="https://site.test/a?x=1&amp;y=2">A</a><a href="/b">B</a></p>
<h2><strong>Ingredientes</strong></h2><p>nota</p><ul><li> sal </li><li>pan<li>agua</ul>
<div><p>inner</p></div><h3>Preparación</h3><p>Uno</p><p> </p><p>Dos</p><div>x</div><p>Tres</p>
<iframe src="https://other.test/e"></iframe><iframe src='https://www.youtube.com/embed/abc?x'></iframe>
<a href="https://site.test/a?x=1&amp;y=2">again</a><a href="https://site.test/r#comments">c</a></div>
<footer><p>foot</p><a href="https://site.test/out">o</a></footer></body></html>"""
PARAGRAPHS = """<div class="entry-content"><p>Ingrediente principal</p><p>sal, pimienta
 agua,,http://z</p><p>Se necesita:</p><p>horno</p><p>p4</p><p>Hace falta ingrediente</p><img src="../i/a.png"></div>"""


def page_rows(spark, *htmls):
    rows = [(i, "https://site.test/r/one", h) for i, h in enumerate(htmls)]
    frame = spark.createDataFrame(rows, schemas.PAGE)
    return {r["page_id"]: r for r in pages.recipe_records(frame).collect()}


def content(body):
    return f'<div class="entry-content">{body}</div>'


def test_full_page(spark):
    row = page_rows(spark, FULL)[0]
    assert row["title"] == "Tarta & pan"
    assert row["image_url"] == "/feat.png"
    assert row["youtube_url"] == "https://www.youtube.com/embed/abc?x"
    assert row["ingredients"] == ["sal", "pan", "agua"]
    assert row["instructions"] == "Uno\nDos"
    assert row["full_content"].startswith("Intro AB\nIngredientesnota") and "foot" not in row["full_content"]


def test_links(spark):
    frame = spark.createDataFrame([(1, "u", FULL)], schemas.PAGE)
    wanted = "https://site.test/a?x=1&y=2"
    assert [r["href"] for r in pages.extract_links(frame, "site.test").orderBy("pos").collect()] == [wanted] * 2
    assert [r["href"] for r in pages.extract_links(frame, "site.test", distinct=True).collect()] == [wanted]


def test_ingredients_from_paragraphs(spark):
    row = page_rows(spark, PARAGRAPHS)[0]
    assert row["ingredients"] == ["sal", "pimienta", "agua", "horno"]
    assert row["image_url"] == "https://site.test/i/a.png"
    assert row["title"] == K.UNKNOWN_TITLE


def test_instruction_rules(spark):
    many = "".join(f"<p>{i}</p>" for i in range(9))
    got = page_rows(
        spark,
        content("<h2>Cómo hacer</h2><ol><li>a</li><li>b</li></ol>"),
        content("<strong>Paso a paso</strong><p>x</p>") + "<ol><li>uno</li></ol>",
        content("<p><b>Vamos</b></p><p>s</p>"),
        content("<h2>Instrucciones</h2>"),
        content(""),
        content("<p>0</p>"),
        content("<p>0</p><p>1</p><p>2</p>"),
        content(many),
        "<p>no content block</p>",
        content("<div><h3>Preparación</h3><p>in</p></div><p>out</p>"),
    )
    assert [got[i]["instructions"] for i in range(10)] == [
        "a\nb", "uno", "", "", "", "0", "1", "2\n3\n4\n5\n6", "", "in",
    ]


def test_nested_lists(spark):
    """Text of a nested list belongs to the items around it, and to its own."""
    lists = [
        "<ul><li>a<ul><li>b</li></ul>c</li><li>d</li></ul><p>x</p>",
        "<ul><li>a<ol><li>b<li>c</ol>d<li>e</ul>f",  # items that are not closed
        "<ul><li>a<ul><li>b<ul><li>c</li></ul></li></ul></li></ul><ul><li>other</li></ul>",
        "<ul>x<li></li>y<li>b",
        "</ul></ul><ul><li>a</li></ul>",
    ]
    got = page_rows(spark, *[content("<h2>Ingredientes</h2>" + x) for x in lists])
    assert [got[i]["ingredients"] for i in range(len(lists))] == [
        ["abc", "b", "d"], ["abcd", "b", "c", "e"], ["abc", "bc", "c"], ["", "b"], [],
    ]
    steps = page_rows(spark, content("<h2>Preparación</h2><ol><li>a <ol><li>b</li></ol></li><li>c</li></ol>"))
    assert steps[0]["instructions"] == "a b\nb\nc"


def test_single_fields_equal_records(spark):
    htmls = [FULL, PARAGRAPHS, None, "", "<h1>no class</h1><h1 class='x entry-title'>A<b>B</b>&amp;<h2>C", "<h1 class=entry-title>end",
             "<h1x class='entry-title'>no</h1x><iframe src=http://www.youtube.com/embed/1>", "<h1 class='entry-title'></h1>text"]
    frame = spark.createDataFrame([(i, "https://site.test/r/one", h) for i, h in enumerate(htmls)], schemas.PAGE)
    whole = {r["page_id"]: r for r in pages.recipe_records(frame).collect()}
    for column, single in (("title", pages.page_title), ("youtube_url", pages.page_video)):
        assert {r["page_id"]: r[column] for r in single(frame).collect()} == {k: r[column] for k, r in whole.items()}
        assert "Exchange" not in single(frame)._jdf.queryExecution().executedPlan().toString()


def test_order_numbers_and_slices(spark):
    rows = [(i * 7 % 1000, i % 3, f"u{i}") for i in range(2000)]
    frame = spark.createDataFrame(rows, "page_id int, pos int, href string").repartition(7)
    got = ordering.with_order_numbers(frame, ["page_id", "pos", "href"], "number", 9).collect()
    assert [r["number"] for r in sorted(got, key=lambda r: r["number"])] == list(range(2000))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["number"])] == sorted(rows)
    unique = frame.dropDuplicates(["page_id", "pos"])
    ordered = sorted({r[:2] for r in rows})
    for start, cap in ((0, None), (5, None), (10, 40), (0, 3), (50, 40), (1999, None), (0, 10**6)):
        out = pages.link_slice(unique, start, cap).collect()
        assert sorted((r["page_id"], r["pos"]) for r in out) == ordered[: cap or None][start:]
    plan = pages.link_slice(unique, 10, 40)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Limit" not in plan and "Window" not in plan
    assert ordering.with_order_numbers(frame.limit(0), ["page_id"], "n").count() == 0


def test_failed_and_empty_pages(spark):
    got = page_rows(spark, None, "", "<!-- only --><script>var a='<p>x</p>'</script>")
    assert sorted(got) == [1, 2]
    assert {r["title"] for r in got.values()} == {K.UNKNOWN_TITLE}


def test_shared_image_and_lists_without_items(spark):
    got = page_rows(
        spark,
        '<head><meta content="http://x/og.png" property="og:image"></head>' + content("<p>x</p>"),
        content("<h4>Ingredientes</h4><ul></ul><p>Se necesita</p><p>pan, sal</p>"),
        content('<img><img src="b.png">'),
    )
    assert got[0]["image_url"] == "http://x/og.png"
    assert got[1]["ingredients"] == ["pan", "sal"]
    assert got[2]["image_url"] == ""


def test_one_row_per_group_of_any_length(spark):
    turns = spark.range(4100).selectExpr("1L as conv_id", "id + 7 as turn", "'user' as role", "cast(id as string) as text")
    assert [r["n"] for r in pairs.fold_turns(turns).selectExpr("size(conversation) as n").collect()] == [4100]
    parts = spark.range(65_540).selectExpr("'v' as video_id", "id as seq", "'x' as text")
    assert video.transcripts(parts).selectExpr("length(transcript) as n").first()["n"] == 2 * 65_540 - 1


def test_split_shares_at_the_ends(spark):
    rows = spark.range(50)
    for exact in (True, False):
        for share, side in ((0, "train"), (1.0, "test")):
            assert {r["split"] for r in split.train_test_split(rows, "id", share, exact=exact).collect()} == {side}
    with pytest.raises(ValueError):
        split.train_test_split(rows, "id", 1.2)


def test_several_replies_make_one_pair(spark):
    asked = spark.createDataFrame([(1, "q")], "recipe_id long, question string")
    said = spark.createDataFrame([(1, "q", "a", "b"), (1, "q", "c", "d")], "recipe_id long, question string, chosen string, rejected string")
    assert [(r["chosen"], r["rejected"]) for r in recipes.attach_responses(asked, said).collect()] == [("c", "d")]


def test_tasks_of_text_operators_stay_small(spark, monkeypatch):
    monkeypatch.setattr(summary, "TASK_BYTES", 1 << 12)
    rows = [(i, f"uno dos tres {i}. " * 60) for i in range(400)]  # some 400 kB
    docs = spark.createDataFrame(rows, "k long, text string")
    for found in (
        summary.word_frequency(docs, ["k"], "text", []),
        summary.sentence_scores(docs, ["k"], "text", []),
        summary.top_sentences(docs, ["k"], "text", 2, []),
        summary.extractive_summary(docs, ["k"], "text", 2, []),
    ):
        assert found.rdd.getNumPartitions() >= 90
    got = {(r["k"], r["word"]): r["n"] for r in summary.word_frequency(docs, ["k"], "text", []).collect()}
    assert len(got) == 4 * 400 and set(got.values()) == {60}
    assert summary.word_frequency(docs.limit(0), ["k"], "text", []).isEmpty()
