"""Golden rows for expressions, checked against plain Python where it has the rule."""

from __future__ import annotations

import json
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions import chat, replies, text, urls
from pairforge.operators import questions
from pairforge.operators.pages import decode_entities


def values(spark, rows, expr):
    frame = spark.createDataFrame(list(enumerate(rows)), "i int, v string")
    return [row[1] for row in frame.select("i", expr(F.col("v"))).orderBy("i").collect()]


STRIPPABLE = [
    "a", " a ", "\ta\n", " a ", "\x0ba\x0c", "\x1ca\x1f", "\x85a", "", " 　 ", "a b", "​a"
]


def test_strip_matches_python(spark):
    assert values(spark, STRIPPABLE, text.strip) == [s.strip() for s in STRIPPABLE]
    assert values(spark, [*STRIPPABLE, None], text.is_blank) == [not s.strip() for s in STRIPPABLE] + [True]


def test_title_case_matches_python(spark):
    roles = ["tool_call", "TOOL", "a1b", "o'neil x", "función_é", ""]
    assert values(spark, roles, text.title_case) == [r.title() for r in roles]


def test_preview(spark):
    texts = ["x" * 199, "x" * 200, "x" * 201, "ñ" * 300]
    expected = [t if len(t) <= 200 else t[:200] + "..." for t in texts]
    assert values(spark, texts, text.preview) == expected


def test_token_count_and_custom_counter(spark):
    texts = ["Hola, mundo!", "", "a-b c3", "¿Qué?"]
    assert values(spark, texts, text.token_count) == [4, 0, 4, 3]

    def factory():
        return lambda value: len(value)

    assert values(spark, texts, lambda c: text.token_count(c, factory)) == [len(t) for t in texts]


def test_references_of_any_kind(spark):
    texts = ["&eacute;&#233;&#xE9;&#Xe9;", "&euro;&nope;&", "&amp;lt; &#38;amp;", "&#0; &#x110000;", "a &apos; b"]
    assert values(spark, texts, decode_entities) == ["éééé", "€&nope;&", "&lt; &amp;", "&#0; &#x110000;", "a ' b"]


def test_fill_template_is_null_when_a_field_is(spark):
    got = values(spark, ["x", None], lambda c: text.fill_template("a {v} {v}!", {"v": c}))
    assert got == ["a x x!", None]


# reply, and what is left of it
FENCED = {
    "```json\n[1]\n```": "[1]",
    "```\n[1]```": "[1]",
    "[1]\n```": "[1]",
    "  [1]  ": "[1]",
    "```json```": "",
    "plain": "plain",
    "`` [1]": "`` [1]",
}


def test_strip_code_fence(spark):
    got = values(spark, list(FENCED), replies.strip_code_fence)
    assert got == list(FENCED.values())
    assert values(spark, got, replies.strip_code_fence) == got


# reply, and the elements of its array
REPLIES = {
    '[{"question":"a"}]': [{"question": "a"}],
    '{"question":"a"}': [],
    'Claro: [{"question":"a","category":"c"}] listo': [{"question": "a", "category": "c"}],
    '[{"question":"a"}] y [{"question":"b"}]': [],
    "] nada [": [],
    '[{"question":"a",}]': [],
    '[{"question":"a"},]': [],
    "sin json": [],
    "[]": [],
    '"texto [1]"': [],
    "[1, 2] tail": [1, 2],
    '[{"question":"a"}': [],
    '{"q": [ {"question":"z"} ]}': [],
    '{"bad": [ {"question":"z"} ] x': [{"question": "z"}],
    "[{'question':'a'}]": [],
    '[{"category":"c"}, {"question":"q2"}]': [{"category": "c"}, {"question": "q2"}],
    '[1], "w": [2]': [],
    "[1]] [[2]": [],
    'x [1] {"v": [2]} ] y': [],
}


def test_reply_elements(spark):
    got = values(spark, list(REPLIES), replies.reply_elements)
    assert [[json.loads(e) for e in row] for row in got] == list(REPLIES.values())


def test_lenient_parsing_keeps_trailing_commas(spark):
    rows = spark.createDataFrame([(1, '[{"question":"a",},]'), (2, "no")], "id int, reply string")
    strict = questions.parse_questions(rows).collect()
    lenient = questions.parse_questions(rows, lenient=True).collect()
    assert strict == []
    assert [(r["id"], r["question"], r["category"], r["question_type"]) for r in lenient] == [
        (1, "a", K.DEFAULT_BANK_CATEGORY, K.DEFAULT_RAW_TYPE)
    ]


def test_repair_knows_strings(spark):
    given = ['[{"a":"x,}",},]', '["\\",]",]', '[1, ]', 'no "open ,]', '{"a":[1,\n],}']
    assert values(spark, given, replies.repair_trailing_commas) == [
        '[{"a":"x,}"}]', '["\\",]"]', "[1]", 'no "open ,]', '{"a":[1]}'
    ]
    long = '["' + "ab\\n," * 50_000 + '",]'
    assert values(spark, [long], replies.repair_trailing_commas) == [long[:-2] + "]"]


CUT = {
    '[{"a":1},{"a":2': ['{"a":1}'],
    'Text: [{"a":"]"},{"a":"x, {"},{"a"': ['{"a":"]"}', '{"a":"x, {"}'],
    "```json\n[1, 2, 3": ["1", "2"],
    '["x","y': ['x'],
    "[[1,2],[3": ["[1,2]"],
    '[{"a":1,},{"b":[1,]},': ['{"a":1}', '{"b":[1]}'],
    "[": [],
    "no": [],
    '{"a":[1': [],
}


def test_cut_replies_keep_complete_elements(spark):
    got = values(spark, list(CUT), lambda c: replies.reply_elements(c, lenient=True))
    assert got == list(CUT.values())
    assert values(spark, list(CUT), replies.reply_elements) == [[]] * len(CUT)


def test_video_urls(spark):
    given = [
        "https://www.youtube.com/embed/tX-_1?feature=oembed",
        "https://www.youtube.com/watch?v=abc&t=3",
        "https://youtu.be/xyz?x=1",
        "https://example.test/none",
        None,
    ]
    assert values(spark, given, urls.video_id) == ["tX-_1", "abc", "xyz", None, None]
    assert values(spark, given, urls.watch_url) == [K.WATCH_PREFIX + "tX-_1", *given[1:]]
    assert values(spark, given, urls.embed_id) == ["tX-_1", "", "", "", ""]


@pytest.mark.parametrize(
    ("page", "likes"),
    [
        ('"label":"1,234 likes"', 1234),
        ('"likeCount":"55"', 55),
        ('"likesText":"6,7"', 67),
        ('"likes":8', 8),
        ("like this video along with 9,000", 9000),
        ('"likes":8 "label":"2 likes"', 2),
        ('like this video along with 9 "likes":3', 3),
        ("nothing", 0),
        ('"label":", likes"', 0),
    ],
)
def test_like_count(spark, page, likes):
    assert values(spark, [page], urls.like_count) == [likes]


def test_absolute_url_matches_urljoin(spark):
    bases = ["https://a.test/x/y/z.html?q=1#f", "http://a.test", "https://a.test/dir/"]
    refs = [
        "img/p.png", "/img/p.png", "//cdn.test/p.png", "https://b.test/p", "../p.png", "../../p.png", "./p.png",
        "a/./b/../c.png", "?q=2", "#top", "p.png?v=../1", "../../../../p.png", "sub/..", "sub/.",
    ]
    rows = [(b, r) for b in bases for r in refs]
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, b string, r string")
    got = frame.select("i", urls.absolute_url(F.col("b"), F.col("r"))).orderBy("i").collect()
    assert [row[1] for row in got] == [urljoin(b, r) for b, r in rows]


def test_entities(spark):
    given = ["a &amp; b", "&amp;lt;", "&#233;&#38;lt;", "&unknown; &", "&ntilde;&nbsp;x", "&#55296;"]
    expected = ["a & b", "&lt;", "é&lt;", "&unknown; &", "ñ x", "&#55296;"]
    assert values(spark, given, decode_entities) == expected


def test_conversation_text_and_markup(spark):
    conversation = "array<struct<role:string,content:string>>"
    rows = [
        (1, [("system", "s"), ("user", "u"), ("assistant", "a"), ("tool_call", "t"), ("user", None)]),
        (2, None),
        (3, []),
    ]
    frame = spark.createDataFrame(rows, f"i int, c {conversation}")
    got = frame.select("i", chat.conversation_to_text(F.col("c"))).orderBy("i").collect()
    assert [r[1] for r in got] == ["System: s\nUser: u\nAssistant: a\nTool_Call: t", "", ""]
    one = frame.filter("i = 1").select(
        chat.role_content(F.col("c"), "user"),
        chat.role_content(F.col("c"), "assistant"),
        chat.role_content(F.col("c"), "none"),
    )
    assert list(one.first()) == ["", "a", ""]


def test_share_style_conversations(spark):
    given = [
        '[{"from":"human","value":"q"},{"from":"gpt","value":"r"}]',
        '[{"role":"user","content":"q"},{"role":"assistant","content":"r"}]',
        "broken",
    ]
    got = values(spark, given, chat.parse_conversation)
    want = [("user", "q"), ("assistant", "r")]
    assert [[tuple(m) for m in c] if c else c for c in got] == [want, want, None]
