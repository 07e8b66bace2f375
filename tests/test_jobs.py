"""Job chains: crawls that resume, training blocks of each split."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from pairforge.plans import jobs

RECORD = "title string, url string, image_url string, youtube_url string, ingredients array<string>, instructions string, full_content string, youtube_transcript string"


def page(links: str = "", title: str = "t") -> str:
    return f'<div class="entry-content"><h1 class="entry-title">{title}</h1>{links}</div>'


def link(url: str) -> str:
    return f'<a href="{url}">x</a>'


def crawl(spark, index, fetched, done=(), **options):
    frame = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")
    existing = spark.createDataFrame([("old", url, "", "", [], "", "", "") for url in done], RECORD)
    found = jobs.crawl_to_recipes(frame(index), frame(fetched), existing, "https://s/", **options)
    return sorted((r["url"] or "", r["title"]) for r in found.collect())


def test_crawl_follows_each_link_once_and_skips_the_finished(spark):
    index = [
        (1, "i", page(link("https://s/a") + link("https://s/b") + link("https://s/b#comments") + link("https://other/c"))),
        (2, "i", page(link("https://s/b") + link("https://s/d") + link("https://s/missing"))),
        (3, None, None),
    ]
    fetched = [(10, "https://s/a", page(title="A")), (11, "https://s/b", page(title="B")), (12, "https://s/d", page(title="D"))]
    fetched += [(14, "https://s/d", page(title="later")), (12, "https://s/d", page(title="D")), (13, None, page(title="none"))]
    fetched += [(15, "https://s/unlinked", page(title="U"))]
    found = crawl(spark, index, fetched, ["https://s/a", None])
    assert found == [("", "old"), ("https://s/a", "old"), ("https://s/b", "B"), ("https://s/d", "D")]
    assert crawl(spark, [], fetched) == [] == crawl(spark, index, [])


def test_crawl_in_slices_gives_the_whole(spark):
    names = [f"https://s/{c}" for c in "abcdef"]
    index = [(1, "i", page("".join(map(link, names))))]
    fetched = [(n, url, page(title=url[-1])) for n, url in enumerate(names)]
    assert [u for u, _ in crawl(spark, index, fetched, max_links=2)] == names[:2]
    assert [u for u, _ in crawl(spark, index, fetched, names[:2], start=2)] == names
    assert [u for u, _ in crawl(spark, index, fetched, start=1, max_links=4)] == names[1:4]


def test_training_blocks_hold_one_split_each(spark, tmp_path):
    talk = lambda i: json.dumps([{"role": "user", "content": f"q{i} " + "x " * (i % 40)}, {"role": "assistant", "content": f"a{i}"}])
    rows = spark.createDataFrame([(i, talk(i), "single_turn") for i in range(300)], ["key", "messages", "metadata.type"])
    plain = {r["key"]: r["split"] for r in jobs.sft_train_set(rows, "key").collect()}
    blocks = jobs.sft_blocks(rows, "key", f"{tmp_path}/a", 64).collect()
    for name in ("train", "test"):
        mine = sorted((b for b in blocks if b["split"] == name), key=lambda b: b["block"])
        assert [b["block"] for b in mine] == list(range(len(mine)))
        assert {b["n_tokens"] for b in mine[:-1]} == {64} and 0 < mine[-1]["n_tokens"] <= 64
        text = "".join(b["text"].replace(" ", "") for b in mine)
        assert {i for i in plain if f"a{i}<" in text} == {i for i, s in plain.items() if s == name}
    assert jobs.sft_blocks(rows.filter(F.lit(False)), "key", f"{tmp_path}/b", 64).count() == 0
