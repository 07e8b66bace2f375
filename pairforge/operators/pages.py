"""Recipe fields out of raw pages: a table of pages in, a table of fields out.

Markup becomes token rows.  The page table is shuffled once by ``page_id``; the
windows that find blocks and items, and the grouping back to one row per page,
all reuse that partitioning.  Tags and classes are parameters of ``PageRules``.

Rules for loose markup: an unclosed paragraph or bold run ends at the next block
tag, an unclosed list item at the next item or the end of its own list.  Text of a
nested list belongs to the items around it as well as to its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.text import let, strip
from pairforge.functions.urls import absolute_url
from pairforge.operators.ordering import with_order_numbers
from pairforge.schemas import SCRAPED_RECIPE

Selector = tuple[str, str | None]

HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
SECTION_HEADINGS = ["h2", "h3", "h4"]
BOLD = ["strong", "b"]
LISTS = ["ul", "ol"]
# containers with a compulsory end tag, so their nesting can be counted
CONTAINERS = [
    "html", "body", "main", "article", "section", "div", "aside", "nav", "header",
    "footer", "blockquote", "figure", "form", "table", "dl", "ul", "ol",
]
PARAGRAPH_ENDS = ["p", "pre", "hr", "li", "dt", "dd", "tr", "td", "th", *HEADINGS, *CONTAINERS]
STOP_SIBLINGS = [*SECTION_HEADINGS, "div", "section"]
END_OF_PAGE = 2**31 - 1


@dataclass(frozen=True)
class PageRules:
    """Where the fields of a page are found; ``None`` as class means any."""

    content: Selector = ("div", "entry-content")
    title: Selector = ("h1", "entry-title")
    featured: Selector = ("div", "featured-image")
    ingredient_header: str = K.INGREDIENT_HEADER
    ingredient_paragraphs: tuple[str, ...] = K.INGREDIENT_PARAGRAPH
    instruction_markers: tuple[str, ...] = K.INSTRUCTION_MARKERS


def _named() -> Column:
    """The named references of HTML 4 with their characters."""
    return F.create_map(*[F.lit(x) for name, code in name2codepoint.items() for x in (f"&{name};", chr(code))], F.lit("&apos;"), F.lit("'"))


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references, each decoded once.

    A reference to no character stays as it is.
    """
    named = _named()

    def decoded(piece: Column) -> Column:
        decimal = F.regexp_extract(piece, r"^&#([0-9]{1,7});$", 1).try_cast("int")
        hexadecimal = F.conv(F.nullif(F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,6});$", 1), F.lit("")), 16, 10)
        number = let(
            F.coalesce(decimal, hexadecimal.try_cast("int")),
            lambda n: F.when(
                n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF),
                F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "utf-32"),
            ),
        )
        char = F.when(F.startswith(piece, F.lit("&#")), number).otherwise(F.try_element_at(named, piece))
        return F.when(F.startswith(piece, F.lit("&")), F.coalesce(char, piece)).otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(K.RX_REFERENCE), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decoded), "")).otherwise(text)


def attribute(attrs: Column, name: str) -> Column:
    """Value of a tag attribute, unquoted and decoded; '' when absent."""
    value = F.regexp_extract(attrs, rf"""(?is)(?:^|\s){name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return decode_entities(F.regexp_replace(value, r"""^["']|["']$""", ""))


def _has_class(wanted: str | None) -> Column:
    return F.lit(True) if wanted is None else F.array_contains("classes", wanted)


def _tokens(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All markup and text pieces; ``keep`` columns are set on position 0 only."""
    visible = F.regexp_replace("html", K.RX_HTML_HIDDEN, "")
    raw = pages.filter(F.col("html").isNotNull()).select(
        "page_id",
        *keep,
        F.posexplode_outer(F.regexp_extract_all(visible, F.lit(K.RX_HTML), F.lit(0))).alias("pos", "token"),
    )
    pos, token = F.coalesce("pos", F.lit(0)), F.coalesce("token", F.lit(""))
    is_tag = F.rlike(token, F.lit(K.RX_HTML_TOKEN_START))
    kind = (
        F.when(~is_tag, F.lit("text")).when(F.startswith(token, F.lit("</")), F.lit("close")).otherwise("open")
    )
    return raw.select(
        "page_id",
        *[F.when(pos == 0, F.col(name)).alias(name) for name in keep],
        pos.alias("pos"),
        kind.alias("kind"),
        F.lower(F.regexp_extract(token, K.RX_HTML_TAG, 1)).alias("tag"),
        F.when(kind == "open", F.regexp_extract(token, r"(?s)^<[a-zA-Z][a-zA-Z0-9]*(.*?)/?>$", 1))
        .otherwise("")
        .alias("attrs"),
        F.when(~is_tag, decode_entities(token)).otherwise("").alias("text"),
    )


def html_tokens(pages: DataFrame) -> DataFrame:
    """(page_id, pos, kind, tag, attrs, text) rows, hidden parts removed.

    ``kind`` is ``open``, ``close`` or ``text``.  Declarations are left out; a
    page without html (a failed read) gives no rows.
    """
    return _tokens(pages).filter(
        F.when(F.col("kind") == "text", F.col("text") != "").otherwise(F.col("tag") != "")
    )


def _is(kind: str, *tags: str) -> Column:
    return (F.col("kind") == kind) & F.col("tag").isin(*tags)


def _is_tag(*tags: str) -> Column:
    return (F.col("kind") != "text") & F.col("tag").isin(*tags)


def _so_far() -> WindowSpec:
    return Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)


def _whole_page() -> WindowSpec:
    """The whole page, in the same order as ``_so_far`` so that one sort serves both."""
    ordered = Window.partitionBy("page_id").orderBy("pos")
    return ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _nesting(*tags: str) -> Column:
    step = F.when(_is("open", *tags), 1).when(_is("close", *tags), -1).otherwise(0)
    return F.sum(step).over(_so_far())


def _locate(tokens: DataFrame, blocks: dict[str, Selector], layers: dict[str, Column]) -> DataFrame:
    """Add ``<name>_start`` / ``<name>_end`` of the first match of each selector.

    ``layers`` are further running expressions computed in the same pass.
    """
    classes = F.when(F.col("kind") == "open", F.split(attribute(F.col("attrs"), "class"), r"\s+"))
    tokens = tokens.withColumn("classes", classes)
    starts = {
        f"{name}_start": F.min(
            F.when(_is("open", tag) & _has_class(cls), F.col("pos"))
        ).over(_whole_page())
        for name, (tag, cls) in blocks.items()
    }
    tokens = tokens.withColumns(starts)
    depths = {}
    for name, (tag, _) in blocks.items():
        reached = F.col("pos") >= F.col(f"{name}_start")
        step = F.when(reached & _is("open", tag), 1).when(reached & _is("close", tag), -1).otherwise(0)
        depths[f"{name}_depth"] = F.sum(step).over(_so_far())
    tokens = tokens.withColumns({**depths, **layers})
    ends = {
        f"{name}_end": F.coalesce(
            F.min(
                F.when(
                    (F.col("pos") > F.col(f"{name}_start")) & (F.col(f"{name}_depth") == 0), F.col("pos")
                )
            ).over(_whole_page()),
            F.lit(END_OF_PAGE),
        )
        for name in blocks
    }
    return tokens.withColumns(ends).drop(*depths)


def _inside(name: str) -> Column:
    return F.coalesce(
        (F.col("pos") > F.col(f"{name}_start")) & (F.col("pos") < F.col(f"{name}_end")), F.lit(False)
    )


def page_anchors(pages: DataFrame, content: Selector = PageRules.content) -> DataFrame:
    """(page_id, pos, href) of every anchor inside the content block, in order."""
    spread = pages.select("page_id", "html").repartition("page_id")
    tokens = _locate(_tokens(spread), {"content": content}, {})
    return tokens.filter(_is("open", "a") & _inside("content")).select(
        "page_id", F.col("pos").cast("long").alias("pos"), attribute(F.col("attrs"), "href").alias("href")
    )


def recipe_links(anchors: DataFrame, contains: str, not_suffix: str = "#comments") -> DataFrame:
    """Anchors to keep: non-empty, on the site, not a jump to the comments."""
    href = F.col("href")
    return anchors.filter(
        (href != "") & F.contains(href, F.lit(contains)) & ~F.endswith(href, F.lit(not_suffix))
    )


def extract_links(
    pages: DataFrame,
    contains: str,
    content: Selector = PageRules.content,
    not_suffix: str = "#comments",
    distinct: bool = False,
) -> DataFrame:
    """Links of the index pages in (page_id, pos) order; repeats are kept.

    ``distinct`` keeps the first of each address instead.
    """
    links = recipe_links(page_anchors(pages, content), contains, not_suffix)
    if distinct:
        first = F.min(F.struct("page_id", "pos")).alias("at")
        return links.groupBy("href").agg(first).select("at.page_id", "at.pos", "href")
    return links


def link_slice(links: DataFrame, start: int = 0, max_links: int | None = None) -> DataFrame:
    """Cap the ordered link list, then skip the first ``start`` of it.

    Both are a filter on the links' order numbers, so no task holds more than its
    range of the list.
    """
    number = F.col("_number")
    wanted = number >= start
    if max_links:
        wanted = wanted & (number < max_links)
    return with_order_numbers(links, ["page_id", "pos"], "_number").filter(wanted).drop("_number")


def pending_links(links: DataFrame, done: DataFrame, url: str = "url") -> DataFrame:
    """Links whose address is not among the finished ones."""
    finished = done.select(F.col(url).alias("href")).filter(F.col("href").isNotNull()).distinct()
    return links.join(finished, "href", "left_anti")


def _layer(own: list[str], ends: list[str]) -> Column:
    """Position of the item a token belongs to, or -1 outside any item.

    The last boundary before a token decides: an opening tag of ``own`` starts
    an item, every other boundary ends the one before.
    """
    mark = F.when(_is("open", *own), F.col("pos")).when(_is_tag(*own, *ends), F.lit(-1))
    return F.coalesce(F.last(mark, ignorenulls=True).over(_so_far()), F.lit(-1))


def _value() -> Column:
    """What an image, frame or shared-image tag points to."""
    attrs = F.col("attrs")
    return F.when(_is("open", "img", "iframe"), attribute(attrs, "src")).when(
        _is("open", "meta") & (attribute(attrs, "property") == "og:image"), attribute(attrs, "content")
    )


def _item(kind: str | Column, at: Column, depth: Column | None = None) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    depth = F.lit(0) if depth is None else depth
    return F.struct(kind.alias("type"), at.cast("int").alias("at"), depth.cast("int").alias("depth"))


def _list_marks() -> Column:
    """What a token says about list items: one entry per list around it.

    An item's tag begins (its position) or ends (-1) an item of the innermost list,
    the end of a list ends the item in it, and text (null) belongs to whatever item
    is open in each of the lists around it.
    """
    level, none = F.col("list_level"), F.lit(None)
    own = F.when(_is("open", "li"), F.col("pos")).when(_is("close", "li"), F.lit(-1))
    return (
        F.when((F.col("kind") == "text") & (level > 0), F.transform(F.sequence(F.lit(1), level), lambda d: _item("li", none, d)))
        .when(own.isNotNull() & (level > 0), F.array(_item("li", own, level)))
        .when(_is("close", *LISTS) & (level >= 0), F.array(_item("li", F.lit(-1), level + 1)))
    )


def _with_list_owners(rows: DataFrame) -> DataFrame:
    """The rows with the list item that each mark of a list belongs to; marks
    outside any item go."""
    so_far = Window.partitionBy("page_id", "item.type", "item.depth").orderBy("pos")
    owner = F.last("item.at", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    listed = F.col("item.type") == "li"
    placed = rows.withColumn("_owner", F.when(listed, F.coalesce(owner, F.lit(-1))).otherwise(F.col("item.at")))
    own = (F.col("_owner") >= 0) & ((F.col("kind") == "text") | (F.col("_owner") == F.col("pos")))
    return placed.filter(~listed | own).withColumn("item", F.struct(F.col("item.type").alias("type"), F.col("_owner").alias("at")))


def _page_items(pages: DataFrame, rules: PageRules) -> DataFrame:
    """One row per page with its items in order.

    Items are paragraphs (p), headings (h), bold runs (b), list items (li), the
    content text (c), and single tags needed to bound them (open / close).
    """
    spread = pages.select("page_id", "url", "html").repartition("page_id")
    located = _locate(
        _tokens(spread, keep=("url",)),
        {"content": rules.content, "featured": rules.featured},
        {
            "p": _layer(["p"], PARAGRAPH_ENDS),
            "h": _layer(HEADINGS, CONTAINERS),
            "b": _layer(BOLD, PARAGRAPH_ENDS),
            "list_level": _nesting(*LISTS),
            "level": _nesting(*CONTAINERS),
            "ul_level": _nesting("ul"),
            "ol_level": _nesting("ol"),
        },
    ).withColumns(
        {
            "inside": _inside("content"),
            "in_featured": _inside("featured"),
            "is_title": _is("open", rules.title[0]) & _has_class(rules.title[1]),
            "value": _value(),
        }
    )

    def member(kind: str) -> Column:
        owner = F.col(kind)
        mine = (owner == F.col("pos")) | ((owner >= 0) & (F.col("kind") == "text"))
        return F.when(mine, _item(kind, owner))

    singles = _is("open", "img", "iframe", "meta", "div", "section", *SECTION_HEADINGS, *LISTS) | _is(
        "close", *CONTAINERS
    )
    memberships = F.array_compact(
        F.array(
            *[member(kind) for kind in ("p", "h", "b")],
            F.when(singles, _item(F.col("kind"), F.col("pos"))),
            F.when(F.col("inside") & (F.col("kind") == "text"), _item("c", F.lit(-1))),
            # carries the page's own columns, and keeps pages with no other item
            F.when(F.col("pos") == 0, _item("page", F.lit(-2))),
        )
    )
    rows = _with_list_owners(
        located.select("*", F.explode(F.concat(memberships, F.coalesce(_list_marks(), F.array()))).alias("item"))
    )
    head = F.struct(
        "tag", "value", "is_title", "inside", "in_featured", "level", "ul_level", "ol_level", (F.col("p") >= 0).alias("in_p"),
        F.col("content_start").isNotNull().alias("has_content"),
    )
    texts = F.array_sort(F.collect_list(F.when(F.col("kind") == "text", F.struct("pos", "text"))))
    items = rows.groupBy("page_id", "item").agg(
        F.min_by(head, "pos").alias("head"),
        F.array_join(texts["text"], "").alias("text"),
        F.max("url").alias("url"),
    )
    entry = F.struct(
        F.col("item.at").alias("pos"), F.col("item.type").alias("type"), F.col("head"), F.col("text")
    )
    return items.groupBy("page_id").agg(
        F.max("url").alias("url"),
        F.array_sort(F.collect_list(entry)).alias("items"),
        F.bool_or("head.has_content").alias("has_content"),
    )


def _first(items: Column, test) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(1))


def _type(item: Column, *types: str) -> Column:
    return item["type"].isin(*types)


def _tag(item: Column, kind: str, tag: str) -> Column:
    return (item["type"] == kind) & (item["head"]["tag"] == tag)


def _headers(items: Column, words: tuple[str, ...]) -> Column:
    """Section headings and bold runs whose text contains one of the words."""

    def matches(item: Column) -> Column:
        header = (_type(item, "h") & item["head"]["tag"].isin(*SECTION_HEADINGS)) | _type(item, "b")
        text = F.lower(item["text"])
        hit = F.contains(text, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(text, F.lit(word))
        return header & hit

    return F.filter(items, matches)


def _list_after(items: Column, header: Column, tag: str) -> Column:
    return let(
        header["pos"], lambda at: _first(items, lambda i: _tag(i, "open", tag) & (i["pos"] > at))
    )


def _list_texts(items: Column, opened: Column, tag: str) -> Column:
    """Stripped texts of the items between a list tag and its end."""
    level = f"{tag}_level"

    def members(list_open: Column) -> Column:
        closing = _first(
            items,
            lambda i: _tag(i, "close", tag)
            & (i["pos"] > list_open["pos"])
            & (i["head"][level] < list_open["head"][level]),
        )
        return let(
            F.coalesce(closing["pos"], F.lit(END_OF_PAGE)),
            lambda end: F.filter(
                items, lambda i: _type(i, "li") & (i["pos"] > list_open["pos"]) & (i["pos"] < end)
            ),
        )

    return F.transform(let(opened, members), lambda i: strip(i["text"]))


def _title(items: Column) -> Column:
    found = _first(items, lambda i: _type(i, "h") & i["head"]["is_title"])
    return F.coalesce(strip(found["text"]), F.lit(K.UNKNOWN_TITLE))


def _image(items: Column, url: Column) -> Column:
    def source(item: Column) -> Column:
        return F.nullif(item["head"]["value"], F.lit(""))

    featured = _first(items, lambda i: _tag(i, "open", "img") & i["head"]["in_featured"])
    in_content = _first(items, lambda i: _tag(i, "open", "img") & i["head"]["inside"])
    shared = _first(items, lambda i: _tag(i, "open", "meta") & i["head"]["value"].isNotNull())
    absolute = let(
        source(in_content),
        lambda src: F.when(F.startswith(src, F.lit("http")), src).when(
            src.isNotNull(), absolute_url(url, src)
        ),
    )
    return F.coalesce(source(featured), absolute, source(shared), F.lit(""))


def _video(items: Column) -> Column:
    frame = _first(
        items,
        lambda i: _tag(i, "open", "iframe") & F.contains(i["head"]["value"], F.lit(K.IFRAME_MARK)),
    )
    return F.coalesce(frame["head"]["value"], F.lit(""))


def _paragraph_texts(items: Column) -> Column:
    inside = F.filter(items, lambda i: _type(i, "p") & i["head"]["inside"])
    return F.transform(inside, lambda i: strip(i["text"]))


def _ingredients(items: Column, rules: PageRules) -> Column:
    header = F.try_element_at(_headers(items, (rules.ingredient_header,)), F.lit(1))
    listed = _list_texts(items, _list_after(items, header, "ul"), "ul")

    def announces(text: Column) -> Column:
        hit = F.lit(False)
        for word in rules.ingredient_paragraphs:
            hit = hit | F.contains(F.lower(text), F.lit(word))
        return hit

    def after_announcement(texts: Column) -> Column:
        paired = F.zip_with(
            F.slice(texts, F.lit(1), F.greatest(F.size(texts) - 1, F.lit(0))),
            F.filter(texts, lambda _, i: i > 0),
            lambda before, text: F.when(announces(before), text),
        )
        parts = F.flatten(F.transform(F.array_compact(paired), lambda t: F.split(t, r"[,\n]")))
        return F.filter(
            F.transform(parts, strip), lambda part: (part != "") & ~F.startswith(part, F.lit("http"))
        )

    return let(
        listed,
        lambda found: F.when(F.size(found) > 0, found).otherwise(
            let(_paragraph_texts(items), after_announcement)
        ),
    )


def _following_paragraphs(items: Column, header: Column) -> Column:
    """Sibling paragraphs after a header, up to the next heading or container."""
    level = header["head"]["level"]

    def stops(item: Column) -> Column:
        own_level = item["head"]["level"]
        container = item["head"]["tag"].isin("div", "section") & (own_level - 1 == level)
        heading = item["head"]["tag"].isin(*SECTION_HEADINGS) & (own_level == level)
        ends = _type(item, "close") & (own_level < level)
        return (item["pos"] > header["pos"]) & ((_type(item, "open") & (container | heading)) | ends)

    siblings = let(
        F.coalesce(_first(items, stops)["pos"], F.lit(END_OF_PAGE)),
        lambda end: F.filter(
            items,
            lambda i: _type(i, "p")
            & (i["pos"] > header["pos"])
            & (i["pos"] < end)
            & (i["head"]["level"] == level),
        ),
    )
    texts = F.filter(F.transform(siblings, lambda i: strip(i["text"])), lambda t: t != "")
    # a bold run inside a paragraph has no paragraphs beside it
    return F.when(header["head"]["in_p"], F.lit("")).otherwise(F.array_join(texts, "\n"))


def _middle_paragraphs(paragraphs: Column) -> Column:
    count = F.size(paragraphs)
    start = F.least(F.lit(2), F.floor(count / 3).cast("int"))
    finish = F.greatest(start + 1, count - 2)
    return F.array_join(F.slice(paragraphs, start + 1, finish - start), "\n")


def _instructions(items: Column, rules: PageRules) -> Column:
    def by_header(header: Column) -> Column:
        return let(
            _list_after(items, header, "ol"),
            lambda steps: F.when(
                steps.isNotNull(), F.array_join(_list_texts(items, steps, "ol"), "\n")
            ).otherwise(_following_paragraphs(items, header)),
        )

    return let(
        _first(_headers(items, rules.instruction_markers), lambda i: i["head"]["inside"]),
        lambda header: F.when(header.isNotNull(), by_header(header)).otherwise(
            let(_paragraph_texts(items), _middle_paragraphs)
        ),
    )


def _content_text(items: Column) -> Column:
    return F.coalesce(strip(_first(items, lambda i: _type(i, "c"))["text"]), F.lit(""))


def _fields(pages: DataFrame, rules: PageRules, *names: str) -> DataFrame:
    """The named fields of every readable page, keyed by ``page_id``."""
    items = F.col("items")
    build = {
        "title": lambda: _title(items),
        "url": lambda: F.col("url"),
        "image_url": lambda: _image(items, F.col("url")),
        "youtube_url": lambda: _video(items),
        "ingredients": lambda: _ingredients(items, rules),
        "instructions": lambda: F.when(F.col("has_content"), _instructions(items, rules)).otherwise(""),
        "full_content": lambda: _content_text(items),
        "youtube_transcript": lambda: F.lit(""),
    }
    return _page_items(pages, rules).select("page_id", *[build[name]().alias(name) for name in names])


def recipe_records(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    """One scraped-recipe row per readable page."""
    return _fields(pages, rules, *SCRAPED_RECIPE.fieldNames())


def _pieces() -> Column:
    """Markup and text pieces of a page, as ``_tokens`` cuts them, in one array."""
    return F.regexp_extract_all(F.regexp_replace("html", K.RX_HTML_HIDDEN, ""), F.lit(K.RX_HTML), F.lit(0))


def _tag_pattern(names: Sequence[str], start: str = "<") -> Column:
    return F.lit(rf"(?i)^{start}(?:{'|'.join(names)})(?![a-zA-Z0-9])")


def _attrs_of(piece: Column) -> Column:
    return F.regexp_extract(piece, r"(?s)^<[a-zA-Z][a-zA-Z0-9]*(.*?)/?>$", 1)


def page_title(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    """The title of every readable page, found inside the row: no markup moves."""
    tag, wanted = rules.title
    ends = _tag_pattern([*HEADINGS, *CONTAINERS], "</?")

    def opens(piece: Column) -> Column:
        named = F.rlike(piece, _tag_pattern([tag]))
        if wanted is None:
            return named
        # the class is looked for in tags of the right name only
        return F.when(named, F.array_contains(F.split(attribute(_attrs_of(piece), "class"), r"\s+"), wanted)).otherwise(False)

    def text_after(pieces: Column, at: Column) -> Column:
        rest = F.slice(pieces, at + 2, F.size(pieces))
        until = let(rest, lambda r: F.slice(r, 1, F.coalesce(F.array_position(F.transform(r, lambda t: F.rlike(t, ends)), True) - 1, F.lit(0))))
        whole = let(rest, lambda r: F.when(F.exists(r, lambda t: F.rlike(t, ends)), until).otherwise(r))
        texts = F.filter(whole, lambda t: ~F.rlike(t, F.lit(K.RX_HTML_TOKEN_START)))
        return strip(F.array_join(F.transform(texts, decode_entities), ""))

    def title(pieces: Column) -> Column:
        first = F.array_position(F.transform(pieces, opens), True)
        return let(first.cast("int"), lambda at: F.when(at > 0, text_after(pieces, at - 1)))

    readable = pages.filter(F.col("html").isNotNull())
    return readable.select("page_id", F.coalesce(let(_pieces(), title), F.lit(K.UNKNOWN_TITLE)).alias("title"))


def page_image(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    return _fields(pages, rules, "image_url")


def page_video(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    """The embedded video of every readable page, found inside the row."""
    frames = F.filter(_pieces(), lambda piece: F.rlike(piece, _tag_pattern(["iframe"])))
    sources = F.transform(frames, lambda piece: attribute(_attrs_of(piece), "src"))
    video = F.get(F.filter(sources, lambda src: F.contains(src, F.lit(K.IFRAME_MARK))), F.lit(0))
    return pages.filter(F.col("html").isNotNull()).select("page_id", F.coalesce(video, F.lit("")).alias("youtube_url"))


def page_ingredients(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    return _fields(pages, rules, "ingredients")


def page_instructions(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    return _fields(pages, rules, "instructions")


def page_text(pages: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    return _fields(pages, rules, "full_content")


def drop_failed(records: DataFrame, column: str) -> DataFrame:
    return records.filter(F.col(column).isNotNull())
