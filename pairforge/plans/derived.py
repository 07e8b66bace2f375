"""Inputs of the registered queries, derived from the given tables by Spark.

Each function covers its whole source table.  ``oracle.py`` states the same
inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.constants import RX_WORD
from pairforge.functions.chat import message
from pairforge.functions.text import sentences
from pairforge.operators.pairs import to_conversations
from pairforge.operators.questions import map_category, map_difficulty
from pairforge.operators.turns import reply_lengths, with_side_texts

DEFAULT_SYSTEM = "Eres un chef experto."
BANK_LABELS = [
    "General",
    "Ingredientes y preparación",
    "Técnicas",
    "Tiempo y planificación",
    "Información nutricional",
    "Porciones",
    "Solución de problemas",
    "Contexto cultural",
    "Opción múltiple",
    "Otra",
]
SESSIONS = ["20250101_080000", "20250102_090000", "20250103_100000"]
STAMP = "2025-01-02 03:04:05"
STOP_WORDS = (
    "a al como con de del el ella ellos en es esa ese eso esta este esto fue ha la las le les lo los "
    "mas me mi muy no nos o para pero por que se ser si sin sobre su sus te tu un una uno y ya yo"
).split()

# markup put in front of the page's own content, by page_id % 6
DECOR = [
    '<h2>Ingredientes</h2><ul><li> sal {id} </li><li>pan: <ul><li>blanco</li><li>negro</ul> fresco</li></ul><h3>Preparación</h3><ol>'
    '<li>Uno {id}<ol><li>primero<li>luego</ol></li><li>Dos</li></ol><img src="img/{id}.png">'
    '<a href="https://site.test/r/{id}">r</a><a href="https://site.test/r/{id}#comments">c</a>'
    '<a href="https://other.test/{id}">o</a><a href="https://site.test/all?a=1&amp;b=2">all</a>',
    "<p>Se necesita {id}:</p><p>harina {id}, huevos\nleche, http://a.test/{id}</p>"
    "<h3>Cómo hacer</h3><p title='x > y'>Mezclar a < 180 {id}.</p><p> </p><p>Hornear.</p><div>fin</div><p>No cuenta</p>"
    '<iframe src="https://www.youtube.com/embed/v{id}?feature=oembed"></iframe>'
    '<a href="https://site.test/all">all</a>',
    '<p><b>Elaboración {id}</b></p><iframe src="https://other.test/embed/v"></iframe>'
    '<img src="/abs/{id}.png">',
    '<strong>Paso a paso</strong><p>Batir {id}</p><img src="https://cdn.test/{id}.png">'
    '<a href="https://site.test/r/{id}">r</a>',
    "<h4>Los ingredientes</h4><p>sin lista</p>",
    "",
]
FEATURED = '<div class="featured-image"><div><img src="feat/{id}.png"></div></div>'
SHARED_IMAGE = '<head><meta property="og:image" content="https://cdn.test/og{id}.png">'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _short_md5(key: str) -> Column:
    return F.substring(F.md5(F.col(key).cast("string")), 1, 11)


def _bank_label(key: str) -> Column:
    labels = F.array(*[F.lit(label) for label in BANK_LABELS])
    return F.get(labels, (F.col(key) % len(BANK_LABELS)).cast("int"))


def _question_type(key: str) -> Column:
    kind = F.col(key) % 3
    return F.when(kind == 0, "conceptual").when(kind == 1, "contextual").otherwise("practical")


def recipe_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, name, text and source of recipes: what ``with_recipe_fields`` starts from."""
    key = F.col("doc_id")
    name = F.concat(F.lit("Receta "), key.cast("string")).alias("nombre")
    return table(spark, sf_dir, "documents").select(key.alias("id"), name, "text", "source")


def with_recipe_fields(rows: DataFrame, id: str = "id") -> DataFrame:
    """The other recipe columns in place of ``text`` and ``source``; nulls exercise
    the defaults.

    Lists of words take several times the bytes of their text, so rows that are
    joined get them after the join.
    """
    key = F.col(id)
    return rows.select(
        *[name for name in rows.columns if name not in ("text", "source")],
        F.regexp_extract_all("text", F.lit(RX_WORD), F.lit(0)).alias("ingredientes"),
        sentences(F.col("text")).alias("pasos"),
        F.lit("30 min").alias("tiempo"),
        F.when(key % 11 != 0, "Media").alias("dificultad"),
        F.lit("4").alias("racion"),
        F.when(key % 3 != 0, "200 kcal").alias("valor_nutricional"),
        F.when(key % 7 != 0, F.col("source")).alias("categoria"),
        F.when(key % 2 != 0, "Colombia").alias("pais"),
    )


def d_recipe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipes from documents."""
    return with_recipe_fields(recipe_texts(spark, sf_dir))


def d_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question bank from user turns: some without id, some empty, one odd label."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return turns.select(
        F.when(F.col("conv_id") % 10 != 0, F.col("conv_id")).alias("recipe_id"),
        F.concat(F.lit("Receta "), F.col("conv_id").cast("string")).alias("recipe_name"),
        F.when(F.col("turn") % 5 == 4, "").otherwise(F.col("text")).alias("questions"),
        _bank_label("conv_id").alias("questions_category"),
        _question_type("turn").alias("question_type"),
        F.col("turn").alias("position"),
    )


def _next_assistant(n: int) -> Column:
    """The n-th assistant text after this turn, read forward once per conversation."""
    return F.expr(f"lead(_said, {n}) ignore nulls over (partition by conv_id order by turn)")


def d_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pair per user turn of every conversation.

    The chosen reply is the assistant turn right after, the rejected one the next
    assistant turn after that, and the system text the last one so far.  The key
    of a pair, still called ``conv_id``, is conversation * 1000003 + turn.
    """
    order = Window.partitionBy("conv_id").orderBy("turn")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    said = F.when(F.col("role") == "assistant", F.col("text"))
    chosen = F.lead("_said").over(order)
    rejected = F.when(chosen.isNull(), _next_assistant(1)).otherwise(_next_assistant(2))
    wide = (
        table(spark, sf_dir, "conversations")
        .withColumn("_said", said)
        .select(
            (F.col("conv_id") * 1000003 + F.col("turn")).alias("conv_id"),
            "role",
            F.coalesce(
                F.last(F.when(F.col("role") == "system", F.col("text")), ignorenulls=True).over(so_far),
                F.lit(DEFAULT_SYSTEM),
            ).alias("sys"),
            F.col("text").alias("usr"),
            chosen.alias("chosen"),
            rejected.alias("rejected"),
        )
        .filter(F.col("role") == "user")
    )
    category = map_category(_bank_label("conv_id"))
    return wide.select(
        "conv_id",
        F.array(message("system", F.col("sys")), message("user", F.col("usr"))).alias("messages"),
        "chosen",
        "rejected",
        F.struct(
            F.when(F.col("conv_id") % 10 != 0, F.col("conv_id")).alias("recipe_id"),
            F.concat(F.lit("Receta "), F.col("conv_id").cast("string")).alias("recipe_name"),
            category.alias("category"),
            _question_type("conv_id").alias("context"),
            map_difficulty(category).alias("difficulty_level"),
            F.lit("N/A").alias("recipe_category"),
            F.lit("Ecuador").alias("recipe_country"),
        ).alias("metadata"),
    )


def d_session_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs spread over three sessions."""
    names = F.array(*[F.lit(name) for name in SESSIONS])
    return d_pair(spark, sf_dir).withColumn(
        "session_id", F.get(names, (F.col("conv_id") % len(SESSIONS)).cast("int"))
    )


def _conversations(pairs: DataFrame) -> DataFrame:
    absent = pairs.select("conv_id", "messages", "chosen", "rejected").withColumns(
        {f"no_{side}": F.col(side).isNull() for side in ("chosen", "rejected")}
    )
    full = to_conversations(absent)
    return full.select(
        "conv_id",
        *[F.when(~F.col(f"no_{side}"), F.col(side)).alias(side) for side in ("chosen", "rejected")],
    )


def d_conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation pairs (conv_id, chosen, rejected); a missing reply gives null."""
    return _conversations(d_pair(spark, sf_dir))


def d_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns (conv_id, turn, role, text) of whole conversations."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def d_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of both sides of every pair, all preceding turns included.

    Pairs as in ``d_pair``; ``key`` is conversation * 1000003 + turn.
    """
    measured = reply_lengths(d_turn(spark, sf_dir), DEFAULT_SYSTEM)
    return measured.withColumn("key", F.col("conv_id") * 1000003 + F.col("turn"))


def with_texts(measured: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``d_measured`` with the texts of their sides."""
    return with_side_texts(measured, d_turn(spark, sf_dir), DEFAULT_SYSTEM)


def d_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies per (recipe_id, question): the assistant turns after each question."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter((F.col("role") == "user") & (F.col("turn") % 5 != 4) & (F.col("conv_id") % 10 != 0))
    said = turns.filter(F.col("role") == "assistant")
    replies = asked.alias("q").join(
        said.alias("r"),
        (F.col("q.conv_id") == F.col("r.conv_id")) & (F.col("r.turn") == F.col("q.turn") + 1),
    )
    return (
        replies.select(
            F.col("q.conv_id").alias("recipe_id"),
            F.col("q.text").alias("question"),
            F.when(F.col("q.turn") % 4 != 2, F.col("r.text")).alias("chosen"),
            F.concat(F.lit("Breve: "), F.col("r.text")).alias("rejected"),
        )
        .groupBy("recipe_id", "question")
        .agg(F.max("chosen").alias("chosen"), F.max("rejected").alias("rejected"))
    )


def d_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies (id, turn, reply): question arrays wrapped in six ways."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    body = F.to_json(
        F.struct(
            F.col("text").alias("question"),
            F.when(F.col("turn") % 4 != 0, _bank_label("conv_id")).alias("category"),
            F.when(F.col("conv_id") % 4 != 0, _question_type("turn")).alias("question_type"),
        )
    )
    kind = F.col("conv_id") % 6
    fence, nl = F.lit("```"), F.lit("\n")
    array = F.concat(F.lit("["), body, F.lit("]"))
    reply = (
        F.when(kind == 0, F.concat(F.lit("  "), array, F.lit("\n ")))
        .when(kind == 1, F.concat(fence, F.lit("json\n"), array, nl, fence))
        .when(kind == 2, F.concat(fence, nl, array, nl, fence))
        .when(kind == 3, F.concat(F.lit("Aquí tienes: "), array, F.lit(" ¡Listo!")))
        .when(kind == 4, body)
        .otherwise(F.concat(F.lit("["), F.regexp_replace(body, r"\}$", ",}"), F.lit("]")))
    )
    return turns.select(F.col("conv_id").alias("id"), "turn", reply.alias("reply"))


def d_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as JSON text with the dotted ``metadata.type`` column."""
    pairs = d_pair(spark, sf_dir)
    system, user = F.get("messages", F.lit(0))["content"], F.get("messages", F.lit(1))["content"]
    chosen = F.coalesce("chosen", F.lit(""))
    plain = F.to_json(F.array(message("user", user), message("assistant", chosen)))
    longer = F.to_json(
        F.array(message("system", system), message("user", user), message("assistant", chosen))
    )

    def share(speaker: str, value: Column) -> Column:
        return F.struct(F.lit(speaker).alias("from"), value.alias("value"))

    shared = F.to_json(F.array(share("human", user), share("gpt", chosen)))
    kind = F.col("conv_id") % 3
    return pairs.select(
        "conv_id",
        F.when(F.col("conv_id") % 5 == 0, longer)
        .when(F.col("conv_id") % 2 == 0, shared)
        .otherwise(plain)
        .alias("messages"),
        F.when(kind == 1, "single_turn").when(kind == 2, "multi_turn").alias("metadata.type"),
    )


def _filled(template: str, key: Column) -> Column:
    return F.replace(F.lit(template), F.lit("{id}"), key)


def d_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with recipe-site markup around their own content."""
    pages = table(spark, sf_dir, "pages")
    key = F.col("page_id").cast("string")
    kind = F.col("page_id") % 6
    decor = F.lit("")
    for index, template in enumerate(DECOR):
        decor = F.when(kind == index, _filled(template, key)).otherwise(decor)
    featured = F.when(kind == 4, _filled(FEATURED, key)).otherwise("")
    opening = F.concat(featured, F.lit('<div class="entry-content wide">'), decor)
    html = F.replace("html", F.lit("<article>"), opening)
    html = F.replace(html, F.lit("</article>"), F.lit("</div>"))
    html = F.replace(html, F.lit("<h1>"), F.lit('<h1 class="entry-title">'))
    html = F.when(kind == 5, F.replace(html, F.lit("<head>"), _filled(SHARED_IMAGE, key))).otherwise(html)
    return pages.select("page_id", "url", html.alias("html"))


def d_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished addresses: those of pages once served without encryption."""
    pages = table(spark, sf_dir, "pages").filter(F.startswith("url", F.lit("http://")))
    return pages.select(F.concat(F.lit("https://site.test/r/"), F.col("page_id").cast("string")).alias("url"))


def d_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipes with embed, watch, short, foreign and missing video urls."""
    kind, vid = F.col("page_id") % 4, _short_md5("page_id")
    prefix = "https://www.youtube.com/"
    url = (
        F.when(kind == 0, F.concat(F.lit(prefix + "embed/"), vid, F.lit("?feature=oembed")))
        .when(kind == 1, F.concat(F.lit(prefix + "watch?v="), vid))
        .when(kind == 2, F.concat(F.lit("https://youtu.be/"), vid))
        .when(F.col("page_id") % 8 == 7, F.concat(F.lit("https://video.test/"), F.col("page_id").cast("string")))
    )
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), url.alias("youtube_url"), F.col("page_id").alias("votos")
    )


def d_video_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video pages whose like count is written in one of several ways."""
    kind = F.col("page_id") % 7
    n = (F.col("page_id") * 7).cast("string")
    mark = (
        F.when(kind == 0, F.concat(F.lit('"label":"1,'), F.lpad(n, 3, "0"), F.lit(' likes"')))
        .when(kind == 1, F.concat(F.lit('"likeCount":"'), n, F.lit('"')))
        .when(kind == 2, F.concat(F.lit('"likesText":"'), n, F.lit('"')))
        .when(kind == 3, F.concat(F.lit('"likes":'), n))
        .when(kind == 4, F.concat(F.lit("like this video along with "), n))
        .when(kind == 5, F.concat(F.lit('"likes":9 "likeCount":"'), n, F.lit('"')))
        .otherwise("")
    )
    return table(spark, sf_dir, "pages").select(
        F.when(F.col("page_id") % 5 != 0, _short_md5("page_id")).alias("video_id"),
        F.concat("html", mark).alias("html"),
    )


def d_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript segments (video_id, seq, text): the sentences of documents."""
    return table(spark, sf_dir, "documents").select(
        _short_md5("doc_id").alias("video_id"), F.posexplode(sentences(F.col("text"))).alias("seq", "text")
    )
