"""Question bank: reply parsing, defaults, grouping, summary, request rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.replies import reply_elements
from pairforge.functions.text import fill_template, lookup
from pairforge.operators.pairs import system_message
from pairforge.schemas import RAW_QUESTION



def complete_questions(raw: DataFrame) -> DataFrame:
    """Drop raw questions without text; fill category and type."""
    return raw.filter(F.col("question").isNotNull()).withColumns(
        {
            "category": F.coalesce("category", F.lit(K.DEFAULT_BANK_CATEGORY)),
            "question_type": F.coalesce("question_type", F.lit(K.DEFAULT_RAW_TYPE)),
        }
    )


def parse_questions(replies: DataFrame, text: str = "reply", lenient: bool = False) -> DataFrame:
    """One row per usable question of each reply, with its position.

    ``lenient`` first removes commas before a closing bracket.
    """
    keep = [name for name in replies.columns if name != text]
    # outer, so that each reply is parsed once; empty replies fall to the filter
    exploded = replies.select(*keep, F.posexplode_outer(reply_elements(F.col(text), lenient)))
    raw = exploded.select(
        *keep,
        F.col("pos").cast("long").alias("position"),
        F.from_json("col", RAW_QUESTION, {"allowSingleQuotes": "false"}).alias("q"),
    ).select(*keep, "position", "q.*")
    return complete_questions(raw)


def to_question_bank(questions: DataFrame) -> DataFrame:
    """Bank column names; questions come with their recipe's id and name."""
    empty = F.lit("")
    return questions.select(
        F.col("id").alias("recipe_id"),
        F.coalesce("nombre", empty).alias("recipe_name"),
        F.coalesce("question", empty).alias("questions"),
        F.coalesce("category", empty).alias("questions_category"),
        F.coalesce("question_type", empty).alias("question_type"),
    )


def explode_recipe_questions(recipes: DataFrame, questions: str = "questions") -> DataFrame:
    """Concatenate the per-recipe question lists into bank rows."""
    rows = recipes.select("id", "nombre", F.explode(questions).alias("q"))
    return to_question_bank(rows.select("id", "nombre", "q.*"))


def map_category(bank_category: Column) -> Column:
    label = F.coalesce(bank_category, F.lit(K.DEFAULT_BANK_CATEGORY))
    return lookup(label, K.CATEGORY_MAP, K.DEFAULT_CATEGORY)


def map_difficulty(category: Column) -> Column:
    return lookup(category, K.DIFFICULTY_MAP, K.DEFAULT_DIFFICULTY)


def with_recipe_id(bank: DataFrame) -> DataFrame:
    return bank.filter(F.col("recipe_id").isNotNull() & (F.col("recipe_id") != 0))


def nonempty_questions(bank: DataFrame) -> DataFrame:
    return bank.filter(F.length("questions") > 0)


def questions_by_recipe(
    bank: DataFrame, position: str = "position", block_size: int | None = None
) -> DataFrame:
    """Question lists per recipe in bank order: one row per recipe.

    With ``block_size``, for lists that don't fit one row, a list continues in
    rows ``block`` 0, 1, 2, ... by position.
    """
    block = F.floor(F.col(position) / F.lit(block_size)).cast("long") if block_size else F.lit(0).cast("long")
    block = block.alias("block")
    entry = F.struct(
        F.col(position).alias("position"), "questions", "questions_category", "question_type"
    )
    return (
        with_recipe_id(bank)
        .groupBy("recipe_id", block)
        .agg(
            F.count(F.lit(1)).alias("n_questions"),
            F.array_sort(F.collect_list(entry)).alias("question_list"),
        )
    )


def bank_totals(bank: DataFrame) -> DataFrame:
    """Questions organised, recipes covered, and rows left out for want of an id."""
    usable = F.coalesce(F.col("recipe_id") != 0, F.lit(False))
    per_recipe = bank.groupBy(F.when(usable, F.col("recipe_id")).alias("recipe_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    kept = F.col("recipe_id").isNotNull()
    return per_recipe.agg(
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("n_questions"),
        F.count_if(kept).alias("n_recipes"),
        F.coalesce(F.sum(F.when(~kept, F.col("n"))), F.lit(0)).alias("n_without_id"),
    )


def question_summary(bank: DataFrame) -> DataFrame:
    """Total, distinct recipes, and counts by category and by type (long form).

    A missing recipe id counts as one value, as it would in a set.
    """
    unknown = F.lit("Unknown")
    labels = F.explode(
        F.array(
            F.struct(
                F.lit("category").alias("dimension"),
                F.coalesce("questions_category", unknown).alias("label"),
            ),
            F.struct(
                F.lit("type").alias("dimension"),
                F.coalesce("question_type", unknown).alias("label"),
            ),
        )
    )
    by_label = (
        bank.select(labels.alias("d"))
        .groupBy("d.dimension", "d.label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = (
        bank.groupBy("recipe_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.count(F.lit(1)).alias("unique_recipes"),
        )
        .unpivot([], ["total", "unique_recipes"], "dimension", "n")
        .select("dimension", F.lit("").alias("label"), "n")
    )
    return totals.unionByName(by_label)


def question_requests(recipes: DataFrame) -> DataFrame:
    """Request rows that ask for a recipe's question bank; absent fields are ''."""
    empty = F.lit("")
    fields = {
        name: F.coalesce(name, empty) for name in ("nombre", "dificultad", "tiempo", "racion", "categoria")
    }
    fields["ingredientes"] = F.coalesce(F.array_join("ingredientes", ", "), empty)
    fields["pasos"] = F.coalesce(F.array_join("pasos", " "), empty)
    cap, temperature = K.QUESTION_LIMITS
    return recipes.select(
        F.col("id").alias("recipe_id"),
        F.lit(K.QUESTION_SYSTEM).alias("system_text"),
        fill_template(K.QUESTION_USER, fields).alias("user_text"),
        F.lit(cap).cast("long").alias("max_tokens"),
        F.lit(temperature).alias("temperature"),
    )


def _reply_fields() -> dict[str, Column]:
    fields = {name: F.col(name) for name in ("question", "tiempo", "dificultad", "racion")}
    fields["nombre"] = F.col("recipe_name")
    fields["ingredientes"] = F.array_join("ingredientes", ", ")
    fields["pasos"] = F.array_join("pasos", " ")
    fields["valor_nutricional"] = F.coalesce("valor_nutricional", F.lit(K.DEFAULT_NUTRITION))
    return fields


def _reply_requests(
    questions: DataFrame, system: Column, template: str, limits: tuple[int, float]
) -> DataFrame:
    cap, temperature = limits
    return questions.select(
        "recipe_id",
        "question",
        system.alias("system_text"),
        fill_template(template, _reply_fields()).alias("user_text"),
        F.lit(cap).cast("long").alias("max_tokens"),
        F.lit(temperature).alias("temperature"),
    )


def chosen_requests(questions: DataFrame) -> DataFrame:
    """Requests for the good reply.

    ``user_text`` is null when the recipe lacks a field the prompt needs: such
    a pair fails, so a null prompt is a defect of that row.
    """
    return _reply_requests(questions, system_message(F.col("category")), K.CHOSEN_USER, K.CHOSEN_LIMITS)


def rejected_requests(questions: DataFrame) -> DataFrame:
    """Requests for the weaker reply; null prompts as in ``chosen_requests``."""
    return _reply_requests(questions, F.lit(K.REJECTED_SYSTEM), K.REJECTED_USER, K.REJECTED_LIMITS)


#: Entries of a dictionary that may be sent to every executor.
MAX_LOOKUP = 10_000


def lookup_join(
    rows: DataFrame, column: str, table: dict[str, str], default: str, output: str
) -> DataFrame:
    """The same lookups as a join, for a dictionary kept as a table.

    A dictionary of at most ``MAX_LOOKUP`` entries is broadcast; a larger one is
    joined as Spark sees fit.
    """
    pairs = rows.sparkSession.createDataFrame(list(table.items()), f"{column} string, _value string")
    joined = rows.join(F.broadcast(pairs) if len(table) <= MAX_LOOKUP else pairs, column, "left")
    return joined.withColumn(output, F.coalesce("_value", F.lit(default))).drop("_value")
