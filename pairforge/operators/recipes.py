"""Joins between recipes, questions, replies and saved pairs.

The side that can repeat a key is always on the left, where Spark's adaptive
skew rule may split it.  Nothing is broadcast by hint: Spark broadcasts a side
only when its measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.text import percent
from pairforge.operators.questions import map_category, nonempty_questions, with_recipe_id

PAIR_KEY = ["recipe_id", "question"]


def recipe_questions(recipes: DataFrame, bank: DataFrame) -> DataFrame:
    """Questions with their recipe's columns and the internal category."""
    asked = nonempty_questions(with_recipe_id(bank)).select(
        "recipe_id",
        F.col("questions").alias("question"),
        map_category(F.col("questions_category")).alias("category"),
        F.coalesce("question_type", F.lit(K.DEFAULT_BANK_TYPE)).alias("question_type"),
    )
    known = (
        recipes.filter(F.col("id").isNotNull() & (F.col("id") != 0))
        .withColumnRenamed("id", "recipe_id")
        .withColumnRenamed("nombre", "recipe_name")
    )
    return asked.join(known, "recipe_id", "inner")


def recipes_without_questions(recipes: DataFrame, bank: DataFrame) -> DataFrame:
    """Recipes with an id but no bank row at all."""
    asked = with_recipe_id(bank).select(F.col("recipe_id").alias("id")).distinct()
    return recipes.filter(F.col("id").isNotNull() & (F.col("id") != 0)).join(asked, "id", "left_anti")


def estimated_pairs(recipes: DataFrame, bank: DataFrame) -> DataFrame:
    """Number of pairs a run would make: questions counted first, then joined."""
    asked = nonempty_questions(with_recipe_id(bank)).groupBy("recipe_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    ids = recipes.select(F.col("id").alias("recipe_id"))
    return ids.join(asked, "recipe_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("estimated_pairs")
    )


def pending_pairs(requests: DataFrame, saved: DataFrame) -> DataFrame:
    """Requests whose (recipe, question) has no saved pair yet."""
    return requests.join(saved.select(*PAIR_KEY).distinct(), PAIR_KEY, "left_anti")


def generation_progress(requests: DataFrame, saved: DataFrame) -> DataFrame:
    """Finished share of the requested (recipe, question) keys.

    Both sides shrink to distinct keys before they meet.
    """
    wanted = requests.select(*PAIR_KEY).distinct()
    done = saved.select(*PAIR_KEY).distinct().withColumn("done", F.lit(True))
    return wanted.join(done, PAIR_KEY, "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("done").alias("finished"),
        percent(F.count_if("done"), F.count(F.lit(1))).alias("completion_pct"),
    )


def attach_responses(
    requests: DataFrame, responses: DataFrame, mark_fallback: bool = True
) -> DataFrame:
    """Join model replies to requests; a missing reply becomes the fixed sentence.

    Of several replies to one key the greatest (chosen, rejected) counts.
    """
    reply = F.max(F.struct("chosen", "rejected"))
    one = responses.groupBy(*PAIR_KEY).agg(reply.alias("_reply")).select(*PAIR_KEY, "_reply.*")
    joined = requests.join(one, PAIR_KEY, "left")
    if mark_fallback:
        joined = joined.withColumn(
            "is_fallback", F.col("chosen").isNull() | F.col("rejected").isNull()
        )
    return joined.withColumns(
        {
            "chosen": F.coalesce("chosen", F.lit(K.FALLBACK_CHOSEN)),
            "rejected": F.coalesce("rejected", F.lit(K.FALLBACK_REJECTED)),
        }
    )


def merge_recipes(existing: DataFrame, new: DataFrame) -> DataFrame:
    """All old rows and all new rows, nothing removed."""
    return existing.unionByName(new)


def distinct_urls(recipes: DataFrame, url: str = "url") -> DataFrame:
    return recipes.select(url).filter(F.col(url).isNotNull()).distinct()
