"""Word frequencies, sentence scores and extractive summaries.

A text is one row.  ``keys`` are the columns that identify it; they must be
unique, so partitioning by them spreads evenly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.text import content_words, let, sentences


#: Text of one task.  As words with their counts and sort keys it takes some 60
#: times its size in memory, so the tasks' sizes mustn't follow those of the table.
TASK_BYTES = 8 << 20


def default_stop_words(language: str = "spanish") -> list[str]:
    from pyspark.ml.feature import StopWordsRemover

    SparkSession.builder.getOrCreate()
    return StopWordsRemover.loadDefaultStopWords(language)


def spread_texts(texts: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """The rows shuffled by ``keys`` into tasks of about ``TASK_BYTES`` of text.

    Spark sizes tasks by the bytes shuffled, which says little about the words made
    of them, so the texts are measured first and the number of tasks is given.
    """
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    return texts.repartition(tasks, *keys)


def word_frequency(
    texts: DataFrame, keys: Sequence[str], text: str = "text", stop_words: list[str] | None = None
) -> DataFrame:
    """Occurrences of each content word per text.

    The texts are shuffled by ``keys``: as (key, word, count) rows a text would
    take several times the bytes.
    """
    stop_words = default_stop_words() if stop_words is None else stop_words
    return (
        spread_texts(texts.select(*keys, text), keys, text)
        .select(*keys, F.explode_outer(content_words(F.col(text), stop_words)).alias("word"))
        .filter(F.col("word").isNotNull())
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _scored(texts: DataFrame, keys: Sequence[str], stop_words: list[str]) -> DataFrame:
    """(keys, sentence, score) for rows with ``_sentences``, partitioned by ``keys``.

    Every step groups by ``keys`` plus something, so none of them shuffles.
    """
    # the outer forms keep Spark from testing each array for emptiness first,
    # which would compute it twice
    occurrences = (
        texts.select(*keys, F.posexplode_outer("_sentences").alias("sentence", "body"))
        .select(*keys, "sentence", F.explode_outer(content_words(F.col("body"), stop_words)).alias("word"))
        .filter(F.col("word").isNotNull())
    )
    frequency = F.count(F.lit(1)).over(Window.partitionBy(*keys, "word"))
    return (
        occurrences.select(*keys, "sentence", frequency.alias("n"))
        .groupBy(*keys, "sentence")
        .agg(F.sum("n").alias("score"))
    )


def sentence_scores(
    texts: DataFrame, keys: Sequence[str], text: str = "text", stop_words: list[str] | None = None
) -> DataFrame:
    """Sum of word frequencies over every word occurrence of a sentence."""
    stop_words = default_stop_words() if stop_words is None else stop_words
    spread = spread_texts(texts.select(*keys, text), keys, text)
    split = spread.select(*keys, sentences(F.col(text)).alias("_sentences"))
    return _scored(split, keys, stop_words).select(
        *keys, F.col("sentence").cast("long").alias("sentence"), "score"
    )


def _to_summarise(text: Column, k: int) -> Column:
    """Sentences of a text that has to be shortened, null for any other text."""
    readable = (
        (text != "")
        & ~F.startswith(text, F.lit("Error"))
        & ~F.startswith(text, F.lit(K.TRANSCRIPT_MISSING))
    )
    return F.when(readable, let(sentences(text), lambda s: F.when(F.size(s) > k, s)))


def top_sentences(
    texts: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    k: int = 5,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """The k best sentences of each text; ties go to the earlier sentence."""
    scores = sentence_scores(texts, keys, text, stop_words)
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "sentence")
    return (
        scores.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= k)
    )


def extractive_summary(
    texts: DataFrame,
    keys: Sequence[str],
    text: str = "text",
    k: int = 5,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Adds ``summary``: the k best sentences in text order.

    Texts of at most k sentences, empty texts and error texts stay as they are.
    The text table is shuffled once by ``keys``; scoring, ranking and the
    closing join all reuse that partitioning.
    """
    stop_words = default_stop_words() if stop_words is None else stop_words
    spread = spread_texts(texts, keys, text).withColumn("_sentences", _to_summarise(F.col(text), k))
    best = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "sentence")
    picks = (
        _scored(spread, keys, stop_words)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .groupBy(*keys)
        .agg(F.collect_list("sentence").alias("_picks"))
    )
    chosen = F.array_join(
        F.filter("_sentences", lambda _, i: F.array_contains("_picks", i)), " "
    )
    return (
        spread.join(picks, list(keys), "left")
        .withColumn(
            "summary",
            F.when(F.col("_sentences").isNull(), F.col(text)).otherwise(F.coalesce(chosen, F.lit(""))),
        )
        .drop("_picks", "_sentences")
    )
