"""Token counts against a caller's vocabulary, each distinct word cut once.

A word is cut from the left, always by the longest piece of the vocabulary that
fits; a character that begins no piece is one token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.functions.text import words

#: Characters of a long word whose pieces are looked up from one row.
BLOCK = 256
#: Words up to this length stand for themselves, longer ones go by their digest.
NAME_CHARS = 32


def _name(word: Column) -> Column:
    # a digest has 64 characters, so it is never the name of a short word
    return F.when(F.length(word) <= NAME_CHARS, word).otherwise(F.sha2(word, 256))


def word_pieces(distinct_words: DataFrame, vocabulary: DataFrame, piece: str = "piece") -> DataFrame:
    """(name, n_tokens) for rows of (name, word), one row per word.

    Every place of a word is joined with the vocabulary on the pieces that may
    begin there, so the vocabulary may be of any size; the walk over the places
    that matched is a fold over one array, linear in the word.
    """
    known = vocabulary.select(F.col(piece).alias("_piece")).where(F.length("_piece") > 0).distinct()
    longest = known.agg(F.max(F.length("_piece"))).scalar()
    blocks = distinct_words.select(
        "name", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1, F.lit(BLOCK))).alias("_base")
    ).select(
        "name",
        "_base",
        F.least(F.lit(BLOCK), F.length("word") - F.col("_base")).alias("_places"),
        F.substring(F.col("word"), F.col("_base") + 1, F.lit(BLOCK) + longest).alias("_part"),
    )
    places = blocks.withColumn("_offset", F.explode(F.sequence(F.lit(0), F.col("_places") - 1)))
    fits = F.least(longest, F.length("_part") - F.col("_offset"))
    candidates = places.withColumn("_length", F.explode(F.sequence(F.lit(1), fits))).select(
        "name",
        F.struct((F.col("_base") + F.col("_offset")).alias("at"), (-F.col("_length")).alias("minus")).alias("_match"),
        F.substring(F.col("_part"), F.col("_offset") + 1, F.col("_length")).alias("_piece"),
    )
    # in this order the longest match of a place comes first
    found = candidates.join(known, "_piece").groupBy("name").agg(F.sort_array(F.collect_list("_match")).alias("_found"))

    def step(done: Column, match: Column) -> Column:
        after = F.struct(
            (match["at"] - match["minus"]).alias("next"),
            (done["n"] + match["at"] - done["next"] + 1).alias("n"),
        )
        return F.when(match["at"] < done["next"], done).otherwise(after)

    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("n"))
    walked = F.aggregate("_found", start, step)
    sized = distinct_words.select("name", F.length("word").alias("_chars")).join(found, "name", "left")
    n_tokens = F.when(F.col("_found").isNull(), F.col("_chars")).otherwise(
        walked["n"] + F.col("_chars") - walked["next"]
    )
    return sized.select("name", n_tokens.cast("long").alias("n_tokens"))


def vocabulary_token_counts(
    texts: DataFrame, keys: Sequence[str], vocabulary: DataFrame, text: str = "text", piece: str = "piece"
) -> DataFrame:
    """(keys, n_words, n_tokens) per text; ``keys`` identify it.

    Words are lower-cased runs of letters and digits.  A text without words, or
    null, has none of either; repeated and empty pieces count once and not at all;
    with an empty vocabulary every character is a token.
    """
    said = texts.select(*keys, F.explode_outer(words(F.col(text))).alias("word"))
    distinct_words = said.where(F.col("word").isNotNull()).select(_name(F.col("word")).alias("name"), "word").distinct()
    # no word holds a space, so texts without words match nothing, each by itself
    nothing = F.concat(F.lit(" "), F.xxhash64(*keys).cast("string"))
    counted = said.groupBy(*keys, F.coalesce(_name(F.col("word")), nothing).alias("name")).agg(F.count("word").alias("_n"))
    tokens = word_pieces(distinct_words, vocabulary, piece)
    return (
        counted.join(tokens, "name", "left")
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("n_words"),
            F.sum(F.coalesce(F.col("_n") * F.col("n_tokens"), F.lit(0))).alias("n_tokens"),
        )
    )
