"""Abbreviations learned from a corpus, and sentences that don't end at them.

The statistic is that of Kiss and Strunk, "Unsupervised Multilingual Sentence
Boundary Detection" (2006): a log-likelihood ratio of a word and the period after
it, weighed by the word's length, its inner periods and how often it goes without.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.text import strip

#: A word and the periods in and after it.
RX_DOTTED = r"[\p{L}\p{N}][\p{L}\p{N}.]*"
#: After a run of end marks, but not at a period between letters or digits.
RX_END = r"(?<=[.!?])(?![.!?])(?!(?<=[\p{L}\p{N}]\.)[\p{L}\p{N}])"
#: Figures of the paper: the chance of a period after an abbreviation, the least score.
LIKELY, LEAST_SCORE = 0.99, 0.3
#: A short word at the end of a few sentences only would score enough as well.
LEAST_PERIODS = 5
#: Tasks over which the pieces that end in one word are spread.
WORD_PARTS = 64


def period_statistics(texts: DataFrame, text: str = "text") -> DataFrame:
    """(word, n_period, n_plain): how often each lower-cased word stands with a
    period after it and how often without, over all texts.

    Counts are combined before the shuffle, so frequent words are no hot keys.
    """
    found = texts.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(RX_DOTTED), F.lit(0))).alias("token"))
    word = F.rtrim("token", F.lit("."))
    dotted = F.endswith("token", F.lit("."))
    return found.groupBy(word.alias("word")).agg(
        F.count_if(dotted).alias("n_period"), F.count_if(~dotted).alias("n_plain")
    )


def abbreviations(
    texts: DataFrame, text: str = "text", least_score: float = LEAST_SCORE, least_periods: int = LEAST_PERIODS
) -> DataFrame:
    """(word, n_period, n_plain, score) of the words that score enough.

    Words without a letter, or before fewer periods, are no abbreviations; null
    and empty texts count for nothing, repeated rows count each time.
    """
    counts = period_statistics(texts, text)
    total = counts.agg(
        F.struct(F.sum("n_period").alias("periods"), F.sum(F.col("n_period") + F.col("n_plain")).alias("words"))
    ).scalar()
    share = total["periods"] / total["words"]
    n_period, n_plain = F.col("n_period"), F.col("n_plain")
    # a word that is never plain leaves the term out: its factor is 0
    by_chance = n_period * F.ln(share) + F.when(n_plain > 0, n_plain * F.ln(1 - share)).otherwise(0.0)
    as_abbreviation = n_period * F.ln(F.lit(LIKELY)) + n_plain * F.ln(F.lit(1 - LIKELY))
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    chars = F.length("word") - inner
    score = 2 * (as_abbreviation - by_chance) * F.exp(-chars) * (inner + 1) * F.pow(chars, -n_plain)
    scored = counts.where((n_period >= max(1, least_periods)) & F.col("word").rlike(r"\p{L}")).withColumn("score", score)
    return scored.where(F.col("score") >= least_score)


def sentences_with_abbreviations(
    texts: DataFrame, keys: Sequence[str], known: DataFrame, text: str = "text", word: str = "word"
) -> DataFrame:
    """(keys, sentence, body): sentences that don't end at a period inside a word
    or after a word of ``known``; numbered from 0, stripped, blanks dropped.

    ``keys`` identify a text.  Texts are cut at their end marks first; a piece
    that ends in a known word and one period goes on with the next piece.  The
    table of known words is joined, so it may be of any size; as few words end most
    of the pieces, it is joined in ``WORD_PARTS`` copies and the pieces are dealt
    over them.  Null and empty texts have no sentences.
    """
    pieces = F.filter(F.split(text, RX_END), lambda p: p.rlike(r"[^.!?]"))
    cut = texts.select(*keys, F.posexplode(pieces).alias("_i", "_piece"))
    last = F.ltrim(F.lower(F.element_at(F.split("_piece", r"[^\p{L}\p{N}.]"), -1)), F.lit("."))
    one_period = F.endswith(last, F.lit(".")) & ~F.endswith(last, F.lit(".."))
    # no known word begins with a period, so pieces without a word match nothing, each by itself
    none = F.concat(F.lit("."), F.xxhash64(*keys, "_i").cast("string"))
    ended = cut.withColumn("_word", F.when(one_period, F.rtrim(last, F.lit("."))).otherwise(none))
    ended = ended.withColumn("_part", F.pmod(F.xxhash64(*keys, "_i"), F.lit(WORD_PARTS)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(WORD_PARTS - 1))).alias("_part")
    listed = known.select(F.col(word).alias("_word")).distinct().select("_word", parts, F.lit(True).alias("_goes_on"))
    in_text = Window.partitionBy(*keys).orderBy("_i")
    begins = F.coalesce(~F.lag("_goes_on").over(in_text), F.lit(True))
    flagged = ended.join(listed, ["_word", "_part"], "left").withColumn("_goes_on", F.coalesce("_goes_on", F.lit(False)))
    numbered = flagged.withColumn("_begins", begins.cast("int")).withColumn("_sentence", F.sum("_begins").over(in_text))
    in_order = F.sort_array(F.collect_list(F.struct("_i", "_piece")))
    whole = numbered.groupBy(*keys, "_sentence").agg(strip(F.array_join(F.transform(in_order, lambda p: p["_piece"]), "")).alias("body"))
    order = Window.partitionBy(*keys).orderBy("_sentence")
    return whole.where(F.col("body") != "").select(*keys, (F.row_number().over(order) - 1).cast("long").alias("sentence"), "body")
