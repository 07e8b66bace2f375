"""Text expressions: stripping, tokens, words, sentences, previews, templates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import constants as K

TokenCounter = Callable[[], Callable[[str], int]]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row.

    Spark may otherwise compute it again at each use, and always does so inside
    a lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Trim every kind of Unicode whitespace on both ends (not just spaces)."""
    return F.btrim(col, F.lit(K.WHITESPACE_CHARS))


def is_blank(col: Column) -> Column:
    """True for null and for text with nothing but whitespace."""
    return F.coalesce(strip(col) == "", F.lit(True))


def tokens(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(K.RX_TOKEN), F.lit(0))


def token_count(col: Column, counter: str | TokenCounter = "regex") -> Column:
    """Token length of a text as a long.

    ``regex`` counts letter/digit runs and single symbols inside the JVM.  A
    caller with a trained tokenizer passes a factory instead: it is called once
    per Python worker and returns a function from text to token count.
    """
    if counter == "regex":
        return F.regexp_count(col, F.lit(K.RX_TOKEN)).cast("long")
    factory = counter

    @F.pandas_udf("long")
    def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = factory()
        for batch in batches:
            yield batch.map(count, na_action="ignore")

    return count_tokens(col)


def words(col: Column) -> Column:
    """Lower-cased alphanumeric runs."""
    return F.regexp_extract_all(F.lower(col), F.lit(K.RX_WORD), F.lit(0))


def content_words(col: Column, stop_words: list[str]) -> Column:
    if not stop_words:
        return words(col)
    return F.filter(words(col), lambda word: ~word.isin(stop_words))


def sentences(col: Column) -> Column:
    """Rule-based sentences: stripped, blanks dropped, in text order."""
    pieces = F.regexp_extract_all(col, F.lit(K.RX_SENTENCE), F.lit(0))
    return F.filter(F.transform(pieces, strip), lambda piece: piece != "")


def preview(col: Column, n: int = 200) -> Column:
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, n), F.lit("..."))).otherwise(col)


def title_case(col: Column) -> Column:
    """Capital after every non-letter, as in ``tool_call`` -> ``Tool_Call``."""
    runs = F.regexp_extract_all(col, F.lit(K.RX_LETTER_RUNS), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def lookup(col: Column, table: Mapping[str, str], default: str) -> Column:
    """Value of a small fixed dictionary, with a default for anything else."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), F.lit(default))


def fill_template(template: str, fields: Mapping[str, Column]) -> Column:
    """Concatenate a ``{name}`` template; null when any used field is null."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [
        fields[piece] if index % 2 else F.lit(piece)
        for index, piece in enumerate(pieces)
        if index % 2 or piece
    ]
    return F.concat(*parts)


def percent(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), total.cast("double")), digits)
