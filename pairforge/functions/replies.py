"""Expressions that recover JSON from model-written text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.text import let, strip

_STRICT = {"allowSingleQuotes": "false"}


def strip_code_fence(col: Column) -> Column:
    """Drop one opening fence (with or without ``json``) and one closing fence."""
    opened = F.regexp_replace(strip(col), r"\A```(?:json)?", "")
    return strip(F.regexp_replace(opened, r"```\z", ""))


def repair_trailing_commas(col: Column) -> Column:
    """Drop commas before a closing bracket; what stands in a string stays."""
    return F.regexp_replace(col, K.RX_TRAILING_COMMA, "$1$2")


def json_elements(text: Column) -> Column:
    """Elements (as JSON text) of a text that is exactly one JSON array.

    ``from_json`` ignores whatever follows the first value, so the text is
    parsed twice inside wrappers that leave no room for a second value: as the
    only member of an object and as the only element of an array.
    """
    looks_right = F.startswith(text, F.lit("[")) & F.endswith(text, F.lit("]"))
    as_member = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), "v array<string>", _STRICT
    )["v"]
    as_element = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _STRICT)
    return F.when(looks_right & (F.size(as_element) == 1), as_member)


def is_single_value(text: Column) -> Column:
    """True when the text is one JSON object or string with nothing after it."""
    wrapped = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _STRICT)
    return F.rlike(text, F.lit(r'\A[{"]')) & F.coalesce(F.size(wrapped) == 1, F.lit(False))


def reply_elements(reply: Column, lenient: bool = False) -> Column:
    """Array elements of a reply: whole text first, else first ``[`` to last ``]``.

    A reply that is valid JSON of another kind, or that stays unreadable, gives
    an empty array.  ``lenient`` also drops trailing commas, and takes the complete
    elements of an array that was cut off.
    """
    text = strip_code_fence(reply)
    if lenient:
        text = repair_trailing_commas(text)
    bracketed = F.regexp_extract(text, K.RX_ARRAY_SLICE, 0)
    found = F.when(~is_single_value(text), json_elements(bracketed))
    if lenient:
        begun = F.regexp_extract(text, K.RX_ARRAY_START, 0)
        found = F.coalesce(found, F.when(~is_single_value(text), json_elements(salvaged_text(begun))))
    return F.coalesce(found, F.array().cast("array<string>"))


def complete_prefix(text: Column) -> Column:
    """The text of an array up to its last complete element, closed.

    One walk over strings, brackets and commas keeps the depth; an element ends
    with its closing bracket or quote, any other one at the comma after it.  What
    follows an unclosed string is not looked at.  A text in which no element ends
    stays as it is.
    """
    start = F.struct(
        F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("cut"), F.lit(False).alias("broken")
    )

    def step(state: Column, piece: Column) -> Column:
        after = state["at"] + F.length(piece)
        closes = piece.isin("]", "}")
        depth = state["depth"] + F.when(piece.isin("[", "{"), 1).when(closes, -1).otherwise(0)
        whole = F.startswith(piece, F.lit('"')) & (F.length(piece) > 1) & (state["depth"] == 1)
        cut = (
            F.when(state["broken"], state["cut"])
            .when((closes & (depth == 1)) | whole, after)
            .when((piece == ",") & (state["depth"] == 1), state["at"])
            .otherwise(state["cut"])
        )
        return F.struct(
            depth.alias("depth"), after.alias("at"), cut.alias("cut"), (state["broken"] | (piece == '"')).alias("broken")
        )

    pieces = F.regexp_extract_all(text, F.lit(K.RX_JSON_PIECE), F.lit(0))
    cut = F.aggregate(pieces, start, step)["cut"]
    return let(cut, lambda n: F.when(n > 0, F.concat(F.substring(text, F.lit(1), n), F.lit("]"))).otherwise(text))


def salvaged_text(text: Column) -> Column:
    """An array that was cut off, closed after its last complete element."""

    def closed(body: Column) -> Column:
        cut = F.startswith(body, F.lit("[")) & json_elements(body).isNull()
        return F.when(cut, complete_prefix(body)).otherwise(body)

    return let(strip(text), closed)
