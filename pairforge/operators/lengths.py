"""Token-length reports and filters over conversation pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge.constants import MAX_TOKENS
from pairforge.functions.chat import conversation_to_text
from pairforge.functions.text import TokenCounter, is_blank, percent, preview, token_count

SIDES = ("chosen", "rejected")
MEASURED = ("chosen_text", "rejected_text", "chosen_length", "rejected_length")
BLANKS = ("chosen_blank", "rejected_blank")


def with_lengths(pairs: DataFrame, counter: str | TokenCounter = "regex") -> DataFrame:
    """Add text and token length of both sides, and whether they are blank.

    A side is a conversation, or a text, which counts as it is (null: empty).
    Conversations given turn by turn are measured by ``turns.reply_lengths``.
    """

    def side(name: str) -> Column:
        plain = isinstance(pairs.schema[name].dataType, T.StringType)
        return F.coalesce(F.col(name), F.lit("")) if plain else conversation_to_text(F.col(name))

    with_text = pairs.withColumns({f"{s}_text": side(s) for s in SIDES})
    return with_text.withColumns(
        {f"{s}_length": token_count(F.col(f"{s}_text"), counter) for s in SIDES}
        | {f"{s}_blank": is_blank(F.col(f"{s}_text")) for s in SIDES}
    )


def both_blank() -> Column:
    return F.col("chosen_blank") & F.col("rejected_blank")


def within_limit(max_length: int = MAX_TOKENS) -> Column:
    return (
        (F.col("chosen_length") <= max_length)
        & (F.col("rejected_length") <= max_length)
        & ~both_blank()
    )


def too_long(max_length: int = MAX_TOKENS) -> Column:
    over = (F.col("chosen_length") > max_length) | (F.col("rejected_length") > max_length)
    return over & ~both_blank()


def length_filter(measured: DataFrame, max_length: int = MAX_TOKENS) -> DataFrame:
    return measured.filter(within_limit(max_length))


def blank_pairs(measured: DataFrame) -> DataFrame:
    return measured.filter(both_blank())


def exceeds_by(length: Column, max_length: int) -> Column:
    return F.greatest(F.lit(0).cast("long"), length - F.lit(max_length))


def long_examples(measured: DataFrame, key: str, max_length: int = MAX_TOKENS) -> DataFrame:
    return measured.filter(too_long(max_length)).select(
        F.col(key).alias("index"),
        "chosen_length",
        "rejected_length",
        "chosen_text",
        "rejected_text",
        *[exceeds_by(F.col(f"{s}_length"), max_length).alias(f"exceeds_by_{s}") for s in SIDES],
    )


def first_long(measured: DataFrame, key: str, max_length: int = MAX_TOKENS, n: int = 5) -> DataFrame:
    """The first ``n`` over-limit rows by key; texts are not needed to find them."""
    return measured.filter(too_long(max_length)).orderBy(key).limit(n)


def sample_long(measured: DataFrame, key: str, max_length: int = MAX_TOKENS, n: int = 5) -> DataFrame:
    """The first ``n`` over-limit rows by key, with text previews."""
    return (
        long_examples(first_long(measured, key, max_length, n), key, max_length)
        .select(
            "index",
            "chosen_length",
            "rejected_length",
            *[preview(F.col(f"{s}_text")).alias(f"{s}_preview") for s in SIDES],
        )
    )


def _report_counts(max_length: int) -> list[Column]:
    over_chosen = F.col("chosen_length") > max_length
    over_rejected = F.col("rejected_length") > max_length
    used = ~both_blank()
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(both_blank()).alias("skipped"),
        F.count_if(too_long(max_length)).alias("exceeding"),
        F.count_if(over_chosen & used).alias("chosen_exceeds"),
        F.count_if(over_rejected & used).alias("rejected_exceeds"),
        F.count_if(over_chosen & over_rejected & used).alias("both_exceed"),
    ]


def length_report(measured: DataFrame, max_length: int = MAX_TOKENS) -> DataFrame:
    """One row of counts and shares, from one aggregate.

    ``within_pct_reported`` is 100 minus the over-limit share of all rows;
    ``within_pct_exact`` also takes the skipped rows out.
    """
    total, exceeding = F.col("total"), F.col("exceeding")
    within = total - exceeding - F.col("skipped")
    return measured.agg(*_report_counts(max_length)).select(
        (total - F.col("skipped")).alias("analyzed"),
        "skipped",
        "exceeding",
        percent(exceeding, total).alias("exceeding_pct"),
        within.alias("within_limit"),
        percent(total - exceeding, total).alias("within_pct_reported"),
        percent(within, total).alias("within_pct_exact"),
        "chosen_exceeds",
        "rejected_exceeds",
        "both_exceed",
    )


def long_side_stats(measured: DataFrame, max_length: int = MAX_TOKENS) -> DataFrame:
    """Count, max, min, mean over-limit length per side; no row when none."""
    return (
        measured.filter(too_long(max_length))
        .select("chosen_length", "rejected_length")
        .unpivot([], ["chosen_length", "rejected_length"], "side", "length")
        .filter(F.col("length") > max_length)
        .groupBy(F.regexp_replace("side", "_length$", "").alias("side"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("length").alias("max_length"),
            F.min("length").alias("min_length"),
            F.round(F.avg("length"), 1).alias("avg_length"),
        )
    )


def retention(measured: DataFrame, max_length: int = MAX_TOKENS) -> DataFrame:
    """Rows before and after the filter, from one pass over the measured table."""
    counted = measured.agg(
        F.count(F.lit(1)).alias("original"), F.count_if(within_limit(max_length)).alias("filtered")
    )
    return counted.select(
        "original",
        "filtered",
        (F.col("original") - F.col("filtered")).alias("removed"),
        percent(F.col("filtered"), F.col("original")).alias("retention_pct"),
    )


def pair_completeness(pairs: DataFrame, key: str, first_n: int = 100) -> DataFrame:
    """Null and blank counts of both sides over the first rows by key."""
    head = pairs.select(key, *SIDES).orderBy(key).limit(first_n)
    return head.agg(
        *[F.count_if(F.col(s).isNull()).alias(f"null_{s}") for s in SIDES],
        *[F.count_if(is_blank(conversation_to_text(F.col(s)))).alias(f"blank_{s}") for s in SIDES],
    )


def conversation_shape(pairs: DataFrame) -> DataFrame:
    """Distribution of message counts and first roles per side."""
    # only the two figures of a conversation leave its row
    sides = F.array(
        *[
            F.struct(
                F.lit(s).alias("side"),
                F.size(s).cast("long").alias("n_messages"),
                F.try_element_at(s, F.lit(1))["role"].alias("first_role"),
            )
            for s in SIDES
        ]
    )
    figures = pairs.select(F.explode(sides).alias("s")).select("s.*")
    return figures.groupBy("side", "n_messages", "first_role").agg(F.count(F.lit(1)).alias("n"))


def example_detail(measured: DataFrame, key: str, value: int) -> DataFrame:
    return measured.filter(F.col(key) == value).select(key, *MEASURED)
