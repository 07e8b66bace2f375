"""Lengths of whole conversations from their turns.

A conversation's text is one line per turn, and no token crosses a line break, so
the length of all turns so far is a running sum of the turns' own lengths.  Text is
put together only for the rows whose text is asked for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.functions.chat import role_label
from pairforge.functions.text import TokenCounter, token_count

#: Order numbers that share a window; a longer conversation takes several.
BLOCK = 4096


def turn_line(role: Column, text: Column) -> Column:
    """``Label: text``; null for a turn without role or text, which has no line."""
    return F.concat(role_label(role), F.lit(": "), text)


def with_running_sums(
    rows: DataFrame, key: str, order: str, sums: Mapping[str, Column], block: int = BLOCK
) -> DataFrame:
    """Add, for each name, the sum of its column over the key's rows up to this one.

    Rows are summed inside blocks of ``block`` order numbers, and the blocks'
    totals (one row each) are summed in turn, so that a key with a large share of
    all rows is spread over many tasks.  Nulls count as nothing.  Rows of equal
    order come in any order.
    """
    numbered = rows.withColumns(
        {"_block": F.floor(F.col(order) / block), **{f"_{n}": F.coalesce(c, F.lit(0)) for n, c in sums.items()}}
    )
    inside = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = numbered.groupBy(key, "_block").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
    earlier = totals.select(
        F.col(key).alias("_key"),
        F.col("_block").alias("_at"),
        *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in sums],
    )
    summed = numbered.withColumns({f"_{n}": F.sum(f"_{n}").over(inside) for n in sums})
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_block").eqNullSafe(F.col("_at"))
    return summed.join(earlier, same).select(
        *[F.col(f"`{c}`") for c in rows.columns], *[(F.col(f"_{n}") + F.col(f"_{n}_before")).alias(n) for n in sums]
    )


def reply_lengths(
    turns: DataFrame, default_system: str, counter: str | TokenCounter = "regex", block: int = BLOCK
) -> DataFrame:
    """One row per user turn of (conv_id, turn, role, text), measured without text.

    A side is every turn up to the user turn, then the reply: the assistant turn
    right after for ``chosen``, the next assistant turn after that for
    ``rejected``.  ``default_system`` comes first where no system text came so far.
    Adds ``chosen_turn`` and ``rejected_turn`` (null without a reply),
    ``chosen_length`` and ``rejected_length`` in tokens, ``chosen_blank`` and
    ``rejected_blank``; a side without a reply is blank and has length 0.
    """
    role, text = F.col("role"), F.col("text")
    counted = turns.select(
        "conv_id",
        "turn",
        "role",
        token_count(turn_line(role, text), counter).alias("_tokens"),
        F.when((role == "assistant") & text.isNotNull(), F.col("turn")).alias("_said"),
        ((role == "system") & text.isNotNull()).cast("int").alias("_system"),
    )
    summed = with_running_sums(
        counted, "conv_id", "turn", {"so_far": F.col("_tokens"), "systems": F.col("_system")}, block
    )
    order = Window.partitionBy("conv_id").orderBy("turn")
    reply = F.when(F.col("_said").isNotNull(), F.struct("_said", "_tokens"))
    placed = summed.withColumns({"_reply": reply}).withColumns(
        {
            "_next": F.lead("_reply").over(order),
            "_one": F.expr("lead(_reply, 1) ignore nulls over (partition by conv_id order by turn)"),
            "_two": F.expr("lead(_reply, 2) ignore nulls over (partition by conv_id order by turn)"),
        }
    )
    asked = placed.filter(role == "user").withColumns(
        {"_chosen": F.col("_next"), "_rejected": F.when(F.col("_next").isNull(), F.col("_one")).otherwise(F.col("_two"))}
    )
    extra = token_count(turn_line(F.lit("system"), F.lit(default_system)), counter)
    before = F.col("so_far") + F.when(F.col("systems") > 0, 0).otherwise(extra)

    def side(name: str) -> list[Column]:
        there = F.col(f"_{name}").isNotNull()
        return [
            F.col(f"_{name}._said").alias(f"{name}_turn"),
            F.when(there, before + F.col(f"_{name}._tokens")).otherwise(0).cast("long").alias(f"{name}_length"),
            (~there).alias(f"{name}_blank"),
        ]

    return asked.select("conv_id", "turn", *side("chosen"), *side("rejected"))


def with_side_texts(measured: DataFrame, turns: DataFrame, default_system: str) -> DataFrame:
    """Add ``chosen_text`` and ``rejected_text`` to rows of ``reply_lengths``.

    For the rows whose text is wanted: each brings its turns together once.
    """
    wanted = measured.select("conv_id", "turn", "chosen_turn", "rejected_turn")
    lines = turns.select(
        F.col("conv_id").alias("_conv"),
        F.col("turn").alias("_turn"),
        ((F.col("role") == "system") & F.col("text").isNotNull()).alias("_system"),
        turn_line(F.col("role"), F.col("text")).alias("_line"),
    ).filter(F.col("_line").isNotNull())
    until = F.greatest("turn", "chosen_turn", "rejected_turn")
    met = lines.join(wanted, (F.col("_conv") == F.col("conv_id")) & (F.col("_turn") <= until))
    entry = F.struct("_turn", "_line")
    early = F.when(F.col("_turn") <= F.col("turn"), entry)
    parts = met.groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(early)).alias("_before"),
        F.max(F.when(F.col("_turn") <= F.col("turn"), F.col("_system"))).alias("_has"),
        *[F.max(F.when(F.col("_turn") == F.col(f"{s}_turn"), F.col("_line"))).alias(f"_{s}") for s in ("chosen", "rejected")],
    )
    first = F.when(F.coalesce("_has", F.lit(False)), F.array()).otherwise(F.array(turn_line(F.lit("system"), F.lit(default_system))))
    before = F.concat(first.cast("array<string>"), F.col("_before._line"))

    def side(name: str) -> Column:
        there = F.col(f"{name}_turn").isNotNull()
        return F.when(there, F.array_join(F.concat(F.coalesce(before, first), F.array(f"_{name}")), "\n")).otherwise("")

    return measured.join(parts, ["conv_id", "turn"], "left").select(
        *measured.columns, side("chosen").alias("chosen_text"), side("rejected").alias("rejected_text")
    )
