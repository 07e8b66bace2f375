"""Preference pairs: assembly, validation, conversations, training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairforge import constants as K
from pairforge.functions import chat
from pairforge.functions.text import lookup
from pairforge.schemas import CONVERSATION, PAIR_COLUMNS


def flatten_pairs(pairs: DataFrame, source: str = "metadata") -> DataFrame:
    """Nested pairs to flat rows.

    ``source="metadata"`` takes id, name and category from the metadata struct;
    ``source="record"`` takes them from the top level of the record.
    """
    prefix = "metadata." if source == "metadata" else ""
    return pairs.select(
        F.coalesce("chosen", F.lit("")).alias("chosen"),
        F.coalesce("rejected", F.lit("")).alias("rejected"),
        *[F.col(f"{prefix}{name}").alias(name) for name in ("recipe_id", "recipe_name", "category")],
    )


def keep_columns(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col(f"`{name}`") for name in rows.columns if name in names])


def strip_session_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(*PAIR_COLUMNS)


def with_metadata(requests: DataFrame) -> DataFrame:
    """Metadata struct from recipe and question columns."""
    return requests.withColumn(
        "metadata",
        F.struct(
            F.col("recipe_id"),
            F.col("recipe_name"),
            F.col("category"),
            F.col("question_type").alias("context"),
            lookup(F.col("category"), K.DIFFICULTY_MAP, K.DEFAULT_DIFFICULTY).alias("difficulty_level"),
            F.coalesce("categoria", F.lit(K.DEFAULT_RECIPE_CATEGORY)).alias("recipe_category"),
            F.coalesce("pais", F.lit(K.DEFAULT_COUNTRY)).alias("recipe_country"),
        ),
    )


def system_message(category: Column) -> Column:
    kind = lookup(category, K.MESSAGE_TYPE_MAP, K.DEFAULT_MESSAGE_TYPE)
    return lookup(kind, K.SYSTEM_MESSAGES, K.SYSTEM_MESSAGES[K.DEFAULT_MESSAGE_TYPE])


def with_messages(requests: DataFrame) -> DataFrame:
    """Two-message array: system text by category, then the question."""
    return requests.withColumn(
        "messages",
        F.array(
            chat.message("system", system_message(F.col("category"))),
            chat.message("user", F.col("question")),
        ),
    )


def to_conversations(pairs: DataFrame) -> DataFrame:
    """Replace each reply by the whole conversation that ends in it."""

    def ending_in(reply: str) -> Column:
        turn = chat.message("assistant", F.col(reply))
        return F.array_append(F.col("messages").cast(CONVERSATION), turn).alias(reply)

    rest = [name for name in pairs.columns if name not in ("messages", "chosen", "rejected")]
    return pairs.select(*rest, ending_in("chosen"), ending_in("rejected"))


def fold_turns(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_size: int | None = None,
) -> DataFrame:
    """Conversation arrays from a turn-per-row table, in turn order.

    A conversation is one row.  With ``block_size``, for conversations that don't
    fit one row, it continues in rows ``block`` 0, 1, 2, ... by turn number.
    """
    entry = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"))
    block = F.floor(F.col(turn) / F.lit(block_size)).cast("long") if block_size else F.lit(0).cast("long")
    return (
        turns.groupBy(F.col(conv_id), block.alias("block"))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            conv_id,
            "block",
            F.transform(
                "entries", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))
            ).alias("conversation"),
        )
    )


def _messages_ok(messages: Column) -> Column:
    return (
        (F.size(messages) == 2)
        & (F.try_element_at(messages, F.lit(1))["role"] == "system")
        & (F.try_element_at(messages, F.lit(2))["role"] == "user")
    )


def _defects(metadata: str) -> dict[str, Column]:
    chosen, rejected, meta = F.col("chosen"), F.col("rejected"), F.col("metadata")
    if metadata == "map":
        absent = [~F.map_contains_key(meta, name) for name in K.REQUIRED_METADATA]
    else:
        absent = [meta[name].isNull() for name in K.REQUIRED_METADATA]
    missing_field = absent[0]
    for flag in absent[1:]:
        missing_field = missing_field | flag
    return {
        "no_messages": F.coalesce(F.size("messages") < 1, F.lit(True)),
        "no_chosen": F.coalesce(chosen == "", F.lit(True)),
        "no_rejected": F.coalesce(rejected == "", F.lit(True)),
        "no_metadata": meta.isNull(),
        "bad_messages": ~F.coalesce(_messages_ok(F.col("messages")), F.lit(False)),
        "short_chosen": F.length(chosen) < K.MIN_CHOSEN_CHARS,
        "short_rejected": F.length(rejected) < K.MIN_REJECTED_CHARS,
        "same_reply": chosen == rejected,
        "incomplete_metadata": missing_field,
    }


def is_valid_pair(metadata: str = "struct") -> Column:
    """True for a pair that may be saved; never null.

    With ``metadata="map"`` a required key only has to be present; a struct
    cannot tell absent from null, so there its value must not be null.
    """
    ok = F.lit(True)
    for flag in _defects(metadata).values():
        ok = ok & ~F.coalesce(flag, F.lit(False))
    return ok


def valid_pairs(pairs: DataFrame, metadata: str = "struct") -> DataFrame:
    return pairs.filter(is_valid_pair(metadata))


def pair_defects(pairs: DataFrame, metadata: str = "struct") -> DataFrame:
    """Adds the array ``defects`` of reason codes, empty for a valid pair."""
    codes = [F.when(flag, F.lit(code)) for code, flag in _defects(metadata).items()]
    return pairs.withColumn("defects", F.array_compact(F.array(*codes)))


def stamp(pairs: DataFrame, session_id: str | Column, timestamp: Column) -> DataFrame:
    """Add the ISO timestamp text and the session id (one, or a column)."""
    return pairs.withColumns(
        {
            "timestamp": F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "session_id": F.lit(session_id),  # a column stays as it is
        }
    )


def session_stats(pairs: DataFrame) -> DataFrame:
    """Per session: totals, distinct counts, and pairs per category and recipe.

    Long form (session_id, stat, label, n), because the number of recipes in a
    session has no bound.  Counts are combined before the shuffle.
    """
    label = lambda name: F.coalesce(F.col(f"metadata.{name}"), F.lit("unknown"))
    dimension = F.explode(
        F.array(
            F.struct(F.lit("category").alias("stat"), label("category").alias("label")),
            F.struct(F.lit("recipe").alias("stat"), label("recipe_name").alias("label")),
        )
    )
    counts = (
        pairs.select("session_id", dimension.alias("d"))
        .groupBy("session_id", "d.stat", "d.label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rollup = (
        counts.groupBy("session_id")
        .agg(
            F.sum(F.when(F.col("stat") == "category", F.col("n"))).alias("total_pairs"),
            F.count_if(F.col("stat") == "category").alias("unique_categories"),
            F.count_if(F.col("stat") == "recipe").alias("unique_recipes"),
        )
        .unpivot("session_id", ["total_pairs", "unique_categories", "unique_recipes"], "stat", "n")
        .select("session_id", "stat", F.lit("").alias("label"), "n")
    )
    return counts.unionByName(rollup)


def run_outcome(pairs: DataFrame, metadata: str = "struct") -> DataFrame:
    """Saved and failed counts per recipe, plus one total row (null recipe)."""
    ok = is_valid_pair(metadata)
    outcome = pairs.select(F.col("metadata")["recipe_id"].alias("recipe_id"), ok.alias("ok"))
    return (
        outcome.rollup("recipe_id")
        .agg(
            F.grouping("recipe_id").cast("long").alias("is_total"),
            F.count_if("ok").alias("saved"),
            F.count_if(~F.col("ok")).alias("failed"),
        )
        .select("recipe_id", "is_total", "saved", "failed")
    )


def preference_rows(pairs: DataFrame, drop_invalid: bool = False, **markup: str) -> DataFrame:
    """Conversation pairs to prompt/chosen/rejected training rows.

    An invalid pair becomes three empty strings and stays in the set unless
    ``drop_invalid`` is given.
    """
    chosen, rejected = F.col("chosen"), F.col("rejected")
    final_chosen, final_rejected = chat.last_message(chosen), chat.last_message(rejected)
    valid = F.coalesce(
        (F.size(chosen) >= 2)
        & (F.size(rejected) >= 2)
        & (final_chosen["role"] == "assistant")
        & (final_rejected["role"] == "assistant"),
        F.lit(False),
    )
    prompt_turns = F.slice(chosen, F.lit(1), F.greatest(F.size(chosen) - 1, F.lit(0)))
    rest = [name for name in pairs.columns if name not in ("prompt", "chosen", "rejected")]
    if drop_invalid:
        pairs = pairs.filter(valid)

    def or_empty(value: Column) -> Column:
        return F.when(valid, value).otherwise("")

    return pairs.select(
        *rest,
        or_empty(chat.render_chatml(prompt_turns, add_generation_prompt=True, **markup)).alias("prompt"),
        or_empty(final_chosen["content"]).alias("chosen"),
        or_empty(final_rejected["content"]).alias("rejected"),
    )


def preference_counts(rows: DataFrame) -> DataFrame:
    return rows.agg(
        *[F.count_if(F.col(name) != "").alias(f"n_{name}") for name in ("prompt", "chosen", "rejected")]
    )


def standardize_turns(rows: DataFrame, column: str = "messages") -> DataFrame:
    """Parse JSON-text conversations; array columns pass through unchanged."""
    if isinstance(rows.schema[column].dataType, T.StringType):
        return rows.withColumn(column, chat.parse_conversation(F.col(column)))
    return rows


def drop_multi_turn(rows: DataFrame, kind: str = "metadata.type") -> DataFrame:
    """Drop rows marked multi-turn; rows without a mark stay."""
    return rows.filter(~F.col(f"`{kind}`").eqNullSafe("multi_turn"))


def single_turn(rows: DataFrame, column: str = "messages") -> DataFrame:
    return rows.filter(F.size(column) == 2)


def sft_rows(rows: DataFrame, column: str = "messages", **markup: str) -> DataFrame:
    return rows.withColumn("text", chat.render_chatml(F.col(column), **markup))
