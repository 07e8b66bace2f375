"""Expressions over conversations (arrays of role/content messages)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairforge import constants as K
from pairforge.functions.text import title_case
from pairforge.schemas import CONVERSATION

_ROLE_LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}

# Share-style exports name the speaker and text differently.
_SHARE_SCHEMA = "array<struct<role:string,content:string,from:string,value:string>>"
_SHARE_ROLES = {"human": "user", "gpt": "assistant", "user": "user", "assistant": "assistant", "system": "system"}


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def role_content(messages: Column, role: str) -> Column:
    """Content of the last message with this role, empty text if there is none."""
    hits = F.filter(messages, lambda m: m["role"] == role)
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["content"], F.lit(""))


def last_message(conversation: Column) -> Column:
    return F.try_element_at(conversation, F.lit(-1))


def role_label(role: Column) -> Column:
    label = title_case(role)
    for name, text in _ROLE_LABELS.items():
        label = F.when(role == name, F.lit(text)).otherwise(label)
    return label


def conversation_to_text(conversation: Column) -> Column:
    """``Label: content`` lines; incomplete messages skipped, null becomes ''."""
    complete = F.filter(conversation, lambda m: m["role"].isNotNull() & m["content"].isNotNull())
    lines = F.transform(complete, lambda m: F.concat(role_label(m["role"]), F.lit(": "), m["content"]))
    return F.coalesce(F.array_join(lines, "\n"), F.lit(""))


def render_chatml(
    conversation: Column, add_generation_prompt: bool = False, end_token: str = K.CHATML_END
) -> Column:
    """Training text with chat markup; ``end_token`` closes each turn.

    A null role or content is written as empty text, so no turn is lost.
    """
    turns = F.transform(
        conversation,
        lambda m: F.concat(
            F.lit(K.CHATML_START),
            F.coalesce(m["role"], F.lit("")),
            F.lit("\n"),
            F.coalesce(m["content"], F.lit("")),
            F.lit(end_token + "\n"),
        ),
    )
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(K.CHATML_OPENER)) if add_generation_prompt else text


def parse_conversation(json_text: Column) -> Column:
    """Conversation from JSON text, share-style keys mapped to role/content."""
    parsed = F.from_json(json_text, _SHARE_SCHEMA, {"allowSingleQuotes": "false"})
    known = F.create_map(*[F.lit(part) for item in _SHARE_ROLES.items() for part in item])
    return F.transform(
        parsed,
        lambda m: F.struct(
            F.coalesce(m["role"], F.try_element_at(known, m["from"]), m["from"]).alias("role"),
            F.coalesce(m["content"], m["value"]).alias("content"),
        ),
    ).cast(CONVERSATION)
