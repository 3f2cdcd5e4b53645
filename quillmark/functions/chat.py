"""Functions over one conversation held as ``array<struct<role, content>>``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.fixed_values import (
    DEFAULT_SYSTEM_TEXT,
    STOP_PHRASES,
    TURN_END,
    TURN_START,
)

MESSAGES = "array<struct<role: string, content: string>>"


@dataclass(frozen=True)
class ChatTemplate:
    """How a tokenizer writes turns. Only the turn markers are settled; the rest is the model's."""

    start: str = TURN_START
    after_role: str = "\n"
    end: str = TURN_END + "\n"
    role_names: dict = field(default_factory=lambda: {"assistant": "model"})
    answering_role: str = "assistant"

    def opener(self) -> str:
        return f"{self.start}{self.role_names.get(self.answering_role, self.answering_role)}{self.after_role}"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def conversation(*messages: Column) -> Column:
    return F.array(*messages).cast(MESSAGES)


def qa_conversation(question: Column, answer: Column, system: str = DEFAULT_SYSTEM_TEXT) -> Column:
    """System, user and assistant turn from a question-answer pair."""
    return conversation(
        message("system", F.lit(system)), message("user", question), message("assistant", answer)
    )


def with_system_turn(messages: Column, system: str) -> Column:
    """Replace a leading system turn, or put one in front (also of an empty conversation)."""
    lead = conversation(message("system", F.lit(system)))
    has_system = F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "system", F.lit(False))
    rest = F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))
    return F.concat(lead, F.when(has_system, rest).otherwise(messages))


def stop_phrase_in(content: Column, phrases: tuple[str, ...] = STOP_PHRASES) -> Column:
    """True if a stop phrase occurs, whatever its case; a null content has none."""
    lowered = F.lower(content)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | F.contains(lowered, F.lit(phrase))
    return F.coalesce(hit, F.lit(False))


def is_useful(messages: Column, phrases: tuple[str, ...] = STOP_PHRASES) -> Column:
    """No turn of the conversation holds a stop phrase."""
    return ~F.exists(messages, lambda m: stop_phrase_in(m["content"], phrases))


def render(messages: Column, template: ChatTemplate = ChatTemplate(), open_turn: bool = False) -> Column:
    """Conversation as one string; ``open_turn`` ends it with the model's turn left open."""

    def turn(m: Column) -> Column:
        role = m["role"]
        for known, shown in template.role_names.items():
            role = F.when(m["role"] == known, F.lit(shown)).otherwise(role)
        content = F.coalesce(m["content"], F.lit(""))
        return F.concat(F.lit(template.start), role, F.lit(template.after_role), content, F.lit(template.end))

    body = F.array_join(F.transform(messages, turn), "")
    return F.concat(body, F.lit(template.opener())) if open_turn else body


def render_turns(
    *turns: tuple[str, Column], template: ChatTemplate = ChatTemplate(), open_turn: bool = False
) -> Column:
    """``render`` for turns known when the plan is written: one flat concat, no array is built."""
    parts = []
    for role, content in turns:
        head = f"{template.start}{template.role_names.get(role, role)}{template.after_role}"
        parts += [F.lit(head), F.coalesce(content, F.lit("")), F.lit(template.end)]
    if open_turn:
        parts.append(F.lit(template.opener()))
    return F.concat(*parts)
