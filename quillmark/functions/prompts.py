"""Prompts for the model calls, as column expressions over the fixed texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions import fixed_values as V
from quillmark.functions.chat import ChatTemplate, render_turns
from quillmark.functions.text import fill


def answer_prompt(question: Column, template: ChatTemplate = ChatTemplate(), system: str | None = None) -> Column:
    """Question with the brevity instruction; tuned models also get their system turn."""
    turns = [("user", F.concat(question, F.lit(V.ANSWER_INSTRUCTION)))]
    if system is not None:
        turns.insert(0, ("system", F.lit(system)))
    return render_turns(*turns, template=template, open_turn=True)


def judge_text(question: Column, expected: Column, generated: Column) -> Column:
    return fill(V.JUDGE_TEMPLATE, question=question, expected=expected, generated=generated)


def judge_prompt(
    question: Column, expected: Column, generated: Column, template: ChatTemplate = ChatTemplate()
) -> Column:
    """Yes-or-No question to the judge about one generated answer."""
    turns = [("system", F.lit(V.JUDGE_SYSTEM_TEXT)), ("user", judge_text(question, expected, generated))]
    return render_turns(*turns, template=template, open_turn=True)


def explain_prompt(sentence: Column, sentiment: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    user = fill(V.EXPLAIN_TEMPLATE, sentence=sentence, sentiment=sentiment)
    turns = [("system", F.lit(V.EXPLAIN_SYSTEM_TEXT)), ("user", user)]
    return render_turns(*turns, template=template, open_turn=True)


def _classify_text(text: Column) -> Column:
    return fill(V.CLASSIFY_INSTRUCTION + V.HEADLINE_TEMPLATE, text=text)


def classify_prompt(text: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """Headline to classify, the model's turn left open."""
    return render_turns(("user", _classify_text(text)), template=template, open_turn=True)


def supervised_prompt(
    text: Column, sentiment: Column, reasoning: Column, template: ChatTemplate = ChatTemplate()
) -> Column:
    """Headline with the tagged answer the model has to learn."""
    answer = fill(V.TAGGED_ANSWER_TEMPLATE, sentiment=sentiment, reasoning=reasoning)
    return render_turns(("user", _classify_text(text)), ("assistant", answer), template=template)


def reasoning_judge_prompt(
    sentence: Column, sentiment: Column, reasoning: Column, template: ChatTemplate = ChatTemplate()
) -> Column:
    """Scoring request for a reasoning; ``sentiment`` is the predicted label."""
    user = fill(V.REASONING_JUDGE_TEMPLATE, sentence=sentence, sentiment=sentiment, reasoning=reasoning)
    return render_turns(("user", user), template=template, open_turn=True)


def qa_prompt(text: Column) -> Column:
    return fill(V.QA_TEMPLATE, text=text)


def rating_prompt(pairs_json: Column) -> Column:
    return fill(V.RATING_TEMPLATE, pairs=pairs_json)


def summary_prompt(text: Column) -> Column:
    return F.concat(F.lit(V.SUMMARY_TEMPLATE), F.lit("\n"), text)
