"""String functions that follow Python's ``str`` and ``re`` rules on Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.fixed_values import HEADLINE_MARK

# Python's str.isspace set, derived rather than listed; all of it lies below U+3001.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# The same set as a pattern: Java's Unicode class lacks the four separators.
_WS = r"[\s\x1c-\x1f]"
_WS_NOT_BLANK = r"[\s\x1c-\x1f&&[^ ]]"

# Lone blanks are the common case and need no replacement, so they are not matched at all.
_RUNS = f"(?U){_WS_NOT_BLANK}{_WS}*| {_WS}+"

# The third branch swallows a brace that never closes on its line and puts it back ($1).
# Without it every such brace would scan to the end of the line again.
_BRACES = r"\{[^}\n]*+\}|\}|(\{[^}\n]*+)"


def strip(text: Column) -> Column:
    """``str.strip()``; a trim over a character set, linear and free of regular expressions."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """``" ".join(text.split())``."""
    return F.regexp_replace(strip(text), _RUNS, " ")


def split_words(text: Column, limit: int = -1) -> Column:
    """``text.split()``, at most ``limit`` pieces of which the last holds the rest."""
    return F.split(strip(text), f"(?U){_WS}+", limit)


def remove_braces(text: Column) -> Column:
    """Drop ``{...}`` (shortest match within one line) and stray ``}``; an unclosed ``{`` stays."""
    braced = F.contains(text, F.lit("{")) | F.contains(text, F.lit("}"))
    return F.when(braced, F.regexp_replace(text, _BRACES, "$1")).otherwise(text)


def clean_text(text: Column) -> Column:
    """Collapse whitespace, then drop braced parts. Gaps left by the braces stay."""
    return remove_braces(collapse_whitespace(text))


def extract_tag(text: Column, tag: str) -> Column:
    """Stripped body of the first ``<tag>...</tag>``; ``''`` for an empty body, null if absent.

    Only the first opening tag can match, as a close after a later one is also after the first;
    the anchor and the atomic group keep the search from trying the others.
    """
    pattern = rf"(?isu)\A(?>.*?(?=<{tag}>))(<{tag}>.*?</{tag}>)"
    whole = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    opening, both = len(tag) + 2, 2 * len(tag) + 5
    return strip(F.substring(whole, F.lit(opening + 1), F.length(whole) - both))


def tag_present(tag_value: Column) -> Column:
    """An empty tag counts as present."""
    return tag_value.isNotNull()


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def sentiment_label(tag_value: Column, raw: Column) -> Column:
    """First of positive, negative, neutral found in the tag (or, without one, in the whole reply)."""
    source = F.lower(F.coalesce(_filled(tag_value), raw))
    label = F.when(F.contains(source, F.lit("positive")), "positive")
    label = label.when(F.contains(source, F.lit("negative")), "negative")
    return label.when(F.contains(source, F.lit("neutral")), "neutral").otherwise("none")


def reasoning_text(tag_value: Column, raw: Column, fallback: str = "none") -> Column:
    """Reasoning tag, or ``"none"``; with ``fallback="raw"`` the whole reply instead."""
    if fallback not in ("none", "raw"):
        raise ValueError("fallback must be 'none' or 'raw'")
    return F.coalesce(_filled(tag_value), raw if fallback == "raw" else F.lit("none"))


def is_yes(reply: Column, strip_punct: bool = False) -> Column:
    """True if the first word of the reply is exactly ``yes``.

    ``"Yes, but"`` and ``"Yes."`` are False, since the first word carries its punctuation;
    ``strip_punct`` ignores punctuation around the word.
    """
    edge = r"\p{Punct}*" if strip_punct else ""
    pattern = rf"(?U)^{_WS}*{edge}[yY][eE][sS]{edge}({_WS}|\z)"
    return F.coalesce(F.regexp_like(reply, F.lit(pattern)), F.lit(False))


def score_1_to_10(reply: Column) -> Column:
    """First standalone number from 1 to 10, else null."""
    found = F.regexp_substr(reply, F.lit(r"(?U)\b([1-9]|10)\b"))
    return found.try_cast("int")


def contains_answer(expected: Column, generated: Column) -> Column:
    """Case-insensitive substring test; a missing side is a miss."""
    return F.coalesce(F.contains(F.lower(generated), F.lower(expected)), F.lit(False))


def headline_of(prompt: Column) -> Column:
    """What follows the first headline mark of a rendered prompt."""
    return F.element_at(F.split(prompt, HEADLINE_MARK, 2), -1)


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    """True if one of the words occurs in the text (case-sensitive); a null text has none."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return F.coalesce(hit, F.lit(False))


def fill(template: str, **values: Column) -> Column:
    """Put columns in the ``{name}`` places of a literal template as one concat."""
    parts, rest = [], template
    while True:
        hits = [(rest.find("{%s}" % name), name) for name in values if "{%s}" % name in rest]
        if not hits:
            break
        at, name = min(hits)
        parts += [F.lit(rest[:at]), values[name]]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts, F.lit(rest))
