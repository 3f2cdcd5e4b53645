"""Row-wise measures over arrays: paired similarity, perplexity, token slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.fixed_values import SIMILARITY_THRESHOLD


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of one row; null if a vector has no length."""
    a, b = a.cast("array<double>"), b.cast("array<double>")
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def at_least(similarity: Column, threshold: float = SIMILARITY_THRESHOLD) -> Column:
    """``similarity >= threshold``; null and NaN are below every threshold."""
    return F.coalesce((similarity >= F.lit(threshold)) & ~F.isnan(similarity), F.lit(False))


def after_prompt(tokens: Column, prompt_length: Column) -> Column:
    """Tokens that come after the prompt."""
    start = prompt_length.cast("int")
    return F.slice(tokens, start + 1, F.greatest(F.size(tokens) - start, F.lit(0)))


def perplexity(logprobs: Column, prompt_length: Column) -> Column:
    """``exp(mean negative log-probability)`` of the tokens after the prompt; null if there are none."""
    kept = after_prompt(logprobs, prompt_length)
    total = F.aggregate(kept, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.exp(-F.try_divide(total, F.size(kept)))


def defined(value: Column) -> Column:
    """NaN as null, so averages skip it."""
    return F.when(~F.isnan(value), value)
