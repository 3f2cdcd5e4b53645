"""Sentiment labels between codes and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmark.functions.fixed_values import DEFAULT_LABEL_CODE, LABEL_CODES, LABEL_NAMES


def _lookup(mapping: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def label_name(code: Column, on_unknown: str = "raise") -> Column:
    """Code to name. An unknown code fails the job, or gives null with ``on_unknown="null"``."""
    name = _lookup(LABEL_NAMES, code)
    if on_unknown == "null":
        return name
    message = F.concat(F.lit("unknown label code: "), F.coalesce(code.cast("string"), F.lit("null")))
    return F.when(name.isNull(), F.raise_error(message)).otherwise(name)


def label_code(name: Column) -> Column:
    """Name to code; anything unknown counts as neutral."""
    return F.coalesce(_lookup(LABEL_CODES, name), F.lit(DEFAULT_LABEL_CODE))


def settle_none(label: Column, unknown_as: str = "none") -> Column:
    """``none`` predictions as their own class, or counted as neutral."""
    if unknown_as not in ("none", "neutral"):
        raise ValueError("unknown_as must be 'none' or 'neutral'")
    if unknown_as == "none":
        return label
    known = label.isin(*LABEL_CODES)
    return F.when(known, label).otherwise(LABEL_NAMES[DEFAULT_LABEL_CODE])
