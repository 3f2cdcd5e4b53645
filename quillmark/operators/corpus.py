"""From pages to text records, chunks and truncated texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import fixed_values as V
from quillmark.functions.text import clean_text, has_any, split_words
from quillmark.operators.inference import TokenBudget

_MANY_CHUNKS = 8


def page_records(
    pages: DataFrame,
    blocked: Sequence[str] = V.BLOCKED_SUMMARY_WORDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One ``text`` per summary and section of ``title, summary, sections``.

    A blocked word in the summary drops the whole page. A piece has to be longer than the title,
    measured before cleaning. ``piece`` is 0 for the summary, then the section number.
    """
    allowed = pages.where(~has_any(F.col("summary"), tuple(blocked))) if blocked else pages
    pieces = F.concat(F.array("summary"), F.transform("sections", lambda s: s["text"]))
    # The outer form keeps the optimizer from testing the size of the array first, which would
    # build it twice; rows without a piece fall to the length rule.
    exploded = allowed.select(*keep, "title", F.posexplode_outer(pieces).alias("piece", "raw"))
    longer = exploded.where(F.length("raw") > F.length("title"))
    text = F.concat("title", F.lit(V.TITLE_SEPARATOR), clean_text(F.col("raw")))
    return longer.select(*keep, "title", "piece", text.alias("text"))


def _count(length: Column, size: int, overlap: int) -> Column:
    return F.greatest(F.ceil((length - overlap) / (size - overlap)), F.lit(1)).cast("int")


def _char_chunks(df: DataFrame, text_col: str, keep: Sequence[str], size: int, overlap: int) -> DataFrame:
    stride = size - overlap
    text, length, cut = F.col(text_col), F.col("_length"), F.col("_strides")
    measured = df.select(*keep, text_col, F.length(text).alias("_length"))
    numbers = F.sequence(F.lit(0), _count(length, size, overlap) - 1)
    # Substring counts from the start each time, which is quadratic in the length. A text of one byte a
    # character is cut at bytes, which counts nothing.
    plain = F.octet_length(text) == length
    raw = text.cast("binary")
    bytewise = F.transform(numbers, lambda i: F.substring(raw, i * stride + 1, F.lit(size)).cast("string"))
    short = F.transform(numbers, lambda i: F.substring(text, i * stride + 1, F.lit(size)))
    # Another text of many chunks is cut into strides in one go; a chunk is the head of the few strides it covers.
    strides = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    is_long = ~plain & (length > _MANY_CHUNKS * stride)
    staged = measured.select(*keep, text_col, "_length", plain.alias("_plain"), F.when(is_long, strides).alias("_strides"))
    covered = -(-size // stride)
    long = F.transform(
        numbers, lambda i: F.substring(F.array_join(F.slice(cut, i + 1, F.lit(covered)), ""), 1, size)
    )
    chunks = F.when(F.col("_plain"), bytewise).when(cut.isNotNull(), long).otherwise(short)
    return staged.select(*keep, chunks.alias("_chunks"))


def _word_chunks(df: DataFrame, text_col: str, keep: Sequence[str], size: int, overlap: int) -> DataFrame:
    stride = size - overlap
    words = F.col("_words")
    staged = df.select(*keep, split_words(F.col(text_col)).alias("_words"))
    numbers = F.sequence(F.lit(0), _count(F.size(words), size, overlap) - 1)
    windows = F.transform(numbers, lambda i: F.array_join(F.slice(words, i * stride + 1, F.lit(size)), " "))
    return staged.select(*keep, windows.alias("_chunks"))


def chunk_text(
    df: DataFrame,
    text_col: str,
    keep: Sequence[str],
    size: int = V.CHUNK_SIZE,
    overlap: int = V.CHUNK_OVERLAP,
    unit: str = "chars",
) -> DataFrame:
    """Overlapping windows over each text: ``keep..., chunk_no, chunk``.

    Windows start every ``size - overlap`` units; the last one ends with the text. An empty text
    gives one empty chunk, a null text none.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    cutter = {"chars": _char_chunks, "words": _word_chunks}[unit]
    chunked = cutter(df, text_col, keep, size, overlap)
    # Outer, or the optimizer would compute the chunks once more to test that there are any.
    return chunked.select(*keep, F.posexplode_outer("_chunks").alias("chunk_no", "chunk")).where("chunk is not null")


def truncate_words(text: Column, budget: int) -> Column:
    """First ``budget`` whitespace-separated words. Splitting stops once the budget is reached."""
    return F.array_join(F.slice(split_words(text, budget + 1), 1, budget), " ")


def within(text: Column, budget: int | TokenBudget | None) -> tuple[Column, TokenBudget | None]:
    """What a plan puts into its prompt, and the budget that is left to the model hook.

    A number cuts the text to so many words before the prompt is built; a budget in tokens is
    for the whole prompt, which only a tokenizer can cut.
    """
    if isinstance(budget, int):
        return truncate_words(text, budget), None
    return text, budget


def truncate_tokens(tokens: Column, budget: int) -> Column:
    """First ``budget`` tokens of a tokenizer's output."""
    return F.slice(tokens, 1, budget)
