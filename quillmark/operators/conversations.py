"""Conversations as tables.

Turns come flat: ``conv_id, turn, role, content`` with ``turn`` counting from 0. Packed, a
conversation is rows of ``conv_id, segment, messages``: segment s holds turns s*size to
(s+1)*size - 1, so that packing, filters and rendering of a conversation that holds a large
share of all turns are spread over tasks. ``whole_conversations`` and ``whole_texts`` put the
segments of a conversation together, in order: one row each, whatever the segment size.

Turn numbers have to be unique in a conversation; ``repeated_turns`` finds those that are not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import chat
from quillmark.functions.fixed_values import STOP_PHRASES

SEGMENT_TURNS = 256
BROADCAST_ROWS = 100_000
SKETCHED = 16_384


def segment_of(turn: Column, size: int = SEGMENT_TURNS) -> Column:
    return F.floor(turn / F.lit(size)).cast("bigint")


def pack_turns(turns: DataFrame, size: int = SEGMENT_TURNS) -> DataFrame:
    """Flat turns to ``messages`` rows, in turn order."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    messages = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    keyed = turns.select("conv_id", segment_of(F.col("turn"), size).alias("segment"), "turn", "role", "content")
    return keyed.groupBy("conv_id", "segment").agg(messages.alias("messages"))


def repeated_turns(turns: DataFrame) -> DataFrame:
    """Conversations and turn numbers that occur more than once."""
    return turns.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _in_order(segments: DataFrame, column: str) -> Column:
    parts = F.array_sort(F.collect_list(F.struct("segment", column)))
    return F.transform(parts, lambda p: p[column])


def whole_conversations(segments: DataFrame) -> DataFrame:
    """``conv_id, messages``: one row per conversation."""
    return segments.groupBy("conv_id").agg(F.flatten(_in_order(segments, "messages")).alias("messages"))


def whole_texts(rendered: DataFrame, column: str = "text") -> DataFrame:
    """``conv_id`` and the text of its rendered segments in order: one training text per conversation."""
    return rendered.groupBy("conv_id").agg(F.array_join(_in_order(rendered, column), "").alias(column))


def flatten_messages(conversations: DataFrame) -> DataFrame:
    """One row per turn of packed conversations."""
    return conversations.select("*", F.inline("messages")).drop("messages")


def replace_system_turn(segments: DataFrame, system: str) -> DataFrame:
    """One system turn at the start of every conversation: replaced or put in front."""
    new = chat.with_system_turn(F.col("messages"), system)
    return segments.withColumn("messages", F.when(F.col("segment") == 0, new).otherwise(F.col("messages")))


def render_segments(
    segments: DataFrame, template: chat.ChatTemplate = chat.ChatTemplate(), out: str = "text"
) -> DataFrame:
    """Training text of each row; segments of one conversation concatenate to its whole text."""
    return segments.withColumn(out, chat.render(F.col("messages"), template))


def keep_useful(
    segments: DataFrame,
    phrases: tuple[str, ...] = STOP_PHRASES,
    turns: DataFrame | None = None,
    size: int = SEGMENT_TURNS,
) -> DataFrame:
    """Drop every conversation in which any turn holds a stop phrase.

    The verdict of a conversation is spread to its segments before the anti join, so the join
    key is unique and no conversation gathers in one task. With the flat ``turns`` the segments
    were packed from, verdicts come from a scan of them and no text is shuffled for it.
    """
    if turns is None:
        found = segments.select("conv_id", "segment", (~chat.is_useful(F.col("messages"), phrases)).alias("bad"))
    else:
        flag = chat.stop_phrase_in(F.col("content"), phrases)
        found = turns.select("conv_id", segment_of(F.col("turn"), size).alias("segment"), flag.alias("bad"))
    verdicts = found.groupBy("conv_id").agg(F.bool_or("bad").alias("bad"), F.max("segment").alias("last"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("last"))
    dropped = verdicts.where("bad").select("conv_id", F.explode(numbers).alias("segment"))
    return segments.join(dropped, ["conv_id", "segment"], "left_anti")


def conversation_verdicts(turns: DataFrame, phrases: tuple[str, ...] = STOP_PHRASES) -> DataFrame:
    """Turn count and usefulness per conversation, straight from flat turns.

    Content is tested before the shuffle; only flags and counts travel.
    """
    flagged = turns.select("conv_id", chat.stop_phrase_in(F.col("content"), phrases).alias("bad"))
    return flagged.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), (~F.bool_or("bad")).alias("useful")
    )


def most_common_contents(turns: DataFrame, content: Column, k: int = 50) -> DataFrame:
    """The ``k`` most frequent contents with their counts, ties by digest.

    Counting runs on 16-byte digests, so texts are not shuffled. The ``k`` winners are
    broadcast, up to a bound, to fetch the texts back.
    """
    keyed = turns.select(content.alias("content")).where(F.col("content").isNotNull())
    keyed = keyed.select(F.unhex(F.md5("content")).alias("digest"), "content")
    counts = keyed.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "digest").limit(k)
    winners = F.broadcast(top) if k <= BROADCAST_ROWS else top
    texts = keyed.join(winners, "digest").select("digest", "n", "content").distinct()
    return texts.select(F.lower(F.hex("digest")).alias("digest"), "content", "n")


def sketched_counts(digests: DataFrame, tracked: int, fan: int = 64) -> DataFrame:
    """``digest`` of up to ``tracked`` candidates for the most frequent ones, out of mergeable sketches.

    A sketch for each task, merged by ``fan`` tasks and then by one: what is shuffled and what is
    held is bounded by sketches, however many different digests there are.
    """
    dealt = digests.select("digest", F.pmod(F.spark_partition_id(), F.lit(fan)).alias("part"))
    some = dealt.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("sketch"))
    one = some.agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    return one.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("item")).select(F.col("item.item").alias("digest"))


def frequent_contents(turns: DataFrame, content: Column, k: int = 50, tracked: int = SKETCHED) -> DataFrame:
    """``most_common_contents`` without a shuffle of all digests, if a few contents are frequent.

    A sketch names candidates, which alone are counted exactly. Its error is at most 3.5 over
    the size of its map, as a share of all rows, and what it does not name has a count of twice that at most. If the
    last of the ``k`` has more, no other content can be among them; else all are counted.
    """
    keyed = turns.select(content.alias("content")).where(F.col("content").isNotNull())
    digests = keyed.select(F.md5("content").alias("digest"))
    candidates = sketched_counts(digests, tracked)
    counted = digests.join(F.broadcast(candidates), "digest", "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    top = counted.orderBy(F.desc("n"), "digest").limit(k).collect()  # k rows
    map_size = 1 << math.ceil(math.log2(math.ceil(tracked / 0.75)))
    unnamed = 2 * 3.5 / map_size * digests.count()
    if len(top) < k or top[-1]["n"] <= unnamed:
        return most_common_contents(turns, content, k)
    winners = F.broadcast(turns.sparkSession.createDataFrame([(r["digest"], r["n"]) for r in top], "digest string, n long"))
    texts = keyed.withColumn("digest", F.md5("content")).join(winners, "digest")
    return texts.select("digest", "n", "content").distinct().select("digest", "content", "n")


def filter_counts(verdicts: DataFrame, by: str) -> DataFrame:
    """Conversations before and after the usefulness filter."""
    return verdicts.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if("useful").alias("n_after")
    )


def step_budget(
    df: DataFrame, batch: int = 1, accumulation: int = 8, epochs: int = 1, warmup_ratio: float = 0.1
) -> DataFrame:
    """Optimizer steps for a training table of this size."""
    sized = df.agg(F.count(F.lit(1)).alias("n"))
    steps = F.ceil(F.col("n") / F.lit(batch * accumulation)).cast("bigint")
    counted = sized.withColumn("steps_per_epoch", steps)
    counted = counted.withColumn("total_steps", F.col("steps_per_epoch") * F.lit(epochs))
    warmup = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(warmup_ratio) * F.col("total_steps")).cast("bigint"))
    return counted.withColumn("warmup_steps", warmup)
