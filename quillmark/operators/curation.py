"""Question-answer pairs out of model replies, rated and filtered."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.fixed_values import RATING_BATCH, RATING_THRESHOLD

PAIR = "array<struct<question: string, answer: string>>"
RATED_PAIR = "array<struct<question: string, answer: string, rating: string>>"


LEVELS = 8
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _object_pattern(levels: int) -> str:
    """A whole JSON object with objects in it, ``levels`` deep; braces in strings do not count."""
    body = rf"[^{{}}\"]++|{_STRING}"
    found = rf"\{{(?:{body})*+\}}"
    for _ in range(levels - 1):
        found = rf"\{{(?:{body}|{found})*+\}}"
    return found


def complete_objects(reply: Column, levels: int = LEVELS) -> Column:
    """The complete objects at the top level of the first array of objects in a reply, in order, as texts.

    The array need not end. The scan stops at the first object that does not end, or that is
    more than ``levels`` deep, so nothing inside a broken object is taken for one. Each match starts where the
    one before ended and nothing is given back, so the scan is linear in the reply. A null reply has none.
    """
    array = F.regexp_extract(reply, r"(?s)\A.*?(\[\s*+\{.*)", 1)
    pattern = rf"(?s)\G(?:[^{{\"]++|{_STRING})*+({_object_pattern(levels)})"
    return F.regexp_extract_all(F.coalesce(array, F.lit("")), F.lit(pattern), F.lit(1))


def parse_array(reply: Column, schema: str) -> Column:
    """The JSON array inside a reply, from the first ``[`` to the last ``]``; null if unreadable."""
    # Places in bytes: both searches end at their bracket, and no character of the array is counted. Without a
    # bracket, or with the last one before the first, the length is below 1 and the text empty.
    before, after = F.octet_length(F.substring_index(reply, "[", 1)), F.octet_length(F.substring_index(reply, "]", -1))
    array = F.substring(reply.cast("binary"), before + 1, F.octet_length(reply) - before - after).cast("string")
    return F.from_json(F.nullif(array, F.lit("")), schema)


def salvaged(reply: Column, schema: str) -> Column:
    """What is complete in a reply whose array is not readable: its objects that have all fields; null if there is none."""
    struct = schema.removeprefix("array<").removesuffix(">")
    fields = [f.split(":")[0].strip() for f in struct.removeprefix("struct<").removesuffix(">").split(",")]
    read = F.transform(complete_objects(reply), lambda o: F.from_json(o, struct))

    kept = F.filter(read, lambda o: reduce(and_, [o[f].isNotNull() for f in fields]))
    return F.when(F.size(kept) > 0, kept)


def _read_or_salvaged(reply: Column, schema: str) -> Column:
    array = parse_array(reply, schema)
    return F.coalesce(array, salvaged(reply, schema))


def parse_pairs(reply: Column) -> Column:
    """Pairs of a reply; of one that is cut off or broken, those that are complete."""
    return _read_or_salvaged(reply, PAIR)


def with_pairs(replies: DataFrame, reply: str, pairs_col: str = "pairs", salvaged_col: str = "n_salvaged") -> DataFrame:
    """Replies with their pairs and how many of them come out of an array that is not readable."""
    read = replies.withColumn("_array", parse_array(F.col(reply), PAIR))
    read = read.withColumn(pairs_col, F.coalesce("_array", salvaged(F.col(reply), PAIR)))
    rescued = F.when(F.col("_array").isNull() & F.col(pairs_col).isNotNull(), F.size(pairs_col)).otherwise(0)
    return read.withColumn(salvaged_col, rescued).drop("_array")


def parse_ratings(reply: Column) -> Column:
    """Rated pairs, complete ones of a broken reply; a rating may be a number or a quoted number."""
    return F.transform(
        _read_or_salvaged(reply, RATED_PAIR),
        lambda p: F.struct(
            p["question"].alias("question"), p["answer"].alias("answer"), p["rating"].try_cast("double").alias("rating")
        ),
    )


def rating_batches(df: DataFrame, pairs_col: str, keep: list[str], size: int = RATING_BATCH) -> DataFrame:
    """Groups of ``size`` neighbouring pairs of one row: the pairs, and as JSON for the rating prompt."""
    pairs = F.col(pairs_col)
    starts = F.sequence(F.lit(0), F.ceil(F.size(pairs) / size).cast("int") - 1)
    groups = F.transform(starts, lambda i: F.slice(pairs, i * size + 1, F.lit(size)))
    grouped = df.select(*keep, F.when(F.size(pairs) > 0, groups).alias("_groups"))
    exploded = grouped.select(*keep, F.posexplode_outer("_groups").alias("group_no", "pairs"))
    return exploded.where("group_no is not null").withColumn("pairs_json", F.to_json("pairs"))


def attach_ratings(pairs: Column, rated: Column) -> Column:
    """The pairs that were sent, each with its rating: by question where the reply repeats it, else by place.

    A pair is never lost: without a rating in the reply, or without a readable reply, it is null.
    Pairs that the reply adds or repeats are not taken over. Of sent pairs with one question, the
    first takes the first rating of that question, the second the second.
    """

    def looked_up(p: Column, i: Column) -> Column:
        echoed = F.filter(rated, lambda r: r["question"] == p["question"])
        same_before = F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda s: s["question"] == p["question"]))
        at_place = F.try_element_at(rated, i + 1)
        placed = F.when(at_place["question"].isNull(), at_place["rating"])
        return F.when(F.size(echoed) > 0, F.try_element_at(echoed, same_before + 1)["rating"]).otherwise(placed)

    def attached(rating: Callable[[Column, Column], Column]) -> Column:
        return F.transform(
            pairs, lambda p, i: F.struct(p["question"].alias("question"), p["answer"].alias("answer"), rating(p, i).alias("rating"))
        )

    # A reply with the sent questions in their order has each rating at its pair's place, also of equal and
    # of null questions, so nothing is looked up.
    in_order = pairs["question"] == rated["question"]
    return F.when(in_order, attached(lambda p, i: rated[i]["rating"])).otherwise(attached(looked_up))


def explode_pairs(df: DataFrame, pairs_col: str, keep: list[str]) -> DataFrame:
    """One row per pair with its position."""
    # Outer, or the array would be parsed once more to test its size.
    exploded = df.select(*keep, F.posexplode_outer(pairs_col).alias("pair_no", "_pair"))
    return exploded.where("pair_no is not null").select(*keep, "pair_no", "_pair.*")


def keep_rated(df: DataFrame, rating: str = "rating", threshold: float = RATING_THRESHOLD) -> DataFrame:
    """Pairs rated at least ``threshold``; unrated ones are dropped."""
    return df.where(F.col(rating) >= F.lit(threshold))


def pair_counts(rating: str = "rating", threshold: float = RATING_THRESHOLD) -> dict[str, Column]:
    """What the threshold keeps and drops, over a row per pair."""
    value = F.col(rating)
    return {
        "n_pairs": F.count(F.lit(1)),
        "n_kept": F.count_if(value >= threshold),
        "n_below": F.count_if(value < threshold),
        "n_unrated": F.count_if(value.isNull()),
    }


def chunk_counts(pairs_col: str = "pairs") -> dict[str, Column]:
    """Chunks and their pairs, over a row per chunk, its pairs null where the reply was unreadable."""
    pairs = F.col(pairs_col)
    return {
        "n_chunks": F.count(F.lit(1)),
        "n_unreadable_chunks": F.count_if(pairs.isNull()),
        "n_written": F.coalesce(F.sum(F.when(pairs.isNotNull(), F.size(pairs))), F.lit(0)),
    }


def prompt_counts() -> dict[str, Column]:
    """Rating prompts and how many ratings came back, over a row per prompt with ``pairs`` and ``rated``."""
    sent, back = F.size("pairs"), F.when(F.col("rated").isNotNull(), F.size("rated"))
    return {
        "n_prompts": F.count(F.lit(1)),
        "n_unreadable_ratings": F.count_if(back.isNull()),
        "n_short": F.count_if(back < sent),
        "n_long": F.count_if(back > sent),
        "n_extra": F.coalesce(F.sum(F.greatest(back - sent, F.lit(0))), F.lit(0)),
    }


def curation_counts(df: DataFrame, rating: str = "rating", threshold: float = RATING_THRESHOLD) -> DataFrame:
    """What the threshold keeps and drops."""
    return df.agg(*[count.alias(name) for name, count in pair_counts(rating, threshold).items()])


def in_one_row(*reports: DataFrame) -> DataFrame:
    """Reports of one row each, of different columns, as one row; without a cross join."""
    stacked = reports[0]
    for more in reports[1:]:
        stacked = stacked.unionByName(more, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def reply_counts(written: DataFrame, rated_groups: DataFrame, pairs_col: str = "pairs") -> DataFrame:
    """What writer and rater made of their prompts, in one row.

    ``written`` has a row per chunk, its pairs null where the reply was unreadable;
    ``rated_groups`` a row per rating prompt with ``pairs`` and ``rated``. Beside the replies,
    pairs sent, ratings that came back and how many replies had fewer or more than were sent.
    """
    chunks = written.agg(*[count.alias(name) for name, count in chunk_counts(pairs_col).items()])
    groups = rated_groups.agg(*[count.alias(name) for name, count in prompt_counts().items()])
    return in_one_row(chunks, groups)
