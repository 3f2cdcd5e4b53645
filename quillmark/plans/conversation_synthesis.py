"""Pages to training conversations: records, chunks, pairs, ratings, split, filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.functions import chat, prompts
from quillmark.functions import fixed_values as V
from quillmark.operators import corpus, curation
from quillmark.operators.corpus import within
from quillmark.operators.inference import ModelFactory, TokenBudget, run_model
from quillmark.operators.sampling import train_eval_split
from quillmark.operators.stages import Run, Watch, staged


def write_pairs(chunks: DataFrame, keep: list[str], writer: ModelFactory, budget: int | TokenBudget | None = None, **hook) -> DataFrame:
    """Chunks with the pairs read from the writer's reply, null where it was unreadable, and ``n_salvaged`` of them.

    ``budget`` cuts the chunk to so many words, or the prompt to so many tokens. ``hook`` are
    options of ``run_model``; with ``partitions`` the chunks are dealt, not their longer prompts.
    """
    shown, cut = within(F.col("chunk"), budget)
    partitions = hook.pop("partitions", None)
    dealt = chunks.select(*keep, "chunk").repartition(partitions) if partitions else chunks
    prompted = dealt.select(*keep, prompts.qa_prompt(shown).alias("_prompt"))
    replied = run_model(prompted, "_prompt", "_reply", writer, budget=cut, keep_inputs=False, **hook)
    return curation.with_pairs(replied, "_reply").drop("_reply")


def rate_groups(
    written: DataFrame, keep: list[str], rater: ModelFactory, batch: int = V.RATING_BATCH, budget: TokenBudget | None = None, **hook
) -> DataFrame:
    """One row per rating prompt: ``keep, group_no, pairs`` as sent and ``rated`` as read from the reply.

    Four neighbours share a prompt, so no row moves for it.
    """
    groups = curation.rating_batches(written, "pairs", keep, batch)
    prompted = groups.select(*keep, "group_no", "pairs", prompts.rating_prompt(F.col("pairs_json")).alias("_prompt"))
    replied = run_model(prompted, "_prompt", "_reply", rater, budget=budget, keep_inputs=False, **hook)
    return replied.withColumn("rated", curation.parse_ratings(F.col("_reply"))).drop("_reply")


def rated_pairs(groups: DataFrame, keep: list[str], batch: int = V.RATING_BATCH) -> DataFrame:
    """One row per pair that was sent, with its rating or null; ``pair_no`` is its place in the chunk."""
    joined = groups.withColumn("_rated", curation.attach_ratings(F.col("pairs"), F.col("rated")))
    rows = curation.explode_pairs(joined.drop("pairs", "rated"), "_rated", [*keep, "group_no"])
    return rows.withColumn("pair_no", F.col("group_no") * batch + F.col("pair_no")).drop("group_no")


def rate_pairs(written: DataFrame, keep: list[str], rater: ModelFactory, batch: int = V.RATING_BATCH, **hook) -> DataFrame:
    """One row per pair, unrated where the rater's call failed; its message is in ``rate_groups``."""
    return rated_pairs(rate_groups(written, keep, rater, batch, **hook), keep, batch)


def curated(
    chunks: DataFrame,
    keep: list[str],
    writer: ModelFactory,
    rater: ModelFactory,
    path: str,
    threshold: float = V.RATING_THRESHOLD,
    partitions: int | None = None,
    parts: int | None = None,
    error_col: str | None = None,
    budget: int | TokenBudget | None = None,
    **hook,
) -> Run:
    """Pairs of the chunks that are rated at least ``threshold``, and what became of all others.

    Two stages, the writer's and the rater's; each is counted by the job that writes it. With
    ``error_col`` a failing chunk or rating prompt ends nothing: it is counted, its pairs are unrated.
    """
    failed = F.col(error_col).isNotNull() if error_col else F.lit(False)
    hook["error_col"] = error_col

    def write(some: DataFrame, watch: Watch) -> DataFrame:
        made = write_pairs(some, keep, writer, budget, partitions=partitions, **hook)
        pairs = F.col("pairs")
        return watch(
            made, n_chunks=F.count(F.lit(1)), n_failed_chunks=F.count_if(failed), n_unreadable_chunks=F.count_if(pairs.isNull() & ~failed),
            n_cut_replies=F.count_if(F.col("n_salvaged") > 0), n_salvaged=F.sum("n_salvaged"), n_written=F.sum(F.when(pairs.isNotNull(), F.size(pairs))),
        )

    def rate(some: DataFrame, watch: Watch) -> DataFrame:
        groups = rate_groups(some, keep, rater, **hook)
        sent, back = F.size("pairs"), F.when(F.col("rated").isNotNull(), F.size("rated"))
        groups = watch(
            groups, n_prompts=F.count(F.lit(1)), n_failed_ratings=F.count_if(failed), n_unreadable_ratings=F.count_if(back.isNull() & ~failed),
            n_short=F.count_if(back < sent), n_long=F.count_if(back > sent),
        )
        value = F.col("rating")
        pairs = watch(
            rated_pairs(groups, keep), n_pairs=F.count(F.lit(1)), n_kept=F.count_if(value >= threshold),
            n_below=F.count_if(value < threshold), n_unrated=F.count_if(value.isNull()),
        )
        return curation.keep_rated(pairs, threshold=threshold)

    written = staged(chunks, keep, write, f"{path}/pairs", parts)
    # A chunk that failed has no pairs; its message stays with the written chunks.
    readable = written.data.drop(error_col) if error_col else written.data
    rated = staged(readable, keep, rate, f"{path}/ratings", parts)
    return Run(rated.data, written.totals | rated.totals)


def synthesize(
    pages: DataFrame,
    page_id: str,
    writer: ModelFactory,
    rater: ModelFactory,
    system: str,
    path: str,
    threshold: float = V.RATING_THRESHOLD,
    seed: int = 0,
    blocked: Sequence[str] = V.BLOCKED_SUMMARY_WORDS,
    **options,
) -> Run:
    """``conv_id, split, messages``: rated, split, given the system turn, then filtered; with the counts of ``curated``.

    The split comes before the filter. Model output is written below ``path`` before reuse.
    ``options`` are those of ``curated``.
    """
    keep = [page_id, "piece", "chunk_no"]
    records = corpus.page_records(pages, blocked, keep=[page_id])
    chunks = corpus.chunk_text(records, "text", [page_id, "piece"])
    pairs = curated(chunks, keep, writer, rater, path, threshold, **options)
    conv_id = F.concat_ws("-", *[F.col(c).cast("string") for c in (*keep, "pair_no")])
    built = pairs.data.select(conv_id.alias("conv_id"), chat.qa_conversation(F.col("question"), F.col("answer")).alias("messages"))
    split = train_eval_split(built, "conv_id", seed, ids=built.select("conv_id"))
    ready = split.withColumn("messages", chat.with_system_turn(F.col("messages"), system))
    return Run(ready.where(chat.is_useful(F.col("messages"))).select("conv_id", "split", "messages"), pairs.totals)
