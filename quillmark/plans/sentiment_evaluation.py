"""Explain, predict and judge sentiment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.functions import prompts, text
from quillmark.functions import fixed_values as V
from quillmark.functions.labels import label_name
from quillmark.operators.corpus import within
from quillmark.operators.inference import ModelFactory, TokenBudget, run_model
from quillmark.operators.stages import Run, Watch, staged

CLASSES = ("negative", "neutral", "positive")
CLASSES_AND_NONE = (*CLASSES, "none")


def explain(labelled: DataFrame, teacher: ModelFactory, budget: int | TokenBudget | None = None, **hook) -> DataFrame:
    """``sentence, label`` (and any ids, ``split``) with the label's name and an explanation.

    ``budget`` cuts the sentence to so many words, or the prompt to so many tokens. ``hook`` are
    options of ``run_model``, here and below.
    """
    named = labelled.withColumn("sentiment", label_name(F.col("label")))
    shown, cut = within(F.col("sentence"), budget)
    prompted = named.withColumn("_prompt", prompts.explain_prompt(shown, F.col("sentiment")))
    explained = run_model(prompted, "_prompt", "explanation", teacher, budget=cut, **hook).drop("_prompt")
    return explained.withColumn("explanation", text.strip(F.col("explanation")))


def training_rows(explained: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Explained sentences under the names the prompts use."""
    return explained.select(*keep, "sentiment", F.col("sentence").alias("text"), F.col("explanation").alias("reasoning"))


def parse_replies(replies: DataFrame, raw: str = "raw_output", fallback: str = "none") -> DataFrame:
    """Label, reasoning and tag flags out of the raw replies."""
    tags = replies.withColumns(
        {"_sentiment": text.extract_tag(F.col(raw), "sentiment"), "_reasoning": text.extract_tag(F.col(raw), "reasoning")}
    )
    parsed = tags.withColumns(
        {
            "sentiment_pred": text.sentiment_label(F.col("_sentiment"), F.col(raw)),
            "reasoning_pred": text.reasoning_text(F.col("_reasoning"), F.col(raw), fallback),
            "sentiment_tag_present": text.tag_present(F.col("_sentiment")),
            "reasoning_tag_present": text.tag_present(F.col("_reasoning")),
        }
    )
    return parsed.drop("_sentiment", "_reasoning")


def predict(
    sentences: DataFrame,
    model: ModelFactory,
    sentence: str = "sentence",
    extra_inputs: Sequence[str] = (),
    fallback: str = "none",
    budget: int | TokenBudget | None = None,
    **hook,
) -> DataFrame:
    """Predicted label and reasoning for each sentence, of which ``budget`` words are shown, or tokens of the prompt."""
    shown, cut = within(F.col(sentence), budget)
    prompted = sentences.withColumn("_prompt", prompts.classify_prompt(shown))
    inputs = ["_prompt", *extra_inputs] if extra_inputs else "_prompt"
    replied = run_model(prompted, inputs, "raw_output", model, budget=cut, **hook).drop("_prompt")
    return parse_replies(replied, fallback=fallback)


def score_reasoning(
    parsed: DataFrame,
    judge: ModelFactory,
    sentence: str = "sentence",
    extra_inputs: Sequence[str] = (),
    budget: TokenBudget | None = None,
    **hook,
) -> DataFrame:
    """``reasoning_score`` per row; the judge is called only where there is a reasoning.

    Rows without one have no prompt and pass by the model; they get the default score.
    """
    missing = F.coalesce(F.lower("reasoning_pred") == "none", F.lit(True))
    prompt = prompts.reasoning_judge_prompt(F.col(sentence), F.col("sentiment_pred"), F.col("reasoning_pred"))
    prompted = parsed.withColumn("_prompt", F.when(~missing, prompt))
    inputs = ["_prompt", *extra_inputs] if extra_inputs else "_prompt"
    hook = {"batch_size": 8} | hook
    replied = run_model(prompted, inputs, "_reply", judge, skip_null=True, budget=budget, **hook)
    score = F.when(F.col("_prompt").isNull(), F.lit(V.MISSING_REASONING_SCORE)).otherwise(text.score_1_to_10(F.col("_reply")))
    return replied.withColumn("reasoning_score", score).drop("_prompt", "_reply")


def evaluate(
    sentences: DataFrame,
    model: ModelFactory,
    judge: ModelFactory,
    path: str,
    ids: Sequence[str],
    sentence: str = "sentence",
    model_inputs: Sequence[str] = (),
    judge_inputs: Sequence[str] = (),
    fallback: str = "none",
    parts: int | None = None,
    partitions: int | None = None,
    error_col: str | None = None,
    budget: int | TokenBudget | None = None,
    **hook,
) -> Run:
    """Predictions with scores of their reasoning, each model's stage written below ``path``; with counts.

    With ``parts`` both stages are resumed after a stop, by ``ids``. With ``error_col`` a row that
    fails keeps its message and has no score; the judge does not see what has no prediction.
    """
    failed = F.col(error_col).isNotNull() if error_col else F.lit(False)
    hook["error_col"] = error_col

    def predictions(some: DataFrame, watch: Watch) -> DataFrame:
        made = predict(some, model, sentence, model_inputs, fallback, budget, partitions=partitions, **hook)
        both = F.col("sentiment_tag_present") & F.col("reasoning_tag_present")
        return watch(made, n_rows=F.count(F.lit(1)), n_failed_predictions=F.count_if(failed), n_tagged=F.count_if(both))

    def scores(some: DataFrame, watch: Watch) -> DataFrame:
        made = score_reasoning(some, judge, sentence, judge_inputs, **hook)
        made = made.withColumn("reasoning_score", F.when(~failed, F.col("reasoning_score")))
        return watch(made, n_failed=F.count_if(failed), n_scored=F.count("reasoning_score"), n_unscored=F.count_if(F.col("reasoning_score").isNull() & ~failed))

    predicted = staged(sentences, ids, predictions, f"{path}/predictions", parts)
    scored = staged(predicted.data, ids, scores, f"{path}/scores", parts)
    return Run(scored.data, predicted.totals | scored.totals)
