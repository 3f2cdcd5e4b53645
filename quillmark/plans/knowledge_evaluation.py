"""Score a model on a question set: generate, score, embed, judge, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.functions import prompts
from quillmark.functions.chat import ChatTemplate
from quillmark.functions.fixed_values import SIMILARITY_THRESHOLD
from quillmark.functions.text import contains_answer, is_yes, strip
from quillmark.functions.vectors import at_least, cosine, perplexity
from quillmark.operators.corpus import within
from quillmark.operators.evaluation import grouped_report
from quillmark.operators.inference import ModelFactory, TokenBudget, run_model
from quillmark.operators.stages import Run, Stage, Watch, staged


@dataclass(frozen=True)
class Models:
    """Factories of the models one evaluation calls."""

    generate: ModelFactory
    score: ModelFactory
    embed: ModelFactory
    judge: ModelFactory


def generate_answers(
    questions: DataFrame,
    generate: ModelFactory,
    system: str | None = None,
    template: ChatTemplate = ChatTemplate(),
    budget: int | TokenBudget | None = None,
    **hook,
) -> DataFrame:
    """``id, question, expected_answer, difficulty`` with the model's answer and its prompt.

    ``budget`` cuts the question to so many words before it is put into the prompt, or the
    prompt to so many tokens. ``hook`` are options of ``run_model``, here and below.
    """
    asked, cut = within(F.col("question"), budget)
    prompted = questions.withColumn("prompt", prompts.answer_prompt(asked, template, system))
    answered = run_model(prompted, "prompt", "generated_answer", generate, budget=cut, **hook)
    return answered.withColumn("generated_answer", strip(F.col("generated_answer")))


def score_references(answered: DataFrame, score: ModelFactory, **hook) -> DataFrame:
    """The perplexity of the expected answer.

    The scorer gets (prompt, answer) and returns the log-probabilities of the answer's own
    tokens: only it knows how its tokenizer cuts the prompt.
    """
    scored = run_model(answered, ["prompt", "expected_answer"], "logprobs", score, out_type="array<double>", **hook)
    return scored.withColumn("perplexity", perplexity(F.col("logprobs"), F.lit(0))).drop("logprobs")


def _of_pairs(embed: ModelFactory) -> ModelFactory:
    """An embedder of pairs out of one of texts; one model for both sides."""

    def make():
        model = embed()

        def of(pairs):
            vectors = model([text for pair in pairs for text in pair])
            return [vectors[i : i + 2] for i in range(0, len(vectors), 2)]

        return of

    return make


def compare_embeddings(answered: DataFrame, embed: ModelFactory, **hook) -> DataFrame:
    """Similarity of expected and generated answer: one row, two vectors, one call, no pair table."""
    both = run_model(answered, ["expected_answer", "generated_answer"], "_both", _of_pairs(embed), out_type="array<array<float>>", **hook)
    return both.withColumn("semantic_similarity", cosine(F.col("_both")[0], F.col("_both")[1])).drop("_both")


def judge_answers(
    answered: DataFrame,
    judge: ModelFactory,
    template: ChatTemplate = ChatTemplate(),
    budget: TokenBudget | None = None,
    **hook,
) -> DataFrame:
    question = prompts.judge_prompt(F.col("question"), F.col("expected_answer"), F.col("generated_answer"), template)
    prompted = answered.withColumn("_prompt", question)
    judged = run_model(prompted, "_prompt", "judge_reply", judge, budget=budget, **hook).drop("_prompt")
    return judged.withColumn("is_correct_ai_eval", is_yes(F.col("judge_reply")))


STAGES = ("answers", "perplexity", "similarity", "verdicts")


def evaluate(
    questions: DataFrame,
    models: Models,
    path: str,
    system: str | None = None,
    threshold: float = SIMILARITY_THRESHOLD,
    template: ChatTemplate = ChatTemplate(),
    partitions: int | None = None,
    parts: int | None = None,
    ids: Sequence[str] = ("id",),
    error_col: str | None = None,
    budget: int | TokenBudget | None = None,
    **hook,
) -> Run:
    """Row-level results, written once below ``path``, one model per written stage; with counts.

    ``partitions`` deals the questions to so many shares once; later stages keep them. With
    ``parts`` each stage is resumed after a stop, by ``ids``. With ``error_col`` a row that
    fails in a stage passes by the later ones, keeps its message and has no verdicts; each
    stage counts the rows that failed up to its end, in the job that writes it.
    """
    hook["error_col"] = error_col

    def counted(name: str, stage) -> Stage:
        def run(some: DataFrame, watch: Watch) -> DataFrame:
            failed = F.count_if(F.col(error_col).isNotNull()) if error_col else F.sum(F.lit(0))
            return watch(stage(some), **{f"n_{name}": F.count(F.lit(1)), f"n_failed_by_{name}": failed})

        return run

    def judged(some: DataFrame) -> DataFrame:
        held = F.lit(True) if error_col is None else F.col(error_col).isNull()
        return judge_answers(some, models.judge, template, **hook).withColumns(
            {
                "is_correct_keyword": F.when(held, contains_answer(F.col("expected_answer"), F.col("generated_answer"))),
                "is_correct_semantic": F.when(held, at_least(F.col("semantic_similarity"), threshold)),
                "is_correct_ai_eval": F.when(held, F.col("is_correct_ai_eval")),
            }
        )

    steps = [
        lambda some: generate_answers(some, models.generate, system, template, budget, partitions=partitions, **hook),
        lambda some: score_references(some, models.score, **hook).drop("prompt"),
        lambda some: compare_embeddings(some, models.embed, **hook),
        judged,
    ]
    rows, totals = questions, {}
    for name, step in zip(STAGES, steps):
        run = staged(rows, ids, counted(name, step), f"{path}/{name}", parts)
        rows, totals = run.data, totals | run.totals
    return Run(rows, totals)


def report(results: DataFrame) -> DataFrame:
    """Accuracy by three methods, perplexity and headline score, per difficulty and overall."""
    return grouped_report(
        results,
        "difficulty",
        flags={
            "keyword_accuracy": F.col("is_correct_keyword"),
            "semantic_accuracy": F.col("is_correct_semantic"),
            "judge_accuracy": F.col("is_correct_ai_eval"),
        },
        means={"mean_perplexity": F.col("perplexity")},
        shares={"score": F.col("is_correct_ai_eval")},
    )
