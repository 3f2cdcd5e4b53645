"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import chat, labels, prompts, text, vectors
from quillmark.functions import fixed_values as V
from quillmark.operators import (
    categories,
    classification,
    conversations,
    corpus,
    curation,
    evaluation,
    inference,
    sampling,
    stages,
    training_logs,
)
from quillmark.plans import conversation_synthesis as synthesis
from quillmark.plans import fixtures, standins
from quillmark.plans import knowledge_evaluation as knowledge
from quillmark.plans import sentiment_evaluation as sentiment
from quillmark.session import run_dir
from quillmark.sources import files, sinks, tables

SYSTEM_TEXT = "You answer questions about the collection."
SEED_CATEGORY = "R1"
SHARD_ROWS = 64
BLOCKED = ("track(1",)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def workers(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Shares for model calls: one for each core, or for each scan task of the table if these are more.

    The tables here are a scan task each; with larger ones the shares become more, not longer.
    """
    return max(spark.sparkContext.defaultParallelism, fixtures.table(spark, sf_dir, name).rdd.getNumPartitions())


def _md5(name: str) -> Column:
    return F.md5(F.col(name)).alias(f"{name}_md5")


# --- answers to questions ---------------------------------------------------


def _keyword() -> Column:
    return text.contains_answer(F.col("expected_answer"), F.col("generated_answer"))


def _verdict() -> Column:
    return text.is_yes(F.col("judge_reply"))


def _answers_with_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected, generated = F.col("expected_answer"), F.col("generated_answer")
    rows = fixtures.qa_results(spark, sf_dir).select(
        "difficulty",
        _keyword().alias("is_correct_keyword"),
        _verdict().alias("is_correct_ai_eval"),
        vectors.perplexity(fixtures.word_scores(expected), F.lit(0)).alias("perplexity"),
        fixtures.letter_vector(expected).alias("e"),
        fixtures.letter_vector(generated).alias("g"),
    )
    return rows.withColumn("is_correct_semantic", vectors.at_least(vectors.cosine(F.col("e"), F.col("g")), 0.7))


@query
def keyword_accuracy_by_difficulty(spark, sf_dir):
    rows = fixtures.qa_results(spark, sf_dir)
    return evaluation.grouped_report(rows, "difficulty", flags={"keyword_accuracy": _keyword()})


@query
def judge_accuracy_by_difficulty(spark, sf_dir):
    rows = fixtures.qa_results(spark, sf_dir)
    flags = {"judge_accuracy": _verdict(), "judge_accuracy_lenient": text.is_yes(F.col("judge_reply"), strip_punct=True)}
    return evaluation.grouped_report(rows, "difficulty", flags=flags, shares={"score": _verdict()})


@query
def eval_full_report(spark, sf_dir):
    return knowledge.report(_answers_with_measures(spark, sf_dir))


@query
def model_comparison(spark, sf_dir):
    base = fixtures.qa_results(spark, sf_dir)
    tuned = base.withColumn("generated_answer", F.concat("generated_answer", F.lit(" "), "question"))
    tuned = tuned.withColumn("judge_reply", F.when(F.length("question") > 150, "Yes").otherwise(F.col("judge_reply")))
    flags = {"keyword": _keyword(), "judge": _verdict()}
    apart = tuned.where("id % 7 <> 0").unionByName(tuned.where("id % 9 = 0").withColumn("id", F.col("id") + 1_000_000_000))
    return evaluation.compare_models(base, apart, "difficulty", flags, on="id")


@query
def semantic_similarity(spark, sf_dir):
    similarity = vectors.cosine(F.col("expected"), F.col("generated"))
    return fixtures.vector_pairs(spark, sf_dir).select("vec_id", evaluation.rounded(similarity).alias("similarity"))


@query
def semantic_accuracy_threshold(spark, sf_dir):
    similarity = evaluation.rounded(vectors.cosine(F.col("expected"), F.col("generated")))
    rows = fixtures.vector_pairs(spark, sf_dir).select(similarity.alias("similarity"))
    levels = F.array(*[F.lit(x) for x in (0.0, 0.5, 0.7)])
    tested = rows.select("similarity", F.explode(levels).alias("threshold"))
    correct = vectors.at_least(F.col("similarity"), F.col("threshold"))
    return tested.groupBy("threshold").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(correct).alias("n_correct"),
        evaluation.rounded(evaluation.mean_flag(correct)).alias("accuracy"),
    )


@query
def perplexity_by_group(spark, sf_dir):
    value = vectors.perplexity(F.col("logprobs"), F.col("prompt_length"))
    rows = fixtures.token_scores(spark, sf_dir)
    return evaluation.grouped_report(rows, "label", means={"mean_perplexity": value})


@query
def new_tokens(spark, sf_dir):
    rows = fixtures.token_scores(spark, sf_dir)
    kept = rows.select("vec_id", vectors.after_prompt(F.col("tokens"), F.col("prompt_length")).alias("kept"))
    shown = F.array_join(F.transform("kept", lambda x: x.cast("string")), ",")
    return kept.select("vec_id", F.size("kept").alias("n_kept"), shown.alias("kept"))


@query
def judge_prompts(spark, sf_dir):
    question, expected, generated = F.col("question"), F.col("expected_answer"), F.col("generated_answer")
    return fixtures.qa_results(spark, sf_dir).select(
        "id",
        F.md5(prompts.judge_prompt(question, expected, generated)).alias("judge_md5"),
        F.md5(prompts.answer_prompt(question)).alias("base_md5"),
        F.md5(prompts.answer_prompt(question, system=SYSTEM_TEXT)).alias("tuned_md5"),
    )


@query
def generate_answers(spark, sf_dir):
    rows = fixtures.qa_results(spark, sf_dir).select("id", "question", "expected_answer", "difficulty")
    answered = knowledge.generate_answers(rows, standins.parrot, partitions=workers(spark, sf_dir, "conversations"))
    judged = knowledge.judge_answers(answered, standins.coin_verdict)
    return judged.select("id", "generated_answer", "judge_reply", "is_correct_ai_eval")


@query
def reference_logprobs(spark, sf_dir):
    rows = fixtures.qa_results(spark, sf_dir).select("id", "question", "expected_answer")
    prompted = rows.withColumn("prompt", prompts.answer_prompt(F.col("question")))
    scored = knowledge.score_references(prompted, standins.word_logprobs, partitions=workers(spark, sf_dir, "conversations"))
    return scored.select("id", evaluation.rounded(F.col("perplexity")).alias("perplexity"))


@query
def embed_and_compare(spark, sf_dir):
    rows = fixtures.qa_results(spark, sf_dir).select("id", "expected_answer", "generated_answer")
    compared = knowledge.compare_embeddings(rows, standins.letter_counts, partitions=workers(spark, sf_dir, "conversations"))
    return compared.select("id", evaluation.rounded(F.col("semantic_similarity")).alias("similarity"))


@query
def knowledge_evaluation(spark, sf_dir):
    rows = fixtures.qa_results(spark, sf_dir).select("id", "question", "expected_answer", "difficulty")
    models = knowledge.Models(
        standins.parrot, standins.word_logprobs, standins.letter_counts, standins.coin_verdict
    )
    results = knowledge.evaluate(rows, models, run_dir(spark, "knowledge"), SYSTEM_TEXT, 0.7, partitions=workers(spark, sf_dir, "conversations"))
    return knowledge.report(results.data)


def _moody_models() -> knowledge.Models:
    """Generator and judge fail on some rows."""
    return knowledge.Models(standins.moody_parrot, standins.word_logprobs, standins.letter_counts, standins.moody_verdict)


@query
def evaluation_with_failures(spark, sf_dir):
    """Rows that fail in a stage keep their message and have no verdicts; in parts, of which the second run finds some done."""
    rows = fixtures.qa_results(spark, sf_dir).select("id", "question", "expected_answer", "difficulty")
    path = run_dir(spark, "failures")

    def run(some: DataFrame) -> DataFrame:
        return knowledge.evaluate(some, _moody_models(), path, SYSTEM_TEXT, 0.7, parts=1, error_col="error", partitions=workers(spark, sf_dir, "conversations")).data

    run(rows.where("id % 3 = 0"))
    return run(rows).select("id", "is_correct_keyword", "is_correct_semantic", "is_correct_ai_eval", "error")


@query
def evaluation_counts(spark, sf_dir):
    """What each stage counted while it was written."""
    rows = fixtures.qa_results(spark, sf_dir).select("id", "question", "expected_answer", "difficulty")
    path = run_dir(spark, "counted")
    return knowledge.evaluate(rows, _moody_models(), path, SYSTEM_TEXT, 0.7, partitions=workers(spark, sf_dir, "conversations"), error_col="error").counts


# --- corpus -----------------------------------------------------------------


@query
def clean_pages(spark, sf_dir):
    cleaned = fixtures.table(spark, sf_dir, "pages").select("page_id", text.clean_text(F.col("html")).alias("text"))
    return cleaned.select("page_id", F.length("text").alias("n_chars"), _md5("text"))


@query
def title_extract(spark, sf_dir):
    rows = fixtures.table(spark, sf_dir, "pages").select(
        "page_id",
        text.extract_tag(F.col("html"), "title").alias("title"),
        text.extract_tag(F.col("html"), "article").alias("article"),
        text.extract_tag(F.col("html"), "h3").alias("h3"),
    )
    return rows.select(
        "page_id",
        "title",
        text.tag_present(F.col("article")).alias("has_article"),
        F.md5(F.coalesce("article", F.lit(""))).alias("article_md5"),
        text.tag_present(F.col("h3")).alias("has_h3"),
    )


@query
def page_records(spark, sf_dir):
    records = corpus.page_records(fixtures.pages(spark, sf_dir), blocked=BLOCKED, keep=["page_id"])
    return records.select("page_id", "piece", F.length("text").alias("n_chars"), _md5("text"))


@query
def chunk_documents(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    chunks = corpus.chunk_text(docs, "text", ["doc_id"])
    return chunks.select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"), _md5("chunk"))


@query
def chunk_words(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    chunks = corpus.chunk_text(docs, "text", ["doc_id"], size=200, overlap=20, unit="words")
    return chunks.select("doc_id", "chunk_no", _md5("chunk"))


@query
def truncate_tokens(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    cut = docs.select("doc_id", corpus.truncate_words(F.col("text"), 100).alias("text"))
    return cut.select("doc_id", F.size(F.split("text", " ")).alias("n_words"), _md5("text"))


@query
def token_budget(spark, sf_dir):
    """First sixteen tokens of a tokenizer's output."""
    rows = fixtures.token_scores(spark, sf_dir).select("vec_id", corpus.truncate_tokens(F.col("tokens"), 16).alias("kept"))
    return rows.select("vec_id", F.size("kept").alias("n_kept"), F.array_join(F.transform("kept", lambda x: x.cast("string")), ",").alias("kept"))


@query
def tokenizer_budget(spark, sf_dir):
    """Documents cut by a tokenizer whose tokens are not words."""
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = inference.cut_tokens(docs, "text", inference.TokenBudget(64, standins.short_pieces), "kept", "n_tokens")
    return cut.select("doc_id", "n_tokens", _md5("kept"))


@query
def category_closure(spark, sf_dir):
    return categories.category_pages(fixtures.edges(spark, sf_dir), [SEED_CATEGORY], max_depth=3)


# --- conversations ----------------------------------------------------------


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.pack_turns(fixtures.turns(spark, sf_dir))


def _roles() -> Column:
    return F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles")


def _contents() -> Column:
    return F.md5(F.array_join(F.transform("messages", lambda m: m["content"]), "\n")).alias("contents_md5")


@query
def build_conversations(spark, sf_dir):
    whole = conversations.whole_conversations(_packed(spark, sf_dir))
    return whole.select("conv_id", F.size("messages").alias("n_turns"), _roles(), _contents())


@query
def qa_to_conversations(spark, sf_dir):
    made = chat.qa_conversation(F.col("question"), F.col("expected_answer"))
    rows = fixtures.qa_results(spark, sf_dir).select("id", made.alias("messages"))
    return rows.select("id", _roles(), _contents())


@query
def replace_system_turn(spark, sf_dir):
    replaced = conversations.replace_system_turn(_packed(spark, sf_dir), SYSTEM_TEXT)
    return conversations.whole_conversations(replaced).select("conv_id", _roles(), _contents())


@query
def render_chat(spark, sf_dir):
    rendered = conversations.whole_texts(conversations.render_segments(_packed(spark, sf_dir)))
    opened = F.concat("text", F.lit(chat.ChatTemplate().opener()))
    return rendered.select("conv_id", _md5("text"), F.md5(opened).alias("open_md5"))


@query
def long_conversations(spark, sf_dir):
    """Conversations of thousands of turns: one text each, with one system turn."""
    turns = fixtures.long_turns(spark, sf_dir)
    segments = conversations.replace_system_turn(conversations.pack_turns(turns), SYSTEM_TEXT)
    useful = conversations.keep_useful(segments, turns=turns)
    texts = conversations.whole_texts(conversations.render_segments(useful))
    return texts.select("conv_id", F.length("text").alias("n_chars"), _md5("text"))


@query
def useful_conversations(spark, sf_dir):
    turns = fixtures.turns(spark, sf_dir)
    useful = conversations.keep_useful(conversations.pack_turns(turns), turns=turns)
    whole = conversations.whole_conversations(useful)
    return whole.select("conv_id", F.size("messages").alias("n_turns"), _contents())


@query
def content_top50(spark, sf_dir):
    top = conversations.most_common_contents(fixtures.turns(spark, sf_dir), F.col("content"), 50)
    return top.select("digest", F.length("content").alias("n_chars"), "n")


@query
def content_top50_sketched(spark, sf_dir):
    rows = fixtures.turns(spark, sf_dir)
    top = conversations.frequent_contents(rows, F.col("content"), 50)
    return top.select("digest", F.length("content").alias("n_chars"), "n")


@query
def train_eval_split(spark, sf_dir):
    ids = fixtures.turns(spark, sf_dir).select("conv_id").distinct()
    return sampling.train_eval_split(ids, "conv_id", seed=0).select("conv_id", "split")


@query
def turns_with_split(spark, sf_dir):
    rows = fixtures.turns(spark, sf_dir)
    split = sampling.train_eval_split(rows, "conv_id", seed=0, limit=60, ids=rows.select("conv_id").distinct())
    return split.select("conv_id", "turn", "split", _md5("content"))


@query
def split_filter_counts(spark, sf_dir):
    verdicts = conversations.conversation_verdicts(fixtures.turns(spark, sf_dir))
    split = sampling.train_eval_split(verdicts, "conv_id", seed=0, ids=verdicts.select("conv_id"))
    return conversations.filter_counts(split, "split")


@query
def step_budget(spark, sf_dir):
    verdicts = conversations.conversation_verdicts(fixtures.turns(spark, sf_dir))
    split = sampling.train_eval_split(verdicts, "conv_id", seed=0, ids=verdicts.select("conv_id"))
    return conversations.step_budget(split.where("split = 'train' and useful"))


@query
def merge_datasets(spark, sf_dir):
    def origin(df: DataFrame, name: str) -> DataFrame:
        key = F.concat_ws("|", F.lit(name), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        return df.select(key.alias("row_id"), "role", "content")

    rows = fixtures.turns(spark, sf_dir)
    merged = sinks.merge(origin(rows, "old"), origin(rows.where("role = 'assistant'"), "new"))
    ranked = sampling.with_global_rank(merged, "row_id", seed=42)
    return ranked.select("rank", "row_id", "role", _md5("content"))


@query
def conversation_synthesis(spark, sf_dir):
    ready = synthesis.synthesize(
        fixtures.pages(spark, sf_dir),
        "page_id",
        standins.pair_writer,
        standins.pair_rater,
        SYSTEM_TEXT,
        run_dir(spark, "synthesis"),
        blocked=BLOCKED,
        partitions=workers(spark, sf_dir, "pages"),
    )
    return ready.data.select("conv_id", "split", _roles(), _contents())


# --- question-answer pairs --------------------------------------------------


@query
def qa_generate_curate(spark, sf_dir):
    chunks = corpus.chunk_text(fixtures.table(spark, sf_dir, "documents"), "text", ["doc_id"])
    keep = ["doc_id", "chunk_no"]
    written = synthesis.write_pairs(chunks, keep, standins.pair_writer, partitions=workers(spark, sf_dir, "documents"))
    kept = curation.keep_rated(synthesis.rate_pairs(written, keep, standins.pair_rater))
    return kept.select(*keep, "pair_no", _md5("question"), _md5("answer"), "rating")


@query
def curation_counts(spark, sf_dir):
    """What became of all chunks and pairs, counted by the one job that writes the ratings."""
    chunks = corpus.chunk_text(fixtures.table(spark, sf_dir, "documents"), "text", ["doc_id"])
    keep = ["doc_id", "chunk_no"]

    def rate(some: DataFrame, watch: stages.Watch) -> DataFrame:
        written = watch(synthesis.write_pairs(some, keep, standins.pair_writer, partitions=workers(spark, sf_dir, "documents")), **curation.chunk_counts())
        groups = watch(synthesis.rate_groups(written, keep, standins.pair_rater), **curation.prompt_counts())
        pairs = synthesis.rated_pairs(groups, keep).select(*keep, "pair_no", "rating")
        return watch(pairs, **curation.pair_counts())

    counted = stages.staged(chunks, keep, rate, f"{run_dir(spark, 'curation')}/ratings").counts
    made = [*curation.pair_counts(), *curation.chunk_counts(), *curation.prompt_counts()]
    return counted.select(*made)


@query
def salvaged_pairs(spark, sf_dir):
    """Pairs of replies that end somewhere within a pair."""
    chunks = corpus.chunk_text(fixtures.table(spark, sf_dir, "documents"), "text", ["doc_id"])
    keep = ["doc_id", "chunk_no"]
    written = synthesis.write_pairs(chunks, keep, standins.cut_off_writer, partitions=workers(spark, sf_dir, "documents"), error_col="error")
    questions = F.md5(F.array_join("pairs.question", "|")).alias("questions_md5")
    return written.select(*keep, F.size("pairs").alias("n_pairs"), "n_salvaged", questions, "error")


@query
def synthesis_counts(spark, sf_dir):
    """What became of all chunks and pairs when writer and rater fail and break off, counted by the writing jobs."""
    chunks = corpus.chunk_text(fixtures.table(spark, sf_dir, "documents"), "text", ["doc_id"])
    path, keep = run_dir(spark, "counted"), ["doc_id", "chunk_no"]
    return synthesis.curated(chunks, keep, standins.cut_off_writer, standins.moody_rater, path, partitions=workers(spark, sf_dir, "documents"), error_col="error").counts


@query
def json_pairs(spark, sf_dir):
    """Replies with a reading, a quoted rating, or no array at all, by event type."""
    kind, props, number = F.col("event_type"), F.col("props"), F.col("event_id").cast("string")
    pair = F.concat(F.lit('{"question": "q'), number, F.lit('", "answer": "a", "rating": '))
    reply = (
        F.when(kind == "click", F.concat(F.lit("```json\n["), pair, F.lit('"8.5"}]\n```')))
        .when(kind == "view", F.concat(F.lit("Here: ["), pair, F.lit("7}]")))
        .when(kind == "error", F.concat(F.lit("["), pair))
        .otherwise(props)
    )
    rows = fixtures.table(spark, sf_dir, "events").select("event_type", curation.parse_ratings(reply).alias("pairs"))
    pairs = F.col("pairs")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(pairs.isNull()).alias("n_unreadable"),
        F.count_if(F.coalesce(F.try_element_at(pairs, F.lit(1))["rating"] >= 8, F.lit(False))).alias("n_high"),
        F.coalesce(F.max(F.try_element_at(pairs, F.lit(1))["question"]), F.lit("")).alias("last_question"),
    )


# --- sentiment --------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.parse_replies(fixtures.predictions(spark, sf_dir))


@query
def parse_predictions(spark, sf_dir):
    raw_fallback = text.reasoning_text(text.extract_tag(F.col("raw_output"), "reasoning"), F.col("raw_output"), "raw")
    parsed = _parsed(spark, sf_dir).withColumn("reasoning_or_raw", raw_fallback)
    return parsed.select(
        "doc_id", "sentiment_pred", "sentiment_tag_present", "reasoning_tag_present",
        _md5("reasoning_pred"), _md5("reasoning_or_raw"),
    )


@query
def tag_integrity(spark, sf_dir):
    return classification.tag_integrity(
        _parsed(spark, sf_dir), F.col("sentiment_tag_present"), F.col("reasoning_tag_present")
    )


@query
def label_accuracy(spark, sf_dir):
    pred = F.col("sentiment_pred")
    ways = {f"accuracy_{mode}": labels.settle_none(pred, mode) for mode in ("none", "neutral")}
    return classification.label_accuracy(_parsed(spark, sf_dir), "sentiment_true", ways)


@query
def label_codes(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    coded = parsed.select(
        "doc_id",
        labels.label_code(F.col("sentiment_true")).alias("true_code"),
        labels.label_code(F.col("sentiment_pred")).alias("pred_code"),
    )
    return coded.withColumn("true_name", labels.label_name(F.col("true_code")))


@query
def confusion_matrix(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    coded = parsed.select(
        labels.label_code(F.col("sentiment_true")).alias("t"), labels.label_code(F.col("sentiment_pred")).alias("p")
    )
    return classification.confusion_matrix(coded, "t", "p", [0, 1, 2])


@query
def classification_report(spark, sf_dir):
    return classification.classification_report(
        _parsed(spark, sf_dir), "sentiment_true", "sentiment_pred", sentiment.CLASSES_AND_NONE
    )


@query
def class_counts(spark, sf_dir):
    return classification.class_counts(fixtures.labelled(spark, sf_dir), "sentiment_true")


@query
def reasoning_score(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    missing = F.lower("reasoning_pred") == "none"
    score = F.when(missing, F.lit(V.MISSING_REASONING_SCORE)).otherwise(text.score_1_to_10(F.col("judge_reply")))
    rows = parsed.select(missing.alias("missing"), score.alias("score"))
    return classification.mean_score(rows, F.col("score"), F.col("missing"))


@query
def stratified_sample(spark, sf_dir):
    rows = fixtures.labelled(spark, sf_dir)
    sample = sampling.stratified_sample(rows, "sentiment_true", 34, "doc_id", classes=sentiment.CLASSES)
    return sample.select("doc_id", "sentiment_true", _md5("text"))


@query
def stratified_sample_open(spark, sf_dir):
    """The same without a list of classes: here the sources, of any number."""
    docs = fixtures.table(spark, sf_dir, "documents")
    return sampling.stratified_sample(docs, "source", 10, "doc_id").select("doc_id", "source")


@query
def first_k_sample(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    return sampling.first_k(docs, "doc_id", 100, seed=5).select("doc_id", _md5("text"))


@query
def sentiment_prompts(spark, sf_dir):
    explained = fixtures.labelled(spark, sf_dir).select(
        "doc_id",
        F.col("text").alias("sentence"),
        F.col("sentiment_true").alias("sentiment"),
        F.col("text").alias("explanation"),
    )
    rows = sentiment.training_rows(explained, keep=["doc_id"])
    body, truth = F.col("text"), F.col("sentiment")
    made = rows.select(
        "doc_id",
        prompts.supervised_prompt(body, truth, F.col("reasoning")).alias("train"),
        prompts.classify_prompt(body).alias("test"),
        prompts.explain_prompt(body, truth).alias("explain"),
        prompts.reasoning_judge_prompt(body, truth, F.col("reasoning")).alias("judge"),
        prompts.summary_prompt(body).alias("summary"),
    ).withColumn("headline", text.headline_of(F.col("test")))
    return made.select("doc_id", *[_md5(c) for c in ("train", "test", "explain", "judge", "summary", "headline")])


@query
def explanations(spark, sf_dir):
    rows = fixtures.labelled(spark, sf_dir).select(
        "doc_id",
        F.col("text").alias("sentence"),
        labels.label_code(F.col("sentiment_true")).alias("label"),
        F.when(F.col("doc_id") % 10 == 0, "test").when(F.col("doc_id") % 10 == 1, "validation").otherwise("train").alias("split"),
    )
    path = run_dir(spark, "explained")
    sinks.write_splits(sentiment.explain(rows, standins.digest_text, error_col="error", partitions=workers(spark, sf_dir, "documents")), path)
    loaded = tables.load_splits(spark, path).where(F.col("error").isNull())
    return loaded.select("doc_id", "label", "sentiment", F.col("split").cast("string").alias("split"), "explanation")


@query
def failed_explanations(spark, sf_dir):
    """A teacher that fails on some rows: they stay, with the message."""
    rows = fixtures.labelled(spark, sf_dir).select(
        "doc_id", F.col("text").alias("sentence"), labels.label_code(F.col("sentiment_true")).alias("label")
    )
    told = sentiment.explain(rows, standins.moody_text, error_col="error", partitions=workers(spark, sf_dir, "documents"))
    return told.select("doc_id", "explanation", "error")


@query
def retried_explanations(spark, sf_dir):
    """A teacher with passing and lasting failures: calls per row, errors where waiting did not help."""
    rows = fixtures.labelled(spark, sf_dir).select(
        "doc_id", F.col("text").alias("sentence"), labels.label_code(F.col("sentiment_true")).alias("label")
    )
    told = sentiment.explain(
        rows, standins.flaky_text, batch_size=1, error_col="error", attempts_col="attempts", retry=inference.Retry(4, wait=0.0), partitions=workers(spark, sf_dir, "documents")
    )
    return told.select("doc_id", "explanation", "error", "attempts")


@query
def budgeted_explanations(spark, sf_dir):
    """Prompts within a budget of tokens, in batches of like length."""
    rows = fixtures.labelled(spark, sf_dir).select(
        "doc_id", F.col("text").alias("sentence"), labels.label_code(F.col("sentiment_true")).alias("label")
    )
    budget = inference.TokenBudget(300, standins.short_pieces)
    told = sentiment.explain(rows, standins.digest_text, budget, tokens_col="n_tokens", padded=2400, partitions=workers(spark, sf_dir, "documents"))
    return told.select("doc_id", "explanation", "n_tokens")


@query
def resumed_predictions(spark, sf_dir):
    """Predictions and scores of some rows, then of all, in parts: what is done is not asked again."""
    rows = fixtures.predictions(spark, sf_dir).select("doc_id", "text", "judge_reply", F.col("raw_output").alias("recorded"))
    path = run_dir(spark, "resumed")

    def run(some: DataFrame) -> DataFrame:
        return sentiment.evaluate(
            some, standins.replay, standins.replay, path, ["doc_id"], "text", ["recorded"], ["judge_reply"], parts=2, partitions=workers(spark, sf_dir, "documents")
        ).data

    run(rows.where("doc_id % 2 = 0"))
    return run(rows).select("doc_id", "sentiment_pred", F.col("reasoning_score").cast("double").alias("reasoning_score"))


@query
def predict_with_reasoning(spark, sf_dir):
    rows = fixtures.predictions(spark, sf_dir).select("doc_id", "text", F.col("raw_output").alias("recorded"))
    predicted = sentiment.predict(rows, standins.replay, "text", extra_inputs=["recorded"], fallback="raw", partitions=workers(spark, sf_dir, "documents"))
    return predicted.select("doc_id", "sentiment_pred", _md5("reasoning_pred"))


@query
def score_reasoning(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    scored = sentiment.score_reasoning(parsed, standins.replay, "text", extra_inputs=["judge_reply"], partitions=workers(spark, sf_dir, "documents"))
    return scored.select("doc_id", "sentiment_pred", F.col("reasoning_score").cast("double").alias("reasoning_score"))


@query
def sentiment_evaluation(spark, sf_dir):
    """Predict, then three reports over the written predictions, in long form."""
    rows = fixtures.predictions(spark, sf_dir).select(
        "doc_id", "text", "sentiment_true", "judge_reply", F.col("raw_output").alias("recorded")
    )
    predicted = sentiment.predict(rows, standins.replay, "text", extra_inputs=["recorded"], partitions=workers(spark, sf_dir, "documents")).drop("recorded")
    path = run_dir(spark, "sentiment")
    done = inference.materialize(predicted, f"{path}/predictions")
    scored = sentiment.score_reasoning(done, standins.replay, "text", extra_inputs=["judge_reply"])
    report = classification.classification_report(done, "sentiment_true", "sentiment_pred", sentiment.CLASSES_AND_NONE)
    tags = classification.tag_integrity(done, F.col("sentiment_tag_present"), F.col("reasoning_tag_present"))
    mean = scored.agg(evaluation.rounded(F.avg("reasoning_score")).alias("value"))
    parts = [
        report.select(F.concat(F.lit("f1 "), "label").alias("metric"), F.col("f1").alias("value")),
        tags.select(F.lit("both tags").alias("metric"), F.col("both_rate").alias("value")),
        mean.select(F.lit("mean reasoning score").alias("metric"), "value"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def review_head(spark, sf_dir):
    rows = _parsed(spark, sf_dir).select("doc_id", "sentiment_true", "sentiment_pred", _md5("text"))
    return sampling.head_rows(rows, "doc_id", 10)


# --- training logs ----------------------------------------------------------


@query
def training_curves(spark, sf_dir):
    return training_logs.loss_curves(fixtures.logs(spark, sf_dir))


@query
def best_checkpoint(spark, sf_dir):
    return training_logs.best_checkpoint(fixtures.logs(spark, sf_dir))


# --- files and sinks --------------------------------------------------------


@query
def text_corpus_scan(spark, sf_dir):
    """Documents as numbered text files of 64 neighbours each, scanned back whole."""
    path = run_dir(spark, "corpus")
    shard = F.floor(F.col("doc_id") / SHARD_ROWS).cast("bigint")
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text", shard.alias("shard"))
    ordered = docs.repartition("shard").sortWithinPartitions("shard", "doc_id")
    ordered.select("shard", "text").write.partitionBy("shard").option("maxRecordsPerFile", SHARD_ROWS).text(path)
    found = files.scan_text_files(spark, path, index_pattern=r"shard=(\d+)/", recursive=True, ordered=False)
    return found.select("file_index", F.length("text").alias("n_chars"), _md5("text"))


@query
def artifact_sizes(spark, sf_dir):
    """Bytes of the documents written as text, one folder per language."""
    path = run_dir(spark, "artifacts")
    docs = fixtures.table(spark, sf_dir, "documents").select("lang", "text")
    docs.write.partitionBy("lang").text(path)
    sizes = files.artifact_sizes(spark, path, files.CHECKSUMS)
    return sizes.select(F.replace("artifact", F.lit("lang="), F.lit("")).alias("lang"), "n_bytes", "gb")


@query
def csv_roundtrip(spark, sf_dir):
    path = run_dir(spark, "csv")
    rows = _parsed(spark, sf_dir).select("doc_id", "text", "sentiment_true", "sentiment_pred", "reasoning_pred")
    sinks.write_csv(rows, path)
    schema = "doc_id bigint, text string, y_true string, y_pred string, reasoning string"
    back = sinks.read_csv(spark, path, schema).withColumn("text", F.coalesce("text", F.lit("")))
    return back.select("doc_id", _md5("text"), "y_true", "y_pred", _md5("reasoning"))


@query
def jsonl_roundtrip(spark, sf_dir):
    path = run_dir(spark, "jsonl")
    sinks.write_jsonl(conversations.whole_conversations(_packed(spark, sf_dir)), path)
    back = tables.read_conversations(spark, path, keys="conv_id bigint")
    return back.select("conv_id", _roles(), _contents())


@query
def json_arrays_roundtrip(spark, sf_dir):
    """Conversations as files of JSON arrays over several lines, one file per task, read back."""
    path = run_dir(spark, "json-arrays")
    whole = conversations.whole_conversations(_packed(spark, sf_dir))
    sinks.write_json_arrays(whole.repartition(8, "conv_id"), path)
    back = tables.read_conversations(spark, path, keys="conv_id bigint", multiline=True)
    return back.select("conv_id", _roles(), _contents())


@query
def json_array_lines(spark, sf_dir):
    """The same files, split across tasks by their lines."""
    path = run_dir(spark, "json-arrays")
    whole = conversations.whole_conversations(_packed(spark, sf_dir))
    sinks.write_json_arrays(whole.repartition(2, "conv_id"), path)
    back = tables.read_array_lines(spark, path, keys="conv_id bigint")
    return back.select("conv_id", _roles(), _contents())


@query
def records_roundtrip(spark, sf_dir):
    path = run_dir(spark, "records")
    sinks.write_records(fixtures.table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return spark.read.schema("source string, text string").parquet(path).select("source", _md5("text"))


@query
def split_roundtrip(spark, sf_dir):
    path = run_dir(spark, "splits")
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "lang")
    sinks.write_splits(sampling.train_eval_split(docs, "doc_id", seed=3, ids=docs.select("doc_id")), path)
    return tables.load_split(spark, path, "eval", lambda df: df.withColumn("lang", F.upper("lang")))


@query
def publish_versions(spark, sf_dir):
    base = run_dir(spark, "published")
    rows = fixtures.turns(spark, sf_dir)
    key = F.concat_ws("|", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    rows = rows.select(key.alias("row_id"), "role", "content")
    sinks.publish(rows.where("role = 'user'"), base, "row_id")
    sinks.publish(rows.where("role <> 'user'"), base, "row_id", merging=True)
    return sinks.read_published(spark, base).select("row_id", "role", _md5("content"))
