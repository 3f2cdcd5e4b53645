"""Views over the given tables that stand in for the datasets (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.text import extract_tag

NO_INFORMATION = " Not specified."


# Declared, so that planning a query reads no file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def qa_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows.

    Joined on conversation and turn together, so a dominant conversation spreads out.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    told = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("generated_answer")
    )
    row_id = F.col("conv_id") * 100 + F.col("turn")
    answer = F.when(F.col("conv_id") % 4 == 0, F.col("generated_answer")).otherwise(F.substring("generated_answer", 5, 12))
    expected = F.when(F.col("conv_id") % 2 == 0, answer).otherwise(
        F.col("question")
    )
    third, fifth = F.col("conv_id") % 3, row_id % 5
    difficulty = F.when(third == 0, "Easy").when(third == 1, "Medium").otherwise("Hard")
    reply = F.when(fifth == 0, "Yes").when(fifth == 1, "Yes, but").when(fifth == 2, "No")
    return asked.join(told, ["conv_id", "turn"]).select(
        row_id.alias("id"),
        "question",
        "generated_answer",
        expected.alias("expected_answer"),
        difficulty.alias("difficulty"),
        reply.when(fifth == 3, " yes indeed").otherwise("").alias("judge_reply"),
    )


def letter_vector(text: Column) -> Column:
    """Counts of eight letters, as the embedding stand-in gives them."""
    letters = F.array(*[F.lit(c) for c in "aeionrst"])
    return F.transform(letters, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))).cast("float"))


def word_scores(text: Column) -> Column:
    """A tenth of each word's length below 0, as the log-probability stand-in gives them."""
    return F.transform(F.split(text, " "), lambda w: -F.length(w) / F.lit(10.0))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a sentiment."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = table(spark, sf_dir, "labels")
    sentiment = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return docs.join(marks, "doc_id", "left").select("doc_id", "text", sentiment.alias("sentiment_true"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a made-up reply of the model and of the judge."""
    truth, kind, score = F.col("sentiment_true"), F.col("doc_id") % 7, F.col("doc_id") % 6
    tagged = F.concat(F.lit("<sentiment>"), truth, F.lit("</sentiment>"))
    reasoned = F.concat(tagged, F.lit(" <reasoning>"), F.col("text"), F.lit("</reasoning>"))
    raw = (
        F.when(kind == 0, reasoned)
        .when(kind == 1, "<SENTIMENT> Positive </SENTIMENT>")
        .when(kind == 2, "<sentiment>negative")
        .when(kind == 3, "<sentiment></sentiment> neutral")
        .when(kind == 4, "no idea")
        .when(kind == 5, F.concat(tagged, F.lit("<reasoning>None</reasoning>")))
        .otherwise("<sentiment>not positive</sentiment><reasoning></reasoning>")
    )
    reply = F.when(score == 0, "8").when(score == 1, "10").when(score == 2, "7/10").when(score == 3, "Score: 9")
    return labelled(spark, sf_dir).select(
        "doc_id", "text", "sentiment_true", raw.alias("raw_output"),
        reply.when(score == 4, "great").otherwise("11").alias("judge_reply"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat turns, some of which say that nothing is specified."""
    text = F.col("text")
    marked = (F.col("conv_id") * 7 + F.col("turn")) % 23 == 0
    content = F.when(marked, F.concat(text, F.lit(NO_INFORMATION))).otherwise(text)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", content.alias("content"))


def long_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the turns of nine conversations; two of them say once that nothing is specified."""
    number = F.col("event_id")
    conv, turn = number % 9, F.floor(number / 9).cast("bigint")
    role = F.when((turn == 0) & (conv % 2 == 0), "system").when(turn % 2 == 0, "user").otherwise("assistant")
    content = F.when((turn == 50) & conv.isin(3, 4), F.concat("props", F.lit(NO_INFORMATION))).otherwise(F.col("props"))
    return table(spark, sf_dir, "events").select(conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), content.alias("content"))


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector with a mix of itself and its neighbour."""
    vectors = table(spark, sf_dir, "embeddings")
    own = vectors.select("vec_id", "label", F.col("embedding").alias("expected"))
    neighbour = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    share = (F.col("vec_id") % 11).cast("double") / F.lit(10.0)

    def mixed(x: Column, y: Column) -> Column:
        return share * x.cast("double") + (F.lit(1.0) - share) * y.cast("double")

    return own.join(neighbour, "vec_id").select(
        "vec_id", "label", "expected", F.zip_with("expected", "other", mixed).alias("generated")
    )


def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and log-probabilities with a prompt length."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        F.transform("embedding", lambda x: -F.abs(x.cast("double")) * 10).alias("logprobs"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 10000).cast("int")).alias("tokens"),
        (F.col("vec_id") % 8).cast("int").alias("prompt_length"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, summary and sections of each page: its html cut at paragraphs."""
    cut = F.split("html", "<p>")
    sections = F.transform(F.slice(cut, F.lit(2), F.size(cut)), lambda s: F.struct(s.alias("text")))
    return table(spark, sf_dir, "pages").select(
        "page_id", extract_tag(F.col("html"), "title").alias("title"), cut[0].alias("summary"), sections.alias("sections")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category members with a cycle between regions and nations."""

    def named(letter: str, key: str) -> Column:
        return F.concat(F.lit(letter), F.col(key).cast("string"))

    def category(letter: str, key: str) -> Column:
        return F.concat(F.lit("Category:"), named(letter, key))

    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"))
    tenth = F.col("c_custkey") % 10 == 0
    customer = F.when(tenth, category("C", "c_custkey")).otherwise(named("C", "c_custkey"))
    parts = [
        nation.join(region, "n_regionkey").select(category("R", "n_regionkey"), category("N", "n_nationkey")),
        nation.select(category("N", "n_nationkey"), category("R", "n_regionkey")),
        table(spark, sf_dir, "supplier").select(category("N", "s_nationkey"), named("S", "s_suppkey")),
        table(spark, sf_dir, "customer").select(category("N", "c_nationkey"), customer),
        table(spark, sf_dir, "orders").select(category("C", "o_custkey"), named("O", "o_orderkey")),
    ]
    whole = parts[0].toDF("category", "member")
    for part in parts[1:]:
        whole = whole.unionByName(part.toDF("category", "member"))
    return whole


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training log with optional losses."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("step"),
        (F.col("event_id") / F.lit(1000.0)).alias("epoch"),
        F.when(kind.isin("click", "view"), F.col("value")).alias("loss"),
        F.when(kind == "error", F.col("value")).alias("eval_loss"),
    )
