"""The model hook: batching, errors, retries, resuming, call counts."""

import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from quillmark.operators import inference
from quillmark.plans import sentiment_evaluation as sentiment
from quillmark.plans import standins


def test_batches_keep_rows_and_order_of_columns(spark):
    def make():
        return lambda values: [f"{v}:{len(values)}" for v in values]

    df = spark.range(50).select("id", F.col("id").cast("string").alias("p"), F.array(F.struct("id")).alias("nested"))
    got = inference.run_model(df, "p", "out", make, batch_size=16, partitions=1).collect()
    assert sorted((r.id, r.out) for r in got) == [(i, f"{i}:{16 if i < 48 else 2}") for i in range(50)]
    assert all(r.nested[0].id == r.id for r in got)


def test_prompts_need_not_come_back(spark, sf_dir):
    def make():
        return lambda pairs: [f"{p}{q}" for p, q in pairs]

    df = spark.range(20).select("id", F.lit("p").alias("p"), F.col("id").cast("string").alias("q"), F.array("id").alias("kept"))
    got = inference.run_model(df, ["p", "q"], "out", make, error_col="error", attempts_col="n", keep_inputs=False)
    assert got.columns == ["id", "kept", "out", "error", "n"]
    assert sorted(tuple(r) for r in got.collect()) == [(i, [i], f"p{i}", None, 1) for i in range(20)]
    from quillmark.plans import catalogue

    plan = catalogue.qa_generate_curate(spark, sf_dir)._jdf.queryExecution().analyzed().toString()
    hooks = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert len(hooks) == 2 and not any("_prompt" in line.split(")#", 1)[1].split("[", 1)[1] for line in hooks)


def test_several_inputs_and_array_results(spark):
    df = spark.createDataFrame([("a b", "cc d")], "p string, a string")
    got = inference.run_model(df, ["p", "a"], "lp", standins.word_logprobs, out_type="array<double>").first()
    assert got.lp == [-0.2, -0.4, -0.1, -0.2]


def test_failing_row_is_marked_and_the_rest_of_its_batch_kept(spark):
    def make():
        def model(values):
            if any(v == "7" for v in values):
                raise ValueError("cannot read 7")
            return [v + "!" for v in values]

        return model

    df = spark.range(20).select(F.col("id").cast("string").alias("p"))
    got = {r.p: (r.out, r.error) for r in inference.run_model(df, "p", "out", make, error_col="error").collect()}
    assert got["7"] == (None, "ValueError: cannot read 7")
    assert all(got[str(i)] == (f"{i}!", None) for i in range(20) if i != 7)
    with pytest.raises(Exception, match="cannot read 7"):
        inference.run_model(df, "p", "out", make).collect()


def test_wrong_number_of_results_is_an_error(spark):
    with pytest.raises(Exception, match="gave 1 results"):
        inference.run_model(spark.createDataFrame([("a",), ("b",)], "p string"), "p", "o", lambda: lambda v: v[:1], partitions=1).collect()


def test_written_output_calls_the_model_once(spark, folder):
    calls = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def make():
        def model(values):
            for v in values:
                os.close(os.open(os.path.join(calls, v), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return values

        return model

    df = spark.range(40).select("id", F.col("id").cast("string").alias("p"))
    done = inference.materialize(inference.run_model(df, "p", "out", make), f"{folder}/done")
    assert done.count() == 40 and done.where("out = '3'").count() == 1
    assert len(os.listdir(calls)) == 40
    more = spark.range(45).select("id", F.col("id").cast("string").alias("p"))
    rest = inference.materialize(inference.run_model(inference.pending(more, done, "id"), "p", "out", make), f"{folder}/rest")
    assert sorted(r.id for r in rest.collect()) == [40, 41, 42, 43, 44]


def test_hook_is_once_in_the_plan_and_filter_below_it(spark, sf_dir):
    from quillmark.plans import catalogue

    plan = catalogue.score_reasoning(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_judge_is_not_called_without_reasoning(spark):
    def make():
        def model(prompts):
            assert all('Provided Reasoning: "good"' in p for p in prompts)
            return ["9" for _ in prompts]

        return model

    rows = [(1, "s", "positive", "good"), (2, "s", "none", "none"), (3, "s", "neutral", "None"), (4, "s", "neutral", None)]
    df = spark.createDataFrame(rows, "id int, sentence string, sentiment_pred string, reasoning_pred string")
    got = {r.id: r.reasoning_score for r in sentiment.score_reasoning(df, make).collect()}
    assert got == {1: 9, 2: 1, 3: 1, 4: 1}


def test_partitions_are_the_callers(spark):
    a = spark.range(300).select(F.col("id"), F.col("id").cast("string").alias("p")).coalesce(1)
    joined = a.join(a.select("id", F.lit(1).alias("x")), "id").coalesce(1)
    dealt = inference.run_model(joined, "p", "o", lambda: lambda v: v, partitions=4).withColumn("task", F.spark_partition_id())
    assert dealt.select("task").distinct().count() > 1
    kept = inference.run_model(a, "p", "o", lambda: lambda v: v)
    assert "Exchange" not in kept._jdf.queryExecution().toString() and kept.rdd.getNumPartitions() == 1


def test_shares_grow_with_the_table(spark, sf_dir, folder):
    from quillmark.plans import catalogue

    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(11).write.parquet(f"{folder}/documents.parquet")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert catalogue.workers(spark, sf_dir, "documents") == spark.sparkContext.defaultParallelism
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        assert catalogue.workers(spark, folder, "documents") == 11
        plan = catalogue.qa_generate_curate(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition 11, true" in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_null_prompts_pass_by_the_model(spark):
    def make():
        def model(prompts):
            assert None not in prompts
            return [p.upper() for p in prompts]

        return model

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, p string").coalesce(1)
    got = inference.run_model(df, "p", "o", make, error_col="e", skip_null=True).collect()
    assert {r.id: (r.o, r.e) for r in got} == {1: ("A", None), 2: (None, None), 3: ("B", None)}


def test_what_is_held_is_bounded_in_bytes(spark):
    """Long texts in one Arrow batch: tokenizer and model see a few of them at a time, each once."""

    def how_many():
        return lambda texts: [[1] * len(texts) for _ in texts]

    def how_long():
        return lambda texts: [str(sum(map(len, texts))) for _ in texts]

    rows = spark.range(40).select("id", F.expr("repeat(cast(id % 10 as string), 400000)").alias("p")).coalesce(1)
    cut = inference.cut_tokens(rows, "p", inference.TokenBudget(1, how_many), "kept", "n").select("id", "kept", "n").collect()
    assert sorted((r.id, r.kept) for r in cut) == [(k, str(k % 10)) for k in range(40)]
    assert max(r.n for r in cut) <= 5
    told = inference.run_model(rows, "p", "out", how_long, batch_size=100).select("id", F.length("p").alias("size"), F.col("out").cast("int").alias("n")).collect()
    assert [(r.id, r["size"]) for r in told] == [(k, 400_000) for k in range(40)]
    assert max(r.n for r in told) <= 2_100_000


def test_perplexity_is_of_the_answer_whatever_the_tokenizer(spark):
    df = spark.createDataFrame([("a long prompt of many words", "yes no")], "prompt string, expected_answer string")
    make = lambda: lambda pairs: [[-1.0] * (2 * len(a.split())) for _, a in pairs]
    from quillmark.plans import knowledge_evaluation as knowledge

    assert abs(knowledge.score_references(df, make).first().perplexity - 2.718281828) < 1e-6


ELSEWHERE = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1] + "/__spark_entry__.py")
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", contract.queries()["explanations"](spark, sys.argv[2]).count())
"""


def test_executors_need_no_copy_of_the_package(sf_dir, folder):
    """A session started elsewhere, whose workers cannot import the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(f"{folder}/run.py", "w") as f:
        f.write(ELSEWHERE)
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "run.py", root, sf_dir], cwd=folder, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
