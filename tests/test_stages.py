"""Hook options, stages that are counted and resumed, replies that break off."""

import json
import os
import random
import tempfile
import time
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from quillmark import session
from quillmark.operators import conversations, curation, inference, stages
from quillmark.plans import conversation_synthesis as synthesis
from quillmark.plans import knowledge_evaluation as knowledge
from quillmark.plans import sentiment_evaluation as sentiment
from quillmark.plans import standins

# ---- pairs out of broken replies


def texts():
    rng = random.Random(4)
    marks = ['"', "\\", "{", "}", "[", "]", ",", ":", "\n", "\t", "é", "日", " ", "a", "b"]
    return lambda n: "".join(rng.choice(marks) for _ in range(n)), rng


def test_cut_replies_keep_every_complete_pair(one):
    text, rng = texts()
    rows, want = [], []
    for _ in range(400):
        pairs = [{"question": text(rng.randrange(1, 12)), "answer": text(rng.randrange(12))} for _ in range(rng.randrange(6))]
        if rng.random() < 0.3:
            pairs = [p | {"more": {"deep": [{"x": text(3)}, text(2)]}} for p in pairs]
        shown = [json.dumps(p, ensure_ascii=rng.random() < 0.5) for p in pairs]
        reply = rng.choice(["", "Sure:\n```json\n", 'Here "they" are [as asked]: ']) + "[" + rng.choice([", ", ",\n"]).join(shown)
        ends, at = [], 0
        for s in shown:
            at = reply.index(s, at) + len(s)
            ends.append(at)
        cut = rng.randrange(len(reply) + 1)
        whole = [(p["question"], p["answer"]) for p, e in zip(pairs, ends) if e <= cut]
        rows.append((reply[:cut],))
        want.append(whole or None)
    got = one("t string", rows, lambda c: curation.parse_pairs(c("t")))
    assert [None if g is None else [tuple(p) for p in g] for g in got] == want
    assert sum(len(w) for w in want if w) > 250


def test_nothing_inside_a_broken_object_is_taken(one):
    rows = [
        ('[{"question": "a", "answer": {"question": "x", "answer": "y"}, "z": ',), ('[{"question": "a"}, {"question": "b", "answer": "c"}',),
        ('[{"question": "a", "answer": "b"}, {"question": unquoted}, {"question": "c", "answer": "d"}]',), ("{}",), (None,), ("[]",), ('[{"question": "a", "answer": "b"}] as said in [1]',),
        ('[{"question": "' + "{" * 9 + '", "answer": "b"}',), ("[" + '{"question":' * 9 + '"x"' + "}" * 9,),
    ]
    got = one("t string", rows, lambda c: curation.parse_pairs(c("t")))
    shown = [None if g is None else [tuple(p) for p in g] for g in got]
    assert shown == [None, [("b", "c")], [("a", "b"), ("c", "d")], None, None, [], [("a", "b")], [("{" * 9, "b")], None]


def test_scan_is_linear(one):
    pair = json.dumps({"question": 'why "so" {', "answer": "because\n" * 8})
    hard = ["[" + ", ".join([pair] * (1_000_000 // len(pair))), '[{"{"' * 200_000, "[{" * 500_000, '[{"x": "' + "\\n" * 500_000, '[{"x":"y",' + '"{",' * 250_000, "[" + '{"a":' * 200_000]
    one("t string", [("[{}",)], lambda c: F.size(curation.complete_objects(c("t"))))
    start = time.time()
    got = one("t string", [(h,) for h in hard], lambda c: F.size(curation.complete_objects(c("t"))))
    assert got[0] == 1_000_000 // len(pair) and got[1:] == [0] * 5
    assert time.time() - start < 20


def test_salvaged_pairs_are_counted(spark):
    rows = [('[{"question": "a", "answer": "b"}, {"que',), ('[{"question": "a", "answer": "b"}]',), ("no",), (None,)]
    got = curation.with_pairs(spark.createDataFrame(rows, "reply string"), "reply").collect()
    assert [(r.pairs and len(r.pairs), r.n_salvaged) for r in got] == [(1, 1), (1, 0), (None, 0), (None, 0)]


def test_equal_questions_take_a_rating_each(spark):
    schema = "pairs array<struct<question string, answer string>>, rated array<struct<question string, answer string, rating double>>"
    rows = [([("q", "1"), ("r", "2"), ("q", "3")], [("q", "1", 3.0), ("q", "3", 9.0), ("r", "2", 5.0)]), ([("q", "1"), ("q", "2")], [("q", "1", 7.0)])]
    got = spark.createDataFrame(rows, schema).select(curation.attach_ratings(F.col("pairs"), F.col("rated")).alias("p")).collect()
    assert [[p.rating for p in r.p] for r in got] == [[3.0, 5.0, 9.0], [7.0, None]]


def test_ratings_in_the_order_of_the_pairs(spark):
    """Equal, null and missing questions: the same ratings as when each is looked up."""
    schema = "pairs array<struct<question string, answer string>>, rated array<struct<question string, answer string, rating double>>"
    rows = [
        ([("q", "1"), ("q", "2"), ("r", "3")], [("q", "x", 1.0), ("q", "y", None), ("r", "z", 3.0)]),
        ([(None, "1"), ("q", "2"), None], [(None, "x", 4.0), ("q", "y", 5.0), None]),
        ([("q", "1"), ("r", "2")], [("r", "x", 6.0), ("q", "y", 7.0)]),
        ([("q", "1")], [("q", "x", 8.0), ("r", "y", 9.0)]),
        ([], []),
    ]
    got = spark.createDataFrame(rows, schema).select(curation.attach_ratings(F.col("pairs"), F.col("rated")).alias("p")).collect()
    assert [[tuple(p) for p in r.p] for r in got] == [
        [("q", "1", 1.0), ("q", "2", None), ("r", "3", 3.0)], [(None, "1", 4.0), ("q", "2", 5.0), (None, None, None)],
        [("q", "1", 7.0), ("r", "2", 6.0)], [("q", "1", 8.0)], [],
    ]


def test_ratings_of_a_cut_reply(one):
    rows = [('[{"question": "a", "answer": "b", "rating": "8"}, {"question": "c", "answer": "d", "rat',)]
    assert [[tuple(p) for p in g] for g in one("t string", rows, lambda c: curation.parse_ratings(c("t")))] == [[("a", "b", 8.0)]]


# ---- the hook


def prompts(spark, values, schema="id int, p string"):
    return spark.createDataFrame(list(enumerate(values)), schema).coalesce(1)


def test_passing_failures_are_retried(spark):
    def make():
        calls = {}

        def model(values):
            for v in values:
                calls[v] = calls.get(v, 0) + 1
                if v == "bad":
                    raise ValueError("cannot be read")
                if v == "never" or (v.startswith("late") and calls[v] < 3):
                    raise ConnectionError("busy")
            return [v.upper() for v in values]

        return model

    df = prompts(spark, ["a", "late1", "never", "bad", "late2", "b"])
    retry = inference.Retry(4, wait=0.001, growth=3.0)
    got = inference.run_model(df, "p", "out", make, batch_size=1, error_col="error", retry=retry, attempts_col="tries").collect()
    assert {r.p: (r.out, r.error, r.tries) for r in got} == {
        "a": ("A", None, 1), "b": ("B", None, 1), "late1": ("LATE1", None, 3), "late2": ("LATE2", None, 3),
        "never": (None, "ConnectionError: busy", 4), "bad": (None, "ValueError: cannot be read", 1),
    }
    # In one batch the failing rows end alone; the others are answered.
    some = inference.run_model(df, "p", "out", make, batch_size=6, error_col="error", retry=retry, attempts_col="tries").collect()
    assert {r.p for r in some if r.error} >= {"never", "bad"} and {r.p for r in some if r.out} >= {"a", "b"}
    with pytest.raises(Exception, match="busy"):
        inference.run_model(prompts(spark, ["never"]), "p", "out", make, retry=retry).collect()


def test_waits_grow_to_a_bound():
    retry = inference.Retry(wait=10, growth=2, longest=60)
    assert [retry.pause(k) for k in (1, 2, 3, 4, 5)] == [10, 20, 40, 60, 60]


def test_rows_that_failed_before_pass_by(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "lost"), (3, "c", None)], "id int, p string, error string").coalesce(1)

    def make():
        def model(values):
            assert "b" not in values
            if "c" in values:
                raise RuntimeError("no")
            return values

        return model

    got = inference.run_model(df, "p", "out", make, error_col="error")
    assert got.columns == ["id", "p", "error", "out"]
    assert {r.id: (r.out, r.error) for r in got.collect()} == {1: ("a", None), 2: (None, "lost"), 3: (None, "RuntimeError: no")}


def test_budget_cuts_at_a_tokens_end(spark):
    budget = inference.TokenBudget(3, standins.short_pieces)
    df = prompts(spark, ["abcdefghij", "ab", "", None, "A日B c"])
    got = inference.run_model(df, "p", "out", lambda: lambda v: v, skip_null=True, budget=budget, tokens_col="n").collect()
    want = {"abcdefghij": ("abcdefghij", 3), "ab": ("ab", 1), "": ("", 0), None: (None, None), "A日B c": ("A日B", 5)}
    assert {r.p: (r.out, r.n) for r in got} == want
    cut = inference.cut_tokens(df, "p", inference.TokenBudget(1, standins.short_pieces), "kept", "n").collect()
    assert [(r.kept, r.n) for r in cut] == [("abcd", 3), ("ab", 1), ("", 0), (None, None), ("A", 5)]
    assert inference.cut_tokens(df, "p", inference.TokenBudget(0, standins.short_pieces), "kept", "n").first().kept == ""


def test_batches_of_like_length(spark, folder):
    rng = random.Random(1)
    values = ["x" * rng.choice([3, 5, 8, 100, 120, 400]) for _ in range(300)] + ["y" * 5000]

    def make():
        def model(batch):
            with open(f"{folder}/{time.time_ns()}", "w") as f:
                f.write(f"{len(batch)} {max(map(len, batch))} {sum(map(len, batch))}")
            return [f"{len(v)}{v[:1]}" for v in batch]

        return model

    def run(**options):
        folder_before = set(os.listdir(folder))
        got = inference.run_model(prompts(spark, values), "p", "out", make, batch_size=32, **options).collect()
        batches = [tuple(map(int, open(f"{folder}/{n}").read().split())) for n in set(os.listdir(folder)) - folder_before]
        return [(r.id, r.out) for r in got], batches

    plain, a = run()
    like, b = run(padded=1600)
    assert like == plain == [(k, f"{len(v)}{v[:1]}") for k, v in enumerate(values)]
    padding = lambda batches: sum(n * longest - size for n, longest, size in batches)
    assert padding(b) * 10 < padding(a)
    assert all(n * longest <= 1600 or n == 1 for n, longest, _ in b) and max(n for n, _, _ in b) <= 32


def test_profile_is_passed_on(spark):
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(2)).build
    df = inference.run_model(spark.range(3).select(F.col("id").cast("string").alias("p")), "p", "out", lambda: lambda v: v, profile=profile)
    assert "cpus -> name: cpus, amount: 2.0" in df._jdf.queryExecution().logical().toString()


# ---- stages


def recording(calls, answer, stop=None):
    """A model that leaves a file for each call of an input, an error if there is one already; it breaks at ``stop`` while that file is there."""

    def make():
        def model(values):
            if stop and os.path.exists(stop):
                wanted = open(stop).read()
                if any(wanted in str(v) for v in values):
                    raise RuntimeError("stopped")
            for v in values:
                name = md5(str(v).encode()).hexdigest()
                os.close(os.open(os.path.join(calls, name), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return answer(values)

        return model

    return make


def test_a_stopped_stage_goes_on(spark, folder):
    calls = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    stop = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), "stop")
    rows = spark.range(200).select("id", F.concat(F.lit("p"), F.col("id").cast("string"), F.lit("end")).alias("p")).coalesce(1)
    rows = rows.unionByName(spark.createDataFrame([(None, "pnullend")], "id long, p string")).coalesce(1)
    make = recording(calls, lambda v: [x.upper() for x in v], stop)

    def stage(some, watch):
        return watch(inference.run_model(some, "p", "out", make, batch_size=1000), n=F.count(F.lit(1)), n_long=F.count_if(F.length("out") > 5)).where("id % 2 = 0 or id is null")

    seventh = next(r.id for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(4)) == 2).collect())
    with open(stop, "w") as f:
        f.write(f"p{seventh}end")
    with pytest.raises(Exception, match="stopped"):
        stages.staged(rows, ["id"], stage, f"{folder}/s", parts=4)
    done = len(stages.committed(spark, f"{folder}/s"))
    assert done == 2 and 0 < len(os.listdir(calls)) < 201
    os.rename(stop, stop + "ped")
    run = stages.staged(rows, ["id"], stage, f"{folder}/s", parts=4)
    assert len(os.listdir(calls)) == 201  # each row once, or a call would have failed
    assert sorted(r.out for r in run.data.collect()) == sorted([f"P{k}END" for k in range(0, 200, 2)] + ["PNULLEND"])
    assert run.totals == {"n": 201, "n_long": 191}
    assert run.counts.first().n == 201
    more = rows.unionByName(spark.createDataFrame([(1000, "p1000end")], "id long, p string"))
    again = stages.staged(more, ["id"], stage, f"{folder}/s", parts=4)
    assert again.data.count() == 102 and len(os.listdir(calls)) == 202 and again.totals["n"] == 202


def test_what_a_stop_left_is_not_read(spark, folder):
    stage = lambda some, watch: watch(some, n=F.count(F.lit(1)))
    rows = spark.range(10).toDF("id")
    first = stages.staged(rows, ["id"], stage, f"{folder}/s", parts=2)
    spark.range(5).toDF("id").write.parquet(f"{folder}/s/data/part-left")
    os.makedirs(f"{folder}/s/done/part-left")
    again = stages.staged(rows, ["id"], stage, f"{folder}/s", parts=2)
    assert again.data.count() == first.data.count() == 10 and again.totals == {"n": 10}
    none = stages.staged(rows.where("false"), ["id"], stage, f"{folder}/none", parts=2)
    assert none.data.count() == 0 and none.totals == {"n": 0}


def test_counts_are_made_by_the_writing_job(spark, sf_dir, folder):
    """One hook and the observed counts are in the one plan that is written."""
    from quillmark.plans import fixtures

    plans = []
    original = stages.Watch.__call__

    def seen(self, df, **counts):
        out = original(self, df, **counts)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    chunks = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("chunk_no"), F.substring("text", 1, 200).alias("chunk")).limit(120)
    calls = [tempfile.mkdtemp(prefix="run-", dir="/tmp") for _ in range(2)]
    writer = recording(calls[0], lambda v: standins.cut_off_writer()(v))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(stages.Watch, "__call__", seen)
        chunks = chunks.withColumn("chunk", F.concat("chunk", F.lit(" "), F.col("doc_id").cast("string")))
        run = synthesis.curated(chunks, ["doc_id", "chunk_no"], writer, standins.moody_rater, f"{folder}/c", error_col="error")
    assert len(plans) == 3 and all(p.count("MapInArrow") == 1 and "CollectMetrics" in p for p in plans) and plans[2].count("CollectMetrics") == 2
    t = run.totals
    assert t["n_chunks"] == 120 and t["n_pairs"] == t["n_written"] and t["n_kept"] == run.data.count()
    assert t["n_kept"] + t["n_below"] + t["n_unrated"] == t["n_pairs"] and t["n_salvaged"] > 0 and t["n_failed_chunks"] > 0


def test_curation_is_counted_without_writing_texts(spark, sf_dir, folder):
    """One job asks both models and writes ratings; nothing is read again to be counted."""
    from quillmark.plans import catalogue

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalogue, "run_dir", lambda _, label: f"{folder}/{label}")
        patch.setattr(inference, "materialize", None)
        counts = catalogue.curation_counts(spark, sf_dir).first()
    written = [os.path.relpath(at, folder) for at, _, names in os.walk(folder) if any(n.endswith(".parquet") for n in names)]
    assert written == ["curation/ratings/data"]
    rows = spark.read.parquet(f"{folder}/{written[0]}")
    assert rows.columns == ["doc_id", "chunk_no", "pair_no", "rating"]
    assert rows.count() == counts.n_pairs == counts.n_written > 0 and rows.where("rating >= 5").count() == counts.n_kept


def test_all_jobs_are_resumed(spark, folder):
    """Each job twice over its parts: the second run calls no model."""
    calls = [tempfile.mkdtemp(prefix="run-", dir="/tmp") for _ in range(8)]
    questions = spark.createDataFrame([(k, f"question {k}", f"answer {k}", "Easy") for k in range(12)], "id int, question string, expected_answer string, difficulty string")
    models = knowledge.Models(
        recording(calls[0], standins.parrot()), recording(calls[1], standins.word_logprobs()), lambda: standins.letter_counts(), recording(calls[3], standins.coin_verdict())
    )
    runs = [knowledge.evaluate(questions, models, f"{folder}/k", parts=2) for _ in range(2)]
    assert sorted(runs[0].data.collect()) == sorted(runs[1].data.collect()) and runs[0].totals == runs[1].totals and runs[1].totals["n_verdicts"] == 12
    sentences = spark.createDataFrame([(k, f"sentence {k}") for k in range(12)], "id int, sentence string")
    tagged = lambda v: [f"<sentiment>positive</sentiment><reasoning>{hash(x) % 7} good {k}</reasoning>" for k, x in enumerate(v)]
    model, judge = recording(calls[4], tagged), lambda: lambda v: ["7"] * len(v)
    runs = [sentiment.evaluate(sentences, model, judge, f"{folder}/s", ["id"], parts=3) for _ in range(2)]
    assert runs[0].totals == runs[1].totals == {"n_rows": 12, "n_failed_predictions": 0, "n_tagged": 12, "n_failed": 0, "n_scored": 12, "n_unscored": 0}
    pages = spark.createDataFrame([(k, f"t{k}", f"{k} a summary of some length", [("a section that is longer",)]) for k in range(8)], "page_id int, title string, summary string, sections array<struct<text string>>")
    writer, rater = recording(calls[5], standins.pair_writer()), standins.pair_rater  # prompts for ratings may repeat
    runs = [synthesis.synthesize(pages, "page_id", writer, rater, "sys", f"{folder}/c", parts=2) for _ in range(2)]
    assert runs[0].totals == runs[1].totals and sorted(runs[0].data.collect()) == sorted(runs[1].data.collect())
    assert runs[0].totals["n_chunks"] == 16


# ---- heavy hitters


def test_sketched_top_equals_the_exact_one(spark):
    n = F.col("id")
    skewed = spark.range(300_000).select(F.when(n % 3 > 0, F.concat(F.lit("hot"), F.floor(F.pow(n % 1000, 0.4)).cast("string"))).when(n % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("rare"), n.cast("string"))).alias("c"))
    want = sorted(tuple(r) for r in conversations.most_common_contents(skewed, F.col("c"), 8).collect())
    got = conversations.frequent_contents(skewed, F.col("c"), 8, tracked=512)
    assert sorted(tuple(r) for r in got.collect()) == want
    flat = spark.range(5000).select(F.concat(F.lit("x"), (n % 2500).cast("string")).alias("c"))
    want = sorted(tuple(r) for r in conversations.most_common_contents(flat, F.col("c"), 5).collect())
    assert sorted(tuple(r) for r in conversations.frequent_contents(flat, F.col("c"), 5, tracked=64).collect()) == want
    assert conversations.frequent_contents(flat.where("false"), F.col("c"), 5).count() == 0


def test_what_a_sketch_does_not_name_is_bounded(spark):
    n = F.col("id")
    rows = spark.range(400_000, numPartitions=9).select(F.md5(F.floor(F.pow(n, 0.8)).cast("string")).alias("digest"))
    named = {r.digest for r in conversations.sketched_counts(rows, 128, fan=4).collect()}
    assert 0 <= len(named) <= 128
    most = max((r.n for r in rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).collect() if r.digest not in named), default=0)
    assert most <= 2 * 3.5 / 256 * 400_000


def test_sketches_bound_the_shuffle(spark):
    """Ten million different contents: what is shuffled are sketches."""
    rows = spark.range(10_000_000, numPartitions=8).select(F.when(F.col("id") % 10 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("digest"))
    found = conversations.sketched_counts(rows, 256)
    names = {r.digest for r in found.collect()}
    assert "hot" in names and len(names) <= 256
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(digest" not in plan and "hashpartitioning(part" in plan


# ---- scratch


def _folders(spark):
    base = os.path.join(session.shared_dir(spark).removeprefix("file:"), "quillmark")
    return set(os.listdir(base)) if os.path.isdir(base) else set()


def test_scratch_drops_its_own_folders_only(spark):
    before = _folders(spark)
    kept = session.run_dir(spark, "kept")
    with session.scratch(spark):
        spark.range(3).write.parquet(session.run_dir(spark, "outer"))
        with pytest.raises(ValueError), session.scratch(spark):
            spark.range(3).write.parquet(session.run_dir(spark, "inner"))
            session.run_dir(spark, "never-written")
            raise ValueError
        assert sorted(f.split("-")[0] for f in _folders(spark) - before) == ["outer"]
        spark.range(4).write.parquet(kept)
    assert _folders(spark) - before == {os.path.basename(kept)} and spark.read.parquet(kept).count() == 4


def test_input_of_parts_is_read_once(spark, folder):
    """Rows of the input are computed once however many parts there are, over several tasks, and nothing is left behind."""
    before, seen = _folders(spark), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(id as string) as id", "id % 7 as _part").mapInArrow(count, "id string, _part long")
    run = stages.staged(rows, ["id"], lambda some, watch: watch(some, n=F.count(F.lit(1))), f"{folder}/s", parts=5)
    assert seen.value == 4000 and run.totals == {"n": 4000} and _folders(spark) == before
    assert sorted((int(r.id), r._part) for r in run.data.collect()) == [(k, k % 7) for k in range(4000)]
    again = stages.staged(rows, ["id"], lambda some, watch: watch(some, n=F.count(F.lit(1))), f"{folder}/s", parts=5)
    assert seen.value == 8000 and again.totals == {"n": 4000} and len(stages.committed(spark, f"{folder}/s")) == 5
