"""Table operators: invariants, brute-force checks, dominant keys."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quillmark.operators import categories, classification, conversations, corpus, evaluation, sampling, training_logs


def key(seed, row_id):
    return hashlib.md5(f"{seed}|{row_id}".encode()).hexdigest()


@pytest.mark.parametrize("n, limit", [(0, None), (1, None), (9, None), (10, None), (137, None), (137, 50), (20, 1000)])
def test_split_is_exact(spark, n, limit):
    df = spark.range(n).toDF("id")
    got = {r.id: r.split for r in sampling.train_eval_split(df, "id", 7, limit=limit).collect()}
    order = sorted(range(n), key=lambda i: key(7, i))
    k = n if limit is None else min(limit, n)
    n_eval = int(k * 0.1)
    assert got == {i: "train" if at < k - n_eval else "eval" for at, i in enumerate(order[:k])}


def test_rank_and_first_k_do_not_depend_on_partitions(spark):
    n = 500
    order = sorted(range(n), key=lambda i: key(3, i))
    for parts in (1, 7):
        df = spark.range(n).toDF("id").repartition(parts)
        ranks = {r.id: r["rank"] for r in sampling.with_global_rank(df, "id", 3).collect()}
        assert ranks == {i: at + 1 for at, i in enumerate(order)}
        assert {r.id for r in sampling.first_k(df, "id", 20, 3).collect()} == set(order[:20])
    assert sampling.first_k(spark.range(5).toDF("id"), "id", 0, 3).count() == 0
    assert [r.id for r in sampling.seeded_order(spark.range(50).toDF("id"), "id", 3).collect()] == sorted(range(50), key=lambda i: key(3, i))


def test_copies_of_one_id_stay_together(spark):
    df = spark.createDataFrame([(i,) for i in range(100)] + [(7,)] * 50, "id int")
    split = sampling.train_eval_split(df, "id", 1)
    assert split.count() == 150
    assert split.groupBy("id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("classes", [None, ["a", "b", "c"]])
def test_stratified_sample_with_dominant_class(spark, classes):
    rows = [(i, "a" if i % 3 else ("b" if i % 2 else "c")) for i in range(400)] + [(1000, "b"), (1001, None)]
    got = {}
    for r in sampling.stratified_sample(spark.createDataFrame(rows, "id int, cls string"), "cls", 80, "id", 42, classes).collect():
        got.setdefault(r.cls, set()).add(r.id)
    want = {}
    for cls in ("a", "b", "c"):
        ids = sorted((i for i, c in rows if c == cls), key=lambda i: key(42, i))
        want[cls] = set(ids[:80])
    assert got == want and len(got["a"]) == 80


def turns_table(spark, spec):
    rows = [(c, t, role, content) for c, turns in spec.items() for t, (role, content) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, content string")


def test_dominant_conversation_is_split_into_segments(spark):
    long = [("user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(1000)]
    bad = long[:700] + [("user", "not mentioned")] + long[701:]
    spec = {1: [("system", "s"), ("user", "u")], 2: long, 3: bad, 4: [("user", "UNKNOWN")]}
    packed = conversations.pack_turns(turns_table(spark, spec), size=64)
    assert packed.agg(F.max(F.size("messages"))).first()[0] == 64
    replaced = conversations.replace_system_turn(conversations.keep_useful(packed), "new")
    turns = turns_table(spark, spec)
    again = conversations.keep_useful(packed, turns=turns, size=64)
    assert again.count() == conversations.keep_useful(packed).count()
    got = {}
    for r in replaced.orderBy("conv_id", "segment").collect():
        got.setdefault(r.conv_id, []).extend((m.role, m.content) for m in r.messages)
    assert got == {1: [("system", "new"), ("user", "u")], 2: [("system", "new"), *long]}
    assert conversations.flatten_messages(packed).count() == 2003


def test_verdicts_agree_with_packed_filter(spark):
    spec = {i: [("user", "Unknown" if i % 4 == 0 else "fine"), ("assistant", None)] for i in range(20)}
    turns = turns_table(spark, spec)
    flat = {r.conv_id for r in conversations.conversation_verdicts(turns).where("useful").collect()}
    packed = {r.conv_id for r in conversations.keep_useful(conversations.pack_turns(turns)).collect()}
    assert flat == packed == {i for i in range(20) if i % 4}


def test_most_common_contents(spark):
    rows = [("hot",)] * 300 + [("b",)] * 5 + [("c",)] * 5 + [(f"x{i}",) for i in range(100)] + [(None,)]
    got = conversations.most_common_contents(spark.createDataFrame(rows, "t string"), F.col("t"), 10).collect()
    digest = lambda s: hashlib.md5(s.encode()).hexdigest()
    ones = sorted((f"x{i}" for i in range(100)), key=digest)[:7]
    assert {(r.content, r.n) for r in got} == {("hot", 300), ("b", 5), ("c", 5), *((x, 1) for x in ones)}


def test_step_budget(spark):
    got = [conversations.step_budget(spark.range(n)).first() for n in (0, 1, 8, 9, 900)]
    assert [(r.steps_per_epoch, r.total_steps, r.warmup_steps) for r in got] == [(0, 0, 1), (1, 1, 1), (1, 1, 1), (2, 2, 1), (113, 113, 11)]


def brute_chunks(text, size, overlap):
    stride = size - overlap
    n = max(-(-(len(text) - overlap) // stride), 1)
    return [text[i * stride : i * stride + size] for i in range(n)]


@pytest.mark.parametrize("size, overlap", [(1022, 64), (10, 3), (10, 0), (10, 9), (7, 5)])
def test_chunks_of_short_and_long_texts(spark, size, overlap):
    alphabet = "ab\n \r é\U0001f600"
    rng = random.Random(size)
    edge = 32 * (size - overlap)
    lengths = [0, 1, overlap, size - 1, size, size + 1, 2 * size - overlap, 2 * size - overlap + 1]
    lengths += [edge - 1, edge, edge + 1, edge + size, edge + 2 * size + 7]
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in lengths]
    df = spark.createDataFrame([*enumerate(texts), (99, None)], "id int, t string")
    got = {}
    for r in corpus.chunk_text(df, "t", ["id"], size, overlap).orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append(r.chunk)
    assert got == {i: brute_chunks(t, size, overlap) for i, t in enumerate(texts)}


def test_chunks_of_texts_of_one_byte_a_character(spark):
    """Cut at bytes, with one other character at characters, however many chunks."""
    texts = ["".join(random.Random(n).choice("ab \n") for _ in range(n)) for n in (0, 1, 9, 10, 11, 55, 56, 57, 58, 64, 2000)]
    texts += [t + "é" for t in texts] + ["😀" + t for t in texts]
    df = spark.createDataFrame([*enumerate(texts)], "id int, t string")
    chunked = corpus.chunk_text(df, "t", ["id"], 10, 3)
    got = {}
    for r in chunked.orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append(r.chunk)
    assert got == {i: brute_chunks(t, 10, 3) for i, t in enumerate(texts)}
    assert "octet_length" in chunked._jdf.queryExecution().optimizedPlan().toString()


def test_word_chunks_and_truncation(spark):
    words = [f"w{i}" for i in range(25)]
    df = spark.createDataFrame([(1, "  " + "\n".join(words) + " "), (2, "one")], "id int, t string")
    got = corpus.chunk_text(df, "t", ["id"], 10, 2, "words").orderBy("id", "chunk_no").collect()
    assert [r.chunk for r in got] == [" ".join(words[i : i + 10]) for i in (0, 8, 16)] + ["one"]
    cut = df.select(corpus.truncate_words(F.col("t"), 3).alias("t")).collect()
    assert [r.t for r in cut] == ["w0 w1 w2", "one"]
    with pytest.raises(ValueError):
        corpus.chunk_text(df, "t", ["id"], 10, 10)


def test_page_records(spark):
    pages = spark.createDataFrame(
        [
            ("Title", "  A long\n summary {{x}}", [("short",), ("a longer   section",), (None,)]),
            ("Other", "about Trump and more", [("a section that is long",)]),
            ("Third", None, [("kept as the summary is missing",)]),
        ],
        "title string, summary string, sections array<struct<text: string>>",
    )
    got = corpus.page_records(pages).orderBy("title", "piece").collect()
    assert [(r.title, r.piece, r.text) for r in got] == [
        ("Third", 1, "Third : kept as the summary is missing"),
        ("Title", 0, "Title : A long summary "),
        ("Title", 2, "Title : a longer section"),
    ]


def brute_pages(edges, seeds, depth):
    frontier, seen, pages = set(seeds), set(seeds), set()
    for _ in range(depth):
        members = [m for c, m in edges if c.replace("Category:", "") in frontier]
        pages |= {m for m in members if "Category:" not in m}
        frontier = {m.replace("Category:", "") for m in members if "Category:" in m} - seen
        seen |= frontier
    return pages


@pytest.mark.parametrize("salted", [False, True])
def test_category_walk_with_cycle_and_dominant_category(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(categories, "BROADCAST_ROWS", 0)
    edges = [("Category:A", "Category:B"), ("Category:B", "Category:A"), ("Category:B", "Category:C"), ("Category:C", "deep")]
    edges += [("Category:A", f"p{i}") for i in range(200)] + [("Category:B", "p1"), ("Category:B", "q"), ("Category:X", "no")]
    df = spark.createDataFrame(edges, "category string, member string")
    for depth in (1, 2, 3, 6):
        rows = [r.page for r in categories.category_pages(df, ["A", "Category:A"], depth).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == brute_pages(edges, {"A"}, depth)


def test_grouped_report_with_missing_groups_and_nan(spark):
    rows = [("a", True, 1.0), ("a", False, float("nan")), ("b", None, 3.0), (None, True, 5.0)]
    df = spark.createDataFrame(rows, "g string, f boolean, p double")
    got = {r.g: r.asDict() for r in evaluation.grouped_report(df, "g", {"flag": F.col("f")}, {"mean": F.col("p")}, {"score": F.col("f")}).collect()}
    assert got["a"] == {"g": "a", "is_total": False, "n": 2, "flag": 0.5, "mean": 1.0, "score": 0.5}
    assert got["b"] == {"g": "b", "is_total": False, "n": 1, "flag": None, "mean": 3.0, "score": 0.0}
    assert got["all"] == {"g": "all", "is_total": True, "n": 4, "flag": 0.666667, "mean": 3.0, "score": 0.5} and len(got) == 3


def test_classification_report_against_hand_count(spark):
    truth = ["a", "a", "a", "b", "b", "c"]
    pred = ["a", "a", "b", "b", "none", "a"]
    df = spark.createDataFrame(list(zip(truth, pred)), "t string, p string")
    got = {r.label: (r.precision, r.recall, r.f1, r.support) for r in classification.classification_report(df, "t", "p", ["a", "b", "c", "none"]).collect()}
    assert got["a"] == (0.666667, 0.666667, 0.666667, 3)
    assert got["b"] == (0.5, 0.5, 0.5, 2)
    assert got["c"] == (0.0, 0.0, 0.0, 1) and got["none"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"] == (0.5, 0.5, 0.5, 6)
    assert got["macro avg"] == (0.291667, 0.291667, 0.291667, 6)
    assert got["weighted avg"] == (0.5, 0.5, 0.5, 6)
    matrix = {(r.truth, r.pred): r.n for r in classification.confusion_matrix(df, "t", "p", ["a", "b", "c"]).collect()}
    assert len(matrix) == 9 and matrix["a", "a"] == 2 and matrix["c", "c"] == 0 and sum(matrix.values()) == 5


def test_classification_report_counts_unlisted_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("mixed", "a"), (None, "a"), ("x", "x"), ("a", "x")], "t string, p string")
    got = {r.label: (r.precision, r.recall, r.support) for r in classification.classification_report(df, "t", "p", ["a"]).collect()}
    assert got == {"a": (0.333333, 0.5, 2), "accuracy": (0.4, 0.4, 5), "macro avg": (0.333333, 0.5, 5), "weighted avg": (0.333333, 0.5, 5)}


def test_comparison_matches_questions(spark):
    base = spark.createDataFrame([("q1", "all", True), ("q2", "all", False), ("q3", "b", True)], "question string, g string, ok boolean")
    tuned = spark.createDataFrame([("q2", "all", True), ("q1", "all", True), ("q4", "b", True)], "question string, g string, ok boolean")
    got = {(r.g, r.is_total): r for r in evaluation.compare_models(base, tuned, "g", {"ok": F.col("ok")}).collect()}
    assert len(got) == 3
    total, both, b = got["all", True], got["all", False], got["b", False]
    assert (total.n_matched, total.n_base_only, total.n_tuned_only, total.ok_base, total.ok_tuned, total.ok_delta) == (2, 1, 1, 0.5, 1.0, 0.5)
    assert both.n_matched == 2 and (b.n_matched, b.ok_base, b.n_base_only) == (0, None, 1)


def test_reports_of_nothing(spark):
    df = spark.createDataFrame([], "t string, p string")
    rows = classification.classification_report(df, "t", "p", ["a"]).collect()
    assert {r.label: r.support for r in rows} == {"a": 0, "accuracy": 0, "macro avg": 0, "weighted avg": 0}


def test_best_checkpoint_takes_the_first_of_equals(spark):
    rows = [(3, 0.1, None, 0.5), (1, 0.1, 2.0, None), (2, 0.1, None, 0.5), (4, 0.2, None, float("nan"))]
    logs = spark.createDataFrame(rows, "step long, epoch double, loss double, eval_loss double")
    assert training_logs.best_checkpoint(logs).first().step == 2
    assert training_logs.loss_curves(logs).count() == 4
