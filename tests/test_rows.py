"""Vectors, labels, chats, prompts and curation on small rows."""

import math

import pytest
from pyspark.sql import functions as F

from quillmark.functions import chat, labels, prompts, vectors
from quillmark.functions import fixed_values as V
from quillmark.operators import curation


def test_perplexity(one):
    rows = [([9.0, -1.0, -2.0, -0.5], 1), ([1.0], 1), ([], 0)]
    got = one("lp array<double>, n int", rows, lambda c: vectors.perplexity(c("lp"), c("n")))
    assert math.isclose(got[0], 3.211270543153561) and got[1:] == [None, None]


def test_cosine_and_threshold(one):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 2.0]), ([0.0, 0.0], [1.0, 0.0]), ([float("nan")], [1.0])]
    schema = "a array<float>, b array<float>"
    got = one(schema, rows, lambda c: vectors.cosine(c("a"), c("b")))
    assert got[:3] == [1.0, 0.0, None] and math.isnan(got[3])
    passed = one(schema, rows, lambda c: vectors.at_least(vectors.cosine(c("a"), c("b")), 0.5))
    assert passed == [True, False, False, False]


def test_new_tokens(one):
    rows = [([1, 2, 3], 2), ([1], 1), ([1], 5)]
    assert one("t array<int>, n int", rows, lambda c: vectors.after_prompt(c("t"), c("n"))) == [[3], [], []]


def test_labels(one, spark):
    rows = [("negative",), ("neutral",), ("positive",), ("none",), (None,)]
    assert one("x string", rows, lambda c: labels.label_code(c("x"))) == [0, 1, 2, 1, 1]
    assert one("x int", [(0,), (1,), (2,)], lambda c: labels.label_name(c("x"))) == ["negative", "neutral", "positive"]
    assert one("x int", [(7,), (None,)], lambda c: labels.label_name(c("x"), "null")) == [None, None]
    with pytest.raises(Exception, match="unknown label code: 7"):
        one("x int", [(7,)], lambda c: labels.label_name(c("x")))
    assert one("x string", [("none",), ("positive",)], lambda c: labels.settle_none(c("x"), "neutral")) == ["neutral", "positive"]


CONVERSATION = "m array<struct<role: string, content: string>>"


def test_system_turn(one):
    rows = [([("system", "old"), ("user", "u")],), ([("user", "u")],), ([],)]
    got = one(CONVERSATION, rows, lambda c: chat.with_system_turn(c("m"), "new"))
    plain = [[(m.role, m.content) for m in conv] for conv in got]
    assert plain == [[("system", "new"), ("user", "u")], [("system", "new"), ("user", "u")], [("system", "new")]]


def test_usefulness(one):
    rows = [([("user", "It is NOT SPECIFIED")],), ([("user", None)],), ([],), ([("a", "x"), ("b", "Unknown man")],)]
    assert one(CONVERSATION, rows, lambda c: chat.is_useful(c("m"))) == [False, True, True, False]


def test_render_two_ways(one):
    rows = [([("user", "q"), ("assistant", "a")],)]
    text = "<start_of_turn>user\nq<end_of_turn>\n<start_of_turn>model\na<end_of_turn>\n"
    assert one(CONVERSATION, rows, lambda c: chat.render(c("m"))) == [text]
    flat = one("q string, a string", [("q", "a")], lambda c: chat.render_turns(("user", c("q")), ("assistant", c("a"))))
    assert flat == [text]
    opened = one(CONVERSATION, rows, lambda c: chat.render(c("m"), open_turn=True))
    assert opened == [text + "<start_of_turn>model\n"]


def test_prompts(one):
    judge = one("q string, e string, g string", [("Q", "E", "G")], lambda c: prompts.judge_text(c("q"), c("e"), c("g")))[0]
    assert "Question:\nQ\n\nExpected Answer:\nE\n\nGenerated Answer:\nG\n\nIs the" in judge
    train = one("t string, s string, r string", [("T", "neutral", "R")], lambda c: prompts.supervised_prompt(c("t"), c("s"), c("r")))[0]
    assert train.endswith("<sentiment>neutral</sentiment>\n<reasoning>R</reasoning><end_of_turn>\n")
    assert '\n\nHeadline: "T"\n' in train
    qa = one("t string", [("chunk {x}",)], lambda c: prompts.qa_prompt(c("t")))[0]
    assert qa.endswith("Text:\nchunk {x}\n") and '"question": "Question 1?"' in qa
    assert V.ANSWER_INSTRUCTION in one("q string", [("Q",)], lambda c: prompts.answer_prompt(c("q")))[0]


def test_reply_json(one):
    good = '{"question": "q", "answer": "a", "rating": %s}'
    rows = [("[]",), (f"```json\n[{good % 8}]\n```",), (f"Here [{good % chr(34)}8{chr(34)}}}]",), ("[" + good % 8,), ("none",), (None,)]
    got = one("x string", rows, lambda c: F.transform(curation.parse_ratings(c("x")), lambda p: p["rating"]))
    assert got[0] == [] and got[1] == [8.0] and got[3:] == [[8.0], None, None]  # what is complete in a cut reply stays
    quoted = one("x string", [('[{"question": "q", "answer": "a", "rating": "8.5"}, {"rating": "high"}]',)],
                 lambda c: F.transform(curation.parse_ratings(c("x")), lambda p: p["rating"]))
    assert quoted == [[8.5, None]]


def test_array_is_cut_at_its_outer_brackets(one):
    pair = '{"question": "qé]😀", "answer": "[a"}'
    whole = [f"[{pair}]", f"é😀 \n[{pair}] é", f"] [{pair}]", f"[{pair}] and ] more", f"{'x' * 5000}[{pair}]{'é' * 5000}"]
    broken = ["", "]", "[", "][", "no ] before [", f"[{pair}", f"{pair}]", None]
    got = one("t string", [(t,) for t in whole + broken], lambda c: curation.parse_array(c("t"), curation.PAIR))
    assert [[tuple(p) for p in a] for a in got[: len(whole)]] == [[("qé]😀", "[a")]] * len(whole)
    assert got[len(whole) :] == [None] * len(broken)


def test_rating_batches(spark):
    pairs = [("q%d" % i, "a") for i in range(9)]
    df = spark.createDataFrame([(1, pairs), (2, []), (3, None)], f"id int, pairs {curation.PAIR}")
    got = curation.rating_batches(df, "pairs", ["id"]).collect()
    assert [(r.id, r.group_no, r.pairs_json.count('"question"')) for r in got] == [(1, 0, 4), (1, 1, 4), (1, 2, 1)]


def test_ratings_attach_to_the_pairs_sent(spark):
    """Unreadable, short, long and mute replies lose no pair and make none."""
    pairs = [(f"q{i}", "a") for i in range(4)]
    one_rating = "struct<question: string, answer: string, rating: double>"
    cases = [
        (1, pairs, None), (2, pairs, [("q1", "a", 7.0)]), (3, pairs, [(f"q{i}", "a", float(i)) for i in range(4)] + [("new", "a", 9.0)]),
        (4, pairs, [(None, None, 3.0), (None, None, None)]), (5, pairs, [("q3", "a", 5.0), ("q0", "b", 6.0)]),
    ]
    df = spark.createDataFrame(cases, f"id int, pairs {curation.PAIR}, rated array<{one_rating}>")
    got = {r.id: [(p.question, p.rating) for p in r.x] for r in df.withColumn("x", curation.attach_ratings(F.col("pairs"), F.col("rated"))).collect()}
    names = [q for q, _ in pairs]
    want = {1: [None] * 4, 2: [None, 7.0, None, None], 3: [0.0, 1.0, 2.0, 3.0], 4: [3.0, None, None, None], 5: [6.0, None, None, 5.0]}
    assert got == {k: list(zip(names, v)) for k, v in want.items()}
    written = spark.createDataFrame([(1, pairs), (2, None)], f"id int, pairs {curation.PAIR}")
    counts = curation.reply_counts(written, df).first().asDict()
    assert counts == {
        "n_chunks": 2, "n_unreadable_chunks": 1, "n_written": 4, "n_prompts": 5, "n_unreadable_ratings": 1, "n_short": 3, "n_long": 1, "n_extra": 1,
    }


def test_curation_counts(spark):
    df = spark.createDataFrame([(5.0,), (4.9,), (None,), (10.0,)], "rating double")
    assert curation.keep_rated(df).count() == 2
    assert curation.curation_counts(df).first().asDict() == {"n_pairs": 4, "n_kept": 2, "n_below": 1, "n_unrated": 1}
