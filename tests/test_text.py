"""String functions against Python's str and re."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark.functions import text

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0      　"
PIECES = st.text(alphabet="ab{}<>/​İß\U0001f600" + SPACES, max_size=40)
MANY = st.lists(PIECES, min_size=20, max_size=60)
RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def clean(s):
    s = " ".join(s.split())
    return re.sub(r"\{.*?\}|\}", "", re.sub(r"\r+", "\r", s))


def tag(s, name="t"):
    m = re.search(rf"<{name}>(.*?)</{name}>", s, re.IGNORECASE | re.DOTALL)
    return m.group(1).strip() if m else None


@RELAXED
@given(MANY)
def test_strip_and_clean_follow_python(one, values):
    rows = [(v,) for v in values]
    assert one("x string", rows, lambda c: text.strip(c("x"))) == [v.strip() for v in values]
    assert one("x string", rows, lambda c: text.clean_text(c("x"))) == [clean(v) for v in values]
    plain = [re.sub(r"\{.*?\}|\}", "", v) for v in values]
    assert one("x string", rows, lambda c: text.remove_braces(c("x"))) == plain


@RELAXED
@given(MANY)
def test_words_follow_python(one, values):
    got = one("x string", [(v,) for v in values], lambda c: text.split_words(c("x")))
    assert got == [v.split() or [""] for v in values]


@RELAXED
@given(st.lists(st.lists(st.sampled_from(["<t>", "</t>", "<T>", "</T>", "a", "\n", " ", "<t"]), max_size=9), min_size=20))
def test_tag_follows_python(one, parts):
    values = ["".join(p) for p in parts]
    assert one("x string", [(v,) for v in values], lambda c: text.extract_tag(c("x"), "t")) == [tag(v) for v in values]


@RELAXED
@given(st.lists(st.text(alphabet="0123456789/. -x_é", max_size=6), min_size=30))
def test_score_follows_python(one, values):
    def score(s):
        m = re.search(r"\b([1-9]|10)\b", s)
        return int(m.group(1)) if m else None

    assert one("x string", [(v,) for v in values], lambda c: text.score_1_to_10(c("x"))) == [score(v) for v in values]


def test_clean_edges(one):
    cases = {
        "  a  b\t\nc ": "a b c",
        "{{cite web}} x {a{b}c} } tail {open": " x c  tail {open",
        "{multi\nline} z": " z",
        "a\xa0　\x1c\x85b": "a b",
        "": "",
        "{" * 50: "{" * 50,
    }
    assert one("x string", [(k,) for k in cases], lambda c: text.clean_text(c("x"))) == list(cases.values())


def test_unclosed_braces_stay_linear(one):
    long = "{" * 200_000 + "\n{ok}"
    got = one("x string", [(long,)], lambda c: F.length(text.remove_braces(c("x"))))
    assert got == [200_001]


def test_unclosed_tags_stay_linear(one):
    got = one("x string", [("<t>" * 100_000,), ("<t>" * 100_000 + "</t>",)], lambda c: F.length(text.extract_tag(c("x"), "t")))
    assert got == [None, 299_997]


def test_tag_edges(one):
    cases = {
        "<SENTIMENT> neg </Sentiment>": "neg",
        "<sentiment></sentiment> neutral": "",
        "<sentiment>pos": None,
        "<sentiment>a</sentiment><sentiment>b</sentiment>": "a",
        "<sentiment>a\nb</sentiment>": "a\nb",
        None: None,
    }
    got = one("x string", [(k,) for k in cases], lambda c: text.extract_tag(c("x"), "sentiment"))
    assert got == list(cases.values())


def test_score_edges(one):
    cases = {"10": 10, "8/10": 8, "7.5": 7, "-3": 3, "10.": 10, "Score: 9": 9, "0": None, "11": None, "100": None,
             "x5": None, "é5": None, "5é": None, "٣": None, "score_6": None}
    assert one("x string", [(k,) for k in cases], lambda c: text.score_1_to_10(c("x"))) == list(cases.values())


def test_verdict_edges(one):
    cases = {"Yes": True, "YES indeed": True, "Yes\n": True, "　yes": True, "Yes, but": False, "yes.": False,
             '"Yes"': False, "No": False, "  ": False, "": False, None: False, "yeſ": False, "yesterday": False}
    assert one("x string", [(k,) for k in cases], lambda c: text.is_yes(c("x"))) == list(cases.values())
    lenient = one("x string", [("Yes, but",), ('"Yes."',), ("yesterday",)], lambda c: text.is_yes(c("x"), strip_punct=True))
    assert lenient == [True, True, False]


def test_keyword_edges(one):
    rows = [("50% OFF", "A 50% off_x"), ("", "a"), (None, "a"), ("a", None), ("a_c", "abc")]
    got = one("e string, g string", rows, lambda c: text.contains_answer(c("e"), c("g")))
    assert got == [True, True, False, False, False]


def test_label_and_reasoning(one):
    rows = [(None, "POSITIVE not"), ("", "neutral"), ("Negative", "positive"), ("x", "positive"), (None, None)]
    got = one("t string, r string", rows, lambda c: text.sentiment_label(c("t"), c("r")))
    assert got == ["positive", "neutral", "negative", "none", "none"]
    none = one("t string, r string", rows, lambda c: text.reasoning_text(c("t"), c("r")))
    assert none == ["none", "none", "Negative", "x", "none"]
    raw = one("t string, r string", rows, lambda c: text.reasoning_text(c("t"), c("r"), "raw"))
    assert raw == ["POSITIVE not", "neutral", "Negative", "x", None]


def test_headline(one):
    rows = [("a\nHeadline: b\nHeadline: c",), ("none",)]
    assert one("x string", rows, lambda c: text.headline_of(c("x"))) == ["b\nHeadline: c", "none"]


def test_fill_does_not_look_into_values(one):
    got = one("a string, b string", [("{b}", "x")], lambda c: text.fill("<{a}|{b}|{c}>", a=c("a"), b=c("b")))
    assert got == ["<{b}|x|{c}>"]
