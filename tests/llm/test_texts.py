"""Decontamination, quality, pieces, licenses and languages on small and odd inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quillmark.llm import language, licenses, pieces, quality
from quillmark.llm.decontamination import Index, Wavelet, find_passages, suffix_order, with_digest, without_passages

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# ---- decontamination


def test_wavelet_counts_and_reads():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 11, 300)
    w = Wavelet(values, 11)
    at = np.arange(301)
    for s in range(11):
        assert (w.rank(np.full(301, s), at) == np.concatenate(([0], np.cumsum(values == s)))).all()
    got, before = w.access(at[:-1])
    assert (got == values).all() and before.tolist() == [int((values[:i] == values[i]).sum()) for i in range(300)]


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(4)
    text = np.concatenate(([0], rng.integers(0, 4, 400), [0]))
    assert suffix_order(text).tolist() != []
    index = Index(text, 4)
    for length in (1, 3, 5):
        patterns = rng.integers(1, 4, (20, length))
        low, high = index.search(patterns, np.full(20, length))
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(len(text) - length + 1) if (text[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def benchmark_rows(prose):
    return [
        (1, prose(1, 40)), (2, prose(2, 11)), (3, "Short item, here"), (4, None), (5, " .,"), (6, prose(1, 40)), (None, prose(3, 40)),
        (7, "alpha beta alpha beta alpha beta alpha beta alpha beta alpha"), (10, prose(1, 40)[:200]),
    ]


def document_rows(prose):
    one = prose(1, 40).split()
    return [
        (1, prose(50, 30) + " " + " ".join(one[5:25]) + "! " + prose(51, 20)), (2, " ".join(one[:9])), (3, "A SHORT-ITEM; here it is short item here"),
        (4, None), (5, ""), (6, "alpha beta " * 9), (6, "alpha beta " * 9), (None, prose(2, 11).upper()), (8, prose(3, 40)), (9, "écoute " + prose(1, 40).replace(" ", "\n--")),
        (11, prose(60, 3000)),
    ]


@pytest.mark.parametrize("phrase_bytes", [8 << 20, 300])
def test_passages(table, spark, prose, phrase_bytes):
    items = [(i, t) for i, t in benchmark_rows(prose) if i is not None]
    windows = {}
    for i, t in items:
        w = words_of(t)
        for a in range(max(len(w) - 9, min(len(w), 1))):
            windows.setdefault(tuple(w[a : a + 10]), set()).add(str(i))
    docs = document_rows(prose)
    bench = spark.createDataFrame(benchmark_rows(prose), "item_id long, text string")
    found = with_digest(find_passages(table(docs), bench, phrase_bytes=phrase_bytes)).collect()
    want = []
    for i, t in docs:
        w = words_of(t)
        hit, of = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                for item in windows.get(tuple(w[a : a + n]), ()):
                    of.add(item)
                    hit[a : a + n] = [True] * n
        want.append((i, len(w), sum(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), any(hit)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_passages_are_cut_out(table, spark, prose):
    bench = spark.createDataFrame([(1, prose(1, 40))], "item_id long, text string")
    docs = table([(1, f"before, {prose(1, 40)} after é"), (2, "clean text"), (3, None), (4, prose(1, 40))])
    cleaned = without_passages(docs, bench)
    assert cleaned.columns == docs.columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == {1: "before,  after é", 2: "clean text", 3: None, 4: ""}


def test_no_benchmark_no_documents(table, spark, prose):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in find_passages(table([(1, "a b")]), bench).collect()] == [0]
    assert find_passages(table([]), spark.createDataFrame(benchmark_rows(prose), "item_id long, text string")).count() == 0


# ---- quality


def rated(prose, n=400):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(n):
        good = rng.random() < 0.8
        text = prose(1000 + k, 40)
        rows.append((k, text if good else " | ".join(w.upper() + "!!" for w in text.split())))
        labels.append((k, int(good)))
    return rows, labels


def test_quality_on_held_out_rows(table, spark, prose):
    rows, labels = rated(prose)
    odd = [(None, "x"), (9000, None), (9001, ""), (9001, ""), (9002, "ab"), (9003, prose(1, 4000))]
    marks = spark.createDataFrame(labels + [(0, None), (77_777, 1), (5, 3)], "doc_id long, quality int")
    docs = table(rows + odd)
    model = quality.fit(docs, marks)
    scored = quality.score(docs, model).withColumn("out", quality.held_out("doc_id")).collect()
    assert len(scored) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in scored)
    label = dict(labels)
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored if r.doc_id is not None)
    held = [(label[r.doc_id], r.score) for r in scored if r.doc_id in label and r.out]
    assert np.mean([(s >= 0.3) == y for y, s in held]) > 0.95
    kept = quality.accepted(docs, model, 0.3)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored if r.score >= 0.3}


def test_held_out_labels_teach_nothing(table, spark, prose):
    rows, labels = rated(prose, 120)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    turned = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels], "doc_id long, quality int")
    a, b = (quality.fit(table(rows), m) for m in (marks, turned))
    assert (a.weights == b.weights).all() and a.bias == b.bias and a.offset == b.offset


@pytest.mark.parametrize("epochs, close", [(400, 1e-3), (quality.EPOCHS, 0.05)])
def test_hinge_loss_is_at_its_optimum(monkeypatch, epochs, close):
    """The primal objective against projected gradient ascent on the dual."""
    monkeypatch.setattr(quality, "EPOCHS", epochs)
    rng = np.random.default_rng(4)
    features = [np.sort(rng.choice(30, rng.integers(3, 9), replace=False)).astype(np.int32) for _ in range(60)]
    labels = np.array([int((f < 12).sum() + rng.normal() > 2) for f in features])
    ratios = quality.log_count_ratios(features, labels)
    weights, bias = quality.hinge_fit(features, labels, ratios)
    x = np.zeros((60, 31))
    for row, f in zip(x, features):
        row[f], row[30] = ratios[f] / np.sqrt(len(f)), 1
    sign = np.where(labels == 1, 1.0, -1.0)
    cost = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    gram = (x * sign[:, None]) @ (x * sign[:, None]).T
    dual, step = np.zeros(60), 1 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(200_000):
        dual = np.clip(dual + step * (1 - gram @ dual), 0, cost)
    objective = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()
    best = objective((dual * sign) @ x)
    assert abs(best - (dual.sum() - 0.5 * dual @ gram @ dual)) < 1e-3 * best  # no gap: the yardstick is the optimum
    own = np.append(np.divide(weights[:30], ratios[:30], out=np.zeros(30), where=ratios[:30] != 0), bias)
    assert objective(own) <= best * (1 + close)


def test_quality_without_labels(table, spark, prose):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(table([(1, "a b c")]), none)
    assert [r.score for r in quality.score(table([(1, "a b c")]), model).collect()] == [0.5]
    assert quality.score(table([]), model).count() == 0


# ---- pieces


TEXTS = ["", None, " ", "  two   spaces  ", "one\ntwo\r\n\tthree", "日本語 ゼ 🎉x🎉", "aaaa aaaaaaa bababab", "<s> </s> <0x41>", "x" * 400, "Don't stop, thinking about tomorrow: 12,345.67!", "\x00\x01"]


@pytest.mark.parametrize("kind", [1, 2])
def test_pieces_equal_the_library(prose, kind):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(pieces.load(MODEL))
    proto.trainer_spec.model_type = kind
    for p in proto.pieces:
        if kind == 1 and p.score < -1e8:
            p.score = -40000
    model = proto.SerializeToString()
    texts = [t or "" for t in TEXTS] + [prose(k, 50) for k in range(40)]
    ours = pieces.Pieces(model)
    ids = pieces.Encoder(ours).encode(texts)
    assert [i.tolist() for i in ids] == sentencepiece.SentencePieceProcessor(model_proto=model).encode(texts, num_threads=1)
    assert [ours.decode(i) for i in ids] == [t.encode() for t in texts]


def test_pieces_over_a_table(table):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, "a"), (50, "a▁b")]
    got = pieces.encode(table(rows), MODEL).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if not r.round_trip] == [50]
    for r in got:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest()
    assert pieces.encode(table([]), MODEL).count() == 0


def test_bytes_that_are_no_text(spark, table):
    from pyspark.sql import functions as F

    docs = table([(1, "x"), (2, "y")]).withColumn("text", F.expr("cast(X'41FF20' as string)"))
    assert [(r.n_tokens > 0, r.round_trip) for r in pieces.encode(docs, MODEL).collect()] == [(True, False)] * 2
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    assert [r.n_words for r in find_passages(docs, bench).collect()] == [1, 1]


# ---- licenses


def test_licenses(table, spark):
    mit = licenses.KNOWN["MIT"][2]
    rows = [
        (1, "Some text.\nReleased under the MIT license"), (2, "Copyright (c) 2024 A. Nobody\nAll rights reserved.\n\n" + mit.replace("Software", "software").upper()),
        (3, "Copyright 2019, Them\n" + mit.replace(". ", ".\n")), (4, "This is released under the MIT License."), (5, None), (6, ""), (7, "Licenced under CC BY-NC 4.0!\nlicensed under the Apache Licence, version 2.0"),
        (7, "Licenced under CC BY-NC 4.0!"), (None, "Licensed under the MIT License."), (8, "x y " * 50_000),
    ]
    got = licenses.scan(table(rows), licenses.known_licenses(spark)).collect()
    assert sorted((r.doc_id or 0, r.licenses, r.is_license) for r in got) == sorted([
        (1, ["MIT"], False), (2, ["MIT"], True), (3, ["MIT"], True), (4, [], False), (5, [], False), (6, [], False),
        (7, ["Apache-2.0", "CC-BY-NC-4.0"], False), (7, ["CC-BY-NC-4.0"], True), (0, ["MIT"], True), (8, [], False),
    ])
    assert licenses.scan(table([]), licenses.known_licenses(spark)).count() == 0
    many = licenses.scan(table(rows), licenses.known_licenses(spark), broadcast_rows=0).collect()
    assert sorted(map(repr, many)) == sorted(map(repr, got))
    none = spark.createDataFrame([(None, "x"), ("y", None), ("z", " ")], "license_id string, text string")
    assert [r.n_licenses for r in licenses.scan(table([(1, "")]), none).collect()] == [0]


def test_whole_license_texts(table, spark):
    """License files as they lie in repositories: heading, copyright lines, wrapped lines."""
    import textwrap

    def file(heading, text, years="Copyright (c) 2021, Somebody <x@y.z>\nAll rights reserved.\n"):
        return f"{heading}\n\n{years}\n" + "\n".join(textwrap.wrap(text, 60))

    bsd3 = licenses.BSD_START + licenses.BSD_NAMES + licenses.BSD_END
    rows = [
        (1, file("BSD 3-Clause License", bsd3)), (2, file("", licenses.BSD_START + licenses.BSD_END)), (3, file("MIT License", licenses.MIT)),
        (4, file("", licenses.KNOWN["Unlicense"][0], "")), (5, file("", licenses.KNOWN["Zlib"][0])), (6, file("BSD 3-Clause License", bsd3 + " And more.")),
        (7, "x = 1\n\n" + file("", licenses.KNOWN["GPL-3.0-or-later"][0]) + "\n\ny = 2"),
    ]
    got = {r.doc_id: (r.licenses, r.is_license) for r in licenses.scan(table(rows), licenses.known_licenses(spark)).collect()}
    assert got == {
        1: (["BSD-3-Clause"], True), 2: (["BSD-2-Clause"], True), 3: (["MIT"], True), 4: (["Unlicense"], True), 5: (["Zlib"], True), 6: ([], False),
        7: (["GPL-3.0-or-later"], False),
    }


def test_each_known_text_has_a_cue(monkeypatch, table, spark):
    forms = ["a license for all", "software license text", "x yy", "the software", "y z"]
    cues = licenses.cue_words(forms)
    assert all(set(f.split()) & set(cues) for f in forms) and len(cues) == 4
    rows = [(k, f"Some words.\n{t}\nMore.") for k, t in enumerate(t for texts in licenses.KNOWN.values() for t in texts)]
    got = licenses.scan(table(rows), licenses.known_licenses(spark)).collect()
    assert all(r.n_licenses == 1 for r in got)
    monkeypatch.setattr(licenses, "CUES", 0)
    plain = licenses.scan(table(rows), licenses.known_licenses(spark)).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, got))


# ---- languages


def test_languages(spark):
    rng = random.Random(8)
    vocabulary = {"aa": ["kalu", "miro", "tane", "solu"], "bb": ["grschi", "übten", "pflätz", "krönd"]}
    text = lambda x, n: " ".join(rng.choice(vocabulary[x]) for _ in range(n))
    docs = spark.createDataFrame([(k, text(x, 40), x) for k in range(60) for x in ("aa", "bb")] + [(999, None, "aa"), (998, "x", None)], "doc_id long, text string, lang string")
    langs, weights = language.fit(docs)
    assert langs == ["aa", "bb"]
    page = lambda x, body: f'<html lang="{x}-XX"><script>var übten</script><body><p>{body}</p></body></html>'
    pages = [(k, f"http://www.{x}.example.{x}/p{k}", page(x, text(x, 30))) for k in range(40) for x in ("aa", "bb")]
    odd = [(1000, "http://www.bb.example.bb/none", page("bb", "")), (1001, "http://www.bb.example.bb/plain", "<p>"), (1002, "https://elsewhere.test", page("aa", text("bb", 30))), (1003, None, None), (1004, "", ""), (1004, "", ""), (None, "http://10.0.0.1/x", page("aa", "solu"))]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages + odd], "page_id long, url string, html string, host string, n int")
    got = language.identify(df, langs, weights).collect()
    assert len(got) == len(pages) + len(odd)
    of = {r.page_id: r.language for r in got}
    assert of[1000] == of[1001] == of[1002] == "bb" and of[1003] in langs and of[1004] in langs
    assert all(r.language == r.host.split(".")[1] for r in got if r.page_id is not None and r.page_id < 100)
    assert all(0.5 <= r.probability <= 1 for r in got)
    assert language.identify(df.where("false"), langs, weights).count() == 0
    assert all(r.language is None for r in language.identify(df, [], weights[:0]).collect())


def test_a_rare_language_is_learned(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(["kalu", "miro", "tane"], k=30)), "aa") for k in range(500)] + [(900 + k, "grschi pflätz krönd " * 9, "bb") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, weights = language.fit(docs, per_language=20)
    assert langs == ["aa", "bb"]
    pages = spark.createDataFrame([(1, "http://x.test", "<p>krönd grschi pflätz grschi</p>")], "page_id long, url string, html string")
    assert language.identify(pages, langs, weights).first().language == "bb"


def test_fusion_beats_each_kind_of_evidence(spark):
    """Pages with known truth: text that is absent, short or clear, markup and host that mislead now and then."""
    rng = random.Random(21)
    words = {"aa": ["kalu", "miro", "tane", "solu", "more"], "bb": ["kalo", "mira", "tano", "sola", "mura"]}
    docs = spark.createDataFrame([(k, " ".join(rng.choices(words[x], k=40)), x) for k in range(80) for x in words], "doc_id long, text string, lang string")
    langs, weights = language.fit(docs)
    rows, truth = [], {}
    for k in range(600):
        x = rng.choice(["aa", "bb"])
        other = "bb" if x == "aa" else "aa"
        body = " ".join(rng.choice(words[x if rng.random() < 0.85 else other]) for _ in range(rng.choice([0, 0, 1, 3, 12])))
        declared, host = x if rng.random() < 0.85 else other, x if rng.random() < 0.9 else other
        truth[k] = (x, declared)
        rows.append((k, f"http://s{k % 7}.{host}-site.{host}/p", f'<html lang="{declared}"><p>{body}</p></html>'))
    got = {r.page_id: r for r in language.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), langs, weights).collect()}
    share = lambda right: sum(map(right, truth)) / len(truth)
    fused, alone, markup = share(lambda k: got[k].language == truth[k][0]), share(lambda k: got[k].text_language == truth[k][0]), share(lambda k: truth[k][1] == truth[k][0])
    assert fused > markup and fused > alone + 0.1 and fused > 0.9, (fused, alone, markup)
