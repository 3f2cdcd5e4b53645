"""Substring, suffix-array and near dedup, SimHash groups, against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from quillmark.llm import simhash
from quillmark.llm.anchors import gram_hashes, owners
from quillmark.llm.substring_dedup import factors, substring_dedup
from quillmark.llm.suffix_dedup import run_classes, suffix_array, suffix_dedup


def sha(data):
    return hashlib.sha256(data).hexdigest()


def copies(prose):
    """Texts with shared passages in other surroundings, copies, copies of parts, repetition, odd rows."""
    shared, other = prose(1, 45), prose(2, 90)
    rows = [(k, f"{prose(100 + k, 30)} {shared} {prose(200 + k, 25)}") for k in range(12)]
    rows += [(20 + k, other if k % 2 else other + "\n" + prose(300 + k, 5)) for k in range(6)]
    rows += [(30, "na " * 400), (31, "x" * 1500), (32, None), (33, ""), (34, " \n"), (35, shared.split(" ", 3)[3]), (36, other), (36, other), (36, prose(9, 50))]
    rows += [(None, other), (None, prose(10, 60)), (40, "日本語 " * 300), (41, prose(5, 30) + " " + prose(5, 30))]
    return rows


def in_order(rows):
    return sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))


@pytest.mark.parametrize("crowd", [4096, 2])
def test_substring_dedup(table, prose, crowd):
    rows, seen, want = copies(prose), set(), Counter()
    for k in in_order(rows):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", rows[k][1] or "") if w]
        hit = [False] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                hit[a : a + 20] = [True] * 20
            seen.add(window)
        want[(rows[k][0], len(words), sum(hit), " ".join(w for w, h in zip(words, hit) if not h).encode())] += 1
    got = substring_dedup(table(rows), crowd=crowd).collect()
    ids_once = lambda c: Counter({x: n for x, n in c.items() if x[0] is not None and x[0] != 36})  # noqa: E731 - rows of one id have no order of their own
    have = Counter((r.doc_id, r.n_symbols, r.n_removed, bytes(r.kept)) for r in got)
    assert ids_once(have) == ids_once(want)
    assert sorted((n, g) for (i, n, g, _), c in have.items() for _ in range(c)) == sorted((n, g) for (i, n, g, _), c in want.items() for _ in range(c))


@pytest.mark.parametrize("crowd", [2048, 2])
def test_suffix_dedup(table, prose, crowd):
    rows = copies(prose)
    seen = Counter(d[a : a + 400] for _, t in rows for d in [(t or "").encode()] for a in range(len(d) - 399))
    want = Counter()
    for i, t in rows:
        data = (t or "").encode()
        hit = bytearray(len(data))
        for a in range(len(data) - 399):
            if seen[data[a : a + 400]] > 1:
                hit[a : a + 400] = b"\1" * 400
        spans = sum(1 for k in range(len(data)) if hit[k] and not (k and hit[k - 1]))
        want[(i, len(data), sum(hit), spans, sha(bytes(x for x, h in zip(data, hit) if not h)))] += 1
    got = suffix_dedup(table(rows), crowd=crowd).collect()
    assert Counter((r.doc_id, r.n_symbols, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in got) == want


def twins(a, b, middle):
    """Two texts around one middle that differ by the Thue-Morse sequence of two letters on both sides."""
    rng = random.Random(0)
    fill = "".join(rng.choice("cdefghijklm ") for _ in range(224))
    one = "".join(b if i.bit_count() % 2 else a for i in range(256))
    other = "".join(a if i.bit_count() % 2 else b for i in range(256))
    return [x + fill[:112] + middle + fill[112:] + y for x, y in ((one, other), (other, one))]


@pytest.mark.parametrize("letters,middle", [("qs", "inighpfhaak ickddfdlllgf ohhecig"), ("9v", "led kkclggj nmmbeocje gpleenigdf")])
@pytest.mark.parametrize("crowd", [2048, 1])
def test_texts_that_differ_by_thue_morse_do_not_repeat(table, letters, middle, crowd):
    """Sums of powers modulo 2^64 took such texts for equal."""
    texts = twins(*letters, middle)
    got = suffix_dedup(table(list(enumerate([*texts, texts[0][:400] + "z"]))), crowd=crowd).collect()
    want = {0: (400, 1), 1: (0, 0), 2: (400, 1)}
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in got} == want


def test_repeats_of_nothing(table):
    assert substring_dedup(table([])).count() == 0
    assert suffix_dedup(table([])).count() == 0


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(3000):
        text = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(16))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_run_classes():
    text = np.array([1, 2, 3, 0, 1, 2, 3, 2, 3, 0])
    got = run_classes(text, 2)
    assert got[0] == got[4] and got[1] == got[5] == got[7] and got[2] == got[3] == got[8] == -1 and got[0] != got[1]


def test_factors_look_across_their_ends():
    reference = [1, 2, 3, 4, 9, 3, 4, 5, 6]
    index = {}
    hashed = lambda w: [hash(tuple(w[i : i + 3])) for i in range(len(w) - 2)]
    for i, h in enumerate(hashed(reference)):
        index.setdefault(h, i)
    words = [1, 2, 3, 4, 5, 6]
    assert factors(words, hashed(words), index, reference, 3) == [(0, 4), (2, 4)]


def test_owners_depend_on_content():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 60, 500).astype(np.uint64)
    codes[300:360] = codes[100:160]
    grams = gram_hashes(codes, 5)
    assert (gram_hashes(codes[7:], 5) == grams[7:]).all() and len(np.unique(grams[:200])) == 200
    own = owners(grams, 16)
    for p in range(100, 141):
        assert own[p + 200] - (p + 200) == own[p] - p
        assert own[p] - p == int(np.argmin(grams[p : p + 16] >> np.uint64(31)))


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("bucket", [16384, 0])
def test_simhash_groups(table, prose, bucket):
    rows = copies(prose) + [(500 + k, prose(1, 400) + f" w{k}" + (f" v{k}" if k % 3 else "")) for k in range(40)]
    got = simhash.near_groups(table(rows), bucket=bucket).collect()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{brute_fingerprint(t):016x}") for i, t in rows)
    distinct = sorted({brute_fingerprint(t) for _, t in rows})
    root = components(distinct, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for i, t in rows:
        if i is not None:
            least[root[brute_fingerprint(t)]].append(i)
    want = Counter((i, min(least[root[brute_fingerprint(t)]], default=None)) for i, t in rows)
    assert Counter((r.doc_id, r.component_id) for r in got) == want
    assert len({r.component_id for r in got}) < len(set(prints))


def test_one_of_each_component_stays(table, prose):
    rows = copies(prose) + [(500 + k, prose(1, 400) + f" w{k}") for k in range(10)]
    docs = table(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = simhash.near_groups(docs).collect()
    first = {}
    for i, t in rows:
        group = next(r.component_id for r in got if r.doc_id == i and r.fingerprint == f"{brute_fingerprint(t):016x}")
        first.setdefault(group, []).append(-1 if i is None else i)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(min(x for x in g if x >= 0) if max(g) >= 0 else -1 for g in first.values())


def test_long_text_has_a_fingerprint(table):
    long = " ".join(f"w{k % 977}" for k in range(400_000))
    got = simhash.near_groups(table([(1, long), (2, long + " x"), (3, "short")])).collect()
    assert {r.doc_id: r.fingerprint for r in got}[1] == f"{brute_fingerprint(long):016x}"
    assert [r.component_id for r in sorted(got, key=lambda r: r.doc_id)][:2] == [1, 1]


def test_groups_of_nothing(table):
    assert simhash.near_groups(table([])).count() == 0
    assert simhash.keep_one(table([])).count() == 0


@pytest.mark.parametrize("kind", ["string", "repeated"])
def test_no_row_is_lost_without_plain_ids(spark, prose, kind):
    """A table of over 20 MB dealt by its ids, of which some are null or repeated."""
    rng = random.Random(11)
    shared = [prose(9000 + k, 30) for k in range(40)]
    vocabulary = [f"{w}{k}" for k in range(300) for w in ("river", "mill", "grain", "bread", "sack")]
    texts = [" ".join(rng.choices(vocabulary, k=1600)) + " " + rng.choice(shared) for _ in range(2000)]
    number = [None if k < 5 else 7 if k < 9 else k for k in range(2000)]
    ids = [None if n is None else f"d{n:05d}" for n in number] if kind == "string" else number
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame(rows, f"doc_id {'string' if kind == 'string' else 'long'}, text string").repartition(32, "doc_id")
    got = substring_dedup(docs).collect()
    assert len(got) == len(rows)
    seen, total = set(), Counter()
    for k in sorted(range(2000), key=lambda k: (ids[k] is None, ids[k] or 0, k)):
        words, hit = texts[k].split(), set()
        for a in range(len(words) - 19):
            window = hash(tuple(words[a : a + 20]))
            if window in seen:
                hit.update(range(a, a + 20))
            seen.add(window)
        total[ids[k]] += len(hit)
    have = Counter()
    for r in got:
        have[r.doc_id] += r.n_removed
    once = [i for i in have if i is not None and i not in (7, "d00007")]
    assert {i: have[i] for i in once} == {i: total[i] for i in once} and have.total() == total.total()
    bytes_left = suffix_dedup(docs).select("doc_id", "n_symbols").collect()
    assert Counter((r.doc_id, r.n_symbols) for r in bytes_left) == Counter((i, len(t.encode())) for i, t in rows)
