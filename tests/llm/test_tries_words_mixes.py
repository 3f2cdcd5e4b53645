"""Prefix trie, spelling variants and mixes against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quillmark.llm import mixing, prefix_trie, spelling

# ---- prefix trie


def word_count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def brute_trie(sequences):
    """Rows of the trie of {conversation: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * word_count(p[-1][1]) if p else 0
    ended = {p: ",".join(map(str, sorted(c for c in who if len(sequences[c]) == len(p)))) for p, who in members.items()}
    return Counter(
        (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p], hashlib.sha256(ended[p].encode()).hexdigest())
        for p, who in members.items()
    )


def rows_of(df):
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def grouped(rows):
    sequences = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, prefix_digest(r))):
        sequences[c].append((role or "", text or ""))
    return dict(sequences)


def prefix_digest(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()


def some_conversations():
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 90), 10_000, -7, -20]:
        for turn in range(rng.choice([0, 1, 2, 3, 3, 5])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["one two", "a", "", "three  little\nwords"])))
    rows += [(200 + k, t, "user", text) for k in range(60) for t, text in enumerate(["hello there", "copy of all", "end"])]
    rows += [(300, t, "user", f"turn {t % 7}") for t in range(500)] + [(301, t, "user", f"turn {t % 7}") for t in range(499)]
    rows += [(400, None, "user", "first"), (400, 0, None, None), (400, 0, "user", "tie"), (400, 0, "user", "tie"), (401, 3, "a:", "b"), (402, 3, "a", ":b"), (None, 1, "user", "nobody"), (403, 1, "user", "long " * 100_000)]
    rng.shuffle(rows)
    return rows


@pytest.fixture()
def many_shards(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def conversations(spark, rows):
    """Turns with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, b"x", 1, 2.0) for r in rows], "conv_id long, turn long, role string, text string, key binary, ids int, n_convs double")


@pytest.mark.parametrize("cells", [prefix_trie.CELLS, 30])
def test_trie(spark, many_shards, cells):
    rows = some_conversations()
    sequences = grouped(rows)
    got = prefix_trie.conversation_trie(conversations(spark, rows), cells=cells)
    assert rows_of(got) == brute_trie(sequences)


def test_trie_in_one_shard(spark):
    rows = some_conversations()
    assert rows_of(prefix_trie.conversation_trie(conversations(spark, rows).coalesce(1), cells=100)) == brute_trie(grouped(rows))


def test_rebuilt_conversations(spark, many_shards):
    rows = some_conversations()
    own, new = grouped(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        new[c] = head[:h] + turns[h:]
    assert any(not t for t in new.values())  # some are without turns
    made = prefix_trie.rebuilt(prefix_trie.turn_rows(conversations(spark, rows)))
    assert rows_of(prefix_trie.trie(made, cells=64, broadcast_nodes=0)) == brute_trie(new)


def test_trie_of_little(spark):
    assert prefix_trie.conversation_trie(conversations(spark, [])).count() == 0
    alone = spark.createDataFrame([(5, [], []), (3, [], [])], "conv_id long, ids array<long>, words array<int>")
    assert rows_of(prefix_trie.trie(alone)) == brute_trie({5: [], 3: []})


def test_a_crowd_of_copies_is_dealt_out(spark, many_shards):
    rows = [(c, t, "user", x) for c in range(4000) for t, x in enumerate(["same", "words in", "all"])]
    sequences = prefix_trie.turn_rows(conversations(spark, rows))
    found = prefix_trie._shards(sequences, 3000)
    assert found.where("kind = 3").count() > 8  # border rows: two a shard
    assert rows_of(prefix_trie.trie(sequences, 3000)) == brute_trie(grouped(rows))


@pytest.mark.parametrize("nodes", [1, 7])
def test_depths_with_equal_nodes_in_small_batches(spark, many_shards, monkeypatch, nodes):
    monkeypatch.setattr(prefix_trie, "BATCH_NODES", nodes)
    rows = some_conversations()
    assert rows_of(prefix_trie.conversation_trie(conversations(spark, rows), cells=5000)) == brute_trie(grouped(rows))


def test_one_conversation_with_most_turns(spark, many_shards):
    n, copied = 20_000, 15_000
    turns = [(t, "user", f"turn {t % 7} " + "more " * (t % 3)) for t in range(n)]
    rows = [(7, *t) for t in turns] + [(9, *t) for t in turns[:copied]] + [(c, 0, "user", f"other {c}") for c in range(20, 40)]
    got = prefix_trie.conversation_trie(conversations(spark, rows)).where("conv_id = 7").collect()
    assert len(got) == n + 1 and {r.depth for r in got} == set(range(n + 1))
    saved = list(itertools.accumulate((word_count(x) for _, _, x in reversed(turns[:copied])), initial=0))[::-1]
    ends = {copied: "9", n: "7"}
    for r in got:
        assert r.n_convs == (22 if not r.depth else 2 if r.depth <= copied else 1)
        assert (r.n_children, r.n_leaves) == ((21, 21) if not r.depth else (int(r.depth < n), 1))
        assert r.saved_tokens == (saved[max(r.depth, 1) - 1] if r.depth <= copied else 0)
        assert r.parent_conv_id == (7 if r.depth else None)
        assert r.ends_sha256 == hashlib.sha256(ends.get(r.depth, "").encode()).hexdigest()


# ---- spelling


def brute_words(rows, shortest=7, often=2, mutate=31):
    counts = Counter()
    for i, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if mutate and h % mutate == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= often}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(words, factor=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= factor * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def spelled(n_words=60):
    rng = random.Random(2)
    base = ["".join(rng.choice("aeiorst") for _ in range(rng.randrange(7, 13))) for _ in range(n_words)] + ["Straßeñada", "aaaaaaaa", "aaaaaaaaa", "aaaaaaa", "abababab", "babababa"]
    texts = []
    for k in range(260):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.12)), len(base) - 1)]
            at, kind = rng.randrange(len(w)), rng.random()
            if kind < 0.04:
                w = w[:at] + rng.choice("aeixÿÀ") + w[at + 1 :]
            elif kind < 0.06:
                w = w[:at] + w[at:].upper()
            elif kind < 0.08:
                w = w[:at] + rng.choice("ae") + w[at:]
            words.append(w)
        texts.append((k, rng.choice([" ", ", ", "1", "\n", "_", "日"]).join(words)))
    long = "z" * 3000
    chain = [(500, "chainedword " * 1000), (501, "chainedworx " * 50), (502, "chainedwarx " * 4)]
    return texts + chain + [(None, "nullable nullable nullablee"), (5, None), (6, ""), (7, "short"), (7, texts[7][1]), (8, f"{long} {long}x {long} {long}x {long}q"), (9, "÷÷÷÷÷÷÷× ÷÷÷÷÷÷÷×")]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 2])
def test_spelling_variants(table, crowd):
    rows = spelled()
    got = spelling.spelling_variants(table(rows), mutate=31, crowd=crowd).collect()
    want = brute_variants(brute_words(rows))
    assert len(want) > 150 and any(f for _, f, *_ in want) and any(r != f for _, f, r, *_ in want if f)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want and len(got) == len(want)


def test_spelling_without_mutation(table):
    rows = spelled(20)
    got = {(r.word, r.n) for r in spelling.vocabulary(table(rows), mutate=None).collect()}
    assert got == set(brute_words(rows, mutate=None).items())


def test_spelling_of_nothing(table):
    assert spelling.spelling_variants(table([])).count() == 0
    assert spelling.spelling_variants(table([(1, None), (2, "a b")])).count() == 0


def test_pieces_cut_no_run(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    text = "abcdefghijklmnop qr stuvwx yz " * 5
    parts = list(spelling._pieces(text, re.compile("[^a-z]")))
    assert "".join(parts) == text and all(re.findall("[a-z]+", "".join(parts)) == list(itertools.chain(*(re.findall("[a-z]+", p) for p in parts))) for _ in [0])


# ---- mixes


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        parts = sum(weight[s] for s in order if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else weight[s] * left / parts for s in order}
        more = {s for s in order if target[s] > most * sizes[s]}
        if not more:
            return target
        stopped |= more


def mixed_rows():
    rng = random.Random(12)
    rows = []
    for k in range(300):
        source = rng.choice(["src1"] * 8 + ["src0", "é", "Z", "a", None, "tiny", "src2"])
        rows.append((k, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 300]))), source))
    rows += [(900, None, "src0"), (901, "", None), (5, "again again", "src1"), (5, "again again", "src1"), (None, "no id", "src2"), (None, "no id", "src2"), (902, "one", "lonely"), (903, None, "empty"), (904, "w " * 20_000, "huge")]
    return rows


def with_sources(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, source string, size int, place int, target string")


@pytest.mark.parametrize("least_block", [64, 7, 100_000])
def test_mix(spark, least_block):
    rows = mixed_rows()
    mix = mixing.Mix(with_sources(spark, rows), least_block=least_block)
    got = mix.documents().collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += word_count(t or "")
    target = brute_targets(sizes)
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == Counter((i, word_count(t or ""), sizes[s], round(target[s], 6)) for i, t, s in rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    again = mixing.Mix(with_sources(spark, rows[::-1]).repartition(5), least_block=least_block).documents().collect()
    key = lambda r: (r.doc_id, r.size, r.source, r.target, r.taken)
    assert Counter(map(key, got)) == Counter(map(key, again))


def test_schedule_is_even_and_complete(spark):
    rows = mixed_rows()
    mix = mixing.Mix(with_sources(spark, rows), least_block=20)
    slots = sorted(r for r in mixing.schedule(mix.sources, mix.block).collect())
    assert len({r.position for r in slots}) == len(slots)
    share, seen = Counter(r.place for r in slots), Counter()
    for k, r in enumerate(slots, 1):
        seen[r.place] += 1
        # The discrepancy of the points is logarithmic.
        assert all(abs(seen[p] - share[p] * k / len(slots)) < 8 for p in share)
    ranks = defaultdict(list)
    for r in slots:
        ranks[r.place].append((r.epoch, r.block))
    assert all(x == sorted(x) for x in ranks.values())
    # The pieces of a slot are its words, without gaps.
    pieces = defaultdict(list)
    for r in mix.pieces().collect():
        pieces[r.position].append((r.at, r.words))
    for r in slots:
        at = 0
        for begin, words in sorted(pieces[r.position]):
            assert begin == at and words > 0
            at += words
        assert at == r.words


def test_mix_of_nothing(spark):
    assert mixing.Mix(with_sources(spark, [])).documents().count() == 0
    blank = mixing.Mix(with_sources(spark, [(1, None, None), (2, " ", "a")])).documents().collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in blank] == [(0, 0, 0.0, 0)] * 2
