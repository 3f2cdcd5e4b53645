"""Exact dedup and sharding against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quillmark.llm.exact_dedup import exact_dedup, keep_first
from quillmark.llm.sharding import assign_shards, schedule


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def odd_rows(prose):
    long = " ".join(prose(k, 300) for k in range(20))
    return [
        (5, "a  b"), (3, "a\tb"), (3, "a b"), (9, None), (8, ""), (None, "a b"), (None, "alone"), (7, " "), (4, " \n"),
        (11, long), (10, long.replace(" ", "  ")), (12, long + "x"), (13, "É é"), (14, "é É"), (15, "a b"), (11, long),
    ]


@pytest.mark.parametrize("block_bytes", [7, 64, 4096])
def test_exact_dedup(table, prose, block_bytes):
    rows = odd_rows(prose)
    got = exact_dedup(table(rows), block_bytes=block_bytes).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    want = Counter()
    for i, t in rows:
        ids = [x for x in groups[normal(t)] if x is not None]
        want[(i, min(ids) if ids else None, len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_keep_first_keeps_columns(table, prose):
    docs = table(odd_rows(prose))
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({normal(t) for _, t in odd_rows(prose)})


def test_exact_dedup_of_nothing(table):
    assert exact_dedup(table([])).count() == 0


def test_schedule_takes_the_longest_first():
    sizes = {"a": 5, "b": 4, "c": 3, "d": 3, "e": 3}
    loads = Counter()
    for unit, shard in schedule(list(sizes.items()), 2):
        loads[shard] += sizes[unit]
    assert sorted(loads.values()) == [8, 10]


def test_shards(table, prose):
    rows = odd_rows(prose) + [(100 + k, prose(k, 20 + k % 50)) for k in range(600)] + [(1000 + k, "same text") for k in range(50)]
    got = assign_shards(table(rows), 7).collect()
    assert len(got) == len(rows)
    by_text = defaultdict(set)
    text_of = defaultdict(list)
    for i, t in rows:
        text_of[(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))].append(t or "")
    slots, loads = defaultdict(list), Counter()
    for r in got:
        by_text[text_of[(r.doc_id, r.size, r.text_crc32)][0]].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    bound = max(sum(len((x or "").encode()) + 16 for _, x in rows if (x or "") == t) for t in by_text)
    assert max(loads.values()) - min(loads.values()) <= bound
    assert {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)


def test_shards_of_nothing(table):
    assert assign_shards(table([])).count() == 0


def brute_schedule(sizes, shards):
    """Loads of the longest-first rule, without a heap."""
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return sorted(loads)


def test_schedule_against_a_plain_one():
    import random

    rng = random.Random(9)
    for _ in range(50):
        sizes, shards = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 40))], rng.randrange(1, 9)
        loads = [0] * shards
        for unit, shard in schedule(list(enumerate(sizes)), shards):
            loads[shard] += sizes[unit]
        assert sorted(loads) == brute_schedule(sizes, shards)


def test_shards_against_the_plain_rule(table, prose):
    """So few groups that each is a unit of its own."""
    rows = [(k, prose(k % 70, 5 + k % 23)) for k in range(150)]
    groups = defaultdict(int)
    for _, t in rows:
        groups[t] += len(t.encode()) + 16
    loads = Counter()
    for r in assign_shards(table(rows), 6).collect():
        loads[r.shard] += r.size
    assert sorted(loads.values()) == brute_schedule(groups.values(), 6)
