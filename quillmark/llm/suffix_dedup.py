"""Suffix-array dedup: byte strings that occur twice, by suffix arrays built with linear grouping.

Segments that share an anchor's key (see ``anchors``) are cut into blocks of 25 bytes on a grid
through the anchor. The blocks' names, in byte order, form one text per chunk of keys; its
suffix array brings equal runs of blocks together. A window of 400 bytes has 15 whole blocks:
windows whose runs are equal there and whose bytes before and after are equal as well repeat.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.anchors import Powers, ordered, removed, repeated_windows, span_hashes
from quillmark.llm.common import stored
from quillmark.llm.words import BYTE_CODES, ragged, runs, slices, splitmix

WINDOW, GRAM, BLOCK, CROWD = 400, 32, 25, 2048


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of non-negative numbers by linear grouping.

    Suffixes are grouped by their Lyndon prefixes. Groups are taken from the largest to the
    smallest; each member points to the previous smaller suffix, and the suffixes pointed to
    move up within their groups by how many members point to them. Then, from the smallest
    suffix on, each suffix puts those whose Lyndon prefix ends where it starts at the next free
    place of their groups. Nothing is renamed and nothing recurs.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    where = [0] * n
    start_of = [0] * n  # by suffix: first place of its group, which also names the group
    end_of = [0] * n  # by first place: the place after the group's last
    begin = 0
    for k, i in enumerate(order):
        where[i] = k
        if k and text[i] != text[order[k - 1]]:
            end_of[begin] = k
            begin = k
        start_of[i] = begin
    if n:
        end_of[begin] = n
    previous = [-1] * n
    top = n
    while top > 0:
        start = start_of[order[top - 1]]
        members = order[start:top]
        if len(members) > 1:
            members.sort()
        counts: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and start_of[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, c in counts.items():
            by_count.setdefault(c, []).append(p)
        # From the fewest pointers to the most: all that have at least so many move up together.
        rising = [by_count[c] for c in sorted(by_count)]
        for level in range(len(rising)):
            moved: dict[int, list[int]] = {}
            for some in rising[level:]:
                for p in some:
                    moved.setdefault(start_of[p], []).append(p)
            for old, parts in moved.items():
                end = end_of[old]
                if len(parts) == end - old:
                    continue
                new = end - len(parts)
                k = end
                for p in parts:
                    k -= 1
                    at, other = where[p], order[k]
                    order[at], order[k] = other, p
                    where[other], where[p] = at, k
                for p in parts:
                    start_of[p] = new
                end_of[new] = end
                end_of[old] = new
        top = start
    # Emit: the empty suffix first, then each suffix in order; end_of is no longer needed.
    slot, out = list(range(n)), [0] * n

    def put(t: int, stop: int) -> None:
        j = t - 1
        while j != stop:
            g = start_of[j]
            out[slot[g]] = j
            slot[g] += 1
            j = previous[j]

    put(n, -1)
    for placed in range(n):
        put(out[placed], previous[out[placed]])
    return out


def run_classes(text: np.ndarray, length: int) -> np.ndarray:
    """For each place, a number that equal runs of ``length`` symbols share; -1 if the run meets a separator (0) or the end."""
    n = len(text)
    order = np.array(suffix_array(text.tolist()), np.int64)
    padded = np.concatenate((text, np.zeros(length, text.dtype)))
    equal = np.ones(max(n - 1, 0), bool)
    for k in range(length):
        equal &= padded[order[1:] + k] == padded[order[:-1] + k]
    classes = np.empty(n, np.int64)
    classes[order] = np.concatenate(([0], np.cumsum(~equal))) if n else 0
    stops = np.concatenate((np.cumsum(padded == 0), [0]))
    closed = stops[np.arange(n) + length - 1] - np.where(np.arange(n) > 0, stops[np.arange(n) - 1], 0)
    return np.where(closed == 0, classes, -1)


def comparer(window: int = WINDOW, block: int = BLOCK):
    """A method for ``anchors``: windows of segments that another segment of the same key has too."""
    whole = window // block - 1
    if whole < 1 or window % block:
        raise ValueError("a window must be two or more whole blocks")
    powers = Powers()

    def compare(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        far, near = (table.column(c).to_numpy().astype(np.int64) for c in ("far", "near"))
        (first, last, data, offsets), *rest = slices(table.column("body").combine_chunks(), 1 << 62)
        starts, sizes = offsets[:-1], np.diff(offsets)
        # The grid goes through the anchor, which is at symbol ``far`` of its segment.
        lead = far % block
        blocks = np.maximum(sizes - lead, 0) // block
        of = np.repeat(np.arange(len(far)), blocks)
        begin = (starts + lead)[of] + (ragged(np.zeros(len(far), np.int64), blocks)) * block
        view = data[begin[:, None] + np.arange(block)] if len(begin) else np.zeros((0, block), np.uint8)
        _, name = np.unique(np.ascontiguousarray(view).view(np.dtype((np.void, block))).ravel(), return_inverse=True)
        ends = np.cumsum(blocks)
        text = np.insert(name + 1, ends, 0)
        text_start = ends - blocks + np.arange(len(far))  # a separator after each segment
        classes = run_classes(text, whole)
        # All windows: distance d starts at symbol far - d.
        count = far - near + 1
        seg = np.repeat(np.arange(len(far)), count)
        at = ragged(np.zeros(len(far), np.int64), count)  # symbol of the segment where the window starts
        skip = (lead[seg] - at) % block
        group = classes[text_start[seg] + (at + skip - lead[seg]) // block]
        some = group >= 0
        repeats = np.bincount(group[some], minlength=1)
        hit = some & (repeats[np.where(some, group, 0)] > 1)
        seg, at, skip, group = seg[hit], at[hit], skip[hit], group[hit]
        a = starts[seg] + at
        codes = BYTE_CODES[data]
        left = span_hashes(codes, a, a + skip, powers)
        right = span_hashes(codes, a + skip + whole * block, a + window, powers)
        same = splitmix(left ^ splitmix(right ^ splitmix(group.astype(np.uint64))))
        _, which, times = np.unique(same, return_inverse=True, return_counts=True)
        twice = times[which] > 1
        flag = np.zeros(int(count.sum()), bool)
        flag[np.flatnonzero(hit)[twice]] = True
        # Runs of repeated windows, cut between segments.
        bounds = np.cumsum(count)
        spread = np.insert(flag, bounds, False)
        x, y = runs(spread)
        s = np.searchsorted(bounds + np.arange(1, len(far) + 1), x, "right")
        base = bounds[s] - count[s] + s
        return s, far[s] - (y - 1 - base), far[s] - (x - base)

    return compare


def suffix_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, crowd: int = CROWD, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """``_row, doc_id, n_symbols, n_removed, n_spans, kept`` (symbols are UTF-8 bytes) for each row.

    A byte goes if it is covered by a string of ``window`` bytes that also starts anywhere else
    in the column, judged on the input. Matches never cross rows; repeated rows and null ids are
    rows like any other. A null text is empty; a text shorter than a window stays; an empty
    table gives no rows; other columns are not read. ``kept`` may cut a character in two.
    """
    rows = ordered(docs, text_col, id_col)
    ranges = repeated_windows(rows, False, window, gram, lambda: comparer(window, block), False, crowd)
    return removed(rows, stored(ranges, "ranges"), False, window)


def with_digest(left: DataFrame) -> DataFrame:
    return left.select("_row", "doc_id", F.col("n_symbols").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
