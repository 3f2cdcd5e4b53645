"""Substring dedup by relative Lempel-Ziv parsing.

The reference is all that starts earlier in the corpus. It is cut into overlapping blocks, one
around each anchor (see ``anchors``), indexed by the anchor's key; blocks of equal text are one.
A block of a document is factored greedily against every earlier block of its key: at a place
whose window is indexed the match is extended word by word as far as it goes and becomes a
factor. A factor is at least a window long. Windows across the end of a factor are looked up
again from a window before its end, so none that lies in two factors is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.anchors import gram_hashes, ordered, removed, repeated_windows, symbols
from quillmark.llm.common import stored
from quillmark.llm.words import slices

WINDOW, GRAM, CROWD = 20, 6, 4096


def factors(words: list[int], hashes: list[int], index: dict[int, int], reference: list[int], window: int) -> list[tuple[int, int]]:
    """(start, length) of the greedy factors of ``words`` that the reference has; ``hashes`` are of the windows."""
    out, i = [], 0
    while i < len(hashes):
        at = index.get(hashes[i])
        if at is None:
            i += 1
            continue
        size, most = window, len(words) - i
        while size < most and at + size < len(reference) and reference[at + size] == words[i + size]:
            size += 1
        out.append((i, size))
        i += size - window + 1
    return out


def parser(window: int = WINDOW):
    """A method for ``anchors``: repeated windows of each segment against the earlier ones of its key."""

    def parse(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, far = table.column("key").to_pylist(), table.column("far").to_pylist()
        at, near_out, far_out, key = [], [], [], None
        index, reference = {}, []
        for first, last, data, offsets in slices(table.column("body").combine_chunks()):
            codes, firsts, _, _ = symbols(data, offsets, True)
            hashes, words, cuts = gram_hashes(codes, window).tolist(), codes.tolist(), firsts.tolist()
            for k in range(first, last):
                if keys[k] != key:
                    key, index, reference = keys[k], {}, []
                a, b = cuts[k - first], cuts[k - first + 1]
                own, places = words[a:b], hashes[a : b - window + 1]
                for start, size in factors(own, places, index, reference, window):
                    # The window that starts at symbol s of a segment is at distance far - s.
                    at.append(k)
                    near_out.append(far[k] - (start + size - window))
                    far_out.append(far[k] - start)
                base = len(reference)
                for i, h in enumerate(places):
                    index.setdefault(h, base + i)
                reference += own
                reference.append(-1)
        return np.array(at, np.int64), np.array(near_out, np.int64), np.array(far_out, np.int64)

    return parse


def substring_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``_row, doc_id, n_symbols, n_removed, n_spans, kept`` for each row; ``kept`` are the words left, joined by one space.

    Words are runs of anything but ASCII blanks. A word goes if it lies in a window of ``window``
    words whose sequence starts earlier too: in a row of smaller id (null ids last, rows of one
    id in stored order), or before in the same text. A null text has no words; a text of fewer
    words than a window keeps them all; an empty table gives no rows; other columns are not read.
    """
    rows = ordered(docs, text_col, id_col)
    ranges = repeated_windows(rows, True, window, gram, lambda: parser(window), True, crowd)
    return removed(rows, stored(ranges, "ranges"), True, window)


def with_digest(left: DataFrame) -> DataFrame:
    return left.select("_row", "doc_id", F.col("n_symbols").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
