"""Spelling variants: words one edit apart, by dense tiles of padded code-point matrices.

Two words are one edit apart if their common prefix and common suffix together reach the longer
length minus one. For words whose longer one has M code points and for any cut t, either the
first t code points agree or the last M - t do. So each word is keyed by half its code points
from either side, and only words of one key are compared: blocks of words, padded from the left
and from the right, against each other, all pairs of a tile at once.

A key with more than ``crowd`` words is cut again: what is open between the known prefix and the
known suffix is halved, until one code point is open, which bounds the key's words by the
alphabet. Each pair is found under one key only.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import schemas, stored, whole_text
from quillmark.llm.words import ragged

SHORTEST, OFTEN, FACTOR, MUTATE = 7, 2, 10, 31
CROWD, TILE, TILE_CELLS, PIECE, HELD_WORDS = 2048, 64, 1 << 21, 1 << 20, 200_000
LETTERS = "a-zÀ-ÿ"


def _pieces(text: str, end_of_run: re.Pattern):
    """The text in pieces that cut no run."""
    at = 0
    while at < len(text):
        stop = at + PIECE
        if stop < len(text):
            found = end_of_run.search(text, stop)
            stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


def run_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shortest: int = SHORTEST, mutate: int | None = MUTATE) -> DataFrame:
    """``word, n``: partial counts of the runs of letters of ``shortest`` code points or more, A-Z lowered.

    With ``mutate`` a run loses one code point if that number divides the CRC-32 of
    ``<id>:<run>``, the code point at the CRC modulo the run's length.
    """
    schema, arrow = schemas("word string, n long")
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), whole_text(text_col).cast("binary").alias("text"))

    def run(batches):
        runs, other = re.compile(f"[{LETTERS}]{{{shortest},}}"), re.compile(f"[^{LETTERS}]")
        counts: Counter = Counter()

        def out():
            words = [w for w, n in counts.items() if n]
            made = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())], schema=arrow)
            counts.clear()
            return made

        for batch in batches:
            for name, raw in zip(batch.column("id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(f"{name}:".encode())
                for piece in _pieces(raw.as_py().lower().decode("utf-8", "replace"), other):  # of bytes: A-Z only
                    found = runs.findall(piece)
                    counts.update(found)
                    for word in found if mutate else ():
                        h = zlib.crc32(word.encode(), seed)
                        if h % mutate == 0:
                            counts[word] -= 1
                            if len(word) > shortest:
                                at = h % len(word)
                                counts[word[:at] + word[at + 1 :]] += 1
                    if len(counts) > HELD_WORDS:
                        yield out()
        yield out()

    return rows.mapInArrow(run, schema)


def vocabulary(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shortest: int = SHORTEST, often: int = OFTEN, mutate: int | None = MUTATE) -> DataFrame:
    """``word, n`` of the words that occur ``often`` times or more."""
    return run_counts(docs, text_col, id_col, shortest, mutate).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def _halved(entries: DataFrame) -> DataFrame:
    """Entries with a longer known prefix, and with a longer known suffix: half of what is open each."""
    cut = F.col("lo") + F.floor((F.col("m") - F.col("lo") - F.col("hi")) / 2).cast("int")
    sides = F.array(F.struct(cut.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), (F.col("m") - cut).alias("hi")))
    halves = entries.select("word", "n", "m", F.explode(sides).alias("side")).select("word", "n", "m", "side.lo", "side.hi")
    known = [F.substring("word", F.lit(1), F.col("lo")), F.substring("word", F.length("word") - F.col("hi") + 1, F.col("hi"))]
    return halves.withColumn("key", F.xxhash64("m", "lo", "hi", *known))


class Block:
    """Some words as matrices of code points, padded on the right and on the left."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int):
        self.first, self.lengths = first, np.diff(offsets[first : last + 1])
        self.width = int(self.lengths.max())
        row, col = np.repeat(np.arange(last - first), self.lengths), ragged(np.zeros(last - first, np.int64), self.lengths)
        flat = data[offsets[first] : offsets[last]]
        self.left, self.right = (np.zeros((last - first, self.width), np.uint8) for _ in range(2))
        self.left[row, col] = flat
        self.right[row, col + np.repeat(self.width - self.lengths, self.lengths)] = flat


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For all pairs of rows, how many columns agree before the first that does not."""
    same = x[:, None, :] == y[None, :, :]
    first = same.argmin(axis=2)
    first[same.all(axis=2)] = x.shape[1]
    return first


def tile(x: Block, y: Block) -> tuple[np.ndarray, np.ndarray]:
    """(one edit apart, common prefix) for all pairs of words of two blocks."""
    width = max(x.width, y.width)
    pad = [(0, 0), (0, 0)]

    def wide(m: np.ndarray, left: bool) -> np.ndarray:
        pad[1] = (width - m.shape[1], 0) if left else (0, width - m.shape[1])
        return np.pad(m, pad)

    shorter = np.minimum(x.lengths[:, None], y.lengths[None, :])
    longer = np.maximum(x.lengths[:, None], y.lengths[None, :])
    prefix = np.minimum(_agree(wide(x.left, False), wide(y.left, False)), shorter)
    suffix = np.minimum(_agree(wide(x.right, True)[:, ::-1], wide(y.right, True)[:, ::-1]), shorter)
    near = (prefix + suffix >= longer - 1) & (longer - shorter <= 1) & ~((prefix == longer) & (longer == shorter))
    return near, prefix


def _whole_keys(batches, rows: int = 8192):
    """Tables of whole keys out of batches sorted by key."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += len(batch)
        if size >= rows:
            table = pa.concat_tables(held).combine_chunks()
            keys = table.column("key").to_numpy()
            cut = int(np.flatnonzero(keys == keys[-1])[0])
            if cut:
                yield table.slice(0, cut)
            held, size = [table.slice(cut)], len(table) - cut
    if size:
        yield pa.concat_tables(held).combine_chunks()


def _pairs(entries: DataFrame) -> DataFrame:
    """``word, other, other_n`` for words of one key that are one edit apart, both ways."""
    schema, arrow = schemas("word string, other string, other_n long")
    rows = entries.withColumn("points", F.encode("word", "ISO-8859-1"))  # letters up to U+00FF are one byte each
    rows = rows.repartition("key").sortWithinPartitions("m", "key", "word").select("key", "m", "hi", "n", "word", "points")

    def run(batches):
        for table in _whole_keys(batches):
            table = table.combine_chunks().to_batches()[0]
            key, m, hi = (table.column(c).to_numpy() for c in ("key", "m", "hi"))
            points = table.column("points").cast(pa.large_binary())
            _, offsets, data = points.buffers()
            offsets = np.frombuffer(offsets, np.int64)[points.offset : points.offset + len(points) + 1]
            data = np.frombuffer(data, np.uint8)
            blocks, at = [], 0
            while at < len(key):
                size = max(1, min(TILE, int((TILE_CELLS / int(m[min(at + TILE, len(m)) - 1])) ** 0.5)))
                blocks.append((at, min(at + size, len(key))))
                at += size
            made: dict[int, Block] = {}
            a_at, b_at = [], []
            for i, (a, b) in enumerate(blocks):
                made = {k: v for k, v in made.items() if k >= i}
                j = i
                while j < len(blocks) and (j == i or key[blocks[j][0]] == key[b - 1]):
                    c, d = blocks[j]
                    for k in (i, j):
                        if k not in made:
                            made[k] = Block(data, offsets, *blocks[k])
                    near, prefix = tile(made[i], made[j])
                    longest = np.maximum(made[i].lengths[:, None], made[j].lengths[None, :])
                    near &= (key[a:b, None] == key[None, c:d]) & (longest == m[a:b, None]) & (prefix < (m - hi)[a:b, None])
                    if i == j:
                        near = np.triu(near, 1)
                    x, y = np.nonzero(near)
                    a_at.append(x + a)
                    b_at.append(y + c)
                    j += 1
            x, y = np.concatenate(a_at), np.concatenate(b_at)
            one, other = pa.array(np.concatenate((x, y))), pa.array(np.concatenate((y, x)))
            words = table.column("word")
            yield pa.RecordBatch.from_arrays([words.take(one), words.take(other), table.column("n").take(other)], schema=arrow)

    return rows.mapInArrow(run, schema)


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word, other, other_n`` for all ordered pairs of distinct words (``word, n``) one edit apart, each pair once."""
    length = F.length("word")
    entries = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("m"), F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    found = None
    while True:
        entries = stored(_halved(entries), "spelling-keys")
        open_ = F.col("m") - F.col("lo") - F.col("hi") > 1
        crowded = entries.where(open_).groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > crowd).select("key")
        crowded = stored(crowded, "crowded-keys")
        is_crowded = not crowded.isEmpty()
        some = _pairs(entries.join(crowded, "key", "left_anti") if is_crowded else entries)
        found = some if found is None else found.unionByName(some)
        if not is_crowded:
            return found
        entries = entries.join(crowded, "key", "left_semi").drop("key")


def with_forms(words: DataFrame, near: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each of ``words`` out of its near words.

    The form is the near word of largest ``n``, of those the smallest, if it occurs ``factor``
    times as often as the word or more; the root is the last word when forms are followed.
    """
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    groups = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    is_form = -F.col("best.less") >= factor * F.col("n")
    rows = words.join(groups, "word", "left").select(
        "word", F.when(is_form, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    rows = stored(rows, "forms")
    ups = rows.where("form is not null").select("word", F.col("form").alias("up"))
    while True:  # a chain grows by the factor with each word, so it is short; each round doubles the steps
        further = ups.select(F.col("word").alias("up"), F.col("up").alias("over"))
        ups = stored(ups.join(further, "up", "left").select("word", F.coalesce("over", "up").alias("up"), F.col("over").isNotNull().alias("moved")), "roots")
        if ups.where("moved").isEmpty():
            break
        ups = ups.drop("moved")
    return rows.join(ups.select("word", F.col("up").alias("root")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shortest: int = SHORTEST, often: int = OFTEN, factor: int = FACTOR, mutate: int | None = None, crowd: int = CROWD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each distinct word of ``shortest`` code points and ``often`` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered. A null text has none,
    a null id counts as an empty one (ids matter with ``mutate`` only, see ``run_counts``).
    Repeated rows count each; an empty table has no words; other columns are not read.
    """
    words = stored(vocabulary(docs, text_col, id_col, shortest, often, mutate), "vocabulary")
    return with_forms(words, near_words(words, crowd), factor)
