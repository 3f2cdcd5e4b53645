"""Finding repeated windows of a corpus: what substring and suffix-array dedup share.

A window is a fixed number of symbols (bytes or words). Each window is owned by the place in it
where the hash of a short gram is smallest, the leftmost if several are. That place, the anchor,
depends on the window's content alone, so equal windows have anchors of the same gram (``key``)
at the same distance. Consecutive windows mostly share an anchor, so a corpus has few of them.

1. Anchors whose key occurs once own no repeated window.
2. Anchors with equal key and equal text over all their windows (``span``) are one class. It is
   aggregated before anything is shuffled, so a text with a million copies is one row.
3. Classes that share a key with another class are compared by the operator's own method, given
   the text of one member each (a *segment*), all segments of a key together.
4. A key with more than ``crowd`` classes is not put into one task: its windows are split by
   their distance to the anchor into ranges an eighth as long, each keyed by the text its
   windows have in common, and the parts go through 1 to 4 again. With one window left, the
   key is the window and its classes are one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, schemas, stored
from quillmark.llm.words import BLANK_BYTES, BYTE_CODES, byte_table, ragged, slices, splitmix, word_codes, word_spans

PLACE_BITS, ORDER_BITS, CHUNK_BYTES, SPLIT = 28, 35, 1 << 20, 8
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
WORD_TABLE = byte_table(BLANK_BYTES, lower=False)


class Powers:
    """Powers of the base and its inverse, grown as needed; one per task."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, BASE))), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, INVERSE))), dtype=np.uint64)
        return self.up[:n], self.down[:n]


def symbols(data: np.ndarray, offsets: np.ndarray, by_words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, first symbol of each row and the count, byte starts, byte ends) of the symbols."""
    if not by_words:
        at = np.arange(len(data))
        return BYTE_CODES[data], offsets, at, at + 1
    mapped, starts, ends, firsts = word_spans(data, offsets, WORD_TABLE)
    return word_codes(mapped, starts, ends), firsts, starts, ends


def gram_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` codes, by doubling."""
    with np.errstate(over="ignore"):
        power, width, total, done = codes, 1, None, 0
        while True:
            if size & width:
                total = power if total is None else (total[: len(power) - done] * BASE + power[done:] if len(power) > done else power[:0])
                if total is not power:
                    total = total ^ (total >> np.uint64(29))
                done += width
            if done == size:
                return splitmix(total[: max(len(codes) - size + 1, 0)])
            power = power[:-width] * (BASE ^ np.uint64(2 * width)) + power[width:] if len(power) > width else power[:0]
            power = power ^ (power >> np.uint64(31))
            width *= 2


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A hash of each run of codes from start to end."""
    up, down = powers.get(len(codes) + 1)
    with np.errstate(over="ignore"):
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * up[:-1], dtype=np.uint64)))
        return splitmix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_hashes(grams: np.ndarray, size: int, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A hash of each text from start to end, by the hashes of its grams of ``size`` symbols.

    Sums of powers over the symbols themselves are equal for some texts of 500 and more symbols that
    differ by the Thue-Morse sequence of two of them. Gram hashes are not linear in the symbols.
    """
    return span_hashes(grams, starts, ends - size + 1, powers)


def owners(grams: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` grams, the leftmost place with the smallest high bits."""
    best = (grams >> np.uint64(31) << np.uint64(31)) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span < width:
        step = min(span, width - span)
        best = np.minimum(best[:-step], best[step:]) if len(best) > step else best[:0]
        span += step
    return (best & np.uint64((1 << 31) - 1)).astype(np.int64)


def find(codes: np.ndarray, firsts: np.ndarray, window: int, gram: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(row, place in the row, nearest, farthest start before the place, key, span) of the anchors of some rows."""
    if len(codes) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    grams = gram_hashes(codes, gram)
    owner = owners(grams, window - gram + 1)
    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    valid = row[: len(owner)] == row[window - 1 :]
    change = np.ones(len(owner) + 1, bool)
    change[1:-1] = (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1]) | (row[1 : len(owner)] != row[: len(owner) - 1])
    cuts = np.flatnonzero(change)
    first, last = cuts[:-1], cuts[1:] - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    at, of = owner[first], row[first]
    return of, at - firsts[of], at - last, at - first, grams[at], text_hashes(grams, gram, first, last + window, powers)


def ordered(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``_row, ord, doc_id, text``: ``ord`` is a long that orders rows by id, null ids last, then by ``_row``.

    Whole ids in range that do not repeat are their own order. Others are ranked, which takes
    one more shuffle of the texts; rows are stored with their numbers before anything is joined
    by them.
    """
    kind = docs.schema[id_col].dataType.typeName()
    rows = numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if kind in ("byte", "short", "integer", "long"):
        odd = F.col("doc_id").isNull() | (F.col("doc_id") < 0) | (F.col("doc_id") >= 1 << ORDER_BITS) | (F.col("n") > 1)
        if rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(odd).isEmpty():
            return rows.select("_row", F.col("doc_id").cast("long").alias("ord"), "doc_id", "text")
    rows = stored(rows, "numbered")
    by = [F.col("doc_id").asc_nulls_last(), F.col("_row")]
    ranked = rows.select("_row", "doc_id").repartitionByRange(*by).sortWithinPartitions(*by).withColumn("m", F.monotonically_increasing_id())
    ranked = stored(ranked.select("_row", F.shiftright("m", 33).alias("part"), F.col("m").bitwiseAND((1 << 33) - 1).alias("k")), "ranks")
    sizes = ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition of the sort
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.part") < F.col("a.part"), "left").groupBy("a.part").agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    ranked = ranked.join(F.broadcast(before), "part").select("_row", (F.col("before") + F.col("k")).alias("ord"))
    return stored(rows.join(ranked, "_row").select("_row", "ord", "doc_id", "text"), "ranked")


ANCHOR_DDL = "key long, near int, far int, span long, place long"


def _anchors(rows: DataFrame, by_words: bool, window: int, gram: int) -> DataFrame:
    schema, arrow = schemas(ANCHOR_DDL)

    def run(batches):
        powers = Powers()
        for batch in batches:
            order = batch.column("ord").to_numpy()
            for first, last, data, offsets in slices(batch.column("text")):
                codes, firsts, _, _ = symbols(data, offsets, by_words)
                if (np.diff(firsts) >> PLACE_BITS).any():
                    raise ValueError(f"a text has over 2^{PLACE_BITS} symbols")
                of, at, near, far, key, span = find(codes, firsts, window, gram, powers)
                place = (order[first:last][of] << PLACE_BITS) + at
                columns = [key.view(np.int64), near.astype(np.int32), far.astype(np.int32), span.view(np.int64), place]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    return rows.select("ord", "text").mapInArrow(run, schema)


def _split(segments: DataFrame, by_words: bool, window: int, gram: int, width: int) -> DataFrame:
    """Anchors with bodies for ranges of ``width`` distances; keys are of the text that a range's windows share."""
    schema, arrow = schemas(ANCHOR_DDL + ", body binary")
    size = min(gram, window - width + 1)

    def run(batches):
        powers = Powers()
        for batch in batches:
            near, far = (batch.column(c).to_numpy().astype(np.int64) for c in ("near", "far"))
            place = batch.column("place").to_numpy()
            for first, last, data, offsets in slices(batch.column("body"), CHUNK_BYTES):
                codes, firsts, starts, ends = symbols(data, offsets, by_words)
                low, high = near[first:last], far[first:last]
                parts = high // width - low // width + 1
                of = np.repeat(np.arange(last - first), parts)
                cell = ragged(low // width, parts)
                a, b = np.maximum(cell * width, low[of]), np.minimum(cell * width + width - 1, high[of])
                # A window at distance d starts at symbol (far - d) of its segment.
                base = firsts[:-1][of] + high[of]
                grams = gram_hashes(codes, size)
                span = text_hashes(grams, size, base - b, base - a + window, powers)
                common = text_hashes(grams, size, base - cell * width, base - (cell * width + width - 1) + window, powers) if width > 1 else span
                key = splitmix(common ^ splitmix(cell.astype(np.uint64) * np.uint64(64) + np.uint64(width)))
                raw = data.tobytes()
                bodies = [raw[x:y] for x, y in zip(starts[base - b].tolist(), ends[base - a + window - 1].tolist())]
                columns = [key.view(np.int64), a.astype(np.int32), b.astype(np.int32), span.view(np.int64), place[first:last][of]]
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(bodies, pa.binary())], schema=arrow)

    return segments.select("near", "far", "place", "body").mapInArrow(run, schema)


def _segments(classes: DataFrame, rows: DataFrame, by_words: bool, window: int) -> DataFrame:
    """The classes with the text of their first member."""
    schema, arrow = schemas("key long, near int, far int, place long, n long, body binary")
    wanted = classes.groupBy(F.shiftright("place", PLACE_BITS).alias("ord")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("place").bitwiseAND((1 << PLACE_BITS) - 1).alias("at"), "key", "near", "far", "n"))).alias("wanted")
    )
    joined = rows.select("ord", "text").join(wanted, "ord")

    def run(batches):
        for batch in batches:
            order, lists = batch.column("ord").to_numpy(), batch.column("wanted")
            for first, last, data, offsets in slices(batch.column("text")):
                _, firsts, starts, ends = symbols(data, offsets, by_words)
                some = lists[first:last]
                flat = some.flatten()
                of = np.repeat(np.arange(last - first), np.diff(some.offsets.to_numpy()))
                at, near, far = (flat.field(c).to_numpy().astype(np.int64) for c in ("at", "near", "far"))
                base = firsts[:-1][of] + at
                raw = data.tobytes()
                bodies = [raw[a:b] for a, b in zip(starts[base - far].tolist(), ends[base - near + window - 1].tolist())]
                place = (order[first:last][of] << PLACE_BITS) + at
                yield pa.RecordBatch.from_arrays([flat.field("key"), flat.field("near"), flat.field("far"), pa.array(place), flat.field("n"), pa.array(bodies, pa.binary())], schema=arrow)

    return joined.mapInArrow(run, schema)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole keys, about ``CHUNK_BYTES`` of bodies each, out of batches sorted by key."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        at = 0
        while at < len(table):
            step = table.slice(at, 2048)
            at += len(step)
            held.append(step)
            size += step.column("body").nbytes
            if size >= CHUNK_BYTES:
                whole = pa.concat_tables(held).combine_chunks()
                keys = whole.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield whole.slice(0, cut)
                held, size = [whole.slice(cut)], whole.slice(cut).column("body").nbytes
    if held and sum(map(len, held)):
        yield pa.concat_tables(held).combine_chunks()


Method = Callable[[pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]]


def repeated_windows(rows: DataFrame, by_words: bool, window: int, gram: int, method: Callable[[], Method], earlier_only: bool, crowd: int) -> DataFrame:
    """``ord, first, last``: ranges of window starts whose windows repeat; ranges may overlap.

    With ``earlier_only`` the first occurrence of a window is not reported. ``method()`` makes,
    in each task, a function from a table of segments (whole keys, ordered by place) to
    (segment, nearest, farthest distance) of repeated windows.
    """
    anchors = _anchors(rows, by_words, window, gram)
    # Stored first: a plain join of two inputs is one whose hot keys adaptive execution splits.
    many = stored(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "keys")
    live = stored(anchors.join(many, "key", "left_semi"), "anchors")
    found, width = [], window
    segments = None
    while True:
        classes = live.groupBy("key", "near", "far", "span").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
        classes = stored(classes, "classes")
        same = live.join(classes.where("n > 1"), ["key", "near", "far", "span"])
        same = same.where("place <> first") if earlier_only else same
        found.append(stored(same.select("place", "near", "far"), "copies"))
        several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
        several = stored(several, "several")
        open_ = classes.join(several.select("key"), "key", "left_semi").withColumnRenamed("first", "place")
        if segments is None:
            segments = stored(_segments(open_.drop("span"), rows, by_words, window), "segments")
        else:
            bodies = live.select("key", "near", "far", "place", "body")
            segments = stored(open_.drop("span").join(bodies, ["key", "near", "far", "place"]), "segments")
        crowded = several.where(F.col("classes") > crowd).select("key")
        is_crowded = not crowded.isEmpty()
        few = segments.join(crowded, "key", "left_anti") if is_crowded else segments
        found.append(stored(_compared(few, method), "compared"))
        if not is_crowded:
            break
        width = 1 << max((width - 1).bit_length() - SPLIT.bit_length() + 1, 0)
        parts = stored(_split(segments.join(crowded, "key", "left_semi"), by_words, window, gram, width), "parts")
        many = stored(parts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "keys")
        live = stored(parts.join(many, "key", "left_semi"), "anchors")
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    at = F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)
    return all_found.select(F.shiftright("place", PLACE_BITS).alias("ord"), (at - F.col("far")).alias("first"), (at - F.col("near")).alias("last"))


def _compared(segments: DataFrame, method: Callable[[], Method]) -> DataFrame:
    schema, arrow = schemas("place long, near int, far int")

    def run(batches):
        compare = method()
        for table in _grouped(batches):
            at, near, far = compare(table)
            place = table.column("place").to_numpy()[at]
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(near.astype(np.int32)), pa.array(far.astype(np.int32))], schema=arrow)

    return segments.repartition("key").sortWithinPartitions("key", "place").mapInArrow(run, schema)


def removed(rows: DataFrame, ranges: DataFrame, by_words: bool, window: int) -> DataFrame:
    """``_row, doc_id, n_symbols, n_removed, n_spans, kept``: what is left of each text.

    ``kept`` is binary: the remaining bytes, or the remaining words joined by one space.
    """
    per_row = ranges.groupBy("ord").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    joined = rows.join(per_row, "ord", "left")
    schema, arrow = schemas(f"_row long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_symbols long, n_removed long, n_spans long, kept binary")

    def run(batches):
        for batch in batches:
            lists = batch.column("ranges")
            for first, last, data, offsets in slices(batch.column("text")):
                _, firsts, starts, ends = symbols(data, offsets, by_words)
                raw, n, gone, spans, kept = data.tobytes(), [], [], [], []
                for k in range(last - first):
                    a, b = int(firsts[k]), int(firsts[k + 1])
                    hit = np.zeros(b - a + 1, np.int32)
                    some = lists[first + k]
                    if some.is_valid:
                        pairs = some.values
                        np.add.at(hit, pairs.field("first").to_numpy(), 1)
                        np.add.at(hit, pairs.field("last").to_numpy() + window, -1)
                    out = np.cumsum(hit[:-1]) > 0
                    n.append(b - a)
                    gone.append(int(out.sum()))
                    spans.append(int((out & ~np.concatenate((np.zeros(min(1, len(out)), bool), out[:-1]))).sum()))
                    stay = np.flatnonzero(~out) + a
                    if by_words:
                        kept.append(b" ".join([raw[x:y] for x, y in zip(starts[stay].tolist(), ends[stay].tolist())]))
                    else:
                        kept.append(data[stay].tobytes() if len(stay) < b - a else raw[int(offsets[k]) : int(offsets[k + 1])])
                columns = [pa.array(x, pa.int64()) for x in (n, gone, spans)]
                yield pa.RecordBatch.from_arrays([batch.column("_row")[first:last], batch.column("doc_id")[first:last], *columns, pa.array(kept, pa.binary())], schema=arrow)

    return joined.select("_row", "doc_id", "text", "ranges").mapInArrow(run, schema)
