"""Benchmark decontamination with an FM-index for each shard of the training texts.

Test phrases are windows of ten consecutive words of a benchmark item (a shorter item is one
window). A shard is a bounded amount of text of one task. Words that no phrase has cannot be in
an occurrence, so the shard's index holds only runs of phrase words, as numbers, long enough for
the shortest phrase. The index is the Burrows-Wheeler transform of that sequence in a wavelet
matrix. All phrases are searched backward together, a word per step, by ranks; occurrences are
located by walking to sampled suffix positions; their spans are merged per document.

Nothing is shuffled. Phrases go to the tasks in blocks of bounded size; a benchmark of more
blocks is one more pass over the texts for each. With one block, spans are cut out in the pass
that finds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import free_name, known_rows, numbered, schemas, stored
from quillmark.llm.words import byte_table, ragged, runs, slices, word_codes, word_spans

WINDOW, SHARD_BYTES, SAMPLING, PHRASE_BYTES = 10, 24 << 20, 8, 8 << 20
FIELDS = ("first_word", "end_word", "start", "stop")
SPANS = "array<struct<first_word: long, end_word: long, start: long, stop: long>>"
# Separators are the ASCII characters that are neither letters nor digits.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


class Phrases:
    """Distinct windows of some items: a matrix of word numbers, their lengths and their items."""

    FIELDS = ("names", "vocabulary", "lengths", "words", "item_counts", "item_list", "item_starts", "shortest")

    def parts(self) -> dict:
        """Plain data for a broadcast, which carries no classes to executors without this package."""
        return {f: getattr(self, f) for f in self.FIELDS}

    @classmethod
    def of(cls, parts: dict) -> Phrases:
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        table = byte_table(SEPARATORS, lower=True)
        codes = []
        for _, text in items:
            data = np.frombuffer(text.encode(), np.uint8)
            mapped, starts, ends, _ = word_spans(data, np.array([0, len(data)]), table)
            codes.append(word_codes(mapped, starts, ends))
        self.names = sorted({name for name, _ in items})
        of_name = {name: k for k, name in enumerate(self.names)}
        self.vocabulary = np.unique(np.concatenate([*codes, np.zeros(0, np.uint64)]))
        seen: dict[tuple, set[int]] = {}
        for (name, _), words in zip(items, codes):
            item = of_name[name]
            numbers = (np.searchsorted(self.vocabulary, words) + 1).tolist()
            for at in range(max(len(numbers) - window + 1, min(len(numbers), 1))):
                seen.setdefault(tuple(numbers[at : at + window]), set()).add(item)
        self.lengths = np.array([len(p) for p in seen], np.int64)
        self.words = np.zeros((len(seen), window), np.int64)
        for row, phrase in enumerate(seen):
            self.words[row, : len(phrase)] = phrase
        of = [sorted(s) for s in seen.values()]
        self.item_counts = np.array([len(s) for s in of], np.int64)
        self.item_list = np.array([x for s in of for x in s], np.int64)
        self.item_starts = np.cumsum(self.item_counts) - self.item_counts
        self.shortest = int(self.lengths.min()) if len(seen) else 0


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling; separators (0) are told apart by their places."""
    n = len(text)
    zeros = text == 0
    rank = text + int(zeros.sum())
    rank[zeros] = np.arange(int(zeros.sum()))
    width = 1
    while True:
        ahead = np.full(n, -1, np.int64)
        if width < n:
            ahead[:-width] = rank[width:]
        key = rank * (n + int(text.max()) + 2) + ahead + 1
        order = np.argsort(key, kind="stable")
        fresh = np.cumsum(np.concatenate(([0], np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2


class Wavelet:
    """Wavelet matrix: bits of the numbers, highest first, zeros before ones from level to level."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int64))))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate((values[~bit], values[bit]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before each place."""
        low, high = np.zeros_like(at), at
        for k in range(self.depth):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            a, b = self.ones[k][low], self.ones[k][high]
            low, high = np.where(one, self.zeros[k] + a, low - a), np.where(one, self.zeros[k] + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before."""
        symbol, place = np.zeros_like(at), at
        for k in range(self.depth):
            one = self.ones[k][place + 1] > self.ones[k][place]
            symbol = symbol << 1 | one
            place = np.where(one, self.zeros[k] + self.ones[k][place], place - self.ones[k][place])
        return symbol, self.rank(symbol, at)


class Index:
    """FM-index of a sequence of numbers; 0 separates."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        self.n = len(text)
        self.bwt = Wavelet(text[order - 1], symbols)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))
        # Separators are ordered by their places, which ranks cannot follow: walks end there as well.
        kept = (order % SAMPLING == 0) | (text[order - 1] == 0)
        self.sampled, self.sample_rank, self.samples = kept, np.cumsum(kept) - 1, order[kept]

    def search(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each phrase, all phrases together, from the last word back."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.n, np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > step) & (low < high))
            symbol = words[live, lengths[live] - 1 - step]
            first = self.before[symbol]
            low[live], high[live] = first + self.bwt.rank(symbol, low[live]), first + self.bwt.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in some rows."""
        place, row, walked, open_ = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(open_):
            known = self.sampled[row]
            place[open_[known]] = self.samples[self.sample_rank[row[known]]] + walked
            open_, row = open_[~known], row[~known]
            symbol, rank = self.bwt.access(row)
            row = self.before[symbol] + rank
            walked += 1
        return place


class Shard:
    """Words of some documents that phrases have, gathered until the shard is full."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.table = phrases, byte_table(SEPARATORS, lower=True)
        self.clear()

    def clear(self) -> None:
        self.text, self.doc, self.word, self.start, self.end, self.counts, self.bytes = [], [], [], [], [], [], 0

    def add(self, texts: pa.Array) -> None:
        known = self.phrases.vocabulary
        base = sum(map(len, self.counts))
        for first, last, data, offsets in slices(texts):
            mapped, starts, ends, firsts = word_spans(data, offsets, self.table)
            counts = np.diff(firsts)
            self.counts.append(counts)
            self.bytes += len(data)
            if not self.phrases.shortest or not len(starts):
                continue
            codes = word_codes(mapped, starts, ends)
            number = np.searchsorted(known, codes)
            number[number == len(known)] = 0
            number = np.where(known[number] == codes, number + 1, 0)
            doc = np.repeat(np.arange(last - first), counts)
            # A run never crosses documents: a gap is put before each document.
            gap = np.searchsorted(doc, np.arange(1, last - first))
            spread = np.insert(number, gap, 0)
            place = np.insert(np.arange(len(number)), gap, -1)
            a, b = runs(spread > 0)
            long = b - a >= self.phrases.shortest
            a, b = a[long], b[long]
            picked = place[ragged(a, b - a)]
            ends_at = np.cumsum(b - a)
            self.text.append(np.insert(number[picked], ends_at, 0))
            self.doc.append(np.insert(doc[picked] + base + first, ends_at, -1))
            self.word.append(np.insert(picked - firsts[doc[picked]], ends_at, -1))
            rows = offsets[:-1][doc[picked]]
            self.start.append(np.insert(starts[picked] - rows, ends_at, 0))
            self.end.append(np.insert(ends[picked] - rows, ends_at, 0))

    def result(self) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]], dict[int, list[tuple]]]:
        """Words and hit words per document, items per document, merged byte spans per document."""
        n_words = np.concatenate([*self.counts, np.zeros(0, np.int64)])
        hits, items, spans = np.zeros(len(n_words), np.int64), {}, {}
        text = np.concatenate([np.zeros(1, np.int64), *self.text])
        if len(text) > 1:
            doc, word, start, end = (np.concatenate([np.full(1, -1), *x]) for x in (self.doc, self.word, self.start, self.end))
            p = self.phrases
            index = Index(text, len(p.vocabulary) + 1)
            low, high = index.search(p.words, p.lengths)
            sizes = np.maximum(high - low, 0)
            phrase = np.repeat(np.arange(len(sizes)), sizes)
            place = index.locate(ragged(low, sizes))
            change = np.zeros(len(text) + 1, np.int64)
            np.add.at(change, place, 1)
            np.add.at(change, place + p.lengths[phrase], -1)
            hit = np.cumsum(change[:-1]) > 0
            hits += np.bincount(doc[hit], minlength=len(n_words))
            for a, b in zip(*runs(hit)):
                spans.setdefault(int(doc[a]), []).append((int(word[a]), int(word[b - 1]) + 1, int(start[a]), int(end[b - 1])))
            many = p.item_counts[phrase]
            pairs = np.unique(np.repeat(doc[place], many) * len(p.names) + p.item_list[ragged(p.item_starts[phrase], many)])
            for d, i in zip((pairs // len(p.names)).tolist(), (pairs % len(p.names)).tolist()):
                items.setdefault(d, []).append(i)
        return n_words, hits, items, spans


class Blocks:
    """Benchmark items in blocks of bounded size; null ids and texts have no words to give.

    An item lies in the blocks of its texts, so an id with a third of all texts is dealt out, too.
    """

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, limit: int):
        rows = benchmark.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
        self.rows = rows.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).distinct()
        size = self.rows.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
        self.count = max(1, -(-int(size) // limit))

    def __iter__(self) -> Iterator[list[tuple[str, str]]]:
        """One block on the driver at a time."""
        for k in range(self.count):
            part = self.rows if self.count == 1 else self.rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(self.count)) == k)
            yield sorted((r["id"], r["text"]) for r in part.collect())


def find_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", phrase_bytes: int = PHRASE_BYTES, row_col: str | None = None) -> DataFrame:
    """``_row, doc_id, n_words, n_hit, items, spans`` for each row of ``docs``.

    ``items`` are the ids (as strings, sorted) of items with a window in the text, ``spans`` the
    merged spans of hit words, in words and in UTF-8 bytes. A null or empty text has no words; items
    without words or without an id match nothing; repeated items and rows count each for
    themselves; an empty benchmark gives no hits, an empty table no rows. Other columns are not
    read.
    """
    blocks = Blocks(benchmark, item_col, item_text_col, phrase_bytes)
    narrow = numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_col=row_col)
    if blocks.count > 1 and not row_col:
        narrow = stored(narrow, "numbered")  # the blocks' findings meet by number
    kinds = {c: narrow.schema[c].dataType.simpleString() for c in ("_row", "doc_id")}
    schema, arrow = schemas(f"_row {kinds['_row']}, doc_id {kinds['doc_id']}, n_words long, n_hit long, items array<string>, spans {SPANS}")
    found, passes = None, 0
    for block in blocks:
        shipped = docs.sparkSession.sparkContext.broadcast(Phrases(block).parts())

        def search(batches, shipped=shipped):
            phrases = Phrases.of(shipped.value)
            shard, held = Shard(phrases), []

            def flush():
                n_words, hits, items, spans = shard.result()
                at = 0
                for ids, rows in held:
                    k = range(at, at + len(ids))
                    at += len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [rows, ids, pa.array(n_words[k.start : k.stop]), pa.array(hits[k.start : k.stop]),
                         pa.array([[phrases.names[i] for i in items.get(d, ())] for d in k], arrow.field("items").type),
                         pa.array([[dict(zip(FIELDS, x)) for x in spans.get(d, ())] for d in k], arrow.field("spans").type)],
                        schema=arrow,
                    )
                shard.clear()
                held.clear()

            for batch in batches:
                shard.add(batch.column("text"))
                held.append((batch.column("doc_id"), batch.column("_row")))
                if shard.bytes >= SHARD_BYTES:
                    yield from flush()
            yield from flush()

        part = narrow.mapInArrow(search, schema)
        found, passes = (found.unionByName(part) if passes else part), passes + 1
    return found if passes == 1 else _merged(stored(found, "passages"))


def _merged(found: DataFrame) -> DataFrame:
    """One row per document out of one for each phrase block: items united, spans merged."""
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    rows = found.groupBy("_row", "doc_id", "n_words").agg(items.alias("items"), spans.alias("spans"))

    def add(done, x):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(
            last["first_word"].alias("first_word"), F.greatest(last["end_word"], x["end_word"]).alias("end_word"),
            last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"),
        )
        head = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(last["end_word"] >= x["first_word"], F.concat(head, F.array(joined))).otherwise(F.concat(done, F.array(x)))

    rows = rows.withColumn("spans", F.aggregate("spans", F.array().cast(SPANS), add))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end_word"] - x["first_word"])
    return rows.select("_row", "doc_id", "n_words", hit.alias("n_hit"), "items", "spans")


def with_digest(found: DataFrame) -> DataFrame:
    """Items as count and digest, a flag for any hit."""
    return found.select(
        "_row", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut(raw: bytes, spans: list[tuple]) -> bytes:
    """The bytes outside the spans."""
    ends = [0, *(stop for _, _, _, stop in spans)]
    starts = [*(start for _, _, start, _ in spans), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, starts))


def _cut_in_tasks(docs: DataFrame, phrases: Phrases, text_col: str) -> DataFrame:
    """The documents with the spans cut out where they are found."""
    shipped = docs.sparkSession.sparkContext.broadcast(phrases.parts())
    schema = docs.schema

    def run(batches):
        shard, held = Shard(Phrases.of(shipped.value)), []

        def flush():
            spans, at = shard.result()[3], 0
            for batch in held:
                hit = {d - at: spans[d] for d in range(at, at + len(batch)) if d in spans}
                at += len(batch)
                if hit:
                    k = batch.schema.get_field_index(text_col)
                    texts = batch.column(k)
                    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
                    raw = texts.view(kind)  # a text may have bytes that are not UTF-8
                    new = [_cut(raw[i].as_py(), hit[i]) if i in hit else None for i in range(len(batch))]
                    mask = pa.array([i in hit for i in range(len(batch))])
                    columns = list(batch.columns)
                    columns[k] = pc.if_else(mask, pa.array(new, kind), raw).view(texts.type)
                    batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                yield batch
            shard.clear()
            held.clear()

        for batch in batches:
            shard.add(batch.column(batch.schema.get_field_index(text_col)))
            held.append(batch)
            if shard.bytes >= SHARD_BYTES:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, schema)


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", phrase_bytes: int = PHRASE_BYTES) -> DataFrame:
    """The documents, all columns, without the bytes of merged hit spans.

    All rows stay: null, empty and clean texts unchanged, a text that is all hit as an empty one.
    Other columns may have any names and values.
    """
    columns = docs.columns
    blocks = Blocks(benchmark, item_col, item_text_col, phrase_bytes)
    if blocks.count == 1:
        return _cut_in_tasks(docs, Phrases(next(iter(blocks))), text_col)
    docs, at = known_rows(docs, id_col)
    found = stored(find_passages(docs, benchmark, text_col, id_col, item_col, item_text_col, phrase_bytes, at).where("n_hit > 0").select("_row", "spans"), "spans")
    hit_row, hit = (free_name(docs, c) for c in ("_hit_row", "_hit_spans"))
    found = found.select(F.col("_row").alias(hit_row), F.col("spans").alias(hit))
    rows = docs.join(found, F.col(f"`{at}`") == F.col(hit_row), "left")
    raw, spans = F.col(text_col).cast("binary"), F.col(hit)
    # The parts between spans: from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0).cast("long")), spans["stop"])
    stops = F.concat(spans["start"], F.array(F.octet_length(text_col).cast("long")))
    parts = F.zip_with(starts, stops, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    text = F.when(spans.isNull(), F.col(text_col)).otherwise(F.array_join(parts, ""))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns])
