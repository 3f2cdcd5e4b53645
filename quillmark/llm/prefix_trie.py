"""Prefix trie of conversations out of padded turn-id matrices.

Distinct turns get integer numbers, so a conversation is a row of numbers. Rows are dealt to
range shards by (numbers, id), which splits a crowd of equal conversations as well, and
come to a task in order. There a block of rows is one matrix, padded with -1: a lexsort settles
its order, the OR-accumulated masks of changed columns say how long a row's common prefix
with the row before is, and ``reduceat`` over the starts of nodes aggregates each depth.

All figures of a node are sums over its rows, once a row knows its common prefix with its
neighbours. A node within a block is complete. Nodes that hold the first or last row of a
block may go on in the next one: they are partial rows, keyed by a digest of their prefix, that
are summed afterwards. What a shard's first and last rows contribute depends on the
neighbouring shards and is added from a table of the shards' border rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import schemas, stored
from quillmark.llm.words import ragged

CELLS, FAMILY, BROADCAST_NODES, BATCH_NODES = 1 << 22, 20, 100_000, 1 << 16
INNER, PARTIAL, ENDS, BORDER = range(4)
FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
DDL = "kind int, key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, at long, ids array<long>, words array<int>"
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, ids, words``: per conversation the numbers of its turns in order and their word counts.

    Equal (role, text) have equal numbers, null counts as empty. Turns are in order of
    ``turn``, null first, turns of one number in order of their digests. Rows without a
    conversation's id belong to none. Texts are not shuffled, only their digests.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, F.lit(":"), text), 256))
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")
    )
    rows = stored(rows, "turns")
    distinct = stored(rows.select("digest").distinct(), "distinct-turns")
    names = stored(distinct.repartitionByRange("digest").sortWithinPartitions("digest").withColumn("name", F.monotonically_increasing_id()), "turn-names")
    named = rows.join(names, "digest")
    turns = F.sort_array(F.collect_list(F.struct("turn", "name", "words"))).alias("turns")
    return named.groupBy("conv_id").agg(turns).select("conv_id", F.col("turns.name").alias("ids"), F.col("turns.words").alias("words"))


def rebuilt(rows: DataFrame, family: int = FAMILY) -> DataFrame:
    """The conversations with their first h turns taken from the first of their family, h by CRC-32 of the id."""
    rows = stored(rows, "conversations")
    first = F.col("conv_id") - F.col("conv_id") % family
    heads = rows.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("head"), F.slice("ids", 1, 3).alias("head_ids"), F.slice("words", 1, 3).alias("head_words"))
    joined = rows.withColumn("head", first).join(heads, "head", "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")

    def new(column: str, kind: str):
        head = F.coalesce(F.slice(f"head_{column}", F.lit(1), h), F.array().cast(kind))
        return F.concat(head, F.slice(column, h + 1, F.size(column))).alias(column)

    return joined.select("conv_id", new("ids", "array<long>"), new("words", "array<int>"))


def prefix_keys(ids: np.ndarray) -> list[bytes]:
    """A digest for each prefix, from the empty one on."""
    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    for x in ids.astype("<i8"):
        state.update(x.tobytes())
        keys.append(state.copy().digest())
    return keys


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _rows(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the schema; absent columns are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _cuts(lengths: np.ndarray, cells: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose padded matrices have at most so many cells; a longer row comes alone."""
    first = 0
    while first < len(lengths):
        widest = np.maximum.accumulate(lengths[first:]) + 1
        fits = int(np.searchsorted(widest * np.arange(1, len(widest) + 1), cells, "right"))
        yield first, first + max(1, fits)
        first += max(1, fits)


def _padded(flat: np.ndarray, lengths: np.ndarray, width: int, pad: int) -> np.ndarray:
    out = np.full((len(lengths), width), pad, np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), ragged(np.zeros(len(lengths), np.int64), lengths)] = flat
    return out


def block_nodes(conv: np.ndarray, matrix: np.ndarray, words: np.ndarray, lengths: np.ndarray, before: int, at: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Nodes of a block of rows in order, depth by depth, complete or partial.

    ``before`` is the common prefix of the first row with the row before the block, -1 if that
    is not known: then what the first row adds by it is left out, as always what the last row
    adds by the row after it.

    Between two depths at which a row ends or leaves the row before, each depth has the same
    nodes; only their keys and saved words differ. Such stretches are written as one, so a very
    long conversation costs no round for each of its turns.
    """
    n_rows, width = matrix.shape
    changed = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
    common = np.empty(n_rows, np.int64)
    common[0] = before
    common[1:] = np.minimum(width - changed.sum(axis=1), np.minimum(lengths[1:], lengths[:-1]))
    leaf = np.append(common[1:] < lengths[:-1], False)
    sums = np.concatenate((np.zeros((n_rows, 1), np.int64), np.cumsum(words, axis=1)), axis=1)
    shared = np.where(common > 0, sums[np.arange(n_rows), np.maximum(common, 0)], 0)
    known = np.ones(n_rows, bool)
    known[0] = before >= 0
    first_keys, last_keys = prefix_keys(matrix[0, : lengths[0]]), prefix_keys(matrix[-1, : lengths[-1]])
    above_of, above_conv, above_key = None, None, None
    turning = np.unique(np.concatenate((lengths, common[common >= 0], [0])))
    depths = np.unique(np.concatenate((turning, turning + 1)))
    for depth, following in zip(depths.tolist(), [*depths[1:].tolist(), width + 1]):
        rows = np.flatnonzero(lengths >= depth)
        if not len(rows):
            return
        start = common[rows] < depth if depth else np.zeros(len(rows), bool)
        start[0] = True
        cut = np.flatnonzero(start)
        least = np.minimum.reduceat(conv[rows], cut)
        children = np.add.reduceat(((lengths[rows] > depth) & (common[rows] <= depth) & known[rows]).astype(np.int64), cut)
        leaves = np.add.reduceat(leaf[rows].astype(np.int64), cut)
        inside = sums[rows, depth - 1] if depth else 0
        saved = np.add.reduceat(np.where(common[rows] >= depth, shared[rows] - inside, 0), cut)
        ended = np.add.reduceat((lengths[rows] == depth).astype(np.int64), cut)
        count = np.diff(np.append(cut, len(rows)))
        paths: list = [None] * len(cut)
        if depth <= lengths[0]:
            paths[0] = first_keys
        if depth <= lengths[-1]:
            paths[-1] = last_keys
        keys = [p and p[depth] for p in paths]
        parent_conv = parent_key = [None] * len(cut)
        if depth:
            above = above_of[rows[cut]]
            parent_key = [above_key[k] for k in above.tolist()]
            parent_conv = [None if k is not None else c for k, c in zip(parent_key, above_conv[above].tolist())]
        # Rows that end in a node are its first ones, in order of their ids.
        texts = [",".join(map(str, conv[rows[a : a + e]].tolist())) if e else "" for a, e in zip(cut.tolist(), ended.tolist())]
        whole = [k is None for k in keys]
        columns = {
            "kind": [INNER if w else PARTIAL for w in whole], "key": keys, "parent": parent_key, "conv_id": least, "depth": np.full(len(cut), depth), "parent_conv_id": parent_conv,
            "n_convs": count, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
            "ends": [(hashlib.sha256(t.encode()).hexdigest() if t else NOTHING) if w else None for w, t in zip(whole, texts)],
        }
        yield _rows(columns, schema)
        open_ends = [(k, t) for k, t in zip(keys, texts) if k is not None and t]
        if open_ends:
            yield _rows({"kind": [ENDS] * len(open_ends), "key": [k for k, _ in open_ends], "ends": [t for _, t in open_ends], "at": [at] * len(open_ends)}, schema)
        above_of = np.zeros(n_rows, np.int64)
        above_of[rows] = np.cumsum(start) - 1
        # The depths up to the next turning one have the same nodes, each the only child of the one above.
        going_on = np.add.reduceat((common[rows] >= depth).astype(np.int64), cut)
        step = max(1, BATCH_NODES // len(cut))
        for a in range(depth + 1, following, step):
            some = np.arange(a, min(a + step, following))
            inner = np.tile(np.array(whole), len(some))
            columns = {
                "kind": np.where(inner, INNER, PARTIAL), "key": [p and p[d] for d in some.tolist() for p in paths], "parent": [p and p[d - 1] for d in some.tolist() for p in paths],
                "conv_id": np.tile(least, len(some)), "depth": np.repeat(some, len(cut)), "parent_conv_id": pa.array(np.tile(least, len(some)), pa.int64(), mask=~inner),
                "n_convs": np.tile(count, len(some)), "n_children": np.tile(children, len(some)), "n_leaves": np.tile(leaves, len(some)),
                "saved_tokens": (saved - going_on * (sums[rows[cut], some[:, None] - 1] - (sums[rows[cut], depth - 1] if depth else 0))).ravel(),
                "ends": [NOTHING if w else None for w in inner.tolist()],
            }
            yield _rows(columns, schema)
        above_conv = least
        above_key = [p and p[following - 1] for p in paths]


def _added(keys: list[bytes], schema: pa.Schema, leaves: int = 0, children=None, saved=None) -> pa.RecordBatch:
    """Partial rows that add figures to the nodes of a path."""
    zero = np.zeros(len(keys), np.int64)
    figures = {"n_convs": zero, "n_children": zero if children is None else children, "n_leaves": zero + leaves, "saved_tokens": zero if saved is None else saved}
    return _rows({"kind": [PARTIAL] * len(keys), "key": keys, **figures}, schema)


def _shards(sequences: DataFrame, cells: int) -> DataFrame:
    """Complete and partial nodes and the border rows of range shards."""
    schema, arrow = schemas(DDL)

    def run(batches):
        from pyspark import TaskContext

        shard, last, block = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column("conv_id").to_numpy()
            ids, counts = batch.column("ids"), batch.column("words")
            offsets = ids.offsets.to_numpy().astype(np.int64)
            flat_ids, flat_words = ids.values.to_numpy(), counts.values.to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.diff(offsets)
            for a, b in _cuts(lengths, cells):
                some, span = lengths[a:b], slice(offsets[a], offsets[b])
                width = int(some.max())
                matrix, words = _padded(flat_ids[span], some, width, -1), _padded(flat_words[span], some, width, 0)
                order = np.lexsort([conv[a:b], *(matrix[:, k] for k in range(width - 1, -1, -1))])
                matrix, words, some, who = matrix[order], words[order], some[order], conv[a:b][order]
                first = matrix[0, : some[0]]
                if last is None:
                    yield _rows({"kind": [BORDER], "at": [2 * shard], "ids": [first], "words": [words[0, : some[0]]]}, arrow)
                    before = -1
                else:
                    before = common_prefix(last, first)
                    if before < len(last):
                        yield _added(prefix_keys(last), arrow, leaves=1)
                yield from block_nodes(who, matrix, words, some, before, (shard << 32) + block, arrow)
                last, block = matrix[-1, : some[-1]].copy(), block + 1
        if last is not None:
            yield _rows({"kind": [BORDER], "at": [2 * shard + 1], "ids": [last], "words": [np.zeros(len(last), np.int64)]}, arrow)

    return sequences.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id").mapInArrow(run, schema)


def _borders(found: DataFrame) -> DataFrame:
    """What border rows add by their neighbours in other shards: two rows a shard, in one task."""
    schema, arrow = schemas(DDL)

    def run(batches):
        last = None
        for batch in batches:
            for at, ids, words in zip(batch.column("at").to_pylist(), batch.column("ids").to_pylist(), batch.column("words").to_pylist()):
                ids = np.array(ids, np.int64)
                if at % 2:
                    last = ids
                    continue
                common = -1 if last is None else common_prefix(last, ids)
                if last is not None and common < len(last):
                    yield _added(prefix_keys(last), arrow, leaves=1)
                depth, sums = np.arange(len(ids) + 1), np.concatenate(([0], np.cumsum(np.array(words, np.int64))))
                children = ((depth < len(ids)) & (common <= depth)).astype(np.int64)
                saved = np.where(depth <= common, sums[max(common, 0)] - sums[np.maximum(depth - 1, 0)], 0)
                yield _added(prefix_keys(ids), arrow, children=children, saved=saved)
        if last is not None:
            yield _added(prefix_keys(last), arrow, leaves=1)

    rows = found.where(F.col("kind") == BORDER).select("at", "ids", "words")
    return rows.repartition(1).sortWithinPartitions("at").mapInArrow(run, schema)


def _digests(found: DataFrame) -> DataFrame:
    """``key, ends``: the digest of the ids that end in a partial node, fed piece by piece in order."""
    schema, arrow = schemas("key binary, ends string")

    def run(batches):
        key, state = None, None
        for batch in batches:
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        yield _rows({"key": [key], "ends": [state.hexdigest()]}, arrow)
                    key, state = k, hashlib.sha256()
                state.update(text.encode())
        if key is not None:
            yield _rows({"key": [key], "ends": [state.hexdigest()]}, arrow)

    rows = found.where(F.col("kind") == ENDS).select("key", "at", "ends")
    return rows.repartition("key").sortWithinPartitions("key", "at").select("key", "ends").mapInArrow(run, schema)


def trie(sequences: DataFrame, cells: int = CELLS, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` for each node.

    ``sequences`` has ``conv_id, ids, words`` with one row for each conversation, which may be
    without turns; a conversation's numbers are one row. A node is a distinct prefix, the
    root the empty one; ``conv_id`` is its smallest member. An empty table has no node.
    """
    found = stored(_shards(stored(sequences, "sequences"), cells), "trie-shards")
    partial = found.where(F.col("kind") == PARTIAL).unionByName(_borders(found))
    sums = [F.sum(c).alias(c) for c in FIGURES]
    open_ = partial.groupBy("key").agg(F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums)
    open_ = stored(open_.join(_digests(found), "key", "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING))), "open-nodes")
    inner = found.where(F.col("kind") == INNER)
    parents = open_.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    parents = F.broadcast(parents) if open_.count() <= broadcast_nodes else parents
    columns = ["parent", "conv_id", "depth", *FIGURES, "ends"]
    below = inner.where("parent is not null").select(*columns).unionByName(open_.select(*columns)).join(parents, "parent", "left")
    names = ["conv_id", "depth", "parent_conv_id", *FIGURES, "ends"]
    return inner.where("parent is null").select(*names).unionByName(below.select(*names)).withColumnRenamed("ends", "ends_sha256")


def conversation_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """The trie of the conversations as they are; see ``turn_rows`` and ``trie``. Other columns are not read."""
    return trie(turn_rows(conversations, id_col, turn_col, role_col, text_col), cells)
