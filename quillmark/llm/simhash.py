"""SimHash fingerprints, linked by multi-index hashing.

Equal fingerprints are one class, so only distinct fingerprints are searched. With two segments
of 32 bits, fingerprints that differ in two bits at most have equal high segments or low
segments that differ in one bit at most. So each fingerprint probes the table of high segments
with its own value and the table of low segments with the ball of radius one around its value;
the complete distance is verified inside the join, which emits links only.

A segment shared by more than ``bucket`` distinct fingerprints would make its task compare them
all with each other. Those fingerprints look up every value of the complete ball around
them instead, which is exact as well and grows with their number only.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import known_rows, numbered, only_rows, schemas, stored

SHINGLE, SEED, BUCKET = 3, 42, 16_384


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words in order, repeats included; a shorter text is one run."""
    words = text.lower().split()  # of bytes: A-Z only; blanks are space and 09-0D
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    of, seed = xxhash.xxh64_intdigest, SEED
    return np.array([of(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """64 bits, signed; a bit is set if it is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        some = hashes[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.uint32)
    bits = np.packbits(counts * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = SHINGLE, row_col: str | None = None) -> DataFrame:
    """``_row, doc_id, fingerprint`` (a long) for each row; no words, fingerprint 0."""
    narrow = numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), row_col=row_col)
    schema, arrow = schemas(f"_row {narrow.schema['_row'].dataType.simpleString()}, doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fingerprint long")

    def make(batches):
        for batch in batches:
            texts = batch.column("text")
            found = [fingerprint(shingle_hashes(t.as_py() or b"", width)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), pa.array(found, pa.int64())], schema=arrow)

    return narrow.mapInArrow(make, schema)


def _balls(radius: int, bits: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fingerprint``) that differ in one or two bits; pairs may repeat."""
    low_mask = (1 << 32) - 1
    f = F.col("fingerprint")
    table = distinct.select(
        f, F.explode(F.array(
            F.struct(F.lit(0).alias("part"), F.shiftrightunsigned(f, 32).alias("segment")),
            F.struct(F.lit(1).alias("part"), f.bitwiseAND(low_mask).alias("segment")),
        )).alias("s"),
    ).select("fingerprint", "s.part", "s.segment")
    sizes = table.groupBy("part", "segment").agg(F.count(F.lit(1)).alias("n"))
    crowded = stored(sizes.where(F.col("n") > bucket), "crowded-segments")
    hot = distinct.limit(0)
    if not crowded.isEmpty():
        # The same for a neighbour of a crowded low segment: its ball reaches into the crowd.
        reach = crowded.where("part = 1").select(F.explode(F.array(*[F.col("segment").bitwiseXOR(F.lit(b)) for b in _balls(1, 32)])).alias("segment"))
        near = crowded.where("part = 0").select("part", "segment").unionByName(reach.select(F.lit(1).alias("part"), "segment")).distinct()
        hot = stored(table.join(near, ["part", "segment"], "left_semi").select("fingerprint").distinct(), "crowded-fingerprints")
        table = table.join(crowded.select("part", "segment"), ["part", "segment"], "left_anti")
    ball = F.array(*[F.lit(b).cast("long") for b in _balls(1, 32)])
    probes = distinct.select(
        f.alias("probe"), F.explode(F.concat(
            F.array(F.struct(F.lit(0).alias("part"), F.shiftrightunsigned(f, 32).alias("segment"))),
            F.transform(ball, lambda b: F.struct(F.lit(1).alias("part"), f.bitwiseAND(low_mask).bitwiseXOR(b).alias("segment"))),
        )).alias("s"),
    ).select("probe", "s.part", "s.segment")
    close = F.bit_count(F.col("probe").bitwiseXOR(f)) <= 2
    same = (F.col("p.part") == F.col("t.part")) & (F.col("p.segment") == F.col("t.segment"))
    found = probes.alias("p").join(table.alias("t"), same & close & (F.col("probe") != f))
    found = found.select(F.least("probe", "fingerprint").alias("a"), F.greatest("probe", "fingerprint").alias("b"))
    if not hot.isEmpty():
        full = F.array(*[F.lit(b if b < 1 << 63 else b - (1 << 64)) for b in _balls(2, 64)[1:]])
        around = hot.select(f.alias("a"), F.explode(full).alias("x")).select("a", F.col("a").bitwiseXOR(F.col("x")).alias("fingerprint"))
        exact = around.join(distinct.select("fingerprint"), "fingerprint").select(F.least("a", "fingerprint").alias("a"), F.greatest("a", "fingerprint").alias("b"))
        found = found.unionByName(exact)
    return found


def components(pairs: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable over pairs (a, b); nodes without pairs do not appear.

    Each round a node takes the smallest root among its neighbours, then the root of that root.
    Nothing of the graph comes to the driver but a count of changes.
    """
    edges = stored(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        offered = edges.join(roots, edges["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("offer"))
        taken = stored(roots.join(offered, roots["node"] == offered["a"]).select("node", "root", F.least("root", "offer").alias("next")), "roots")
        up = taken.select(F.col("node").alias("next"), F.col("next").alias("up"))
        jumped = stored(taken.join(up, "next").select("node", "root", F.least("next", "up").alias("next")), "roots")
        changed = jumped.where("next <> root").limit(1).count()
        roots = jumped.select("node", F.col("next").alias("root"))
        if not changed:
            return roots


def near_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = SHINGLE, bucket: int = BUCKET, row_col: str | None = None) -> DataFrame:
    """``_row, doc_id, fingerprint`` (hex), ``component_id, kept`` for each row.

    Fingerprints link at two or fewer differing bits; the component's id is the smallest id
    reachable, its own included, and one row of that id is ``kept``. Null texts have no words;
    texts without words have fingerprint zero and link like any other. Null ids do not name a
    component unless all its ids are null. Repeated rows are rows like any other; an empty table
    gives no rows; other columns are not read. ``row_col`` tells the rows of ``known_rows``
    documents apart.
    """
    rows = stored(fingerprints(docs, text_col, id_col, width, row_col), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "_row"))
    distinct = stored(rows.groupBy("fingerprint").agg(first.alias("first")), "distinct-fingerprints")
    pairs = stored(links(distinct.select("fingerprint"), bucket), "links")
    roots = components(pairs).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    named = stored(rooted.join(named, "root").select("fingerprint", "stays"), "components")
    return rows.join(named, "fingerprint").select(
        "_row", "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("stays.doc_id").alias("component_id"), (F.col("_row") == F.col("stays._row")).alias("kept"),
    )


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """The documents with one of each component, all columns: the row with the smallest id.

    Null, empty and blank texts are one component. Null ids come last; of repeated rows one
    stays. Other columns may have any names and values; an empty table stays empty.
    """
    columns = docs.columns
    docs, row = known_rows(docs, id_col)
    gone = near_groups(docs, text_col, id_col, width, bucket, row).where(~F.col("kept"))
    return only_rows(docs, row, stored(gone.select("_row"), "gone"), "left_anti", columns)
