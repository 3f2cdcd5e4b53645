"""Exact dedup by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. The distinct blocks, sorted by digest, get
integer names. Adjacent names of a document are paired, the distinct pairs are sorted and named
in turn, until each document has one name. Names stand for content without collisions: digests
only order the blocks, and it is checked on the blocks themselves that no digest stands for two.

Only DataFrame functions are used. Texts are shuffled once, after equal blocks met on the map
side; all else moves numbers. A group of copies is aggregated before it is shuffled.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import BLANKS, known_rows, numbered, only_rows, stored, whole_text

BLOCK_BYTES = 4096


def _blocks(docs: DataFrame, text_col: str, block_bytes: int, cut):
    """Array over the blocks of the normalised text; the text is bound once in the lambda."""
    text = F.regexp_replace(whole_text(text_col), BLANKS, " ")

    def of(t):
        last = F.greatest(F.ceil(F.octet_length(t) / block_bytes) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: cut(F.substring(t.cast("binary"), i * block_bytes + 1, F.lit(block_bytes))))

    return F.flatten(F.transform(F.array(text), of))


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with integer names in sorted order."""
    order = [F.col(k) for k in keys]
    ranked = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranked.withColumn("name", F.monotonically_increasing_id()), "names")


def document_names(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """One row per document: ``_row, _id, text_sha256, level, name``; equal (level, name), equal text."""
    for attempt in count():
        def keyed(b, attempt=attempt):
            return F.struct(F.xxhash64(F.lit(attempt), b).alias("k1"), F.xxhash64(b, F.lit(attempt)).alias("k2"))

        keys = _blocks(docs, text_col, block_bytes, keyed)
        sha = F.sha2(F.regexp_replace(whole_text(text_col), BLANKS, " "), 256)
        facts = stored(numbered(docs, F.col(id_col).alias("_id"), sha.alias("text_sha256"), keys.alias("keys"), row_col=row_col), "block-keys")
        raw = docs.select(F.explode_outer(_blocks(docs, text_col, block_bytes, lambda b: b)).alias("block"))
        raw = raw.select(keyed(F.col("block")).alias("k"), "block").select("k.k1", "k.k2", "block")
        digests = stored(raw.distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("variants")), "digests")
        if digests.where("variants > 1").isEmpty():
            break
    names = _named(digests.select("k1", "k2"), ["k1", "k2"])
    parts = facts.select("_row", F.posexplode_outer("keys").alias("pos", "k")).select("_row", F.col("pos").cast("long"), "k.k1", "k.k2")
    parts = parts.join(names, ["k1", "k2"]).select("_row", "pos", "name")
    most = facts.agg(F.max(F.size("keys"))).first()[0] or 1
    done, level = None, 0
    if most == 1:
        done = stored(parts.select("_row", F.lit(0).alias("level"), "name"), "identities")
    else:
        sizes = facts.select("_row", F.size("keys").alias("n"))
        parts = stored(parts.join(sizes, "_row"), "level")
        done = parts.where("n = 1").select("_row", F.lit(0).alias("level"), "name")
        while most > 1:
            level += 1
            half = F.col("pos") % 2
            pairs = parts.where("n > 1").groupBy("_row", F.floor(F.col("pos") / 2).alias("pos"), F.floor((F.col("n") + 1) / 2).alias("n")).agg(
                F.max(F.when(half == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
            pairs = stored(pairs, "pairs")
            names = _named(pairs.select("left", "right").distinct(), ["left", "right"])
            parts = stored(pairs.join(names, ["left", "right"]).select("_row", "pos", "n", "name"), "level")
            done = done.unionByName(parts.where("n = 1").select("_row", F.lit(level).alias("level"), "name"))
            most = (most + 1) // 2
    return facts.select("_row", "_id", "text_sha256").join(done, "_row")


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES, row_col: str | None = None) -> DataFrame:
    """Which rows stay: ``_row, doc_id, keep_id, group_size, kept, text_sha256``, a row for each input row.

    Texts are equal if identical after each run of ASCII blanks became one space. A null text
    counts as empty. The row with the smallest id stays; null ids come last, rows that share the
    smallest id are told apart by ``_row`` and one of them stays. An empty table gives no rows.
    Other input columns are not read. ``row_col`` tells the rows of ``known_rows`` documents apart.
    """
    named = stored(document_names(docs, text_col, id_col, block_bytes, row_col), "identities")
    first = F.min(F.struct(F.col("_id").isNull().alias("absent"), F.col("_id").alias("id"), F.col("_row").alias("row")))
    # Stored first: a plain join of two inputs is one whose hot groups adaptive execution splits.
    groups = stored(named.groupBy("level", "name").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
    return named.join(groups, ["level", "name"]).select(
        "_row", F.col("_id").alias("doc_id"), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("first.row")).alias("kept"), "text_sha256",
    )


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The documents without later copies, all columns.

    Which row of a group stays is as in ``exact_dedup``; all null and empty texts are one group,
    of rows equal in id and text one stays. Other columns may have any names and values.
    """
    columns = docs.columns
    docs, row = known_rows(docs, id_col)
    return only_rows(docs, row, exact_dedup(docs, text_col, id_col, row_col=row).where("kept"), "left_semi", columns)
