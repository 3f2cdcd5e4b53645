"""Sharding by longest-processing-time scheduling.

Groups that must stay together are sorted by size and go to the least loaded shard through a
heap. The heap sees a bounded number of units: groups above a small share of a shard (there can
be few of them) are units of their own, the others are pooled by a hash of their key. So the
driver holds at most ``2 * shards * grain`` numbers whatever the input.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, stored, whole_text

SHARDS, GRAIN, ROW_OVERHEAD, SLOT_ROWS = 40, 256, 16, 20_000


def schedule(units: list[tuple], shards: int) -> list[tuple]:
    """(unit, shard) for (unit, size): longest first to the least loaded; ties by unit and shard."""
    heap = [(0, s) for s in range(shards)]
    placed = []
    for unit, size in sorted(units, key=lambda u: (-u[1], str(u[0]))):
        load, shard = heapq.heappop(heap)
        placed.append((unit, shard))
        heapq.heappush(heap, (load + size, shard))
    return placed


def assign_shards(docs: DataFrame, shards: int = SHARDS, text_col: str = "text", id_col: str = "doc_id", grain: int = GRAIN) -> DataFrame:
    """``_row, doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row.

    Rows of equal text stay together. A size is the UTF-8 bytes of the text plus 16; a null text
    is empty and grouped with empty ones. Slots count from 0 in each shard without gaps; in a
    shard they follow blocks of rows, within a block the id. Repeated and null ids are rows like
    any other. An empty table gives no rows; other input columns are not read.
    """
    spark = docs.sparkSession
    text = whole_text(text_col)
    facts = stored(
        numbered(
            docs, F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + ROW_OVERHEAD).alias("size"),
            F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("group"),
        ),
        "shard-facts",
    )
    total, rows = facts.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    cells = shards * grain
    pool = F.pmod(F.xxhash64("group"), F.lit(cells)).cast("int")
    groups = stored(facts.groupBy("group").agg(F.sum("size").alias("size")), "shard-groups")
    large = F.col("size") * cells >= total
    own = groups.where(large).select(F.lit(-1).alias("pool"), "group", "size")
    pooled = groups.where(~large).groupBy(pool.alias("pool")).agg(F.sum("size").alias("size")).select("pool", F.lit(0).cast("long").alias("group"), "size")
    units = own.unionByName(pooled).collect()  # at most 2 * cells rows
    placed = schedule([((u["pool"], u["group"]), u["size"]) for u in units], shards)
    apart = spark.createDataFrame([(g, s) for (p, g), s in placed if p < 0], "group long, own_shard int")
    by_pool = spark.createDataFrame([(p, s) for (p, g), s in placed if p >= 0], "pool int, pool_shard int")
    put = (
        facts.join(F.broadcast(apart), "group", "left").withColumn("pool", pool).join(F.broadcast(by_pool), "pool", "left")
        .withColumn("shard", F.coalesce("own_shard", "pool_shard"))
    )
    blocks = max(64, -(-rows // (shards * SLOT_ROWS)))
    put = put.withColumn("block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int"))
    counts = stored(put.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy(F.col("doc_id").asc_nulls_last(), "_row")
    ranked = put.withColumn("rank", F.row_number().over(inside)).join(starts, ["shard", "block"])
    return ranked.select(
        "_row", "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
