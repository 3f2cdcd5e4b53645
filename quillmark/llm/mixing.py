"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Sources share the corpus' size by weight; none gets more than ``most`` times its own. A source
is the stream of its documents in shuffled order, again from the start when it is used up, cut
into blocks of equal size. As many slots as its target needs blocks are its own, a range of
the numbers below the count of all slots: the cumulative weights. Slot p of the schedule has
the van der Corput point of p: its number with the bits in reverse order, so that each source
comes up evenly. Ranked within its source, a slot names the block that it takes.

Only DataFrame functions are used. Slots are bounded in number, whatever the corpus: blocks
grow with it. Running sums are taken within range partitions, so no source is in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, stored, whole_text

WEIGHTS, MOST, SLOTS, LEAST_BLOCK = (5, 2, 1), 3, 1 << 20, 64


def running(rows: DataFrame, order: list[Column], values: dict[str, Column], label: str) -> DataFrame:
    """The rows with the sum of each value over all rows before them in the order."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    ranged = stored(ranged.select("*", F.shiftright(at, 33).alias("_part"), at.alias("_at"), *[v.cast("long").alias(f"_{c}") for c, v in values.items()]), label)
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition of the sort.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("_part").agg(*[F.sum(f"_{c}").alias(f"_{c}") for c in values])
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in values])
    summed = ranged.select("*", *[F.coalesce(F.sum(f"_{c}").over(inside), F.lit(0)).alias(c) for c in values]).join(F.broadcast(parts), "_part")
    return summed.select(*rows.columns, *[(F.col(c) + F.col(f"_before_{c}")).alias(c) for c in values])


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, place, start, weight, target, total`` out of ``source, source_size``.

    ``place`` is the source's place by code point, null last; weights repeat in that order.
    ``start`` is the size of all sources before. Targets share the sum of sizes by weight; one
    above ``most`` times its source's size stops there and the others share the excess, until
    none is above. ``total`` is the target in whole words.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = running(sizes, order, {"place": F.lit(1), "start": F.col("source_size")}, "source-places")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = stored(placed.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * most
    left, parts = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    size, stopped = left, 0
    while parts:
        share = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(parts))
        above = share > cap
        found = placed.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if found[0] == stopped or not found[2]:
            break
        stopped, left, parts = found[0], size - found[1], found[2]
    target = F.when(above, cap.cast("double")).otherwise(share) if parts else F.lit(0.0)
    placed = placed.withColumn("target", target)
    return placed.withColumn("total", F.least(F.floor(F.col("target") + 0.5), cap))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """``position, place, epoch, block, words``: what each slot of the mix takes, in order of ``position``.

    A slot takes the first ``words`` words of its source's block: the whole block but for the
    source's last slot, which stops at its target. Positions have gaps, as the slots need not
    be a power of two.
    """
    blocks, whole = F.ceil(F.col("source_size") / block), F.floor(F.col("total") / F.greatest("source_size", F.lit(1)))
    rest = F.col("total") - whole * F.col("source_size")
    planned = sources.select("place", "source_size", blocks.alias("blocks"), rest.alias("rest"), (whole * blocks + F.ceil(rest / block)).alias("slots"))
    planned = stored(running(planned, [F.col("place")], {"first": F.col("slots")}, "source-slots"), "slot-ranges")
    bits = max(1, ((planned.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0] or 1) - 1).bit_length())
    slots = planned.where("slots > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("k"))
    point = F.conv(F.reverse(F.lpad(F.bin(F.col("first") + F.col("k")), bits, "0")), 2, 10).cast("long")
    rank = F.row_number().over(Window.partitionBy("place").orderBy("position")) - 1
    ranked = slots.withColumn("position", point).withColumn("rank", rank.cast("long"))
    ranked = ranked.withColumn("block", F.col("rank") % F.col("blocks"))
    end = F.when((F.col("rank") == F.col("slots") - 1) & (F.col("rest") > 0), F.col("rest")).otherwise(F.col("source_size"))
    words = F.least(F.lit(block).cast("long"), end - F.col("block") * block)
    return ranked.select("position", "place", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"), "block", words.alias("words"))


class Mix:
    """A mix of documents: ``facts`` (a row for each document), ``sources``, ``block`` (words a block) and the pieces.

    Sizes are words; a null text has none. Null sources are one source. Documents of a source are
    shuffled by a digest of their ids; rows that agree in id and size can change places without a
    change to the result, so reruns agree. An empty table gives an empty mix; other columns are
    not read.
    """

    def __init__(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", source_col: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST, slots: int = SLOTS, least_block: int = LEAST_BLOCK):
        size = F.regexp_count(whole_text(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
        self.facts = stored(numbered(docs, F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size")), "mix-facts")
        sizes = stored(self.facts.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
        self.sources = stored(source_targets(sizes, weights, most), "targets")
        total = self.sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
        self.block = max(least_block, -(-total // slots))

    def pieces(self) -> DataFrame:
        """``position, source, epoch, block, _row, doc_id, first, words``: the mix as runs of words of documents.

        In order of ``position``, and within a slot of ``at``; ``first`` counts a document's words from 0.
        """
        slots = stored(schedule(self.sources, self.block), "schedule")
        order = [F.col("source").isNull(), F.col("source"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.col("doc_id"), F.col("size"), F.col("_row")]
        placed = running(self.facts.where("size > 0"), order, {"before": F.col("size")}, "shuffled")
        own = self.sources.select(F.col("source").alias("own"), "place", "start")
        placed = placed.join(own, F.col("source").eqNullSafe(F.col("own"))).withColumn("offset", F.col("before") - F.col("start"))
        size = F.lit(self.block)
        last = F.floor((F.col("offset") + F.col("size") - 1) / size)
        cut = placed.select("*", F.explode(F.sequence(F.floor(F.col("offset") / size), last)).alias("block"))
        begin = F.greatest(F.col("offset"), F.col("block") * size)
        stop = F.least(F.col("offset") + F.col("size"), F.col("block") * size + size)
        cut = cut.select("_row", "doc_id", "source", "place", "block", (begin - F.col("block") * size).alias("at"), (stop - begin).alias("long"), (begin - F.col("offset")).alias("first"))
        taken = F.least(F.col("long"), F.col("words") - F.col("at"))
        joined = cut.join(slots, ["place", "block"]).where(F.col("words") > F.col("at"))
        return joined.select("position", "at", "source", "epoch", "block", "_row", "doc_id", "first", taken.alias("words"))

    def documents(self) -> DataFrame:
        """``_row, doc_id, size, source, source_size, target, taken`` for each document; ``taken`` counts repeats."""
        taken = self.pieces().groupBy("_row").agg(F.sum("words").alias("taken"))
        own = self.sources.select(F.col("source").alias("own"), "source_size", "target")
        rows = self.facts.join(own, F.col("source").eqNullSafe(F.col("own"))).join(taken, "_row", "left")
        return rows.select("_row", "doc_id", "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
