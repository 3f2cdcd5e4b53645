"""Seeded order, exact ranks, splits and samples.

Order is the hash of seed and row id, so it does not depend on partitioning. Ids are taken to
be unique; rows that share one fall on the same side of a cut. Ranks never need one sorted
partition: rows are counted by hash prefix (at most 65,536 counters), and only the bucket
that holds the wanted rank is looked into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillmark.functions.fixed_values import EVAL_SHARE

_PREFIX = 4  # hex digits: 16 ** 4 buckets
TOP_KEYS, TOP_ROWS, BROADCAST_ROWS = 100_000, 10_000, 100_000


def order_key(row_id: Column, seed: int) -> Column:
    """Sort key of a row under a seed."""
    return F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))


def seeded_order(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Whole table in seeded order."""
    return df.orderBy(order_key(F.col(id_col), seed), id_col)


def _bucket(key: Column) -> Column:
    return F.substring(key, 1, _PREFIX)


def with_global_rank(df: DataFrame, id_col: str, seed: int, rank_col: str = "rank") -> DataFrame:
    """Rank of every row (from 1) in the seeded order."""
    keyed = df.withColumn("_key", order_key(F.col(id_col), seed)).withColumn("_bucket", _bucket(F.col("_key")))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    offsets = F.broadcast(counts.select("_bucket", before.alias("_before")))  # <= 65,536 rows
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    ranked = keyed.join(offsets, "_bucket").withColumn(rank_col, F.col("_before") + inside)
    return ranked.drop("_key", "_bucket", "_before")


def cutoffs(keys: DataFrame, wanted: Callable[[Column], Column], by: Sequence[str] = ()) -> DataFrame:
    """Key of the last row to take per group: the ``wanted(n)``-th smallest of its n keys.

    ``keys`` has the group columns and ``key``. A group of which nothing is wanted has no row.
    The result holds one row per group.
    """
    by = list(by)
    keyed = keys.select(*by, "key", _bucket(F.col("key")).alias("_bucket"))
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*by).orderBy("_bucket") if by else Window.orderBy("_bucket")
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    counted = counts.select(
        *by,
        "_bucket",
        (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
        F.col("_n"),
        wanted(F.sum("_n").over(whole)).cast("bigint").alias("_wanted"),
    )
    edge = counted.where("_before < _wanted and _wanted <= _before + _n").select(
        *by, "_bucket", (F.col("_wanted") - F.col("_before")).alias("_position")
    )
    if not by:
        edge = F.broadcast(edge)  # one row at most
    # Copies of one key are counted before they meet, however many there are.
    inside = keyed.join(edge, [*by, "_bucket"]).groupBy(*by, "_bucket", "_position", "key").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    reached = F.sum("_copies").over(Window.partitionBy(*by, "_bucket").orderBy("key"))
    located = inside.withColumn("_reached", reached)
    at_position = (F.col("_reached") >= F.col("_position")) & (F.col("_reached") - F.col("_copies") < F.col("_position"))
    return located.where(at_position).select(*by, F.col("key").alias("cutoff"))


def several_cutoffs(keys: DataFrame, wanted: dict[str, Callable[[Column], Column]]) -> Column:
    """One scalar struct with the ``cutoffs`` key of each wanted rank, by one count and one look-up.

    A rank of which nothing is wanted has a null key.
    """
    keyed = keys.select("key", _bucket(F.col("key")).alias("_bucket"))
    counts = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())  # <= 65,536 rows
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), make(total).cast("bigint").alias("wanted")) for name, make in wanted.items()])
    before = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    counted = counts.select("_bucket", before.alias("_before"), "_n", ranks.alias("_ranks"))
    asked = counted.select("_bucket", "_before", "_n", F.inline("_ranks"))
    edge = asked.where("_before < wanted and wanted <= _before + _n").select("_bucket", "name", (F.col("wanted") - F.col("_before")).alias("_position"))
    inside = keyed.join(F.broadcast(edge), "_bucket").groupBy("name", "_position", "key").agg(F.count(F.lit(1)).alias("_copies"))
    reached = F.sum("_copies").over(Window.partitionBy("name").orderBy("key"))
    located = inside.withColumn("_reached", reached)
    at_position = (F.col("_reached") >= F.col("_position")) & (F.col("_reached") - F.col("_copies") < F.col("_position"))
    found = located.where(at_position).agg(*[F.max(F.when(F.col("name") == name, F.col("key"))).alias(name) for name in wanted])
    return found.select(F.struct(*wanted)).scalar()


def first_k(df: DataFrame, id_col: str, k: int, seed: int) -> DataFrame:
    """First ``min(k, n)`` rows of the seeded order, by one scalar cutoff and no join.

    Few rows are found by a top-k of keys in each task, many by counting prefixes.
    """
    key = order_key(F.col(id_col), seed)
    if k <= TOP_KEYS:
        last = df.select(key.alias("cutoff")).orderBy("cutoff").limit(k).agg(F.max("cutoff").alias("cutoff"))
    else:
        last = cutoffs(df.select(key.alias("key")), lambda n: F.least(F.lit(k), n))
    return df.where(key <= last.select("cutoff").scalar())


def train_eval_split(
    df: DataFrame,
    id_col: str,
    seed: int = 0,
    eval_share: float = EVAL_SHARE,
    limit: int | None = None,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Adds ``split``: of the first ``k = min(limit, n)`` rows, ``int(k * eval_share)`` are eval.

    Rows past ``limit`` are left out. ``df`` may hold several rows per id (pass the distinct
    ``ids`` then): membership is a comparison with a scalar, so rows of one id stay together
    without a join.
    """
    keys = (df if ids is None else ids).select(order_key(F.col(id_col), seed).alias("key"))

    def used(n: Column) -> Column:
        return n if limit is None else F.least(n, F.lit(limit))

    def train(n: Column) -> Column:
        return used(n) - F.floor(used(n) * F.lit(eval_share)).cast("bigint")

    key = order_key(F.col(id_col), seed)
    if limit is None:
        return df.withColumn("split", F.when(key <= cutoffs(keys, train).select("cutoff").scalar(), "train").otherwise("eval"))
    last = several_cutoffs(keys, {"train": train, "used": used})
    return df.where(key <= last["used"]).withColumn("split", F.when(key <= last["train"], "train").otherwise("eval"))


def stratified_sample(
    df: DataFrame, class_col: str, per_class: int, id_col: str, seed: int = 42, classes: Sequence | None = None
) -> DataFrame:
    """``min(n, per_class)`` rows of each class, first in the seeded order.

    Up to ``TOP_ROWS`` rows a class are found by a top-n of narrow keys per class and salt, then
    per class over what is left; more by counting prefixes. A class is then one row with its
    last key. These rows are broadcast if the classes are given or counted to be few; otherwise
    rows meet them in a join, whose skew is left to adaptive execution.
    """
    df = df.where(F.col(class_col).isNotNull() if classes is None else F.col(class_col).isin(*classes))
    keyed = df.withColumn("_key", order_key(F.col(id_col), seed))
    keys = keyed.select(class_col, F.col("_key").alias("key"))
    if per_class <= TOP_ROWS:
        salted = keys.withColumn("_salt", F.conv(F.substring("key", 1, 2), 16, 10).cast("int"))
        parts = Window.partitionBy(class_col, "_salt").orderBy("key")
        few = salted.withColumn("_rank", F.row_number().over(parts)).where(F.col("_rank") <= per_class).drop("_rank")
        first = few.withColumn("_rank", F.row_number().over(Window.partitionBy(class_col).orderBy("key")))
        last = first.where(F.col("_rank") <= per_class).groupBy(class_col).agg(F.max("key").alias("cutoff"))
    else:
        last = cutoffs(keys, lambda n: F.least(F.lit(per_class), n), [class_col])
    if classes is not None or keys.select(class_col).distinct().limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        last = F.broadcast(last)
    return keyed.join(last, class_col).where("_key <= cutoff").select(*df.columns)


def head_rows(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """First ``n`` rows for review."""
    return df.orderBy(order_col).limit(n)
