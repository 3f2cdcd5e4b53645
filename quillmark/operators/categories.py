"""Pages reachable from seed categories through a table of category members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.fixed_values import CATEGORY_PREFIX
from quillmark.session import shared_dir

BROADCAST_ROWS = 100_000


def is_category(member: Column) -> Column:
    return F.contains(member, F.lit(CATEGORY_PREFIX))


def category_name(member: Column) -> Column:
    return F.replace(member, F.lit(CATEGORY_PREFIX), F.lit(""))


def members_of(edges: DataFrame, categories: DataFrame, n_categories: int) -> DataFrame:
    """Edges whose category is in ``categories(name)``, a distinct list of counted size.

    A short list is broadcast. A long one is joined; a category that holds a large share of all
    edges is split by adaptive execution, as both sides are plain inputs of the join.
    """
    named = edges.withColumn("name", category_name(F.col("category")))
    if n_categories <= BROADCAST_ROWS:
        return named.join(F.broadcast(categories), "name").drop("name")
    return named.join(categories, "name").drop("name")


def category_pages(edges: DataFrame, seeds: Sequence[str], max_depth: int = 2) -> DataFrame:
    """Distinct pages at most ``max_depth`` member edges away from a seed category.

    The loop walks category-to-category edges only. Each level is checkpointed, which cuts the
    lineage and lets a lost executor recover from the shared folder; known categories are
    removed, so cycles end. Pages are collected once, after the last level.
    """
    spark = edges.sparkSession
    shared_dir(spark)
    names = sorted({s.replace(CATEGORY_PREFIX, "") for s in seeds})
    frontier = spark.createDataFrame([(n,) for n in names], "name string")
    visited, n_visited, n_frontier = frontier, len(names), len(names)
    links = edges.where(is_category(F.col("member")))
    for _ in range(max_depth - 1):
        found = members_of(links, frontier, n_frontier).select(category_name(F.col("member")).alias("name")).distinct()
        frontier = found.join(visited, "name", "left_anti").checkpoint()
        n_frontier = frontier.count()
        if n_frontier == 0:
            break
        visited, n_visited = visited.unionByName(frontier), n_visited + n_frontier
    pages = edges.where(~is_category(F.col("member")))
    return members_of(pages, visited, n_visited).select(F.col("member").alias("page")).distinct()
