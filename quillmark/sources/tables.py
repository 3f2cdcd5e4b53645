"""Datasets with splits, and conversation files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.chat import MESSAGES


def load_splits(spark: SparkSession, path: str) -> DataFrame:
    """All splits of a dataset; ``split`` is a column, so one job covers them all."""
    return spark.read.parquet(path)


def load_split(
    spark: SparkSession, path: str, split: str = "train", mapper: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One split, by partition pruning, with an optional mapping of its rows."""
    rows = load_splits(spark, path).where(F.col("split") == split).drop("split")
    return rows.transform(mapper) if mapper else rows


def read_conversations(spark: SparkSession, path: str, keys: str = "", multiline: bool = False) -> DataFrame:
    """Conversation files below a folder, as one table.

    JSON lines are split across tasks; ``multiline`` reads one array or object per file.
    ``keys`` names further columns, such as ``"conv_id bigint"``.
    """
    schema = ", ".join(part for part in (keys, f"messages {MESSAGES}") if part)
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_array_lines(spark: SparkSession, path: str, keys: str = "") -> DataFrame:
    """``read_conversations`` for JSON arrays with an object on each line, as ``write_json_arrays`` writes them.

    So a large file is split across tasks like JSON lines. Lines may begin with a bracket or a comma and
    end with one; a line with anything else but one whole object is an error, as its file has another layout.
    """
    schema = ", ".join(part for part in (keys, f"messages {MESSAGES}") if part)
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\s*+[\[,]?\s*+", "").alias("line"))
    rows = lines.where(~F.col("line").rlike(r"^[\],\s]*$")).select("line", F.regexp_extract("line", r"^(\{.*\})[\],\s]*$", 1).alias("object"))
    read = F.from_json("object", schema, {"mode": "FAILFAST"})
    whole = F.when(F.col("object") == "", F.raise_error(F.concat(F.lit("not a whole object: "), F.substring("line", 1, 80)))).otherwise(read)
    return rows.select(whole.alias("row")).select("row.*")
