"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import quillmark
from quillmark.session import run_dir

# Functions of this package travel by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(quillmark)

BLANKS = r"[\x20\x09-\x0D]+"
# Where the SentencePiece model of queries and pipeline lies.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = f"{run_dir(df.sparkSession, label)}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text_col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text_col), F.lit(""))


def numbered(docs: DataFrame, *columns: Column, row_col: str | None = None) -> DataFrame:
    """``_row`` and the given columns.

    Ids may repeat or be null, so rows get numbers of their own, those of ``row_col`` if it is
    given. Without it they hold for one scan: how files are dealt to partitions may change with
    the cores. What joins rows of several scans needs the result stored, or ``known_rows``.
    """
    row = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    return docs.select(row.alias("_row"), *columns)


def known_rows(docs: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """The documents with a column that tells their rows apart in each scan, and its name.

    Ids do if none is null or repeats. Otherwise the table is written once, with numbers as data.
    """
    counts = docs.select(F.col(id_col).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if counts.where("id is null or n > 1").isEmpty():
        return docs, id_col
    name = free_name(docs, "_at_row")
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "documents"), name


def schemas(ddl: str) -> tuple:
    """The Spark and the Arrow schema of a task's output."""
    schema = T.StructType.fromDDL(ddl)
    return schema, to_arrow_schema(schema)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def only_rows(docs: DataFrame, row_col: str, rows: DataFrame, how: str, columns: list[str]) -> DataFrame:
    """The columns of ``known_rows`` documents whose row is (``left_semi``) or is not (``left_anti``) in ``rows._row``."""
    other = free_name(docs, "_other_row")
    some = docs.join(rows.select(F.col("_row").alias(other)), F.col(f"`{row_col}`") == F.col(other), how)
    return some.select(*[F.col(f"`{c}`") for c in columns])
