"""A corpus pipeline of operators from ``quillmark.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import stages
from quillmark.llm.common import read_table
from quillmark.operators.inference import materialize
from quillmark.session import drop_dir, run_dir, scratch

STAGES = stages.STAGES

# Model scores and locality-sensitive groups are beyond SQL; the tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read by the next one.

    A stage's own folders, and the output of the stage before it, are dropped once its output is written, so
    the shared folder holds two stages at most. The result reads the output of the last stage but one.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    *inner, (_, last) = STAGES
    for name, stage in inner:
        path = run_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), path)
        if before:
            drop_dir(spark, before)
        before = path
    return last(spark, docs, sf_dir)
