"""Loss curves and the best checkpoint from a training log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loss_curves(logs: DataFrame) -> DataFrame:
    """Train and eval series in long form: ``series, step, epoch, loss``."""
    series = F.array(
        F.struct(F.lit("train").alias("series"), F.col("loss").alias("value")),
        F.struct(F.lit("eval").alias("series"), F.col("eval_loss").alias("value")),
    )
    long = logs.select("step", "epoch", F.inline(series))
    return long.where(F.col("value").isNotNull()).select("series", "step", "epoch", F.col("value").alias("loss"))


def best_checkpoint(logs: DataFrame) -> DataFrame:
    """Step with the least eval loss; of equals the earliest."""
    seen = logs.where(F.col("eval_loss").isNotNull() & ~F.isnan("eval_loss"))
    best = F.min(F.struct("eval_loss", "step"))
    return seen.agg(best.alias("best"), F.count(F.lit(1)).alias("n_evals")).select("best.step", "best.eval_loss", "n_evals")
