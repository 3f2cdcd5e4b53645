"""Reports over answers to questions: accuracy, perplexity, model against model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions.vectors import defined

TOTAL = "all"


def rounded(value: Column) -> Column:
    """Six decimals: sums of doubles differ in the last bit by order of arrival."""
    return F.round(value, 6)


def share(flag: Column) -> Column:
    """Share of true flags over all rows; a null flag is in the denominator."""
    return F.try_divide(F.count_if(flag).cast("double"), F.count(F.lit(1)))


def mean_flag(flag: Column) -> Column:
    """Mean of the flags that are there."""
    return F.avg(flag.cast("int"))


def grouped_report(
    df: DataFrame,
    group: str,
    flags: dict[str, Column] | None = None,
    means: dict[str, Column] | None = None,
    shares: dict[str, Column] | None = None,
) -> DataFrame:
    """Row count and metrics per group and over all rows, in one pass over the data.

    ``flags`` give means of booleans, ``means`` means of numbers that skip null and NaN,
    ``shares`` true over all rows. Rows without a group count in the total only. ``is_total``
    marks the total, so a group may be called anything.
    """
    flags, means, shares = flags or {}, means or {}, shares or {}
    named = {**flags, **means, **shares}
    narrow = df.select(F.col(group), *[c.alias(name) for name, c in named.items()])
    metrics = [rounded(mean_flag(F.col(name))).alias(name) for name in flags]
    metrics += [rounded(F.avg(defined(F.col(name)))).alias(name) for name in means]
    metrics += [rounded(share(F.col(name))).alias(name) for name in shares]
    report = narrow.rollup(group).agg(F.grouping(group).alias("_total"), F.count(F.lit(1)).alias("n"), *metrics)
    named_group = F.when(F.col("_total") == 1, F.lit(TOTAL)).otherwise(F.col(group).cast("string"))
    kept = report.where((F.col("_total") == 1) | F.col(group).isNotNull())
    return kept.select(named_group.alias(group), (F.col("_total") == 1).alias("is_total"), "n", *named)


def compare_models(
    base: DataFrame,
    tuned: DataFrame,
    group: str,
    flags: dict[str, Column],
    means: dict[str, Column] | None = None,
    on: str = "question",
) -> DataFrame:
    """Metrics of two result tables side by side, with deltas, per group and overall.

    Rows are matched by ``on``, which must be unique in each table. Metrics are over matched
    rows; ``n_base_only`` and ``n_tuned_only`` count the others. Only flags and numbers are
    shuffled. A group comes from the base row where there is one.
    """
    means = means or {}
    names = [*flags, *means]

    def side(df: DataFrame, label: str) -> DataFrame:
        measures = [c.cast("int").alias(f"{m}_{label}") for m, c in flags.items()]
        measures += [defined(c).alias(f"{m}_{label}") for m, c in means.items()]
        return df.select(F.col(on).alias("_on"), F.col(group).alias(f"_{label}_group"), F.lit(True).alias(f"_{label}"), *measures)

    both = side(base, "base").join(side(tuned, "tuned"), "_on", "full")
    matched = F.col("_base") & F.col("_tuned")
    rows = both.withColumn(group, F.coalesce("_base_group", "_tuned_group"))
    metrics = [rounded(F.avg(F.when(matched, F.col(f"{m}_{x}")))).alias(f"{m}_{x}") for m in names for x in ("base", "tuned")]
    report = rows.rollup(group).agg(
        F.grouping(group).alias("_total"),
        F.count_if(matched).alias("n_matched"),
        F.count_if(F.col("_tuned").isNull()).alias("n_base_only"),
        F.count_if(F.col("_base").isNull()).alias("n_tuned_only"),
        *metrics,
    )
    total = F.col("_total") == 1
    deltas = [rounded(F.col(f"{m}_tuned") - F.col(f"{m}_base")).alias(f"{m}_delta") for m in names]
    named_group = F.when(total, F.lit(TOTAL)).otherwise(F.col(group).cast("string")).alias(group)
    counts = ("n_matched", "n_base_only", "n_tuned_only")
    kept = report.where(total | F.col(group).isNotNull())
    return kept.select(named_group, total.alias("is_total"), *counts, *[f"{m}_{x}" for m in names for x in ("base", "tuned")], *deltas)
