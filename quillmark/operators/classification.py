"""Reports over predicted labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.evaluation import grouped_report, rounded


def label_accuracy(df: DataFrame, truth: str, preds: dict[str, Column]) -> DataFrame:
    """Accuracy over all rows and per true label, one column per way of reading the prediction."""
    flags = {name: F.col(truth).eqNullSafe(pred) for name, pred in preds.items()}
    return grouped_report(df, truth, flags=flags)


def confusion_counts(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Non-empty cells of the confusion matrix."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def _grid(df: DataFrame, labels: Sequence) -> DataFrame:
    options = F.array(*[F.lit(x) for x in labels])
    one = df.sparkSession.range(0, 1, 1, 1)
    return one.select(F.explode(options).alias("truth")).select("truth", F.explode(options).alias("pred"))


def confusion_matrix(df: DataFrame, truth: str, pred: str, labels: Sequence) -> DataFrame:
    """Every cell of the fixed label order, empty cells as 0."""
    wanted = df.where(F.col(truth).isin(*labels) & F.col(pred).isin(*labels))
    cells = F.broadcast(confusion_counts(wanted, truth, pred))  # at most len(labels) ** 2 rows
    return _grid(df, labels).join(cells, ["truth", "pred"], "left").na.fill(0, ["n"])


def classification_report(df: DataFrame, truth: str, pred: str, labels: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro and weighted average.

    All configured labels are there; a metric without a denominator is 0. Rows whose true or
    predicted label is not configured, or null, have no line of their own, but accuracy and
    total support are over all rows. Macro and weighted averages are over configured labels.
    """
    cells = confusion_counts(df, truth, pred)
    hit = F.col("truth").eqNullSafe(F.col("pred"))
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")),
    )
    per_side = cells.select(F.explode(sides).alias("s"), F.when(hit, F.col("n")).otherwise(F.lit(0)).alias("hits"))
    present = F.array(
        *[
            F.struct(F.lit(x).alias("label"), *[F.lit(0).cast("bigint").alias(c) for c in ("support", "predicted", "hits")])
            for x in labels
        ]
    )
    zero_rows = df.sparkSession.range(0, 1, 1, 1).select(F.inline(present))
    counted = per_side.select("s.label", "s.support", "s.predicted", F.when(F.col("s.support") > 0, F.col("hits")).otherwise(F.lit(0)).cast("bigint").alias("hits"))
    listed_label = F.when(F.col("label").isin(*labels), F.col("label")).alias("label")  # all others are null, as one
    totals = (
        counted.select(listed_label, "support", "predicted", "hits")
        .unionByName(zero_rows)
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))

    scored = totals.select(
        "label",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )
    metrics = ("precision", "recall", "f1")
    listed, every = F.col("label").isNotNull(), F.sum("support")
    accuracy = ratio(F.sum("hits"), every)

    def of_listed(value: Column) -> Column:
        return F.when(listed, value)

    def line(label: str, values: list[Column]) -> Column:
        named = [v.alias(m) for v, m in zip(values, metrics)]
        return F.struct(F.lit(label).alias("label"), *named, every.alias("support"))

    # One row per configured label and three summary rows: a handful, held in one array.
    rows = scored.agg(
        F.collect_list(of_listed(F.struct("label", *metrics, "support"))).alias("classes"),
        F.array(
            line("accuracy", [accuracy] * 3),
            line("macro avg", [F.avg(of_listed(F.col(m))) for m in metrics]),
            line("weighted avg", [ratio(F.sum(of_listed(F.col(m) * F.col("support"))), F.sum(of_listed(F.col("support")))) for m in metrics]),
        ).alias("summary"),
    )
    flat = rows.select(F.inline(F.concat("classes", "summary")))
    return flat.select("label", *[rounded(F.col(m)).alias(m) for m in metrics], "support")


def tag_integrity(df: DataFrame, sentiment_present: Column, reasoning_present: Column) -> DataFrame:
    """Share of replies with the sentiment tag, the reasoning tag and both."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg(sentiment_present.cast("int"))).alias("sentiment_rate"),
        rounded(F.avg(reasoning_present.cast("int"))).alias("reasoning_rate"),
        rounded(F.avg((sentiment_present & reasoning_present).cast("int"))).alias("both_rate"),
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, largest first."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)


def mean_score(df: DataFrame, score: Column, defaulted: Column) -> DataFrame:
    """Mean of the scores that could be read, with the counts behind it."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(score).alias("n_scored"),
        F.count_if(score.isNull()).alias("n_unreadable"),
        F.count_if(defaulted).alias("n_defaulted"),
        rounded(F.avg(score)).alias("mean_score"),
    )

