"""Classifier and regression metrics as aggregate queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.values import binarise, ratio
from pulsetrail.operators.ordering import running_totals

# The column names of the confusion report, in order, and the variant of two of them.
REPORT = (
    "type", "predict_cnt", "real_loss_cnt", "predict_loss_cnt",
    "accuarcy", "precise", "recall", "TP", "FP", "TN", "FN",
)
PLAIN_NAMES = {"real_loss_cnt": "real_cnt", "predict_loss_cnt": "predict_real_cnt"}


def _counts(label: Column, prediction: Column) -> list[Column]:
    """The four conditional counts, and all rows."""
    return [
        F.count("*").alias("predict_cnt"),
        F.count_if((label == 1) & (prediction == 1)).alias("TP"),
        F.count_if((label == 0) & (prediction == 1)).alias("FP"),
        F.count_if((label == 0) & (prediction == 0)).alias("TN"),
        F.count_if((label == 1) & (prediction == 0)).alias("FN"),
    ]


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(*_counts(F.col(label), F.col(prediction)))


def _report(counts: DataFrame, tag: Column, plain: bool) -> DataFrame:
    report = counts.select(
        tag.alias("type"),
        "predict_cnt",
        (F.col("TP") + F.col("FN")).alias("real_loss_cnt"),
        (F.col("TP") + F.col("FP")).alias("predict_loss_cnt"),
        ratio(F.col("TP") + F.col("TN"), "predict_cnt").alias("accuarcy"),
        ratio("TP", F.col("TP") + F.col("FP")).alias("precise"),
        ratio("TP", F.col("TP") + F.col("FN")).alias("recall"),
        "TP", "FP", "TN", "FN",
    ).select(*REPORT)
    return report.withColumnsRenamed(PLAIN_NAMES) if plain else report


def confusion(
    df: DataFrame,
    tag: str,
    label: str = "label",
    prediction: str = "prediction",
    plain: bool = False,
) -> DataFrame:
    """The confusion report; a rate without any case to count is null."""
    return _report(confusion_counts(df, label, prediction), F.lit(tag), plain)


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float],
    label: str = "label",
    score: str = "probability",
    plain: bool = True,
) -> DataFrame:
    """One confusion report per threshold, all from one pass over the rows."""
    sweeps = [
        F.struct(F.lit(bar).alias("threshold"), *_counts(F.col(label), binarise(score, bar)))
        for bar in thresholds
    ]
    counts = df.agg(F.array(*sweeps).alias("sweeps")).select(F.explode("sweeps").alias("sweep"))
    tag = F.format_string("%.2f", "threshold")
    return _report(counts.select("sweep.*"), tag, plain)


def auc(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """Area under the ROC curve from raw scores, ties counting half: one row, column ``auc``.

    The rows are first summed per distinct score; then each positive is set against the negatives
    with a smaller score, taken from a running total over the sorted scores.
    """
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranked = running_totals(per_score, [F.col("score")], {"neg_upto": F.col("neg")})
    wins = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    sums = ranked.agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(F.try_divide("wins", F.col("p").cast("double") * F.col("n")).alias("auc"))


def precision_by_threshold(df: DataFrame, label: str = "label", score: str = "probability") -> DataFrame:
    """``(threshold, precision)`` of "positive from this score on", per distinct score."""
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("rows")
    )
    ranked = running_totals(
        per_score, [F.desc("threshold")], {"hits": F.col("pos"), "taken": F.col("rows")}
    )
    return ranked.select("threshold", (F.col("hits") / F.col("taken")).alias("precision"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))
