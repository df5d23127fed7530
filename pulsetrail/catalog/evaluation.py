"""Metrics, on a price-based score of the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.functions.values import binarise
from pulsetrail.operators import evaluation

SCORED_SQL = """select case when o_orderstatus = 'F' then 1 else 0 end as label,
       round(o_totalprice / 500000, 3) as probability,
       case when round(o_totalprice / 500000, 3) >= 0.6 then 1.0 else 0.0 end as prediction
from orders"""

COUNTS_SQL = f"""select count(*) as predict_cnt,
       count(*) filter (label = 1 and prediction = 1) as TP,
       count(*) filter (label = 0 and prediction = 1) as FP,
       count(*) filter (label = 0 and prediction = 0) as TN,
       count(*) filter (label = 1 and prediction = 0) as FN
from ({SCORED_SQL})"""


def scored(spark: SparkSession, folder: str, label: str = "label") -> DataFrame:
    probability = F.round(F.col("o_totalprice") / 500000, 3)
    return table(spark, folder, "orders").select(
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias(label),
        probability.alias("probability"),
        binarise(probability, 0.6).alias("prediction"),
    )


def rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({c: F.round(c, 6) for c in ("accuarcy", "precise", "recall")})


def report_sql(source: str, tag: str, real: str, predicted: str) -> str:
    return f"""select {tag} as type, predict_cnt, TP + FN as {real}, TP + FP as {predicted},
        round((TP + TN) * 1.0 / predict_cnt, 6) as accuarcy,
        round(TP * 1.0 / nullif(TP + FP, 0), 6) as precise,
        round(TP * 1.0 / nullif(TP + FN, 0), 6) as recall, TP, FP, TN, FN from ({source})"""


@query("confusion_counts", COUNTS_SQL)
def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_counts(scored(spark, folder))


@query("confusion", report_sql(COUNTS_SQL, "'test'", "real_loss_cnt", "predict_loss_cnt"))
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.confusion(scored(spark, folder), "test"))


@query("confusion_plain", report_sql(COUNTS_SQL, "'test'", "real_cnt", "predict_real_cnt"))
def confusion_plain(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.confusion(scored(spark, folder), "test", plain=True))


@query("confusion_r", report_sql(COUNTS_SQL, "'test'", "real_loss_cnt", "predict_loss_cnt"))
def confusion_r(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.confusion(scored(spark, folder, "r_label"), "test", label="r_label"))


SWEEP_SQL = f"""select threshold, count(*) as predict_cnt,
       count(*) filter (label = 1 and probability >= threshold) as TP,
       count(*) filter (label = 0 and probability >= threshold) as FP,
       count(*) filter (label = 0 and probability < threshold) as TN,
       count(*) filter (label = 1 and probability < threshold) as FN
from ({SCORED_SQL}), (select unnest([0.7, 0.8, 0.9]) as threshold) group by threshold"""


@query(
    "threshold_sweep",
    report_sql(SWEEP_SQL, "printf('%.2f', threshold::double)", "real_cnt", "predict_real_cnt"),
)
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.threshold_sweep(scored(spark, folder), [0.7, 0.8, 0.9]))


def auc_sql(score: str) -> str:
    return f"""select round((sum(case when label = 1 then r end) - p * (p + 1) / 2.0)
                            / (cast(p as double) * n), 6) as auc
        from (select label,
                     rank() over (order by s) + (count(*) over (partition by s) - 1) / 2.0 as r,
                     sum(label) over () as p, sum(1 - label) over () as n
              from (select label, {score} as s from ({SCORED_SQL}))) group by p, n"""


@query("auc", auc_sql("probability"))
def auc(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.auc(scored(spark, folder)).withColumn("auc", F.round("auc", 6))


@query("auc_hard", auc_sql("prediction"))
def auc_hard(spark: SparkSession, folder: str) -> DataFrame:
    area = evaluation.auc(scored(spark, folder), score="prediction")
    return area.withColumn("auc", F.round("auc", 6))


@query(
    "rmse",
    f"""select round(sqrt(avg((label - probability) * (label - probability))), 6) as rmse
        from ({SCORED_SQL})""",
)
def rmse(spark: SparkSession, folder: str) -> DataFrame:
    error = evaluation.rmse(scored(spark, folder), "label", "probability")
    return error.withColumn("rmse", F.round("rmse", 6))


@query(
    "accuracy",
    f"""select round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as accuracy
        from ({SCORED_SQL})""",
)
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.accuracy(scored(spark, folder)).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "precision_by_threshold",
    f"""select probability as threshold,
               round(sum(sum(label)) over w * 1.0 / sum(count(*)) over w, 6) as precision
        from ({SCORED_SQL}) group by probability
        window w as (order by probability desc rows unbounded preceding)""",
)
def precision_by_threshold(spark: SparkSession, folder: str) -> DataFrame:
    rows = evaluation.precision_by_threshold(scored(spark, folder))
    return rows.withColumn("precision", F.round("precision", 6))


@query("class_counts", f"select label, count(*) as cnt from ({SCORED_SQL}) group by label")
def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    from pulsetrail.operators.cleaning import class_counts as counts

    return counts(scored(spark, folder), ["label"])
