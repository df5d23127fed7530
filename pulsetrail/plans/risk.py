"""Account-risk model: ratios, hashed lists, threshold sweep, scores of the day's payers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.dates import COMPACT, day, days_between
from pulsetrail.functions.values import is_numeric_id, safe_ratio
from pulsetrail.operators.evaluation import threshold_sweep
from pulsetrail.operators.joins import keep_known
from pulsetrail.operators.models import score
from pulsetrail.operators.pipelines import Features, Learner
from pulsetrail.operators.sampling import downsample_negatives, hash_split
from pulsetrail.plans import feature_sets as sets
from pulsetrail.plans.training import Trained, train_and_report, write_scores
from pulsetrail.sources.artefacts import load_model, save_model
from pulsetrail.sources.tables import scan_day

NEGATIVES_PER_CASE = 120
SPLIT = (0.7, 0.3)


def risk_rows(df: DataFrame) -> DataFrame:
    """Accounts with a numeric id, with the derived ratios; a missing or zero count gives 0."""
    ratios = {name: safe_ratio(a, b) for name, (a, b) in sets.RISK_RATIOS.items()}
    return df.where(is_numeric_id("uid")).withColumns(ratios)


def with_ip_names(df: DataFrame) -> DataFrame:
    """The address counts under the names the model was trained with."""
    return df.withColumns({f"{n}_ip_cnts": F.col(f"{n}_ip_cnt") for n in ("max", "avg", "stdev")})


def train_risk(
    spark: SparkSession,
    table: str,
    artefacts: str,
    target: str,
    dt: str,
    features: Features = sets.RISK,
    learner: Learner = sets.RISK_LEARNER,
    rows: DataFrame | None = None,
) -> tuple[Trained, DataFrame]:
    """Train on 70 % of the accounts, report the rest and the sweep, score everyone."""
    if rows is None:
        rows = with_ip_names(risk_rows(scan_day(spark, table, day(dt))))
    training, test = hash_split(rows, "uid", SPLIT, salt="split:")
    training = downsample_negatives(training, "uid", features.label, NEGATIVES_PER_CASE)
    trained = train_and_report(training, test, features, learner, plain_names=True)
    sweep = threshold_sweep(trained.held_out, sets.RISK_THRESHOLDS, features.label)
    save_model(trained.model, artefacts, "risk", dt)
    write_scores(score(trained.model, rows, ["uid"]), target, ["uid"], day(dt))
    return trained, sweep


def payer_rows(features: DataFrame, orders: DataFrame, dt: str) -> DataFrame:
    """The accounts that placed an order, with the derived columns the model reads."""
    payers = orders.select(F.col("userid").cast("string").alias("uid"))
    derived = {
        "is_nick_modifys": F.col("is_nick_modify").cast("string"),
        "reg_day": days_between(F.lit(day(dt)), "regtime"),
    }
    return with_ip_names(risk_rows(keep_known(features, payers, "uid")).withColumns(derived))


def scoring_rows(spark: SparkSession, table: str, orders: str, dt: str) -> DataFrame:
    """The day's payers with their derived columns; the order table's days have the compact format."""
    paid = scan_day(spark, orders, day(dt, 0, COMPACT))
    return payer_rows(scan_day(spark, table, day(dt)), paid, dt)


def score_risk(
    spark: SparkSession, table: str, orders: str, artefacts: str, target: str, dt: str, model_dt: str
) -> DataFrame:
    """Score the accounts that paid on the day."""
    rows = scoring_rows(spark, table, orders, dt)
    model = load_model(PipelineModel, artefacts, "risk", model_dt)
    write_scores(score(model, rows, ["uid"]), target, ["uid"], day(dt))
    return scan_day(spark, target, day(dt))
