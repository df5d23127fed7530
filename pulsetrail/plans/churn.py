"""Churn model on user feature snapshots."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from pulsetrail.functions.dates import day
from pulsetrail.operators.models import score
from pulsetrail.operators.pipelines import Features, Learner
from pulsetrail.operators.sampling import two_stage_sample
from pulsetrail.plans import feature_sets as sets
from pulsetrail.plans.training import Trained, train_and_report, write_scores
from pulsetrail.sources.artefacts import load_model, save_model
from pulsetrail.sources.tables import scan_day, scan_days


def training_rows(
    spark: SparkSession, table: str, dt: str, label: str = sets.CHURN.label
) -> DataFrame:
    """Four snapshots of every user, half of them at random, then fewer negatives than positives."""
    rows = scan_days(spark, table, dt, sets.CHURN_SNAPSHOTS)
    rows = rows.selectExpr("*", "concat_ws('|', hdid, dt) as row_key")
    return two_stage_sample(rows, "row_key", label)


def train_churn(
    spark: SparkSession,
    table: str,
    artefacts: str,
    target: str,
    dt: str,
    test_offset: int = sets.CHURN_TEST_OFFSET,
    features: Features = sets.CHURN,
    learner: Learner = sets.CHURN_LEARNER,
) -> Trained:
    """Train on four snapshots, test on a later day, save the pipeline and the tested scores."""
    sampled = training_rows(spark, table, dt, features.label)
    test = scan_day(spark, table, day(dt, test_offset))
    trained = train_and_report(sampled, test, features, learner, keys=["hdid"])
    save_model(trained.model, artefacts, "churn", dt)
    write_scores(trained.held_out, target, ["hdid"], day(dt), with_label=features.label)
    return trained


def score_churn(
    spark: SparkSession,
    table: str,
    artefacts: str,
    target: str,
    dt: str,
    lag: int = sets.CHURN_MODEL_LAG,
) -> DataFrame:
    """Score one day with an older pipeline and replace that day's scores."""
    model = load_model(PipelineModel, artefacts, "churn", dt, lag)
    scored = score(model, scan_day(spark, table, day(dt)), ["hdid"])
    write_scores(scored, target, ["hdid"], day(dt))
    return scan_day(spark, target, day(dt))
