"""Click and retention models on user-item feature snapshots."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

from pulsetrail.functions.dates import day
from pulsetrail.operators.models import score
from pulsetrail.operators.pipelines import Features, Learner
from pulsetrail.operators.recommend import item_vectors
from pulsetrail.operators.sampling import downsample_negatives, sample_rows
from pulsetrail.plans import feature_sets as sets
from pulsetrail.plans.training import Trained, train_and_report, write_scores
from pulsetrail.sources.artefacts import load_model, save_model
from pulsetrail.sources.tables import scan_day, scan_days

NEGATIVES_PER_CLICK = 20
KEYS = ["hdid", "doc_id"]


def _row_key(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", "concat_ws('|', hdid, doc_id, dt) as row_key")


def training_rows(spark: SparkSession, table: str, dt: str) -> DataFrame:
    """Five weekly snapshots of shown items with a title; about twenty rows without a click for each with one."""
    rows = scan_days(spark, table, dt, sets.CLICK_SNAPSHOTS).dropna(subset=["title_length"])
    return downsample_negatives(_row_key(rows), "row_key", "label", NEGATIVES_PER_CLICK)


def train_click(
    spark: SparkSession,
    table: str,
    artefacts: str,
    dt: str,
    vectors: tuple[DataFrame, ALSModel] | None = None,
    features: Features | None = None,
    learner: Learner = sets.CLICK_LEARNER,
) -> Trained:
    """Train on five weekly snapshots, test on the day ten days before, save the pipeline.

    With ``vectors`` (an item index and a factor model) the item's factors are a feature too.
    """
    features = features or (sets.CLICK_VECTOR if vectors else sets.CLICK)
    rows = training_rows(spark, table, dt)
    test = scan_day(spark, table, day(dt, sets.CLICK_TEST_OFFSET)).dropna(subset=["title_length"])
    if vectors:
        rows, test = (item_vectors(df, "doc_id", *vectors) for df in (rows, test))
    trained = train_and_report(rows, test, features, learner)
    save_model(trained.model, artefacts, "click_vector" if vectors else "click", dt)
    return trained


def train_retention(
    spark: SparkSession,
    table: str,
    dt: str,
    test_dt: str,
    vectors: tuple[DataFrame, ALSModel],
    snapshots: tuple[int, ...] = sets.CLICK_SNAPSHOTS,
    features: Features = sets.RETENTION,
    learner: Learner = sets.RETENTION_LEARNER,
) -> Trained:
    """Retention after a click: half of the rows at random, with the item's factors."""
    rows = scan_days(spark, table, dt, snapshots).dropna(subset=["title_length"])
    rows = sample_rows(_row_key(rows), "row_key", 0.5)
    test = scan_day(spark, table, test_dt).dropna(subset=["title_length"])
    rows, test = (item_vectors(df, "doc_id", *vectors) for df in (rows, test))
    return train_and_report(rows, test, features, learner)


def score_click(
    spark: SparkSession,
    table: str,
    artefacts: str,
    target: str,
    dt: str,
    lag: int = 0,
    vectors: tuple[DataFrame, ALSModel] | None = None,
) -> DataFrame:
    """Score one day with the pipeline trained ``lag`` days earlier and replace that day's scores."""
    name = "click_vector" if vectors else "click"
    model = load_model(PipelineModel, artefacts, name, dt, lag)
    rows = scan_day(spark, table, day(dt))
    if vectors:
        rows = item_vectors(rows, "doc_id", *vectors)
    scored = score(model, rows, KEYS).withColumnRenamed("doc_id", "docid")
    write_scores(scored, target, ["hdid", "docid"], day(dt))
    return scan_day(spark, target, day(dt))
