"""Profile models: who talks or sings much, from twelve profile fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.values import threshold_label
from pulsetrail.operators.cleaning import require_all
from pulsetrail.operators.encoding import (
    SPARSE_PROFILE_WIDTH,
    ordinal_profile,
    positions_to_vector,
    sparse_profile,
)
from pulsetrail.operators.evaluation import accuracy, auc, precision_by_threshold
from pulsetrail.operators.models import chi_square_test, select_features, train, weights
from pulsetrail.operators.pipelines import Features, Learner, classifier
from pulsetrail.operators.sampling import downsample_negatives, hash_split
from pulsetrail.plans import feature_sets as sets
from pulsetrail.plans.training import Trained, train_and_report
from pulsetrail.functions.vectors import to_vector
from pulsetrail.session import stage
from pulsetrail.sources.formats import read_libsvm, write_libsvm
from pyspark.ml import Pipeline

SPLIT = (0.7, 0.3)


def labelled_profiles(df: DataFrame, measure: str, bar: float) -> DataFrame:
    """Users with a complete profile, labelled by a threshold on a duration."""
    return require_all(df, sets.PROFILE_FIELDS).withColumn("label", threshold_label(measure, bar))


def train_profile(
    df: DataFrame,
    measure: str = "talk_dr",
    bar: float = sets.TALK_BAR,
    features: Features = sets.PROFILE,
    learner: Learner = sets.PROFILE_TREES,
    negatives: float | None = None,
    key: str = "hdid",
) -> Trained:
    """Train on 70 % of the users, optionally with fewer negatives; test on the rest as they are."""
    training, test = hash_split(labelled_profiles(df, measure, bar), key, SPLIT, salt="split:")
    if negatives is not None:
        training = downsample_negatives(training, key, features.label, negatives)
    return train_and_report(training, test, features, learner, plain_names=True)


def profile_relations(df: DataFrame, measure: str = "talk_dr", bar: float = sets.TALK_BAR) -> DataFrame:
    """Chi-square test of every coded profile field against the label."""
    rows = labelled_profiles(df, measure, bar).withColumn("features", to_vector(ordinal_profile()))
    return chi_square_test(rows, "features", "label")


def strongest_fields(
    df: DataFrame, measure: str = "talk_dr", bar: float = sets.TALK_BAR, top: int = 1
) -> DataFrame:
    """The rows with the ``top`` coded fields that relate most to the label."""
    rows = labelled_profiles(df, measure, bar).withColumn("features", to_vector(ordinal_profile()))
    return select_features(rows, "features", "label", top)


def train_sparse_profile(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    measure: str = "sing_dr",
    bar: float = sets.SING_BAR,
    learner: Learner = sets.PROFILE_PLAIN_LOGISTIC,
) -> dict[str, DataFrame]:
    """Export the users that sing at all as libSVM rows, train on the export, report on it."""
    rows = labelled_profiles(df.where(F.col(measure) > 0), measure, bar)
    vectors = positions_to_vector(sparse_profile(), SPARSE_PROFILE_WIDTH)
    write_libsvm(rows.select("label", vectors.alias("features")), path)
    data = read_libsvm(spark, path, SPARSE_PROFILE_WIDTH)
    model = train(data, Pipeline(stages=[classifier(learner, Features())]))
    scored = stage(model.transform(data).select("label", "prediction"), "scored")
    return {
        "accuracy": accuracy(scored),
        "auc": auc(scored, score="prediction"),
        "precision": precision_by_threshold(scored, score="prediction"),
        "weights": weights(model, data),
    }
