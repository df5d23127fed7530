"""The flow all training jobs share: fit, report on training and held-out rows, write scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.vectors import positive_probability
from pulsetrail.operators.evaluation import auc, confusion
from pulsetrail.operators.models import train
from pulsetrail.operators.pipelines import Features, Learner, build_pipeline
from pulsetrail.session import stage
from pulsetrail.sources.tables import project_to, write_partition

# The types of the score columns.
SCORE_TYPES = {"prediction": "double", "probability": "double"}


@dataclass(frozen=True)
class Trained:
    """A fitted pipeline, its reports (one row each) and the scored held-out rows."""

    model: PipelineModel
    reports: DataFrame
    aucs: DataFrame
    held_out: DataFrame


def evaluated(
    model: PipelineModel, df: DataFrame, label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Keys, label, ``prediction`` and P(positive), computed once for all the reports."""
    scored = model.transform(df).select(
        *keys,
        F.col(label).cast("int").alias(label),
        "prediction",
        positive_probability().alias("probability"),
    )
    return stage(scored, "scored")


def train_and_report(
    training: DataFrame,
    held_out: DataFrame,
    features: Features,
    learner: Learner,
    plain_names: bool = False,
    keys: Sequence[str] = (),
) -> Trained:
    """Fit on ``training``; confusion and AUC on both parts, by the label that was trained on.

    Only the feature columns and the label of the training rows are read and staged; the held-out
    rows keep ``keys`` beside their scores.
    """
    training = stage(training.select(features.label, *features.columns()), "training")
    model = train(training, build_pipeline(features, learner))
    parts = {
        "trained": evaluated(model, training, features.label),
        "test": evaluated(model, held_out, features.label, keys),
    }
    reports = [confusion(df, tag, features.label, plain=plain_names) for tag, df in parts.items()]
    aucs = [auc(df, features.label).withColumn("type", F.lit(tag)) for tag, df in parts.items()]
    return Trained(
        model, reports[0].unionByName(reports[1]), aucs[0].unionByName(aucs[1]), parts["test"]
    )


def write_scores(
    scored: DataFrame, path: str, keys: Sequence[str], dt: str, with_label: str | None = None
) -> None:
    """Replace one day of a score table: keys as strings, prediction, P(positive)."""
    schema = dict.fromkeys(keys, "string")
    schema["prediction"] = SCORE_TYPES["prediction"]
    if with_label:
        schema[with_label] = "int"
    schema["probability"] = SCORE_TYPES["probability"]
    write_partition(project_to(scored, schema), path, dt=dt)
