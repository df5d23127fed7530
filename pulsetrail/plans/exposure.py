"""Response to an exposure: one row per user, stratified sample, both arms scored."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.dates import day, dormant
from pulsetrail.functions.values import default_to
from pulsetrail.operators.cleaning import class_counts, fill_defaults
from pulsetrail.operators.models import score_arms
from pulsetrail.operators.ordering import first_per_key
from pulsetrail.operators.pipelines import Features, Learner
from pulsetrail.operators.sampling import EXPOSURE_RATES, sample_strata
from pulsetrail.plans import feature_sets as sets
from pulsetrail.plans.training import SCORE_TYPES, Trained, train_and_report
from pulsetrail.session import stage
from pulsetrail.sources.artefacts import load_model, save_model
from pulsetrail.sources.tables import project_to, scan_day, scan_range, write_partitions

FLAG = "is_exposure_v2"
DORMANT_DAYS = 3
# Fixed value: the types of the two-arm scores.
ARM_SCHEMA = {"hdid": "string", FLAG: "string", **SCORE_TYPES, "dtype": "string"}


def named(df: DataFrame) -> DataFrame:
    """Lists and age without nulls, under the names the model reads."""
    return df.withColumns(
        {"applists": default_to("applist", ""), "age_filled": default_to("age", "other")}
    )


def with_events(users: DataFrame, events: DataFrame, features: Features) -> DataFrame:
    """Attach the event lists that the model reads, of the same user and day; none is an empty list.

    A user's day that occurs several times in ``events`` has the largest of its lists, so no user row
    is multiplied. A model that reads no list needs no join.
    """
    read = [c for c in sets.EXPOSURE_EVENT_LISTS if c in features.columns()]
    if not read:
        return users
    lists = events.groupBy("hdid", "dt").agg(*[F.max(c).alias(c) for c in read])
    return fill_defaults(users.join(lists, ["hdid", "dt"], "left"), dict.fromkeys(read, ""))


def one_row_per_user(df: DataFrame) -> DataFrame:
    """Dormant users only; of several days the exposed one counts, then the earliest."""
    idle = df.where(dormant("last_active_dt", "dt", DORMANT_DAYS))
    first = first_per_key(idle, ["hdid"], [F.desc(FLAG), F.asc("dt")])
    return first.withColumn(FLAG, F.col(FLAG).cast("int"))


def training_rows(
    spark: SparkSession,
    table: str,
    events: str,
    first: str,
    last: str,
    features: Features = sets.EXPOSURE,
    rates: dict[tuple, float] = EXPOSURE_RATES,
) -> DataFrame:
    """One row per dormant user of a range of days, with its event lists; a sample by stratum."""
    users = named(one_row_per_user(scan_range(spark, table, first, last)))
    rows = with_events(users, scan_range(spark, events, first, last), features)
    return sample_strata(rows, "hdid", [FLAG, features.label], rates)


def train_exposure(
    spark: SparkSession,
    table: str,
    events: str,
    artefacts: str,
    dt: str,
    first: str,
    last: str,
    test_dt: str,
    features: Features = sets.EXPOSURE,
    learner: Learner = sets.EXPOSURE_LEARNER,
    rates: dict[tuple, float] = EXPOSURE_RATES,
) -> tuple[Trained, DataFrame]:
    """Train on a stratified sample of a range of days; also returns the sample's class counts."""
    sampled = stage(training_rows(spark, table, events, first, last, features, rates), "sampled")
    test = named(scan_day(spark, table, test_dt)).withColumn(FLAG, F.col(FLAG).cast("int"))
    test = with_events(test, scan_day(spark, events, test_dt), features)
    trained = train_and_report(sampled, test, features, learner)
    save_model(trained.model, artefacts, "exposure", dt)
    return trained, class_counts(sampled, [features.label, FLAG])


def score_exposure(
    spark: SparkSession,
    table: str,
    events: str,
    artefacts: str,
    target: str,
    dt: str,
    model_dt: str,
    features: Features = sets.EXPOSURE,
) -> DataFrame:
    """Score every user of a day as exposed and as not exposed; one partition per arm."""
    users = named(scan_day(spark, table, day(dt)))
    rows = with_events(users, scan_day(spark, events, day(dt)), features)
    model = load_model(PipelineModel, artefacts, "exposure", model_dt)
    scored = score_arms(model, rows, ["hdid"], FLAG).withColumn("dtype", F.col(FLAG))
    sink = project_to(scored, ARM_SCHEMA).withColumn("dt", F.lit(day(dt)))
    write_partitions(sink, target, ["dt", "dtype"])
    return scan_day(spark, target, day(dt))
