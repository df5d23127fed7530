"""Certificates of fitted models: conditions at the optimum that rows can be checked against."""

from __future__ import annotations

from typing import Any

from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.vectors import positive_probability
from pulsetrail.operators import factors
from pulsetrail.operators.joins import lookup_join
from pulsetrail.operators.recommend import MOST_FOR_SPARK, RATINGS_A_BLOCK, factor_blocks


def logistic_gaps(model: Any, scored: DataFrame) -> DataFrame:
    """``(slot, weight, gap)`` of a binary logistic model on its scored training rows.

    ``gap`` is by how much the weight misses the condition of the optimum, on features scaled to unit
    deviation: the gradient of the mean loss and the penalty must cancel, or be within the penalty
    where the weight is zero. Slot -1 is the intercept, if there is one.
    """
    strength, mix = model.getRegParam(), model.getElasticNetParam()
    error = positive_probability(model.getProbabilityCol()) - F.col(model.getLabelCol())
    slots = scored.select(error.alias("e"), F.posexplode(vector_to_array(model.getFeaturesCol())).alias("slot", "x"))
    slots = slots.groupBy("slot").agg(F.avg(F.col("e") * F.col("x")).alias("g"), F.stddev_samp("x").alias("sd"))
    weights = scored.sparkSession.createDataFrame(
        [(i, float(w)) for i, w in enumerate(model.coefficients.toArray())], "slot int, weight double"
    )
    scaled, slope = F.col("weight") * F.col("sd"), F.col("g") / F.col("sd")
    pull = slope + F.lit(strength * (1 - mix)) * scaled
    bound = F.lit(strength * mix)
    missing = F.when(F.col("weight") == 0, F.greatest(F.abs(pull) - bound, F.lit(0.0))).otherwise(
        F.abs(pull + bound * F.signum("weight"))
    )
    gap = F.when(F.coalesce(F.col("sd"), F.lit(0.0)) == 0, F.lit(0.0)).otherwise(missing)
    found = slots.join(F.broadcast(weights), "slot").select("slot", "weight", gap.alias("gap"))
    if model.getFitIntercept():
        own = scored.agg(F.lit(-1).alias("slot"), F.lit(float(model.intercept)).alias("weight"), F.abs(F.avg(error)).alias("gap"))
        found = found.unionByName(own)
    return found


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def factor_gaps(
    model: ALSModel, ratings: DataFrame, implicit: bool, strength: float, alpha: float = 1.0,
    most_for_joins: int = MOST_FOR_SPARK,
) -> DataFrame:
    """``(userId, gap)``: by how much the factors of each user miss their normal equation, relative to
    its right side.

    The users are solved last, so theirs holds for the factors of the items that are stored. The Gram
    matrix of the items, the square of the rank, is all that the driver holds. Up to ``most_for_joins``
    ratings are joined to the factors; of more, blocks of users are sent the factors that they need.
    """
    rank = model.rank
    count = ratings.count()
    if count > most_for_joins:
        rows = factors.checked(ratings, "userId", "itemId", "rating")
        blocks = factor_blocks(count, RATINGS_A_BLOCK)
        return factors.gaps(model.userFactors, model.itemFactors, rows, blocks, rank, strength, alpha if implicit else None)
    as_double = lambda c: F.col(c).cast("array<double>")
    items = model.itemFactors.select(F.col("id").alias("itemId"), as_double("features").alias("y"))
    users = model.userFactors.select(F.col("id").alias("userId"), as_double("features").alias("x"))
    both = lookup_join(lookup_join(ratings, items, "itemId", "inner"), users, "userId", "inner")
    r = F.col("rating").cast("double")
    trust = F.abs(r) * alpha if implicit else F.lit(1.0)
    wanted = F.when(r > 0, 1.0 + trust).otherwise(0.0) if implicit else r
    counted = F.count_if(r > 0) if implicit else F.count("*")
    part = trust * _dot(F.col("x"), F.col("y"))
    sums = both.groupBy("userId").agg(
        F.first("x").alias("x"), counted.alias("n"),
        F.array(*[F.sum(part * F.col("y")[i]) for i in range(rank)]).alias("left"),
        F.array(*[F.sum(wanted * F.col("y")[i]) for i in range(rank)]).alias("right"),
    )
    left = F.zip_with("left", "x", lambda a, x: a + x * F.col("n") * strength)
    if implicit:
        gram = items.agg(F.array(*[
            F.array(*[F.sum(F.col("y")[i] * F.col("y")[j]) for j in range(rank)]) for i in range(rank)
        ])).first()[0]
        rows = [_dot(F.array(*[F.lit(v) for v in row]), F.col("x")) for row in gram]
        left = F.zip_with(left, F.array(*rows), lambda a, b: a + b)
    off = F.zip_with(left, "right", lambda a, b: a - b)
    size = F.greatest(_dot(F.col("right"), F.col("right")), F.lit(1e-12))
    return sums.select("userId", F.sqrt(_dot(off, off) / size).alias("gap"))


def boosting_losses(model: Any, rows: DataFrame) -> DataFrame:
    """``(round, loss, before, prior)`` of a boosted classifier on its training rows, features included.

    ``loss`` is the mean loss after each round, ``before`` the one after the round before it, and
    ``prior`` that of the best constant.
    """
    losses = model.evaluateEachIteration(rows)
    spark = rows.sparkSession
    p = F.avg(F.col(model.getLabelCol()).cast("double"))
    prior = rows.agg((-2 * (p * F.log(p) + (1 - p) * F.log(1 - p))).alias("prior"))
    before = [None, *losses[:-1]]
    table = spark.createDataFrame(
        [(n + 1, float(loss), b) for n, (loss, b) in enumerate(zip(losses, before))],
        "round int, loss double, before double",
    )
    return table.withColumn("prior", prior.scalar())
