"""Similar promotional materials: mean user vectors, unseen candidates, distances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.values import match_fill
from pulsetrail.operators.cleaning import fill_defaults, mean_vector, popular_items
from pulsetrail.operators.joins import keep_unseen, lookup_join, lookup_on
from pulsetrail.operators.pipelines import Features, feature_stages
from pulsetrail.operators.similarity import projection_model, similar_pairs
from pulsetrail.plans import feature_sets as sets
from pulsetrail.session import stage
from pulsetrail.sources.tables import write_partition

RANKED_DEVICES = 30
CANDIDATES = 50


def material_rows(
    users: DataFrame, device_ranks: DataFrame, live_counts: DataFrame, app_lists: DataFrame
) -> DataFrame:
    """Users with a material; attributes, device model, live count and app list filled."""
    # one row per key, whatever the lists repeat
    devices = device_ranks.where(F.col("rank") <= RANKED_DEVICES)
    devices = devices.groupBy(F.lower("sjp").alias("_device")).agg(F.min("sjp").alias("_sjp"))
    live = live_counts.groupBy("hdid").agg(F.max("live_cnt").alias("_live"), F.lit(1).alias("_in_live"))
    apps = app_lists.groupBy("hdid").agg(F.max("applist").alias("_apps"), F.lit(1).alias("_in_apps"))
    joined = users.where(F.col("mate_id").isNotNull())
    joined = lookup_on(joined, devices, F.lower("sjp"), F.col("_device")).drop("_device")
    joined = lookup_join(joined, live, "hdid")
    joined = lookup_join(joined, apps, "hdid")
    filled = joined.withColumns(
        {
            "applists": match_fill("_apps", "_in_apps", ""),
            "sjp": match_fill("_sjp", "_sjp", "other"),
            "live_cnt": match_fill("_live", "_in_live", 1),
        }
    ).drop("_sjp", "_live", "_in_live", "_apps", "_in_apps")
    return fill_defaults(filled, {**dict.fromkeys(sets.MATERIAL.numeric, 0), **sets.MATERIAL_DEFAULTS})


def scaled_features(rows: DataFrame, features: Features = sets.MATERIAL) -> DataFrame:
    """The assembled feature vector, every element scaled to [0, 1]."""
    stages = feature_stages(features, out="unscaled")
    stages.append(MinMaxScaler(inputCol="unscaled", outputCol="features"))
    return Pipeline(stages=stages).fit(rows).transform(rows)


def unseen_materials(users: DataFrame, retained: DataFrame, k: int = CANDIDATES) -> DataFrame:
    """The ``k`` materials with the most users among those without any retention record."""
    return popular_items(keep_unseen(users, retained, "mate_id"), "mate_id", "hdid", k)


def similar_materials(
    rows: DataFrame,
    everyone: DataFrame,
    retained: DataFrame,
    seeds: Sequence[str],
    dt: str,
    features: Features = sets.MATERIAL,
    tables: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Mean vectors, and the distance of the candidates to the seeds and to the target users.

    ``everyone`` links users and materials over all days, ``retained`` over the days in question;
    ``seeds`` is the given list of materials to compare with. ``tables`` names the three sinks
    (``means``, ``pairs``, ``target``) when the results are to be written.
    """
    kept = ["mate_id", "is_low_cost_retain", "is_profit_retain"]
    read = stage(rows.select(*dict.fromkeys([*kept, *features.columns()])), "material-rows")
    vectors = stage(scaled_features(read, features).select(*kept, "features"), "vectors")
    means = stage(mean_vector(vectors, ["mate_id"], "features"), "means")
    recorded = retained.where("is_low_cost_retain is not null or is_profit_retain is not null")
    candidates = unseen_materials(everyone, recorded).join(means, "mate_id").select("mate_id", "means")
    candidates = stage(candidates, "candidates")

    target = mean_vector(
        vectors.where("is_low_cost_retain = 1 or is_profit_retain = 1"), [], "features"
    ).select(F.lit("target").alias("mate_id"), "means")
    model = projection_model(means, "means")
    chosen = means.where(F.col("mate_id").isin(list(seeds)))
    results = {
        "means": means,
        "pairs": similar_pairs(model, candidates, chosen, "mate_id"),
        "target": similar_pairs(model, candidates, target, "mate_id").select("idA", "dist"),
    }
    for name, path in (tables or {}).items():
        write_partition(results[name], path, dt=dt)
    return results
