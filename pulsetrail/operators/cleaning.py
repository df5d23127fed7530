"""Row cleaning and plain aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.ordering import positions, top_k


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls, column by column; the types stay, and NaN is a value like any other."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value).cast(kinds[c])) for c, value in defaults.items()}
    )


def require_all(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.dropna(how="any", subset=list(columns))


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def class_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("cnt"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positives, negatives and their ratio in one pass."""
    counts = df.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return counts.select("pos", "neg", F.try_divide(F.col("pos").cast("double"), "neg").alias("ratio"))


def popular_items(df: DataFrame, item: str, user: str, k: int) -> DataFrame:
    """The ``k`` items with the most distinct users; ties go to the smaller item."""
    counts = df.where(F.col(item).isNotNull()).groupBy(item)
    counts = counts.agg(F.countDistinct(user).alias("users"))
    return top_k(counts, [F.desc("users"), F.asc(item)], k)


def baskets(
    df: DataFrame, user: str, item: str, day: str, chunk: int = 1000, at_least: int = 2
) -> DataFrame:
    """``(user, part, items)``: what each user took, one entry per item and day, in that order.

    Users with fewer than ``at_least`` entries are dropped. A long basket comes as several rows of
    ``chunk`` items, which is where the embedding cuts its sentences too; so no user, however
    active, is gathered into one row or one task.
    """
    taken = df.select(user, item, day).distinct()
    placed = positions(taken, [user], [F.col(day), F.col(item)], "place")
    parts = placed.groupBy(user, F.floor(F.col("place") / chunk).alias("part")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("place", item))), lambda entry: entry[item]
        ).alias("items")
    )
    return parts.where((F.size("items") >= at_least) | (F.col("part") > 0))


def mean_vector(df: DataFrame, by: Sequence[str], vector: str) -> DataFrame:
    """The mean of a vector (or numeric array) column, per group or over all rows."""
    kind = df.schema[vector].dataType.typeName()
    values = array_to_vector(F.col(vector).cast("array<double>")) if kind == "array" else F.col(vector)
    return df.groupBy(*by).agg(Summarizer.mean(values).alias("means"))


def elements(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """One row per vector element: keys, ``dim``, ``value``."""
    return df.select(*keys, F.posexplode(vector_to_array(vector)).alias("dim", "value"))


def minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale columns to [0, 1] over all rows; a constant column becomes 0.5."""
    bounds = df.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        ).alias("bounds")
    ).scalar()

    def scaled(name: str) -> Column:
        low, high = F.col(f"_bounds.lo_{name}"), F.col(f"_bounds.hi_{name}")
        return F.when(high == low, 0.5).otherwise((F.col(name) - low) / (high - low))

    # a column of its own, so that the bounds are computed once and not per use
    beside = df.withColumn("_bounds", bounds)
    return beside.withColumns({c: scaled(c) for c in columns}).drop("_bounds")


def array_difference(a: Column | str, b: Column | str) -> Column:
    """Keys of map ``a`` that map ``b`` lacks."""
    return F.array_except(F.map_keys(a), F.map_keys(b))


def merge_lowest(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The union of two keyed tables, with the lowest value of each key."""
    return a.unionByName(b).groupBy(*keys).agg(F.min(value).alias(value))
