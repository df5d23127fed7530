"""Joins: key-set filters, look-ups with defaults, expression keys, bounded candidate lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.session import stage

HOT_KEYS = 1_000  # at most so many keys are spread by hand
SALTS = 64  # parts that such a key is spread over
MOST_CANDIDATES = 1_000


def _names(columns: Sequence[str] | str) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: Sequence[str] | str,
    how: str = "left",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``facts`` to ``table`` (one row per key), safe for keys that hold most of the facts.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``; in all of them Spark may split the
    facts of a partition, so the adaptive skew join takes hot keys apart at run time, from the sizes
    it has measured. Nothing is counted beforehand and the facts are read once.

    Where adaptive execution is off or its thresholds do not fit, ``hot_rows`` spreads keys by hand:
    one pass finds the (at most ``HOT_KEYS``) keys with that many facts, and the join itself deals
    their facts over ``SALTS`` parts and copies their rows of the table to each part. Facts without
    a key are dealt out too, as they match nothing.
    """
    on = _names(on)
    if hot_rows is None:
        return facts.join(table, on, how)
    hot = facts.dropna(subset=on).groupBy(*on).count().where(F.col("count") >= hot_rows)
    hot = stage(hot.orderBy(F.desc("count"), *on).limit(HOT_KEYS).select(*on), "hot-keys")
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    no_key = F.expr(" or ".join(f"`{c}` is null" for c in on))
    dealt = facts.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot") | no_key, part).otherwise(0))
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = table.join(hot, on, "left").withColumn("_salt", F.explode(parts))
    joined = dealt.drop("_hot").join(copied.drop("_hot"), [*on, "_salt"], how)
    return joined.drop("_salt")


def keep_known(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key occurs in ``keys``. The keys are made distinct before they are shuffled."""
    return lookup_join(df, keys.select(*_names(on)).distinct(), on, "left_semi")


def keep_unseen(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return lookup_join(df, keys.select(*_names(on)).distinct(), on, "left_anti")


def lookup_on(
    facts: DataFrame,
    table: DataFrame,
    fact_key: Column,
    table_key: Column,
    how: str = "left",
) -> DataFrame:
    """Look-up on an expression of both sides, such as ``lower(a) = lower(b)``."""
    keyed = table.withColumn("_key", table_key)
    return lookup_join(facts.withColumn("_key", fact_key), keyed, "_key", how).drop("_key")


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str] | str, defaults: Mapping[str, Any]
) -> DataFrame:
    """Left look-up that gives ``defaults`` to the rows whose key the table lacks.

    A key that is present with a null value keeps its null: the default marks an unknown key only.
    """
    marked = table.withColumn("_known", F.lit(True))
    joined = lookup_join(df, marked, on)
    filled = {
        name: F.when(F.col("_known").isNull(), value if isinstance(value, Column) else F.lit(value))
        .otherwise(F.col(name))
        for name, value in defaults.items()
    }
    return joined.withColumns(filled).drop("_known")


def with_candidate_table(df: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pair every row with each row of a short table, such as a report: one narrow step, no join.

    The table may have at most MOST_CANDIDATES rows; a longer one is an error, not a long list.
    """
    if candidates.limit(MOST_CANDIDATES + 1).count() > MOST_CANDIDATES:
        raise ValueError(f"more than {MOST_CANDIDATES} candidates")
    entries = candidates.agg(F.sort_array(F.collect_list(F.struct(*candidates.columns)))).scalar()
    paired = df.withColumn("_candidate", F.explode(entries))
    return paired.select(*df.columns, *[F.col(f"_candidate.{c}").alias(c) for c in candidates.columns])


def with_candidates(df: DataFrame, candidates: Sequence[Any], name: str) -> DataFrame:
    """Pair every row with each entry of a given list: one narrow step, no join, no shuffle.

    The list is a job argument and therefore small; pairing two whole tables is not offered.
    """
    return df.withColumn(name, F.explode(F.array(*[F.lit(c) for c in candidates])))
