"""Numbering, running totals and top rows without a window that pulls all rows into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.session import stage

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number within a partition in 33 bits


def _names(columns: Sequence[str] | str) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Add, per row, the sum of each ``totals`` expression over its group up to and with this row.

    ``order`` must be unique within a group. The rows are range-partitioned by group and order, so a
    group of any size is spread over many tasks; each task sums its own stretch, and the sums of the
    earlier stretches of the same group are added afterwards. At most one group runs across each
    border between two range partitions, so the table of those sums has fewer rows than there are
    partitions and is safe to broadcast.
    """
    groups = _names(groups)
    keys = ["_part", *groups]
    spread = df.select("*", *[expr.alias(f"_v_{name}") for name, expr in totals.items()])
    spread = spread.repartitionByRange(*[F.col(g) for g in groups], *order)
    spread = stage(spread.withColumn("_part", F.spark_partition_id()), "stretches")

    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = spread.select("*", *[F.sum(f"_v_{n}").over(upto).alias(n) for n in totals])

    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        spread.groupBy(*keys)
        .agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            *[F.sum(f"_s_{n}").over(before).alias(f"_b_{n}") for n in totals],
            F.count(F.lit(1)).over(before).alias("_stretches"),
        )
        .where("_stretches > 0")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = local.join(F.broadcast(earlier), same, "left")
    return joined.select(
        *df.columns,
        *[(F.col(n) + F.coalesce(F.col(f"_b_{n}"), F.lit(0))).alias(n) for n in totals],
    )


def positions(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "position"
) -> DataFrame:
    """Add the 0-based place of each row within its group; ``order`` must be unique in the group."""
    counted = running_totals(df, order, {name: F.lit(1).cast("long")}, groups)
    return counted.withColumn(name, F.col(name) - 1)


def dense_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "id", start: int = 0
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the given (unique) order.

    One range shuffle and a sort inside each partition; a row's number is its place in the partition
    plus the sizes of the partitions before it. The table of sizes has one row per partition.
    """
    ordered = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = df.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    placed = stage(placed.withColumn("_place", F.monotonically_increasing_id()), "placed")
    placed = placed.select(
        *df.columns,
        F.shiftright("_place", _LOCAL_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_local"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_local") + F.lit(start)).cast("long").alias(name)
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key in the given order.

    Spark cuts every key to one row per map task before the shuffle, so a hot key stays small.
    """
    window = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in the given order (each task keeps its own ``k`` before the merge)."""
    return df.orderBy(*order).limit(k)
