"""Risk groups: accounts that hang together through shared phones and identity numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.dates import day
from pulsetrail.operators.graph import (
    Relation,
    component_members,
    connected_components,
    index_vertices,
    resolve_edges,
    typed_edges,
    typed_vertices,
)
from pulsetrail.session import stage, staged
from pulsetrail.sources.tables import project_to, scan_day, write_partition

# Fixed value: the columns of the group table.
GROUP_SCHEMA = {"vertices": "string", "types": "string", "categoryid": "bigint"}


def group_members(relations: Sequence[Relation]) -> DataFrame:
    """``(value, type, component)`` of every entity in the relations."""
    index = stage(index_vertices(typed_vertices(relations)), "vertex-index")
    edges = resolve_edges(typed_edges(relations), index)
    return component_members(index, connected_components(index, edges))


def write_risk_groups(
    spark: SparkSession, phones: str, identities: str, target: str, dt: str
) -> DataFrame:
    """Group the accounts of a day and replace that day's groups."""
    relations = [
        Relation(scan_day(spark, phones, day(dt)), "mobile", "mobile", "uid", "uid", "mobile_conn"),
        Relation(scan_day(spark, identities, day(dt)), "idnum", "idnum", "uid", "uid", "idnum_conn"),
    ]
    with staged(spark):
        groups = group_members(relations).select(
            F.col("value").alias("vertices"),
            F.col("type").alias("types"),
            F.col("component").alias("categoryid"),
        )
        write_partition(project_to(groups, GROUP_SCHEMA), target, dt=day(dt))
    return scan_day(spark, target, day(dt))
