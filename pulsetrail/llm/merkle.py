"""Merkle manifests of a dataset by slot pivots.

Rows are leaves, numbered within their tree. At each level conditional aggregates spread the children
of a parent into ``FANOUT`` slot columns: all slots put together and hashed are the parent, all slots
but one's own are its siblings. Proofs come down the same rows, from the root to the leaves: a child
takes the siblings that its parent's row shows and the path that the parent has itself, so no leaf is
joined to the levels above it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.ordering import dense_index
from pulsetrail.session import stage

FANOUT = 8
SLOTS = [f"slot{i}" for i in range(FANOUT)]
STEP = "struct<before:string,after:string>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A value in the input of a leaf: its UTF-8 byte count, ``:`` and itself, or ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts put together, in lowercase hex; null parts are left out."""
    return F.sha2(F.concat_ws("", *parts), 256)


@dataclass
class Forest:
    """Trees over ``nodes`` (tree, place, n, digest, item) and the pivoted rows of each level above."""

    nodes: DataFrame
    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """``(tree, digest)`` of the last node of each tree."""
        found = self.nodes.where("n = 1").select("tree", "digest")
        for level in self.levels:
            found = found.unionByName(level.where("n = 1").select("tree", "digest"))
        return found

    def descend(self, tops: DataFrame) -> DataFrame:
        """The nodes with what ``tops`` has for their tree, and their path.

        ``tops`` has ``tree``, ``path`` (the steps above the root of the tree) and other columns. The
        steps of a path lead from the node upwards; each holds the siblings before and after.
        """
        more = [c for c in tops.columns if c not in ("tree", "path")]
        reached = None  # (tree, place, path, more) of the nodes of the level in hand
        for level in reversed(self.levels):
            ended = level.where("n = 1").join(tops, "tree").select("tree", "place", "path", *more)
            reached = ended if reached is None else ended.unionByName(reached)
            child = F.explode(F.array(*[
                F.when(
                    F.col(slot).isNotNull(),
                    F.struct(
                        (F.col("place") * FANOUT + i).alias("place"),
                        F.col(slot).alias("node"),
                        F.struct(
                            F.concat_ws("", *[F.col(f"{s}.digest") for s in SLOTS[:i]]).alias("before"),
                            F.concat_ws("", *[F.col(f"{s}.digest") for s in SLOTS[i + 1 :]]).alias("after"),
                        ).alias("step"),
                    ),
                )
                for i, slot in enumerate(SLOTS)
            ]))
            opened = level.select("tree", "place", *SLOTS).join(reached, ["tree", "place"])
            opened = opened.select("tree", "path", *more, child.alias("child")).where("child is not null")
            reached = opened.select(
                "tree", F.col("child.place").alias("place"), F.col("child.node").alias("node"),
                F.concat(F.array("child.step"), "path").alias("path"), *more,
            )
            lowest = level is self.levels[0]
            if not lowest:
                reached = reached.drop("node")
        single = self.nodes.where("n = 1").join(tops, "tree")
        single = single.select("tree", "place", "digest", "item", "path", *more)
        if reached is None:
            return single
        return single.unionByName(
            reached.select("tree", "place", "node.digest", "node.item", "path", *more)
        )


def grow(nodes: DataFrame) -> Forest:
    """Trees over ``(tree, place, n, digest, item)``; places run from 0 to n - 1 in each tree.

    Parents are made and written level by level; the number of levels is the logarithm of the largest
    tree, and only its ``n`` comes to the driver.
    """
    size = nodes.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    below = nodes
    while size > 1:
        item = F.col("item") if not levels else F.lit(None).cast("string")
        own = F.struct(F.col("digest").alias("digest"), item.alias("item"))
        pivot = [F.max(F.when(F.col("place") % FANOUT == i, own)).alias(s) for i, s in enumerate(SLOTS)]
        parents = below.where("n > 1").groupBy("tree", F.floor(F.col("place") / FANOUT).alias("up")).agg(
            F.max(F.ceil(F.col("n") / FANOUT)).alias("up_n"), *pivot
        )
        below = stage(
            parents.select(
                "tree", F.col("up").alias("place"), F.col("up_n").alias("n"),
                digest(*[F.col(f"{s}.digest") for s in SLOTS]).alias("digest"), *SLOTS,
            ),
            "level",
        )
        levels.append(below)
        size = -(-size // FANOUT)
    return Forest(nodes, levels)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(
        path, leaf, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256)
    )


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    changed: Column | None = None,
    change: dict[str, Column] | None = None,
) -> DataFrame:
    """``(key, leaf, subroot, root, path, claimed)`` of every row: its place in the manifest.

    A leaf is the digest of ``fields``. The rows of each value of ``group`` are one tree, in the order
    of ``key``; the roots of these trees, in the order of the group, are the leaves of the top tree.
    ``path`` has a step for each level from the leaf to the root. ``claimed`` is the leaf of the row
    with the columns of ``change`` put in, where ``changed`` holds, and null elsewhere: what somebody
    else claims the row to be.

    Nulls: a null group is a tree of its own and the first one, a null key comes first. Rows with the
    same key are ordered by their leaf; equal rows are leaves of their own. An empty table has no rows
    and no root. Other columns are not read. Only one root and the size of the largest tree are
    collected; trees of any size are numbered and pivoted in parallel.
    """
    changed = F.lit(False) if changed is None else F.coalesce(changed, F.lit(False))
    values = {name: F.col(f"`{name}`") for name in fields}
    other = values | (change or {})
    rows = docs.select(
        F.col(f"`{group}`").alias("part"),
        F.col(f"`{key}`").alias("key"),
        digest(*[field(v) for v in values.values()]).alias("leaf"),
        F.when(changed, digest(*[field(other[n]) for n in fields])).alias("claimed"),
    )
    placed = dense_index(stage(rows, "leaves"), ["part", "key", "leaf", "claimed"], "at")
    parts = stage(placed.groupBy("part").agg(F.min("at").alias("first"), F.count("*").alias("n")), "parts")
    parts = stage(dense_index(parts, ["first"], "tree"), "trees")
    nodes = placed.join(parts.withColumnRenamed("part", "own"), F.col("part").eqNullSafe(F.col("own")))
    lower = grow(stage(
        nodes.select(
            "tree", (F.col("at") - F.col("first")).alias("place"), "n", F.col("leaf").alias("digest"),
            F.struct("key", "claimed").alias("item"),
        ),
        "nodes",
    ))
    subroots = stage(lower.roots(), "subroots")
    upper = grow(
        subroots.select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest",
            F.lit(parts.count()).cast("long").alias("n"), F.struct("tree").alias("item"),
        )
    )
    found = upper.roots().first()
    root = F.lit(found["digest"] if found else None).cast("string")
    top = upper.roots().select("tree", F.array().cast(f"array<{STEP}>").alias("path"))
    tops = upper.descend(top).select(
        F.col("item.tree").alias("tree"), "path", F.col("digest").alias("subroot"), root.alias("root")
    )
    return lower.descend(stage(tops, "tops")).select(
        F.col("item.key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "path",
        F.col("item.claimed").alias("claimed"),
    )


def verify(proved: DataFrame) -> DataFrame:
    """Add ``proof`` (all siblings in one digest), ``folded_root`` of the claimed or own leaf, ``verified``."""
    siblings = F.transform("path", lambda s: F.concat(s["before"], s["after"]))
    return proved.withColumn("proof", F.sha2(F.array_join(siblings, ""), 256)).withColumn(
        "folded_root", fold(F.coalesce("claimed", "leaf"), F.col("path"))
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
