"""Principal axes of wide sparse rows by subspace iteration: the covariance is never built.

Rows are ``(row, slot, value)`` entries; an entry that is not there is zero. A round multiplies the
centred rows by a narrow matrix and the result by the rows again, each a join and an aggregate, and
makes the columns orthonormal by the Cholesky factor of their Gram matrix. The driver holds square
matrices of the width of the result only, whatever the number of slots.

Up to ``FEW`` slots the products of each row with itself are added up once, and the rounds need the
rows no more: one shuffle of the entries instead of three a round.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.joins import lookup_join
from pulsetrail.session import discard, stage

ROUNDS = 12
FEW = 32  # slots whose products with each other, at most so many squared, are summed beforehand
EXTRA = 4  # columns more than asked for, which make the axes converge sooner
SEED = 11


@dataclass
class Axes:
    """``axes`` is ``(slot, axis)`` with an array of the k loadings; ``variances`` falls; ``centre`` is
    the projection of the mean, which scores are relative to."""

    axes: DataFrame
    variances: list[float]
    centre: list[float]

    def scores(self, entries: DataFrame) -> DataFrame:
        """``(row, scores)`` of rows with any entry; a row without entries is at minus ``centre``."""
        found = _times(entries, self.axes, "slot", "row", len(self.centre))
        return found.select("row", F.zip_with("v", _values(self.centre), lambda x, c: x - c).alias("scores"))


def _values(numbers) -> Column:
    return F.array(*[F.lit(float(x)) for x in numbers])


def _times(entries: DataFrame, matrix: DataFrame, on: str, by: str, width: int) -> DataFrame:
    """The product of the entries (or their transpose) and a matrix of ``(on, v)``, as ``(by, v)``.

    The rows of ``matrix`` are looked up, so hot slots are split at run time; sums are made before the
    shuffle.
    """
    met = lookup_join(entries, matrix.withColumnRenamed("axis", "v"), on, "inner")
    sums = [F.sum(F.col("value") * F.col("v")[i]).alias(f"s{i}") for i in range(width)]
    return met.groupBy(by).agg(*sums).select(by, F.array(*[f"s{i}" for i in range(width)]).alias("v"))


def _gram(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the outer products and of the vectors: one aggregate of a few hundred numbers."""
    v = F.col("v")
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = vectors.agg(
        *[F.sum(v[i] * v[j]).alias(f"g{i}_{j}") for i, j in pairs], *[F.sum(v[i]).alias(f"t{i}") for i in range(width)]
    ).first()
    gram = np.zeros((width, width))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"] or 0.0
    return gram, np.array([row[f"t{i}"] or 0.0 for i in range(width)])


def _turned(vectors: DataFrame, key: str, turn: np.ndarray) -> DataFrame:
    """Each vector times a small matrix."""
    out = [
        F.aggregate(F.zip_with("v", _values(column), lambda x, t: x * t), F.lit(0.0), lambda total, x: total + x)
        for column in turn.T
    ]
    return vectors.select(key, F.array(*out).alias("v"))


def _orthonormal(vectors: DataFrame) -> DataFrame:
    """The same space with orthonormal columns; columns that depend on others are dropped."""
    for _ in range(2):  # the second time mends what rounding left of the first
        width = len(vectors.first()["v"])
        gram, _ = _gram(vectors, width)
        sizes, turns = np.linalg.eigh(gram)
        kept = sizes > max(sizes.max(), 0) * 1e-12
        vectors = stage(_turned(vectors, "slot", turns[:, kept] / np.sqrt(sizes[kept])), "axes")
    return vectors


def _products(values: DataFrame, slots: list) -> np.ndarray:
    """Sums over the rows of the products of each two of a few slots, in one shuffle of the entries."""
    at = F.element_at(F.create_map(*[x for i, s in enumerate(slots) for x in (F.lit(s), F.lit(i))]), F.col("slot"))
    placed = values.withColumn("at", at)
    sums = [F.sum(F.when(F.col("at") == i, F.col("value"))) for i in range(len(slots))]
    wide = placed.groupBy("row").agg(*[F.coalesce(x, F.lit(0.0)).alias(f"c{i}") for i, x in enumerate(sums)])
    wide = wide.select(F.array(*[f"c{i}" for i in range(len(slots))]).alias("v"))
    one = wide.select(F.posexplode("v").alias("i", "x"), "v").where("x <> 0 or isnan(x)")
    found = one.groupBy("i").agg(*[F.sum(F.col("x") * F.col("v")[j]).alias(f"p{j}") for j in range(len(slots))])
    total = np.zeros((len(slots), len(slots)))
    for row in found.collect():
        total[row["i"]] = [row[f"p{j}"] for j in range(len(slots))]
    return total


def _axes_of_few(values: DataFrame, few: list, rows: int, k: int, rounds: int) -> Axes:
    """The same iteration on the products of a few slots; ``few`` has ``(slot, mean, v)`` of each."""
    slots = [r["slot"] for r in few]
    products = _products(values, slots)
    mean, q = np.array([r["mean"] or 0.0 for r in few]), np.array([r["v"] for r in few])
    spread = products - rows * np.outer(mean, mean)
    for turn in range(rounds + 1):
        for _ in range(2):
            sizes, turns = np.linalg.eigh(q.T @ q)
            kept = sizes > max(sizes.max(), 0) * 1e-12
            q = q @ (turns[:, kept] / np.sqrt(sizes[kept]))
        if turn < rounds:
            q = spread @ q
    sizes, turns = np.linalg.eigh(q.T @ spread @ q / (rows - 1))
    best = np.argsort(-sizes)[:k]
    q = q @ turns[:, best]
    kind = values.schema["slot"].dataType.simpleString()
    axes = [(s, [float(x) for x in row]) for s, row in zip(slots, q)]
    axes = values.sparkSession.createDataFrame(axes, f"slot {kind}, axis array<double>")
    return Axes(axes, [float(max(s, 0.0)) for s in sizes[best]], [float(x) for x in mean @ q])


def principal_axes(entries: DataFrame, rows: int, k: int, rounds: int = ROUNDS, seed: int = SEED) -> Axes:
    """The ``k`` axes of greatest variance of ``rows`` rows given as ``(row, slot, value)`` entries.

    ``entries`` is read twice a round: stage it; entries of one row and slot are added up. Fewer axes
    come back where the rows span fewer dimensions; no entries give none. Null values count as zero.
    """
    if rows < 2:
        raise ValueError("two rows at least")
    width = k + EXTRA
    start = [F.xxhash64("slot", F.lit(seed), F.lit(i)) / F.lit(float(1 << 63)) for i in range(width)]
    q = stage(entries.select("slot").distinct().select("slot", F.array(*start).alias("v")), "start")
    if q.isEmpty():
        return Axes(q.withColumnRenamed("v", "axis"), [], [])
    mean = stage(entries.groupBy("slot").agg((F.sum("value") / rows).alias("mean")), "mean")
    values = entries.select("row", "slot", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
    few = mean.join(q, "slot").orderBy("slot").limit(FEW + 1).collect()
    if 0 < len(few) <= FEW:
        return _axes_of_few(values, few, rows, k, rounds)
    q = _orthonormal(q)
    for turn in range(rounds + 1):
        width = len(q.first()["v"])
        # the mean row times the matrix: what centring takes away from every product
        shift = mean.join(q, "slot").agg(*[F.sum(F.col("mean") * F.col("v")[i]) for i in range(width)]).first()
        shift = np.array([x or 0.0 for x in shift])
        product = stage(_times(values, q, "slot", "row", width), "product")
        if turn == rounds:
            break
        # rows centred times the shifted products; the mean's share of the shift is put in per slot
        back = _times(values, product.withColumnRenamed("v", "axis"), "row", "slot", width)
        lowered = back.join(mean, "slot").select(
            "slot",
            F.zip_with("v", F.transform(_values(shift), lambda s: s * F.col("mean") * rows), lambda x, s: x - s).alias("v"),
        )
        q = _orthonormal(stage(lowered, "lowered"))
        discard(product)
    gram, _ = _gram(product, width)
    spread = (gram - rows * np.outer(shift, shift)) / (rows - 1)
    sizes, turns = np.linalg.eigh(spread)
    best = np.argsort(-sizes)[:k]
    axes = stage(_turned(q, "slot", turns[:, best]), "axes").withColumnRenamed("v", "axis")
    return Axes(axes, [float(max(s, 0.0)) for s in sizes[best]], [float(x) for x in shift @ turns[:, best]])


def explained(axes: Axes, entries: DataFrame, rows: int) -> DataFrame:
    """``(axis, variance, total)``: the variance along each axis and that of all slots together."""
    squares = entries.groupBy("slot").agg(F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("q"))
    total = squares.agg((F.sum(F.col("q") - F.col("s") ** 2 / rows) / (rows - 1)).alias("total"))
    spark = entries.sparkSession
    table = spark.createDataFrame(list(enumerate(axes.variances)), "axis int, variance double")
    return table.withColumn("total", total.scalar())
