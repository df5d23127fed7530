"""Euclidean similarity between sets of vectors: by random-projection buckets, and exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pulsetrail.functions.vectors import euclidean
from pulsetrail.operators.joins import lookup_join
from pulsetrail.operators.pipelines import SEED
from pulsetrail.session import ship, stage

# Bucket width, number of hash tables, and the widest distance that is reported.
BUCKET_WIDTH = 0.2
HASH_TABLES = 3
WIDEST = 100000.0

CELL = 4_096  # rows of one bucket and one side that a task holds
BLOCK = 256  # rows of one key whose vectors travel in one row and are compared as matrices
MAX_PROBES = 1_000  # a set of up to this many vectors is broadcast to the other set


def projection_model(
    df: DataFrame, vector: str, bucket: float = BUCKET_WIDTH, tables: int = HASH_TABLES
) -> BucketedRandomProjectionLSHModel:
    lsh = BucketedRandomProjectionLSH(inputCol=vector, outputCol="buckets", seed=SEED)
    return lsh.setBucketLength(bucket).setNumHashTables(tables).fit(df)


def hashed(model: BucketedRandomProjectionLSHModel, df: DataFrame, key: str) -> DataFrame:
    """``(id, vec, hashes)``: the vector as an array, and its bucket in each hash table."""
    buckets = [
        vector_to_array(F.col("buckets")[i])[0].cast("long") for i in range(model.getNumHashTables())
    ]
    return model.transform(df).select(
        F.col(key).alias("id"),
        vector_to_array(model.getInputCol()).alias("vec"),
        F.array(*buckets).alias("hashes"),
    )


def similar_pairs(
    model: BucketedRandomProjectionLSHModel,
    left: DataFrame,
    right: DataFrame,
    key: str,
    widest: float = WIDEST,
    cell: int = CELL,
) -> DataFrame:
    """``(idA, idB, dist)`` of the pairs that share a bucket and are at most ``widest`` apart.

    Rows meet by (table, bucket). A pair that shares several buckets is reported by the first of them
    only, so no distinct over the pairs is needed. A short ``right`` (a given list of items, a top-k
    report, a single mean) is counted and broadcast when it has at most MAX_PROBES vectors, so
    ``left`` may be of any size and is not shuffled. A longer one is met in ``cells``: crowded buckets
    are cut into parts, so that no task holds a bucket, however many vectors fall into it.
    """
    short = right.limit(MAX_PROBES + 1).count() <= MAX_PROBES
    a = hashed(model, left, key).select(
        F.col("id").alias("idA"), F.col("vec").alias("vecA"), F.col("hashes").alias("hashesA"),
        F.posexplode("hashes").alias("table", "bucket"),
    )
    b = hashed(model, right, key).select(
        F.col("id").alias("idB"), F.col("vec").alias("vecB"), F.col("hashes").alias("hashesB"),
        F.posexplode("hashes").alias("table", "bucket"),
    )
    shared = F.zip_with("hashesA", "hashesB", lambda x, y: x == y)
    first = F.array_position(shared, F.lit(True)) == F.col("table") + 1
    if not short:
        return near_pairs(a, b, ["table", "bucket"], widest, cell, hashed=True)
    met = a.join(F.broadcast(b), ["table", "bucket"])
    return met.where(first).select("idA", "idB", euclidean("vecA", "vecB").alias("dist")).where(
        F.col("dist") <= widest
    )


def cells(a: DataFrame, b: DataFrame, on: list[str], cell: int = CELL) -> DataFrame:
    """``a`` joined to ``b`` where both may have many rows of one key.

    A census counts the rows of each key. A key with more than ``cell`` rows on a side has several
    parts there: its rows are dealt out to them by chance, and every part of one side meets every part
    of the other in a task of its own. The census keeps only such keys, at most one for every ``cell``
    rows of the input.
    """
    counts = a.select(*on, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*on, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    census = counts.groupBy(*on).agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    crowded = census.where(F.greatest("_na", "_nb") > cell).select(
        *on, F.ceil(F.col("_na") / cell).cast("int").alias("_pa"), F.ceil(F.col("_nb") / cell).cast("int").alias("_pb")
    )
    crowded = stage(crowded, "crowded")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        parts = {name: F.greatest(F.coalesce(name, F.lit(1)), F.lit(1)) for name in ("_pa", "_pb")}
        mine = F.pmod(F.monotonically_increasing_id(), parts[f"_p{own}"].cast("long")).cast("int")
        placed = lookup_join(side, crowded, on).withColumn(f"_i{own}", mine)
        copies = F.explode(F.sequence(F.lit(0), parts[f"_p{other}"] - 1)).alias(f"_i{other}")
        return placed.select(*side.columns, f"_i{own}", copies)

    return dealt(a, "a", "b").join(dealt(b, "b", "a"), [*on, "_ia", "_ib"]).drop("_ia", "_ib")


def _blocks(side: DataFrame, name: str, on: list[str], hashed: bool) -> DataFrame:
    """Up to about ``BLOCK`` rows of one key and vector width in a row: ids, and the vectors end to end."""
    own, vec = f"id{name}", f"vec{name}"
    rows = side.where(F.col(own).isNotNull() & F.col(vec).isNotNull()).withColumn("width", F.size(vec))
    if not hashed:
        rows = rows.withColumn(f"hashes{name}", F.array().cast("array<bigint>"))
    on = [*on, "width"]
    parts = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK)
    parts = stage(parts.select(*on, F.ceil(F.col("_n") / BLOCK).alias("_parts")), "parts")
    placed = lookup_join(rows, parts, on)
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("_parts", F.lit(1).cast("long")))
    held = F.collect_list(F.struct(F.col(own).alias("i"), F.col(vec).alias("v"), F.col(f"hashes{name}").alias("h")))
    held = placed.withColumn("_part", part).groupBy(*on, "_part").agg(held.alias("s"))
    return held.select(
        *on, F.col("s.i").alias(own), F.flatten("s.v").cast("array<double>").alias(vec), F.flatten("s.h").alias(f"hashes{name}")
    )


def near_pairs(
    a: DataFrame, b: DataFrame, on: list[str], widest: float, cell: int = CELL, hashed: bool = False
) -> DataFrame:
    """``(idA, idB, dist)`` of the pairs of equal keys that are at most ``widest`` apart.

    ``a`` has ``idA`` and ``vecA``, ``b`` alike. Every pair is compared, but as blocks of rows: a matrix
    product leaves out the pairs that are clearly too far apart, and the others get their exact
    distance. With ``hashed``, the keys are table and bucket, both sides have their hashes, and a pair
    counts in the first table that it shares.
    """
    ship(a.sparkSession)  # and batches of a few pairs of blocks
    met = cells(_blocks(a, "A", on, hashed), _blocks(b, "B", on, hashed), [*on, "width"], max(1, cell // BLOCK))
    table = "table" if hashed else F.lit(0).alias("table")
    met = met.select("idA", "vecA", "hashesA", "idB", "vecB", "hashesB", "width", table)
    kinds = {c: met.schema[c].dataType.elementType for c in ("idA", "idB")}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                one = {c: batch.column(c)[n] for c in batch.schema.names}
                ids = [one[c].values for c in ("idA", "idB")]
                x, y = (one[c].values.to_numpy().reshape(len(i), -1) for c, i in zip(("vecA", "vecB"), ids))
                squares = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)
                # a rounding error of the product is far below the slack; what is not finite is compared
                with np.errstate(invalid="ignore", over="ignore"):
                    far = squares - 2 * (x @ y.T) > widest * widest + 1e-9 * (1 + widest * widest + squares)
                i, j = np.nonzero(~far)
                if hashed:
                    g, h = (one[c].values.to_numpy().reshape(len(d), -1) for c, d in zip(("hashesA", "hashesB"), ids))
                    first = (g[i] == h[j]).argmax(axis=1) == one["table"].as_py()
                    i, j = i[first], j[first]
                total = np.zeros(len(i))
                for k in range(x.shape[1]):  # in the order in which ``euclidean`` adds
                    total += (x[i, k] - y[j, k]) ** 2
                dist = np.sqrt(total)
                near = dist <= widest
                found = [ids[0].take(pa.array(i[near])), ids[1].take(pa.array(j[near])), pa.array(dist[near])]
                yield pa.RecordBatch.from_arrays(found, names=["idA", "idB", "dist"])

    out = StructType([*[StructField(c, kind) for c, kind in kinds.items()], StructField("dist", DoubleType())])
    return met.mapInArrow(compare, out)


def projections(model: BucketedRandomProjectionLSHModel, spark: SparkSession, width: int) -> list[list[float]]:
    """The unit vector that each hash table projects on, read from the buckets of long axis vectors."""
    far = float(1 << 40)
    axes = [(i, Vectors.sparse(width, [i], [far])) for i in range(width)]
    rows = hashed(model, spark.createDataFrame(axes, ["id", model.getInputCol()]), "id").collect()
    step = model.getBucketLength() / far
    columns = [[(b + 0.5) * step for b in row.hashes] for row in sorted(rows, key=lambda r: r.id)]
    return [list(table) for table in zip(*columns)]


def recall(found: DataFrame, exact: DataFrame, by: str) -> DataFrame:
    """``(by, exact, found, wrong, recall)``: how many of the exact pairs were found, and how many
    others; both tables have ``by``, ``idA`` and ``idB``, each pair once."""
    marked = exact.withColumn("_e", F.lit(1)).join(
        found.withColumn("_f", F.lit(1)), [by, "idA", "idB"], "full"
    )
    both = F.count_if(F.col("_e").isNotNull() & F.col("_f").isNotNull())
    counted = marked.groupBy(by).agg(
        F.count("_e").alias("exact"), both.alias("found"), F.count_if(F.col("_e").isNull()).alias("wrong")
    )
    return counted.withColumn("recall", F.try_divide("found", "exact"))


def centroid_distances(df: DataFrame, key: str, vector: Column | str, centroid: DataFrame) -> DataFrame:
    """``(idA, dist)``: the exact distance of every vector to the single vector in ``centroid``."""
    values = F.col(vector) if isinstance(vector, str) else vector
    beside = df.select(F.col(key).alias("idA"), values.alias("_v"), centroid.scalar().alias("_c"))
    return beside.select("idA", euclidean("_v", "_c").alias("dist"))
