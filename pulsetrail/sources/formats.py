"""libSVM rows and word vectors as text."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.vectors import render, to_vector


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    """``label index:value ...`` rows of the values that are not 0, indexes from 1, ascending."""
    slots = F.transform(
        vector_to_array(features),
        lambda value, i: F.when(value != 0, F.concat_ws(":", (i + 1).cast("string"), value.cast("string"))),
    )
    line = F.concat_ws(" ", F.col(label).cast("string"), F.array_compact(slots))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_libsvm(spark: SparkSession, path: str, width: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", width).load(path)


def write_vectors(df: DataFrame, path: str, word: str = "word", vector: str = "vector") -> None:
    """``word<tab>v1,v2,...`` lines."""
    line = F.concat_ws("\t", F.col(word), render(vector_to_array(vector)))
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    return spark.read.text(path).select(
        parts[0].alias("word"), to_vector(F.split(parts[1], ",")).alias("vector")
    )
