"""Categories, delimited lists and profiles as indexes and vectors, in relational form.

These forms keep vocabularies in tables, so they also serve columns with more values than a driver
could hold. The ``pyspark.ml`` stages for small category columns are in ``pipelines``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.values import code_of
from pulsetrail.operators.joins import lookup_join
from pulsetrail.operators.ordering import dense_index
from pulsetrail.session import stage


def category_index(df: DataFrame, column: str) -> DataFrame:
    """``(column, index)``: categories numbered by falling frequency, ties in alphabetical order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return dense_index(counts, [F.desc("_n"), F.asc(column)], "index").drop("_n")


def index_column(df: DataFrame, column: str, index: DataFrame, out: str, keep: bool = False) -> DataFrame:
    """Attach the index of each row's category.

    Unknown categories and nulls share the index after the last one with ``keep``, and raise an
    error when read without it.
    """
    joined = lookup_join(df, index.withColumnRenamed("index", out), column)
    if keep:
        unknown = index.agg(F.count("*")).scalar()
    else:
        message = F.concat(F.lit(f"unknown category in {column}: "), F.coalesce(column, F.lit("null")))
        unknown = F.raise_error(message).cast("long")
    return joined.withColumn(out, F.coalesce(F.col(out), unknown))


def _width(size: Column | int, drop_last: bool) -> Column:
    known = F.lit(size) if isinstance(size, int) else size
    return F.greatest(known - (1 if drop_last else 0), F.lit(0)).cast("int")


def one_hot(index: Column | str, size: Column | int, drop_last: bool = True) -> Column:
    """An array of 0.0 and 1.0; with ``drop_last`` the last category is all zeros.

    The array is as wide as there are categories: for many of them take ``sparse_one_hot``.
    """
    place = F.col(index) if isinstance(index, str) else index
    width = _width(size, drop_last)
    places = F.when(width > 0, F.sequence(F.lit(0), width - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: (i == place).cast("double"))


def sparse_one_hot(index: Column | str, size: Column | int, drop_last: bool = True) -> Column:
    """The same as ``(size, indices, values)``, as long for a million categories as for two."""
    place = (F.col(index) if isinstance(index, str) else index).cast("int")
    width = _width(size, drop_last)
    inside = place < width
    return F.struct(
        width.alias("size"),
        F.when(inside, F.array(place)).otherwise(F.array().cast("array<int>")).alias("indices"),
        F.when(inside, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"),
    )


def vocabulary(df: DataFrame, column: str, separator: str) -> DataFrame:
    """``(token, index)``: the distinct entries of a delimited column, numbered in order."""
    entries = df.where(F.col(column).isNotNull() & (F.col(column) != ""))
    entries = entries.select(F.explode(F.split(column, separator)).alias("token")).distinct()
    return dense_index(entries, ["token"], "index")


def multi_hot(df: DataFrame, key: str, column: str, separator: str, vocab: DataFrame) -> DataFrame:
    """``(key, indices)``: the sorted vocabulary indexes of each row's entries.

    Unknown entries are dropped, repeats count once, and a row without entries has no index.
    """
    pairs = df.select(key, F.explode(F.split(column, separator)).alias("token")).distinct()
    found = lookup_join(stage(pairs, "entries"), vocab, "token", "inner")
    indices = found.groupBy(key).agg(F.sort_array(F.collect_list("index")).alias("indices"))
    return df.select(key).join(indices, key, "left").select(
        key, F.coalesce("indices", F.array().cast("array<bigint>")).alias("indices")
    )


# ---------------------------------------------------------------- profile vectors

# The codes of the ordinal user profile, one table per field, in field order; the
# last entry of each pair is the code of every other value.
ORDINAL_PROFILE: dict[str, tuple[dict[str, float], float]] = {
    "bd_sex": ({"F": 0.0}, 1.0),
    "bd_age": (
        {
            "35-44": 1.0,
            "18-24": 3.0,
            "45-54": 4.0,
            "65以上": 5.0,
            "18以下": 6.0,
            "25-34": 7.0,
            "55-64": 8.0,
        },
        0.0,
    ),
    "bd_consume": ({"低": 0.0, "中": 1.0}, 2.0),
    "bd_marriage": ({"已婚": 0.0}, 1.0),
    "bd_high_value": ({"Y": 0.0}, 1.0),
    "bd_low_value": ({"Y": 0.0}, 1.0),
    "bd_sing": ({"Y": 0.0}, 1.0),
    "bd_dance": ({"Y": 0.0}, 1.0),
    "bd_talk": ({"Y": 0.0}, 1.0),
    "bd_outdoor": ({"Y": 0.0}, 1.0),
    "bd_game": ({"Y": 0.0}, 1.0),
    "bd_sport": ({"Y": 0.0}, 1.0),
}

# The positions (from 1) of the sparse user profile, one table per field; 25-34 has
# position 9, as every value has one of its own. The second entry is the position of other values.
SPARSE_PROFILE: dict[str, tuple[dict[str, int], int | None]] = {
    "bd_sex": ({"M": 1}, 2),
    "bd_age": (
        {
            "35-44": 3,
            "18-24": 5,
            "45-54": 6,
            "65以上": 7,
            "18以下": 8,
            "25-34": 9,
            "55-64": 10,
        },
        None,
    ),
    "bd_consume": ({"高": 11, "中": 12, "低": 13}, None),
    "bd_marriage": ({"已婚": 14, "未婚": 15}, None),
    "bd_high_value": ({"Y": 16}, None),
    "bd_low_value": ({"Y": 17}, None),
    "bd_sing": ({"Y": 18}, None),
    "bd_dance": ({"Y": 19}, None),
    "bd_talk": ({"Y": 20}, None),
    "bd_outdoor": ({"Y": 21}, None),
    "bd_game": ({"Y": 22}, None),
    "bd_sport": ({"Y": 23}, None),
}
SPARSE_PROFILE_WIDTH = 23


def ordinal_profile(codes: Mapping[str, tuple[Mapping[str, float], float]] = ORDINAL_PROFILE) -> Column:
    """The coded fields of a row as an array of numbers."""
    return F.array(*[code_of(name, table, other) for name, (table, other) in codes.items()])


def sparse_profile(
    positions: Mapping[str, tuple[Mapping[str, int], int | None]] = SPARSE_PROFILE,
) -> Column:
    """The positions (from 1, ascending) that a row's fields switch on."""
    found = [code_of(name, table, other) for name, (table, other) in positions.items()]
    return F.sort_array(F.array_compact(F.array(*found)))


def positions_to_vector(positions: Column | str, width: int) -> Column:
    """Positions from 1 as a 0/1 vector of the given width."""
    column = F.col(positions) if isinstance(positions, str) else positions
    flags = F.transform(
        F.sequence(F.lit(1), F.lit(width)), lambda i: F.array_contains(column, i).cast("double")
    )
    return array_to_vector(flags)


def assembled(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns as one array; rows with a null among them are dropped."""
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.dropna(how="any", subset=list(columns)).withColumn(out, values)


# ---------------------------------------------------------------- chi-square


def chi_square(df: DataFrame, feature: str, label: str) -> DataFrame:
    """``(statistic, dof)`` of Pearson's independence test of two category columns.

    One aggregation to the contingency table; all further work is on its cells.
    """
    cells = df.groupBy(F.col(feature).alias("f"), F.col(label).alias("l"))
    cells = stage(cells.agg(F.count("*").alias("seen")), "cells")
    rows = cells.groupBy("f").agg(F.sum("seen").alias("in_row"))
    columns = cells.groupBy("l").agg(F.sum("seen").alias("in_column"))
    share = F.col("seen").cast("double") * F.col("seen") / (F.col("in_row") * F.col("in_column"))
    sums = cells.join(rows, "f").join(columns, "l").agg(
        F.sum(share).alias("shares"),
        F.sum("seen").alias("n"),
        F.countDistinct("f").alias("fs"),
        F.countDistinct("l").alias("ls"),
    )
    return sums.select(
        (F.col("n") * (F.col("shares") - 1)).alias("statistic"),
        ((F.col("fs") - 1) * (F.col("ls") - 1)).alias("dof"),
    )
