"""Vector columns as arrays: elements, distances, text."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def positive_probability(probability: Column | str = "probability") -> Column:
    """P(positive) of a classifier's probability vector."""
    return vector_to_array(_column(probability))[1]


def to_vector(values: Column | str) -> Column:
    """A numeric array as an ML vector."""
    return array_to_vector(_column(values).cast("array<double>"))


def zeros(width: int) -> Column:
    """An array of ``width`` zeros."""
    return F.array_repeat(F.lit(0.0), width)


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Distance of two numeric arrays of the same length."""
    squares = F.zip_with(
        _column(a).cast("array<double>"),
        _column(b).cast("array<double>"),
        lambda x, y: (x - y) * (x - y),
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def render(values: Column | str, separator: str = ",") -> Column:
    """A numeric array as text."""
    return F.concat_ws(separator, _column(values).cast("array<string>"))


def render_pairs(pairs: Column | str) -> Column:
    """An array of ``(index, value)`` structs as ``index:value`` text, ordered by index."""
    texts = F.transform(
        F.sort_array(_column(pairs)),
        lambda pair: F.concat_ws(":", pair["index"].cast("string"), pair["value"].cast("string")),
    )
    return F.concat_ws(" ", texts)
