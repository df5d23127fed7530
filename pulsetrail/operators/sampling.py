"""Samplers that keep or drop a row by a hash of its key.

The decision depends on the key alone, so a sample is the same after a lost executor, in a second
run, and under any partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the first 8 hex digits of an MD5 span this many numbers.
_SPAN = 4294967296.0


def hash_fraction(key: Column | str, salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key and the salt only."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    digest = F.md5(F.concat(F.lit(salt), text) if salt else text)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / _SPAN


def sample_rows(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """A uniform sample."""
    return df.where(hash_fraction(key, salt) < fraction)


def downsample_negatives(
    df: DataFrame, key: str, label: str, k: float, salt: str = ""
) -> DataFrame:
    """All positives, and negatives at the rate that leaves about ``k`` per positive (at most all).

    The rate is one aggregate over the label column, evaluated inside the same query.
    """
    rate = df.agg(
        F.try_divide(
            F.count_if(F.col(label) == 1).cast("double") * k, F.count_if(F.col(label) == 0)
        )
    ).scalar()
    kept = (F.col(label) == 1) | ((F.col(label) == 0) & (hash_fraction(key, salt) < rate))
    return df.where(kept)


def two_stage_sample(
    df: DataFrame, key: str, label: str, fraction: float = 0.5, k: float = 0.8
) -> DataFrame:
    """A uniform sample first, then fewer negatives, with independent hashes."""
    return downsample_negatives(sample_rows(df, key, fraction, "first:"), key, label, k)


def sample_strata(
    df: DataFrame, key: str, by: Sequence[str], fractions: Mapping[tuple, float]
) -> DataFrame:
    """Each stratum at its own rate; rows of other strata are dropped."""
    rate = F.lit(None).cast("double")
    for values, fraction in fractions.items():
        same = F.lit(True)
        for name, value in zip(by, values, strict=True):
            same = same & (F.col(name) == value)
        rate = F.when(same, fraction).otherwise(rate)
    return df.where(hash_fraction(key) < rate)


def hash_split(df: DataFrame, key: str, weights: Sequence[float], salt: str = "") -> list[DataFrame]:
    """Disjoint parts of ``df`` in the given proportions."""
    total = float(sum(weights))
    place = hash_fraction(key, salt)
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = low + weight / total
        last = i == len(weights) - 1
        parts.append(df.where((place >= low) if last else (place >= low) & (place < high)))
        low = high
    return parts


# The rates of the exposure sample, by (exposed, label).
EXPOSURE_RATES = {(1, 1): 1.0, (0, 1): 0.0678 * 0.5, (1, 0): 0.3, (0, 0): 0.0166 * 0.25}
