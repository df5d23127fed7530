"""Null handling, ratios, labels and code look-ups on columns. None raises in ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def default_to(value: Column | str, default: Any) -> Column:
    """``value``, or ``default`` where it is null."""
    return F.coalesce(_column(value), F.lit(default))


def match_fill(value: Column | str, matched_key: Column | str, default: Any) -> Column:
    """``default`` where the joined key is null; a null of a matched row stays null."""
    return F.when(_column(matched_key).isNull(), F.lit(default)).otherwise(_column(value))


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, null when ``b`` is null or 0."""
    return F.try_divide(_column(a), _column(b))


def safe_ratio(a: Column | str, b: Column | str, default: float = 0.0) -> Column:
    """``a / b``, or ``default`` when an operand is null or ``b`` is 0."""
    return F.coalesce(ratio(_column(a).cast("double"), b), F.lit(default))


def threshold_label(value: Column | str, bar: float) -> Column:
    """1 above ``bar``, else 0; a null counts as 0."""
    return F.when(_column(value) > bar, 1).otherwise(0)


def binarise(score: Column | str, bar: Column | float) -> Column:
    """1.0 from ``bar`` on, else 0.0."""
    return F.when(_column(score) >= bar, 1.0).otherwise(0.0)


def as_number(value: Column | str, kind: str = "bigint") -> Column:
    """The number in a string, null when there is none."""
    return _column(value).try_cast(kind)


def is_numeric_id(value: Column | str) -> Column:
    """Whether a string is a positive whole number."""
    return F.coalesce(as_number(value) > 0, F.lit(False))


def non_empty(value: Column | str) -> Column:
    """Whether a string is neither null nor empty."""
    return _column(value).isNotNull() & (_column(value) != "")


def code_of(value: Column | str, codes: Mapping[str, float], default: float | None) -> Column:
    """The number a fixed table gives to a category."""
    pairs = [F.lit(part) for item in codes.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), _column(value))
    return F.coalesce(found, F.lit(default))


def tokens(value: Column | str, pattern: str) -> Column:
    """Lower-cased pieces of a string between matches of ``pattern``, without empty pieces."""
    pieces = F.split(F.lower(_column(value)), pattern)
    return F.filter(pieces, lambda piece: piece != "")
