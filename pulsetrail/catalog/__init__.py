"""The registered queries: each runs operators on whole test tables, with the SQL it must equal."""

from __future__ import annotations

from pulsetrail.catalog import (  # noqa: F401
    certificates,
    cleaning,
    encoding,
    evaluation,
    graphs,
    jobs,
    joins,
    model_checks,
    models,
    sampling,
    scans,
)
from pulsetrail.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
