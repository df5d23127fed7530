"""Principal axes of sparse entries against the dense decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsetrail.operators import reduction
from pulsetrail.operators.reduction import explained, principal_axes


def as_entries(spark, x):
    rows = [(i, j, float(v)) for i, r in enumerate(x) for j, v in enumerate(r) if v]
    return spark.createDataFrame(rows, "row int, slot int, value double").cache()


def test_axes_equal_the_dense_decomposition(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3)) @ rng.normal(size=(3, 9)) * 3 + rng.normal(size=(120, 9)) * 0.2 + 4
    x[rng.random(x.shape) < 0.1] = 0
    entries = as_entries(spark, x)
    found = principal_axes(entries, 120, 3)
    sizes, turns = np.linalg.eigh(np.cov(x.T))
    assert found.variances == pytest.approx(sizes[::-1][:3], rel=1e-6)
    loads = np.array([r.axis for r in found.axes.orderBy("slot").collect()])
    assert abs(loads.T @ turns[:, ::-1][:, :3]) == pytest.approx(np.eye(3), abs=1e-3)
    got = np.array([r.scores for r in found.scores(entries).orderBy("row").collect()])
    assert got == pytest.approx((x - x.mean(axis=0)) @ loads, abs=1e-6)
    total = explained(found, entries, 120).first().total
    assert total == pytest.approx(np.cov(x.T).trace())


def test_fewer_dimensions_than_axes(spark):
    x = np.outer(np.arange(1, 8), [1.0, 2.0, 0.0])
    found = principal_axes(as_entries(spark, x), 7, 3)
    assert found.variances[0] == pytest.approx(np.cov(x.T).trace())
    assert all(v < 1e-9 for v in found.variances[1:])


def test_few_slots_give_the_axes_of_the_joins(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(60, 2)) @ rng.normal(size=(2, 6)) + rng.normal(size=(60, 6)) * 0.3 + 2
    entries = as_entries(spark, x)
    joins = []
    times = reduction._times
    monkeypatch.setattr(reduction, "_times", lambda *a: joins.append(a) or times(*a))
    few = principal_axes(entries, 60, 2, rounds=1)
    assert not joins  # before, three shuffles of the entries a round
    monkeypatch.setattr(reduction, "FEW", 3)
    many = principal_axes(entries, 60, 2, rounds=1)
    assert joins and few.variances == pytest.approx(many.variances, rel=1e-9)
    assert np.abs(few.centre) == pytest.approx(np.abs(many.centre), abs=1e-6)


def test_no_entries(spark):
    found = principal_axes(as_entries(spark, np.zeros((1, 1))).limit(0), 5, 2)
    assert found.variances == [] and found.axes.isEmpty()
    with pytest.raises(ValueError):
        principal_axes(as_entries(spark, np.ones((1, 1))), 1, 1)


def test_very_many_one_hot_columns(spark):
    """A hundred thousand columns: the driver never holds them, two planted groups are the first axis."""
    n = 20_000
    rows = spark.range(n).select(
        F.col("id").alias("row"),
        F.explode(F.array(
            F.struct((F.xxhash64("id") % 50_000 + 50_000).alias("slot"), F.lit(1.0).alias("value")),
            F.struct(F.lit(200_000).cast("long").alias("slot"), (F.col("id") % 2 * 6).cast("double").alias("value")),
        )).alias("e"),
    ).select("row", "e.slot", "e.value").cache()
    found = principal_axes(rows, n, 1, rounds=4)
    assert found.variances[0] == pytest.approx(9.0, rel=0.02)
    top = found.axes.orderBy(F.desc(F.abs(F.col("axis")[0]))).first()
    assert top.slot == 200_000
