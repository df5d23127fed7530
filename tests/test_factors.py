"""Factors solved block by block."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsetrail.operators import factors
from pulsetrail.operators.certificates import factor_gaps
from pulsetrail.operators.recommend import train_als


@pytest.fixture
def rated(spark, monkeypatch):
    """Ids below zero and with gaps, pairs that come twice, ratings of zero and below."""
    monkeypatch.setattr(factors, "WIDTH", 16)
    monkeypatch.setattr(factors, "RATINGS_A_PIECE", 60)
    random.seed(4)
    rows = [(u * 3 - 20, i * 7, float(random.randrange(-1, 6))) for u in range(80) for i in range(60) if random.random() < 0.2]
    rows += rows[:5] + [(5000, 0, 3.0)]
    return spark.createDataFrame(rows, "userId int, itemId int, rating double").cache()


@pytest.mark.parametrize("implicit", [True, False])
def test_blocks_solve_the_equations_of_sparks_learner(rated, implicit, tmp_path):
    settings = dict(implicitPrefs=implicit, rank=4, maxIter=2, regParam=0.1, alpha=0.5)
    model = train_als(rated, most=100, most_for_spark=0, **settings)
    users = {r.userId for r in rated.collect()}
    assert {r.id for r in model.userFactors.collect()} == users
    joined = factor_gaps(model, rated, implicit, 0.1, 0.5)
    assert joined.count() == len(users) and joined.agg(F.max("gap")).first()[0] < 1e-4
    moved = rated.withColumn("rating", F.col("rating") + 2).where("itemId <> 7")
    moved = moved.unionByName(rated.limit(1).selectExpr("-9 as userId", "-9 as itemId", "rating"))
    by_joins = dict(map(tuple, factor_gaps(model, moved, implicit, 0.1, 0.5).collect()))
    by_blocks = dict(map(tuple, factor_gaps(model, moved, implicit, 0.1, 0.5, most_for_joins=0).collect()))
    assert by_blocks == pytest.approx(by_joins, abs=1e-9) and max(by_joins.values()) > 1e-2
    model.write().save(f"{tmp_path}/m")
    assert type(model).load(f"{tmp_path}/m").itemFactors.count() == model.itemFactors.count() == 60


def test_blocks_do_not_change_the_factors(rated):
    rows = factors.checked(rated, "userId", "itemId", "rating")
    found = []
    for blocks in (1, 7):
        users, _ = factors.fit(rows, blocks, 3, 1, 0.1, 0.5, 11)
        found.append({r.id: list(r.features) for r in users.collect()})
    assert found[0].keys() == found[1].keys()
    assert all(found[0][u] == pytest.approx(found[1][u], rel=1e-4, abs=1e-6) for u in found[0])


@pytest.mark.parametrize("bad", ["null as rating", "double('nan') as rating", "double('inf') as rating"])
def test_ratings_that_are_no_numbers_are_errors(rated, bad):
    rows = rated.selectExpr("userId", "itemId", bad).withColumn("rating", F.col("rating").cast("double"))
    with pytest.raises(Exception, match="(?i)ratings must"):
        train_als(rows, most_for_spark=0, maxIter=1)


def test_normal_equations_leave_out_what_is_not_there():
    rng = np.random.default_rng(5)
    sizes = np.array([3, 1, 9, 4, 3, 30])
    y, r = rng.normal(size=(sizes.sum(), 2)), rng.integers(-1, 5, sizes.sum()).astype(float)
    ends = np.cumsum(sizes)
    seen = set()
    for some, index, here in factors._groups(sizes, 2):
        left, right = factors._equations(y[index], r[index], here, 0.1, 0.5, np.eye(2))
        for k, n in enumerate(some):
            part = slice(ends[n] - sizes[n], ends[n])
            a, b = y[part], r[part]
            want = np.eye(2) * (1 + 0.1 * (b > 0).sum()) + (a.T * 0.5 * np.abs(b)) @ a
            assert np.allclose(left[k], want) and np.allclose(right[k, :, 0], ((1 + 0.5 * b) * (b > 0)) @ a)
            seen.add(int(n))
    assert seen == set(range(len(sizes)))
