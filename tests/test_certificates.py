"""Certificates turn red on models that are off; bucket cells, category tables, lists, embeddings."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pulsetrail.functions.vectors import to_vector
from pulsetrail.operators import similarity
from pulsetrail.operators.categories import CategoryIndexer, CategoryIndexerModel
from pulsetrail.operators.certificates import factor_gaps, logistic_gaps
from pulsetrail.operators.embeddings import company_embeddings, cooccurrences, pointwise_information
from pulsetrail.operators.pipelines import Features, Learner, ListColumn, build_pipeline, multi_hot_stages
from pulsetrail.operators.recommend import factor_blocks, train_als
from pulsetrail.session import stage


# ---------------------------------------------------------------- crowded buckets


@pytest.mark.parametrize("cell", [1, 7, 1000])
def test_cells_lose_and_repeat_no_pair(spark, cell):
    random.seed(cell)
    keys = [0 if random.random() < 0.4 else random.randrange(1, 9) for _ in range(200)]
    a = spark.createDataFrame([(k, i) for i, k in enumerate(keys[:120])], "k int, x int").repartition(5)
    b = spark.createDataFrame([(k, i) for i, k in enumerate(keys[120:])], "k int, y int").repartition(3)
    got = Counter((r.k, r.x, r.y) for r in similarity.cells(a, b, ["k"], cell).collect())
    want = Counter((k, i, j) for i, k in enumerate(keys[:120]) for j, h in enumerate(keys[120:]) if h == k)
    assert got == want


def test_a_bucket_with_a_third_of_the_rows_is_cut(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    other = spark.range(50).select((F.pmod(F.col("id"), F.lit(1)) - 1).alias("k"), F.col("id").alias("y"))
    met = similarity.cells(rows, other, ["k"], 100)
    assert met.count() == 3000 * 50
    plan = met._jdf.queryExecution().toString()
    assert "_ia" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_long_and_short_lists_give_the_same_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(60, 4)))]
    df = spark.createDataFrame(rows, "id int, a array<double>").select("id", to_vector("a").alias("v"))
    model = similarity.projection_model(df, "v", 1.0)
    short = {tuple(r)[:2] for r in similarity.similar_pairs(model, df, df, "id", 1.5).collect()}
    monkeypatch.setattr(similarity, "MAX_PROBES", 5)
    long = [tuple(r)[:2] for r in similarity.similar_pairs(model, df, df, "id", 1.5, cell=4).collect()]
    assert len(long) == len(set(long)) and set(long) == short and len(short) > 60


def test_recall_counts_what_is_missing_and_what_is_wrong(spark):
    exact = spark.createDataFrame([("a", 1, n) for n in range(10)], "g string, idA int, idB int")
    found = spark.createDataFrame([("a", 1, n) for n in range(3, 12)], "g string, idA int, idB int")
    assert tuple(similarity.recall(found, exact, "g").first()) == ("a", 10, 7, 2, 0.7)
    nothing = similarity.recall(found.limit(0), exact, "g").first()
    assert nothing.recall == 0 and nothing.found == 0


# ---------------------------------------------------------------- optimality


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4)) * [1, 5, 0.2, 0]
    y = (x[:, 0] - 0.3 * x[:, 1] + rng.normal(size=400) > 0).astype(float)
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "a array<double>, label double")
    return df.select("label", to_vector("a").alias("features")).cache()


@pytest.mark.parametrize(("reg", "mix"), [(0.0, 0.0), (0.1, 0.0), (0.05, 1.0), (0.05, 0.5)])
def test_gaps_vanish_at_the_optimum_only(labelled, reg, mix):
    fit = LogisticRegression(regParam=reg, elasticNetParam=mix, maxIter=2000, tol=1e-10).fit(labelled)
    scored = fit.transform(labelled)
    assert logistic_gaps(fit, scored).agg(F.max("gap")).first()[0] < 2e-3
    moved = np.array(fit.coefficients.toArray()) + [0.3, 0, 0, 0]
    p = vector_to_array("features")
    margin = sum(F.lit(float(w)) * p[i] for i, w in enumerate(moved)) + float(fit.intercept)
    off = 1 / (1 + F.exp(-margin))
    wrong = labelled.withColumn("probability", to_vector(F.array(1 - off, off)))
    names = ("getRegParam", "getElasticNetParam", "getProbabilityCol", "getLabelCol", "getFeaturesCol", "getFitIntercept")
    fake = SimpleNamespace(**{n: getattr(fit, n) for n in names}, coefficients=SimpleNamespace(toArray=lambda: moved), intercept=fit.intercept)
    assert logistic_gaps(fake, wrong).agg(F.max("gap")).first()[0] > 0.02


@pytest.mark.parametrize("implicit", [True, False])
def test_factor_gaps(spark, implicit):
    random.seed(4)
    rows = [(u, i, float(random.randrange(1, 6))) for u in range(30) for i in range(20) if random.random() < 0.4]
    ratings = spark.createDataFrame(rows, "userId int, itemId int, rating double")
    model = train_als(ratings, implicitPrefs=implicit, rank=4, maxIter=3, regParam=0.1, alpha=0.5)
    gaps = factor_gaps(model, ratings, implicit, 0.1, 0.5)
    assert gaps.count() == 30 and gaps.agg(F.max("gap")).first()[0] < 1e-4
    other = ratings.withColumn("rating", F.col("rating") + 2)
    assert factor_gaps(model, other, implicit, 0.1, 0.5).agg(F.max("gap")).first()[0] > 1e-2


# ---------------------------------------------------------------- categories and lists


def test_a_saved_index_of_very_many_categories(spark, tmp_path):
    rows = spark.range(300_000).select(F.concat(F.lit("c"), F.col("id") % 250_000).alias("c"), F.lit("x").alias("d"))
    fitted = Pipeline(stages=[CategoryIndexer(inputCols=["c", "d"], outputCols=["ci", "di"])]).fit(rows)
    fitted.write().overwrite().save(f"{tmp_path}/m")
    loaded = PipelineModel.load(f"{tmp_path}/m")
    assert isinstance(loaded.stages[0], CategoryIndexerModel)
    out = loaded.transform(rows)
    assert out.select("ci").distinct().count() == 250_000
    assert tuple(out.agg(F.min("ci"), F.max("ci"), F.max("di")).first()) == (0.0, 249_999.0, 0.0)
    assert out.where("ci < 50000").select("c").distinct().where("int(substring(c, 2)) >= 50000").count() == 0
    assert out.schema["ci"].metadata["ml_attr"]["num_vals"] == 250_000


def test_unknown_categories(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,), ("b",)], "c string")
    keep = CategoryIndexer(inputCols=["c"], outputCols=["i"], handleInvalid="keep").fit(train)
    assert {r.c: r.i for r in keep.transform(test).collect()} == {"a": 1.0, "z": 2.0, None: 2.0, "b": 0.0}
    strict = CategoryIndexer(inputCols=["c"], outputCols=["i"]).fit(train)
    with pytest.raises(Exception, match="unknown category"):
        strict.transform(test).collect()


def test_tables_and_driver_held_categories_give_the_same_vectors(spark):
    random.seed(2)
    rows = [(random.choice("aabbbc"), random.choice("xy"), float(n), n % 2) for n in range(40)]
    df = spark.createDataFrame(rows, "c string, d string, n double, label int")
    given = dict(categorical=["c", "d"], numeric=["n"], unknown_category="keep")
    out = [
        Counter(str(r.features.toArray().tolist()) for r in build_pipeline(Features(**given, category_tables=t)).fit(df).transform(df).collect())
        for t in (False, True)
    ]
    assert out[0] == out[1]


def test_lists_are_features_of_a_trained_pipeline(spark, tmp_path):
    rows = [("a|b", 1.0, 1), ("b|b|z", 2.0, 0), ("", 3.0, 0), (None, 0.5, 0), ("a", 1.0, 1), ("c|a", 0.0, 1)] * 5
    df = spark.createDataFrame(rows, "tags string, n double, label int").fillna("", ["tags"])
    vocab = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, index long")
    column = ListColumn.of("tags", r"\|", vocab)
    features = Features(numeric=["n"], lists=[column])
    assert features.columns() == ["n", "tags"]
    model = build_pipeline(features, Learner("logistic", {"regParam": 0.01})).fit(df)
    model.write().overwrite().save(f"{tmp_path}/m")
    out = PipelineModel.load(f"{tmp_path}/m").transform(df)
    hot = {r.tags: r.tags_hot.toArray().tolist() for r in out.collect()}
    assert hot == {"a|b": [1, 1, 0], "b|b|z": [0, 1, 0], "": [0, 0, 0], "a": [1, 0, 0], "c|a": [1, 0, 1]}
    assert out.where("prediction <> label").count() == 0
    with pytest.raises(ValueError):
        ListColumn.of("tags", r"\|", vocab, most=2)
    with pytest.raises(ValueError):
        multi_hot_stages(ListColumn("tags", r"\|", ()))


# ---------------------------------------------------------------- embeddings


def test_company_is_counted_within_the_window(spark):
    df = spark.createDataFrame([(["a", "b", "c", "a"],), (["a"],), (["d", "d"],)], "items array<string>")
    got = {(r.a, r.b): r.n for r in cooccurrences(df, window=2).collect()}
    assert got == {("a", "b"): 2, ("b", "a"): 2, ("b", "c"): 1, ("c", "b"): 1, ("a", "c"): 2, ("c", "a"): 2}
    weights = pointwise_information(cooccurrences(df, window=2)).collect()
    total = sum(got.values())
    single = Counter()
    for (a, _), n in got.items():
        single[a] += n
    for r in weights:
        assert r.weight == pytest.approx(max(0, np.log(r.n * total / single[r.a] / single[r.b])))


def test_company_brings_the_sums_of_its_items(spark):
    baskets = [["a", "b", "c", "a"], ["a"], ["d", "d"], ["a", None, "b"], None, [], ["b", "a"], ["a", "b", "c", "a"]]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    pairs = Counter()
    for b in filter(None, baskets):
        for i, x in enumerate(b):
            for y in b[max(i - 2, 0) : i] + b[i + 1 : i + 3]:
                if x is not None and y is not None and x != y:
                    pairs[x, y] += 1
    single = Counter()
    for (a, _), n in pairs.items():
        single[a] += n
    counts = cooccurrences(df, window=2)
    every = sum(pairs.values())
    expected = sorted((a, b, n, single[a], single[b], every) for (a, b), n in pairs.items())
    assert sorted(map(tuple, counts.collect())) == expected
    weights = pointwise_information(counts)
    looked_up = pointwise_information(counts.select("a", "b", "n"))
    assert sorted(weights.collect()) == sorted(looked_up.collect())
    # the sums come with the pairs: no table of pairs is joined to get them
    assert "Join" not in pointwise_information(stage(counts, "company"))._jdf.queryExecution().optimizedPlan().toString()


def test_items_of_a_planted_group_are_nearer_than_others(spark):
    random.seed(8)
    groups = [[f"{g}{i}" for i in range(8)] for g in "ABC"]
    noise = [x for g in groups for x in g]
    rows = []
    for _ in range(600):
        rows.append(([x if random.random() < 0.9 else random.choice(noise) for x in random.choices(random.choice(groups), k=8)],))
    df = spark.createDataFrame(rows, "items array<string>")
    vectors, _, _ = company_embeddings(df)
    at = {r.word: r.vector.toArray() for r in vectors.collect()}
    assert set(at) == set(noise)

    def near(a, b):
        return at[a] @ at[b] / np.linalg.norm(at[a]) / np.linalg.norm(at[b])

    inside = np.mean([near(a, b) for g in groups for a in g for b in g if a < b])
    across = np.mean([near(a, b) for a in noise for b in noise if a[0] != b[0]])
    assert inside > across + 0.2


def test_blocks_of_factors_grow_with_the_ratings(spark):
    assert factor_blocks(0) == factor_blocks(100, 10) == 10 and factor_blocks(101, 10) == 11
    pairs = [(u, i, 1.0 + (u * i) % 3) for u in range(30) for i in range(20) if (u + i) % 3]
    ratings = spark.createDataFrame(pairs, "userId int, itemId int, rating double")
    model = train_als(ratings, most=len(pairs) // 16, rank=2, maxIter=1)
    assert model.itemFactors.rdd.getNumPartitions() >= 16


@pytest.mark.parametrize("block, cell", [(256, 4096), (3, 6)])
def test_pairs_in_blocks_equal_brute_force(spark, monkeypatch, block, cell):
    monkeypatch.setattr(similarity, "BLOCK", block)
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(20, 3)), np.zeros((2, 3)), [[np.nan, 0, 0]]])
    rows = [(i, i % 2, [float(v) for v in r]) for i, r in enumerate(x)] + [(90, 0, [1.0]), (None, 0, [0.0] * 3), (91, 0, None)]
    side = spark.createDataFrame(rows, "id long, k int, vec array<double>")
    a, b = (side.select("k", F.col("id").alias(f"id{n}"), F.col("vec").alias(f"vec{n}")) for n in "AB")
    for on in ([], ["k"]):
        want = {(i, j): np.linalg.norm(x[i] - x[j]) for i in range(23) for j in range(23)
                if (not on or i % 2 == j % 2) and np.linalg.norm(x[i] - x[j]) <= 1.3} | {(90, 90): 0.0}
        found = similarity.near_pairs(a, b, on, 1.3, cell).collect()
        assert len(found) == len(want) and {(r.idA, r.idB): r.dist for r in found} == pytest.approx(want)
