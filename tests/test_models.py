"""Properties of the queries that SQL cannot express."""

from types import SimpleNamespace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pulsetrail.catalog import models
from pulsetrail.operators import models as operators
from pulsetrail.operators.pipelines import TextColumn, feature_stages, tfidf_stages
from pulsetrail.plans import feature_sets as sets


RAW = {
    "importances": models.importances_query,
    "uplift": lambda spark, folder: models.uplift(models.two_arm_scores(spark, folder), ["hdid"], "exposed"),
    "word_vectors": models.word_vectors_query,
    "lsh_pairs": lambda spark, folder: models.lsh_pairs(spark, folder)[0],
    "material_similarity": lambda spark, folder: models.material_similarity(spark, folder)[0],
}


@pytest.fixture(scope="module")
def run(spark, folder):
    done = {}

    def once(name):
        if name not in done:
            done[name] = RAW.get(name, getattr(models, name, None))(spark, folder).cache()
        return done[name]

    return once


@pytest.fixture(scope="module")
def orders(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey").distinct()
    return lines.count()


@pytest.mark.parametrize("name", ["gbt_scores", "pca_scores", "rformula_scores"])
def test_scores(run, orders, name):
    df = run(name)
    assert df.count() == orders
    odd = "probability is null or probability < 0 or probability > 1"
    assert df.where(odd).isEmpty()
    assert df.where("prediction <> cast(probability > 0.5 as double)").isEmpty()


def test_the_trees_learn_something(run):
    hit = run("gbt_scores").agg(F.avg((F.col("label") == F.col("prediction")).cast("int"))).first()[0]
    assert hit > 0.8


def test_importances_sum_to_one_and_have_names(run):
    df = run("importances")
    assert df.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert df.orderBy(F.desc("importance")).first()["feature"] == "lines"


def test_weights_have_names(run):
    names = {r["feature"] for r in run("lr_weights").collect()}
    assert {"lines", "o_totalprice", "c_mktsegment_vec_BUILDING"} & names >= {"lines", "o_totalprice"}


def test_uplift_is_the_difference_of_the_arms(run, orders):
    arms = {(r["hdid"], r["exposed"]): r["probability"] for r in run("two_arm_scores").collect()}
    assert len(arms) == 2 * orders
    for r in run("uplift").limit(50).collect():
        assert r["uplift"] == pytest.approx(arms[r["hdid"], 1] - arms[r["hdid"], 0])


def test_reloaded_pipeline_scores_the_same(run, orders):
    assert run("model_roundtrip").where("before = probability").count() == orders


def test_factor_queries(run):
    scores = run("als_scores")
    assert scores.where("prediction is null or isnan(prediction)").isEmpty()
    error = scores.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2)))).first()[0]
    assert run("als_rmse").first()["rmse"] == pytest.approx(error, rel=1e-3)
    best = run("als_recommend").groupBy("userId").count()
    assert best.where("count <> 10").isEmpty()
    assert run("als_item_vectors").where("size(split(item_vec, ',')) <> 10").isEmpty()


def test_hashed_weights_follow_the_idf_formula(spark):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([(1, "a"), (2, "a,b"), (3, "")], "id int, s string")
    stages = tfidf_stages(TextColumn("s", ",", 1000))
    out = Pipeline(stages=stages).fit(df).transform(df)
    weights = out.select("id", F.aggregate(vector_to_array("s_vec"), F.lit(0.0), lambda a, x: a + x))
    from math import log

    got = dict(map(tuple, weights.collect()))
    assert got[1] == pytest.approx(log(4 / 3)) and got[3] == 0
    assert got[2] == pytest.approx(log(4 / 3) + log(4 / 2))


def test_hashed_tfidf_has_a_row_per_document(run, spark, folder):
    assert run("hashed_tfidf").count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_similar_pairs_have_exact_distances(run, spark, folder):
    import numpy as np

    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("label", "embedding").collect()
    vectors = np.array([r["embedding"] for r in rows], dtype=float)
    labels = np.array([r["label"] for r in rows])
    middle = vectors.mean(axis=0)
    for r in run("lsh_pairs").collect():
        mean = vectors[labels == r["idA"]].mean(axis=0)
        assert r["dist"] == pytest.approx(np.linalg.norm(mean - middle), abs=1e-6)


def test_other_model_queries_have_rows(run, spark, folder):
    parts = spark.read.parquet(f"{folder}/part.parquet").count()
    assert run("word_vectors").count() == parts
    assert run("material_similarity").count() <= 50
    assert run("selected_features").select("code").distinct().count() > 1
    assert run("lr_no_intercept").count() == 23


def test_stage_lists_follow_the_feature_sets():
    kinds = [type(s).__name__ for s in feature_stages(sets.EXPOSURE)]
    assert kinds == [
        "RFormula", "RegexTokenizer", "HashingTF", "IDF", "VectorAssembler", "PCA", "OneHotEncoder",
        "VectorAssembler",
    ]
    assert len(sets.CLICK.numeric) == 64 and len(sets.CHURN.numeric) == 71
    assert len(sets.RISK.numeric) == 45 and len(sets.EXPOSURE.numeric) == 15


def test_large_training_tables_are_dealt_to_more_tasks(spark):
    rows = spark.range(0, 100, 1, 2).select(F.col("id").alias("x"))
    met = []
    pipeline = SimpleNamespace(fit=lambda df: met.append((df.rdd.getNumPartitions(), df.count(), df.is_cached)))
    operators.train(rows, pipeline, most=50)
    operators.train(rows, pipeline, most=9)
    assert met == [(2, 100, False), (12, 100, True)]
