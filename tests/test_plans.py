"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from pulsetrail.operators import cleaning, evaluation, joins, sampling, similarity
from pulsetrail.plans import feature_sets as sets

PLANNED = {"als_recommend", "als_scores", "lsh_pairs", "material_similarity", "hashed_tfidf"}
MODEL_QUERIES = {n for n in entry_points.queries() if n not in entry_points.oracle_sql()}


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - MODEL_QUERIES | PLANNED))
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(entry_points.queries()[name](spark, folder))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert operator not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    text = plan(entry_points.queries()["value_filters"](spark, folder))
    assert "PushedFilters: [IsNotNull(o_orderpriority), Not(EqualTo(o_orderpriority,))" in text
    assert "o_orderdate" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_confusion_reads_two_columns_in_one_pass(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    df = orders.withColumn("label", F.col("o_custkey") % 2).withColumn("prediction", F.lit(1.0))
    text = plan(evaluation.confusion(df, "t"))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert re.search(r"ReadSchema: (.*)", text).group(1) == "struct<o_custkey:bigint>"


def test_sweep_is_one_pass(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    df = orders.select(F.lit(1).alias("label"), F.col("o_totalprice").alias("probability"))
    text = plan(evaluation.threshold_sweep(df, [0.7, 0.8, 0.9]))
    assert text.count("Scan parquet") == 2 and "Join" not in text


def test_two_arms_are_one_narrow_pass(spark):
    both = joins.with_candidates(spark.range(5), [1, 0], "flag")
    text = plan(both)
    assert "Exchange" not in text and "Join" not in text
    assert both.count() == 10


def test_samplers_do_not_shuffle(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    assert "Exchange" not in plan(sampling.sample_rows(orders, "o_orderkey", 0.5))
    assert "Exchange" not in plan(sampling.sample_strata(orders, "o_orderkey", ["o_orderstatus"], {("F",): 0.5}))


def test_top_k_keeps_k_rows_per_task(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert "TakeOrderedAndProject" in plan(cleaning.popular_items(lines, "l_partkey", "l_orderkey", 50))


def test_short_lists_are_broadcast_and_long_ones_shuffled(spark, monkeypatch):
    from pulsetrail.functions.vectors import to_vector

    df = spark.range(40).select("id", to_vector(F.array(F.col("id") / 40, F.col("id") % 3)).alias("v"))
    model = similarity.projection_model(df, "v")
    short = similarity.similar_pairs(model, df, df.where("id < 5"), "id")
    monkeypatch.setattr(similarity, "MAX_PROBES", 2)
    long = similarity.similar_pairs(model, df, df.where("id < 5"), "id")
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.collect()))
    expected = model.approxSimilarityJoin(df, df.where("id < 5"), 1e5, "dist").select(
        "datasetA.id", "datasetB.id", "dist"
    )
    got = {(a, b): d for a, b, d in short.collect()}
    want = {(a, b): d for a, b, d in expected.collect()}
    assert got.keys() == want.keys() and len(got) == short.count()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_training_reads_only_its_columns():
    assert set(sets.EXPOSURE.columns()) >= {"applists", "is_exposure_v2", "sex", "start_cnt_d7"}
    assert len(sets.MATERIAL.columns()) == len(set(sets.MATERIAL.columns())) == 20


def test_texts_meet_by_key_and_terms_of_crowded_keys_are_spread(spark, monkeypatch):
    """Term counts send texts, not terms, but for keys with many rows; both count the same."""
    from collections import Counter

    from pulsetrail.operators import text

    rows = [(1, "a b a"), (1, "B c"), (2, ""), (3, None), (4, "d  d"), *[(None, "a x")] * 4, *[(5, "a y")] * 5]
    docs = spark.createDataFrame(rows, "doc_id long, words string")
    expected = Counter((key, term) for key, words in rows for term in (words or "").lower().split())
    for most, spread in ((10, False), (3, True)):
        monkeypatch.setattr(text, "ROWS_A_KEY", most, raising=False)
        counts = text.token_counts(docs, "doc_id", "words", " +")
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert bool(re.search(r"hashpartitioning\(doc_id#\d+L?, term#", plan)) == spread
        assert sorted(map(str, counts.collect())) == sorted(
            f"Row(doc_id={key}, term={term!r}, tf={n})" for (key, term), n in expected.items()
        )
