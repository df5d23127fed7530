"""What the embedding of company stores, and the files that staged tables leave."""

import random

import pytest
from pyspark.sql import functions as F

from pulsetrail.operators.embeddings import company_embeddings, cooccurrences, pointwise_information
from pulsetrail.session import stage


def test_company_is_stored_once_for_both_directions(spark):
    random.seed(3)
    baskets = [random.choices("abcdefgh", k=6) for _ in range(40)] + [["z"], ["y", "y"], None, ["a", None, "b"]]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    vectors, _, rows = company_embeddings(df)
    key = {r["index"]: r["word"] for r in vectors.collect()}
    assert sorted(key.items()) == list(enumerate("abcdefgh"))
    want = {(r.a, r.b): r.weight for r in pointwise_information(cooccurrences(df)).collect()}
    got = {(key[r.userId], key[r.itemId]): r.rating for r in rows.collect()}
    assert got == pytest.approx(want)
    stored = spark.read.parquet(*rows.inputFiles())
    assert 2 * stored.count() == rows.count() == len(want)


def test_a_staged_table_leaves_no_shuffle_files(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    made = stage(spark.range(1000).withColumn("k", F.col("id") % 10).repartition(5).groupBy("k").count(), "counted")
    assert files() <= before
    assert made.count() == 10
