import pytest
from pyspark.sql import functions as F

from pulsetrail.operators import joins, ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most of the rows, some rows have no key."""
    pairs = [("hot", i) for i in range(400)] + [(f"k{i}", i) for i in range(50)] + [(None, 1)] * 7
    return spark.createDataFrame(pairs, "k string, n long")


def test_positions_of_a_hot_group(skewed, rows):
    found = ordering.positions(skewed.dropna(), ["k"], [F.col("n")])
    expected = [("hot", i, i) for i in range(400)] + [(f"k{i}", i, 0) for i in range(50)]
    assert rows(found) == sorted(expected, key=repr)


def test_running_totals_across_partitions(spark, rows):
    df = spark.range(1000).repartition(7).withColumn("v", F.col("id") % 5)
    found = ordering.running_totals(df, [F.desc("id")], {"total": F.col("v")})
    total, expected = 0, []
    for i in range(999, -1, -1):
        total += i % 5
        expected.append((i, i % 5, total))
    assert rows(found) == sorted(expected, key=repr)


def test_dense_index_follows_the_order(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).cast("string").alias("key"))
    found = [tuple(r) for r in ordering.dense_index(df, ["key"]).orderBy("id").collect()]
    assert found == [(key, i) for i, key in enumerate(sorted(str(n) for n in range(500)))]


def test_dense_index_from_a_start(spark, rows):
    assert rows(ordering.dense_index(spark.range(3), [F.desc("id")], "n", 1)) == [
        (0, 3), (1, 2), (2, 1),
    ]


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = ordering.first_per_key(df, ["k"], [F.desc("id")])
    assert sorted(map(tuple, first.collect())) == [(0, 99), (1, 97), (2, 98)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 50, 10**9])
def test_lookup_join_equals_a_plain_join(skewed, spark, rows, how, hot_rows):
    table = spark.createDataFrame([("hot", 1.0), ("k3", 2.0), ("k4", None)], "k string, v double")
    expected = rows(skewed.join(table, "k", how))
    assert rows(joins.lookup_join(skewed, table, "k", how, hot_rows)) == expected
    without_hot = table.where("k <> 'hot'")
    expected = rows(skewed.join(without_hot, "k", how))
    assert rows(joins.lookup_join(skewed, without_hot, "k", how, hot_rows)) == expected


def test_lookup_default_marks_unknown_keys_only(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    table = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    assert rows(joins.lookup(df, table, "k", {"v": -1})) == [("a", 1), ("b", None), ("c", -1)]


def test_key_filters(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(joins.keep_known(df, keys, "k")) == [(1,), (1,), (3,)]
    assert rows(joins.keep_unseen(df, keys, "k")) == [(2,)]


def test_lookup_on_expressions(spark, rows):
    df = spark.createDataFrame([("Ab",), ("x",)], "sjp string")
    ranks = spark.createDataFrame([("aB", 1)], "name string, rank int")
    joined = joins.lookup_on(df, ranks, F.lower("sjp"), F.lower("name"))
    assert rows(joined) == [("Ab", "aB", 1), ("x", None, None)]
