from datetime import date, datetime

from pyspark.sql import functions as F

from pulsetrail.functions import dates, values, vectors
from pulsetrail.operators import cleaning, encoding


def one(df):
    return tuple(df.first())


def test_date_examples(spark):
    df = spark.createDataFrame([("20210912", "20210508", "20210532", "x")], "a string, b string, c string, d string")
    assert one(
        df.select(
            dates.shift_date("a", -1),
            dates.shift_date("a", -1, dates.COMPACT),
            dates.reformat_date("b"),
            dates.reformat_date("c"),
            dates.reformat_date("d"),
        )
    ) == ("2021-09-11", "20210911", "2021-05-08", None, None)
    assert dates.day("20210912", -1) == "2021-09-11"
    assert dates.day("2021-03-01", -1, dates.COMPACT) == "20210228"


def test_elapsed_and_calendar_days(spark):
    df = spark.createDataFrame([(datetime(2021, 5, 1, 23, 0),)], "ts timestamp")
    found = df.select(
        dates.elapsed_days("ts", F.lit("2021-05-03 22:59:59")),
        dates.days_between(F.lit("2021-05-03"), "ts"),
        dates.day_string("ts", 3),
        dates.dormant("ts", F.lit(date(2021, 5, 4)), 3),
    )
    assert one(found) == (1, 2, "20210504", True)


def test_ratio_edge_cases(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2), (3, 2)], "a int, b int")
    found = df.select(values.safe_ratio("a", "b"), values.ratio("a", "b")).collect()
    assert [tuple(r) for r in found] == [(0.0, None), (0.0, None), (0.0, None), (1.5, 1.5)]


def test_numeric_ids_never_raise(spark, rows):
    df = spark.createDataFrame([("12",), ("0",), ("-3",), ("",), ("a1",), (None,), ("9" * 30,)], "u string")
    assert rows(df.where(values.is_numeric_id("u"))) == [("12",)]


def test_labels_and_defaults(spark):
    df = spark.createDataFrame([(138.0, None, ""), (None, "k", None)], "x double, key string, s string")
    found = df.select(
        values.threshold_label("x", 137),
        values.match_fill("s", "key", "none"),
        values.default_to("s", "d"),
        values.non_empty("s"),
    ).collect()
    assert [tuple(r) for r in found] == [(1, "none", "", False), (0, None, "d", False)]


def test_tokens(spark):
    df = spark.createDataFrame([("A|b||C",), ("",)], "s string")
    assert [r[0] for r in df.select(values.tokens("s", r"\|")).collect()] == [["a", "b", "c"], []]


def test_map_key_difference(spark):
    df = spark.sql("select map(2,3,0,2,5,2) as a, map(0,3,2,2,6,2) as b")
    assert one(df.select(cleaning.array_difference("a", "b"))) == ([5],)


def test_one_hot_of_a_flag(spark):
    df = spark.createDataFrame([(0,), (1,)], "f int")
    assert [r[0] for r in df.select(encoding.one_hot("f", 2)).collect()] == [[1.0], [0.0]]


def test_pairs_are_ordered_by_index(spark):
    df = spark.sql("select array(struct(3 as index, 1.0D as value), struct(1 as index, 2.0D as value)) as p")
    assert one(df.select(vectors.render_pairs("p"))) == ("1:2.0 3:1.0",)


def test_distance(spark):
    df = spark.sql("select array(0.0D, 3.0D) as a, array(4.0D, 0.0D) as b")
    assert one(df.select(vectors.euclidean("a", "b"))) == (5.0,)


def test_profiles(spark):
    names = list(encoding.ORDINAL_PROFILE)
    user = ("M", "25-34", "中", "未婚", "Y", "N", "Y", "N", "N", "N", "N", "Y")
    df = spark.createDataFrame([user], names)
    assert df.select(encoding.ordinal_profile()).first()[0] == [1, 7, 1, 1, 0, 1, 0, 1, 1, 1, 1, 0]
    assert df.select(encoding.sparse_profile()).first()[0] == [1, 9, 12, 15, 16, 18, 23]


def test_every_profile_value_has_its_own_position():
    used = [p for table, other in encoding.SPARSE_PROFILE.values() for p in (*table.values(), other) if p]
    assert len(used) == len(set(used)) and max(used) == encoding.SPARSE_PROFILE_WIDTH


def test_multi_hot_drops_unknown_and_repeated_entries(spark, rows):
    vocab = spark.createDataFrame([("a", 0), ("b", 1)], "token string, index long")
    df = spark.createDataFrame([(1, "b,a,b"), (2, "z"), (3, None)], "id int, s string")
    found = encoding.multi_hot(df, "id", "s", ",", vocab)
    assert rows(found) == [(1, [0, 1]), (2, []), (3, [])]


def test_unknown_category_raises_without_keep(spark):
    import pytest

    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    index = encoding.category_index(df.where("c = 'a'"), "c")
    assert encoding.index_column(df, "c", index, "i", keep=True).agg(F.max("i")).first()[0] == 1
    with pytest.raises(Exception, match="unknown category in c: b"):
        encoding.index_column(df, "c", index, "i").collect()


def test_long_baskets_come_in_parts(spark):
    taken = spark.range(25).selectExpr("'u' as user", "cast(id as string) as item", "'d' as day")
    lone = spark.sql("select 'v' as user, '1' as item, 'd' as day")
    found = cleaning.baskets(taken.unionByName(lone), "user", "item", "day", chunk=10)
    parts = sorted((r["part"], r["items"]) for r in found.collect())
    assert [p for p, _ in parts] == [0, 1, 2]
    assert [i for _, items in parts for i in items] == sorted(str(n) for n in range(25))
