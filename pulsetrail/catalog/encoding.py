"""Category, vocabulary, profile and text encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.functions.values import tokens
from pulsetrail.functions.vectors import render
from pulsetrail.operators.encoding import (
    SPARSE_PROFILE_WIDTH,
    category_index,
    chi_square,
    index_column,
    multi_hot,
    one_hot,
    sparse_one_hot,
    ordinal_profile,
    positions_to_vector,
    sparse_profile,
    vocabulary,
)
from pulsetrail.operators.text import tfidf_terms
from pulsetrail.session import scratch_path
from pulsetrail.sources.formats import read_libsvm, write_libsvm

# The twelve profile fields, derived from customers by expressions both engines read.
PROFILE_SQL = {
    "bd_sex": "case when c_nationkey % 2 = 0 then 'F' else 'M' end",
    "bd_age": """case c_nationkey % 8 when 0 then '35-44' when 1 then '18-24' when 2 then '45-54'
                 when 3 then '65以上' when 4 then '18以下' when 5 then '25-34' when 6 then '55-64'
                 else 'unknown' end""",
    "bd_consume": "case when c_acctbal > 6000 then '高' when c_acctbal > 2500 then '中' else '低' end",
    "bd_marriage": "case when c_mktsegment < 'F' then '已婚' else '未婚' end",
    "bd_high_value": "case when c_acctbal > 8000 then 'Y' else 'N' end",
    "bd_low_value": "case when c_acctbal < 500 then 'Y' else 'N' end",
    "bd_sing": "case when c_mktsegment = 'BUILDING' then 'Y' else 'N' end",
    "bd_dance": "case when c_mktsegment = 'MACHINERY' then 'Y' else 'N' end",
    "bd_talk": "case when c_nationkey % 3 = 0 then 'Y' else 'N' end",
    "bd_outdoor": "case when c_nationkey % 5 = 1 then 'Y' else 'N' end",
    "bd_game": "case when c_nationkey % 7 = 2 then 'Y' else 'N' end",
    "bd_sport": "case when c_acctbal > 4000 then 'Y' else 'N' end",
}
FIELDS_SQL = ", ".join(f"{expr} as {name}" for name, expr in PROFILE_SQL.items())


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with the twelve profile fields."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey", "c_acctbal", *[f"{expr} as {name}" for name, expr in PROFILE_SQL.items()]
    )


ORDINAL_SQL = " || ',' || ".join(
    f"cast({code} as varchar)"
    for code in [
        "case bd_sex when 'F' then 0.0 else 1.0 end",
        """case bd_age when '35-44' then 1.0 when '18-24' then 3.0 when '45-54' then 4.0
           when '65以上' then 5.0 when '18以下' then 6.0 when '25-34' then 7.0
           when '55-64' then 8.0 else 0.0 end""",
        "case bd_consume when '低' then 0.0 when '中' then 1.0 else 2.0 end",
        "case bd_marriage when '已婚' then 0.0 else 1.0 end",
        *[
            f"case bd_{flag} when 'Y' then 0.0 else 1.0 end"
            for flag in (
                "high_value", "low_value", "sing", "dance", "talk", "outdoor", "game", "sport",
            )
        ],
    ]
)

POSITIONS_SQL = """list_filter([
    case bd_sex when 'M' then 1 else 2 end,
    case bd_age when '35-44' then 3 when '18-24' then 5 when '45-54' then 6 when '65以上' then 7
                when '18以下' then 8 when '25-34' then 9 when '55-64' then 10 end,
    case bd_consume when '高' then 11 when '中' then 12 when '低' then 13 end,
    case bd_marriage when '已婚' then 14 when '未婚' then 15 end,
    case bd_high_value when 'Y' then 16 end, case bd_low_value when 'Y' then 17 end,
    case bd_sing when 'Y' then 18 end, case bd_dance when 'Y' then 19 end,
    case bd_talk when 'Y' then 20 end, case bd_outdoor when 'Y' then 21 end,
    case bd_game when 'Y' then 22 end, case bd_sport when 'Y' then 23 end],
    lambda p: p is not null)"""


@query(
    "profile_ordinal",
    f"""select c_custkey, {ORDINAL_SQL} as codes from (select *, {FIELDS_SQL} from customer)""",
)
def profile_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    rows = profiles(spark, folder)
    return rows.select("c_custkey", render(ordinal_profile()).alias("codes"))


@query(
    "profile_sparse",
    f"""select c_custkey, array_to_string({POSITIONS_SQL}, ',') as positions
        from (select *, {FIELDS_SQL} from customer)""",
)
def profile_sparse(spark: SparkSession, folder: str) -> DataFrame:
    rows = profiles(spark, folder)
    return rows.select("c_custkey", render(sparse_profile()).alias("positions"))


@query(
    "libsvm_roundtrip",
    f"""select label, positions, count(*) as n from (
            select case when c_acctbal > 5000 then 1.0::double else 0.0::double end as label,
                   array_to_string({POSITIONS_SQL}, ',') as positions
            from (select *, {FIELDS_SQL} from customer)) group by 1, 2""",
)
def libsvm_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    vectors = positions_to_vector(sparse_profile(), SPARSE_PROFILE_WIDTH)
    rows = profiles(spark, folder).select(
        F.when(F.col("c_acctbal") > 5000, 1.0).otherwise(0.0).alias("label"),
        vectors.alias("features"),
    )
    path = scratch_path(spark, "libsvm")
    write_libsvm(rows, path)
    flags = vector_to_array("features")
    numbered = F.transform(flags, lambda x, i: F.when(x != 0, i + 1))
    back = read_libsvm(spark, path, SPARSE_PROFILE_WIDTH)
    back = back.select("label", render(F.array_compact(numbered)).alias("positions"))
    return back.groupBy("label", "positions").agg(F.count("*").alias("n"))


@query(
    "string_index",
    """with i as (select c_mktsegment,
                         row_number() over (order by count(*) desc, c_mktsegment) - 1 as segment_index
                  from customer group by c_mktsegment)
       select c_custkey, c_mktsegment, segment_index from customer join i using (c_mktsegment)""",
)
def string_index(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    index = category_index(customers, "c_mktsegment")
    return index_column(customers, "c_mktsegment", index, "segment_index")


@query(
    "string_index_keep",
    """with i as (select event_type, row_number() over (order by count(*) desc, event_type) - 1 as n
                  from events where event_type <> 'error' group by event_type)
       select event_id, coalesce(n, (select count(*) from i)) as type_index
       from events left join i using (event_type)""",
)
def string_index_keep(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    index = category_index(events.where("event_type <> 'error'"), "event_type")
    indexed = index_column(events, "event_type", index, "type_index", keep=True)
    return indexed.select("event_id", "type_index")


@query(
    "one_hot",
    """with i as (select c_mktsegment,
                         row_number() over (order by count(*) desc, c_mktsegment) - 1 as n
                  from customer group by c_mktsegment)
       select c_custkey, array_to_string(list_transform(range((select count(*) - 1 from i)),
                  lambda k: case when k = n then '1.0' else '0.0' end), ',') as vec
       from customer join i using (c_mktsegment)""",
)
def one_hot_query(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    index = category_index(customers, "c_mktsegment")
    indexed = index_column(customers, "c_mktsegment", index, "n")
    sized = indexed.withColumn("size", index.agg(F.count("*")).scalar())
    return sized.select("c_custkey", render(one_hot("n", F.col("size"))).alias("vec"))


SPARSE_SQL = """with i as (select c_mktsegment,
                         row_number() over (order by count(*) desc, c_mktsegment) - 1 as n
                  from customer where {where} group by c_mktsegment)
       select c_custkey, cast((select count(*) - 1 from i) as integer) as size,
              case when n < (select count(*) - 1 from i) then cast(n as varchar) else '' end as indices
       from customer join i using (c_mktsegment)"""


def _sparse(spark: SparkSession, folder: str, where: str) -> DataFrame:
    customers = table(spark, folder, "customer").where(where).select("c_custkey", "c_mktsegment")
    index = category_index(customers, "c_mktsegment")
    indexed = index_column(customers, "c_mktsegment", index, "n")
    sized = indexed.withColumn("size", index.agg(F.count("*")).scalar())
    coded = sized.select("c_custkey", sparse_one_hot("n", F.col("size")).alias("v"))
    places = F.transform("v.indices", lambda x: x.cast("string"))
    return coded.select("c_custkey", F.col("v.size").alias("size"), F.array_join(places, ",").alias("indices"))


@query("sparse_one_hot", SPARSE_SQL.format(where="true"))
def sparse_one_hot_query(spark: SparkSession, folder: str) -> DataFrame:
    return _sparse(spark, folder, "true")


@query("one_hot_single", SPARSE_SQL.format(where="c_mktsegment = 'BUILDING'"))
def one_hot_single(spark: SparkSession, folder: str) -> DataFrame:
    """A column with one category has no slot."""
    return _sparse(spark, folder, "c_mktsegment = 'BUILDING'")


@query(
    "flag_one_hot",
    "select o_orderkey, case when o_orderstatus = 'F' then '0.0' else '1.0' end as vec from orders",
)
def flag_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", render(one_hot(flag, 2)).alias("vec"))


VOCAB_SQL = """select token, row_number() over (order by token) - 1 as index
from (select distinct unnest(string_split(p_name, ' ')) as token from part where p_name <> '')"""


@query("vocab", VOCAB_SQL)
def vocab(spark: SparkSession, folder: str) -> DataFrame:
    return vocabulary(table(spark, folder, "part"), "p_name", " ")


@query(
    "multi_hot",
    f"""with v as ({VOCAB_SQL}),
        p as (select distinct p_partkey, unnest(string_split(p_name, ' ')) as token from part)
        select p_partkey, string_agg(cast(index as varchar), ',' order by index) as indices
        from p join v using (token) group by p_partkey""",
)
def multi_hot_query(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    words = vocabulary(parts, "p_name", " ")
    hot = multi_hot(parts, "p_partkey", "p_name", " ", words)
    return hot.withColumn("indices", render("indices"))


# Fixed value: tokens of the texts are runs between spaces, tabs and line ends.
BLANKS = "[ \\t\\r\\n]+"
TOKENS_SQL = """select doc_id, unnest(list_filter(
    regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'), lambda t: t <> '')) as term from documents"""


@query(
    "tokenize",
    """select doc_id, cast(len(t) as integer) as tokens, t[1] as head, t[len(t)] as tail
       from (select doc_id, list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'),
                                        lambda t: t <> '') as t from documents)""",
)
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", tokens("text", BLANKS).alias("t"))
    return docs.select(
        "doc_id",
        F.size("t").alias("tokens"),
        F.try_element_at("t", F.lit(1)).alias("head"),
        F.try_element_at("t", F.lit(-1)).alias("tail"),
    )


@query(
    "tfidf_terms",
    f"""with t as (select doc_id, term, count(*) as tf from ({TOKENS_SQL}) group by 1, 2),
        d as (select term, count(*) as df from t group by term)
        select doc_id, term, tf, df,
               round(tf * ln(((select count(*) from documents) + 1.0) / (df + 1.0)), 6) as weight
        from t join d using (term)""",
)
def tfidf_terms_query(spark: SparkSession, folder: str) -> DataFrame:
    terms = tfidf_terms(table(spark, folder, "documents"), "doc_id", "text", BLANKS)
    return terms.withColumn("weight", F.round("weight", 6))


def chi_square_sql(source: str, feature: str, label: str) -> str:
    return f"""with o as (select {feature} as f, {label} as l, count(*) as n from {source} group by 1, 2),
        t as (select sum(n) as n from o),
        e as (select r.f, c.l, r.n * c.n / cast(t.n as double) as expected
              from (select f, sum(n) as n from o group by f) r,
                   (select l, sum(n) as n from o group by l) c, t)
        select round(sum((coalesce(o.n, 0) - expected) * (coalesce(o.n, 0) - expected) / expected), 6)
                   as statistic,
               cast((count(distinct e.f) - 1) * (count(distinct e.l) - 1) as bigint) as dof
        from e left join o on e.f = o.f and e.l = o.l"""


@query("chi_square", chi_square_sql("lineitem", "l_returnflag", "l_linestatus"))
def chi_square_query(spark: SparkSession, folder: str) -> DataFrame:
    result = chi_square(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus")
    return result.withColumn("statistic", F.round("statistic", 6))


@query("chi_square_wide", chi_square_sql("lineitem", "l_suppkey", "l_returnflag"))
def chi_square_wide(spark: SparkSession, folder: str) -> DataFrame:
    result = chi_square(table(spark, folder, "lineitem"), "l_suppkey", "l_returnflag")
    return result.withColumn("statistic", F.round("statistic", 6))
