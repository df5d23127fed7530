"""Null handling, filters, aggregation and row-level arrays."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.functions.values import (
    as_number,
    default_to,
    is_numeric_id,
    match_fill,
    non_empty,
    ratio,
    safe_ratio,
    threshold_label,
)
from pulsetrail.functions.vectors import render, render_pairs
from pulsetrail.operators.cleaning import (
    baskets,
    class_balance,
    class_counts,
    distinct_keys,
    elements,
    fill_defaults,
    mean_vector,
    merge_lowest,
    minmax,
    popular_items,
    require_all,
)
from pulsetrail.operators.encoding import assembled
from pulsetrail.operators.joins import keep_unseen
from pulsetrail.operators.ordering import first_per_key


def user_days(spark: SparkSession, folder: str) -> DataFrame:
    """Activity per user and day."""
    events = table(spark, folder, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    return events.groupBy("user_id", "dt").agg(
        F.count("*").alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.sum("value").alias("total"),
    )


USER_DAYS_SQL = """select user_id, strftime(ts, '%Y-%m-%d') as dt, count(*) as events,
       count(*) filter (event_type = 'purchase') as purchases,
       count(*) filter (event_type = 'click') as clicks, sum(value) as total
from events group by 1, 2"""


@query(
    "null_clean",
    """select c.c_custkey, coalesce(p.n, 0) as purchases,
              case when p.user_id is null then 'never' else p.last_day end as last_day,
              coalesce(p.kind, 'other') as kind
       from customer c left join (
           select user_id, count(*) as n,
                  nullif(strftime(max(ts), '%Y-%m-%d'), '2024-01-30') as last_day,
                  nullif(max(event_type), 'signup') as kind
           from events where event_type in ('purchase', 'signup') group by user_id) p
       on c.c_custkey = p.user_id""",
)
def null_clean(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where(F.col("event_type").isin("purchase", "signup"))
    last = F.date_format(F.max("ts"), "yyyy-MM-dd")
    buyers = events.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.nullif(last, F.lit("2024-01-30")).alias("last_day"),
        F.nullif(F.max("event_type"), F.lit("signup")).alias("kind"),
    )
    customers = table(spark, folder, "customer")
    joined = customers.join(buyers, customers.c_custkey == buyers.user_id, "left")
    cleaned = joined.select(
        "c_custkey",
        default_to("n", 0).alias("purchases"),
        match_fill("last_day", "user_id", "never").alias("last_day"),
        "kind",
    )
    return fill_defaults(cleaned, {"kind": "other"})


@query(
    "required_fields",
    """select event_id, nullif(event_type, 'error') as kind,
              case when value > 50 then value end as big
       from events where event_type <> 'error' and value > 50""",
)
def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("kind"),
        F.when(F.col("value") > 50, F.col("value")).alias("big"),
    )
    return require_all(events, ["kind", "big"])


@query(
    "threshold_label",
    f"""select user_id, dt, case when total > 137 then 1 else 0 end as label
        from ({USER_DAYS_SQL}) where total > 0""",
)
def threshold_label_query(spark: SparkSession, folder: str) -> DataFrame:
    days = user_days(spark, folder).where("total > 0")
    return days.select("user_id", "dt", threshold_label("total", 137).alias("label"))


@query(
    "safe_ratio",
    f"""select user_id, dt,
               round(case when clicks = 0 then 0.0 else purchases * 1.0 / clicks end, 6) as filled,
               round(case when clicks = 0 then null else purchases * 1.0 / clicks end, 6) as plain
        from ({USER_DAYS_SQL})""",
)
def safe_ratio_query(spark: SparkSession, folder: str) -> DataFrame:
    return user_days(spark, folder).select(
        "user_id",
        "dt",
        F.round(safe_ratio("purchases", "clicks"), 6).alias("filled"),
        F.round(ratio("purchases", "clicks"), 6).alias("plain"),
    )


@query(
    "numeric_guard",
    """select uid, try_cast(uid as bigint) as number
       from (select substr(c_name, 10) as uid from customer
             union all select c_mktsegment from customer
             union all select c_name from customer)
       where try_cast(uid as bigint) > 0""",
)
def numeric_guard(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    names = customers.select(
        F.explode(F.array(F.substring("c_name", 10, 20), "c_mktsegment", "c_name")).alias("uid")
    )
    return names.where(is_numeric_id("uid")).withColumn("number", as_number("uid"))


@query(
    "value_filters",
    """select o_orderkey, lower(o_orderpriority) as priority from orders
       where o_orderpriority <> '' and o_orderpriority is not null
         and (o_orderstatus = 'F' or o_totalprice > 300000)
         and lower(o_orderpriority) in ('1-urgent', '2-high')""",
)
def value_filters(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    kept = orders.where(non_empty("o_orderpriority")).where(
        (F.col("o_orderstatus") == "F") | (F.col("o_totalprice") > 300000)
    )
    priority = F.lower("o_orderpriority")
    kept = kept.where(priority.isin("1-urgent", "2-high"))
    return kept.select("o_orderkey", priority.alias("priority"))


@query(
    "first_exposure",
    """select user_id, event_id, cast(exposed as integer) as is_exposure from (
           select user_id, event_id, case when event_type = 'purchase' then '1' else '0' end as exposed,
                  row_number() over (partition by user_id
                      order by case when event_type = 'purchase' then '1' else '0' end desc,
                               ts, event_id) as rn
           from events) where rn = 1""",
)
def first_exposure(spark: SparkSession, folder: str) -> DataFrame:
    exposed = F.when(F.col("event_type") == "purchase", "1").otherwise("0")
    events = table(spark, folder, "events").withColumn("exposed", exposed)
    first = first_per_key(events, ["user_id"], [F.desc("exposed"), F.asc("ts"), F.asc("event_id")])
    return first.select("user_id", "event_id", F.col("exposed").cast("int").alias("is_exposure"))


@query(
    "class_balance",
    """select pos, neg, round(pos * 1.0 / neg, 6) as ratio
       from (select count(*) filter (toxic = 1) as pos, count(*) filter (toxic = 0) as neg
             from labels)""",
)
def class_balance_query(spark: SparkSession, folder: str) -> DataFrame:
    balance = class_balance(table(spark, folder, "labels"), "toxic")
    return balance.withColumn("ratio", F.round("ratio", 6))


@query(
    "strata_counts",
    "select l_returnflag, l_linestatus, count(*) as cnt from lineitem group by 1, 2",
)
def strata_counts(spark: SparkSession, folder: str) -> DataFrame:
    return class_counts(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("distinct_keys", "select distinct l_partkey, l_suppkey from lineitem")
def distinct_keys_query(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_keys(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"])


@query(
    "union_strata",
    """select event_id, event_type from events where event_type = 'purchase'
       union all select event_id, event_type from events where value > 250""",
)
def union_strata(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    one, two = events.where("event_type = 'purchase'"), events.where("value > 250")
    return one.unionByName(two).drop("value")


@query(
    "key_union",
    """select user_id, min(v) as lowest from (
           select user_id, value as v from events where event_type = 'purchase'
           union all select user_id, value from events where event_type = 'click') group by user_id""",
)
def key_union(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_type", F.col("value").alias("lowest"))
    bought = events.where("event_type = 'purchase'").drop("event_type")
    clicked = events.where("event_type = 'click'").drop("event_type")
    return merge_lowest(bought, clicked, ["user_id"], "lowest")


@query(
    "key_difference",
    f"""select user_id, dt from ({USER_DAYS_SQL}) where clicks > 0 and purchases = 0""",
)
def key_difference(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    clicked = distinct_keys(events.where("event_type = 'click'"), ["user_id", "dt"])
    return keep_unseen(clicked, events.where("event_type = 'purchase'"), ["user_id", "dt"])


@query(
    "popular_parts",
    """select l_partkey, count(distinct l_orderkey) as users from lineitem
       group by l_partkey order by users desc, l_partkey limit 50""",
)
def popular_parts(spark: SparkSession, folder: str) -> DataFrame:
    return popular_items(table(spark, folder, "lineitem"), "l_partkey", "l_orderkey", 50)


@query(
    "pair_arrays",
    """select l_orderkey, l_partkey,
              '1:' || cast(l_quantity as varchar) || ' 2:' || cast(l_discount as varchar)
              || ' 3:' || cast(l_tax as varchar) as pairs
       from lineitem""",
)
def pair_arrays(spark: SparkSession, folder: str) -> DataFrame:
    def pair(index: int, name: str):
        return F.struct(F.lit(index).alias("index"), F.col(name).alias("value"))

    pairs = F.array(pair(3, "l_tax"), pair(1, "l_quantity"), pair(2, "l_discount"))
    lines = table(spark, folder, "lineitem")
    return lines.select("l_orderkey", "l_partkey", render_pairs(pairs).alias("pairs"))


@query(
    "assembled_arrays",
    """select l_orderkey, l_partkey,
              cast(l_quantity as varchar) || ',' || cast(l_discount as varchar)
              || ',' || cast(l_tax as varchar) as features
       from lineitem where l_tax <> 0 and l_discount <> 0""",
)
def assembled_arrays(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumns(
        {c: F.nullif(c, F.lit(0.0)) for c in ("l_tax", "l_discount")}
    )
    rows = assembled(lines, ["l_quantity", "l_discount", "l_tax"])
    return rows.select("l_orderkey", "l_partkey", render("features").alias("features"))


@query(
    "basket",
    """with taken as (
           select distinct o_custkey as hdid, l_partkey as doc_id,
                  strftime(o_orderdate, '%Y-%m-%d') as dt
           from lineitem join orders on l_orderkey = o_orderkey),
       placed as (
           select *, row_number() over (partition by hdid order by dt, doc_id) - 1 as place
           from taken)
       select hdid, place // 1000 as part, string_agg(cast(doc_id as varchar), ',' order by place) as items
       from placed group by 1, 2 having count(*) >= 2 or place // 1000 > 0""",
)
def basket(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("hdid"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
    )
    taken = table(spark, folder, "lineitem").join(orders, "l_orderkey")
    taken = taken.select("hdid", F.col("l_partkey").alias("doc_id"), "dt")
    return baskets(taken, "hdid", "doc_id", "dt").withColumn("items", render("items"))


@query(
    "mean_vector",
    """select label, cast(i - 1 as integer) as dim, round(avg(cast(embedding[i] as double)), 6) as value
       from embeddings, range(1, 65) r(i) group by 1, 2""",
)
def mean_vector_query(spark: SparkSession, folder: str) -> DataFrame:
    means = mean_vector(table(spark, folder, "embeddings"), ["label"], "embedding")
    return elements(means, ["label"], "means").withColumn("value", F.round("value", 6))


@query(
    "centroid",
    """select cast(i - 1 as integer) as dim, round(avg(cast(embedding[i] as double)), 6) as value
       from embeddings, range(1, 65) r(i) where label in (1, 2, 3) group by 1""",
)
def centroid(spark: SparkSession, folder: str) -> DataFrame:
    chosen = table(spark, folder, "embeddings").where(F.col("label").isin(1, 2, 3))
    return elements(mean_vector(chosen, [], "embedding"), [], "means").withColumn(
        "value", F.round("value", 6)
    )


@query(
    "exact_distance",
    """with c as (select i, avg(cast(embedding[i] as double)) as m
                  from embeddings, range(1, 65) r(i) where label in (1, 2, 3) group by i)
       select vec_id as idA,
              round(sqrt(sum((cast(embedding[i] as double) - m) * (cast(embedding[i] as double) - m))), 6)
                  as dist
       from embeddings, c group by vec_id""",
)
def exact_distance(spark: SparkSession, folder: str) -> DataFrame:
    from pulsetrail.operators.similarity import centroid_distances

    vectors = table(spark, folder, "embeddings")
    chosen = mean_vector(vectors.where(F.col("label").isin(1, 2, 3)), [], "embedding")
    middle = chosen.select(vector_to_array("means").alias("m"))
    distances = centroid_distances(vectors, "vec_id", "embedding", middle)
    return distances.withColumn("dist", F.round("dist", 6))


@query(
    "minmax",
    """select o_orderkey,
              round((o_totalprice - min(o_totalprice) over ())
                    / (max(o_totalprice) over () - min(o_totalprice) over ()), 6) as o_totalprice,
              round((o_custkey - min(o_custkey) over ())
                    / (max(o_custkey) over () - min(o_custkey) over ()), 6) as o_custkey,
              0.5::double as fixed
       from orders""",
)
def minmax_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("fixed", F.lit(7))
    scaled = minmax(orders, ["o_totalprice", "o_custkey", "fixed"])
    return scaled.select(
        "o_orderkey",
        F.round("o_totalprice", 6).alias("o_totalprice"),
        F.round("o_custkey", 6).alias("o_custkey"),
        "fixed",
    )
