"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.cleaning import USER_DAYS_SQL, user_days
from pulsetrail.catalog.registry import query, table
from pulsetrail.functions.values import match_fill
from pulsetrail.functions.vectors import zeros
from pulsetrail.operators.cleaning import fill_defaults, popular_items
from pulsetrail.operators.encoding import category_index
from pulsetrail.operators.joins import (
    keep_known,
    keep_unseen,
    lookup,
    lookup_join,
    lookup_on,
    with_candidate_table,
)



@query(
    "semi_payers",
    """select c_custkey, c_name from customer where c_custkey in (
           select o_custkey from orders where o_orderdate >= timestamp '2000-08-01')""",
)
def semi_payers(spark: SparkSession, folder: str) -> DataFrame:
    payers = table(spark, folder, "orders").where("o_orderdate >= timestamp '2000-08-01'")
    payers = payers.select(F.col("o_custkey").alias("c_custkey"))
    return keep_known(table(spark, folder, "customer"), payers, "c_custkey").select(
        "c_custkey", "c_name"
    )


@query(
    "anti_candidates_topk",
    """select l_partkey, count(distinct l_orderkey) as users from lineitem
       where l_partkey not in (
           select l_partkey from lineitem where l_returnflag = 'R'
           and l_shipdate >= timestamp '1998-01-01' and l_shipdate <= timestamp '1999-12-31')
       group by l_partkey order by users desc, l_partkey limit 50""",
)
def anti_candidates_topk(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    seen = lines.where(
        (F.col("l_returnflag") == "R")
        & F.col("l_shipdate").between(F.lit("1998-01-01").cast("timestamp"), F.lit("1999-12-31").cast("timestamp"))
    )
    return popular_items(keep_unseen(lines, seen, "l_partkey"), "l_partkey", "l_orderkey", 50)


@query(
    "expr_key_join",
    """with ranks as (
           select upper(event_type) as sjp, row_number() over (order by count(*) desc, event_type) as rank
           from events group by event_type)
       select e.event_id, coalesce(r.sjp, 'other') as sjp
       from events e left join (select sjp from ranks where rank <= 3) r
       on lower(e.event_type) = lower(r.sjp)""",
)
def expr_key_join(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    ranks = category_index(events, "event_type").where("index + 1 <= 3")
    ranks = ranks.select(F.upper("event_type").alias("sjp"))
    joined = lookup_on(events, ranks, F.lower("event_type"), F.lower("sjp"))
    return joined.select("event_id", match_fill("sjp", "sjp", "other").alias("sjp"))


@query(
    "composite_left_join",
    f"""with d as ({USER_DAYS_SQL})
        select a.user_id, a.dt, a.events, coalesce(round(b.spent, 4), 0.0) as spent
        from d a left join (
            select user_id, strftime(ts, '%Y-%m-%d') as dt, sum(value) as spent
            from events where event_type = 'purchase' group by 1, 2) b
        on a.user_id = b.user_id and a.dt = b.dt""",
)
def composite_left_join(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").where("event_type = 'purchase'")
    spent = events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    spent = spent.agg(F.round(F.sum("value"), 4).alias("spent"))
    days = user_days(spark, folder).select("user_id", "dt", "events")
    return fill_defaults(days.join(spent, ["user_id", "dt"], "left"), {"spent": 0.0})


@query(
    "candidate_pairs",
    """select c_custkey, p as priority from (select distinct c_custkey from customer),
       (select distinct o_orderpriority as p from orders)""",
)
def candidate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "customer").select("c_custkey").distinct()
    priorities = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("priority"))
    return with_candidate_table(users, priorities.distinct())


@query(
    "lookup_default",
    """select c_custkey, cast(len(v) as integer) as width, round(v[1], 6) as head,
              round(list_sum(v), 5) as total
       from (select c_custkey, case when vec_id is null
                    then list_transform(range(64), lambda x: cast(0 as double))
                    else list_transform(embedding, lambda x: cast(x as double)) end as v
             from customer left join embeddings on c_custkey = vec_id)""",
)
def lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("c_custkey"), F.col("embedding").cast("array<double>").alias("vec")
    )
    found = lookup(
        table(spark, folder, "customer").select("c_custkey"), vectors, "c_custkey", {"vec": zeros(64)}
    )
    return found.select(
        "c_custkey",
        F.size("vec").alias("width"),
        F.round(F.col("vec")[0], 6).alias("head"),
        F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
    )


@query(
    "endpoint_join",
    """select o_orderkey, c_name, n_name from orders
       join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
)
def endpoint_join(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    named = lookup_join(orders, table(spark, folder, "customer"), "c_custkey", "inner")
    named = lookup_join(named, nations, "c_nationkey", "inner")
    return named.select("o_orderkey", "c_name", "n_name")


@query(
    "using_join",
    """select l_partkey, p_brand, lines from
       (select l_partkey, count(*) as lines from lineitem group by l_partkey)
       join (select p_partkey as l_partkey, p_brand from part) using (l_partkey)""",
)
def using_join(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("lines"))
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return lines.join(parts, "l_partkey").select("l_partkey", "p_brand", "lines")


def _spread(spark: SparkSession, folder: str, how: str) -> DataFrame:
    """Lines joined to what is known of their order, keys with four lines or more spread by hand."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    orders = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lookup_join(lines, orders, "l_orderkey", how, hot_rows=4)


_LINES_SQL = "select l_orderkey, l_linenumber, l_quantity from lineitem"
_KNOWN_SQL = "l_orderkey in (select o_orderkey from orders where o_orderstatus = 'F')"


@query(
    "spread_left",
    """select l_orderkey, l_linenumber, l_quantity, o_custkey from lineitem
       left join (select * from orders where o_orderstatus = 'F') on l_orderkey = o_orderkey""",
)
def spread_left(spark: SparkSession, folder: str) -> DataFrame:
    return _spread(spark, folder, "left")


@query(
    "spread_inner",
    """select l_orderkey, l_linenumber, l_quantity, o_custkey from lineitem
       join (select * from orders where o_orderstatus = 'F') on l_orderkey = o_orderkey""",
)
def spread_inner(spark: SparkSession, folder: str) -> DataFrame:
    return _spread(spark, folder, "inner")


@query("spread_semi", f"{_LINES_SQL} where {_KNOWN_SQL}")
def spread_semi(spark: SparkSession, folder: str) -> DataFrame:
    return _spread(spark, folder, "left_semi")


@query("spread_anti", f"{_LINES_SQL} where not {_KNOWN_SQL}")
def spread_anti(spark: SparkSession, folder: str) -> DataFrame:
    return _spread(spark, folder, "left_anti")
