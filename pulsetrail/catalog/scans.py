"""Scans, partition writes and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.functions.dates import (
    day,
    day_string,
    days_between,
    dormant,
    elapsed_days,
    reformat_date,
    shift_date,
)
from pulsetrail.plans.feature_sets import CLICK_SNAPSHOTS, CLICK_TEST_OFFSET
from pulsetrail.session import scratch_path
from pulsetrail.sources.tables import (
    project_to,
    scan_all,
    scan_day,
    scan_days,
    scan_range,
    write_partition,
    write_partitions,
)

COLUMNS = ["event_id", "user_id", "event_type", "value", "dt"]
EVENTS_SQL = "select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') as dt from events"


def daily_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).select(*COLUMNS)


def events_by_day(spark: SparkSession, folder: str) -> str:
    """The events as a table partitioned by day."""
    path = scratch_path(spark, "events-by-day")
    write_partitions(daily_events(spark, folder), path, ["dt"])
    return path


@query("partition_scan", f"select * from ({EVENTS_SQL}) where dt = '2024-01-30'")
def partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_day(spark, events_by_day(spark, folder), "2024-01-30").select(*COLUMNS)


@query(
    "multi_snapshot",
    f"""select * from ({EVENTS_SQL})
        where dt in ('2024-01-30', '2024-01-24', '2024-01-17', '2024-01-10', '2024-01-03')""",
)
def multi_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    path = events_by_day(spark, folder)
    return scan_days(spark, path, "20240130", CLICK_SNAPSHOTS).select(*COLUMNS)


@query(
    "range_scan", f"select * from ({EVENTS_SQL}) where dt >= '2024-01-10' and dt <= '2024-01-19'"
)
def range_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = events_by_day(spark, folder)
    return scan_range(spark, path, "2024-01-10", "2024-01-19").select(*COLUMNS)


@query(
    "out_of_time_test",
    f"select * from ({EVENTS_SQL}) where dt in ('2024-01-10', '2024-01-21')",
)
def out_of_time_test(spark: SparkSession, folder: str) -> DataFrame:
    path = events_by_day(spark, folder)
    earlier = scan_day(spark, path, day("20240120", CLICK_TEST_OFFSET))
    later = scan_day(spark, path, day("20240120", 1))
    return earlier.unionByName(later).select(*COLUMNS)


@query(
    "partition_overwrite",
    f"""select dt, count(*) as n,
               round(sum(case when dt = '2024-01-05' then value * 2 else value end), 4) as total
        from ({EVENTS_SQL}) group by dt""",
)
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = events_by_day(spark, folder)
    renewed = daily_events(spark, folder).where("dt = '2024-01-05'")
    renewed = renewed.withColumn("value", F.col("value") * 2).drop("dt")
    write_partition(renewed, path, dt="2024-01-05")
    after = scan_all(spark, path)
    return after.groupBy("dt").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "arm_overwrite",
    f"""select dt, dtype, count(*) as n, round(sum(v), 4) as total
        from (select dt, case when event_type = 'purchase' then '1' else '0' end as dtype,
                     case when dt = '2024-01-05' and event_type = 'purchase' then -value
                          else value end as v
              from ({EVENTS_SQL})) group by dt, dtype""",
)
def arm_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "events-by-arm")
    dtype = F.when(F.col("event_type") == "purchase", "1").otherwise("0")
    arms = daily_events(spark, folder).withColumn("dtype", dtype)
    write_partitions(arms, path, ["dt", "dtype"])
    renewed = arms.where("dt = '2024-01-05' and dtype = '1'").withColumn("value", -F.col("value"))
    write_partition(renewed.drop("dt", "dtype"), path, dt="2024-01-05", dtype="1")
    after = scan_all(spark, path)
    return after.groupBy("dt", "dtype").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "partition_emptied",
    f"""select dt, count(*) as n, round(sum(value), 4) as total
        from ({EVENTS_SQL}) where dt <> '2024-01-05' group by dt""",
)
def partition_emptied(spark: SparkSession, folder: str) -> DataFrame:
    """A day that is overwritten without rows holds none afterwards."""
    path = events_by_day(spark, folder)
    write_partition(daily_events(spark, folder).where("false"), path, dt="2024-01-05")
    after = scan_all(spark, path)
    return after.groupBy("dt").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


DAY_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, dt string"


@query("day_folders", f"select * from ({EVENTS_SQL}) where dt in ('2024-01-09', '2024-01-10')")
def day_folders(spark: SparkSession, folder: str) -> DataFrame:
    """The same days by their folders, of a table whose schema is given."""
    path = events_by_day(spark, folder)
    found = scan_range(spark, path, "2024-01-09", "2024-01-10", DAY_SCHEMA)
    none = scan_day(spark, path, "1999-01-01", DAY_SCHEMA)
    return found.unionByName(none).select(*COLUMNS)


@query(
    "event_projection",
    """select cast(user_id as varchar) as hdid, event_type as action, value as score,
              cast(event_id as integer) as event_no, 'uid' as types, 1 as is_exposure
       from events""",
)
def event_projection(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("hdid"),
        F.col("event_type").alias("action"),
        F.col("value").alias("score"),
        F.col("event_id").alias("event_no"),
        F.lit("uid").alias("types"),
        F.lit(1).alias("is_exposure"),
    )
    schema = {
        "hdid": "string",
        "action": "string",
        "score": "double",
        "event_no": "int",
        "types": "string",
        "is_exposure": "int",
    }
    return project_to(events, schema)


@query(
    "starred_derive",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
              strftime(o_orderdate, '%Y-%m-%d') as o_orderdate,
              round(o_totalprice / 1000, 6) as price_k, o_custkey as custkey
       from orders""",
)
def starred_derive(spark: SparkSession, folder: str) -> DataFrame:
    table(spark, folder, "orders").createOrReplaceTempView("derived_orders")
    return spark.sql(
        """select * except (o_orderdate), date_format(o_orderdate, 'yyyy-MM-dd') as o_orderdate,
                  round(o_totalprice / 1000, 6) as price_k, o_custkey as custkey
           from derived_orders"""
    )


@query(
    "date_shift",
    """select o_orderkey,
              strftime(d - interval 1 day, '%Y-%m-%d') as day_before,
              strftime(d + interval 30 day, '%Y%m%d') as compact_later,
              strftime(d, '%Y-%m-%d') as dashed,
              cast(null as varchar) as no_date,
              strftime(d + interval 2 day, '%Y%m%d') as two_later
       from (select o_orderkey, cast(o_orderdate as date) as d from orders)""",
)
def date_shift(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    orders = orders.withColumn("compact", F.date_format("o_orderdate", "yyyyMMdd"))
    return orders.select(
        "o_orderkey",
        shift_date("compact", -1).alias("day_before"),
        shift_date("compact", 30, "yyyyMMdd").alias("compact_later"),
        reformat_date("compact").alias("dashed"),
        reformat_date("o_orderpriority").alias("no_date"),
        day_string("o_orderdate", 2).alias("two_later"),
    )


@query(
    "elapsed_days",
    """select event_id,
              cast(floor(epoch(timestamp '2024-02-01 12:00:00' - ts) / 86400) as bigint) as blocks,
              cast(date_diff('day', cast(ts as date), date '2024-02-01') as bigint) as calendar
       from events""",
)
def elapsed_days_query(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        elapsed_days("ts", F.lit("2024-02-01 12:00:00")).alias("blocks"),
        days_between(F.lit("2024-02-01"), "ts").cast("long").alias("calendar"),
    )


@query(
    "dormant_users",
    """select o_custkey, strftime(last_active, '%Y-%m-%d') as last_active
       from (select o_custkey, cast(max(o_orderdate) as date) as last_active from orders
             group by o_custkey)
       where last_active <= date '2001-06-30' - 3""",
)
def dormant_users(spark: SparkSession, folder: str) -> DataFrame:
    last = table(spark, folder, "orders").groupBy("o_custkey")
    last = last.agg(F.max("o_orderdate").cast("date").alias("last_active"))
    idle = last.where(dormant("last_active", F.lit("2001-06-30").cast("date"), 3))
    return idle.withColumn("last_active", F.date_format("last_active", "yyyy-MM-dd"))
