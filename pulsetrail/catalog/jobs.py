"""The relational half of the complete jobs: the rows that each job trains on or scores.

The daily tables that the jobs read are derived from the events by Spark and written by day.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.catalog.sampling import place
from pulsetrail.functions.dates import day
from pulsetrail.operators.pipelines import TextColumn
from pulsetrail.plans import churn, click, exposure, feature_sets as sets, risk
from pulsetrail.session import scratch_path
from pulsetrail.sources.tables import write_partitions

DT = "20240130"
CHURN_DT = "20240122"  # two more days are left for the label
EVENTS_SQL = """select cast(user_id as varchar) as hdid, event_type, value, ts, cast(ts as date) as d,
       strftime(ts, '%Y-%m-%d') as dt from events"""
ACCOUNT_SQL = "case when user_id % 7 = 0 then 'guest-' || user_id else cast(user_id as varchar) end"


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("hdid"), "event_type", "value", "ts",
        F.to_date("ts").alias("d"), F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )


def written(df: DataFrame, label: str) -> str:
    """The path of ``df`` as a table by day."""
    path = scratch_path(df.sparkSession, label)
    write_partitions(df, path, ["dt"])
    return path


# ---------------------------------------------------------------- payers of a day

ACCOUNTS_SQL = f"""select {ACCOUNT_SQL} as uid, cast('2024-01-30' as varchar) as dt,
       count(distinct event_type) as chid_90, count(*) filter (event_type = 'click') as paymethod_90,
       count(*) filter (event_type = 'view') as buyerid_cnt,
       count(*) filter (event_type = 'purchase' and value > 120) as alldt_90,
       max(value) as max_ip_cnt, min(value) as avg_ip_cnt, count(*) as stdev_ip_cnt,
       user_id % 2 as is_nick_modify, min(ts) as regtime
from events group by user_id"""


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """A feature row for each account on the day; some accounts have no number."""
    kind, value = F.col("event_type"), F.col("value")
    rows = table(spark, folder, "events").groupBy("user_id").agg(
        F.count_distinct("event_type").alias("chid_90"),
        F.count_if(kind == "click").alias("paymethod_90"),
        F.count_if(kind == "view").alias("buyerid_cnt"),
        F.count_if((kind == "purchase") & (value > 120)).alias("alldt_90"),
        F.max("value").alias("max_ip_cnt"),
        F.min("value").alias("avg_ip_cnt"),
        F.count("*").alias("stdev_ip_cnt"),
        F.min("ts").alias("regtime"),
    )
    return rows.withColumns({
        "uid": account("user_id"), "is_nick_modify": F.col("user_id") % 2, "dt": F.lit(day(DT)),
    }).drop("user_id")


def account(name: str):
    number = F.col(name).cast("string")
    return F.when(F.col(name) % 7 == 0, F.concat(F.lit("guest-"), number)).otherwise(number)


@query(
    "job_risk_payers",
    f"""with a as ({ACCOUNTS_SQL}),
        paid as (select distinct {ACCOUNT_SQL} as uid from events
                 where event_type = 'purchase' and strftime(ts, '%Y%m%d') = '20240130')
        select uid, coalesce(chid_90 / nullif(alldt_90, 0), 0.0) as avg_chid_times_90,
               coalesce(paymethod_90 / nullif(alldt_90, 0), 0.0) as avg_method_times_90,
               coalesce(buyerid_cnt / nullif(alldt_90, 0), 0.0) as buyer_pay_ratio,
               max_ip_cnt as max_ip_cnts, avg_ip_cnt as avg_ip_cnts, stdev_ip_cnt as stdev_ip_cnts,
               cast(is_nick_modify as varchar) as is_nick_modifys,
               cast(date_diff('day', cast(regtime as date), date '2024-01-30') as bigint) as reg_day
        from a semi join paid using (uid) where try_cast(uid as bigint) > 0""",
)
def job_risk_payers(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric accounts that paid on the day, with their ratios: what the risk job scores."""
    orders = table(spark, folder, "events").where("event_type = 'purchase'")
    orders = orders.select(account("user_id").alias("userid"), F.date_format("ts", "yyyyMMdd").alias("dt"))
    features = written(accounts(spark, folder), "accounts")
    rows = risk.scoring_rows(spark, features, written(orders, "orders-by-day"), DT)
    return rows.withColumn("reg_day", F.col("reg_day").cast("long")).select(
        "uid", *sets.RISK_RATIOS, "max_ip_cnts", "avg_ip_cnts", "stdev_ip_cnts", "is_nick_modifys", "reg_day"
    )


# ---------------------------------------------------------------- snapshots of users

SNAPSHOT_DAYS = [day(CHURN_DT, n) for n in sets.CHURN_SNAPSHOTS]
SNAPSHOTS_SQL = f"""select hdid, s.dt, count(*) filter (d <= cast(s.dt as date)) as start_cnt_d30,
       count(*) filter (d <= cast(s.dt as date) and event_type = 'purchase') as consume_cnt_d30,
       case when count(*) filter (event_type = 'purchase' and d > cast(s.dt as date)
                                  and d <= cast(s.dt as date) + 2) = 0 then 1 else 0 end as label
from ({EVENTS_SQL}) e, (select unnest({SNAPSHOT_DAYS!r}) as dt) s
where d <= cast(s.dt as date) + 2 group by hdid, s.dt"""


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Users seen up to two days after a snapshot; the label is that they bought nothing in these two."""
    days = F.filter(
        F.array(*[F.lit(d) for d in SNAPSHOT_DAYS]), lambda s: F.col("d") <= F.date_add(F.to_date(s), 2)
    )
    seen = user_events(spark, folder).withColumn("s", F.explode(days))
    before, bought = F.col("d") <= F.to_date("s"), F.col("event_type") == "purchase"
    return seen.groupBy("hdid", F.col("s").alias("dt")).agg(
        F.count_if(before).alias("start_cnt_d30"),
        F.count_if(before & bought).alias("consume_cnt_d30"),
        F.when(F.count_if(~before & bought) == 0, 1).otherwise(0).alias("label"),
    )


@query(
    "job_churn_rows",
    f"""with half as (select *, hdid || '|' || dt as row_key from ({SNAPSHOTS_SQL})
                      where {place("hdid || '|' || dt", 'first:')} < 0.5),
        r as (select 0.8 * count(*) filter (label = 1) / nullif(count(*) filter (label = 0), 0) as rate from half)
        select hdid, dt, start_cnt_d30, consume_cnt_d30, label
        from half, r where label = 1 or {place('row_key')} < rate""",
)
def job_churn_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the churn job trains on."""
    rows = churn.training_rows(spark, written(snapshots(spark, folder), "snapshots"), CHURN_DT)
    return rows.select("hdid", "dt", "start_cnt_d30", "consume_cnt_d30", "label")


# ---------------------------------------------------------------- shown items

SHOWN_SQL = f"""select hdid, event_type as doc_id, dt, count(*) as show_1,
       case when event_type <> 'error' then length(event_type) end as title_length,
       case when sum(cast(value as decimal(12, 2))) > 200 then 1 else 0 end as label
from ({EVENTS_SQL}) group by hdid, event_type, dt"""


def shown(spark: SparkSession, folder: str) -> DataFrame:
    """Users and kinds of event by day, as users and items; one kind has no title."""
    kind = F.col("event_type")
    rows = user_events(spark, folder).groupBy("hdid", kind.alias("doc_id"), "dt")
    rows = rows.agg(
        F.count("*").alias("show_1"),
        F.when(F.sum(F.col("value").cast("decimal(12, 2)")) > 200, 1).otherwise(0).alias("label"),
    )
    return rows.withColumn(
        "title_length", F.when(F.col("doc_id") != "error", F.length("doc_id")).cast("long")
    )


@query(
    "job_click_rows",
    f"""with s as (select *, hdid || '|' || doc_id || '|' || dt as row_key from ({SHOWN_SQL})
                   where title_length is not null
                     and dt in ('2024-01-03', '2024-01-10', '2024-01-17', '2024-01-24', '2024-01-30')),
        r as (select 20.0 * count(*) filter (label = 1) / nullif(count(*) filter (label = 0), 0) as rate from s)
        select hdid, doc_id, dt, show_1, title_length, label
        from s, r where label = 1 or {place('row_key')} < rate""",
)
def job_click_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the click job trains on."""
    rows = click.training_rows(spark, written(shown(spark, folder), "shown"), DT)
    return rows.select("hdid", "doc_id", "dt", "show_1", "title_length", "label")


# ---------------------------------------------------------------- exposed users

FIRST, LAST = "2024-01-05", "2024-01-28"
ACTIVE_SQL = f"""select hdid, dt, strftime(lag(d) over (partition by hdid order by d), '%Y-%m-%d') as last_active_dt,
       exposed, label, applist
from (select hdid, dt, d, max(case when event_type = 'view' then 1 else 0 end) as exposed,
             max(case when event_type = 'purchase' then 1 else 0 end) as label,
             case when count(distinct event_type) > 1
                  then array_to_string(list_sort(list(distinct event_type)), '|') end as applist
      from ({EVENTS_SQL}) group by hdid, dt, d)"""
LISTS_SQL = f"""select hdid, strftime(d + n, '%Y-%m-%d') as dt,
       array_to_string(list_sort(list(distinct event_type)), ',') as event_act_list_d4_d7
from ({EVENTS_SQL}), (select unnest([4, 5, 6, 7]) as n) group by all"""
EXPOSURE_WITH_LISTS = replace(
    sets.EXPOSURE, text=[*sets.EXPOSURE.text, TextColumn("event_act_list_d4_d7", ",", 10)]
)


def kinds(mark: str):
    return F.array_join(F.sort_array(F.collect_set("event_type")), mark)


def active_days(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each user and day with events, beside the day the user was active before."""
    days = user_events(spark, folder).groupBy("hdid", "dt").agg(
        F.max((F.col("event_type") == "view").cast("int")).cast("string").alias(exposure.FLAG),
        F.max((F.col("event_type") == "purchase").cast("int")).alias("label"),
        F.when(F.count_distinct("event_type") > 1, kinds("|")).alias("applist"),
    )
    before = F.lag("dt").over(Window.partitionBy("hdid").orderBy("dt"))
    return days.withColumns({"last_active_dt": before, "age": F.lit(None).cast("string")})


def event_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The kinds of a user's events four to seven days before a day."""
    later = F.explode(F.transform(F.sequence(F.lit(4), F.lit(7)), lambda n: F.date_add(F.col("d"), n)))
    rows = user_events(spark, folder).select("hdid", "event_type", later.alias("day"))
    rows = rows.groupBy("hdid", F.date_format("day", "yyyy-MM-dd").alias("dt"))
    return rows.agg(kinds(",").alias("event_act_list_d4_d7"))


EXPOSED_SQL = f"""with idle as (select *, row_number() over (partition by hdid order by exposed desc, dt) as place
                from ({ACTIVE_SQL}) where dt between '{FIRST}' and '{LAST}'
                  and cast(last_active_dt as date) <= cast(dt as date) - 3),
     u as (select * from idle where place = 1)
select u.hdid, u.dt, last_active_dt, exposed as is_exposure_v2, label, coalesce(applist, '') as applists,
       'other' as age_filled, coalesce(event_act_list_d4_d7, '') as event_act_list_d4_d7
from u left join ({LISTS_SQL}) l on l.hdid = u.hdid and l.dt = u.dt"""
EXPOSED = ["hdid", "dt", "last_active_dt", exposure.FLAG, "label", "applists", "age_filled", "event_act_list_d4_d7"]


def exposed_rows(spark: SparkSession, folder: str, rates: dict[tuple, float]) -> DataFrame:
    users = written(active_days(spark, folder), "active")
    lists = written(event_lists(spark, folder), "lists")
    rows = exposure.training_rows(spark, users, lists, FIRST, LAST, EXPOSURE_WITH_LISTS, rates)
    return rows.select(*EXPOSED)


@query(
    "job_exposure_rows",
    f"""select * from ({EXPOSED_SQL}) where {place('hdid')} <
        case when is_exposure_v2 = 1 and label = 1 then 1.0 when is_exposure_v2 = 0 and label = 1 then 0.0339
             when is_exposure_v2 = 1 and label = 0 then 0.3 else 0.00415 end""",
)
def job_exposure_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the exposure job trains on: one row per dormant user, by stratum."""
    return exposed_rows(spark, folder, exposure.EXPOSURE_RATES)


@query("job_dormant_users", EXPOSED_SQL)
def job_dormant_users(spark: SparkSession, folder: str) -> DataFrame:
    """The same before sampling: users whose last activity lies three days before their own day."""
    return exposed_rows(spark, folder, dict.fromkeys(exposure.EXPOSURE_RATES, 1.0))
