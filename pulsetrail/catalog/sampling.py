"""Samplers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.operators.sampling import (
    EXPOSURE_RATES,
    downsample_negatives,
    hash_split,
    sample_rows,
    sample_strata,
    two_stage_sample,
)


def place(key: str, salt: str = "") -> str:
    """The SQL of the hash fraction."""
    text = f"'{salt}' || cast({key} as varchar)" if salt else f"cast({key} as varchar)"
    return f"(('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0)"


ORDERS_SQL = """select o_orderkey, case when o_orderstatus = 'P' then 1 else 0 end as exposed,
       case when o_totalprice > 400000 then 1 else 0 end as label from orders"""


def labelled_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("exposed"),
        F.when(F.col("o_totalprice") > 400000, 1).otherwise(0).alias("label"),
    )


@query(
    "downsample",
    f"""with o as ({ORDERS_SQL}),
        r as (select 2.0 * count(*) filter (label = 1) / count(*) filter (label = 0) as rate from o)
        select o.* from o, r where label = 1 or {place('o_orderkey')} < rate""",
)
def downsample(spark: SparkSession, folder: str) -> DataFrame:
    return downsample_negatives(labelled_orders(spark, folder), "o_orderkey", "label", 2)


@query("downsample_all", "select doc_id, toxic from labels")
def downsample_all(spark: SparkSession, folder: str) -> DataFrame:
    """A rate above 1 keeps every negative."""
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return downsample_negatives(labels, "doc_id", "toxic", 20)


@query(
    "two_stage",
    f"""with o as (select * from ({ORDERS_SQL}) where {place('o_orderkey', 'first:')} < 0.5),
        r as (select 0.8 * count(*) filter (label = 1) / count(*) filter (label = 0) as rate from o)
        select o.* from o, r where label = 1 or {place('o_orderkey')} < rate""",
)
def two_stage(spark: SparkSession, folder: str) -> DataFrame:
    return two_stage_sample(labelled_orders(spark, folder), "o_orderkey", "label")


@query("uniform_sample", f"select * from ({ORDERS_SQL}) where {place('o_orderkey')} < 0.5")
def uniform_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sample_rows(labelled_orders(spark, folder), "o_orderkey", 0.5)


@query(
    "four_strata",
    f"""select * from ({ORDERS_SQL}) where {place('o_orderkey')} <
        case when exposed = 1 and label = 1 then 1.0 when exposed = 0 and label = 1 then 0.0339
             when exposed = 1 and label = 0 then 0.3 else 0.00415 end""",
)
def four_strata(spark: SparkSession, folder: str) -> DataFrame:
    orders = labelled_orders(spark, folder)
    return sample_strata(orders, "o_orderkey", ["exposed", "label"], EXPOSURE_RATES)


@query(
    "hash_split",
    f"""select o_orderkey, case when {place('o_orderkey')} < 0.7 then 'train' else 'test' end as part
        from orders""",
)
def hash_split_query(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey")
    training, test = hash_split(orders, "o_orderkey", [0.7, 0.3])
    return training.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
