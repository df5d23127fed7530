"""Models on the test tables, and the queries on them that SQL expresses; see ``model_checks``."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.encoding import FIELDS_SQL, chi_square_sql, profiles
from pulsetrail.catalog.registry import query, table
from pulsetrail.functions.vectors import render, to_vector
from pulsetrail.operators.cleaning import baskets, popular_items
from pulsetrail.operators.encoding import ordinal_profile
from pulsetrail.operators.evaluation import rmse
from pulsetrail.operators.models import (
    chi_square_test,
    importances,
    score,
    score_arms,
    select_features,
    train,
    uplift,
    weights,
)
from pulsetrail.operators.pipelines import Features, Learner, TextColumn, build_pipeline, tfidf_stages
from pulsetrail.operators.recommend import (
    attach_vectors,
    basket_embeddings,
    id_index,
    item_vectors,
    rating_rows,
    recommend,
    score_pairs,
    train_als,
)
from pulsetrail.operators.similarity import projection_model, similar_pairs
from pulsetrail.plans import feature_sets as sets
from pulsetrail.plans.material import scaled_features, unseen_materials
from pulsetrail.plans.profile import train_sparse_profile
from pulsetrail.session import scratch_path, stage
from pulsetrail.sources.artefacts import load_model, save_model, word_vectors
from pulsetrail.sources.formats import read_vectors, write_vectors

DAY = "20240130"

ORDER_FEATURES = Features(
    categorical=["o_orderpriority", "c_mktsegment"],
    numeric=["o_totalprice", "c_acctbal", "lines", "price", "discount", "tax", "suppliers"],
)


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One feature row per order; the label says whether the order is a large one."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    lines = lines.agg(
        F.count("*").alias("lines"),
        F.sum("l_quantity").alias("quantity"),
        F.avg("l_extendedprice").alias("price"),
        F.avg("l_discount").alias("discount"),
        F.max("l_tax").alias("tax"),
        F.countDistinct("l_suppkey").alias("suppliers"),
        F.concat_ws("|", F.sort_array(F.collect_set("l_returnflag"))).alias("flags"),
    )
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.join(lines, "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("hdid"),
        F.when(F.col("quantity") > 100, 1).otherwise(0).alias("label"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("exposed"),
        "flags",
        *ORDER_FEATURES.categorical,
        *ORDER_FEATURES.numeric,
    )


def fitted(
    spark: SparkSession, folder: str, features: Features, learner: Learner
) -> tuple[DataFrame, PipelineModel]:
    rows = stage(order_rows(spark, folder), "order-rows")
    return rows, train(rows, build_pipeline(features, learner))


def reduced(width: int) -> Features:
    return Features(ORDER_FEATURES.numeric, ORDER_FEATURES.categorical, pca=width)


def gbt_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = fitted(spark, folder, ORDER_FEATURES, sets.EXPOSURE_LEARNER)
    return score(model, rows, ["hdid", "label"])


def importances_query(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = fitted(spark, folder, ORDER_FEATURES, sets.EXPOSURE_LEARNER)
    return importances(model, model.transform(rows))


def pca_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = fitted(spark, folder, reduced(5), sets.ELASTIC_NET)
    return score(model, rows, ["hdid"])


def mlp_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = fitted(spark, folder, reduced(5), sets.perceptron(5))
    return score(model, rows, ["hdid"])


def rformula_scores(spark: SparkSession, folder: str) -> DataFrame:
    features = Features(numeric=ORDER_FEATURES.numeric, formula=ORDER_FEATURES.categorical)
    rows, model = fitted(spark, folder, features, sets.PROFILE_LOGISTIC)
    return score(model, rows, ["hdid"])


def lr_weights(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = fitted(spark, folder, ORDER_FEATURES, sets.PROFILE_LOGISTIC)
    return weights(model, model.transform(rows))


def lr_no_intercept(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of the sparse profile, trained from exported libSVM rows."""
    rows = profiles(spark, folder).withColumn("sing_dr", F.col("c_acctbal") / 10)
    return train_sparse_profile(spark, rows, scratch_path(spark, "sparse-profile"))["weights"]


ARM_FEATURES = Features(
    numeric=ORDER_FEATURES.numeric,
    formula=ORDER_FEATURES.categorical,
    text=[TextColumn("flags", r"\|", 10)],
    flags=["exposed"],
    pca=5,
)


def two_arm_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = fitted(spark, folder, ARM_FEATURES, sets.EXPOSURE_LEARNER)
    return score_arms(model, rows, ["hdid"], "exposed")


@query(
    "two_level_assembly",
    """select cast(o_orderkey as varchar) as hdid, case when o_orderstatus = 'F' then 1 else 0 end as exposed,
              6 as width, case when o_orderstatus = 'F' then 0.0::double else 1.0::double end as flag
       from orders where o_orderkey in (select l_orderkey from lineitem)""",
)
def two_level_assembly(spark: SparkSession, folder: str) -> DataFrame:
    """The reduced features and the flag as text: width 5 + 1, the flag last and untouched."""
    rows = stage(order_rows(spark, folder), "order-rows")
    vectors = build_pipeline(ARM_FEATURES).fit(rows).transform(rows)
    values = vector_to_array("features")
    return vectors.select("hdid", "exposed", F.size(values).alias("width"), values[5].alias("flag"))


def hashed_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.ml import Pipeline

    docs = table(spark, folder, "documents").select("doc_id", "text")
    stages = tfidf_stages(TextColumn("text", r"\s+", 14))
    vectors = Pipeline(stages=stages).fit(docs).transform(docs)
    return vectors.select(
        "doc_id",
        render(vector_to_array("text_vec")).alias("weights"),
        vector_to_array("text_tf").alias("counts"),
    )


def selected_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = profiles(spark, folder).select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("label"),
        to_vector(ordinal_profile()).alias("features"),
    )
    kept = select_features(rows, "features", "label", 1)
    return kept.select("c_custkey", "label", vector_to_array("selected")[0].alias("code"))


CODES_SQL = [
    "case bd_sex when 'F' then 0 else 1 end",
    """case bd_age when '35-44' then 1 when '18-24' then 3 when '45-54' then 4 when '65以上' then 5
       when '18以下' then 6 when '25-34' then 7 when '55-64' then 8 else 0 end""",
    "case bd_consume when '低' then 0 when '中' then 1 else 2 end",
    "case bd_marriage when '已婚' then 0 else 1 end",
    *[f"case {flag} when 'Y' then 0 else 1 end" for flag in sets.PROFILE_FIELDS[4:]],
]
LABELLED_SQL = f"""(select *, case when c_acctbal > 5000 then 1 else 0 end as label
                    from (select *, {FIELDS_SQL} from customer))"""


@query(
    "chi_square_test",
    " union all ".join(
        f"select {i} as feature, statistic, dof from ({chi_square_sql(LABELLED_SQL, code, 'label')})"
        for i, code in enumerate(CODES_SQL)
    ),
)
def chi_square_test_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = profiles(spark, folder).select(
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("label"),
        to_vector(ordinal_profile()).alias("features"),
    )
    tested = chi_square_test(rows, "features", "label")
    return tested.select(
        F.col("featureIndex").alias("feature"),
        F.round("statistic", 6).alias("statistic"),
        F.col("degreesOfFreedom").cast("long").alias("dof"),
    )


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of the saved and reloaded pipeline, with those of the original."""
    rows, model = fitted(spark, folder, ORDER_FEATURES, sets.PROFILE_LOGISTIC)
    base = scratch_path(spark, "artefacts")
    save_model(model, base, "orders", DAY)
    loaded = load_model(PipelineModel, base, "orders", "20240317", lag=47)
    before = score(model, rows, ["hdid"]).withColumnRenamed("probability", "before")
    return before.join(score(loaded, rows, ["hdid"]).select("hdid", "probability"), "hdid")


# ---------------------------------------------------------------- recommendation


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity per customer and part."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, folder, "lineitem").join(orders, "l_orderkey")
    return lines.groupBy(
        F.col("o_custkey").cast("string").alias("hdid"), F.col("l_partkey").cast("string").alias("docid")
    ).agg(F.sum("l_quantity").cast("float").alias("score"))


def factors(spark: SparkSession, folder: str):
    data = stage(interactions(spark, folder), "interactions")
    users, items = stage(id_index(data, "hdid"), "users"), stage(id_index(data, "docid"), "items")
    ratings = stage(rating_rows(data, "hdid", "docid", "score", users, items), "ratings")
    return train_als(ratings), ratings, users, items


@query(
    "als_rows",
    """with d as (select o_custkey as u, l_partkey as i, sum(l_quantity) as rating
                  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2),
       us as (select cast(u as varchar) as k, row_number() over (order by cast(u as varchar)) - 1 as n
              from (select distinct u from d)),
       its as (select cast(i as varchar) as k, row_number() over (order by cast(i as varchar)) - 1 as n
               from (select distinct i from d))
       select cast(us.n as integer) as userId, cast(its.n as integer) as itemId, rating
       from d join us on us.k = cast(d.u as varchar) join its on its.k = cast(d.i as varchar)""",
)
def als_rows(spark: SparkSession, folder: str) -> DataFrame:
    data = stage(interactions(spark, folder), "interactions")
    users, items = id_index(data, "hdid"), id_index(data, "docid")
    return rating_rows(data, "hdid", "docid", "score", users, items)


def als_scores(spark: SparkSession, folder: str) -> DataFrame:
    model, ratings, _, _ = factors(spark, folder)
    return score_pairs(model, ratings)


def als_rmse(spark: SparkSession, folder: str) -> DataFrame:
    model, ratings, _, _ = factors(spark, folder)
    return rmse(score_pairs(model, ratings), "rating", "prediction")


def als_recommend(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best of a report of the fifty most ordered parts, for every customer."""
    model, ratings, users, _ = factors(spark, folder)
    report = stage(popular_items(ratings, "itemId", "userId", 50).select("itemId"), "report")
    return recommend(model, users.select(F.col("index").alias("userId")), report, 10)


def als_item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Every part with its factors; parts nobody ordered have zeros."""
    model, _, _, items = factors(spark, folder)
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("doc_id"))
    found = item_vectors(parts, "doc_id", items, model)
    return found.select("doc_id", render(vector_to_array("item_vec")).alias("item_vec"))


def purchase_baskets(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("hdid"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
    )
    lines = table(spark, folder, "lineitem").join(orders, "l_orderkey")
    taken = lines.select("hdid", F.col("l_partkey").cast("string").alias("doc_id"), "dt")
    return baskets(taken, "hdid", "doc_id", "dt")


def word_vectors_query(spark: SparkSession, folder: str) -> DataFrame:
    vectors = word_vectors(basket_embeddings(purchase_baskets(spark, folder)))
    return vectors.select("word", render(vector_to_array("vector")).alias("vector"))


@query(
    "text_vectors",
    """select cast(p_partkey as varchar) as word, cast(64 as integer) as width,
              coalesce(round(cast(embedding[1] as double), 6), 0.0) as head,
              coalesce(round(list_sum(list_transform(embedding, lambda x: cast(x as double))), 5), 0.0)
                  as total
       from part left join embeddings on p_partkey = vec_id""",
)
def text_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors written as text and read back, looked up for every part (zeros when unknown)."""
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("word"), to_vector("embedding").alias("vector")
    )
    path = scratch_path(spark, "text-vectors")
    write_vectors(vectors, path)
    back = read_vectors(spark, path).withColumn("vector", vector_to_array("vector"))
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("word"))
    found = attach_vectors(parts, "word", back, "vector", 64)
    found = found.select("word", vector_to_array("vector").alias("v"))
    return found.select(
        "word",
        F.size("v").alias("width"),
        F.round(F.col("v")[0], 6).alias("head"),
        F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 5).alias("total"),
    )


# ---------------------------------------------------------------- similarity


def lsh_pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distances of the label means to the mean of all vectors, by shared buckets; both sides."""
    from pulsetrail.operators.cleaning import mean_vector

    vectors = table(spark, folder, "embeddings")
    means = stage(mean_vector(vectors, ["label"], "embedding"), "means")
    middle = stage(mean_vector(vectors, [], "embedding"), "middle")
    named = middle.select(F.lit(-1).alias("label"), "means")
    return similar_pairs(projection_model(means, "means"), means, named, "label"), means, middle


def material_similarity(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts without a line returned in two years against the mean of the parts with the highest tax:
    the similar pairs, the candidates and the target."""
    from pulsetrail.operators.cleaning import mean_vector

    lines = table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("mate_id"),
        F.col("l_orderkey").cast("string").alias("hdid"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )
    features = Features(
        numeric=["l_quantity", "l_extendedprice", "l_discount", "l_tax"], formula=["l_linestatus"]
    )
    vectors = stage(scaled_features(lines, features).select("mate_id", "l_tax", "features"), "vectors")
    means = stage(mean_vector(vectors, ["mate_id"], "features"), "means")
    returned = lines.where("l_returnflag = 'R' and shipped between '1998-01-01' and '1999-12-31'")
    candidates = stage(
        unseen_materials(lines, returned).join(means, "mate_id").select("mate_id", "means"), "candidates"
    )
    target = stage(mean_vector(vectors.where("l_tax >= 0.08"), [], "features"), "target")
    named = target.select(F.lit("target").alias("mate_id"), "means")
    return similar_pairs(projection_model(means, "means"), candidates, named, "mate_id"), candidates, target
