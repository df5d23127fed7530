"""Model queries: of each model that what data and rules determine, which SQL can state.

Weights and scores depend on the learner; keys, labels, ranges, shapes and relations between results
do not. Each query trains and applies the model on whole tables and returns these.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog import models
from pulsetrail.catalog.encoding import chi_square_sql
from pulsetrail.catalog.registry import query
from pulsetrail.operators.evaluation import rmse
from pulsetrail.operators.models import uplift
from pulsetrail.operators.recommend import score_pairs
from pulsetrail.operators.similarity import centroid_distances
from pulsetrail.sources.artefacts import word_vectors
from pulsetrail.session import stage

ORDERS_SQL = """(select cast(o_orderkey as varchar) as hdid, case when q > 100 then 1 else 0 end as label,
        o_orderpriority, c_mktsegment
 from (select l_orderkey, sum(l_quantity) as q from lineitem group by l_orderkey)
 join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey)"""
SCORED_SQL = f"select hdid, true as bounded, true as consistent from {ORDERS_SQL}"
INTERACTIONS_SQL = """(select o_custkey as u, l_partkey as i from lineitem
 join orders on l_orderkey = o_orderkey group by 1, 2)"""
USERS_SQL = f"""(select u, row_number() over (order by cast(u as varchar)) - 1 as n
 from (select distinct u from {INTERACTIONS_SQL}))"""
ITEMS_SQL = f"""(select i, row_number() over (order by cast(i as varchar)) - 1 as n
 from (select distinct i from {INTERACTIONS_SQL}))"""
SLOTS_SQL = f"""select 'o_orderpriority' as source, count(distinct o_orderpriority) - 1 as slots from {ORDERS_SQL}
 union all select 'c_mktsegment', count(distinct c_mktsegment) - 1 from {ORDERS_SQL}
 union all select unnest(['o_totalprice', 'c_acctbal', 'lines', 'price', 'discount', 'tax', 'suppliers']), 1"""


def in_range() -> list[Column]:
    """Whether the probability is one, and whether the prediction follows from it."""
    p = F.col("probability")
    return [
        F.coalesce(p.between(0, 1), F.lit(False)).alias("bounded"),
        (F.col("prediction") == (p > 0.5).cast("double")).alias("consistent"),
    ]


def sources(slots: DataFrame) -> DataFrame:
    """How many slots of a feature vector come from each input column."""
    return slots.groupBy(F.split("feature", "_vec_")[0].alias("source")).agg(F.count("*").alias("slots"))


@query(
    "gbt_scores",
    f"select hdid, label, true as bounded, true as consistent from {ORDERS_SQL}",
)
def gbt_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.gbt_scores(spark, folder).select("hdid", "label", *in_range())


@query("pca_scores", SCORED_SQL)
def pca_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.pca_scores(spark, folder).select("hdid", *in_range())


@query("mlp_scores", SCORED_SQL)
def mlp_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.mlp_scores(spark, folder).select("hdid", *in_range())


@query("rformula_scores", SCORED_SQL)
def rformula_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.rformula_scores(spark, folder).select("hdid", *in_range())


@query("importances", f"select source, slots, true as whole from ({SLOTS_SQL})")
def importances(spark: SparkSession, folder: str) -> DataFrame:
    """The slots of each input column; all importances are shares of one."""
    found = stage(models.importances_query(spark, folder), "importances")
    whole = found.agg(
        (F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0)
    ).scalar()
    return sources(found).withColumn("whole", whole)


@query("lr_weights", SLOTS_SQL)
def lr_weights(spark: SparkSession, folder: str) -> DataFrame:
    return sources(models.lr_weights(spark, folder).where("not isnan(weight)"))


@query("lr_no_intercept", "select cast(unnest(range(23)) as integer) as slot, true as finite")
def lr_no_intercept(spark: SparkSession, folder: str) -> DataFrame:
    """A finite weight for each of the 23 places of the sparse profile."""
    finite = ~F.isnan("weight") & (F.abs("weight") < float("inf"))
    return models.lr_no_intercept(spark, folder).select("slot", finite.alias("finite"))


@query(
    "two_arm_scores",
    f"select hdid, cast(unnest([0, 1]) as integer) as exposed, true as bounded, true as consistent from {ORDERS_SQL}",
)
def two_arm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return models.two_arm_scores(spark, folder).select("hdid", "exposed", *in_range())


@query("uplift", f"select hdid, true as agrees from {ORDERS_SQL}")
def uplift_query(spark: SparkSession, folder: str) -> DataFrame:
    """The uplift of every order equals the difference of its two scores."""
    arms = stage(models.two_arm_scores(spark, folder), "arms")
    one, other = (
        arms.where(F.col("exposed") == arm).select("hdid", F.col("probability").alias(name))
        for arm, name in ((1, "treated"), (0, "control"))
    )
    found = uplift(arms, ["hdid"], "exposed").join(one, "hdid").join(other, "hdid")
    same = F.abs(F.col("uplift") - (F.col("treated") - F.col("control"))) < 1e-12
    return found.select("hdid", same.alias("agrees"))


@query(
    "hashed_tfidf",
    r"""select doc_id, cast(len(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> ''))
                            as double) as terms
        from documents""",
)
def hashed_tfidf(spark: SparkSession, folder: str) -> DataFrame:
    """Hashing loses no term: the counts of all buckets add up to the terms of the text."""
    found = models.hashed_tfidf(spark, folder)
    total = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    return found.select("doc_id", total.alias("terms"))


_CHOSEN_SQL = " union all ".join(
    f"select {i} as feature, statistic from ({chi_square_sql(models.LABELLED_SQL, code, 'label')})"
    for i, code in enumerate(models.CODES_SQL)
)


@query(
    "selected_features",
    f"""with best as (select feature from ({_CHOSEN_SQL}) order by statistic desc limit 1)
        select c_custkey, label, cast(case feature {' '.join(f'when {i} then {code}' for i, code in enumerate(models.CODES_SQL))}
                                      end as double) as code
        from {models.LABELLED_SQL}, best""",
)
def selected_features(spark: SparkSession, folder: str) -> DataFrame:
    return models.selected_features(spark, folder)


@query("model_roundtrip", f"select hdid, true as same from {ORDERS_SQL}")
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The reloaded pipeline gives every order the score that the original gave."""
    found = models.model_roundtrip(spark, folder)
    return found.select("hdid", (F.col("before") == F.col("probability")).alias("same"))


@query(
    "als_scores",
    f"""select cast(us.n as integer) as userId, cast(its.n as integer) as itemId, true as scored
        from {INTERACTIONS_SQL} d join {USERS_SQL} us on us.u = d.u join {ITEMS_SQL} its on its.i = d.i""",
)
def als_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = ~F.isnan("prediction") & F.col("prediction").isNotNull()
    return models.als_scores(spark, folder).select("userId", "itemId", scored.alias("scored"))


@query("als_rmse", f"select count(*) as pairs, true as agrees from {INTERACTIONS_SQL}")
def als_rmse(spark: SparkSession, folder: str) -> DataFrame:
    """The root mean square error equals the one of the errors one by one."""
    model, ratings, _, _ = models.factors(spark, folder)
    scored = stage(score_pairs(model, ratings), "scored")
    error = (F.col("rating") - F.col("prediction").cast("double")) ** 2
    own = scored.agg(F.count("*").alias("pairs"), F.sqrt(F.avg(error)).alias("expected"))
    both = own.withColumn("found", rmse(scored, "rating", "prediction").scalar())
    return both.select("pairs", (F.abs(F.col("found") - F.col("expected")) < 1e-9).alias("agrees"))


@query(
    "als_recommend",
    f"""select cast(us.n as integer) as userId, least(10, (select count(*) from {ITEMS_SQL})) as picks,
               least(10, (select count(*) from {ITEMS_SQL})) as items, true as falling
        from {USERS_SQL} us""",
)
def als_recommend(spark: SparkSession, folder: str) -> DataFrame:
    """Ten different parts for every customer, the best first."""
    found = models.als_recommend(spark, folder).groupBy("userId")
    picks = F.sort_array(F.collect_list(F.struct("rank", "prediction")))
    found = found.agg(F.count("*").alias("picks"), F.countDistinct("itemId").alias("items"), picks.alias("p"))
    falling = F.forall("p", lambda x: F.get("p.prediction", x["rank"] - 2).isNull()
                       | (F.get("p.prediction", x["rank"] - 2) >= x["prediction"]))
    return found.select("userId", "picks", "items", falling.alias("falling"))


@query(
    "als_item_vectors",
    f"""select cast(p_partkey as varchar) as doc_id, 10 as width,
               p_partkey in (select i from {INTERACTIONS_SQL}) as known from part""",
)
def als_item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The width of every part's factors, which are zeros just for parts that nobody ordered."""
    values = F.split("item_vec", ",")
    known = F.exists(values, lambda v: v.cast("double") != 0)
    return models.als_item_vectors(spark, folder).select("doc_id", F.size(values).alias("width"), known.alias("known"))


@query(
    "word_vectors",
    """with taken as (
           select distinct o_custkey as hdid, l_partkey as doc_id, strftime(o_orderdate, '%Y-%m-%d') as dt
           from lineitem join orders on l_orderkey = o_orderkey)
       select distinct cast(doc_id as varchar) as word, 5 as width
       from taken where hdid in (select hdid from taken group by hdid having count(*) >= 2)""",
)
def word_vectors_query(spark: SparkSession, folder: str) -> DataFrame:
    """Every part of a basket has a vector."""
    found = models.word_vectors_query(spark, folder)
    return found.select("word", F.size(F.split("vector", ",")).alias("width"))


def disagreements(pairs: DataFrame, rows: DataFrame, key: str, centre: DataFrame) -> DataFrame:
    """Per row how many of its reported distances to the centre are not the exact one."""
    means = vector_to_array("means")
    exact = centroid_distances(rows, key, means, centre.select(means)).withColumnRenamed("dist", "exact")
    wrong = F.count_if(F.abs(F.col("dist") - F.col("exact")) > 1e-9)
    return exact.join(pairs, "idA", "left").groupBy(F.col("idA").alias(key)).agg(wrong.alias("wrong"))


@query("lsh_pairs", "select label, 0::bigint as wrong from embeddings group by label")
def lsh_pairs(spark: SparkSession, folder: str) -> DataFrame:
    pairs, means, middle = models.lsh_pairs(spark, folder)
    return disagreements(pairs, means, "label", middle)


@query(
    "material_similarity",
    """select mate_id, 0::bigint as wrong
       from (select cast(l_partkey as varchar) as mate_id, count(distinct l_orderkey) as users from lineitem
             where l_partkey not in (select l_partkey from lineitem where l_returnflag = 'R'
                 and strftime(l_shipdate, '%Y-%m-%d') between '1998-01-01' and '1999-12-31')
             group by l_partkey order by users desc, mate_id limit 50)""",
)
def material_similarity(spark: SparkSession, folder: str) -> DataFrame:
    pairs, candidates, target = models.material_similarity(spark, folder)
    return disagreements(pairs, candidates, "mate_id", target)
