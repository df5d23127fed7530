"""Implicit-feedback recommendation and basket embeddings."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession

from pulsetrail.functions.dates import day
from pulsetrail.operators.cleaning import baskets
from pulsetrail.operators.evaluation import rmse
from pulsetrail.operators.recommend import (
    basket_embeddings,
    id_index,
    rating_rows,
    score_pairs,
    train_als,
)
from pulsetrail.session import stage
from pulsetrail.sources.artefacts import artefact_path, load_model, save_model, word_vectors
from pulsetrail.sources.formats import write_vectors
from pulsetrail.sources.tables import scan_day, write_partition

USER, ITEM, SCORE = "hdid", "docid", "score"


def train_recommender(
    spark: SparkSession, table: str, user_index: str, item_index: str, artefacts: str, dt: str
) -> tuple[ALSModel, DataFrame]:
    """Number the ids, write both indexes of the day, train and save the factors; returns the RMSE."""
    data = scan_day(spark, table, day(dt)).select(USER, ITEM, SCORE)
    users, items = stage(id_index(data, USER), "users"), stage(id_index(data, ITEM), "items")
    write_partition(users.withColumnRenamed("key", USER), user_index, dt=day(dt))
    write_partition(items.withColumnRenamed("key", ITEM), item_index, dt=day(dt))
    ratings = stage(rating_rows(data, USER, ITEM, SCORE, users, items), "ratings")
    model = train_als(ratings)
    save_model(model, artefacts, "factors", dt)
    return model, rmse(score_pairs(model, ratings), "rating", "prediction")


def load_items(
    spark: SparkSession, item_index: str, artefacts: str, dt: str
) -> tuple[DataFrame, ALSModel]:
    """The item index and the factor model of a day, as the click jobs take them."""
    index = scan_day(spark, item_index, day(dt)).selectExpr(f"{ITEM} as key", "index")
    return index, load_model(ALSModel, artefacts, "factors", dt)


def score_candidates(
    spark: SparkSession, pairs: DataFrame, user_index: str, item_index: str, artefacts: str, dt: str
) -> DataFrame:
    """Score given ``(hdid, docid)`` pairs; pairs with an unknown id are dropped."""
    users = scan_day(spark, user_index, day(dt)).selectExpr(f"{USER} as key", "index")
    items, model = load_items(spark, item_index, artefacts, dt)
    indexed = rating_rows(pairs.selectExpr("*", "0.0D as rating"), USER, ITEM, "rating", users, items)
    return score_pairs(model, indexed.drop("rating"))


def train_embeddings(
    clicks: DataFrame, artefacts: str, dt: str, user: str = USER, item: str = "doc_id"
) -> DataFrame:
    """Item vectors from click baskets, saved as a model and as text; returns ``(word, vector)``."""
    model = basket_embeddings(baskets(clicks, user, item, "dt"))
    save_model(model, artefacts, "embedding", dt)
    vectors = word_vectors(model)
    write_vectors(vectors, artefact_path(artefacts, "embedding_text", dt))
    return vectors
