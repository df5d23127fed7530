"""Tokens and TF-IDF in relational form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.values import tokens
from pulsetrail.operators.joins import lookup_join
from pulsetrail.session import stage


ROWS_A_KEY = 1_000  # texts of a key that may meet in one task


def token_counts(df: DataFrame, key: str, column: str, pattern: str) -> DataFrame:
    """``(key, term, tf)`` over the whole text of every row.

    Texts are sent to the task of their key and counted there, as a text is smaller than its terms
    with their keys. The terms of keys with more than ``ROWS_A_KEY`` rows are counted where they are
    and sent by key and term, so such a key is spread over many tasks.
    """

    def counted(texts: DataFrame) -> DataFrame:
        terms = texts.select(key, F.explode(tokens(column, pattern)).alias("term"))
        return terms.groupBy(key, "term").agg(F.count("*").alias("tf"))

    texts = df.select(key, column)
    sizes = texts.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    crowded = stage(sizes.where(F.col("_n") > ROWS_A_KEY).select("_key"), "crowded-keys")
    if crowded.isEmpty():
        return counted(texts.repartition(key))
    same = F.col(key).eqNullSafe(F.col("_key"))
    few, many = (texts.join(crowded, same, how) for how in ("left_anti", "left_semi"))
    return counted(few.repartition(key)).unionByName(counted(many))


def tfidf_terms(df: DataFrame, key: str, column: str, pattern: str) -> DataFrame:
    """``(key, term, tf, df, weight)`` with weight ``tf * ln((rows + 1) / (df + 1))``.

    The counts are staged, as the document frequencies come from them too; a term that occurs in
    most rows is kept out of the shuffle of the look-up.
    """
    counts = stage(token_counts(df, key, column, pattern), "token-counts")
    spread = counts.groupBy("term").agg(F.count("*").alias("df"))
    rows = df.agg(F.count("*")).scalar()
    weight = F.col("tf") * F.log((rows + 1) / (F.col("df") + 1))
    joined = lookup_join(counts, spread, "term", "inner")
    return joined.select(key, "term", "tf", "df", weight.alias("weight"))
