"""From documents to packed sequences: five stages, each on all that the one before has kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return documents
with the columns they came with. ``run`` writes the result of each stage to the shared folder and
reads it again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm import exact, packing, secrets, simhash, toxicity
from pulsetrail.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from ``labels``, scores 0.5 or more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for blanks, the one with the smallest id stays."""
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose five-word shingles are 0.8 alike or more, the smallest id stays."""
    return simhash.keep_one_of_near(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets found in them are masked, and ``n_chars`` follows the text."""
    masked = secrets.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs).drop("row")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a learned classifier and a tokenizer: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *earlier, last = STAGES
    for name, function in earlier:
        docs = stage(function(spark, docs, sf_dir), name)
    return last[1](spark, docs, sf_dir)
