"""Exact dedup: a tree merge of sorted digest runs, in DataFrame operations only.

Every partition of the documents is a leaf of a tree with ``FAN ** ROUNDS`` addresses. Its run is the
set of its distinct digests, each with the smallest identifier. In each round the runs of up to
``FAN`` neighbours in one digit of the address are merged, and the merged run is dealt out again over
that digit by a digit of the digest, as in a binomial exchange. So a digest arrives once from each
neighbour, however many rows share it, and after the last round it lies at one address only. The
answers then go back down the same tree, from each merged run to the runs that it was made from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import SPACE
from pulsetrail.session import stage

FAN = 16  # runs that one merge takes
ROUNDS = 3  # merges from a leaf to the top
KEY = ["sha", "check", "n_bytes"]


def normalised(text: Column) -> Column:
    """Each run of blanks becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_table(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: tuple[str, ...] = ()
) -> DataFrame:
    """``(row, doc_id, node, sha, check, n_bytes)``: the digests of the normalised text of each row.

    Texts count as equal when SHA-256, XXH64 and the length in bytes all agree.
    """
    norm = F.col("norm")
    return docs.select(
        *carried, F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm")
    ).select(
        *carried,
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.pmod(F.spark_partition_id().cast("long"), F.lit(FAN**ROUNDS)).alias("node"),
        F.unhex(F.sha2(norm, 256)).alias("sha"),
        F.xxhash64(norm).alias("check"),
        F.octet_length(norm).alias("n_bytes"),
    )


def _next_node(level: int) -> Column:
    """The address after the exchange: one digit of it becomes that digit of the digest."""
    step = FAN**level
    own = F.floor(F.col("node") / step) % FAN
    drawn = F.floor(F.pmod(F.col("check"), F.lit(FAN**ROUNDS)) / step) % FAN
    return (F.col("node") + (drawn - own) * step).cast("long")


def _merged(runs: DataFrame) -> DataFrame:
    """One sorted run for each address: the smallest identifier of each digest, and its rows."""
    return runs.groupBy("node", *KEY).agg(F.min("first").alias("first"), F.sum("rows").alias("rows"))


def first_of_group(digests: DataFrame) -> DataFrame:
    """``digests`` with ``first`` (nullness, id and row of the first row of the group) and ``rows``.

    ``digests`` is read several times: stage it. The first row has the smallest id; of rows with the
    same id the first that was read; rows without an id come last.
    """
    identifier = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    leaves = digests.select("node", *KEY, identifier.alias("first"), F.lit(1).cast("long").alias("rows"))
    levels = [stage(_merged(leaves), "run-0")]
    for level in range(ROUNDS):
        moved = levels[-1].withColumn("node", _next_node(level))
        levels.append(stage(_merged(moved), f"run-{level + 1}"))

    answers = levels.pop()
    while levels:
        level = len(levels) - 1
        below = levels.pop().select("node", *KEY, _next_node(level).alias("above"))
        known = answers.withColumnRenamed("node", "above")
        answers = below.join(known, ["above", *KEY]).select("node", *KEY, "first", "rows")
    return digests.join(answers, ["node", *KEY])


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    A null text is an empty text. Of equal texts the row with the smallest id is kept; a repeated row
    (same id, same text) is kept once; rows without an id come after all others. An empty table gives
    an empty result.
    """
    digests = stage(digest_table(docs, id_col, text_col), "digests")
    return first_of_group(digests).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without later copies of a text, all their columns as they are."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"))
    digests = digest_table(held, f"held.`{id_col}`", f"held.`{text_col}`", ("held",))
    staged = stage(digests, "documents")
    kept = first_of_group(staged.drop("held")).where("row = first.row").select("row")
    return staged.join(kept, "row", "left_semi").select("held.*")
