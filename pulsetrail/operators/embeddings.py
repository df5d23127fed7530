"""Item embeddings by factorising how often items keep company: no vocabulary on the driver."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.vectors import to_vector
from pulsetrail.operators.joins import lookup_join
from pulsetrail.operators.recommend import id_index, train_als
from pulsetrail.session import discard, stage

WINDOW = 5  # items to either side that count as company
# Explicit ratings: a weight that is not there is unknown, not zero.
PAIRS_A_BLOCK = 8_000_000  # an item has many more pairs than a rated item has ratings, and shorter factors
SETTINGS = {"implicitPrefs": False, "rank": 5, "maxIter": 10, "regParam": 0.05}


def _entries(baskets: DataFrame, items: str) -> DataFrame:
    """``(basket, items, place, x)``: the entries of all baskets, from a staged table."""
    numbered = baskets.select(F.monotonically_increasing_id().alias("basket"), F.col(items).alias("items"))
    return stage(numbered, "company-baskets").select("*", F.posexplode("items").alias("place", "x"))


def _singles(entries: DataFrame, window: int) -> DataFrame:
    """``(x, s)``, staged: how often each item that has company has it."""
    others = [F.get("items", F.col("place") + d) for d in range(-window, window + 1) if d]
    company = sum((F.when(y != F.col("x"), 1).otherwise(0) for y in others), F.lit(0))
    singles = entries.select("x", company.alias("c")).where("c > 0").groupBy("x").agg(F.sum("c").alias("s"))
    return stage(singles, "singles")


def _with_singles(baskets: DataFrame, items: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Each basket as an array ``near`` of ``(place, x, s)``, with ``s``: how often ``x`` has company in all
    baskets; and the staged table ``(x, s)``.

    Items are counted where they stand, so what is grouped and joined are the entries of the baskets, not
    their pairs.
    """
    entries = _entries(baskets, items)
    singles = _singles(entries, window)
    known = lookup_join(entries.select("basket", "place", "x"), singles, "x")
    near = F.sort_array(F.collect_list(F.struct("place", "x", "s"))).alias("near")
    return known.groupBy("basket").agg(near), singles


def _numbered(baskets: DataFrame, items: str, window: int) -> tuple[DataFrame, DataFrame]:
    """The baskets with numbers for items, null for those without company, and ``(key, index)``; both staged."""
    entries = _entries(baskets, items)
    index = stage(id_index(_singles(entries, window), "x"), "items")
    known = lookup_join(entries.select("basket", "place", "x"), index.withColumnRenamed("key", "x"), "x")
    placed = known.groupBy("basket").agg(F.sort_array(F.collect_list(F.struct("place", "index"))).alias("p"))
    numbers = F.transform("p", lambda entry: entry["index"]).alias("items")
    return stage(placed.select(numbers), "numbered-baskets"), index


def cooccurrences(baskets: DataFrame, items: str = "items", window: int = WINDOW) -> DataFrame:
    """``(a, b, n, n_a, n_b, n_all)``: how often item ``b`` is within ``window`` places of ``a`` in a basket.

    Both directions are counted; an item does not keep company with itself. ``n_a`` and ``n_b`` are the
    sums of ``n`` over all company of either, ``n_all`` is the sum over all rows. The pairs of a basket grow with its length, not with its
    square; they are added up before they are shuffled, once for both directions.
    """
    ahead = F.explode(F.array(*[F.lit(d) for d in range(1, window + 1)])).alias("d")
    known, singles = _with_singles(baskets, items, window)
    met = known.select("near", F.posexplode("near").alias("i", "x"))
    met = met.select("near", "i", "x", ahead).select("x", F.get("near", F.col("i") + F.col("d")).alias("y"))
    lower = F.col("x.x") < F.col("y.x")
    pairs = met.where("x.x <> y.x").select(
        F.least("x.x", "y.x").alias("a"), F.greatest("x.x", "y.x").alias("b"),
        F.when(lower, F.col("x.s")).otherwise(F.col("y.s")).alias("n_a"),
        F.when(lower, F.col("y.s")).otherwise(F.col("x.s")).alias("n_b"),
    )
    once = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))
    turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "n", F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b"))
    both = once.select(F.inline(F.array(F.struct(*once.columns), turned)))
    return both.withColumn("n_all", singles.agg(F.sum("s")).scalar())


def pointwise_information(counts: DataFrame) -> DataFrame:
    """``(a, b, n, weight)``: the positive part of the pointwise mutual information of each pair.

    Pairs that meet no more often than by chance weigh 0. ``counts`` with the sums that ``cooccurrences``
    brings is read once; without them (``a``, ``b``, ``n``) it is read three times: stage it.
    """
    if not {"n_a", "n_b", "n_all"} <= set(counts.columns):
        single = stage(counts.groupBy(F.col("a").alias("item")).agg(F.sum("n").alias("single")), "singles")
        total = single.agg(F.sum("single")).scalar()
        counts = counts.select("a", "b", "n", total.alias("n_all"))
        for end in ("a", "b"):
            own = single.select(F.col("item").alias(end), F.col("single").alias(f"n_{end}"))
            counts = lookup_join(counts, own, end)
    expected = F.col("n_a").cast("double") * F.col("n_b") / F.col("n_all")
    return counts.select("a", "b", "n", F.greatest(F.log(F.col("n") / expected), F.lit(0.0)).alias("weight"))


def company_embeddings(
    baskets: DataFrame, items: str = "items", window: int = WINDOW, **settings
) -> tuple[DataFrame, ALSModel, DataFrame]:
    """``(word, index, vector)`` of every item that keeps company, with the model and its training rows.

    The weights of ``pointwise_information`` are factorised by alternating least squares, whose
    factors stay in blocks on the executors. Items with much the same company have much the same
    vectors. Baskets of one item say nothing and give no vector.

    Items are numbered before they are paired, and a pair is stored once for both directions: its rows
    are the largest table of the job.
    """
    numbered, index = _numbered(baskets, items, window)
    weights = pointwise_information(cooccurrences(numbered, window=window)).where("a < b")
    once = stage(weights.select("a", "b", "weight"), "weights")
    discard(numbered)
    ends = [F.struct(F.col(u).alias("userId"), F.col(i).alias("itemId"), F.col("weight").alias("rating")) for u, i in ("ab", "ba")]
    rows = once.select(F.inline(F.array(*ends)))
    model = train_als(rows, PAIRS_A_BLOCK, symmetric=True, **{**SETTINGS, **settings})
    factors = model.userFactors.select(F.col("id").alias("index"), F.col("features").alias("vector"))
    vectors = factors.join(index, "index").select(
        F.col("key").alias("word"), "index", to_vector("vector").alias("vector")
    )
    return vectors, model, rows
