"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. The classifier is fitted by FTRL with
elastic-net penalties on a bounded, reproducible sample of them (``fit_rows``, dealt evenly to the
languages), and a temperature is fitted on a fifth of the sample that is kept out of the training.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from sys import maxunicode
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import in_arrow, plain, record, slices
from pulsetrail.llm.linear import Ftrl, Row, logits_of, softmax, temperature

FEATURES = 1 << 15
FIT_ROWS = 8000
LANGUAGES = 256  # more would not fit the one task that fits the model: an error, none is left out
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(maxunicode + 1)), bool, maxunicode + 1)


def gram_counts(text: str) -> np.ndarray | None:
    """Hashed counts of the character 1- to 3-grams of a text; None if it has no letter.

    The text is lower-cased; every other character than a letter is a blank; grams of blanks only do
    not count.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _letters()[codes]
    if not letters.any():
        return None
    codes = np.where(letters, codes, np.uint32(32))
    a = codes * np.uint32(0x9E3779B1)
    found = [a[letters]]
    pair = (a[:-1] ^ np.uint32(0x51ED270B)) * np.uint32(0x85EBCA77) + codes[1:]
    found.append((pair * np.uint32(0x9E3779B1))[letters[:-1] | letters[1:]])
    triple = (pair[:-1] ^ np.uint32(0x2545F491)) * np.uint32(0xC2B2AE3D) + codes[2:]
    found.append((triple * np.uint32(0x9E3779B1))[letters[:-2] | letters[1:-1] | letters[2:]])
    return np.bincount(np.concatenate(found) >> np.uint32(17), minlength=FEATURES)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> Row:
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / max(np.linalg.norm(values), 1e-12)


def _frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, and the number of documents with a letter."""
    schema = pa.schema([("feature", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in slices(batches, "text"):
            for text in batch.column("text"):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    total[:-1] += counts > 0
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield record(schema, feature=at, n=total[at])

    found = in_arrow(docs.select("text"), count, "feature int, n long")
    total = np.zeros(FEATURES + 1, np.int64)
    for row in found.groupBy("feature").agg(F.sum("n").alias("n")).collect():  # FEATURES + 1 at most
        total[row["feature"]] = row["n"]
    return total[:-1], int(total[-1])


def fit(train: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 7) -> Model:
    """A model of the rows of ``(doc_id, text, lang)`` that have a language.

    Rows of the sample are chosen by a hash of id and text, the same way on any cluster. The fit runs
    in one task on at most about ``fit_rows`` rows of hashed counts; document frequencies come from
    all rows.
    """
    train = train.where("lang is not null")
    frequency, documents = _frequencies(train)
    idf = np.log((1 + documents) / (1 + frequency)) + 1
    sizes = train.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], idf, np.zeros((0, FEATURES + 1)), 1.0)
    share = {r["lang"]: fit_rows / len(sizes) / r["count"] for r in sizes}
    spark = train.sparkSession
    shares = spark.createDataFrame(
        [(n, lang, float(min(1.0, share[lang]))) for n, lang in enumerate(languages)],
        "label int, lang string, share double",
    )
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = train.join(F.broadcast(shares), "lang").where(draw < F.col("share"))
    one = pa.schema([("label", pa.int32()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: dict[str, list] = {"label": [], "ids": [], "counts": []}
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text")):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    at = np.flatnonzero(counts)
                    out["label"].append(label)
                    out["ids"].append(at.astype(np.int32))
                    out["counts"].append(counts[at].astype(np.int32))
            yield record(one, **out)

    classes = len(languages)
    fitted = pa.schema([("label", pa.int32()), ("weights", pa.list_(pa.float32())), ("t", pa.float64())])

    def train_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[Row] = []
        labels: list[int] = []
        for batch in batches:
            for label, at, counts in zip(*(batch.column(c) for c in ("label", "ids", "counts"))):
                at = at.values.to_numpy()
                values = (1 + np.log(counts.values.to_numpy())) * idf[at]
                rows.append((at, (values / np.linalg.norm(values)).astype(np.float32)))
                labels.append(label.as_py())
        order = np.random.default_rng(seed).permutation(len(rows))
        held, used = order[: len(order) // 5], order[len(order) // 5 :]
        model = Ftrl(classes, FEATURES, alpha=0.5, l1=0.02, l2=1e-4)
        model.fit([rows[i] for i in used], [labels[i] for i in used], epochs=3)
        weights = model.final()
        logits = np.array([logits_of(weights, rows[i]) for i in held])
        t = temperature(logits, np.array([labels[i] for i in held], int))
        yield record(fitted, label=list(range(classes)), weights=list(weights.astype(np.float32)), t=[t] * classes)

    drawn = in_arrow(sample.select("label", "text"), features, "label int, ids array<int>, counts array<int>")
    made = in_arrow(drawn.repartition(1), train_one, "label int, weights array<float>, t double")
    rows = sorted(made.collect(), key=lambda r: r["label"])  # a row per language
    if not rows:
        return Model([], idf, np.zeros((0, FEATURES + 1)), 1.0)
    weights = np.array([r["weights"] for r in rows], np.float32)
    return Model(languages, idf, weights, rows[0]["t"])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every whole text.

    A null text, a text without letters, or a model without languages gives ``und`` with score 0.
    Rows that share an id are each predicted. An empty table gives an empty result.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, idf, weights, t = shared.value
        for batch in slices(batches, "text"):
            names, scores = [], []
            for text in batch.column("text"):
                counts = gram_counts(text.as_py()) if languages else None
                if counts is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    p = softmax(logits_of(weights, tf_idf(counts, idf)) / t)
                    best = int(p.argmax())
                    names.append(languages[best])
                    scores.append(float(p[best]))
            yield record(schema, doc_id=batch.column("doc_id"), lang_pred=names, score=scores)

    return in_arrow(plain(docs, id_col, text_col), work, "doc_id long, lang_pred string, score double")


def labelled(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, lang)`` of the rows that ``learn`` holds for."""
    return docs.where(learn).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col("lang"),
    )
