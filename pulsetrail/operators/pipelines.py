"""``pyspark.ml`` pipelines described by column lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
)
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizerModel,
    HashingTF,
    OneHotEncoder,
    RegexTokenizer,
    RFormula,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame

from pulsetrail.operators.categories import CategoryIndexer
from pulsetrail.operators.perceptron import BatchPerceptron

SEED = 11
MOST_ENTRIES = 1 << 18  # of the vocabulary of a list column


@dataclass(frozen=True)
class TextColumn:
    """A delimited column turned into hashed TF-IDF."""

    name: str
    pattern: str
    buckets: int


@dataclass(frozen=True)
class ListColumn:
    """A delimited column turned into a multi-hot vector over a given vocabulary.

    Entries that the vocabulary lacks are left out, repeats count once, an empty text is all zeros.
    """

    name: str
    pattern: str
    vocabulary: tuple[str, ...]

    @classmethod
    def of(cls, name: str, pattern: str, vocab: DataFrame, most: int = MOST_ENTRIES) -> ListColumn:
        """From a table of ``(token, index)``; the entries become a setting of the stage, ``most`` at most."""
        rows = vocab.orderBy("index").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"more than {most} entries")
        return cls(name, pattern, tuple(r["token"] for r in rows))


@dataclass(frozen=True)
class Features:
    """Which columns become features, and how.

    ``categorical`` columns are indexed and one-hot encoded, with ``category_tables`` by an index whose
    categories never come to the driver; ``formula`` columns take the formula encoding, ``lists`` are
    multi-hot, ``vectors`` go in as they are. With ``pca`` the assembled vector is reduced to that
    width. ``flags`` are 0/1 columns that join after the reduction, one-hot encoded, so that a
    treatment stays a feature of its own.
    """

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    formula: Sequence[str] = ()
    text: Sequence[TextColumn] = ()
    lists: Sequence[ListColumn] = ()
    vectors: Sequence[str] = ()
    flags: Sequence[str] = ()
    pca: int | None = None
    label: str = "label"
    unknown_category: str = "error"
    null_numbers: str = "error"
    formula_nulls: str = "skip"
    category_tables: bool = False

    def columns(self) -> list[str]:
        """The input columns, each once; a job reads no others."""
        texts = [column.name for column in (*self.text, *self.lists)]
        groups = (self.numeric, self.categorical, self.formula, texts, self.vectors, self.flags)
        return list(dict.fromkeys(name for group in groups for name in group))


@dataclass(frozen=True)
class Learner:
    """A classifier and its settings; settings that are not given stay at Spark's defaults."""

    kind: str = "gbt"
    settings: dict[str, Any] = field(default_factory=dict)

    def with_settings(self, **settings: Any) -> Learner:
        return replace(self, settings={**self.settings, **settings})


def tfidf_stages(column: TextColumn) -> list[Any]:
    """Tokenise, hash, weigh; the result is ``<name>_vec``."""
    name = column.name
    return [
        RegexTokenizer(inputCol=name, outputCol=f"{name}_token", pattern=column.pattern),
        HashingTF(inputCol=f"{name}_token", outputCol=f"{name}_tf", numFeatures=column.buckets),
        IDF(inputCol=f"{name}_tf", outputCol=f"{name}_vec"),
    ]


def multi_hot_stages(column: ListColumn) -> list[Any]:
    """Split, look up; the result is ``<name>_hot``."""
    if not column.vocabulary:
        raise ValueError(f"the vocabulary of {column.name} is empty")
    name = column.name
    split = RegexTokenizer(inputCol=name, outputCol=f"{name}_entries", pattern=column.pattern, toLowercase=False)
    known = CountVectorizerModel.from_vocabulary(list(column.vocabulary), f"{name}_entries", f"{name}_hot")
    return [split, known.setBinary(True)]


def feature_stages(features: Features, out: str = "features") -> list[Any]:
    """The stages that turn a feature table's columns into the vector ``out``."""
    stages: list[Any] = []
    inputs: list[str] = []
    if features.categorical:
        names = list(features.categorical)
        indexed, encoded = [f"{n}_index" for n in names], [f"{n}_vec" for n in names]
        indexer = CategoryIndexer if features.category_tables else StringIndexer
        stages.append(indexer(inputCols=names, outputCols=indexed, handleInvalid=features.unknown_category))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded))
        inputs += encoded
    if features.formula:
        stages.append(
            RFormula(
                formula=f"{features.label} ~ " + " + ".join(features.formula),
                featuresCol="formula_vec",
                labelCol=features.label,
                handleInvalid=features.formula_nulls,
            )
        )
        inputs.append("formula_vec")
    for column in features.text:
        stages += tfidf_stages(column)
        inputs.append(f"{column.name}_vec")
    for column in features.lists:
        stages += multi_hot_stages(column)
        inputs.append(f"{column.name}_hot")
    inputs += [*features.vectors, *dict.fromkeys(features.numeric)]

    last = "assembled" if features.pca or features.flags else out
    stages.append(VectorAssembler(inputCols=inputs, outputCol=last, handleInvalid=features.null_numbers))
    if features.pca:
        reduced = "reduced" if features.flags else out
        stages.append(PCA(k=features.pca, inputCol=last, outputCol=reduced))
        last = reduced
    if features.flags:
        encoded = [f"{n}_vec" for n in features.flags]
        stages.append(OneHotEncoder(inputCols=list(features.flags), outputCols=encoded))
        stages.append(VectorAssembler(inputCols=[last, *encoded], outputCol=out))
    return stages


def classifier(learner: Learner, features: Features) -> Any:
    """The learner reading ``features`` and the label."""
    columns = {"labelCol": features.label, "featuresCol": "features"}
    if learner.kind == "gbt":
        return GBTClassifier(**{"seed": SEED, **columns, **learner.settings})
    if learner.kind == "logistic":
        return LogisticRegression(**columns, **learner.settings)
    if learner.kind == "perceptron":
        return BatchPerceptron(**{"seed": SEED, **columns, **learner.settings})
    raise ValueError(f"unknown learner {learner.kind!r}")


def build_pipeline(features: Features, learner: Learner | None = None) -> Pipeline:
    """Feature stages, and the classifier when one is given."""
    stages = feature_stages(features)
    if learner is not None:
        stages.append(classifier(learner, features))
    return Pipeline(stages=stages)
