"""Toxicity: noisy-channel deobfuscation, then a linear score of the restored words.

Words that may be disguised (letters replaced by look-alikes, set apart or repeated) are lattices of
the letters they may stand for. A Viterbi search takes the best path under a character language model
counted over the whole corpus. The score is a logistic regression on the words and word beginnings of
the restored text, fitted by FTRL on a bounded, reproducible sample of the labelled documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pulsetrail.llm.common import in_arrow, plain, record, slices
from pulsetrail.llm.linear import Ftrl, Row

# Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou",
}
LITERAL, SWAPPED, FEWER = math.log(0.05), math.log(0.3), math.log(0.5)  # channel log probabilities

KINDS = 28  # a blank or sign, a to z, any other letter
LM_ORDER = 4
FIT_ROWS = 6000  # of either label
BAR = 30.0  # least chi-square of a feature with label 1 over the sample
WORDS_KEPT = 400_000
EDGES = "\"'`.,;:?!()[]{}<>|*+~_-#/\\&%=^"
FRONT = "".join(c for c in EDGES if c not in LOOKALIKES)
APART = re.compile(r"[^\W_](?:[.\-_~*][^\W_]){2,}")
DOUBLE = re.compile(r"(.)\1")
MIXED = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
LETTER = re.compile(r"[^\W\d_]")


# ---------------------------------------------------------------- the language model


def _kinds() -> np.ndarray:
    """The kind of each byte of a lower-cased text; bytes beyond ASCII count as one other letter."""
    kinds = np.zeros(256, np.int32)
    kinds[97:123] = np.arange(1, 27)
    kinds[128:] = 27
    return kinds


def _kind(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if ord(char) > 127 else 0


def gram_counts(texts: Iterable[bytes]) -> np.ndarray:
    """Counts of all character 4-grams, texts apart; a run of bytes beyond ASCII stays as it is."""
    kinds = _kinds()[np.frombuffer(b"   ".join([b"", *(t.lower() for t in texts), b""]), np.uint8)]
    code = kinds[: len(kinds) - LM_ORDER + 1].copy()
    for n in range(1, LM_ORDER):
        code = code * KINDS + kinds[n : len(kinds) - LM_ORDER + 1 + n]
    return np.bincount(code, minlength=KINDS**LM_ORDER)


def corpus_grams(texts: DataFrame) -> np.ndarray:
    """4-gram counts of all rows of a ``text`` column; KINDS ** 4 numbers, whatever the input."""
    schema = pa.schema([("gram", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(KINDS**LM_ORDER, np.int64)
        for batch in slices(batches, "text"):
            total += gram_counts(t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary()))
        at = np.flatnonzero(total)
        yield record(schema, gram=at, n=total[at])

    found = in_arrow(texts.select("text"), count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    total = np.zeros(KINDS**LM_ORDER)
    for row in found.toLocalIterator():
        total[row["gram"]] = row["n"]
    return total


def char_model(grams: np.ndarray) -> np.ndarray:
    """log P(character | the three before it), smoothed with the shorter contexts."""
    p = np.full(KINDS, 1 / KINDS)
    for order in range(1, LM_ORDER + 1):
        counts = grams.reshape(-1, KINDS**order).sum(axis=0).reshape(-1, KINDS)
        lower = np.tile(p.reshape(-1, KINDS), (len(counts) // max(1, p.size // KINDS), 1))
        p = (counts + 4 * lower) / (counts.sum(axis=1, keepdims=True) + 4)
    return np.log(p).astype(np.float32)


# ---------------------------------------------------------------- the channel


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each run of one sign the strings that it may stand for, with channel log probabilities.

    A blank between the parts of a partly spaced word may stand for itself or for nothing.
    """
    steps = []
    for run in re.finditer(r"(.)\1*", word):
        sign, n = run[1], len(run[0])
        if sign == " ":
            steps.append([(sign, 0.0), ("", FEWER)])
            continue
        options = [(run[0], LITERAL if sign in LOOKALIKES else 0.0)]
        options += [(letter * n, SWAPPED) for letter in LOOKALIKES.get(sign, "")]
        if n > 1:
            options += [(text[0] * m, cost + FEWER) for text, cost in options for m in (1, 2) if m < n]
        steps.append(options)
    return steps


def decode(word: str, model: np.ndarray) -> str:
    """The most likely plain form of a disguised word under ``char_model``; linear in its length."""
    paths: dict[tuple, tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
    for options in [*lattice(word), [(" ", 0.0)]]:
        ahead: dict[tuple, tuple[float, tuple | None]] = {}
        for context, (score, path) in paths.items():
            for letters, cost in options:
                a, b, c = context
                total = score + cost
                for letter in letters:
                    kind = _kind(letter)
                    total += float(model[(a * KINDS + b) * KINDS + c, kind])
                    a, b, c = b, c, kind
                if (a, b, c) not in ahead or ahead[a, b, c][0] < total:
                    ahead[a, b, c] = (total, (path, letters))
        paths = ahead
    path, parts = max(paths.values(), key=lambda found: found[0])[1], []
    while path:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts)).strip()


def core_of(word: str) -> str:
    """A lower-cased word without signs at its ends, and without signs that set its letters apart.

    A sign at the front that may stand for a letter stays.
    """
    core = word.rstrip(EDGES).lstrip(FRONT)
    if APART.fullmatch(core):
        core = re.sub(r"[.\-_~*]", "", core)
    return core


def may_spell(word: str) -> bool:
    """Whether a word has a letter, or two signs that may stand for letters."""
    return LETTER.search(word) is not None or len(MIXED.findall(word)) > 1


def disguised(core: str) -> bool:
    """Whether a word may have letters, and has look-alikes or one sign twice in a row."""
    return len(core) > 2 and (MIXED.search(core) or DOUBLE.search(core)) is not None and may_spell(core)


def restore_word(word: str, model: np.ndarray) -> str:
    core = core_of(word)
    return decode(core, model) if disguised(core) else core


def restore_words(word: str, model: np.ndarray) -> list[str]:
    """What a word of ``words_of`` stands for: itself restored, or the new words of a partly spaced one."""
    if " " not in word:
        return [restore_word(word, model)]
    parts = word.split(" ")
    return [w for w in decode(word, model).split() if w not in parts]


def _single(word: str) -> bool:
    return len(word) == 1 and (word in LOOKALIKES or LETTER.match(word) is not None)


def spaced_words(words: list[str]) -> list[str]:
    """Words of three or more letters that stand alone side by side."""
    found, run = [], []
    for word in [*words, ""]:
        if _single(word):
            run.append(word)
        else:
            if len(run) > 2 and may_spell("".join(run)):
                found.append("".join(run))
            run = []
    return found


def partly_spaced_words(words: list[str]) -> list[str]:
    """Two or more letters that stand alone side by side, with the words next to them, by blanks."""
    found, start = [], 0
    while start < len(words):
        end = start
        while end < len(words) and _single(words[end]):
            end += 1
        if end - start > 1 and may_spell("".join(words[start:end])):
            sides = [core_of(w) for w in (*words[max(0, start - 1) : start], *words[end : end + 1])]
            before, after = sides[: start > 0], sides[start > 0 :]
            if any(sides):
                found.append(" ".join(filter(None, [*before, *words[start:end], *after])))
        start = end + 1
    return found


def words_of(text: str) -> set[str]:
    """The distinct words of a text, also those that are written with blanks between letters.

    Those of which only some letters are set apart still have their blanks.
    """
    words = text.lower().split()
    distinct = set(words)
    if any(len(w) == 1 for w in distinct):
        distinct.update(spaced_words(words))
        distinct.update(partly_spaced_words(words))
    return distinct


def restore(text: str, model: np.ndarray) -> str:
    """The text with disguised words replaced; other words keep their form, in lower case."""
    words = text.lower().split()
    out, at = [], 0
    while at < len(words):
        end = at
        while end < len(words) and len(words[end]) == 1:
            end += 1
        joined = spaced_words(words[at:end])
        if joined:
            out += [restore_word(w, model) for w in joined]
            at = end
        else:
            core = core_of(words[at])
            out.append(decode(core, model) if disguised(core) else words[at])
            at += 1
    return " ".join(out)


# ---------------------------------------------------------------- the score


def features_of(word: str) -> list[int]:
    """The word and its beginnings of four and five letters, as 64-bit hashes."""
    names = [f"={word}"] + [word[:n] for n in (4, 5) if len(word) > n]
    return [xxh64_intdigest(name) >> 1 for name in names]


class Model(NamedTuple):
    chars: np.ndarray
    weights: dict[int, float]
    intercept: float | None  # None: nothing was learned


class Scorer:
    """Adds up the weights of the distinct words of a text; keeps the sums of words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        ids = [i for w in restore_words(word, self.model.chars) for i in features_of(w)]
        return sum(self.model.weights.get(i, 0.0) for i in ids)

    def __call__(self, text: str) -> float:
        if self.model.intercept is None:
            return 0.0
        words, known = words_of(text), self.known
        if len(known) > WORDS_KEPT:
            known.clear()
        for word in words.difference(known):
            known[word] = self.word(word)
        # the order of a set differs between workers, and so would the last bits of a plain sum
        logit = self.model.intercept + math.fsum(filter(None, map(known.__getitem__, words)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, logit))))


def _signs(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The features that go with label 1 beyond chance: chi-square of at least ``BAR``."""
    none = [np.empty(0, np.int64)]
    ids, docs = np.unique(np.concatenate(none + rows), return_counts=True)
    toxic, hits = np.unique(
        np.concatenate(none + [r for r, y in zip(rows, labels) if y]), return_counts=True
    )
    both = np.zeros(len(ids))
    both[np.searchsorted(ids, toxic)] = hits
    total, ones = len(labels), max(1, int(labels.sum()))
    gap = both * total - docs * ones
    spread = docs.astype(float) * (total - docs) * ones * max(1, total - ones)
    chi = np.divide(total * gap * gap, spread, out=np.zeros(len(ids)), where=spread > 0)
    return ids[(chi >= BAR) & (gap > 0)]


def _fit(rows: list[np.ndarray], labels: list[int], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """``(feature hashes, weights, intercept)``; ``prior`` is the share of label 1 outside the sample."""
    ids = _signs(rows, np.array(labels, int))
    made: list[Row] = []
    for row in rows:
        at = np.searchsorted(ids, row[np.isin(row, ids)])
        made.append((at, np.ones(len(at))))
    model = Ftrl(2, len(ids), alpha=0.3, l1=0.5, l2=1.0)
    model.fit(made, labels, epochs=4)
    weights = model.final()
    weight = weights[1] - weights[0]
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    shift = math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    kept = np.flatnonzero(weight[:-1])
    return ids[kept], weight[kept], float(weight[-1] + shift)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    fit_rows: int = FIT_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model of ``labels`` (``doc_id``, ``toxic``), those for which ``learn`` (of the id) holds.

    The character model counts all documents. The classifier is fitted in one task on the ``fit_rows``
    labelled documents of either label with the smallest hash of their id, so the list of them is
    bounded and may be broadcast; the share of the labels is counted over all of them and corrects the
    intercept. Without labels nothing is learned. A document with several labels has the largest one.
    """
    texts = plain(docs, id_col, text_col)
    chars = char_model(corpus_grams(texts))
    marked = labels.where("toxic in (0, 1) and doc_id is not null")
    marked = marked.where(learn) if learn is not None else marked
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    total = sum(sizes.values())
    if not total:
        return Model(chars, {}, None)
    prior = (sizes.get(1, 0) + 0.5) / (total + 1)
    first = F.xxhash64("doc_id", F.lit(11))
    drawn = [marked.where(F.col("toxic") == y).orderBy(first, "doc_id").limit(fit_rows) for y in (0, 1)]
    sample = texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id").select("toxic", "text")
    one = pa.schema([("label", pa.int32()), ("ids", pa.list_(pa.int64()))])
    fitted = pa.schema([("id", pa.int64()), ("weight", pa.float64())])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in slices(batches, "text"):
            ids = []
            for text in batch.column("text"):
                found = words_of(text.as_py())
                if len(known) > WORDS_KEPT:
                    known.clear()
                for word in found.difference(known):
                    known[word] = restore_words(word, chars)
                words = {w for word in found for w in known[word]}
                ids.append(sorted({i for w in words for i in features_of(w)}))
            yield record(one, label=batch.column("toxic").cast(pa.int32()), ids=ids)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, marks = [], []
        for batch in batches:
            marks += batch.column("label").to_pylist()
            rows += [r.values.to_numpy() for r in batch.column("ids")]
        order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), marks[i]))
        ids, weights, intercept = _fit([rows[i] for i in order], [marks[i] for i in order], prior)
        yield record(fitted, id=[-1, *ids.tolist()], weight=[intercept, *weights.tolist()])

    counted = in_arrow(sample, features, "label int, ids array<long>")
    found = in_arrow(counted.repartition(1), train, "id long, weight double")
    weights = {r["id"]: r["weight"] for r in found.toLocalIterator()}
    intercept = weights.pop(-1, None)
    return Model(chars, weights, intercept)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, score)`` of every whole text, 0 to 1; a null text is an empty one.

    An empty text has the score of a document without any known word; without labels to learn from
    every score is 0. Rows that share an id are each scored. An empty table gives an empty result.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches, "text"):
            scores = [scorer(t.as_py()) for t in batch.column("text")]
            yield record(schema, row=batch.column("row"), doc_id=batch.column("doc_id"), score=scores)

    rows = plain(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return in_arrow(rows, work, "row long, doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, bar: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that score below ``bar``, all their columns as they are; nothing is moved."""
    names, shared = docs.columns, docs.sparkSession.sparkContext.broadcast(model)
    at = names.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices(batches, text_col):
            yield batch.filter(pa.array([scorer(t.as_py() or "") < bar for t in batch.column(at)], pa.bool_()))

    return in_arrow(docs, keep, docs.schema)
