"""Learned operators by held-out accuracy, exact counts and hand-made cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsetrail.llm import language, linear, mixing, queries, toxicity
from tests.llm.conftest import AWKWARD


def remainder(doc, parts):
    return zlib.crc32(str(doc).encode()) % parts


# ---------------------------------------------------------------- language


def test_language_query_is_right_on_held_out_documents(spark, folder, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = queries.op2_language(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(lang) and len(rows) == len(lang)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es"} for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_of_awkward_documents(documents, awkward, nothing):
    model = language.fit(language.labelled(documents, F.lit(True)))
    rows = language.predict(awkward, model).collect()
    assert len(rows) == len(AWKWARD)
    wordless = {None, 2, 3, 4, 5}
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in wordless - {None})
    assert {r.lang_pred for r in rows if r.doc_id in (7, 9)} <= set(model.languages)
    assert language.predict(nothing, model).count() == 0
    blank = language.fit(language.labelled(nothing, F.lit(True)))
    assert {(r.lang_pred, r.score) for r in language.predict(awkward, blank).collect()} == {("und", 0.0)}


@pytest.mark.parametrize(("text", "letters"), [("😀😀 !!", False), ("𠀀𠀁", True), ("𝒜𝓁", True), ("½ ①", False)])
def test_letters_of_every_plane(text, letters):
    assert (language.gram_counts(text) is not None) == letters


def test_too_many_languages_are_an_error(make):
    docs = make([(n, f"text {n}", f"l{n}") for n in range(language.LANGUAGES + 1)])
    with pytest.raises(ValueError):
        language.fit(language.labelled(docs, F.lit(True)))


def test_the_sample_and_so_the_model_do_not_depend_on_the_layout(documents):
    train = language.labelled(documents, F.lit(True))
    a, b = (language.fit(train.repartition(n), fit_rows=60) for n in (2, 5))
    assert a.languages == b.languages and np.allclose(a.idf, b.idf)
    shares = [np.sort(np.abs(m.weights).sum(axis=1)) for m in (a, b)]
    assert np.allclose(*shares, rtol=0.2)


@settings(deadline=None, max_examples=100)
@given(st.text(max_size=60))
def test_grams_of_any_text(text):
    counts = language.gram_counts(text)
    letters = sum(c.isalpha() for c in text.lower())
    assert (counts is None) == (letters == 0)
    if letters:
        assert letters <= counts.sum() <= 3 * len(text.lower())


def test_elastic_net_leaves_noise_at_zero():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 600)
    rows = []
    for y in labels:
        noise = rng.choice(np.arange(2, 200), 5, replace=False)
        rows.append((np.append(noise, y), np.ones(6)))
    model = linear.Ftrl(2, 200, alpha=0.3, l1=4.0, l2=0.1)
    model.fit(rows, labels.tolist(), epochs=3)
    weights = model.final()
    assert weights[0, 0] > 0.3 and weights[1, 1] > 0.3
    assert (weights[:, 2:-1] == 0).mean() > 0.6


def test_temperature_of_overconfident_logits():
    rng = np.random.default_rng(0)
    p = rng.uniform(0.55, 0.95, 4000)
    labels = (rng.uniform(size=4000) > p).astype(int)
    logits = np.column_stack([np.log(p / (1 - p)), np.zeros(4000)])
    assert linear.temperature(3 * logits, labels) == pytest.approx(3, rel=0.15)
    assert linear.temperature(np.zeros((0, 2)), labels[:0]) == 1


# ---------------------------------------------------------------- toxicity

INSULTS = ["vilewort", "grubface", "snotling", "muckbrain"]


def prose(rng, extra=()):
    words = [rng.choice(SYLLABLES) + rng.choice(SYLLABLES) for _ in range(60)] + list(extra)
    rng.shuffle(words)
    return " ".join(words)


SYLLABLES = "ta re mi no lu ser ban dor fil gan hep jor kal mon".split()


@pytest.fixture(scope="module")
def trained(spark):
    import random

    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        rows.append((i, prose(rng, rng.sample(INSULTS, 2) if toxic else ())))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxic_query_is_right_where_it_is_sure(spark, folder):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op6_toxicity(spark, folder).collect()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    clean = [r for r in rows if labels.get(r.doc_id) == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_disguised_words_are_restored_and_scored(trained):
    score = toxicity.Scorer(trained)
    for plain, disguises in {
        "vilewort": ["v1lewort", "vi1ew0rt", "viiiilewort", "v.i.l.e.w.o.r.t", "v*lewort", "VILEWORT!!"],
        "grubface": ["gru8f4ce", "grubf@ce", "gruuuubface"],
        "muckbrain": ["muckbr4in", "muckbra!n", "mmmuckbrain"],
    }.items():
        assert score(f"tare mino {plain} luser") >= 0.5
        for word in disguises:
            assert toxicity.restore_word(word.lower(), trained.chars) == plain
            assert score(f"tare mino {word} luser") >= 0.5
    assert score("tare mino v i l e w o r t luser") >= 0.5
    assert toxicity.restore("Tare v i l e w o r t, gru8f4ce luser", trained.chars).startswith("tare vilewor")
    assert score("tare mino luser bandor") < 0.5


def test_heavy_disguises_are_restored_and_scored(trained):
    score = toxicity.Scorer(trained)
    heavy = ["v1l3w0r7", "v|13w0r7", "v" + "i" * 40 + "lewort", "vviilleewwoorrtt"]
    for word in heavy:
        assert toxicity.restore_word(word, trained.chars) == "vilewort"
    for word in [*heavy, "v 1 1 3 w 0 r 7", "v i lewort", "vilewo r t"]:
        assert score(f"tare mino {word} luser") >= 0.5
    assert score("tare mino m i luser 1 0 0 bandor 2 0 1 7") < 0.5
    assert toxicity.restore_word("x" * 200_000, trained.chars).strip("x") == ""


def test_toxicity_of_awkward_documents(spark, trained, awkward, nothing):
    rows = toxicity.score(awkward, trained).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score < 0.5 for r in rows)
    assert toxicity.keep_clean(awkward, trained).columns == awkward.columns
    assert toxicity.keep_clean(awkward, trained).count() == len(AWKWARD)
    assert toxicity.score(nothing, trained).count() == 0
    unlabelled = toxicity.fit(awkward, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(awkward, unlabelled).collect()} == {0.0}


def test_char_model_is_a_distribution():
    model = toxicity.char_model(toxicity.gram_counts([b"some text about something", "größe".encode()]).astype(float))
    assert np.allclose(np.exp(model).sum(axis=1), 1, atol=1e-4)
    assert model.shape == (toxicity.KINDS**3, toxicity.KINDS)


# ---------------------------------------------------------------- language model


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def base_columns(docs, learned):
    counts = Counter(t for i, text in docs if learned(i) for t in tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for i, text in docs:
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out[i, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 4)] += 1
    return out


def test_lm_query_has_the_base_score_and_a_probability(spark, folder, texts):
    rows = queries.op5_lm_scoring(spark, folder).collect()
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)
    assert got == base_columns(list(texts.items()), lambda i: remainder(i, 7) != 2)
    assert all(r.held_out == (remainder(r.doc_id, 7) == 2) and r.score < 0 for r in rows)
    held = [r for r in rows if r.held_out]
    size = sum(len(texts[r.doc_id].encode()) for r in held)
    # far below the four bits or more that the letters of the text take one by one
    assert -sum(r.score for r in held) * math.log2(10) / size < 3


def test_lm_scores_of_awkward_documents(awkward, nothing):
    rows = mixing.score_documents(awkward, F.lit(True)).collect()
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)
    assert got == base_columns([(i, t) for i, t, _ in AWKWARD], lambda i: True)
    blank = mixing.score_documents(awkward, F.lit(None).cast("boolean")).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in blank} == {(0, 0, 0.0)}
    assert all(math.isfinite(r.score) and r.score < 0 for r in [*rows, *blank])
    assert mixing.score_documents(nothing, F.lit(True)).count() == 0


def small_model(words, counts):
    tree = mixing.huffman(np.bincount(np.frombuffer(b" ".join([*words, b""]), np.uint8), minlength=256))
    table = np.zeros((mixing.ORDERS << mixing.SLOT_BITS, 2), np.float32)
    bits = mixing.bits_of(words, tree)
    for slots in bits.slots:
        np.add.at(table.reshape(-1), slots * 2 + bits.value, counts[bits.word])
    return tree, table, mixing._odds(table), mixing.new_mixer()


def test_words_have_probabilities_that_do_not_exceed_one():
    words = sorted({a + b + c for a in (b"ab", b"cd", b"e") for b in (b"xyz", b"uv", b"") for c in (b"q", b"")} | {b""})
    counts = np.arange(1, len(words) + 1)
    tree, table, odds, mixer = small_model(words, counts.astype(np.float32))
    scores = mixing.word_scores(words, counts, table, odds, tree, mixer)
    assert 0.3 < (10**scores).sum() <= 1
    unseen = mixing.word_scores([b"zebra"], np.array([0]), table, odds, tree, mixer)
    assert unseen[0] < scores.min()


@settings(deadline=None, max_examples=50)
@given(st.lists(st.binary(max_size=12).map(lambda b: b.replace(b" ", b"_")), min_size=1, max_size=8, unique=True))
def test_bits_spell_the_words(words):
    words = sorted(words)
    tree = mixing.huffman(np.ones(256, int))
    bits = mixing.bits_of(words, tree)
    codes = {tuple(zip(tree.node[s, : tree.length[s]], tree.bit[s, : tree.length[s]])): s for s in range(256)}
    assert len(codes) == 256
    at = 0
    for n, word in enumerate(words):
        for symbol in word + b" ":
            length = tree.length[symbol]
            code = tuple(zip(bits.node[at : at + length], bits.value[at : at + length]))
            assert codes[code] == symbol and set(bits.word[at : at + length]) == {n}
            at += length
    assert at == len(bits.value)


def test_repeats_in_a_document_are_a_probability():
    known = [0.2, 0.3]
    for history in ([b"a", b"b", b"r", b"a"], [b"r", b"r", b"r"]):
        places = [{b"a": 0, b"b": 1}.get(w, -1) for w in history]
        before = mixing.in_document(history, places, known)
        total = 0.0
        for word in (b"a", b"b", b"r"):
            place = {b"a": 0, b"b": 1}.get(word, -1)
            total += 10 ** (mixing.in_document([*history, word], [*places, place], known) - before)
        assert 0 < total <= 1


def test_the_mixer_learns_from_every_training_word(spark, monkeypatch):
    """Every token has its weight in the steps and its bits in the map, in whatever shards it is."""
    counts = np.random.default_rng(2).zipf(1.3, 3000).clip(1, 10**6)
    word, weight, step = mixing.steps_of(counts, np.random.default_rng(0))
    assert np.bincount(word, weight) == pytest.approx(counts)
    assert np.bincount(step, weight).max() < 1.3 * np.bincount(step, weight).mean()
    words = [(f"w{i:x}", int(n)) for i, n in enumerate(counts)] + [("unseen", 0)]
    table = spark.createDataFrame(words, "word string, n long").repartition(3)
    passed = []
    monkeypatch.setattr(mixing, "mapped", lambda mixer, total: passed.append(total) or mixer)
    one = mixing.fit(table)
    many = mixing.fit(table.repartition(7), 100)
    again = mixing.fit(table, 100)
    bits = sum(n * int(one.tree.length[list(w.encode() + b" ")].sum()) for w, n in words)
    assert [t.sum() for t in passed] == pytest.approx([bits] * 3, rel=1e-6)
    assert np.array_equal(many.mixer.weights, again.mixer.weights)
    assert not np.array_equal(one.mixer.weights, mixing.new_mixer().weights)
