"""Packing and piece coding against the libraries, exact round trips and hand-made cases."""

import hashlib
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulsetrail.llm import packing, pieces, queries
from tests.llm.conftest import AWKWARD


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check_packed(rows, size=packing.SEQUENCE):
    """Every sequence is filled from 0 without gaps and holds at most ``size``."""
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= size
    return len(places)


def test_pack_query_has_the_ids_of_whole_texts(spark, folder, texts, tokenizer):
    rows = queries.op1_packing(spark, folder).collect()
    found = defaultdict(dict)
    for r in rows:
        found[r.doc_id][r.piece] = r
    assert set(found) == set(texts)
    for doc, text in texts.items():
        ids = np.array(whole_ids(tokenizer, text), "<u4")
        cuts = range(0, len(ids), 4096)
        assert sorted(found[doc]) == list(range(len(cuts)))
        for piece, start in enumerate(cuts):
            part = ids[start : start + 4096]
            r = found[doc][piece]
            assert (r.start, r.length, r.ids_crc32) == (start, len(part), zlib.crc32(part.tobytes()))
    used = check_packed(rows)
    assert used <= -(-sum(r.length for r in rows) // 4096) * 1.01 + 1


def test_awkward_documents_are_packed_each(awkward, nothing, tokenizer):
    rows = packing.pack_documents(awkward, most=64).collect()
    check_packed(rows, 64)
    by_doc = Counter()
    for r in rows:
        by_doc[r.doc_id] += r.length
    expected = Counter()
    for doc, text, _ in AWKWARD:
        expected[doc] += len(whole_ids(tokenizer, text))
    assert by_doc == expected
    assert packing.pack_documents(nothing).count() == 0


def test_sequences_hold_the_ids(make, tokenizer):
    docs = make([(i, f"word{i} " * (i % 9), "en") for i in range(50)])
    packed = packing.pack_documents(docs, most=16, with_ids=True)
    total = Counter(t for r in packing.sequences(packed).collect() for t in r.ids)
    assert total == Counter(t for r in docs.collect() for t in whole_ids(tokenizer, r.text))


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), min_size=1, max_size=25))
def test_plan_is_best_fit_one_by_one(counts):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(40 - length)
    slots = packing.plan_slots(counts, 40)
    bins = defaultdict(list)
    ranks = defaultdict(list)
    for s in slots:
        for rank in range(s.low, s.high):
            nth = rank - s.low
            bins[s.bin + nth // s.each].append((s.offset + nth % s.each * s.length, s.length))
            ranks[s.length].append(rank)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 40
    assert len(bins) == len(rooms)


def test_plan_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        packing.plan_slots({41: 1}, 40)


@settings(deadline=None, max_examples=150)
@given(st.text(max_size=40))
def test_word_ids_equal_the_tokenizer(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")) if not CACHED else CACHED[0]
    CACHED[:] = [tokenizer]
    own = packing.word_ids("word_bpe_49k.json").of([text.encode("utf-8", "ignore")])[0]
    clean = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(own, "<u4").tolist() == tokenizer.encode(clean, add_special_tokens=False).ids


def test_unseen_words_are_encoded_together(tokenizer, monkeypatch):
    """Words of letters go to the tokenizer as joined texts, and a stem once for all punctuation behind it."""
    coder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return tokenizer.encode_batch_fast(texts, **options)

    monkeypatch.setattr(coder, "tokenizer", Counting())
    stems = [f"{a}{b}{c}" for a in ("tar", "mön", "lu") for b in "aeiou" for c in "bcdfghjklm"]
    awkward = ["İx", "x's.", "don't,", "'s", "...", "a7.", "é.", "\u2013.", "\u1100", "a\u0301b,", "\u00a0", "\u00a0.", "\u00bd!"]
    regular = [" ".join(f"{s}{end}" for s in stems for end in ("", ",", ".", "?!", "'")), "", " \t"]
    found = [coder.of([t.encode() for t in regular]), len(sent), coder.of([" ".join(awkward).encode()])]
    ids = [np.frombuffer(f, "<u4").tolist() for f in found[0] + found[2]]
    assert ids == [whole_ids(tokenizer, t)[:-1] for t in [*regular, " ".join(awkward)]]
    assert found[1] < 20


CACHED: list = []
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain_coder():
    return pieces.Coder(PIECES)


def test_without_dropout_pieces_equal_the_library(plain_coder, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in [*list(texts.values())[:120], "", " ", "  a  b ", "\n\n x\t\ty", "日本語 🎉", "<s> <unk> <0x0A>"]:
        assert np.frombuffer(plain_coder.encode(text), "<u4").tolist() == library.encode(text)


@settings(deadline=None, max_examples=150)
@given(st.text(max_size=40), st.floats(0, 1), st.integers(0, 3))
def test_any_text_survives_any_dropout(text, drop, key):
    text = text.encode("utf-8", "ignore").decode()
    own = pieces.coder("piece_bpe_32k.model")
    ids = np.frombuffer(own.encode(text, drop, 1, key), "<u4").tolist()
    assert own.decode(ids).decode() == text


@settings(deadline=None, max_examples=150)
@given(st.text("abcdehinorst\u2581", max_size=60), st.floats(0, 1), st.integers(0, 2**64 - 1))
def test_short_and_long_units_are_merged_alike(unit, drop, key):
    own = pieces.coder("piece_bpe_32k.model")
    limit, pieces.LONG_UNIT = pieces.LONG_UNIT, 100
    try:
        skip = own.skip_by_hash(drop, key)
        assert own.merge(unit, skip) == own._merge_long(unit, skip)
    finally:
        pieces.LONG_UNIT = limit


def plainly_encoded(own, text, drop, seed, key):
    """The same dropout with every occurrence merged on its own, candidate by candidate."""
    signs, units, at = pieces.SPACE, [], 0
    for n, part in enumerate(text.split(signs)) if text else ():
        shown = (signs if n == 0 else "") + part.replace(" ", signs)
        units += ([""] if n else []) + own.units.findall(shown)
    ids = []
    for unit in units:
        base = xxhash.xxh64_intdigest(f"{seed}|{key}") + at * pieces.PLACE_FACTOR
        at += max(len(unit), 1)
        spans, skipped = [(i, i + 1) for i in range(len(unit))], set()
        while True:
            agenda = [
                (own.ranks[unit[a:c]], i) for i, ((a, b), (_, c)) in enumerate(pairwise(spans))
                if unit[a:c] in own.ranks and (a, b, c) not in skipped
            ]
            if not agenda:
                break
            i = min(agenda)[1]
            (a, b), (_, c) = spans[i : i + 2]
            value = (base + a * pieces.PLACE_FACTOR + own.ids[unit[a:c]] * pieces.PIECE_FACTOR) % 2**64
            if pieces.drawn(value) < drop * 2**53:
                skipped.add((a, b, c))
            else:
                spans[i : i + 2] = [(a, c)]
        for a, b in spans:
            known = own.ids.get(unit[a:b])
            ids += [known] if known is not None else [own.bytes[x] for x in unit[a:b].encode()]
        ids += [own.bytes[x] for x in signs.encode()] if unit == "" else []
    return ids


@pytest.mark.parametrize("drop", [0.0, 0.1, 0.5, 1.0])
@pytest.mark.parametrize("at_once", [7, 100_000])
def test_dropout_equals_brute_force(plain_coder, texts, drop, at_once, monkeypatch):
    monkeypatch.setattr(pieces, "UNITS_AT_ONCE", at_once)
    some = [t[:1500] for t in [*texts.values()][:12]] + ["", "▁a ▁▁", "日本語 🎉" * 20, "  x\n\ny  "]
    own = plain_coder.encode_all(some, range(len(some)), drop, 5)
    for key, (text, ids) in enumerate(zip(some, own)):
        assert np.frombuffer(ids, "<u4").tolist() == plainly_encoded(plain_coder, text, drop, 5, key)


def test_dropout_varies_with_seed_document_and_place_and_repeats(plain_coder):
    text = "repeatable segmentation of somewhat longer words"
    made = {}
    for seed in (0, 1):
        for key in range(3):
            made[seed, key] = plain_coder.encode(text, 0.3, seed, key)
            assert plain_coder.encode(text, 0.3, seed, key) == made[seed, key]
    assert len(set(made.values())) > 3
    assert all(len(m) >= len(plain_coder.encode(text)) for m in made.values())
    ids = np.frombuffer(plain_coder.encode("segmentation " * 200, 0.3), "<u4").tolist()
    words = "".join(f"{i}," for i in ids).split(f"{plain_coder.ids['▁s']},")
    assert len(set(words)) > 5  # one word of one text, cut in many ways


def test_rate_of_dropout(plain_coder):
    """A blank and a letter that make one piece stay apart at the rate, over places of one document."""
    keys = np.arange(20_000, dtype=np.uint64) * np.uint64(pieces.PLACE_FACTOR)
    _, counts = plain_coder._settled(["▁a"] * 20_000, keys, 0.1)
    apart = (counts > 1).mean()
    assert 0.09 < apart < 0.11


def test_piece_query_decodes_every_text(spark, folder, texts):
    rows = queries.op10_pieces(spark, folder).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()
    }


def test_awkward_documents_decode(awkward, nothing):
    coded = pieces.encode_documents(awkward, drop=0.5)
    rows = pieces.decode_documents(coded).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t or "") for i, t, _ in AWKWARD)
    assert pieces.decode_documents(pieces.encode_documents(nothing)).count() == 0
