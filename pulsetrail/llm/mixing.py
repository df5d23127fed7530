"""Language-model scoring by logistic context mixing.

A text is its words and one end. The bytes of a word, then a blank, are coded bit by bit along a
Huffman tree of bytes; the end is the empty word. For each bit several predictors look up how often
it was 0 and 1 in hashed contexts: the last one to four bytes of the word, in tables of a fixed size,
and from the fifth byte on all of the word so far, counted where the words with the same first four
bytes meet, so this part of the model grows with the corpus. A gated mixer adds up their log odds,
with weights chosen by the place in the word and by how often the longest context was seen, and an
adaptive map corrects what comes out. Counts cover all training words, and the mixer and the map
learn from all of them too, each taken out of the counts while it is predicted: families of words are
dealt to shards by hash, a mixer learns online in each shard, and the mixers are averaged by their
curvature; then the map adds up the bits of all shards under that mixer. So far the probability of a word does not depend on its neighbours, and every distinct
word is scored once and joined back to the documents. In a document a last mixer, whose share is
learned online from its start to its end, adds the words that the document has had before.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import in_arrow, plain, record, slices
from pulsetrail.session import stage

ORDERS = 4  # contexts of the last 1, 2, ... bytes; one more has the whole word so far
INPUTS = ORDERS + 1
SLOT_BITS = 20  # slots of the table of each order
BLOCK = 1 << 10
SHARD_WORDS = 30_000  # distinct training words that a mixer learns from, about
MOST_SHARDS = 512  # whose mixers are averaged; more words make larger shards
STEP_WORDS = 64  # of one online step, about
LEAST_STEPS = 250  # for each part of a shard, if it has the tokens
HEAD = 1 << 16  # at most so many of the most frequent words have scores that go to all tasks
HEAD_BYTES = 64  # longer words are never among them
DISTINCT = 300_000  # words counted in a task before it hands them on
END = " "  # no word has a blank
WORDS_AT_ONCE = 4_000
BYTES_AT_ONCE = 50_000
PLACES, SEEN = ORDERS + 1, 12  # gates
BUCKETS = 33  # of the adaptive map
DELTA = 0.4
RATE = 0.02  # of the online steps
RIDGE = 0.01  # curvature that the first weights have
PRIOR = 16.0  # bits that an entry of the map has from the start
ADAPT = 0.02  # of the share of words that a document repeats, for each word
RARE = 1e-7  # what a rare word counts as when that share is learned


class Tree(NamedTuple):
    """The Huffman code of bytes: for each byte its bits and the nodes where they are decided."""

    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray


class Mixer(NamedTuple):
    weights: np.ndarray  # (PLACES * SEEN * 2, INPUTS)
    refined: np.ndarray  # (255 nodes, BUCKETS): log odds
    size: np.ndarray  # of the steps that the weights have made


def huffman(counts: np.ndarray) -> Tree:
    heap = [(int(n) + 1, symbol, symbol) for symbol, n in enumerate(counts)]
    heapq.heapify(heap)
    parents: dict[int, tuple[int, int]] = {}
    fresh = 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parents[a[2]], parents[b[2]] = (fresh, 0), (fresh, 1)
        heapq.heappush(heap, (a[0] + b[0], fresh, fresh))
        fresh += 1
    codes = []
    for symbol in range(256):
        path, at = [], symbol
        while at in parents:
            at, bit = parents[at]
            path.append((at - 256, bit))
        codes.append(path[::-1])
    deepest = max(map(len, codes))
    node, bit = np.zeros((256, deepest), np.int64), np.zeros((256, deepest), np.int8)
    for symbol, path in enumerate(codes):
        node[symbol, : len(path)] = [n for n, _ in path]
        bit[symbol, : len(path)] = [b for _, b in path]
    return Tree(np.array([len(c) for c in codes]), node, bit)


class Bits(NamedTuple):
    word: np.ndarray  # which word each bit belongs to
    value: np.ndarray
    node: np.ndarray
    place: np.ndarray  # of the byte in the word
    slots: np.ndarray  # (ORDERS, bits): places in the tables
    whole: np.ndarray  # hash of the whole word so far and of the node


def bits_of(words: list[bytes], tree: Tree) -> Bits:
    """All bits of some words with their contexts; every word ends with a blank."""
    data = np.frombuffer(b" ".join([*words, b""]), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    start = np.repeat(ends - sizes, sizes)
    place = np.arange(len(data)) - start
    powers = np.full(int(sizes.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64)
    powers = np.multiply.accumulate(powers)
    value = data.astype(np.uint64) + np.uint64(1)
    rolled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * powers[place], dtype=np.uint64)])
    contexts = []
    recent = np.zeros(len(data), np.uint64)
    for back in range(1, ORDERS + 1):
        earlier = np.zeros(len(data), np.uint64)
        earlier[back:] = value[:-back]
        earlier[place < back] = 0
        recent = recent + earlier * np.uint64((0xC2B2AE3D27D4EB4F * (2 * back + 1)) & (2**64 - 1))
        contexts.append(recent)

    length = tree.length[data]
    at = np.repeat(np.arange(len(data)), length)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    node, bit = tree.node[data[at], depth], tree.bit[data[at], depth]
    mixed = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)

    def hashed(context: np.ndarray) -> np.ndarray:
        h = context[at] ^ mixed
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
        return (h ^ (h >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)

    slots = np.empty((ORDERS, len(at)), np.int64)
    for j, context in enumerate(contexts):
        slots[j] = (hashed(context) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) + (j << SLOT_BITS)
    whole = hashed(rolled[:-1] - rolled[start])
    return Bits(np.repeat(np.arange(len(words)), sizes)[at], bit, node, place[at], slots, whole)


def whole_counts(bits: Bits, counts: np.ndarray) -> np.ndarray:
    """``(bits, 2)``: how often each whole beginning was followed by 0 and 1, among these words.

    The words must include all that share their first ``ORDERS`` bytes. Earlier places have none, as
    the tables know the whole word there.
    """
    late = np.flatnonzero(bits.place >= ORDERS)
    found = np.zeros((len(bits.place), 2), np.float32)
    _, group = np.unique(bits.whole[late], return_inverse=True)
    weight = counts[bits.word[late]].astype(float)
    for value in (0, 1):
        total = np.bincount(group, weight * (bits.value[late] == value), minlength=1)
        found[late, value] = total[group]
    return found


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words (the end is empty) and their counts, in parts of bounded size."""
    for batch in slices(batches, "word", BYTES_AT_ONCE):
        for at in range(0, batch.num_rows, WORDS_AT_ONCE):
            part = batch.slice(at, WORDS_AT_ONCE)
            words = [b"" if w == END else w.encode() for w in part.column("word").to_pylist()]
            yield words, part.column("n").to_numpy(zero_copy_only=False)


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The same in parts that never cut a family of words with the same first bytes."""
    words: list[bytes] = []
    counts: list[np.ndarray] = []
    for part, numbers in _parts(batches):
        words += part
        counts.append(numbers)
        first = words[-1][:ORDERS]
        cut = len(words)
        while cut and words[cut - 1][:ORDERS] == first:
            cut -= 1
        if cut:
            total = np.concatenate(counts)
            yield words[:cut], total[:cut]
            words, counts = words[cut:], [total[cut:]]
    if words:
        yield words, np.concatenate(counts)


def by_family(words: DataFrame, parts: int | None = None) -> DataFrame:
    """The words in tasks that have all words with the same first bytes, side by side; in so many ``parts``."""
    family = F.substring(F.col("word").cast("binary"), 1, ORDERS)
    dealt = words.select("word", "n", family.alias("f"))
    dealt = dealt.repartition(parts, "f") if parts else dealt.repartition("f")
    return dealt.sortWithinPartitions("f", "word").select("word", "n")


# ---------------------------------------------------------------- counting


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of ``(text, learned)``: how often each occurs in learned texts.

    Words of other texts only have the count 0. Each task adds up words before it hands them on.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def emit(counts: Counter, others: set[bytes]) -> Iterator[pa.RecordBatch]:
        rows = [(w.decode(), n) for w, n in counts.items()]
        rows += [(w.decode(), 0) for w in others if w not in counts]
        for at in range(0, len(rows), 50_000):
            words, numbers = zip(*rows[at : at + 50_000])
            yield record(schema, word=list(words), n=list(numbers))
        counts.clear()
        others.clear()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        others: set[bytes] = set()
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary())
            for text, learned in zip(texts, batch.column("learned").to_pylist()):
                words = text.as_py().lower().split()
                if learned:
                    counts.update(words)
                    counts[END.encode()] += 1
                else:
                    others.update(words)
                    others.add(END.encode())
            if len(counts) + len(others) > DISTINCT:
                yield from emit(counts, others)
        yield from emit(counts, others)

    found = in_arrow(docs.select("text", "learned"), work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def code_tree(words: DataFrame) -> Tree:
    """The Huffman tree of the bytes of all distinct training words: 256 counts."""
    schema = pa.schema([("symbol", pa.int32()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for part, _ in _parts(batches):
            total += np.bincount(np.frombuffer(b" ".join([*part, b""]), np.uint8), minlength=256)
        yield record(schema, symbol=list(range(256)), n=total)

    found = in_arrow(words.where("n > 0"), work, "symbol int, n long")
    counts = np.zeros(256, np.int64)
    for row in found.groupBy("symbol").agg(F.sum("n").alias("n")).collect():
        counts[row["symbol"]] = row["n"]
    return huffman(counts)


def bit_counts(words: DataFrame, tree: Tree) -> np.ndarray:
    """``(ORDERS << SLOT_BITS, 2)``: how often each slot was followed by 0 and by 1.

    Each task adds up its words and hands on what it met, in blocks of slots; blocks are added up
    where they meet. What comes to the driver has the size of the model.
    """
    pair = np.dtype([("slot", "<u2"), ("zero", "<f4"), ("one", "<f4")])
    sent = pa.schema([("block", pa.int32()), ("data", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ORDERS << SLOT_BITS << 1, np.float32)
        for part, counts in _parts(batches):
            bits = bits_of(part, tree)
            weight = counts[bits.word].astype(np.float32)
            for slots in bits.slots:
                np.add.at(total, slots * 2 + bits.value, weight)
        total = total.reshape(-1, 2)
        met = np.flatnonzero(total.any(axis=1))
        rows = np.empty(len(met), pair)
        rows["slot"], rows["zero"], rows["one"] = met % BLOCK, total[met, 0], total[met, 1]
        blocks, starts = np.unique(met // BLOCK, return_index=True)
        for at in range(0, len(blocks), 512):
            ends = [*starts[at + 1 : at + 513], len(met)][: len(blocks[at : at + 512])]
            data = [rows[a:b].tobytes() for a, b in zip(starts[at : at + 512], ends)]
            yield record(sent, block=blocks[at : at + 512].astype(np.int32), data=data)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                rows = np.frombuffer(data.as_py(), pair)
                total = held.setdefault(block, np.zeros((BLOCK, 2)))
                total[rows["slot"], 0] += rows["zero"]
                total[rows["slot"], 1] += rows["one"]
        for block, total in held.items():
            scale = np.minimum(1.0, 60_000 / np.maximum(1.0, total.max(axis=1, keepdims=True)))
            yield record(sent, block=[block], data=[(total * scale).astype("<f2").tobytes()])

    partial = in_arrow(words.where("n > 0").select("word", "n"), work, "block int, data binary")
    merged = in_arrow(partial.repartition("block"), add, "block int, data binary")
    table = np.zeros((ORDERS << SLOT_BITS, 2), np.float16)
    for row in merged.toLocalIterator():
        table[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["data"], "<f2").reshape(-1, 2)
    return table


# ---------------------------------------------------------------- mixing


def _gate(place: np.ndarray, seen: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """The weight set: by place in the word, by how often the longest context was seen, and by
    whether only one of the two bits has followed it."""
    often = np.minimum(np.log2(1 + seen).astype(np.int64), SEEN - 1)
    return (np.minimum(place, PLACES - 1) * SEEN + often) * 2 + sure


def _refine(refined: np.ndarray, node: np.ndarray, logit: np.ndarray) -> tuple[np.ndarray, ...]:
    """The map's two entries around a logit, the share of the upper one, and the corrected logit."""
    at = (np.clip(logit, -7.99, 7.99) + 8) * (BUCKETS - 1) / 16
    low = at.astype(np.int64)
    upper = (at - low).astype(np.float32)
    first = node * BUCKETS + low
    flat = refined.reshape(-1)
    corrected = flat[first] * (1 - upper) + flat[first + 1] * upper
    return first, upper, (logit + corrected) / 2


def new_mixer() -> Mixer:
    weights = np.full((PLACES * SEEN * 2, INPUTS), 0.1, np.float32)
    weights[:, -2:] = 0.6
    grid = np.linspace(-8, 8, BUCKETS, dtype=np.float32)
    return Mixer(weights, np.tile(grid, (255, 1)), np.full_like(weights, 1e-2))


def _odds(counts: np.ndarray) -> np.ndarray:
    return np.log((counts[..., 1] + DELTA) / (counts[..., 0] + DELTA))


class Examples(NamedTuple):
    """The bits of training words, each taken out of its own counts."""

    word: np.ndarray
    node: np.ndarray
    one: np.ndarray
    inputs: np.ndarray  # (bits, INPUTS)
    gate: np.ndarray


def examples(words: list[bytes], counts: np.ndarray, table: np.ndarray, tree: Tree) -> Examples:
    """Of whole families; ``table`` has 32-bit floats."""
    bits = bits_of(words, tree)
    pairs = table.view(np.uint64).reshape(-1)  # both counts of a slot at once
    own = np.stack([1 - bits.value, bits.value], axis=1).astype(np.float32)
    inputs = np.empty((len(own), INPUTS), np.float32)
    for j in range(INPUTS):
        found = np.take(pairs, bits.slots[j]).view(np.float32).reshape(-1, 2) if j < ORDERS else whole_counts(bits, counts)
        found = np.maximum(found - own, 0)
        inputs[:, j] = _odds(found)
        longest = found if j < ORDERS else np.where((bits.place < ORDERS)[:, None], longest, found)
    gate = _gate(bits.place, longest[:, 0] + longest[:, 1], np.minimum(longest[:, 0], longest[:, 1]) == 0)
    return Examples(bits.word, bits.node, own[:, 1], inputs, gate)


def steps_of(counts: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word, weight, step)``: the tokens of some words, in random order, in steps of about as many tokens.

    Every token counts once. A word with more than an eighth of the tokens of a step is cut into rows
    with a weight each, which go to different steps mostly, so there are at most eight more rows a step.
    """
    total = int(counts.sum())
    steps = max(-(-len(counts) // STEP_WORDS), min(LEAST_STEPS, -(-total // STEP_WORDS)))
    rows = np.ceil(counts / max(1.0, total / steps / 8)).astype(np.int64)
    word = rng.permutation(np.repeat(np.arange(len(counts)), rows))
    weight = (counts / rows)[word]
    return word, weight, np.minimum((np.cumsum(weight) * steps / total).astype(np.int64), steps - 1)


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def learn(mixer: Mixer, found: Examples, counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Online steps on all tokens of some words; returns the curvature of each weight set at their end."""
    size = np.bincount(found.word, minlength=len(counts))
    start = np.cumsum(size) - size
    word, weight, step = steps_of(counts, rng)
    sets = len(mixer.weights)
    for rows in np.split(np.arange(len(word)), np.flatnonzero(np.diff(step)) + 1):
        length = size[word[rows]]
        ends = np.cumsum(length)
        at = np.repeat(start[word[rows]] - ends + length, length) + np.arange(ends[-1])
        x, g = found.inputs[at], found.gate[at]
        logit = (mixer.weights[g] * x).sum(axis=1)
        wrong = np.repeat(weight[rows], length) * (found.one[at] - _chance(logit))
        change = np.stack([np.bincount(g, wrong * x[:, j], sets) for j in range(INPUTS)], axis=1)
        mixer.size[:] += change * change
        mixer.weights[:] += RATE * change / np.sqrt(mixer.size)
    p = _chance((mixer.weights[found.gate] * found.inputs).sum(axis=1))
    sure = counts[found.word] * p * (1 - p)
    curve = np.empty((sets, INPUTS, INPUTS))
    for i in range(INPUTS):
        for j in range(i, INPUTS):
            curve[:, i, j] = np.bincount(found.gate, sure * found.inputs[:, i] * found.inputs[:, j], sets)
            curve[:, j, i] = curve[:, i, j]
    return curve


def averaged(curve: np.ndarray, bent: np.ndarray) -> Mixer:
    """The mixer at the minimum of the summed parabolas of all shards.

    ``curve`` is the sum of their curvatures, ``bent`` that of curvature times weights. A set that no
    shard has met keeps its first weights.
    """
    mixer = new_mixer()
    own = RIDGE * np.eye(INPUTS)
    mixer.weights[:] = np.linalg.solve(curve + own, (bent + RIDGE * mixer.weights)[..., None])[..., 0]
    return mixer


def map_counts(mixer: Mixer, found: Examples, counts: np.ndarray) -> np.ndarray:
    """``(2, 255 * BUCKETS)``: the bits 0 and 1 at each entry of the map, shared by the two around a logit."""
    first, upper, _ = _refine(mixer.refined, found.node, (mixer.weights[found.gate] * found.inputs).sum(axis=1))
    total = np.empty((2, mixer.refined.size))
    for value in (0, 1):
        share = counts[found.word] * (found.one == value)
        total[value] = np.bincount(first, share * (1 - upper), mixer.refined.size)
        total[value] += np.bincount(first + 1, share * upper, mixer.refined.size)
    return total


def mapped(mixer: Mixer, total: np.ndarray) -> Mixer:
    """The mixer with the log odds of all bits in its map, with ``PRIOR`` bits of an entry's own logit."""
    own = _chance(mixer.refined.reshape(-1).astype(float))
    odds = np.log((total[1] + PRIOR * own) / (total[0] + PRIOR * (1 - own)))
    return mixer._replace(refined=np.clip(odds, -12, 12).astype(np.float32).reshape(mixer.refined.shape))


def word_scores(
    words: list[bytes], counts: np.ndarray, table: np.ndarray, odds: np.ndarray, tree: Tree, mixer: Mixer
) -> np.ndarray:
    """log10 probability of each word of whole families; ``odds`` are those of ``table``."""
    bits = bits_of(words, tree)
    whole = whole_counts(bits, counts)
    longest = np.where((bits.place < ORDERS)[:, None], table[bits.slots[-1]], whole)
    gate = _gate(bits.place, longest.sum(axis=1), longest.min(axis=1) == 0)
    logit = mixer.weights[gate, ORDERS] * _odds(whole)
    for j, slots in enumerate(bits.slots):
        logit += mixer.weights[gate, j] * odds[slots]
    _, _, logit = _refine(mixer.refined, bits.node, logit)
    sign = np.where(bits.value == 1, -logit, logit).astype(np.float64)
    return np.bincount(bits.word, -np.logaddexp(0, sign), len(words)) / np.log(10)


class Model(NamedTuple):
    tree: Tree
    table: np.ndarray
    mixer: Mixer
    tokens: int  # N
    distinct: int  # V


def summed(parts: DataFrame) -> np.ndarray | None:
    """The sum of arrays of doubles of one size, one in each row ``data``; none of no rows."""
    schema = pa.schema([("data", pa.binary())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in batch.column("data").to_pylist())  # rounded alike
        if rows:
            yield record(schema, data=[sum(map(np.frombuffer, rows)).tobytes()])

    found = in_arrow(parts.repartition(1), add, "data binary").first()
    return None if found is None else np.frombuffer(found["data"])


def fit(words: DataFrame, shard_words: int = SHARD_WORDS) -> Model:
    """A model of a staged ``(word, n)`` table, learned from every row with ``n`` > 0.

    The shards depend on the words and their number alone, not on the layout. What a shard hands on
    has the size of the mixer or the map.
    """
    totals = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("v")
    ).first()
    tree = code_tree(words)
    counted = bit_counts(words, tree)
    shared = words.sparkSession.sparkContext.broadcast(counted)
    schema = pa.schema([("data", pa.binary())])
    dealt = by_family(words.where("n > 0"), min(MOST_SHARDS, totals["v"] // shard_words + 1))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, rng, curve = new_mixer(), np.random.default_rng(1), None
        table = shared.value.astype(np.float32)
        for part, counts in _families(batches):
            found = learn(mixer, examples(part, counts, table, tree), counts, rng)
            curve = found if curve is None else curve + found
        if curve is not None:
            bent = (curve @ mixer.weights[..., None].astype(float))[..., 0]
            yield record(schema, data=[np.concatenate([curve.reshape(-1), bent.reshape(-1)]).tobytes()])

    mixer = new_mixer()
    found = summed(in_arrow(dealt, train, "data binary"))
    if found is not None:
        cut = mixer.weights.size * INPUTS
        mixer = averaged(found[:cut].reshape(-1, INPUTS, INPUTS), found[cut:].reshape(-1, INPUTS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, mixer.refined.size))
        table = shared.value.astype(np.float32)
        for part, counts in _families(batches):
            total += map_counts(mixer, examples(part, counts, table, tree), counts)
        if total.any():
            yield record(schema, data=[total.tobytes()])

    found = summed(in_arrow(dealt, place, "data binary"))
    if found is not None:
        mixer = mapped(mixer, found.reshape(2, -1))
    return Model(tree, counted, mixer, int(totals["n"]), int(totals["v"]))


def score_words(words: DataFrame, model: Model) -> DataFrame:
    """``(word, n, score)``: the log10 probability of every distinct word."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("score", pa.float64())])
    shared = words.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, table, mixer = shared.value[:3]
        table = table.astype(np.float32)
        odds = _odds(table)
        for part, counts in _families(batches):
            found = word_scores(part, counts, table, odds, tree, mixer)
            yield record(schema, word=[w.decode() or END for w in part], n=counts, score=found)

    return in_arrow(by_family(words), work, "word string, n long, score double")


# ---------------------------------------------------------------- documents


def in_document(tokens: list[bytes], places: list[int], known: list[float]) -> float:
    """log10 probability of the tokens, but for the model's probability of rare words.

    ``places`` are those of the frequent words in ``known``, their probabilities; -1 for rare words.
    A word comes from the model or, with the share ``r``, from the words before it. A rare word that
    was there before comes from them alone; at its first place the model's probability is a factor
    that is left out here. The share follows the evidence of each word that has passed.
    """
    seen: dict[bytes, int] = {}
    r, chances = 0.1, []
    for i, (word, place) in enumerate(zip(tokens, places)):
        times = seen.get(word, 0)
        if times:
            again = r * times / i
            other = (1 - r) * (known[place] if place >= 0 else RARE)
            total = again + other
            chances.append(total if place >= 0 else again)
            r += ADAPT * (again / total - r)
        else:
            chances.append((1 - r) * known[place] if place >= 0 else 1 - r)
            r -= ADAPT * r
        seen[word] = times + 1
    return float(np.log10(np.array(chances)).sum())


def frequent(scored: DataFrame, most: int = HEAD) -> DataFrame:
    """The most frequent words that are not too long: whole classes of frequency, ``most`` words at most."""
    known = scored.where((F.octet_length("word") <= HEAD_BYTES) & (F.col("n") > 0))
    known = known.withColumn("class", F.floor(F.log2("n") * 16))
    left, bar = most, None
    for row in known.groupBy("class").count().orderBy(F.desc("class")).collect():  # 16 for each doubling
        left -= row["count"]
        if left < 0:
            break
        bar = row["class"]
    return known.where(F.col("class") >= F.lit(bar))


def score_documents(
    docs: DataFrame, learned: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score)`` of every whole text.

    ``learned`` (of ``doc_id``) marks the rows to learn from. A null or empty text is an end alone.
    Rows that share an id are each scored. Without rows to learn from every bit has probability 1/2.
    An empty table gives an empty result.

    The scores of the ``HEAD`` most frequent words, which hold most of the text and all hot keys, go
    to all tasks; other words are joined, once for each document that has them.
    """
    rows = plain(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.coalesce(learned, F.lit(False)).alias("learned"),
    )
    words = stage(count_words(rows), "words")
    model = fit(words)
    scored = stage(score_words(words, model), "scores")
    spark = docs.sparkSession
    head = frequent(scored).collect()
    shared = spark.sparkContext.broadcast((
        {r["word"].encode(): i for i, r in enumerate(head)},
        np.log10(np.array([r["n"] for r in head], float) + 1),
        [max(10.0 ** r["score"], 1e-300) for r in head],
        np.array([r["n"] > 0 for r in head], bool),
    ))
    fields = [("row", pa.int64()), ("doc_id", pa.int64()), ("word", pa.string()), ("times", pa.int64()),
              ("bytes", pa.int64()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
              ("score_here", pa.float64())]
    schema = pa.schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base, chance, known = shared.value
        for batch in slices(batches, "text", 2_000_000):
            out: dict[str, list] = {name: [] for name, _ in fields}
            texts = batch.column("text").cast(pa.binary())
            for row, doc, text in zip(
                batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), texts
            ):
                data = text.as_py()
                tokens = data.lower().split()
                tokens.append(END.encode())
                at = np.fromiter(map(index.get, tokens, repeat(-1)), np.int64, len(tokens))
                rare = Counter(tokens[i] for i in np.flatnonzero(at < 0))
                score = in_document(tokens, at.tolist(), chance)
                at = at[at >= 0]
                # the sums of the frequent words, under a key of their own that no word can have
                names = [f"{END}{row}", *(w.decode() for w in rare)]
                more = len(rare)
                out["row"] += [row] * (more + 1)
                out["doc_id"] += [doc] * (more + 1)
                out["word"] += names
                out["times"] += [0, *rare.values()]
                out["bytes"] += [len(data)] + [0] * more
                out["tokens"] += [len(tokens)] + [0] * more
                out["known"] += [int(known[at].sum())] + [0] * more
                out["base"] += [float(base[at].sum())] + [0.0] * more
                out["score_here"] += [score] + [0.0] * more
            yield record(schema, **out)

    found = in_arrow(
        rows.select("row", "doc_id", "text"), work,
        "row long, doc_id long, word string, times long, bytes long, tokens long, known long,"
        " base double, score_here double",
    )
    joined = found.join(scored, "word", "left")
    times = F.col("times")
    total = model.tokens + model.distinct + 1
    return (
        joined.groupBy("row", "doc_id")
        .agg(
            F.sum("bytes").alias("n_bytes"),
            F.sum("tokens").alias("n_tokens"),
            F.sum(F.col("known") + F.when(F.col("n") > 0, times).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + times * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("base"),
            F.sum(F.col("score_here") + F.coalesce("score", F.lit(0.0))).alias("score"),
        )
        .select(
            "doc_id", "n_bytes", "n_tokens", "n_known",
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(total)))).alias("base_score"),
            "score",
        )
    )
