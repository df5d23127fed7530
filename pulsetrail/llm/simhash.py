"""SimHash near-dedup with BK-trees.

Fingerprints that differ in few bits agree in whole blocks of bits, so all fingerprints that share
the bits of some blocks form a shard, and every near pair meets in at least one shard. Each shard has
a BK-tree of bounded size, whose children are keyed by their Hamming distance to the parent; the tree
goes with the queries of its shard to one task (a shard that is too large has several trees, and each
goes to all queries of the shard), and a query follows only the edges within the radius. A task
returns a spanning forest of the pairs that it finds, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations, pairwise
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_digest

from pulsetrail.llm.common import (
    MAP_BITS,
    bit_blocks,
    bitmap_of,
    has_bit,
    in_arrow,
    may_have,
    merged_bitmap,
    plain,
    record,
    slices,
)
from pulsetrail.operators.graph import connected_components
from pulsetrail.session import discard, stage

BITS = 64
SEED = 42
BLOCKS = 6
TREE = 1024  # fingerprints of one tree, on average, in shards with more than that
ROWS = 1 << 16  # shingles whose bits are counted at once
PAIRS = 1 << 19  # pairs of query and node that are looked at together

# of near_pairs, which looks for a similarity of the shingles rather than for a number of bits
WIDE = 128
WIDE_RADIUS = 32
SIMILAR = 0.8
SHINGLE = 5
APART = 20  # bits of 128 that the fingerprints of a similar pair differ in, on average at the bar
MISSED = 0.002  # of the pairs at that distance, the share that no band brings together
SHARD = 16  # fingerprints of a shard on average: bands get wider with the number of documents
CELLS = 256  # of a sketch; each keeps the least hash that falls into it
DOUBT = 0.15  # a pair is refuted by its sketches if they show so much less than the bar: 6 deviations
FAMILY = 1024  # documents of a part of a family; a task holds two parts
SHINGLED = 1 << 22  # shingles of a part of a family, on average
TRIED = 256  # documents whose shingles are compared with those of one at a time
FEW = 64  # shingles of a document whose pairs are always verified


def shingles(text: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` words joined by one space; all words if there are fewer; none without words.

    ASCII is lower-cased, words are split at blanks.
    """
    words = text.lower().split()
    line = b" ".join(words)
    if len(words) <= size:
        return [line] if words else []
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    return [line[a:b] for a, b in zip(starts, ends[size - 1 :])]


def fingerprint(text: bytes, shingle: int) -> bytes:
    """64 bits, most significant first, of the shingles of a text; repeated shingles count as often."""
    return print_of(shingles(text, shingle), BITS)


def print_of(pieces: Iterable[bytes], bits: int) -> bytes:
    """``bits`` (64 or 128) bits, most significant first; set where over half the hashes have it.

    No pieces have the fingerprint zero.
    """
    digest = xxh64_digest if bits == BITS else xxh3_128_digest
    return _majority(np.frombuffer(b"".join([digest(s, SEED) for s in pieces]), np.uint8), bits)


def _majority(hashes: np.ndarray, bits: int) -> bytes:
    table = hashes.reshape(-1, bits // 8)
    ones = np.zeros(bits, np.int64)
    for at in range(0, len(table), ROWS):
        ones += np.unpackbits(table[at : at + ROWS], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(table)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"):
    """``(row, doc_id, fp)`` of every text; ``fp`` is the fingerprint as a signed number."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary())
            fps = b"".join(fingerprint(t.as_py(), shingle) for t in texts)
            fps = np.frombuffer(fps, ">i8").astype(np.int64)
            yield record(schema, row=batch.column("row"), doc_id=batch.column("doc_id"), fp=fps)

    rows = plain(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return in_arrow(rows, work, "row long, doc_id long, fp long")


def shard_keys(fp: Column, radius: int, blocks: int = BLOCKS) -> Column:
    """The shards of a fingerprint: one for each choice of ``blocks - radius`` blocks of its bits.

    A pair that differs in at most ``radius`` bits agrees in one choice at least.
    """
    if not radius < blocks:
        raise ValueError("there must be more blocks than bits that may differ")
    edges = [BITS * b // blocks for b in range(blocks + 1)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(n).cast("long")
        for b in chosen:
            width = edges[b + 1] - edges[b]
            part = F.shiftrightunsigned(fp, edges[b]).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


def apart(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of ``fps``, which has 64 bits in each column."""
    return np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1, dtype=np.int64)


def grow_trees(fps: np.ndarray, tree: np.ndarray, planted: np.ndarray) -> tuple[np.ndarray, ...]:
    """All BK-trees of a batch at once: ``(root of each row, edge keys, child of each edge)``.

    ``tree`` numbers the tree of each row in ascending order; rows with ``planted`` false are no nodes.
    The first row of a tree must be a node; it is the root. An edge key is node * 256 + distance.
    """
    first = np.ones(len(tree), bool)
    first[1:] = tree[1:] != tree[:-1]
    roots = np.flatnonzero(first)[np.cumsum(first) - 1]
    moving = np.flatnonzero(planted & ~first)
    at = roots[moving]
    keys, children = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while moving.size:
        key = at * 256 + apart(fps, moving, at)
        edge, earliest, which = np.unique(key, return_index=True, return_inverse=True)
        keys.append(edge)
        children.append(moving[earliest])
        settled = np.zeros(len(moving), bool)
        settled[earliest] = True
        at = moving[earliest][which][~settled]
        moving = moving[~settled]
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return roots, key[order], child[order]


def search(
    fps: np.ndarray, trees: tuple[np.ndarray, ...], queries: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(query, node, distance)`` of earlier nodes within the radius, following only edges within it."""
    roots, keys, children = trees
    query, node = queries, roots[queries]
    while query.size:
        distance = apart(fps, query, node)
        near = (distance <= radius) & (node < query)
        yield query[near], node[near], distance[near]
        low = np.searchsorted(keys, node * 256 + np.maximum(distance - radius, 0))
        high = np.searchsorted(keys, node * 256 + distance + radius, "right")
        count = high - low
        query = np.repeat(query, count)
        edge = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        node = children[edge]
        earlier = node < query
        query, node = query[earlier], node[earlier]


def join_groups(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the groups of each pair in ``label``, in place; a label is the least row of its group."""
    while a.size:
        a, b = label[a], label[b]
        different = a != b
        a, b = a[different], b[different]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


Found = tuple[np.ndarray, np.ndarray, np.ndarray]  # rows, their partners, and the distances


def spanning(found: Iterator[Found], ids: np.ndarray, more: list[np.ndarray]) -> Found:
    """Pairs that connect just the rows that all found pairs connect: fewer than there are rows."""
    label = np.arange(len(ids))
    for a, b, _ in found:
        join_groups(label, a, b)
    linked = np.flatnonzero(label != np.arange(len(ids)))
    return linked, label[linked], np.zeros(len(linked), np.int64)


def families(similar: float):
    """A ``reduce`` like ``spanning`` of the pairs whose numbers of shingles do not rule out ``similar``."""

    def reduce(found: Iterator[Found], ids: np.ndarray, more: list[np.ndarray]) -> Found:
        (size,) = more

        def fitting() -> Iterator[Found]:
            for a, b, distance in found:
                fits = np.minimum(size[a], size[b]) >= similar * np.maximum(size[a], size[b])
                yield a[fits], b[fits], distance[fits]

        return spanning(fitting(), ids, [])

    return reduce


def search_shards(columns: list[np.ndarray], radius: int, reduce, wide: int, owned=None) -> Found:
    """What ``reduce`` keeps of the near pairs within each run of equal ``(shard, lo, hi)``.

    ``wide`` columns are the fingerprint; the others tell ``reduce`` more. Rows that do not ask are
    nodes of the trees and no queries. ``owned`` tells which pairs count in a shard.
    """
    shard, lo, hi, side, ids, asks, *others = columns
    words, more = others[:wide], others[wide:]
    new = np.ones(len(shard), bool)
    new[1:] = (shard[1:] != shard[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    run = np.cumsum(new) - 1
    size = np.bincount(run)
    rooted = side[np.flatnonzero(new)] == 0  # a run without tree rows has nothing to search
    asked = np.bincount(run, weights=asks) > 0
    rows = np.flatnonzero((size[run] > 1) & rooted[run] & asked[run])
    if not len(rows):
        return rows, rows, rows
    run, side, crossing, asks = run[rows], side[rows], (lo != hi)[rows], asks[rows].astype(bool)
    fps = np.column_stack([w[rows].view(np.uint64) for w in words])
    trees = grow_trees(fps, run, side == 0)
    queries = np.flatnonzero((~crossing | (side == 1)) & asks)
    if not len(queries):
        return queries, queries, queries
    work = np.cumsum(size[run[queries]])
    cuts = [0, *np.searchsorted(work, np.arange(PAIRS, work[-1], PAIRS)), len(queries)]
    found = (f for a, b in pairwise(cuts) for f in search(fps, trees, queries[a:b], radius))
    if owned is not None:
        found = (tuple(c[owned(shard[rows], fps, f[0], f[1])] for c in f) for f in found)
    a, b, distance = reduce(found, ids[rows], [m[rows] for m in more])
    return rows[a], rows[b], distance


def crowded(rows: DataFrame, tree: int = TREE) -> DataFrame:
    """``(shard, parts)`` of the shards of more than ``tree`` rows: the number of their trees."""
    large = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > tree)
    return large.select("shard", F.ceil(F.col("n") / tree).cast("int").alias("parts"))


def shard_pairs(
    rows: DataFrame,
    large: DataFrame,
    words: list[str],
    radius: int,
    reduce,
    more: list[str] | None = None,
    owned=None,
) -> DataFrame:
    """``(shard, a, b, distance)`` of the pairs of ids that ``reduce`` keeps in each shard; ``a`` has asked.

    ``rows`` has ``shard``, ``id``, ``asks`` (1 or 0), the 64-bit ``words`` of a fingerprint and the
    columns ``more`` for ``reduce``. Shards that are ``crowded`` are dealt out to as many trees as they
    need; every query of such a shard visits all of its trees, in tasks of one tree and one part of
    the queries. Which of two rows asks for the other depends on their ids and the shard alone.
    ``owned(shard, fps, a, b)``, if given, tells which pairs of rows count in their shard.
    """
    columns = ["id", "asks", *words, *(more or [])]
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(large, "shard", "left").select(
        "shard", *columns,
        F.pmod(F.xxhash64("id", "shard"), parts).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"),
    )
    meeting = dealt.select(
        "shard",
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        *columns,
    )
    key = ["shard", "lo", "hi"]
    placed = meeting.repartition(*key).sortWithinPartitions(*key, "side", "id")
    schema = pa.schema([("shard", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("distance", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def made(columns: list[np.ndarray]) -> pa.RecordBatch:
            a, b, distance = search_shards(columns, radius, reduce, len(words), owned)
            return record(schema, shard=columns[0][a], a=columns[4][a], b=columns[4][b], distance=distance)

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            last = np.ones(len(columns[0]), bool)
            for c in columns[:3]:
                last &= c == c[-1]
            cut = int(np.argmax(last))  # the last run may go on in the next batch
            held = [c[cut:] for c in columns]
            if cut:
                yield made([c[:cut] for c in columns])
        if held:
            yield made(held)

    return in_arrow(placed, work, "shard long, a long, b long, distance long")


def near_links(distinct: DataFrame, radius: int, blocks: int = BLOCKS, tree: int = TREE) -> DataFrame:
    """``(src, dst)``: links between fingerprints that connect just what near pairs connect.

    ``distinct`` has each ``fp`` once.
    """
    rows = distinct.select(
        F.explode(shard_keys(F.col("fp"), radius, blocks)).alias("shard"),
        F.col("fp").alias("id"), F.lit(1).alias("asks"), "fp",
    )
    pairs = shard_pairs(rows, crowded(rows, tree), ["fp"], radius, spanning)
    return pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()


def near_classes(prints: DataFrame, radius: int = 4, blocks: int = BLOCKS) -> DataFrame:
    """``prints`` with ``component_id``: the smallest id of the documents that links can reach.

    ``prints`` has ``doc_id`` and ``fp`` and is read twice: stage it. Equal fingerprints are one
    vertex, so copies of any number are no links. Rows without an id take part; a component in which
    no row has an id has the component null.
    """
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    links = near_links(distinct, radius, blocks)
    labels = connected_components(None, links).withColumnRenamed("id", "fp")
    group = F.coalesce("component", "fp").alias("group")
    grouped = distinct.join(labels, "fp", "left").select("fp", "first", group)
    firsts = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    known = grouped.select("fp", "group").join(firsts, "group").select("fp", "component_id")
    return prints.join(known, "fp")


def near_documents(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every document; ``fingerprint`` in 16 hex digits.

    A null or empty text has the fingerprint zero and is linked like any other. Every row is
    reported, also rows that share an id. An empty table gives an empty result.
    """
    prints = stage(fingerprints(docs, shingle, id_col, text_col), "prints")
    return near_classes(prints, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---------------------------------------------------------------- near by similarity of shingles


def _id_of() -> Column:
    """An id for every document: its own, or a negative one from the hash of its text."""
    made = F.xxhash64("text").bitwiseOR(F.lit(-(1 << 63)))
    return F.coalesce("doc_id", made)


def bands(documents: int) -> tuple[np.ndarray, int]:
    """The bits of each band, and how many there are in one.

    A band has so many bits that about ``SHARD`` documents share those of one by chance; there are so
    many bands that all but ``MISSED`` of the pairs ``APART`` bits apart agree in one.
    """
    width = min(24, max(8, (documents // SHARD).bit_length()))
    agree = comb(WIDE - APART, width) / comb(WIDE, width)
    each = WIDE // width
    deals = -(-ceil(log(MISSED) / log1p(-agree)) // each)
    rng = np.random.default_rng(SEED)
    rows = [rng.permutation(WIDE)[: each * width].reshape(each, width) for _ in range(deals)]
    return np.concatenate(rows), width


def first_shared(chosen: np.ndarray, width: int):
    """An ``owned`` for shards of bands: a pair counts in the first band whose bits agree, and in no other."""
    words = np.zeros((len(chosen), WIDE // BITS), np.uint64)
    for band, bits in enumerate(chosen.tolist()):
        for bit in bits:
            words[band, bit // BITS] |= np.uint64(1 << BITS - 1 - bit % BITS)

    def owned(shard: np.ndarray, fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        own, kept = shard[a] >> width, np.ones(len(a), bool)
        left = np.arange(len(a))
        for band in range(own.max(initial=0)):
            left = left[own[left] > band]
            differ = ((fps[a[left]] ^ fps[b[left]]) & words[band]).any(axis=1)
            kept[left[~differ]] = False
            left = left[differ]
        return kept

    return owned


def sketch_of(hashes: np.ndarray) -> bytes:
    """The least hash of each of ``CELLS`` cells, its last byte; the high bytes choose the cell.

    Two sketches agree in about as large a share of the cells in use as the sets are similar. A cell
    of no hash is 0, any other is at least 1.
    """
    out = np.zeros(CELLS, np.uint8)
    ordered = np.sort(hashes)
    cell = (ordered >> np.uint64(56)).astype(np.int64)
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    out[cell[new]] = (ordered[new] % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out.tobytes()


def wide_prints(docs: DataFrame, dealt: tuple[np.ndarray, int] | None = None) -> DataFrame:
    """``(id, high, low, size, keys)`` of ``(id, text)``.

    128 bits, the number of distinct shingles, and the shard of each band of the
    bits (``dealt``, or those for as many documents). Each distinct shingle counts once, as in the similarity that is verified.
    """
    schema = pa.schema([("id", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("size", pa.int64()),
                        ("keys", pa.list_(pa.int64()))])
    chosen, width = dealt or bands(docs.count())
    powers = 1 << np.arange(width, dtype=np.int64)
    count = len(chosen)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, made = [], []
            for text in batch.column("text").cast(pa.binary()):
                digests = b"".join([xxh3_128_digest(s, SEED) for s in set(shingles(text.as_py(), SHINGLE))])
                hashes = np.frombuffer(digests, np.uint8)
                sizes.append(len(hashes) // 16)
                made.append(_majority(hashes, WIDE))
            data = np.frombuffer(b"".join(made), np.uint8)
            bits = np.unpackbits(data.reshape(-1, WIDE // 8), axis=1)
            keys = bits[:, chosen].astype(np.int64) @ powers + (np.arange(count) << width)
            words = data.view(">i8").reshape(-1, 2).astype(np.int64)
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * count)
            lists = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))
            yield record(
                schema, id=batch.column("id"), high=words[:, 0], low=words[:, 1], size=sizes, keys=lists,
            )

    made = "id long, high long, low long, size long, keys array<long>"
    return in_arrow(docs.select("id", "text"), work, made)


def near_pairs(docs: DataFrame, similar: float = SIMILAR, tree: int = TREE) -> DataFrame:
    """``(src, dst)``: links of documents of ``(id, text)`` whose sets of shingles are at least ``similar``.

    Fingerprints of 128 bits meet in shards of equal bands; BK-trees find the candidates, and a shard
    gives a spanning forest of them. What candidates connect is a family, so every candidate has both
    ends in one. The documents of a family meet in blocks (``_linked``), where sketches refute most
    pairs that are not similar and the others are verified on the whole texts; a block returns a
    spanning forest of the similar pairs. So no row is made for a pair, however large a family is,
    and the links connect just what all pairs of a family that are similar enough connect.
    """
    dealt = bands(docs.count())
    owned, words = first_shared(*dealt), ["high", "low"]
    prints = stage(wide_prints(docs, dealt), "wide-prints")
    shard = F.explode("keys").alias("shard")
    large = stage(crowded(prints.select(shard), tree), "crowded")
    rows = prints.select(shard, "id", F.lit(1).alias("asks"), *words, "size")
    pairs = shard_pairs(rows, large, words, WIDE_RADIUS, families(similar), ["size"], owned)
    seen = stage(pairs.where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct(), "seen")
    labels = stage(connected_components(None, seen).withColumnRenamed("component", "family"), "families")
    sizes = stage(prints.select("id", "size").join(labels, "id"), "sizes")
    discard(prints)
    discard(seen)
    return _linked(docs, sizes, similar)


def _in_shards(prints: DataFrame, seen: DataFrame) -> DataFrame:
    """The rows of ``prints`` that have a key among the shards of ``seen``, with no other keys; staged.

    A bitmap of fixed size tells which keys to keep: all that are among the shards, and few others.
    """
    low, fields = (1 << MAP_BITS) - 1, prints.columns

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from bit_blocks(batch.column(0).to_numpy(zero_copy_only=False) & low)

    marked = in_arrow(seen.select("shard").distinct(), mark, "block int, bits binary")
    bitmap = prints.sparkSession.sparkContext.broadcast(merged_bitmap(marked))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False)
                kept = has_bit(bitmap.value, keys & low)
                count = kept.reshape(batch.num_rows, -1).sum(axis=1)
                offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[kept]))
                columns = [lists if c == "keys" else batch.column(c) for c in fields]
                yield pa.RecordBatch.from_arrays(columns, names=fields).filter(pa.array(count > 0))

    live = stage(in_arrow(prints, keep, prints.schema), "live")
    bitmap.destroy()
    return live


def _dealt(docs: DataFrame, sizes: DataFrame, most: int = FAMILY, shingled: int = SHINGLED) -> DataFrame:
    """``(family, lo, hi, side, id, text)``: the documents of the families of ``sizes``, dealt out to blocks.

    ``sizes`` has ``id``, ``size`` and ``family`` and is staged. A family of more than ``most`` documents,
    or ``shingled`` shingles, is cut into parts; a block is two of its parts, or one, which has side 0.
    Texts of other documents are not moved, but for some that a bitmap of fixed size lets through.
    """
    parts = sizes.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("size") / shingled)).cast("int").alias("parts")
    )
    member = sizes.select("id", "family").distinct().join(parts, "family")
    bitmap = bitmap_of(sizes.select("id"))
    met = docs.where(may_have(F.col("id"), bitmap)).select("id", "text").join(member, "id").select(
        "family", "id", "text",
        F.pmod(F.xxhash64("id", "text"), F.col("parts")).cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
    )
    placed = met.select(
        "family",
        F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "id",
        "text",
    )
    return placed.repartition("family", "lo", "hi").sortWithinPartitions("family", "lo", "hi")


def _shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many digests each of some sets has in common with ``one``; all are sorted, or all are empty."""
    if not len(one):
        return np.zeros(len(others), np.int64)
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    starts = np.cumsum([0, *map(len, others[:-1])])
    return np.add.reduceat((one[at] == every).astype(np.int64), starts)


def link_block(
    ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray], similar: float, crossing: bool
) -> list[tuple[int, int]]:
    """Pairs of ids that connect what all similar pairs of a block connect: fewer than it has documents.

    ``sets`` are the sorted digests of the shingles. If ``crossing``, only pairs of different sides count.
    Pairs that are connected already are passed over; a document tries the others by the likeness of
    their sketches. Sketches refute a pair that looks clearly less than ``similar``.
    """
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    ids, side, size, sets = ids[order], side[order], size[order], [sets[k] for k in order]
    sketches = np.frombuffer(b"".join(map(sketch_of, sets)), np.uint8).reshape(-1, CELLS)
    filled = sketches > 0
    end = np.searchsorted(similar * size, size, "right")  # behind the largest that may be similar
    label, links = np.unique(ids, return_inverse=True)[1], []
    for row in range(len(ids)):
        left = np.arange(row + 1, end[row])
        left = left[label[left] != label[row]]
        if crossing:
            left = left[side[left] != side[row]]
        if not len(left):
            continue
        used = (filled[left] | filled[row]).sum(axis=1)
        agree = ((sketches[left] == sketches[row]) & filled[row]).sum(axis=1)
        open_ = (agree >= (similar - DOUBT) * used) | (size[row] < FEW)
        likeness = agree[open_] / np.maximum(used[open_], 1)
        left, most = left[open_][np.argsort(-likeness, kind="stable")], 1
        while len(left):
            tried, left = left[:most], left[most:]
            both = _shared(sets[row], [sets[k] for k in tried])
            for k in tried[both >= similar * (size[row] + size[tried] - both)]:
                if label[k] != label[row]:
                    links.append((int(ids[row]), int(ids[k])))
                    label[label == label[k]] = label[row]
            left, most = left[label[left] != label[row]], min(2 * most, TRIED)
    return links


def _linked(docs: DataFrame, sizes: DataFrame, similar: float) -> DataFrame:
    """``(src, dst)``, staged: links that connect what the similar pairs within each family connect."""
    placed = _dealt(docs, sizes)
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        held: list[tuple[int, int, np.ndarray]] = []

        def made() -> Iterator[pa.RecordBatch]:
            if len(held) > 1:
                ids, side, sets = zip(*held)
                links = link_block(np.array(ids), np.array(side), list(sets), similar, at[1] != at[2])
                yield record(schema, src=[a for a, _ in links], dst=[b for _, b in links])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("family", "lo", "hi", "side", "id")]
            for family, lo, hi, side, id_, text in zip(*columns, batch.column("text").cast(pa.binary())):
                if (family, lo, hi) != at:
                    yield from made()
                    at, held = (family, lo, hi), []
                digests = b"".join([xxh64_digest(s, SEED) for s in set(shingles(text.as_py(), SHINGLE))])
                held.append((id_, side, np.unique(np.frombuffer(digests, "<u8"))))
        yield from made()

    return stage(in_arrow(placed, work, "src long, dst long"), "verified")


def keep_one_of_near(
    docs: DataFrame, similar: float = SIMILAR, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without all but the first of each group of near duplicates, as they are.

    A group is what verified pairs connect; its document with the smallest id stays. Rows that share
    an id stay or go together. Rows without an id are known by the hash of their text and come first.
    Texts without words (or null) are alike. An empty table gives an empty result.
    """
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    held = held.select("held", "text", _id_of().alias("id"))
    links = stage(near_pairs(held.select("id", "text"), similar), "links")
    gone = stage(connected_components(None, links).where("component <> id").select("id"), "gone")
    held = held.select("held", "id", may_have(F.col("id"), bitmap_of(gone)).alias("may_go"))
    rest = held.where("may_go").join(gone, "id", "left_anti")
    return held.where("not may_go").select("held.*").unionByName(rest.select("held.*"))
