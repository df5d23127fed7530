"""Alternating least squares whose tasks hold one block of factors, however many ratings there are.

The ids of a side are dealt to blocks by remainder. The ratings of a block are packed once, in pieces of
some thousand ids, and stay where they are. In each half round a block is sent the factors its ratings
need, each once, as bytes; then its pieces pass by one at a time and are solved in numpy. New factors are
written as a table of a few hundred kilobytes a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.session import LONG_ROWS, discard, ship, stage

WIDTH = 4_096  # places of a block that share a row
RATINGS_A_PIECE = 1_000_000  # or those of one id
CELLS = 1 << 20  # numbers that are gathered at once
SENT_BYTES = 8 << 20

MESSAGE, OWN, PIECE = 0, 1, 2  # kinds of rows that meet in a block
MET = pa.schema(
    [("to", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("chunk", pa.int32()), ("start", pa.int64()),
     ("total", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("at", pa.binary()), ("data", pa.binary())]
)
MET_FORM = (
    "to int, kind int, block int, chunk int, start long, total long, ids binary, sizes binary, at binary, data binary"
)
FACTORS = pa.schema(
    [("block", pa.int32()), ("chunk", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("gram", pa.binary())]
)
FACTORS_FORM = "block int, chunk int, ids binary, data binary, gram binary"
Batches = Iterator[pa.RecordBatch]


def partition_labels(spark: SparkSession, blocks: int) -> list[int]:
    """One number for each of the blocks, which Spark's hash sends to the partition of the block."""
    tried = spark.range(20 * blocks * (blocks.bit_length() + 2)).select(F.col("id").cast("int").alias("n"))
    first = tried.groupBy(F.pmod(F.hash("n"), F.lit(blocks)).alias("p")).agg(F.min("n").alias("n")).collect()
    if len(first) < blocks:
        raise RuntimeError(f"no numbers for {blocks} partitions")
    return [r["n"] for r in sorted(first, key=lambda r: r["p"])]


def _label(ids: Column, labels: Sequence[int]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in labels]), F.pmod(ids, F.lit(len(labels)))).cast("int")


def _record(schema: pa.Schema, **columns: list) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    arrays = [pa.array(columns.get(f.name, [None] * rows), f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _positions(ids: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The different ids in the order of their blocks, and the place of each of ``ids`` among them."""
    low, high = int(ids.min()) // blocks, int(ids.max()) // blocks
    span = high - low + 1
    if span * blocks > 4 * len(ids) + (1 << 20):  # ids with wide gaps
        kinds, at = np.unique((ids % blocks).astype(np.int64) * span + (ids // blocks - low), return_inverse=True)
        return (kinds % span + low) * blocks + kinds // span, at.astype(np.int32)
    known = np.zeros(span * blocks, bool)
    steps = range(0, len(ids), CELLS)

    def key(part: np.ndarray) -> np.ndarray:
        return (part % blocks).astype(np.int64) * span + (part // blocks - low)

    for n in steps:
        known[key(ids[n : n + CELLS])] = True
    places = np.cumsum(known, dtype=np.int32) - 1
    at = np.concatenate([places[key(ids[n : n + CELLS])] for n in steps])
    kinds = np.flatnonzero(known)
    return (kinds % span + low) * blocks + kinds // span, at


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where rows of equal values begin, and the end."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), len(change))


def packed(ratings: DataFrame, own: str, other: str, labels: Sequence[int], others: int) -> DataFrame:
    """The ratings of the blocks of ``own`` as pieces, and which factors of ``other`` they need."""
    blocks = len(labels)
    dealt_form = pa.schema([("to", pa.int32()), ("own", pa.binary()), ("other", pa.binary()), ("rating", pa.binary())])

    def deal(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []

        def parts() -> Batches:
            columns = [np.concatenate([b.column(n).to_numpy() for b in held]) for n in range(3)]
            block = (columns[0] % blocks).astype(np.int16 if blocks < 1 << 15 else np.int32)
            order = np.argsort(block, kind="stable")
            cuts = np.searchsorted(block[order], np.arange(blocks + 1))
            columns = [c[order] for c in columns]
            some = [n for n in range(blocks) if cuts[n] < cuts[n + 1]]
            cells = [[c[cuts[n] : cuts[n + 1]].tobytes() for n in some] for c in columns]
            yield _record(dealt_form, to=[labels[n] for n in some], own=cells[0], other=cells[1], rating=cells[2])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CELLS:
                yield from parts()
                held = []
        if sum(b.num_rows for b in held):
            yield from parts()

    def pack(batches: Batches) -> Batches:
        to, kept = None, ([], [], [])
        for batch in batches:
            for n in range(batch.num_rows):
                label = batch.column("to")[n].as_py()
                if to not in (None, label):
                    raise RuntimeError("two blocks in a partition")
                to = label
                for held, name, kind in zip(kept, ("own", "other", "rating"), (np.int32, np.int32, np.float32)):
                    held.append(np.frombuffer(batch.column(name)[n].as_buffer(), kind).copy())
        if to is None:
            return
        ids = np.concatenate(kept[0])
        kept[0].clear()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        cuts = _cuts(ids)
        ids, ends = ids[cuts[:-1]], cuts[1:]
        other_ids = np.concatenate(kept[1])[order]
        kept[1].clear()
        needed, at = _positions(other_ids, others)
        del other_ids
        rated = np.concatenate(kept[2])[order]
        kept[2].clear()
        del order
        block, place = needed % others, needed // others
        cuts = _cuts(block, place // WIDTH)
        for a, b in zip(cuts, cuts[1:]):
            chunk = int(place[a] // WIDTH)
            bits = np.zeros(WIDTH, bool)
            bits[place[a:b] - chunk * WIDTH] = True
            yield _record(MET, to=[to], kind=[MESSAGE], block=[int(block[a])], chunk=[chunk], start=[int(a)],
                          total=[len(needed)], data=[np.packbits(bits).tobytes()])
        starts = np.append(0, ends[:-1])
        cuts = _cuts(ids // blocks // WIDTH)
        for a, b in zip(cuts, cuts[1:]):
            while a < b:
                upto = min(b, max(a + 1, int(np.searchsorted(ends, starts[a] + RATINGS_A_PIECE, "right"))))
                part = slice(starts[a], ends[upto - 1])
                yield _record(MET, to=[to], kind=[PIECE], block=[int(ids[a] % blocks)],
                              chunk=[int(ids[a] // blocks // WIDTH)], total=[len(needed)],
                              ids=[ids[a:upto].tobytes()], sizes=[(ends - starts)[a:upto].astype(np.int64).tobytes()],
                              at=[at[part].tobytes()], data=[rated[part].tobytes()])
                a = upto

    ship(ratings.sparkSession)
    rows = ratings.select(F.col(own).alias("own"), F.col(other).alias("other"), "rating")
    dealt = rows.mapInArrow(deal, "to int, own binary, other binary, rating binary").repartition(blocks, "to")
    made = stage(dealt.mapInArrow(pack, MET_FORM), "factor-pieces", **LONG_ROWS)
    # the planner knows the partitions of a table that it dealt itself
    kept = made.repartition(blocks, "to").persist(StorageLevel.DISK_ONLY)
    kept.count()
    discard(made)
    return kept


def needs(table: DataFrame) -> DataFrame:
    """``(block, chunk, wanted)``: which blocks of the other side want which factors of a row."""
    wanted = F.collect_list(F.struct("to", "start", "total", F.col("data").alias("bits"))).alias("wanted")
    return stage(table.where(F.col("kind") == MESSAGE).groupBy("block", "chunk").agg(wanted), "factor-needs", **LONG_ROWS)


def sent(factors: DataFrame, wanted: DataFrame, rank: int, blocks: int) -> DataFrame:
    """The factors as messages, in the partitions of the blocks that want them."""

    def work(batches: Batches) -> Batches:
        rows: list[dict] = []
        held = 0
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["data"], np.float32).reshape(-1, rank)
                places = np.frombuffer(r["ids"], np.int32) // blocks - r["chunk"] * WIDTH
                for w in r["wanted"]:
                    bits = np.unpackbits(np.frombuffer(w["bits"], np.uint8))
                    picked = bits[places] == 1
                    if picked.any():
                        at = w["start"] + np.cumsum(bits, dtype=np.int32)[places[picked]] - 1
                        part = data[picked].tobytes()
                        rows.append({"to": w["to"], "kind": MESSAGE, "total": w["total"], "at": at.tobytes(), "data": part})
                        held += len(part)
                if held > SENT_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=MET)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=MET)

    both = factors.select("block", "chunk", "ids", "data").join(wanted, ["block", "chunk"])
    return both.mapInArrow(work, MET_FORM).repartition(blocks, "to")


def _groups(sizes: np.ndarray, rank: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids with about as many ratings: their numbers, the places of the ratings, which of these are real."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    n = 0
    while n < len(order):
        least = int(ranked[n])
        upto = int(np.searchsorted(ranked, max(least * 5 // 4, least + 3), "right"))
        upto = min(upto, n + max(1, CELLS // (int(ranked[upto - 1]) * rank)))
        some = order[n:upto]
        steps = np.arange(int(ranked[upto - 1]))
        here = steps < ranked[n:upto, None]
        yield some, np.where(here, starts[some][:, None] + steps, 0), here
        n = upto


def _equations(
    y: np.ndarray, r: np.ndarray, here: np.ndarray, strength: float, alpha: float | None, gram: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Both sides of the normal equations of some ids; ratings that are not ``here`` weigh nothing."""
    r = r * here
    if alpha is None:
        trust, wanted, many = here, r, here.sum(axis=1)
    else:
        trust, liked = alpha * np.abs(r), r > 0
        wanted, many = (1 + trust) * liked, liked.sum(axis=1)
    left = np.matmul((y * trust[:, :, None]).transpose(0, 2, 1), y)
    left += (strength * many)[:, None, None] * np.eye(y.shape[2])
    if gram is not None:
        left += gram
    return left, np.matmul(wanted[:, None, :], y).transpose(0, 2, 1)


def solved(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(left, right)[:, :, 0]
    except np.linalg.LinAlgError:  # of all solutions the shortest
        return np.matmul(np.linalg.pinv(left, hermitian=True), right)[:, :, 0]


def _factor_rows(block: int, chunk: int, ids: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
    found = found.astype(np.float32)
    wide = found.astype(np.float64)
    return _record(FACTORS, block=[block], chunk=[chunk], ids=[ids.astype(np.int32).tobytes()],
                   data=[found.tobytes()], gram=[(wide.T @ wide).tobytes()])


class _Table:
    """The factors that a block was sent, in the order of its needs."""

    def __init__(self, rank: int) -> None:
        self.rank, self.rows, self.known = rank, None, None

    def add(self, total: int, at: np.ndarray, data: np.ndarray) -> None:
        if self.rows is None:
            self.rows, self.known = np.zeros((total, self.rank), np.float32), np.zeros(total, bool)
        self.rows[at] = data.reshape(-1, self.rank)
        self.known[at] = True


def _pieces(batches: Batches, rank: int) -> Iterator[tuple[dict, _Table, tuple[np.ndarray, np.ndarray]]]:
    """The pieces of a block, each with the factors it was sent and its own (ids and factors)."""
    table, own = _Table(rank), []
    for batch in batches:
        for n in range(batch.num_rows):
            r = {c: batch.column(c)[n] for c in batch.schema.names}
            kind = r["kind"].as_py()
            whole = lambda c, t: np.frombuffer(r[c].as_buffer(), t)  # noqa: B023, E731
            if kind == MESSAGE:
                table.add(r["total"].as_py(), whole("at", np.int32), whole("data", np.float32))
            elif kind == OWN:
                own.append((whole("ids", np.int32).copy(), whole("data", np.float32).reshape(-1, rank).copy()))
            else:
                piece = {"block": r["block"].as_py(), "chunk": r["chunk"].as_py(), "total": r["total"].as_py()}
                piece |= {"ids": whole("ids", np.int32), "sizes": whole("sizes", np.int64)}
                piece |= {"at": whole("at", np.int32), "ratings": whole("data", np.float32)}
                yield piece, table, own


def _met(messages: DataFrame, pieces: DataFrame, work: Callable[[Batches], Batches], form: str) -> DataFrame:
    """Both are in the partitions of the blocks; the union keeps them, and its first part comes first."""
    both = messages.union(pieces.where(F.col("kind") == PIECE))
    spark = both.sparkSession
    spark.conf.set("spark.sql.unionOutputPartitioning", "true")
    return both.mapInArrow(work, form)


def half_round(
    factors: DataFrame, wanted: DataFrame, pieces: DataFrame, rank: int, blocks: int, strength: float, alpha: float | None
) -> DataFrame:
    """The factors of one side, given those of the other."""
    gram = total_gram(factors, rank) if alpha is not None else None

    def work(batches: Batches) -> Batches:
        for p, table, _ in _pieces(batches, rank):
            if table.rows is None or len(table.known) != p["total"] or not table.known.all():
                raise RuntimeError("a block was not sent all factors it needs")
            found = np.zeros((len(p["ids"]), rank))
            for some, index, here in _groups(p["sizes"], rank):
                y = np.take(table.rows, p["at"].take(index), axis=0, mode="clip").astype(np.float64)
                r = p["ratings"].take(index).astype(np.float64)
                found[some] = solved(*_equations(y, r, here, strength, alpha, gram))
            yield _factor_rows(p["block"], p["chunk"], p["ids"], found)

    return stage(_met(sent(factors, wanted, rank, blocks), pieces, work, FACTORS_FORM), "factors", **LONG_ROWS)


def total_gram(factors: DataFrame, rank: int) -> np.ndarray:
    """The sum of the outer products of all factors; a matrix per partition comes to the driver."""

    def work(batches: Batches) -> Batches:
        total = np.zeros((rank, rank))
        for batch in batches:
            for g in batch.column("gram"):
                total += np.frombuffer(g.as_buffer()).reshape(rank, rank)
        yield pa.RecordBatch.from_pylist([{"gram": total.tobytes()}], schema=pa.schema([("gram", pa.binary())]))

    parts = factors.select("gram").mapInArrow(work, "gram binary").collect()
    return sum((np.frombuffer(r["gram"]).reshape(rank, rank) for r in parts), np.zeros((rank, rank)))


def first_factors(pieces: DataFrame, rank: int, seed: int) -> DataFrame:
    """Directions drawn by a hash of the id, so the layout does not change them."""

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def uniform(ids: np.ndarray, draw: int) -> np.ndarray:
        start = mixed(np.array([seed & (2**64 - 1), draw + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        bits = mixed(mixed(ids.astype(np.int64).view(np.uint64) + start[0]) + start[1])
        return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53

    def work(batches: Batches) -> Batches:
        for p, _, _ in _pieces(batches, rank):
            normal = [
                np.sqrt(-2 * np.log(uniform(p["ids"], 2 * n))) * np.cos(2 * np.pi * uniform(p["ids"], 2 * n + 1))
                for n in range(rank)
            ]
            found = np.stack(normal, axis=1)
            yield _factor_rows(p["block"], p["chunk"], p["ids"], found / np.linalg.norm(found, axis=1, keepdims=True))

    return stage(pieces.where(F.col("kind") == PIECE).mapInArrow(work, FACTORS_FORM), "factors", **LONG_ROWS)


def as_rows(factors: DataFrame, rank: int) -> DataFrame:
    """``(id, features)`` of packed factors."""
    sent_as = pa.schema([("id", pa.int32()), ("features", pa.list_(pa.float32()))])

    def work(batches: Batches) -> Batches:
        for batch in batches:
            for ids, data in zip(batch.column("ids"), batch.column("data")):
                own = np.frombuffer(ids.as_buffer(), np.int32)
                ends = pa.array(np.arange(len(own) + 1) * rank, pa.int32())
                values = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(data.as_buffer(), np.float32)))
                yield pa.RecordBatch.from_arrays([pa.array(own), values], schema=sent_as)

    return factors.select("ids", "data").mapInArrow(work, "id int, features array<float>")


def as_factors(rows: DataFrame, rank: int, blocks: int) -> DataFrame:
    """Packed factors of ``(id, features)``; those of a model without null."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                keys = batch.column("block").to_numpy(), batch.column("chunk").to_numpy()
                ids, cuts = batch.column("id").to_numpy(), _cuts(*keys)
                data = batch.column("features").flatten().to_numpy().reshape(-1, rank)
                for a, b in zip(cuts, cuts[1:]):
                    yield _factor_rows(int(keys[0][a]), int(keys[1][a]), ids[a:b], data[a:b])

    block = F.pmod("id", F.lit(blocks))
    place = (F.col("id") - block) / blocks
    keyed = rows.select(block.alias("block"), F.floor(place / WIDTH).cast("int").alias("chunk"), "id", "features")
    sorted_rows = keyed.repartition("block", "chunk").sortWithinPartitions("block", "chunk", "id")
    return stage(sorted_rows.mapInArrow(work, FACTORS_FORM), "factors", **LONG_ROWS)


def checked(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """``(userId int, itemId int, rating float)``; what Spark's learner refuses is an error here too."""

    def number(name: str) -> Column:
        c = F.col(name)
        odd = c.isNull() | (c.cast("double") != F.floor(c.cast("double")))
        return F.when(odd, F.raise_error(F.lit(f"{name}: ids must be whole numbers"))).otherwise(c).cast("int")

    value = F.col(rating).cast("float")
    odd = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    value = F.when(odd, F.raise_error(F.lit("ratings must be numbers"))).otherwise(value).cast("float")
    return ratings.select(number(user).alias("userId"), number(item).alias("itemId"), value.alias("rating"))


def fit(
    ratings: DataFrame, blocks: int, rank: int, rounds: int, strength: float, alpha: float | None, seed: int,
    symmetric: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(id, features)`` of users and of items after some rounds, in which items are solved first.

    ``ratings`` (``userId``, ``itemId``, ``rating``) are explicit without ``alpha``. ``symmetric``: every
    rating is there in both directions, so one packed table serves both sides.
    """
    labels = partition_labels(ratings.sparkSession, blocks)
    sides = [packed(ratings, "userId", "itemId", labels, blocks)]
    sides.append(sides[0] if symmetric else packed(ratings, "itemId", "userId", labels, blocks))
    wanted = [needs(sides[0])]  # of users: factors of items
    wanted.append(wanted[0] if symmetric else needs(sides[1]))
    step = partial(half_round, rank=rank, blocks=blocks, strength=strength, alpha=alpha)
    users, items = first_factors(sides[0], rank, seed), None
    for _ in range(rounds):
        new = step(users, wanted[1], sides[1])
        if items is not None:
            discard(items)
        items = new
        new = step(items, wanted[0], sides[0])
        discard(users)
        users = new
    for side in {id(side): side for side in sides}.values():
        side.unpersist()
    return as_rows(users, rank), as_rows(items, rank)


def gaps(
    users: DataFrame, items: DataFrame, ratings: DataFrame, blocks: int, rank: int, strength: float, alpha: float | None
) -> DataFrame:
    """``(userId, gap)``: by how much users miss their normal equation; see ``certificates.factor_gaps``."""
    labels = partition_labels(ratings.sparkSession, blocks)
    side = packed(ratings, "userId", "itemId", labels, blocks)
    held = as_factors(items, rank, blocks)
    gram = total_gram(held, rank) if alpha is not None else None
    out = pa.schema([("userId", pa.int32()), ("gap", pa.float64())])

    def work(batches: Batches) -> Batches:
        found = None
        for p, table, own in _pieces(batches, rank):
            if found is None:
                ids = np.concatenate([a for a, _ in own]) if own else np.zeros(0, np.int32)
                order = np.argsort(ids)
                found = ids[order], np.concatenate([b for _, b in own])[order] if own else np.zeros((0, rank))
            if table.rows is None or not len(found[0]):
                continue
            place = np.minimum(np.searchsorted(found[0], p["ids"]), len(found[0]) - 1)
            there = found[0][place] == p["ids"]
            off = np.zeros(len(p["ids"]))
            for some, index, here in _groups(p["sizes"], rank):
                at = p["at"].take(index)
                here = here & table.known[at]
                y = np.take(table.rows, at, axis=0, mode="clip").astype(np.float64)
                r = p["ratings"].take(index).astype(np.float64)
                left, right = _equations(y, r, here, strength, alpha, gram)
                x = found[1][place[some]].astype(np.float64)[:, :, None]
                away = np.matmul(left, x) - right
                size = np.maximum((right * right).sum(axis=(1, 2)), 1e-12)
                off[some] = np.sqrt((away * away).sum(axis=(1, 2)) / size)
                there[some] &= here.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(p["ids"][there]), pa.array(off[there])], schema=out)

    own = as_factors(users, rank, blocks)
    lit = lambda v, t: F.lit(v).cast(t)
    own = own.select(
        _label(F.col("block"), labels).alias("to"), lit(OWN, "int").alias("kind"), "block", "chunk",
        lit(None, "long").alias("start"), lit(None, "long").alias("total"), "ids",
        lit(None, "binary").alias("sizes"), lit(None, "binary").alias("at"), "data",
    )
    messages = sent(held, needs(side), rank, blocks).union(own.repartition(blocks, "to"))
    measured = stage(_met(messages, side, work, "userId int, gap double"), "gaps")
    side.unpersist()
    return measured
