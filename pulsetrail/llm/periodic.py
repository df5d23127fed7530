"""Runs of repeated words, by recompression.

Candidates lie on harmonic grids: for each period q the words at 0, q, 2q, ... are compared, and a
stretch of at least four periods shows as three equal neighbours on the grid. How far such a candidate
reaches to either side is answered by a grammar of the texts: rounds of block compression (a maximal
block of one symbol becomes a symbol) alternate with rounds of pair compression (symbols are dealt to
two sides, and a left one followed by a right one become a symbol). Equal stretches have equal symbols
but for their edges, so a longest common extension climbs the levels while symbols agree and comes
down where they first differ: exact, and logarithmic in its length.

All work is inside the batch of documents that a task has in hand, on arrays over all their words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import in_arrow, record, slices

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
GRID = 1 << 20  # grid points looked at together
QUERIES = 1 << 18  # extensions followed together
BYTES = 2_000_000  # of text that a batch of documents has, or one document
SIDES = np.uint64(0x9E3779B97F4A7C15)
ROUNDS = 6  # in which only the first candidates of a stretch are followed; then all that are left


@dataclass
class Level:
    """One level of a grammar: its symbols and how they lie in the symbols of the next level."""

    symbol: np.ndarray
    ahead: np.ndarray | None  # equal symbols from here to the end of the block; None: always one
    behind: np.ndarray | None
    parent: np.ndarray | None = None  # place of the parent in the next level
    first: np.ndarray | None = None  # whether this is the first child of its parent
    last: np.ndarray | None = None
    starts: np.ndarray | None = None  # first and last child of each symbol, in the level below
    ends: np.ndarray | None = None


def _blocks(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal blocks of equal symbols."""
    edge = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
    starts = np.concatenate([[0], edge])
    return starts, np.diff(np.concatenate([starts, [len(symbol)]]))


def _named(keys: np.ndarray, after: int) -> tuple[np.ndarray, int]:
    """New symbols for keys, equal ones for equal keys, and the next free symbol."""
    values, names = np.unique(keys, return_inverse=True)
    return names + after, after + len(values)


def compress(symbol: np.ndarray) -> list[Level]:
    """The grammar of a sequence of symbols, as its levels from the words up to a single symbol.

    Symbols that are left alone in a round keep their name. A round of pairs that would join nothing
    is dealt again, so every round that is kept makes the sequence shorter.
    """
    levels: list[Level] = []
    top = int(symbol.max(initial=0)) + 1
    current = symbol.astype(np.int64)
    starts = ends = None
    deal = 0
    while True:
        levels.append(level := Level(current, None, None, starts=starts, ends=ends))
        if len(current) <= 1:
            return levels
        starts, length = _blocks(current)
        if length.max() > 1:
            level.ahead = np.repeat(starts + length, length) - np.arange(len(current))
            level.behind = np.arange(len(current)) - np.repeat(starts, length) + 1
            above = current[starts].copy()
            many = length > 1
            above[many], top = _named(above[many] * (len(current) + 1) + length[many], top)
        else:
            pair = np.zeros(len(current), bool)
            while not pair.any():
                deal += 1
                salt = np.uint64(deal * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
                mixed = (current.astype(np.uint64) + salt) * SIDES
                mixed ^= mixed >> np.uint64(29)
                left = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 0
                pair = np.zeros(len(current), bool)
                pair[:-1] = left[:-1] & ~left[1:]
            start = np.ones(len(current), bool)
            start[1:] = ~pair[:-1]
            starts = np.flatnonzero(start)
            above = current[starts].copy()
            joined = pair[starts]
            keys = above[joined] * np.int64(top) + current[starts[joined] + 1]
            above[joined], top = _named(keys, top)
        ends = np.concatenate([starts[1:], [len(current)]]) - 1
        level.first = np.zeros(len(current), bool)
        level.first[starts] = True
        level.last = np.zeros(len(current), bool)
        level.last[ends] = True
        level.parent = np.cumsum(level.first) - 1
        current = above


def _advance(level: Level, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
    """By how many equal symbols both places may move on: the rest of the shorter block."""
    rest = level.ahead if way > 0 else level.behind
    return np.ones(len(a), np.int64) if rest is None else np.minimum(rest[a], rest[b])


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``a`` and ``b`` on are equal, to the right (``way`` 1) or left (-1).

    The sequence must begin and end with symbols that occur nowhere else, and the places must differ.
    """
    a, b = a.astype(np.int64), b.astype(np.int64)
    origin = a.copy()
    height = np.zeros(len(a), np.int64)  # the level where the symbols of a query differ
    going = np.arange(len(a))
    for h, level in enumerate(levels):
        x, y = a[going], b[going]
        edge = level.first if way > 0 else level.last
        if edge is not None:
            # one move takes a place inside a parent to the edge of the next one
            inside = ~(edge[x] & edge[y])
            move = np.flatnonzero(inside)
            same = move[level.symbol[x[move]] == level.symbol[y[move]]]
            step = _advance(level, x[same], y[same], way) * way
            x[same] += step
            y[same] += step
            a[going], b[going] = x, y
        up = level.symbol[x] == level.symbol[y]
        if edge is not None:
            up &= edge[x] & edge[y]
        height[going[~up]] = h
        going = going[up]
        if not len(going):
            break
        a[going], b[going] = level.parent[a[going]], level.parent[b[going]]
    for h in range(int(height.max(initial=0)), 0, -1):
        above, level = levels[h], levels[h - 1]
        down = np.flatnonzero(height >= h)
        child = above.starts if way > 0 else above.ends
        x, y = child[a[down]], child[b[down]]
        same = np.flatnonzero(level.symbol[x] == level.symbol[y])
        step = _advance(level, x[same], y[same], way) * way
        x[same] += step
        y[same] += step
        a[down], b[down] = x, y
    return (a - origin) * way


def candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, period, place)`` where three neighbours on the grid of the period agree.

    A stretch whose words all equal those a period later, three periods long at least, has three such
    places in a row; so two more words in it, which any stretch must have, are compared as well.
    """
    most = sizes // TIMES
    found: list[tuple[np.ndarray, ...]] = []
    live = np.flatnonzero(most > 0)
    low = np.ones(len(live), np.int64)  # the first period that is still to come
    while len(live):
        # as many periods of each document as fill the block together
        room = max(1, GRID // len(live))
        fits = np.maximum(1, room * low // np.maximum(sizes[live], 1))
        high = np.minimum(low + fits, most[live] + 1)
        count = high - low
        pair_doc = np.repeat(live, count)
        period = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        points = -(-sizes[pair_doc] // period)
        base = np.cumsum(points) - points
        total = int(points.sum())
        place = (np.arange(total) - np.repeat(base, points)) * np.repeat(period, points)
        at = place + np.repeat(starts[pair_doc], points)
        value = words[at]
        equal = value[1:] == value[:-1]
        equal[base[1:] - 1] = False  # neighbours of different grids
        three = np.flatnonzero(equal[:-2] & equal[1:-1] & equal[2:])
        if len(three):
            owner = np.searchsorted(base, three, side="right") - 1
            q, x = period[owner], at[three]
            keep = (words[x + 1] == words[x + q + 1]) & (words[x + q + q // 2] == words[x + 2 * q + q // 2])
            keep &= words[x + q - 1] == words[x + 2 * q - 1]
            found.append((pair_doc[owner][keep], q[keep], x[keep]))
        low, left = high, high <= most[live]
        live, low = live[left], low[left]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(parts) for parts in zip(*found))


def find_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(document, start, length, period)`` of every run, by document, start and period.

    ``words`` has the numbered words of all documents, one after the other; starts are counted from
    the beginning of the document.
    """
    doc, period, place = candidates(words, starts, sizes)
    none = np.zeros(0, np.int64)
    if not len(doc):
        return none, none, none, none
    # the grammar is made of the documents that have candidates, with a symbol of its own at each border
    held = np.unique(doc)
    size = sizes[held] + 1
    begin = np.cumsum(size) - size
    text = np.empty(int(size.sum()) + 1, np.int64)
    border = np.zeros(len(text), bool)
    border[begin] = border[-1] = True
    inner = np.arange(int(sizes[held].sum())) - np.repeat(np.cumsum(sizes[held]) - sizes[held], sizes[held])
    text[~border] = words[inner + np.repeat(starts[held], sizes[held])]
    text[border] = int(words.max(initial=0)) + 1 + np.arange(border.sum())
    levels = compress(text)
    row = np.searchsorted(held, doc)
    shift = begin[row] + 1 - starts[doc]  # from a place in the words to one in the text

    order = np.lexsort((place, period, row))
    row, period, at = row[order], period[order], (place + shift)[order]
    spans: list[np.ndarray] = []
    open_ = np.arange(len(row))
    for turn in range(ROUNDS + 1):
        if not len(open_):
            break
        r, q, x = row[open_], period[open_], at[open_]
        ask = np.ones(len(open_), bool)
        if turn < ROUNDS:  # the first of candidates that follow each other on a grid
            ask[1:] = (r[1:] != r[:-1]) | (q[1:] != q[:-1]) | (x[1:] != x[:-1] + q[1:])
        reach = np.zeros(len(open_), np.int64)  # end of what the asked one covers
        for part in np.array_split(np.flatnonzero(ask), -(-int(ask.sum()) // QUERIES)):
            right = extensions(levels, x[part], x[part] + q[part], 1)
            left = extensions(levels, x[part] - 1, x[part] + q[part] - 1, -1)
            long = np.flatnonzero(right + left + q[part] >= np.maximum(LEAST, TIMES * q[part]))
            spans.append(
                np.stack([r[part], x[part] - left, x[part] + right + q[part], q[part]])[:, long]
            )
            reach[part] = x[part] + right
        # candidates up to there belong to the same stretch as the one before them that was asked
        asked = np.maximum.accumulate(np.where(ask, np.arange(len(open_)), 0))
        open_ = open_[~ask & (x >= reach[asked])]
    r, s, e, q = np.concatenate(spans, axis=1)
    # of the periods of one stretch the smallest counts; the others are its multiples
    order = np.lexsort((q, e, s, r))
    r, s, e, q = r[order], s[order], e[order], q[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    r, s, e, q = r[new], s[new], e[new], q[new]
    order = np.lexsort((q, s, r))
    r, s, e, q = r[order], s[order], e[order], q[order]
    return held[r], s - begin[r] - 1, e - s, q


def planted(n: int, seed: int) -> np.ndarray:
    """The word that each place takes when a tail of the text is made periodic, by a rule of ``seed``."""
    rest = seed // 10
    at = np.arange(n)
    if seed % 10 == 0 and n:
        a = rest % n
        p = 1 + (n - a) // (3 + rest % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Of ``(start, length, period)``, in order, the first with the greatest length in periods."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


OUT = pa.schema([
    ("doc_id", pa.int64()), ("starts", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("periods", pa.list_(pa.int64())), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("collapsed", pa.string()),
])
OUT_DDL = (
    "doc_id long, starts array<long>, lengths array<long>, periods array<long>, n_runs long, "
    "start long, length long, period long, exponent_milli long, collapsed string"
)


def _scan(ids: list, texts: list[bytes], seeds: list) -> pa.RecordBatch:
    """The runs of some documents, found together."""
    split = [t.split() for t in texts]  # bytes split at the blanks of the contract only
    sizes = np.array([len(w) for w in split], np.int64)
    starts = np.cumsum(sizes) - sizes
    kept = []
    for n, words in enumerate(split):
        if seeds[n] is not None and seeds[n] % 10 == 0:
            split[n] = [words[i] for i in planted(len(words), seeds[n])]
        kept.extend(split[n])
    names = pa.array(kept, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    del kept
    doc, start, length, period = find_runs(names.astype(np.int64), starts, sizes)
    ends = np.searchsorted(doc, np.arange(len(ids) + 1))
    rows: dict[str, list] = {name: [] for name in OUT.names}
    for n, words in enumerate(split):
        mine = slice(ends[n], ends[n + 1])
        s, k, q = start[mine].tolist(), length[mine].tolist(), period[mine].tolist()
        runs = list(zip(s, k, q))
        if runs:
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, start[mine] + period[mine], 1)
            np.add.at(gone, start[mine] + length[mine], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
        best = best_run(runs) if runs else (None, None, None)
        milli = 1000 * best[1] // best[2] if runs else None
        values = [ids[n], s, k, q, len(runs), *best, milli, b" ".join(words)]
        for name, value in zip(OUT.names, values):
            rows[name].append(value)
    rows["collapsed"] = pa.array(rows["collapsed"], pa.binary()).cast(pa.string())
    return record(OUT, **rows)


def collapse_runs(
    docs: DataFrame, seed: Column | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The runs of every document and its text with the repeats of each run taken out.

    Returns ``doc_id, starts, lengths, periods, n_runs, start, length, period, exponent_milli,
    collapsed``. Words are what lies between blanks. A run is a stretch of words with smallest period
    q, ``TIMES`` periods and ``LEAST`` words long at least, that no neighbouring word extends;
    ``starts``, ``lengths`` and ``periods`` list all of them by start and period, the single columns
    describe the one with most periods (ties: smallest start, then period; none: nulls).
    ``collapsed`` has the words, joined by blanks, that no run contains after its first q words.

    ``seed`` makes the tail of some texts periodic first (see ``planted``), for measurements.

    A null text is empty: no runs, collapsed to the empty text. Rows with equal or null ids are scanned
    one by one, an empty table gives no rows, other columns are not read. Documents are taken whole, in
    batches of ``BYTES`` of text or one longer document; a word of text takes about 300 bytes of memory
    while its batch is scanned.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
        (F.lit(None) if seed is None else seed).cast("long").alias("seed"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BYTES):
            yield _scan(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "seed")))

    return in_arrow(rows, scan, OUT_DDL)


def runs_digest() -> Column:
    """SHA-256 over ``start,length,period`` and a line feed for each run."""
    lines = F.transform(
        F.arrays_zip("starts", "lengths", "periods"),
        lambda r: F.concat_ws(",", r["starts"], r["lengths"], r["periods"]),
    )
    return F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.col("n_runs") > 0, "\n").otherwise("")), 256)
