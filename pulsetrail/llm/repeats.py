"""Suffix-array dedup: bytes covered by a string of a given length that occurred before.

Suffixes are ordered only through the first ``window`` bytes, by passes from the most significant
digit on; a suffix that is alone in its group is dropped after each pass, and the groups that are
left at the end are exactly the repeated windows. The first digit is the anchor of a window: the
least hash among its q-grams, and its place in the window. Equal windows have equal anchors, and
neighbouring windows share theirs, so the first pass moves one number for dozens of suffixes. The
q-gram is widened to the side on which the window has more room, so that anchors are as long as can be:

1. All anchors are counted. A bitmap of fixed size marks those that occur twice; it may mark others
   too, which costs work but no result.
2. Of each run of windows with a marked anchor a digest goes, once for each task that has the run, to
   where its anchor meets. Equal runs are settled whole: all but the first are repeated. Anchors
   around which runs differ are marked in a second bitmap.
3. Only the runs of these go there with their bytes and through the further passes, eight bytes at a
   time.
4. The spans found go back to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import (
    MAP_BITS, bit_blocks, has_bit, in_arrow, merged_bitmap, plain, record, slices,
)
from pulsetrail.session import stage

WINDOW = 100
SLICE = 1_000_000  # bytes that are hashed at once
KEYS_AT_ONCE = 1_000_000
BASE = 0x9E3779B97F4A7C15
LAST = (1 << 63) - 1  # rows without an id come after all others

_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def _totals(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data) + 1)[0][: len(data)], out=total[1:])
    return total


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the ``q`` bytes from each place on."""
    if len(data) < q:
        return np.empty(0, np.uint64)
    total = _totals(data)
    return _mixed((total[q:] - total[:-q]) * _powers(len(data) + 1)[1][: len(data) - q + 1])


def _span_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """64-bit hashes of given spans; spans of different sizes differ."""
    total = _totals(data)
    h = (total[start + size] - total[start]) * _powers(len(data) + 1)[1][start]
    return _mixed(h + np.asarray(size, np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


class Runs(NamedTuple):
    """Runs of windows with one anchor, in documents laid end to end."""

    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray  # where the anchor's gram begins
    key: np.ndarray  # the gram's hash
    digest: np.ndarray  # of all bytes of the run


def runs_of(data: np.ndarray, ends: np.ndarray, window: int) -> Runs:
    """All runs of some documents.

    The anchor of a window is the place of its least q-gram hash, the first of equal ones; its gram is
    widened by half the places that it may have, to the left or to the right, inside the window.
    """
    width = 1 << (2 * window // 3).bit_length() - 1  # q-grams in a window: a power of two
    half, q = width // 2, window - width + 1
    h = gram_hashes(data, q)
    if len(data) < window:
        none = np.empty(0, np.int64)
        return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64))
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    reach = 1
    while reach < width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    left = anchor - np.arange(len(anchor)) >= half
    sizes = np.diff(ends, prepend=0)
    late = np.minimum(sizes, window - 1)  # the last windows of a document reach beyond it
    beyond = np.repeat(ends - late, late) + np.arange(late.sum()) - np.repeat(np.cumsum(late) - late, late)
    state = anchor * 2 + left
    state[beyond[beyond < len(state)]] = -1
    cuts = np.flatnonzero(np.diff(state, prepend=-2))
    count = np.diff(cuts, append=len(state))
    real = state[cuts] >= 0
    start, count = cuts[real], count[real]
    place = anchor[start] - np.where(left[start], half, 0)
    return Runs(start, count, place, _span_hashes(data, place, q + half), _span_hashes(data, start, count + window - 1))


def refine(groups: np.ndarray, buffer: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Passes over the bytes of windows, most significant first: ``(item, group)`` of equal windows.

    ``groups`` is the first digit of the windows that begin ``at`` places of ``buffer``. Windows that
    are alone in their group are dropped before each pass.
    """
    item = np.arange(len(at))
    words = np.lib.stride_tricks.sliding_window_view(buffer, 8)
    offsets = [*range(0, window - 8, 8), window - 8]
    digit = np.zeros(len(at), np.uint64)
    for offset in [None, *offsets]:
        if offset is not None:
            digit = np.ascontiguousarray(words[at[item] + offset]).view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((digit, groups))
        item, groups, digit = item[order], groups[order], digit[order]
        new = np.ones(len(item), bool)
        new[1:] = (groups[1:] != groups[:-1]) | (digit[1:] != digit[:-1])
        groups = np.cumsum(new) - 1
        kept = np.bincount(groups, minlength=1)[groups] > 1
        item, groups = item[kept], groups[kept]
        if not len(item):
            break
    return item, groups


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, place, mark, text)``; rows that agree in ``place`` and ``mark`` are one document."""
    return plain(docs, id_col, text_col).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("place"), F.xxhash64("text").alias("mark"), "text"
    )


def _laid_out(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = [t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary())]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts], dtype=np.int64)


def repeated_anchors(docs: DataFrame, window: int) -> np.ndarray:
    """The bitmap of the anchors that occur twice or more; its size does not depend on the input."""
    spark = docs.sparkSession
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("again", pa.binary())])

    def hand_on(keys: list[np.ndarray]) -> pa.RecordBatch:
        key, times = np.unique(np.concatenate(keys), return_counts=True)
        bucket = (key % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        key, times, bucket = key[order], times[order], bucket[order]
        names, starts = np.unique(bucket, return_index=True)
        ends = [*starts[1:], len(key)]
        return record(
            sent,
            bucket=names,
            keys=[key[a:b].tobytes() for a, b in zip(starts, ends)],
            again=[key[a:b][times[a:b] > 1].tobytes() for a, b in zip(starts, ends)],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in slices(batches, "text", SLICE):
            held.append(runs_of(*_laid_out(batch), window).key)
            if sum(map(len, held)) > KEYS_AT_ONCE:
                yield hand_on(held)
                held = []
        if held:
            yield hand_on(held)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def twice(keys: list[bytes], again: list[bytes]) -> np.ndarray:
            key = np.sort(np.frombuffer(b"".join(keys), np.uint64))
            return np.concatenate([key[1:][key[1:] == key[:-1]], np.frombuffer(b"".join(again), np.uint64)])

        rows = (
            row
            for batch in batches
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "again")))
        )
        for _, group in groupby(rows, lambda row: row[0]):
            _, keys, again = zip(*group)
            yield from bit_blocks(_bit(twice(keys, again)))

    counted = in_arrow(docs.select("text"), count, "bucket int, keys binary, again binary")
    found = in_arrow(
        counted.repartition("bucket").sortWithinPartitions("bucket"), find, "block int, bits binary"
    )
    return merged_bitmap(found)


def _bit(key: np.ndarray) -> np.ndarray:
    return (key >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans: maximal spans in ascending order; spans that touch are joined."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:], len(ends)) - 1] if len(first) else ends[:0]


def _blob(starts, ends) -> bytes:
    starts, ends = _spans(np.asarray(starts, np.int64), np.asarray(ends, np.int64))
    return np.column_stack([starts, ends]).astype("<i8").tobytes()


def _first_of_runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, run, later)`` of rows of key, digest, offset, place, mark and start.

    ``order`` sorts them, ``run`` numbers equal runs in that order, and ``later`` tells which of them
    also occur earlier. Rows that agree in all are one.
    """
    mixed = columns[0] ^ columns[1] * np.int64(0x51ED270B27D4EB4F)
    order = np.argsort(mixed)
    again = np.zeros(len(order) + 1, bool)
    again[1:-1] = mixed[order[1:]] == mixed[order[:-1]]
    among = np.flatnonzero(again[1:] | again[:-1])  # only rows that are not alone need the whole order
    part = order[among]
    order[among] = part[np.lexsort([c[part] for c in columns[::-1]] + [mixed[part]])]
    key, digest, offset, place, mark, start = (c[order] for c in columns)
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (digest[1:] != digest[:-1]) | (offset[1:] != offset[:-1])
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)[run]
    later = (place != place[first]) | (mark != mark[first]) | (start != start[first])
    return order, run, later


def _grouped_blobs(place, mark, start, end) -> tuple[list, list, list]:
    """Spans put together by document."""
    order = np.lexsort((start, mark, place))
    place, mark, start, end = place[order], mark[order], start[order], end[order]
    new = np.ones(len(order), bool)
    new[1:] = (place[1:] != place[:-1]) | (mark[1:] != mark[:-1])
    first = np.flatnonzero(new)
    cuts = [*first.tolist(), len(order)]
    blobs = [_blob(start[a:b], end[a:b]) for a, b in pairwise(cuts)]
    return place[first].tolist(), mark[first].tolist(), blobs


def equal_runs(docs: DataFrame, window: int) -> DataFrame:
    """``(place, mark, spans, bits)``: the spans of runs that occurred before as they are, and the
    places in a bitmap of the anchors around which runs differ."""
    spark = docs.sparkSession
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(repeated_anchors(docs, window))
    numbers = ["key", "digest", "offset", "place", "mark", "start", "size"]
    sent = pa.schema([("bucket", pa.int32()), ("rows", pa.binary()), ("spans", pa.binary())])
    found = pa.schema([("place", pa.int64()), ("mark", pa.int64()), ("spans", pa.binary()), ("bits", pa.binary())])
    row = np.dtype([(n, "<u2" if n in ("offset", "size") else "<i8") for n in numbers])
    span = np.dtype([(n, "<i8") for n in ("place", "mark", "start", "end")])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, ends = _laid_out(batch)
            runs = runs_of(data, ends, window)
            marked = np.flatnonzero(has_bit(shared.value, _bit(runs.key)))
            runs = Runs(*(x[marked] for x in runs))
            doc = np.searchsorted(ends, runs.start, "right")
            place, mark = (batch.column(c).to_numpy()[doc] for c in ("place", "mark"))
            begin = runs.start - np.append(0, ends)[doc]
            columns = [runs.key.view(np.int64), runs.digest.view(np.int64), runs.anchor - runs.start, place, mark, begin]
            order, run, later = _first_of_runs(columns)
            size = runs.windows + window - 1
            gone = order[later]
            spans = np.empty(len(gone), span)
            for n, values in zip(span.names, (place, mark, begin, begin + size)):
                spans[n] = values[gone]
            one = np.ones(len(order), bool)
            one[1:] = run[1:] != run[:-1]
            kept = order[one]
            rows = np.empty(len(kept), row)
            for n, values in zip(numbers, (*columns, size)):
                rows[n] = values[kept]
            bucket = (rows["key"].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            names, starts = np.unique(bucket[by], return_index=True)
            rows = rows[by]
            parts = [rows[a:b].tobytes() for a, b in pairwise([*starts.tolist(), len(by)])]
            yield record(sent, bucket=names, rows=parts, spans=[spans.tobytes()] + [b""] * (len(parts) - 1) if parts else [])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = (
            entry for batch in batches for entry in zip(*(batch.column(c).to_pylist() for c in sent.names))
        )
        for _, group in groupby(entries, lambda entry: entry[0]):
            _, parts, spans = zip(*group)
            rows = np.frombuffer(b"".join(parts), row)
            order, run, later = _first_of_runs([rows[n].astype(np.int64) for n in numbers[:-1]])
            gone = rows[order[later]]
            early = np.frombuffer(b"".join(spans), span)
            place = np.concatenate([gone["place"], early["place"]])
            mark = np.concatenate([gone["mark"], early["mark"]])
            start = np.concatenate([gone["start"], early["start"]])
            end = np.concatenate([gone["start"] + gone["size"], early["end"]])
            heads = np.flatnonzero(np.diff(run, prepend=-1))
            keys, variants = np.unique(rows["key"][order[heads]], return_counts=True)
            bits = _bit(keys[variants > 1].view(np.uint64)).astype("<u4").tobytes()
            places, marks, blobs = _grouped_blobs(place, mark, start, end)
            yield record(
                found,
                place=[*places, None], mark=[*marks, None], spans=[*blobs, None],
                bits=[None] * len(places) + [bits],
            )

    collected = in_arrow(
        docs.select("place", "mark", "text"), collect, "bucket int, rows binary, spans binary"
    )
    dealt = collected.repartition("bucket").sortWithinPartitions("bucket")
    return in_arrow(dealt, settle, "place long, mark long, spans binary, bits binary")


def differing_anchors(equal: DataFrame) -> np.ndarray:
    """The bitmap of the anchors around which runs differ."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bits in batch.column("bits").to_pylist():
                yield from bit_blocks(np.frombuffer(bits, "<u4").astype(np.int64))

    return merged_bitmap(in_arrow(equal.where("bits is not null").select("bits"), mark, "block int, bits binary"))


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """``(place, mark, spans)``: for some documents some spans of bytes that occurred before.

    ``spans`` holds pairs of 64-bit numbers; a document may have several rows, whose spans may overlap.
    """
    spark = docs.sparkSession
    buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    equal = stage(equal_runs(docs, window), "equal-runs")
    shared = spark.sparkContext.broadcast(differing_anchors(equal))
    fields = [("bucket", pa.int32()), ("key", pa.int64()), ("offset", pa.int32()), ("place", pa.int64()),
              ("mark", pa.int64()), ("start", pa.int64()), ("data", pa.binary())]
    sent = pa.schema(fields)
    found = pa.schema([("place", pa.int64()), ("mark", pa.int64()), ("spans", pa.binary())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            data, ends = _laid_out(batch)
            start, count, anchor, key, _ = runs_of(data, ends, window)
            marked = np.flatnonzero(has_bit(shared.value, _bit(key)))
            start, count, anchor, key = start[marked], count[marked], anchor[marked], key[marked]
            doc = np.searchsorted(ends, start, "right")
            begin = start - np.append(0, ends)[doc]
            places, marks = batch.column("place").to_pylist(), batch.column("mark").to_pylist()
            whole = data.tobytes()
            first: dict[tuple[int, bytes], tuple] = {}
            later: dict[int, list[tuple[int, int]]] = {}
            for s, n, a, d, b, k in zip(*(x.tolist() for x in (start, count, anchor, doc, begin, key.view(np.int64)))):
                payload = whole[s : s + n + window - 1]
                own = (places[d], marks[d], b, d, k)
                known = first.setdefault((a - s, payload), own)
                if known is not own:
                    if own[:3] < known[:3]:
                        first[a - s, payload], known, own = own, own, known
                    if known[:3] < own[:3]:
                        later.setdefault(own[3], []).append((own[2], own[2] + n + window - 1))
            out: dict[str, list] = {name: [] for name, _ in fields}
            for (offset, payload), (place, mark, b, _, k) in first.items():
                for name, value in zip(out, (k % buckets, k, offset, place, mark, b, payload)):
                    out[name].append(value)
            for d, spans in later.items():
                blob = _blob(*zip(*spans))
                for name, value in zip(out, (hash((places[d], marks[d])) % buckets, 0, -1, places[d], marks[d], 0, blob)):
                    out[name].append(value)
            yield record(sent, **out)

    def settle(rows: list[tuple]) -> Iterator[tuple[int, int, bytes]]:
        """The spans of one bucket: all rows of its anchors."""
        first: dict[tuple[int, int, bytes], tuple[int, int, int]] = {}
        later: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for _, key, offset, place, mark, start, data in rows:
            if offset < 0:
                yield place, mark, data
                continue
            own = (place, mark, start)
            known = first.setdefault((key, offset, data), own)
            if own != known:
                if own < known:
                    first[key, offset, data] = own
                    own = known
                later.setdefault(own[:2], []).append((own[2], own[2] + len(data)))
        variants = sorted(first.items(), key=lambda item: item[0][0])
        alike = [list(group) for _, group in groupby(variants, lambda item: item[0][0])]
        runs = [run for group in alike if len(group) > 1 for run in group]
        if runs:
            sizes = np.array([len(run[0][2]) for run in runs])
            offset = np.array([run[0][1] for run in runs])
            start = np.array([run[1][2] for run in runs])
            keys = np.array([run[0][0] for run in runs])
            # of the same anchor, the earlier window is the one with the earlier anchor
            order = sorted(range(len(runs)), key=lambda i: (*runs[i][1][:2], start[i] + offset[i]))
            rank = np.empty(len(runs), np.int64)
            rank[order] = np.arange(len(runs))
            windows = sizes - window + 1
            run = np.repeat(np.arange(len(runs)), windows)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(windows) - windows, windows)
            at = np.repeat(np.cumsum(sizes) - sizes, windows) + nth
            _, group = np.unique(keys, return_inverse=True)
            group = group[run] * (window + 1) + offset[run] - nth
            buffer = np.frombuffer(b"".join(r[0][2] for r in runs), np.uint8)
            item, group = refine(group, buffer, at, window)
            earliest = np.full(int(group.max(initial=0)) + 1, len(runs))
            np.minimum.at(earliest, group, rank[run[item]])
            again = np.sort(item[rank[run[item]] > earliest[group]])
            for i, begin in zip(run[again].tolist(), (start[run[again]] + nth[again]).tolist()):
                later.setdefault(runs[i][1][:2], []).append((begin, begin + window))
        for (place, mark), spans in later.items():
            yield place, mark, _blob(*zip(*spans))

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for batch in batches for row in zip(*(batch.column(name).to_pylist() for name, _ in fields))
        )
        for _, group in groupby(rows, lambda row: row[0]):
            out = list(settle(list(group)))
            if out:
                place, mark, spans = zip(*out)
                yield record(found, place=list(place), mark=list(mark), spans=list(spans))

    collected = in_arrow(
        docs.select("place", "mark", "text"), collect,
        "bucket int, key long, offset int, place long, mark long, start long, data binary",
    )
    dealt = collected.repartition("bucket").sortWithinPartitions("bucket")
    rest = in_arrow(dealt, resolve, "place long, mark long, spans binary")
    return equal.where("spans is not null").select("place", "mark", "spans").unionByName(rest)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, keep_bytes: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])`` of every whole text in UTF-8.

    A byte is removed if it lies in a string of ``window`` bytes (8 at least) that also starts earlier:
    in a document with a smaller id, or before in the same one. A null or empty text has no bytes.
    Documents that share an id are ordered by the hash of their text; rows that agree in id and text
    are one document and have the same result. Rows without an id come after all others. An empty
    table gives an empty result. With ``keep_bytes`` the remaining bytes are returned too.
    """
    if window < 8:
        raise ValueError("window must be at least 8")
    own = _documents(docs, id_col, text_col)
    spans = repeated_spans(own, window).groupBy("place", "mark").agg(F.collect_list("spans").alias("spans"))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
              ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept", pa.binary())] * keep_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc, text, found in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("spans")
            ):
                data = text.as_py()
                pairs = np.frombuffer(b"".join(found.as_py() or []), "<i8").reshape(-1, 2)
                starts, ends = _spans(pairs[:, 0], pairs[:, 1])
                parts, at = [], 0
                for a, b in zip(starts.tolist(), ends.tolist()):
                    parts.append(data[at:a])
                    at = b
                kept = b"".join([*parts, data[at:]])
                out["doc_id"].append(doc)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(starts))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_bytes:
                    out["kept"].append(kept)
            yield record(schema, **out)

    joined = own.join(spans, ["place", "mark"], "left").select("doc_id", "text", "spans")
    return in_arrow(
        joined, cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + ", kept binary" * keep_bytes,
    )
