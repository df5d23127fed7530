"""SentencePiece encoding and decoding with seeded merge-dropout.

Pieces are merged in the order of their scores, from an agenda of neighbouring pairs, as a merge-type
model does. With dropout, a candidate that comes up is skipped when a keyed hash of it falls below
the rate; another candidate may come up there next to a larger neighbour. The key is the seed, the
document, the place in its text and the piece, so every occurrence of a word is segmented on its own,
and a run can be repeated anywhere. Whatever is skipped, the pieces spell the text, and decoding
returns it exactly.

The agendas of a block of text are processed together: each is a row of a matrix, and in every step
each row takes its first candidate, merges it or skips it, and looks its new neighbours up.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys
import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from pulsetrail.llm.common import in_arrow, plain, record, slices

SPACE = "▁"  # how pieces spell a blank
UNITS = re.compile(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
LETTER = r"[^\W\d_²³¹¼-¾]"
FINE_UNITS = re.compile(rf"\n|{SPACE}*{LETTER}+|{SPACE}*(?:(?!{LETTER})[^{SPACE}\n])+|{SPACE}+")
UNITS_AT_ONCE = 50_000
LONG_UNIT = 48  # longer units are merged one by one, with a heap
WIDTHS = (1, 3, 5, 7, 9, 12, 16, 24, LONG_UNIT)  # units of similar length share a matrix
NEVER, MASK = (1 << 31) - 1, (1 << 64) - 1
# Odd factors that spread places and pieces, and the shifts and factors that mix them.
PLACE_FACTOR, PIECE_FACTOR = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1))

Skip = Callable[[int, str], bool]


def drawn(value: int) -> int:
    """53 bits that depend on all 64 of the value."""
    for shift, factor in MIX:
        value = (value ^ value >> shift) * factor & MASK
    return value >> 11


def all_drawn(values: np.ndarray) -> np.ndarray:
    """The same of an array of unsigned numbers."""
    for shift, factor in MIX:
        values = (values ^ values >> np.uint64(shift)) * np.uint64(factor)
    return values >> np.uint64(11)


_CODERS: dict[str, Coder] = {}


class Coder:
    """The pieces of a model file, an encoder of units, and tables of the pairs that merge."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.spelling: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.bytes[value] = i
                self.spelling.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelling.append(b"")
            else:
                self.scores[piece] = model.get_score(i)
                self.ids[piece] = i
                self.spelling.append(piece.replace(SPACE, " ").encode())
        if len(self.bytes) < 256:
            raise ValueError("the model has no byte fallback, so not every text could be decoded")
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("the model has pieces across blanks")
        # no merge can cross from a letter to a sign if no piece has the two side by side
        letter = re.compile(LETTER).match
        joined = {(a, b) for p in self.ids for a, b in pairwise(p.lstrip(SPACE))}
        mixed = any(bool(letter(a)) != bool(letter(b)) for a, b in joined)
        self.units = UNITS if mixed else FINE_UNITS
        self.sign = struct.pack("<3I", *(self.bytes[b] for b in SPACE.encode()))
        names = sorted(self.ids, key=lambda piece: -self.scores[piece])
        ranks: dict[float, int] = {}
        self.ranks = {piece: ranks.setdefault(self.scores[piece], len(ranks)) for piece in names}
        size = model.vocab_size()
        self.none = size  # the symbol behind the end of a unit
        self.symbols = np.full(sys.maxunicode + 1, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        splits = {
            self.ids[p[:n]] * (size + 1) + self.ids[p[n:]]: i
            for p, i in self.ids.items() for n in range(1, len(p)) if p[:n] in self.ids and p[n:] in self.ids
        }
        splits[(size + 1) ** 2] = 0  # beyond all pairs, so that a search never leaves the table
        self.pairs = np.array(sorted(splits), np.int64)
        self.merged = np.array([splits[key] for key in self.pairs.tolist()], np.int64)
        self.rank_of = np.full(size + 1, NEVER, np.int32)
        self.rank_of[[*self.ids.values()]] = [self.ranks[piece] for piece in self.ids]

    def skip_by_hash(self, drop: float, key: int) -> Skip:
        """Whether the candidate at a place of a unit is skipped; ``key`` is that of the occurrence."""
        bar, ids = int(drop * 2**53), self.ids
        return lambda place, piece: drawn(key + place * PLACE_FACTOR + ids[piece] * PIECE_FACTOR & MASK) < bar

    def merge(self, unit: str, skip: Skip) -> list[str]:
        """The pieces of a unit, merged from its agenda except for skipped candidates."""
        if len(unit) > LONG_UNIT:
            return self._merge_long(unit, skip)
        parts, places, get = list(unit), list(range(len(unit))), self.ranks.get
        agenda = [get(a + b, NEVER) for a, b in pairwise(parts)]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            at = agenda.index(best)
            piece = parts[at] + parts[at + 1]
            if skip(places[at], piece):
                agenda[at] = NEVER
                continue
            parts[at] = piece
            del parts[at + 1], places[at + 1], agenda[at]
            if at:
                agenda[at - 1] = get(parts[at - 1] + piece, NEVER)
            if at < len(agenda):
                agenda[at] = get(piece + parts[at + 1], NEVER)
        return parts

    def _merge_long(self, unit: str, skip: Skip) -> list[str]:
        """The same with a heap and linked neighbours, for units of any length."""
        parts: list[str | None] = list(unit)
        ahead = list(range(1, len(parts) + 1))
        behind = list(range(-1, len(parts) - 1))
        agenda: list[tuple[int, int, int, str]] = []

        def propose(left: int) -> None:
            right = ahead[left]
            if right < len(parts):
                piece = parts[left] + parts[right]
                if piece in self.ranks:
                    heapq.heappush(agenda, (self.ranks[piece], left, right, piece))

        for left in range(len(parts) - 1):
            propose(left)
        while agenda:
            _, left, right, piece = heapq.heappop(agenda)
            if parts[left] is None or parts[right] is None or ahead[left] != right:
                continue
            if parts[left] + parts[right] != piece or skip(left, piece):
                continue
            parts[left], parts[right] = piece, None
            ahead[left] = ahead[right]
            if ahead[left] < len(parts):
                behind[ahead[left]] = left
            propose(left)
            if behind[left] >= 0:
                propose(behind[left])
        return [p for p in parts if p is not None]

    def ids_of(self, pieces: list[str]) -> bytes:
        """Ids as little-endian 32-bit numbers; unknown characters are spelled in bytes."""
        try:
            found = [*map(self.ids.__getitem__, pieces)]
        except KeyError:
            found = []
            for piece in pieces:
                known = self.ids.get(piece)
                found += [known] if known is not None else [self.bytes[b] for b in piece.encode("utf-8")]
        return struct.pack(f"<{len(found)}I", *found)

    def _pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What neighbouring symbols merge to, and its rank, ``NEVER`` where they do not merge."""
        key = left * (self.none + 1) + right
        at = np.searchsorted(self.pairs, key)
        merged = self.merged[at]
        return merged, np.where(self.pairs[at] == key, self.rank_of[merged], NEVER)

    def _agendas(self, symbols: np.ndarray, keys: np.ndarray, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of each row of a matrix, in one array, and their number by row.

        The last column is ``none``, and so is what follows the end of a shorter row.
        """
        rows, width = symbols.shape
        flat = symbols.ravel()
        ahead, behind = np.arange(1, flat.size + 1), np.arange(-1, flat.size - 1)
        gone = flat == self.none
        merged, rank = self._pair(flat, np.append(flat[1:], self.none))
        by_row, busy = rank.reshape(rows, width), np.arange(rows)
        while busy.size:
            start = busy * width
            at = start + by_row[busy].argmin(1)
            on = rank[at] < NEVER
            busy, start, at = busy[on], start[on], at[on]
            piece = merged[at]
            if bar:
                values = (at - start).astype(np.uint64) * np.uint64(PLACE_FACTOR)
                values += piece.astype(np.uint64) * np.uint64(PIECE_FACTOR) + keys[busy]
                skipped = all_drawn(values) < np.uint64(bar)
                rank[at[skipped]] = NEVER
                at, piece = at[~skipped], piece[~skipped]
            right, left = ahead[at], behind[at]
            after = ahead[right]
            flat[at], ahead[at], behind[after] = piece, after, at
            gone[right], rank[right] = True, NEVER
            merged[at], rank[at] = self._pair(piece, flat[after])
            merged[left], rank[left] = self._pair(flat[left], piece)
        return flat[~gone], width - gone.reshape(rows, width).sum(1)

    def _settled(self, units: list[str], keys: np.ndarray, drop: float) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, and their number by unit, decided by the key of each occurrence.

        Units of characters that are no pieces, and very long ones, are merged one by one.
        """
        length = np.fromiter(map(len, units), np.int64, len(units))
        first = np.cumsum(length) - length
        text = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        symbols = np.append(self.symbols[text], self.none).astype(np.int64)
        single = (length > LONG_UNIT) | (length == 0)
        single[np.searchsorted(first, np.flatnonzero(symbols < 0), "right") - 1] = True
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row in np.flatnonzero(single).tolist():
            unit = units[row]
            ids = self.ids_of(self.merge(unit, self.skip_by_hash(drop, int(keys[row])))) if unit else self.sign
            parts.append((np.array([row]), np.frombuffer(ids, "<u4"), np.array([len(ids) // 4])))
        low = 0
        for high in WIDTHS:
            rows = np.flatnonzero((length > low) & (length <= high) & ~single)
            low = high
            if rows.size:
                place = np.arange(high + 1)
                inside = place < length[rows, None]
                matrix = symbols[np.where(inside, first[rows, None] + place, symbols.size - 1)]
                parts.append((rows, *self._agendas(matrix, keys[rows], int(drop * 2**53))))
        counts = np.zeros(len(units), np.int64)
        for rows, _, number in parts:
            counts[rows] = number
        start, out = np.cumsum(counts) - counts, np.empty(counts.sum(), "<u4")
        for rows, ids, number in parts:
            shift = start[rows] - (np.cumsum(number) - number)
            out[np.arange(ids.size) + np.repeat(shift, number)] = ids
        return out, counts

    def encode_all(self, texts: Sequence[str], keys: Sequence[int], drop: float = 0.0, seed: int = 0) -> list[bytes]:
        """The ids of texts as little-endian 32-bit numbers; a text has a key of its own.

        A text starts with a blank that decoding takes away; an empty text has no ids. The sign that
        spells blanks is itself spelled in bytes, so that it is not taken for a blank.
        """
        units: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                first, *others = text.split(SPACE)
                units += self.units.findall(SPACE + first.replace(" ", SPACE))
                for part in others:
                    units.append("")  # stands for the sign
                    units += self.units.findall(part.replace(" ", SPACE))
            ends.append(len(units))
        length = np.maximum(np.fromiter(map(len, units), np.int64, len(units)), 1)
        start = np.cumsum(length) - length
        counts = np.diff(ends)
        origin = np.repeat(np.append(start, 0)[ends[:-1]], counts)
        own = np.array([xxh64_intdigest(f"{seed}|{key}") for key in keys], np.uint64)
        hashed = np.repeat(own, counts) + (start - origin).astype(np.uint64) * np.uint64(PLACE_FACTOR)
        blocks = [slice(low, low + UNITS_AT_ONCE) for low in range(0, len(units), UNITS_AT_ONCE)]
        found = [self._settled(units[b], hashed[b], drop) for b in blocks]
        ids = np.concatenate([np.empty(0, "<u4"), *(f[0] for f in found)])
        places = np.cumsum(np.concatenate([[0], *(f[1] for f in found)]))
        return [ids[low:high].tobytes() for low, high in pairwise(places[ends].tolist())]

    def encode(self, text: str, drop: float = 0.0, seed: int = 0, key: int = 0) -> bytes:
        """The ids of one text."""
        return self.encode_all([text], [key], drop, seed)[0]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a text, without the blank in front."""
        return b"".join(map(self.spelling.__getitem__, ids)).removeprefix(b" ")


def coder(model: str) -> Coder:
    """The worker's coder for a file of ``public_tokenizers``, or for a path that all workers see."""
    if model not in _CODERS:
        import public_tokenizers

        _CODERS[model] = Coder(model if "/" in model else public_tokenizers.path(model))
    return _CODERS[model]


def encode_documents(
    docs: DataFrame,
    model: str = "piece_bpe_32k.model",
    drop: float = 0.1,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(row, doc_id, n_chars, ids)`` of every whole text; a null text is an empty one, without ids.

    The key of a document is a hash of its id and text, so equal rows have equal ids and rows that share
    an id are each encoded. An empty table gives an empty result.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                        ("ids", pa.list_(pa.int32()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in slices(batches, "text", 2_000_000):
            texts = batch.column("text").to_pylist()
            coded = own.encode_all(texts, batch.column("key").to_pylist(), drop, seed)
            sizes = [*map(len, texts)]
            offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32), pa.int32())
            yield record(schema, row=batch.column("row"), doc_id=batch.column("doc_id"), n_chars=sizes,
                         ids=pa.ListArray.from_arrays(pa.array(offsets), values))

    rows = plain(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text",
        F.xxhash64("doc_id", "text").alias("key"),
    )
    return in_arrow(rows, work, "row long, doc_id long, n_chars long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """``(row, doc_id, n_pieces, ids_crc32, text)``: the texts that the ids of each row spell.

    ``ids_crc32`` is that of the ids as little-endian 32-bit numbers. Null ids spell an empty text.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_pieces", pa.int64()),
                        ("ids_crc32", pa.int64()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                numbers = [
                    np.empty(0, np.int32) if x.values is None else x.values.to_numpy() for x in part.column("ids")
                ]
                yield record(
                    schema,
                    row=part.column("row"),
                    doc_id=part.column("doc_id"),
                    n_pieces=[len(x) for x in numbers],
                    ids_crc32=[zlib.crc32(x.astype("<u4").tobytes()) for x in numbers],
                    text=[own.decode(x.tolist()).decode("utf-8", "replace") for x in numbers],
                )

    return in_arrow(
        encoded.select("row", "doc_id", "ids"), work,
        "row long, doc_id long, n_pieces long, ids_crc32 long, text string",
    )
