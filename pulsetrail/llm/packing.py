"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

The plan is made on counts of lengths, never on documents: best fit in descending length, where all
bins with the same room are one group. A length takes a whole group at a time, so the plan has a
size bounded by the number of lengths, whatever the number of documents. Then every piece looks up
its slot by its rank within its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping
from itertools import chain, pairwise, product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import in_arrow, plain, record, slices
from pulsetrail.session import stage

SEQUENCE = 4096
SALTS = 256  # a length that holds most pieces is ranked in this many parts
WORDS_KEPT = 250_000  # words of either generation in a worker's cache

JOINED = 1000  # unseen words of letters are encoded as texts of so many
PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())

_CACHES: dict[str, WordIds] = {}


class WordIds:
    """Ids of words under a tokenizer that drops blanks, as bytes; a cache of two generations.

    The words of the young generation become the old one when there are ``WORDS_KEPT``; words that
    are met again come back, rare ones go. ASCII is lower-cased before the look-up, as the tokenizer
    does itself, except in a text that may hold a special token.

    Where the tokenizer itself cuts ASCII punctuation from the letter or digit before it and marks the
    end of each such part, an unseen word is made of its stem and the punctuation behind it, and unseen
    words of letters are encoded many at a time, cut apart at the marks.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.last = self._last_ids()

    def _last_ids(self) -> np.ndarray | None:
        """Which ids end a part of a word; None if the tokenizer marks no ends or cuts otherwise."""
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        cut = self.tokenizer.pre_tokenizer
        if not mark or cut is None:
            return None
        for before, sign in product("a7", PUNCTUATION.decode()):
            if [part for part, _ in cut.pre_tokenize_str(before + sign)] != [before, sign]:
                return None
        names = self.tokenizer.get_vocab()
        last = np.zeros(max(names.values()) + 1, bool)
        last[[at for name, at in names.items() if name.endswith(mark)]] = True
        return last

    def _unseen(self, words: set[bytes]) -> list[bytes]:
        """The words that neither generation has; those of the old one come back."""
        unseen = []
        for word in words.difference(self.young):
            ids = self.old.get(word)
            if ids is None:
                unseen.append(word)
            else:
                self.young[word] = ids
        return unseen

    def _encode(self, words: list[str]) -> None:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        for word, one in zip(words, coded, strict=True):
            self.young[word.encode()] = np.array(one.ids, "<u4").tobytes()

    def _encode_joined(self, words: list[str]) -> None:
        """The same for words of letters. Each has one part at least, so with as many parts as words
        each has just one."""
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            one = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            ids = np.array(one.ids, "<u4")
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            if len(ends) != len(some):
                self._encode(some)
                continue
            data, ends = ids.tobytes(), [0, *ends.tolist()]
            for word, (start, end) in zip(some, pairwise(ends)):
                self.young[word.encode()] = data[start:end]

    def learn(self, words: set[bytes]) -> None:
        if len(self.young) > WORDS_KEPT:
            self.young, self.old = {}, self.young
        unseen = self._unseen(words)
        if self.last is None:
            self._encode([w.decode() for w in unseen])
            return
        whole, made = [], []
        for word in unseen:
            size = len(word.rstrip(PUNCTUATION))
            if 0 < size < len(word) and word[size - 1 : size].isalnum() and b"<|" not in word:
                made.append((word, word[:size], word[size:]))
            else:
                whole.append(word)
        parts = {part for _, *both in made for part in both}
        texts = [w.decode() for w in chain(whole, self._unseen(parts.difference(whole)))]
        self._encode_joined([t for t in texts if t.isalpha()])
        self._encode([t for t in texts if not t.isalpha()])
        for word, stem, behind in made:
            self.young[word] = self.young[stem] + self.young[behind]

    def of(self, texts: list[bytes]) -> list[bytes]:
        lower = [t if b"<|" in t else t.lower() for t in texts]
        split = pa.compute.ascii_split_whitespace(pa.array(lower, pa.binary()).cast(pa.string()))
        coded = split.flatten().cast(pa.binary()).dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(set(words))
        known = [self.young[w] for w in words]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(known), "<u4")
        at = coded.indices.to_numpy()
        each = sizes[at]
        ends = np.cumsum(each)
        place = np.repeat(starts[at] - ends + each, each)
        place += np.arange(len(place))
        ids = data[place].tobytes()
        cuts = (4 * np.concatenate([[0], ends]))[split.offsets.to_numpy()].tolist()
        return [ids[start:end] for start, end in pairwise(cuts)]


def word_ids(tokenizer: str) -> WordIds:
    """The worker's cache for a file of ``public_tokenizers``, or for a path that all workers see."""
    if tokenizer not in _CACHES:
        import public_tokenizers

        _CACHES[tokenizer] = WordIds(tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer))
    return _CACHES[tokenizer]


def token_pieces(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1,
    most: int = SEQUENCE,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(row, doc_id, piece, start, length, ids_crc32[, ids])`` of all texts, cut at ``most`` ids.

    A document is the ids of its text and ``end_id``, so a null or empty text is one id. Special
    tokens are not added. ``row`` tells rows apart that share an id or have none. The words of a text
    are encoded once for each worker: the tokenizer drops blanks and works word by word.
    """
    fields = [("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_ids(tokenizer)
        for batch in slices(batches, "text", 2_000_000):
            texts = [t.as_buffer().to_pybytes() for t in batch.column("text").cast(pa.binary())]
            out = {f.name: [] for f in schema}
            for row, doc, ids in zip(
                batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), coder.of(texts), strict=True
            ):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    out["row"].append(row)
                    out["doc_id"].append(doc)
                    out["piece"].append(piece)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
            yield record(schema, **out)

    rows = plain(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    ids = ", ids array<int>" * with_ids
    return in_arrow(
        rows, cut, f"row long, doc_id long, piece int, start long, length long, ids_crc32 long{ids}"
    )


class Slots(NamedTuple):
    """Ranks ``low`` to ``high - 1`` of a length go to bins from ``bin`` on, ``each`` to a bin."""

    length: int
    low: int
    high: int
    bin: int
    each: int
    offset: int


def plan_slots(counts: Mapping[int, int], size: int = SEQUENCE) -> list[Slots]:
    """Best fit in descending length over a histogram of lengths.

    The open bins are groups of equal room. The items of a length fill the group with the least
    sufficient room first, as many to a bin as fit, then the next one; what is left opens new bins.
    That is what best fit does with one item after the other.
    """
    if any(not 0 < length <= size for length in counts):
        raise ValueError(f"lengths must be from 1 to {size}")
    slots: list[Slots] = []
    rooms: list[int] = []  # sorted; the groups of each room in open_bins
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room: (first bin, bins)
    bins = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_bins:
                bisect.insort(rooms, room)
                open_bins[room] = []
            open_bins[room].append((first, n))

    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            else:
                room, first = size, bins
                n = -(-left // (size // length))
                bins += n
            each = room // length
            whole = min(n, left // each)
            rest = min(left - whole * each, each - 1) if whole < n else 0
            took = whole * each + rest
            slots.append(Slots(length, done, done + took, first, each, size - room))
            put(room - each * length, first, whole)
            put(room - rest * length, first + whole, 1 if rest else 0)
            used = whole + (1 if rest else 0)
            put(room, first + used, n - used)
            done, left = done + took, left - took
    return slots


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: their places in as few sequences as can be.

    ``pieces`` has ``row``, ``piece`` and ``length`` (1 to ``size``) and is read twice: stage it.
    The histogram has at most ``size`` rows, so it may go to the driver, and the plan made from it may
    be broadcast. The rank within a length is any numbering; it is counted in ``SALTS`` parts of the
    length, so that no length meets in one task.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame(
        plan_slots(counts, size), "length long, low long, high long, bin long, each long, base long"
    )
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row", "piece"), F.lit(SALTS)).cast("int"))
    key = ["length", "salt"]
    sizes = salted.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("row", "piece"))
    ranked = salted.withColumn("place", place - 1).join(before, key)
    ranked = ranked.withColumn("rank", F.col("place") + F.col("before"))
    found = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "l")),
        F.expr("length = l and low <= rank and rank < high"),
    )
    nth = F.col("rank") - F.col("low")
    return found.select(
        *pieces.columns,
        (F.col("bin") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", **options) -> DataFrame:
    """Tokenize, cut and pack documents: one row per piece with its sequence and offset.

    A null or empty text is a piece of one id. Rows that share an id or have none are packed each on
    its own. An empty table gives an empty result. ``options`` go to ``token_pieces``; with
    ``with_ids`` the ids themselves are carried along, and ``sequences`` joins them.
    """
    pieces = stage(token_pieces(docs, tokenizer, **options), "pieces")
    return pack(pieces, options.get("most", SEQUENCE))


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of pieces packed with their ids: each sequence is one bounded row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
