"""Document fingerprints by Order MinHash, in DataFrame functions only.

The k-mers of a text are runs of ``K`` words, numbered by how often each has occurred before. Every
numbered k-mer has one hash, a point on a ring; each of ``SKETCHES`` fixed points of the ring selects
the ``LEAST`` k-mers that follow it, which are the minimal ones under the order "distance past that
point". The selected k-mers are put back in the order of the text and hashed as a tuple. Two texts
agree in a part of the signature only where the same k-mers come in the same order, so the share of
equal parts follows the edit distance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import SPACE, plain

K = 3
LEAST = 2
SKETCHES = 32
PLACE_BITS = 24  # of a packed number hold the place in the text
MOST = 1 << PLACE_BITS
RING = 62  # bits of a packed number; one more tells points and k-mers apart
BLOCKS = 1024  # of neighbouring documents


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` where ``value`` is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _upto(n: Column) -> Column:
    """0, 1, ..., n - 1; empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _packed(high: Column, place: Column) -> Column:
    """A number of RING bits with a hash above and a place below, so that it sorts by the hash."""
    kept = F.shiftleft(F.shiftrightunsigned(high, 64 - RING + PLACE_BITS), PLACE_BITS)
    return kept.bitwiseOR(place.cast("long"))


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(MOST - 1))


def _high(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, PLACE_BITS)


def kmer_hashes(text: Column) -> Column:
    """The hashes of a text's k-mers packed with their places; one k-mer for a text of fewer words."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")

    def grams(w: Column) -> Column:
        n = F.size(w)
        many = F.greatest(n - (K - 1), F.least(n, F.lit(1)))
        return F.transform(
            _upto(many),
            lambda i: _packed(F.xxhash64(*[F.get(w, i + j) for j in range(K)]), i),
        )

    return let(words, grams)


def numbered_hashes(kmers: Column) -> Column:
    """One packed hash for each k-mer and the number of its occurrence, in ascending order."""

    def number(p: Column) -> Column:
        starts = F.filter(_upto(F.size(p)), lambda i: (i == 0) | (_high(F.get(p, i)) != _high(F.get(p, i - 1))))

        def runs(s: Column) -> Column:
            def run(start: Column, k: Column) -> Column:
                end = F.coalesce(F.get(s, k + 1), F.size(p))
                return F.transform(
                    F.sequence(start, end - 1),
                    lambda i: _packed(F.xxhash64(_high(F.get(p, i)), i - start), _place(F.get(p, i))),
                )

            return F.sort_array(F.flatten(F.transform(s, run)))

        return let(starts, runs)

    return let(F.sort_array(kmers), number)


def signature(text: Column) -> Column:
    """``SKETCHES`` 32-bit hashes; all zero for a text without words."""
    shift = RING - (SKETCHES - 1).bit_length()  # the upper bits of a packed number name its sector

    def sector(packed: Column) -> Column:
        return F.shiftrightunsigned(packed, shift)

    def select(h: Column) -> Column:
        # the first LEAST of each sector of the ring are all that any point can select
        few = F.filter(h, lambda x, i: (i < LEAST) | (sector(x) != sector(F.get(h, i - LEAST))))

        def parts(m: Column) -> Column:
            points = F.array(*[F.lit(b << shift) for b in range(SKETCHES)])
            marks = F.sort_array(F.concat(F.transform(m, lambda x: x * 2 + 1), F.transform(points, lambda x: x * 2)))
            at = let(marks, lambda a: F.filter(_upto(F.size(a)), lambda i: F.get(a, i) % 2 == 0))

            def tuple_hash(where: Column, b: Column) -> Column:
                first = where - b
                chosen = F.transform(
                    F.sequence(F.lit(0), F.lit(LEAST - 1)),
                    lambda j: F.get(m, ((first + j) % F.size(m)).cast("int")),
                )
                in_text = F.array_sort(F.transform(chosen, lambda x: F.struct(_place(x).alias("p"), _high(x).alias("h"))))
                return F.hash(F.transform(in_text, lambda x: x["h"]))

            return F.transform(at, tuple_hash)

        return let(few, parts)

    def whole(h: Column) -> Column:
        return F.when(F.size(h) > 0, select(h)).otherwise(F.array_repeat(F.lit(0), SKETCHES))

    return let(numbered_hashes(kmer_hashes(text)), whole)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal parts of two signatures, 0 to 1."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, x: total + x
    )
    return same / F.lit(float(SKETCHES))


def as_text(sig: Column) -> Column:
    """The signature in hex digits, eight for each part."""
    return F.lower(F.array_join(F.transform(sig, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, sig)`` of every row. A null text is an empty one, with a signature of zeros."""
    return plain(docs, id_col, text_col).withColumn("sig", signature(F.col("text")))


def _block(doc_id: Column, bounds: list[int]) -> Column:
    """The number of bounds not above an id, found in two steps of the square root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(r[0]) for r in rows]).cast("array<long>")
    table = F.array(*[F.array(*[F.lit(b) for b in r]).cast("array<long>") for r in rows])
    row = F.size(F.filter(heads, lambda h: h <= doc_id)) - 1
    inside = F.size(F.filter(F.get(table, row), lambda b: b <= doc_id))
    found = F.when(row < 0, F.lit(0)).otherwise(row * step + inside)
    return F.coalesce(found, F.lit(0))


def with_next(docs: DataFrame, carried: list[str], blocks: int = BLOCKS) -> DataFrame:
    """Every row of ``docs`` with ``next``, a struct of ``carried`` of the next document by id.

    After the last comes the first; equal ids are ordered by text, rows without an id come first.
    Documents are dealt out in blocks of neighbouring ids, cut at ``blocks`` quantiles of the ids, so a
    text is moved once; only the first document of each block, one row a block, is handed to the
    block before.
    """
    cuts = [n / blocks for n in range(1, blocks)]
    row = docs.agg(F.percentile_approx("doc_id", cuts, 16 * blocks).alias("cuts")).first()
    bounds = sorted(set(row["cuts"] or []))
    block = _block(F.col("doc_id"), bounds) if bounds else F.lit(0)
    placed = docs.withColumn("block", block.cast("int"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    inside = Window.partitionBy("block").orderBy(*order)
    shown = F.struct(*carried)
    following = placed.withColumn("next", F.lead(shown).over(inside))
    first = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "text", shown.alias("shown"))
    heads = placed.groupBy("block").agg(F.min(first).alias("first"))
    ring = Window.partitionBy(F.lit(0)).orderBy("block")  # one row for each block
    start = F.min(F.struct("block", "first")).over(Window.partitionBy(F.lit(0)))
    heads = heads.select("block", F.coalesce(F.lead("first").over(ring), start["first"])["shown"].alias("head"))
    return following.join(heads, "block").select(
        *docs.columns, F.coalesce("next", "head").alias("next")
    )


def near_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document, the same with its last quarter replaced, and the likeness of their fingerprints.

    The last floor(n_chars / 4) code points give way to the first as many of the next document, or to
    all of it. ``(doc_id, n_chars, edited, sig, edited_sig, near_edited, near_next)``. A null text is
    an empty one; a document alone is its own next. An empty table gives an empty result.
    """
    known = fingerprint_documents(docs, id_col, text_col)
    paired = with_next(known, ["text", "sig"])
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring(F.col("next.text"), F.lit(1), quarter))
    made = paired.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sig", F.col("next.sig").alias("next_sig"))
    made = made.withColumn("edited_sig", signature(F.col("edited")))
    return made.select(
        "doc_id", "n_chars", "edited", "sig", "edited_sig",
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
