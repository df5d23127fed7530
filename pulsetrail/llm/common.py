"""What the operators on documents share: their columns, batches, and small tables on all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.session import ship

SPACE = r"[\x20\x09-\x0D]+"


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` of every row; a null text counts as empty. Other columns are not read."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def remainder(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(id_col.cast("string")) % parts


def slices(
    batches: Iterator[pa.RecordBatch], column: str | tuple[str, ...], most: int = 4_000_000
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of the columns, and one row at least."""
    columns = (column,) if isinstance(column, str) else column
    for batch in batches:
        sizes = sum(
            pa.compute.binary_length(batch.column(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for c in columns
        )
        start = size = 0
        for row, n in enumerate(sizes):
            if size + n > most and row > start:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def in_arrow(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package on the workers; ``df`` has only the columns the work reads."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def record(schema: pa.Schema, **columns: Any) -> pa.RecordBatch:
    """A batch of the given schema from lists or arrays by name."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
         else columns[f.name] for f in schema],
        schema=schema,
    )


MAP_BITS = 27  # of a bitmap of hashes: 16 MB, whatever it is made of
MAP_BLOCK = 1 << 15


def merged_bitmap(found: DataFrame) -> np.ndarray:
    """One bitmap of rows of ``(block, bits)``: 16-bit places in blocks of ``MAP_BLOCK`` bits.

    Blocks are put together where they meet; the driver gets the bitmap and no more.
    """
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, bits in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist()):
                held.setdefault(block, np.zeros(MAP_BLOCK, bool))[np.frombuffer(bits, "<u2")] = True
        for block, bits in held.items():
            yield record(schema, block=[block], bits=[np.packbits(bits).tobytes()])

    bitmap = np.zeros(1 << MAP_BITS - 3, np.uint8)
    for row in in_arrow(found.repartition("block"), merge, "block int, bits binary").toLocalIterator():
        at = row["block"] * (MAP_BLOCK // 8)
        bitmap[at : at + MAP_BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def bit_blocks(places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The ``(block, bits)`` of some places of a bitmap."""
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])
    places = np.unique(places)
    blocks, starts = np.unique(places // MAP_BLOCK, return_index=True)
    parts = np.split((places % MAP_BLOCK).astype("<u2"), starts[1:]) if len(blocks) else []
    if parts:
        yield record(schema, block=blocks, bits=[p.tobytes() for p in parts])


def has_bit(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1 != 0


def _place(value: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(value), 64 - MAP_BITS)


def bitmap_of(ids: DataFrame) -> Any:
    """A broadcast bitmap of the hashes of a column ``id``, for ``may_have``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from bit_blocks(batch.column(0).to_numpy(zero_copy_only=False))

    marked = in_arrow(ids.select(_place(F.col("id")).alias("place")), mark, "block int, bits binary")
    return ids.sparkSession.sparkContext.broadcast(merged_bitmap(marked))


def may_have(value: Column, bitmap: Any) -> Column:
    """False only for values that are not among the ids of the bitmap; others may be true by chance."""

    @F.pandas_udf("boolean")
    def look(place: pd.Series) -> pd.Series:
        return pd.Series(has_bit(bitmap.value, place.to_numpy()))

    return look(_place(value))
