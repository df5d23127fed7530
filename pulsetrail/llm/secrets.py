"""Secret scans through a ledger of blobs.

Every version of a text is a blob named by the SHA-256 of its content. The ledger holds what each
rule version found in each blob, also if it found nothing. A run scans only the pairs of blob and
rule version that the ledger lacks, each blob once however many paths hold it, and joins the findings
back to all paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import bitmap_of, in_arrow, may_have, plain, record, slices
from pulsetrail.session import stage

# The kinds in the order of the report, their patterns, and the least length of the
# secret itself (group 2, or the whole match).
BASE = ["assign", "access", "hex"]
PATTERNS = {
    "assign": (
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6, True,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, False),
    "hex": (r"[0-9a-f]+", 0, 24, False),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, False),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0, False),
}
KINDS = list(PATTERNS)
RULES = "2"  # the version of the rules above
# A cheap test that every text with a match of the kind passes.
HINTS = {
    "assign": re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A),
    "access": re.compile("AKIA"),
    "hex": re.compile("[0-9a-f]{24}"),
    "pem": re.compile("PRIVATE KEY-----"),
    "jwt": re.compile("eyJ"),
}
COMPILED = {
    kind: (re.compile(pattern, re.I | re.A if either else re.A), group, least)
    for kind, (pattern, group, least, either) in PATTERNS.items()
}


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, by start and then by kind; per kind leftmost, apart."""
    found = []
    for order, kind in enumerate(KINDS):
        if HINTS[kind].search(text):
            pattern, group, least = COMPILED[kind]
            found += [
                (m.start(), order, m.end())
                for m in pattern.finditer(text)
                if m.end(group) - m.start(group) >= least
            ]
    return [(start, end, KINDS[order]) for start, order, end in sorted(found)]


def _blobs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return plain(docs, id_col, text_col).withColumn("blob", F.unhex(F.sha2("text", 256)))


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """``(blob, kinds, starts, ends)`` of a table of distinct ``(blob, text)``."""
    schema = pa.schema([
        ("blob", pa.binary()), ("kinds", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
    ])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans = [find_spans(t.as_py()) for t in batch.column("text")]
            yield record(
                schema,
                blob=batch.column("blob"),
                kinds=[[k for _, _, k in s] for s in spans],
                starts=[[a for a, _, _ in s] for s in spans],
                ends=[[b for _, b, _ in s] for s in spans],
            )

    return in_arrow(
        blobs.select("blob", "text"),
        scan,
        "blob binary, kinds array<string>, starts array<int>, ends array<int>",
    )


def update_ledger(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    rules: str = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The new rows of the ledger: ``(blob, rules, kinds, starts, ends)`` of pairs not yet in it.

    Copies of a text meet by their blob name only, after each task has kept one of its own, so a blob
    with many paths is one small group. With a ``ledger``, blobs that it has under ``rules`` are
    neither moved nor scanned.
    """
    blobs = _blobs(docs, id_col, text_col)
    if ledger is not None:
        known = ledger.where(F.col("rules") == rules).select("blob").distinct()
        blobs = blobs.join(known, "blob", "left_anti")
    distinct = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    return scan_blobs(distinct).select("blob", F.lit(rules).alias("rules"), "kinds", "starts", "ends")


def scan_documents(
    docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, kinds, starts, ends)`` of every document: the findings of its blob.

    A null text is an empty one and has no spans; rows that repeat or share an id are reported one by
    one. ``ledger`` holds the findings of earlier runs; the caller adds ``update_ledger``'s rows to it.
    """
    new = update_ledger(docs, ledger, RULES, id_col, text_col)
    known = new if ledger is None else new.unionByName(ledger.where(F.col("rules") == RULES))
    paths = _blobs(docs, id_col, text_col).select("doc_id", "blob")
    return paths.join(known.drop("rules"), "blob").select("doc_id", "kinds", "starts", "ends")


def without_spans(text: str, starts: list[int], ends: list[int], mark: str) -> str:
    """The text with ``mark`` in place of each span; overlapping spans are replaced together."""
    parts, done = [], 0
    for start, end in zip(starts, ends):
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame, mark: str = "[secret]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span found in ``text_col`` replaced by ``mark``, all else as it is.

    Only blobs with findings are joined back; a bitmap of fixed size tells which documents may hold
    one, so no other text is moved a second time.
    """
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("id"),
    )
    found = stage(update_ledger(docs, None, RULES, id_col, text_col), "ledger").where("size(kinds) > 0")
    found = found.select(F.col("blob").alias("id"), "starts", "ends")
    held = held.withColumn("may", may_have(F.col("id"), bitmap_of(found)))
    touched = held.where("may").join(found, "id", "left")

    @F.pandas_udf("string")
    def cleaned(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series(
            [t if a is None else without_spans(t, a, b, mark) for t, a, b in zip(text, starts, ends)], dtype=object
        )

    own = [F.col(f"held.`{c}`").alias(c) for c in docs.columns]
    at = docs.columns.index(text_col)
    new = [*own[:at], cleaned(F.col(f"held.`{text_col}`"), "starts", "ends").alias(text_col), *own[at + 1 :]]
    return held.where("not may").select(*own).unionByName(touched.select(*new))
