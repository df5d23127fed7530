"""Reply trees as conversations for training.

Messages form trees: each replies to its parent. Iterative self-joins double the reach of every
message's pointer to an ancestor, so depths and path scores are known after as many rounds as the
logarithm of the depth. The leaves of a tree are the ends of its branches; the branches with the best
scores are walked down the same tables of pointers, and each gives one conversation. Until then only
ids move; the texts are then joined to their places once.

A conversation is text under a template that marks turns and escapes its own signs in texts, with the
spans of the assistant's texts as loss mask. Long conversations come as parts of ``PART`` messages,
which put together are the whole conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import in_arrow, record, slices
from pulsetrail.operators.ordering import dense_index, first_per_key
from pulsetrail.session import stage

PART = 64  # messages of a part
DEEPEST = 48  # rounds: trees deeper than 2 ** DEEPEST have a circle in them
TRAINED = "assistant"

# Fixed values of the template
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
SIGNS = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}  # what stands for a sign inside a turn
_IN_ROLE = str.maketrans(SIGNS)
_IN_TEXT = str.maketrans({sign: SIGNS[sign] for sign in "\\#<"})
_BACK = {escaped[1]: sign for sign, escaped in SIGNS.items()}
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]+|\\.)*): ((?:[^\\<]+|\\.)*)</turn>\n", re.S)


def ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Pointers of ``(tree, node, parent, score)`` to the ancestor 1, 2, 4, ... levels up, and sums.

    The first result has one table of ``(node, up)`` a round; the second is ``(tree, node, depth,
    total)`` of every node: the number and the scores of the nodes from the root to it. A parent that
    is no node counts as none. A circle raises.
    """
    known = nodes.select(F.col("node").alias("up"), F.lit(True).alias("known"))
    state = nodes.withColumnRenamed("parent", "up").join(known, "up", "left").select(
        "tree", "node", F.when(F.col("known"), F.col("up")).alias("up"),
        F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"),
    )
    state = stage(state, "pointers")
    jumps: list[DataFrame] = []
    done: DataFrame | None = None  # nodes that reached their root in an earlier round
    while True:
        going = state.where("up is not null")
        ended = state.where("up is null")
        both = state if done is None else state.unionByName(done)
        done = ended if done is None else done.unionByName(ended)
        if going.isEmpty():
            return jumps, done.drop("up")
        if len(jumps) == DEEPEST:
            raise ValueError("messages reply to each other in a circle")
        jumps.append(going.select("node", "up"))
        upper = both.select(
            F.col("node").alias("up"), F.col("up").alias("further"),
            F.col("depth").alias("more"), F.col("total").alias("sum"),
        )
        state = stage(
            going.join(upper, "up").select(
                "tree", "node", F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("total") + F.col("sum")).alias("total"),
            ),
            "pointers",
        )


def best_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """``(tree, branch, node, place, length)`` of the ``keep`` best root-to-leaf paths of each tree.

    ``nodes`` is ``(tree, node, parent, score)`` with a node of its own for each row. The score of a
    branch is the mean score of its nodes (null scores count as 0); ties go to the smaller leaf.
    ``branch`` counts from 0 and ``place`` from the root. A node on several chosen branches comes once
    for each. Nodes are joined by their own ids, so a tree of any size is spread over all tasks.
    """
    nodes = nodes.withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    jumps, reached = ancestors(nodes)
    reached = stage(reached, "depths")
    parents = jumps[0].select(F.col("up").alias("node")).distinct() if jumps else None
    leaves = reached if parents is None else reached.join(parents, "node", "left_anti")
    leaves = leaves.withColumn("mean", F.col("total") / F.col("depth"))
    order = [F.desc("mean"), F.asc("node")]
    if keep == 1:
        chosen = first_per_key(leaves, ["tree"], order).withColumn("branch", F.lit(0))
    else:
        ranked = F.row_number().over(Window.partitionBy("tree").orderBy(*order)) - 1
        chosen = leaves.withColumn("branch", ranked).where(F.col("branch") < keep)
    walk = chosen.select("tree", "branch", "node", F.col("depth").alias("length"))
    for links in reversed(jumps):  # the largest first: each step at most doubles what has been reached
        both = F.explode(F.when(F.col("up").isNull(), F.array("node")).otherwise(F.array("node", "up")))
        walk = walk.join(links, "node", "left").select("tree", "branch", both.alias("node"), "length")
    places = reached.select("node", (F.col("depth") - 1).alias("place"))
    return walk.join(places, "node").select("tree", "branch", "node", "place", "length")


def turn_nodes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``(tree, key, node, parent, score, copies)`` of rows in turns: each replies to the one before.

    ``key`` names a row by its conversation, turn and content. Rows of one turn come in the order of
    role and of a hash of the text; rows that are equal in all of these are one node with ``copies``.
    A null turn comes first. All rows of one null conversation are one tree.
    """
    named = keyed(messages, conv, turn)
    distinct = named.groupBy("tree", "key").agg(F.count("*").alias("copies"))
    order = [F.col("tree"), F.col("key.turn"), F.col("key.role"), F.col("key.hash")]
    numbered = stage(dense_index(distinct, order, "node"), "numbered")
    roots = numbered.groupBy("tree").agg(F.min("node").alias("node")).select("node", F.lit(True).alias("root"))
    parent = F.when(F.col("root").isNull(), F.col("node") - 1)
    return numbered.join(roots, "node", "left").select(
        "tree", "key", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "copies"
    )


def keyed(messages: DataFrame, conv: str, turn: str, role: str = "role", text: str = "text") -> DataFrame:
    """``(tree, key, role, text)`` of all rows; null roles and texts are empty."""
    said = F.coalesce(F.col(f"`{role}`"), F.lit(""))
    text_ = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.struct(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), said.alias("role"),
        F.xxhash64(text_).alias("hash"),
    )
    return messages.select(F.col(f"`{conv}`").alias("tree"), key.alias("key"), said.alias("role"), text_.alias("text"))


def template(role: str, text: str) -> tuple[str, int, int]:
    """A turn under the template, and where its text starts and ends in it."""
    head = OPEN + role.translate(_IN_ROLE) + AFTER_ROLE
    body = text.translate(_IN_TEXT)
    return head + body + CLOSE, len(head), len(head) + len(body)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted conversation or part; an error if it is anything else."""
    found, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError("not a formatted conversation")
        found.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return found


PARTS = pa.schema([
    ("tree", pa.int64()), ("branch", pa.int32()), ("part", pa.int64()), ("parts", pa.int64()),
    ("sub", pa.int64()), ("formatted", pa.string()), ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32())),
])
PARTS_DDL = (
    "tree long, branch int, part long, parts long, sub long, formatted string, "
    "loss_starts array<int>, loss_ends array<int>"
)


def _rows(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[dict[str, Any]]:
    for batch in batches:
        for cut in slices([batch], column):
            yield from cut.to_pylist()


def format_paths(paths: DataFrame, texts: DataFrame) -> DataFrame:
    """Each path as one conversation, in parts: ``(tree, branch, part, parts, sub, formatted,
    loss_starts, loss_ends)``.

    ``paths`` is ``(tree, branch, key, place, length)``, ``texts`` is ``(tree, key, role, text)`` with
    one row or more a key; rows of the same key follow each other. The parts of a conversation, in the
    order of ``part`` and ``sub``, are its text; ``sub`` is only used where rows of the same key make a
    part longer than ``PART`` messages. The spans of the loss mask are code points within the part.
    """
    placed = texts.join(paths.drop("tree"), "key").select(
        "tree", "branch", F.floor(F.col("place") / PART).alias("part"),
        F.ceil(F.col("length") / PART).alias("parts"), "place", "role", "text",
    )
    spread = placed.repartition("tree", "branch", "part").sortWithinPartitions("tree", "branch", "part", "place")

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _rows(batches, "text")
        for key, group in groupby(rows, lambda r: (r["tree"], r["branch"], r["part"], r["parts"])):
            held: list[str] = []
            starts: list[int] = []
            ends: list[int] = []
            at = sub = 0

            def flush() -> pa.RecordBatch:
                return record(
                    PARTS, tree=[key[0]], branch=[key[1]], part=[key[2]], parts=[key[3]], sub=[sub],
                    formatted=["".join(held)], loss_starts=[starts], loss_ends=[ends],
                )

            for row in group:
                if len(held) == PART:
                    yield flush()
                    held, starts, ends, at, sub = [], [], [], 0, sub + 1
                turn, start, end = template(row["role"], row["text"])
                held.append(turn)
                if row["role"] == TRAINED:
                    starts.append(at + start)
                    ends.append(at + end)
                at += len(turn)
            yield flush()

    return in_arrow(spread, lay_out, PARTS_DDL)


def format_conversations(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn"
) -> DataFrame:
    """The parts (see ``format_paths``) of conversations whose rows follow each other by turn.

    Null roles and texts are empty, rows that repeat are kept, an empty table gives no rows, a null
    conversation is one of its own; columns other than ``conv``, ``turn``, ``role`` and ``text`` are
    not read.
    """
    nodes = turn_nodes(messages, conv, turn)
    paths = best_paths(nodes.select("tree", "node", "parent", "score"))
    paths = paths.join(nodes.select("node", "key"), "node").drop("node")
    return format_paths(paths, keyed(messages, conv, turn))


DIGESTS = pa.schema([
    ("tree", pa.int64()), ("branch", pa.int32()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
DIGESTS_DDL = (
    "tree long, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)
READ = pa.schema([
    ("tree", pa.int64()), ("branch", pa.int32()), ("part", pa.int64()), ("sub", pa.int64()), ("n_turns", pa.int64()),
    ("turns", pa.binary()), ("loss", pa.binary()), ("loss_chars", pa.int64()), ("chars", pa.int64()),
])
READ_DDL = "tree long, branch int, part long, sub long, n_turns long, turns binary, loss binary, loss_chars long, chars long"


def read_back(parts: DataFrame) -> DataFrame:
    """``(tree, branch, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of every
    conversation, read from its formatted parts and their loss masks.

    Parts are read where they lie; one task a conversation then only feeds their bytes, in order, to
    two digests, holding one part at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices([batch], "formatted"):
                rows = cut.to_pylist()
                turns = [read_turns(r["formatted"]) for r in rows]
                loss = [
                    "".join(unescape(r["formatted"][a:b]) for a, b in zip(r["loss_starts"], r["loss_ends"]))
                    for r in rows
                ]
                yield record(
                    READ, **{c: cut.column(c) for c in ("tree", "branch", "part", "sub")},
                    n_turns=[len(t) for t in turns],
                    turns=["".join(f"{role}\n{text}\n" for role, text in t).encode() for t in turns],
                    loss=[x.encode() for x in loss], loss_chars=[len(x) for x in loss],
                    chars=[len(r["formatted"]) for r in rows],
                )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, branch), group in groupby(_rows(batches, "turns"), lambda r: (r["tree"], r["branch"])):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            sums = [0, 0, 0]
            for row in group:
                turns.update(row["turns"])
                loss.update(row["loss"])
                for n, c in enumerate(("n_turns", "loss_chars", "chars")):
                    sums[n] += row[c]
            yield record(
                DIGESTS, tree=[tree], branch=[branch], n_turns=sums[:1], turns_sha256=[turns.hexdigest()],
                loss_chars=sums[1:2], loss_sha256=[loss.hexdigest()], formatted_chars=sums[2:],
            )

    done = in_arrow(parts, read, READ_DDL).repartition("tree", "branch")
    return in_arrow(done.sortWithinPartitions("tree", "branch", "part", "sub"), close, DIGESTS_DDL)
