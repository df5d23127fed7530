"""Merkle manifests, periodic runs and chat formatting against SQL and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsetrail.llm import chat, merkle, periodic, queries
from tests.llm.conftest import AWKWARD


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.mark.parametrize("name", ["op11_merkle", "op13_chat"])
def test_query_equals_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    result = connection.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*names).collect())) == Counter(result.fetchall())


# ---- manifests


def level_up(nodes):
    return [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]


def siblings(nodes, at):
    out = []
    while len(nodes) > 1:
        run = at // 8 * 8
        out.append((nodes[run:at], nodes[at + 1 : run + 8]))
        nodes, at = level_up(nodes), at // 8
    return out, nodes[0]


def plain_manifest(rows):
    """Rows ``(doc_id, source, lang, n_chars, text)`` to the rows of the query."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    trees = defaultdict(list)
    for row in rows:
        touched = row[0] is not None and crc(row[0]) % 3 == 0
        claim = leaf((*row[:4], row[4] and row[4].translate(low))) if touched else leaf(row)
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row[0], claim))
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    proved = {}
    for lang in langs:
        trees[lang].sort()
        leaves = [t[2] for t in trees[lang]]
        proved[lang] = [siblings(leaves, i) for i in range(len(leaves))]
    subroots = [proved[lang][0][1] for lang in langs]
    out = []
    for n, lang in enumerate(langs):
        above, root = siblings(subroots, n)
        for (steps, subroot), (_, _, own, doc_id, claim) in zip(proved[lang], trees[lang]):
            folded = claim
            for before, after in steps + above:
                folded = sha("".join([*before, folded, *after]))
            proof = sha("".join("".join([*b, *a]) for b, a in steps + above))
            out.append((doc_id, own, subroot, root, proof, folded, folded == root))
    return Counter(out)


def manifest_rows(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(map(tuple, queries.op11_merkle(spark, str(tmp_path)).collect()))


def test_manifest_of_awkward_documents(spark, tmp_path, awkward, make):
    many = [(100 + n, f"Text {n}", "hot" if n % 3 else None) for n in range(200)]
    df = awkward.unionByName(make(many)).unionByName(make([(900 + n, "X", f"l{n}") for n in range(20)]))
    rows = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    found = manifest_rows(spark, tmp_path, df)
    expected = plain_manifest(rows)
    assert found == expected
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_a_single_language(spark, tmp_path, make, n):
    rows = [(i, f"A {i}", "en") for i in range(n)]
    found = manifest_rows(spark, tmp_path, make(rows))
    assert found == plain_manifest([(i, "src", "en", len(t), t) for i, t, _ in rows])


# ---- periodic runs


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            smaller = any(stretch[p:] == stretch[:-p] for p in range(1, q))
            if len(stretch) >= max(6, 4 * q) and not smaller:
                found.append((i, len(stretch), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_periods(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = None if doc_id is None else crc(doc_id)
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, milli, sha(lines), hashlib.sha256(kept).hexdigest())


def test_periods_query_equals_brute_force(spark, folder, texts):
    found = Counter(map(tuple, queries.op12_periods(spark, folder).collect()))
    short = {i: t for i, t in texts.items() if len(t) < 6000}  # the plain way takes the square of a text
    assert {r for r in found if r[0] in short} == {plain_periods(i, t) for i, t in short.items()}
    assert len(found) == len(texts)
    assert sum(r[1] > 0 for r in found) > len(texts) / 20


def test_periods_of_awkward_documents(spark, tmp_path, make):
    random.seed(3)
    made = [(50 + n, " ".join(random.choice("ab") for _ in range(random.randrange(80))), "en") for n in range(200)]
    rows = [r for r in AWKWARD if not (r[1] and len(r[1]) > 5000)] + made
    rows += [(400, "la " * 3000, "en"), (401, "one two " * 2000 + "x " + "one two " * 2000, "en")]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(map(tuple, queries.op12_periods(spark, str(tmp_path)).collect()))
    small = Counter(plain_periods(i, t) for i, t, _ in rows if i not in (400, 401))
    assert Counter({r: n for r, n in found.items() if r[0] not in (400, 401)}) == small
    by_id = {r[0]: r for r in found}
    if crc(400) % 10:
        assert by_id[400][1:6] == (1, 0, 3000, 1, 3_000_000)
    if crc(401) % 10:
        assert by_id[401][1:6] == (2, 0, 4000, 2, 2_000_000)
        assert by_id[401][-1] == sha("one two x one two")


def test_periods_of_nothing(nothing):
    assert periodic.collapse_runs(nothing).collect() == []


def test_extensions_equal_a_plain_scan():
    random.seed(5)
    for _ in range(60):
        text = [1000] + [random.randrange(random.randint(1, 3)) for _ in range(random.randint(2, 90))] + [1001]
        levels = periodic.compress(np.array(text))
        pairs = [(a, b) for a in range(1, len(text) - 1) for b in range(a + 1, len(text))]
        a, b = (np.array(v) for v in zip(*pairs))

        def plain(i, j, way):
            n = 0
            while text[i + way * n] == text[j + way * n]:
                n += 1
            return n

        for way in (1, -1):
            got = periodic.extensions(levels, a, b, way)
            assert got.tolist() == [plain(i, j, way) for i, j in pairs]


def test_runs_at_batch_borders_stay_apart():
    words, sizes = np.array([7] * 5 + [7] * 5 + [7] * 6), np.array([5, 5, 6])
    found = periodic.find_runs(words, np.array([0, 5, 10]), sizes)
    assert [x.tolist() for x in found] == [[2], [0], [6], [1]]


def test_small_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 200, 40)
    words, starts = rng.integers(0, 2, sizes.sum()), np.cumsum(sizes) - sizes
    whole = periodic.find_runs(words, starts, sizes)
    monkeypatch.setattr(periodic, "GRID", 64)
    monkeypatch.setattr(periodic, "QUERIES", 3)
    monkeypatch.setattr(periodic, "ROUNDS", 1)
    for x, y in zip(whole, periodic.find_runs(words, starts, sizes)):
        assert x.tolist() == y.tolist()


# ---- chat


def plain_chat(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in said.items():
        turns.sort()
        pairs = [t[2:] for t in turns]
        loss = "".join(text for role, text in pairs if role == "assistant")
        both = "".join(f"{role}\n{text}\n" for role, text in pairs)
        out[conv] = (len(pairs), sha(both), len(loss), sha(loss))
    return out


NASTY = [
    "\\### Assistant: </turn> ok", "### user: hi</turn>\n### assistant: x</turn>\n", "\\", "\\\\n", "\\n", "", None,
    "<", "#", "</turn", "🎉 é 日本", "\r\n \t", "trailing\\",
]


def chat_rows(spark, tmp_path, rows):
    schema = "conv_id long, turn long, role string, text string, tree string, key string, node string, place string"
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema)
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    return queries.op13_chat(spark, str(tmp_path)).collect()


def test_chat_of_awkward_conversations(spark, tmp_path):
    rows = [(1, n, ("user", "assistant")[n % 2], t) for n, t in enumerate(NASTY * 2)]
    rows += [(2, n // 2, "assistant", "same") for n in range(300)]  # repeated rows, several parts
    rows += [(3, 5, None, "x"), (3, None, "a: b<c#\\", "y"), (3, 2, "assistant", None)]
    rows += [(None, 1, "user", "q"), (None, 2, "assistant", "a"), (4, 0, "", "")]
    rows += [(5, n * 7 - 40, "assistant" if n % 3 else "user", f"turn {n}") for n in range(500)]
    rows += [(6, 0, "assistant", "w " * 60_000)]
    found = {r.conv_id: r for r in chat_rows(spark, tmp_path, rows)}
    expected = plain_chat([*rows, (-7, 0, "user", queries.SAID), (-7, 1, "assistant", queries.SAID)])
    got = {i: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for i, r in found.items()}
    assert got == expected


def test_chat_of_nothing(spark, tmp_path):
    assert [r.conv_id for r in chat_rows(spark, tmp_path, [])] == [-7]


@pytest.mark.parametrize("text", [t for t in NASTY if t is not None])
def test_template_is_reversible(text):
    turn, start, end = chat.template(text, text)
    assert chat.read_turns(turn * 3) == [(text, text)] * 3
    assert chat.unescape(turn[start:end]) == text
    assert turn.count(chat.CLOSE) == 1


def test_foreign_text_is_no_conversation():
    with pytest.raises(ValueError):
        chat.read_turns("### user: a</turn>\nmore")


def test_best_paths_equal_brute_force(spark):
    random.seed(11)
    nodes = []
    for tree in range(12):
        for n in range(random.randint(1, 40)):
            parent = None if n == 0 else tree * 100 + random.choice([n - 1, random.randrange(n)])
            nodes.append((tree, tree * 100 + n, parent, random.choice([None, 0.0, 1.0, 2.5])))
    nodes.append((50, 9000, 8999, 1.0))  # the parent is missing
    up = {node: parent for _, node, parent, _ in nodes}
    score = {node: s or 0.0 for _, node, _, s in nodes}
    paths = defaultdict(list)
    for tree, node, _, _ in nodes:
        if node not in set(up.values()):
            path = [node]
            while up[path[-1]] in up:
                path.append(up[path[-1]])
            paths[tree].append(path[::-1])
    expected = set()
    for tree, found in paths.items():
        found.sort(key=lambda p: (-sum(score[x] for x in p) / len(p), p[-1]))
        for branch, path in enumerate(found[:3]):
            expected |= {(tree, branch, node, place, len(path)) for place, node in enumerate(path)}
    df = spark.createDataFrame(nodes, "tree long, node long, parent long, score double")
    got = [tuple(r) for r in chat.best_paths(df, keep=3).collect()]
    assert len(got) == len(expected) and set(got) == expected
    first = [tuple(r) for r in chat.best_paths(df).collect()]
    assert set(first) == {r for r in expected if r[1] == 0}


def test_branches_become_conversations(spark):
    said = [(1, 10, None, 0.0, "user", "hi"), (1, 11, 10, 1.0, "assistant", "good"), (1, 12, 10, 2.0, "assistant", "better")]
    df = spark.createDataFrame(said, "tree long, node long, parent long, score double, role string, text string")
    paths = chat.best_paths(df.select("tree", "node", "parent", "score"), keep=2).withColumnRenamed("node", "key")
    parts = chat.format_paths(paths, df.withColumnRenamed("node", "key").select("tree", "key", "role", "text"))
    got = {r.branch: chat.read_turns(r.formatted) for r in parts.collect()}
    assert got == {0: [("user", "hi"), ("assistant", "better")], 1: [("user", "hi"), ("assistant", "good")]}


def test_a_circle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(chat, "DEEPEST", 3)
    df = spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0)], "tree long, node long, parent long, score double")
    with pytest.raises(ValueError):
        chat.best_paths(df)


def test_manifest_verifies_every_untouched_row(documents):
    proved = merkle.verify(merkle.manifest(documents))
    assert proved.where("not verified or claimed is not null").count() == 0
    forged = proved.withColumn("claimed", F.sha2(F.lit("x"), 256)).drop("proof", "folded_root", "verified")
    assert merkle.verify(forged).where("verified").count() == 0
