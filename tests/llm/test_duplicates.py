"""Exact, near and partial duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from pulsetrail.llm import common, exact, queries, repeats, simhash
from tests.llm.conftest import AWKWARD


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def least(ids):
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def test_exact_query_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    expected = con.execute(queries.OP8_SQL).fetchall()
    got = queries.op8_exact_dedup(spark, folder)
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_exact_on_awkward_documents(awkward, nothing):
    groups = {}
    for i, t, _ in AWKWARD:
        groups.setdefault(normal(t), []).append(i)
    expected = Counter(
        (i, least(groups[normal(t)]), len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest())
        for i, t, _ in AWKWARD
    )
    rows = exact.mark_duplicates(awkward).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == expected
    kept = [r for r in rows if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact.mark_duplicates(nothing).count() == 0


def test_keep_first_leaves_the_rows_as_they_are(awkward, nothing):
    rows = exact.keep_first(awkward).collect()
    assert rows[0].__fields__ == awkward.columns
    assert len(rows) == len({normal(t) for _, t, _ in AWKWARD})
    assert all(r.row == "row" and r.held == "held" for r in rows)
    assert exact.keep_first(nothing).count() == 0


def test_a_group_of_a_third_of_all_rows(make):
    docs = make([(i, "the same" if i % 3 == 0 else f"own {i}", "en") for i in range(3000)]).repartition(17)
    rows = exact.mark_duplicates(docs).where("group_size > 1").collect()
    assert len(rows) == 1000 and {r.keep_id for r in rows} == {0}
    assert [r.doc_id for r in rows if r.kept] == [0]


def brute_print(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, radius):
    """The least id that each id can reach."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if b < a and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_query_equals_brute_force(spark, folder, texts):
    prints = {i: brute_print(t) for i, t in texts.items()}
    classes = brute_classes(prints, 4)
    rows = queries.op7_simhash(spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", classes[i]) for i in texts
    }


def test_simhash_on_awkward_documents(awkward, nothing):
    rows = simhash.near_documents(awkward).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in rows) == Counter(
        (i, f"{brute_print(t):016x}") for i, t, _ in AWKWARD
    )
    by = {r.fingerprint: r.component_id for r in rows}
    assert by[f"{brute_print(AWKWARD[0][1]):016x}"] == -5
    assert by["0" * 16] == 2
    assert simhash.near_documents(nothing).count() == 0


@pytest.mark.parametrize("tree", [4, 50, 100_000])
def test_links_of_split_shards_connect_the_same(spark, tree):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {}
    for i in range(300):
        fp = rng.choice(centres) if i % 2 else rng.getrandbits(64)
        for _ in range(rng.randrange(5)):
            fp ^= 1 << rng.randrange(64)
        prints[i] = fp
    signed = {i: fp - (1 << 64) if fp >> 63 else fp for i, fp in prints.items()}
    distinct = spark.createDataFrame([(v,) for v in set(signed.values())], "fp long").repartition(3)
    links = [(r.src, r.dst) for r in simhash.near_links(distinct, 4, tree=tree).collect()]
    classes = brute_classes(prints, 4)
    label = {v: v for v in signed.values()}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in links:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 64
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    assert all(
        (find(signed[a]) == find(signed[b])) == (classes[a] == classes[b]) for a in prints for b in prints
    )
    if tree > 300:
        assert len(links) < len(prints) * 15


def test_trees_find_all_neighbours():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**63, (400, 2)).astype(np.uint64)
    fps[200:] = fps[:200] ^ (np.uint64(1) << rng.integers(0, 60, (200, 2)).astype(np.uint64))
    tree = np.sort(rng.integers(0, 5, 400))
    trees = simhash.grow_trees(fps, tree, np.ones(400, bool))
    found = {
        (a, b, d)
        for part in simhash.search(fps, trees, np.arange(400), 50)
        for a, b, d in zip(*(x.tolist() for x in part))
    }
    expected = set()
    for a in range(400):
        for b in range(a):
            d = int(np.bitwise_count(fps[a] ^ fps[b]).sum())
            if tree[a] == tree[b] and d <= 50:
                expected.add((a, b, d))
    assert found == expected


def test_a_pair_counts_in_its_first_shared_band_only():
    rng = np.random.default_rng(4)
    chosen, width = simhash.bands(5000)
    bits = rng.integers(0, 2, (60, simhash.WIDE), dtype=np.uint8)
    bits[30:] = bits[:30] ^ (rng.random((30, simhash.WIDE)) < 0.12)
    fps = np.packbits(bits, axis=1).view(">u8").astype(np.uint64)
    owned = simhash.first_shared(chosen, width)
    a, b, shared = np.arange(30, 60), np.arange(30), 0
    same = (bits[a][:, chosen] == bits[b][:, chosen]).all(axis=2)  # pair by band
    for band in range(len(chosen)):
        shard = np.full(60, band << width) + 3
        for pair in np.flatnonzero(same[:, band]):
            first = int(np.argmax(same[pair]))
            assert owned(shard, fps, a[pair : pair + 1], b[pair : pair + 1])[0] == (band == first)
            shared += 1
    assert shared > 60
    none = np.empty(0, np.int64)
    assert len(owned(np.zeros(60, np.int64), fps, none, none)) == 0


def test_shards_without_a_candidate_are_left_out(spark):
    rows = [(i, [i, 100 + i % 3, 200]) for i in range(50)]
    prints = spark.createDataFrame(rows, "id long, keys array<long>").repartition(4)
    seen = spark.createDataFrame([(7,), (101,), (101,)], "shard long")
    live = simhash._in_shards(prints, seen)
    assert live.columns == ["id", "keys"]
    expected = {i: [k for k in keys if k in (7, 101)] for i, keys in rows}
    assert {r.id: r["keys"] for r in live.collect()} == {i: k for i, k in expected.items() if k}
    assert simhash._in_shards(prints, seen.limit(0)).count() == 0


def test_near_copies_go_and_others_stay(make, nothing):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(60)]
    rows = [(i, " ".join(b), "en") for i, b in enumerate(base)]
    for i, b in enumerate(base[:20]):
        changed = list(b)
        changed[50] = "changed"
        rows.append((100 + i, " ".join(changed), "en"))  # 111 of 121 shingles agree: 0.92
    for i, b in enumerate(base[20:40]):
        rows.append((200 + i, " ".join(b[:60] + [rng.choice(words) for _ in range(60)]), "en"))
    rows += [(300, None, "en"), (301, "", "en"), (None, rows[45][1], "en"), (50, "a second text of 50", "en")]
    kept = simhash.keep_one_of_near(make(rows))
    assert kept.columns == make([]).columns
    ids = [r.doc_id for r in kept.collect()]
    assert not any(i is not None and 100 <= i < 120 for i in ids)
    assert set(range(45)) <= set(i for i in ids if i is not None)
    assert set(range(200, 220)) <= set(i for i in ids if i is not None)
    assert ids.count(50) == 2 and ids.count(None) == 1 and 45 not in ids and 300 in ids
    assert simhash.keep_one_of_near(nothing).count() == 0


@pytest.mark.parametrize("tree", [12, 1024])
def test_near_copies_are_found_behind_refuted_ones(make, monkeypatch, tree):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(6):
        base = [rng.choice(words) for _ in range(110)]
        for _ in range(40):
            copy = list(base)
            for at in rng.sample(range(110), rng.randrange(1, 5)):
                copy[at] = rng.choice(words)
            rows.append((len(rows), " ".join(copy), "en"))
    docs = make(rows).repartition(5)
    prints = simhash.wide_prints(docs.select(simhash.F.col("doc_id").alias("id"), "text")).collect()
    bits = {r.id: ((r.high % 2**64) << 64) | r.low % 2**64 for r in prints}
    keys = {r.id: set(r["keys"]) for r in prints}
    sets = {i: set(simhash.shingles(t.encode(), simhash.SHINGLE)) for i, t, _ in rows}
    label = {i: i for i in sets}
    refuted = 0
    for a in sets:
        for b in range(a):
            if keys[a] & keys[b] and (bits[a] ^ bits[b]).bit_count() <= simhash.WIDE_RADIUS:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    low, high = sorted((label[a], label[b]))
                    label = {i: low if v == high else v for i, v in label.items()}
                else:
                    refuted += 1
    monkeypatch.setattr(simhash.near_pairs, "__defaults__", (simhash.SIMILAR, tree))
    kept = sorted(r.doc_id for r in simhash.keep_one_of_near(docs).collect())
    assert refuted > 500 and kept == sorted(set(label.values()))


@pytest.fixture
def family():
    """180 copies of a text with many changes each: most pairs are less than 0.8 alike, some are more."""
    rng = random.Random(21)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(110)]
    rows = []
    for i in range(180):
        copy = list(base)
        for at in rng.sample(range(110), rng.randrange(1, 5)):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy), "en"))
    return rows


def test_no_table_grows_with_the_square_of_a_family(make, family, monkeypatch):
    counts = {}
    plain_stage = simhash.stage

    def stage(df, label):
        staged = plain_stage(df, label)
        counts[label] = max(counts.get(label, 0), staged.count())
        return staged

    monkeypatch.setattr(simhash, "stage", stage)
    simhash.keep_one_of_near(make(family)).count()
    assert counts["wide-prints"] == 180 and max(counts.values()) <= 12 * len(family), counts


def test_families_in_parts_give_the_links_of_all_pairs(spark, make, family):
    ids = [i for i, _, _ in family]
    sets = {i: set(simhash.shingles(t.encode(), simhash.SHINGLE)) for i, t, _ in family}
    label = {i: i for i in ids}
    for a in ids:
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {i: low if v == high else v for i, v in label.items()}
    sizes = spark.createDataFrame([(i, len(sets[i]), 0) for i in ids], "id long, size long, family long")
    docs = make(family).selectExpr("doc_id as id", "text")
    for most, shingled in ((1024, 1 << 22), (50, 1 << 22), (1024, 4000)):
        blocks = simhash._dealt(docs, sizes, most, shingled).collect()
        parts = -(-len(ids) // most) if most < 1024 else -(-sum(map(len, sets.values())) // shingled)
        assert len(blocks) == parts * len(ids)
        held, links = {}, []
        for r in blocks:
            digests = np.array(sorted(hash(s) % 2**64 for s in sets[r.id]), np.uint64)
            held.setdefault((r.lo, r.hi), []).append((r.id, r.side, digests))
        for (lo, hi), rows in held.items():
            one, side, digests = zip(*rows)
            links += simhash.link_block(np.array(one), np.array(side), list(digests), 0.8, lo != hi)
        found = {i: i for i in ids}
        for a, b in links:
            low, high = sorted((found[a], found[b]))
            found = {i: low if v == high else v for i, v in found.items()}
        assert found == label and len(set(label.values())) > 1


def test_near_copies_with_other_repeats_of_a_line_go(make):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(30):
        base = [rng.choice(words) for _ in range(200)]
        line = [rng.choice(words) for _ in range(20)]
        rows.append((i, " ".join(base + line), "en"))
        rows.append((100 + i, " ".join(base + line * 20), "en"))
        one, other = (set(simhash.shingles(t.encode(), simhash.SHINGLE)) for _, t, _ in rows[-2:])
        assert len(one & other) >= 0.9 * len(one | other)
    kept = {r.doc_id for r in simhash.keep_one_of_near(make(rows)).collect()}
    assert kept == set(range(30))


def brute_repeats(docs, window):
    """``docs`` in order; distinct rows of equal id and text count once."""
    seen, out = set(), {}
    for key, data in docs:
        removed = bytearray(len(data))
        for p in range(len(data) - window + 1):
            part = data[p : p + window]
            if part in seen:
                removed[p : p + window] = b"\1" * window
            else:
                seen.add(part)
        kept = bytes(c for c, r in zip(data, removed) if not r)
        spans = sum(1 for j, r in enumerate(removed) if r and (j == 0 or not removed[j - 1]))
        out[key] = (len(data), sum(removed), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_query_equals_brute_force(spark, folder, texts):
    expected = brute_repeats([(i, texts[i].encode()) for i in sorted(texts)], 100)
    rows = queries.op4_repeats(spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected
    assert any(e[1] for e in expected.values())


@pytest.mark.parametrize("window", [8, 21])
def test_repeats_in_dense_texts(make, window):
    rng = random.Random(window)
    shared = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(5)]
    rows = []
    for i in range(120):
        parts = [rng.choice(shared)[rng.randrange(30) :] if rng.random() < 0.6 else
                 "".join(rng.choice("abcdé") for _ in range(25)) for _ in range(4)]
        rows.append((i, "".join(parts), "en"))
    rows += [(500, "z" * 300, "en"), (501, "z" * 40, "en")]
    docs = make(rows).repartition(9)
    got = {r.doc_id: tuple(r)[1:] for r in repeats.remove_repeats(docs, window).collect()}
    assert got == brute_repeats([(i, t.encode()) for i, t, _ in rows], window)


def test_repeats_on_awkward_documents(awkward, nothing):
    rows = repeats.remove_repeats(awkward, 20, keep_bytes=True).collect()
    assert len(rows) == len(AWKWARD)
    whole = {(i, len((t or "").encode())) for i, t, _ in AWKWARD}
    assert {(r.doc_id, r.n_bytes) for r in rows} == whole
    for r in rows:
        assert r.n_bytes - r.n_removed == len(r.kept)
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[-5][0].n_removed == 0
    assert {r.n_removed for r in by[1] if r.n_bytes == len(AWKWARD[0][1])} == {len(AWKWARD[0][1])}
    assert (by[8][0].n_removed, by[8][0].n_spans) == (99_999, 1)
    assert repeats.remove_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(nothing, 7)


def test_bitmap_has_no_false_negatives(spark):
    ids = spark.range(0, 5000, 7)
    bitmap = common.bitmap_of(ids)
    rows = spark.range(5000).select("id", common.may_have(common.F.col("id"), bitmap).alias("may")).collect()
    assert all(r.may for r in rows if r.id % 7 == 0)
    assert sum(r.may for r in rows if r.id % 7) < 50
