import collections
import random

from functools import partial

import pytest
from pyspark.sql import functions as F

from pulsetrail.operators import graph, joins

LINKS = [(3, 7), (5, 3), (2, 5), (5, 7), (4, 10), (5, 0), (0, 2)]


def edges(spark, links):
    return spark.createDataFrame(links, "src long, dst long")


def neighbours(links):
    near = collections.defaultdict(set)
    for a, b in links:
        near[a], near[b]
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return near


def distances(links):
    near = neighbours(links)
    found = {}
    for start in near:
        seen, queue = {start: 0}, collections.deque([start])
        while queue:
            here = queue.popleft()
            for there in near[here] - seen.keys():
                seen[there] = seen[here] + 1
                queue.append(there)
        found[start] = seen
    return found


def random_links(seed):
    draw = random.Random(seed)
    links = [(draw.randrange(30), draw.randrange(30)) for _ in range(24)]
    path = [(100 + i, 101 + i) for i in range(20)]
    hub = [(50, 200 + i) for i in range(15)] + [(200, 201), (201, 202)]
    return links + path + hub


def test_components_of_the_small_graph(spark, rows):
    found = rows(graph.connected_components(None, edges(spark, LINKS)))
    assert found == [(0, 0), (10, 4), (2, 0), (3, 0), (4, 4), (5, 0), (7, 0)]


def test_components_keep_lone_vertices(spark, rows):
    vertices = spark.createDataFrame([(1,), (9,)], "id long")
    found = rows(graph.connected_components(vertices, edges(spark, [(1, 2), (3, 3)])))
    assert found == [(1, 1), (2, 1), (3, 3), (9, 9)]


def test_components_without_edges(spark, rows):
    vertices = spark.createDataFrame([(1,), (9,)], "id long")
    assert rows(graph.connected_components(vertices, edges(spark, []))) == [(1, 1), (9, 9)]


def test_triangles_of_the_small_graph(spark):
    found = dict(map(tuple, graph.triangle_count(None, edges(spark, LINKS)).collect()))
    assert found == {5: 2, 3: 1, 7: 1, 2: 1, 0: 1, 4: 0, 10: 0}


def test_pairs_of_a_crowded_vertex_are_made_in_even_parts(spark):
    """Nearly all pairs are those of one vertex with 2000 arcs; no key makes twice the median."""
    arcs = spark.range(2000).selectExpr("0L as low", "id + 1 as high")
    arcs = arcs.unionByName(spark.range(50).selectExpr("5000 + id % 5 as low", "6000 + id as high"))
    whole = graph.corner_pairs(arcs, 10_000).select("a", "b", "c")
    parted = graph.corner_pairs(arcs, 100)
    assert parted.count() == whole.count() == 2000 * 1999 // 2 + 5 * 45
    assert parted.select("a", "b", "c").distinct().count() == whole.count()
    hot = parted.where("a = 0").groupBy("one", "two").count()
    made = [r["count"] for r in hot.collect()]
    assert len(made) == 400
    assert max(made) < 2 * sorted(made)[200]


@pytest.mark.parametrize("most", [1, 3])
def test_triangles_in_parts_equal_brute_force(spark, most):
    links = random_links(7) + [(60, 300 + i) for i in range(12)] + [(300 + i, 300 + j) for i in range(12) for j in range(i)]
    near = neighbours(links)
    found = dict(map(tuple, graph.triangle_count(None, edges(spark, links), most).collect()))
    assert found == {v: sum(b in near[a] for a in near[v] for b in near[v] if a < b) for v in near}


def test_triangles_send_lists_and_no_pairs(spark, monkeypatch):
    """A vertex with few edges sends lists; crowded ones have their pairs, and loops and nulls are vertices."""
    monkeypatch.setattr(graph, "corner_pairs", None)
    links = [(1, 2), (2, 1), (2, 3), (3, 1), (3, 4), (7, 7), (None, 9), (None, None)]
    found = graph.triangle_count(spark.createDataFrame([(4,), (11,), (11,)], "id long"), edges(spark, links))
    assert dict(map(tuple, found.collect())) == {1: 1, 2: 1, 3: 1, 4: 0, 7: 0, 9: 0, 11: 0, None: 0}
    assert found.schema.simpleString() == "struct<id:bigint,triangles:bigint>"


def test_exact_hops_of_the_small_graph(spark, rows):
    found = rows(graph.exact_hops(edges(spark, [*LINKS, (7, 16)]), 3))
    assert found == [(0, 16), (16, 0), (16, 2), (2, 16)]


@pytest.mark.parametrize("hot_rows", [1000, 4])
def test_random_graph(spark, rows, monkeypatch, hot_rows):
    """Brute force agrees, also when hubs are spread by hand."""
    spread = partial(joins.lookup_join, hot_rows=hot_rows)
    monkeypatch.setattr(graph, "lookup_join", spread)
    links = random_links(hot_rows)
    df, near, far = edges(spark, links), neighbours(links), distances(links)
    components = rows(graph.connected_components(None, df))
    assert components == sorted(((v, min(far[v])) for v in near), key=repr)
    triangles = dict(map(tuple, graph.triangle_count(None, df).collect()))
    assert triangles == {
        v: sum(b in near[a] for a in near[v] for b in near[v] if a < b) for v in near
    }
    for n in (1, 2, 3, 4):
        expected = [(v, w) for v in near for w, d in far[v].items() if d == n]
        assert rows(graph.exact_hops(df, n)) == sorted(expected, key=repr)


def test_message_loop_stops_at_max_rounds(spark):
    """After k rounds an id has travelled k links."""
    path = edges(spark, [(i, i + 1) for i in range(6)])
    vertices = spark.createDataFrame([(i, i) for i in range(7)], "id long, label long")
    state = graph.message_loop(
        vertices,
        path,
        to_dst=lambda src, dst: (src("label") < dst("label"), src("label")),
        to_src=None,
        merge=F.min,
        apply={"label": F.least("label", "msg")},
        max_rounds=2,
        complete=False,
    )
    assert dict(map(tuple, state.collect())) == {i: max(0, i - 2) for i in range(7)}


def test_neighbour_average_counts_larger_sources_only(spark, rows):
    vertices = spark.createDataFrame([(1, 10.0), (2, 4.0), (3, 6.0)], "id long, age double")
    found = graph.neighbour_agg(
        vertices,
        edges(spark, [(1, 2), (3, 2), (2, 1), (2, 3)]),
        "src_age > dst_age",
        older=F.count("*"),
        mean=F.avg("src_age"),
    )
    assert rows(found) == [(2, 2, 8.0)]


def test_same_value_of_two_types_is_two_vertices(spark, rows):
    table = spark.createDataFrame([("7", "7"), ("8", "7")], "uid string, mobile string")
    links = [graph.Relation(table, "mobile", "mobile", "uid", "uid", "mobile_conn")]
    index = graph.index_vertices(graph.typed_vertices(links))
    assert rows(index) == [("mobile", "7", 0), ("uid", "7", 1), ("uid", "8", 2)]
    assert rows(graph.resolve_edges(graph.typed_edges(links), index)) == [
        (0, 1, "mobile_conn"),
        (0, 2, "mobile_conn"),
    ]


def chain(spark, n):
    return edges(spark, [(i, i + 1) for i in range(n)])


def spread_least(links, **options):
    vertices = links.selectExpr("explode(array(src, dst)) as id").distinct().selectExpr("id", "id as label")
    return graph.message_loop(
        vertices,
        links,
        to_dst=lambda src, dst: (src("label") < dst("label"), src("label")),
        to_src=None,
        merge=F.min,
        apply={"label": F.least("label", "msg")},
        **options,
    )


def test_message_loop_ends_when_no_message_is_left_or_says_so(spark):
    links = chain(spark, 6)
    assert {r["label"] for r in spread_least(links).collect()} == {0}
    assert {r["label"] for r in spread_least(links, max_rounds=6).collect()} == {0}
    with pytest.raises(RuntimeError):
        spread_least(links, max_rounds=2)
    assert len({r["label"] for r in spread_least(links, max_rounds=2, complete=False).collect()}) > 1


def test_hops_from_some_vertices(spark, rows):
    links = edges(spark, [*LINKS, (7, 16)])
    start = spark.createDataFrame([(16,), (2,)], "id long")
    for n in (1, 2, 3):
        every = rows(graph.exact_hops(links, n))
        assert rows(graph.exact_hops(links, n, start)) == [r for r in every if r[0] in (2, 16)]


@pytest.mark.parametrize("seed", range(4))
def test_components_of_the_next_day_equal_those_from_scratch(spark, rows, seed):
    random.seed(seed)
    links = [(random.randrange(60), random.randrange(60)) for _ in range(45)]
    cut = (0, 20, 45, 30)[seed]
    day_one = graph.connected_components(None, edges(spark, links[:cut]))
    alone = spark.createDataFrame([(100,), (links[0][0],)], "id long")
    got = graph.extend_components(day_one, edges(spark, links[cut:]), alone)
    assert rows(got) == rows(graph.connected_components(alone, edges(spark, links)))


def test_edges_inside_a_component_start_no_round(spark, rows, monkeypatch):
    day_one = graph.connected_components(None, edges(spark, LINKS)).cache()
    before = rows(day_one)
    monkeypatch.setattr(graph, "_large_star", lambda links: pytest.fail("a round was run"))
    assert rows(graph.extend_components(day_one, edges(spark, [(7, 0), (2, 3), (10, 4)]))) == before
