"""Entity graphs as two DataFrames: ``vertices(id, ...)`` and ``edges(src, dst, ...)``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.joins import lookup_join
from pulsetrail.operators.ordering import dense_index
from pulsetrail.session import discard, stage


@dataclass(frozen=True)
class Relation:
    """A table that links two kinds of entity, one link per row."""

    table: DataFrame
    src: str
    src_type: str
    dst: str
    dst_type: str
    name: str


# ---------------------------------------------------------------- building a graph


def typed_vertices(relations: Sequence[Relation]) -> DataFrame:
    """Distinct ``(type, value)`` of all ends of all relations; one value may have several types."""
    ends = [
        r.table.select(F.lit(kind).alias("type"), F.col(column).cast("string").alias("value"))
        for r in relations
        for column, kind in ((r.src, r.src_type), (r.dst, r.dst_type))
    ]
    return reduce(DataFrame.unionByName, ends).where("value is not null").distinct()


def typed_edges(relations: Sequence[Relation]) -> DataFrame:
    """Distinct ``(src_type, src_value, dst_type, dst_value, relation)``."""
    links = [
        r.table.select(
            F.lit(r.src_type).alias("src_type"),
            F.col(r.src).cast("string").alias("src_value"),
            F.lit(r.dst_type).alias("dst_type"),
            F.col(r.dst).cast("string").alias("dst_value"),
            F.lit(r.name).alias("relation"),
        )
        for r in relations
    ]
    every = reduce(DataFrame.unionByName, links)
    return every.where("src_value is not null and dst_value is not null").distinct()


def index_vertices(vertices: DataFrame) -> DataFrame:
    """Give each ``(type, value)`` a dense id in the order of type and value."""
    return dense_index(vertices, ["type", "value"], "id")


def resolve_edges(edges: DataFrame, index: DataFrame) -> DataFrame:
    """Replace the typed ends of ``edges`` by vertex ids: ``(src, dst, relation)``."""
    edges = stage(edges, "typed-edges")
    for end in ("src", "dst"):
        ids = index.select(
            F.col("type").alias(f"{end}_type"),
            F.col("value").alias(f"{end}_value"),
            F.col("id").alias(end),
        )
        edges = lookup_join(edges, ids, [f"{end}_type", f"{end}_value"], "inner")
    return edges.select("src", "dst", "relation")


def pairs_of(edges: DataFrame) -> DataFrame:
    """Each pair of linked vertices once, the smaller id first; loops stay."""
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    return edges.select(low.alias("src"), high.alias("dst")).distinct()


def undirected(edges: DataFrame) -> DataFrame:
    """Each link once as ``src < dst``; direction, repeats and loops are dropped."""
    return pairs_of(edges.where("src <> dst"))


def _all_ids(vertices: DataFrame | None, pairs: DataFrame) -> DataFrame:
    """The ids of the given vertices and of all ends."""
    ends = both_ways(pairs).select(F.col("src").alias("id"))
    every = ends if vertices is None else ends.unionByName(vertices.select("id"))
    return every.distinct()


def both_ways(edges: DataFrame) -> DataFrame:
    """Each undirected link in both directions."""
    once = edges.select("src", "dst")
    return once.unionByName(once.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def degrees(edges: DataFrame) -> DataFrame:
    """``(id, degree)`` of the vertices that occur in undirected edges."""
    ends = both_ways(edges)
    return ends.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))


# ---------------------------------------------------------------- connected components


def _settled(links: DataFrame) -> DataFrame:
    """The links whose ``src`` has no other link: it can only get the label of its ``dst``."""
    single = links.groupBy("src").agg(F.min("dst").alias("dst"), F.count("*").alias("n"))
    used = links.select(F.col("dst").alias("src")).distinct()
    return single.where("n = 1").drop("n").join(used, "src", "left_anti")


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every vertex to the smallest of its neighbours and itself."""
    facing = both_ways(links)
    lowest = facing.groupBy("src").agg(F.min("dst").alias("low"))
    lowest = lowest.select("src", F.least("src", "low").alias("low"))
    joined = lookup_join(facing, lowest, "src", "inner").where("dst > src")
    return joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link every vertex and its smaller neighbours to the smallest of those neighbours."""
    lowest = links.groupBy("src").agg(F.min("dst").alias("low"))
    joined = lookup_join(links, lowest, "src", "inner")
    moved = joined.where("dst > low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    own = lowest.select("src", F.col("low").alias("dst"))
    return moved.unionByName(own).distinct()


def connected_components(vertices: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``(id, component)``: the component is the smallest id in it.

    Alternates large-star and small-star steps (Kiveris et al., 2014), which reach a star per
    component in a number of rounds that grows with the square of the logarithm of the size, however
    long the paths are. After each round the vertices that hang on a single smaller neighbour are set
    aside, as they can only get its label; later rounds work on what is left, so finished components
    and the leaves of hubs are not shuffled again. In the end the labels are handed back from the
    last round to the first. Every step is a partial aggregation plus a look-up, whose hub vertices
    adaptive execution takes apart, and every round is staged in the shared folder. Vertices that occur
    only in ``edges`` are included, and so are vertices without an edge.
    """
    pairs = stage(pairs_of(edges), "pairs")
    links = pairs.where("src <> dst")
    left, rounds = links.count(), []
    while left:
        half = stage(_large_star(links), "large-star")
        moved = stage(_small_star(half), "small-star")
        settled = _settled(moved).select("src", F.lit(True).alias("settled"))
        marked = stage(lookup_join(moved, settled, "src"), "marked")
        discard(half)
        discard(moved)
        rounds.append(marked.where("settled").select("src", "dst"))
        links = marked.where("settled is null").select("src", "dst")
        left = links.count()

    labels = pairs.where("false").select(F.col("src").alias("id"), F.col("dst").alias("component"))
    while rounds:
        settled = rounds.pop()
        above = labels.select(F.col("id").alias("dst"), "component")
        found = lookup_join(settled, above, "dst")
        found = found.select(F.col("src").alias("id"), F.coalesce("component", "dst").alias("component"))
        labels = stage(labels.unionByName(found), "labels")
    return _all_ids(vertices, pairs).join(labels, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def extend_components(labels: DataFrame, edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` of yesterday's ``labels`` with today's ``edges`` (and vertices without any).

    Each end of a new edge is replaced by the component it had, so all that was connected before is a
    single vertex, and the rounds work on as many links as there are new ones between different
    components, not on the whole graph. A new label is the smallest id again. Only labels of
    components that grew change; yesterday's labels are looked up, never run through again. Edges that
    were known already, and edges inside a component, change nothing.
    """
    fresh = stage(edges.select("src", "dst").where("src is not null and dst is not null"), "fresh")
    known = labels.select("id", "component")

    def contracted(df: DataFrame, end: str) -> DataFrame:
        own = known.select(F.col("id").alias(end), F.col("component").alias("_c"))
        return lookup_join(df, own, end).withColumn(end, F.coalesce("_c", end)).drop("_c")

    links = contracted(contracted(fresh, "src"), "dst").where("src <> dst").distinct()
    merged = stage(connected_components(None, stage(links, "contracted")), "merged")
    grown = merged.select(F.col("id").alias("component"), F.col("component").alias("_new"))
    kept = lookup_join(known, grown, "component").select("id", F.coalesce("_new", "component").alias("component"))
    ends = fresh.select(F.explode(F.array("src", "dst")).alias("id"))
    if vertices is not None:
        ends = ends.unionByName(vertices.select("id"))
    new = ends.distinct().join(known.select("id"), "id", "left_anti")
    found = lookup_join(new, merged, "id").select("id", F.coalesce("component", "id").alias("component"))
    return kept.unionByName(found)


def component_members(index: DataFrame, components: DataFrame) -> DataFrame:
    """``(value, type, component)`` of every indexed vertex."""
    return index.join(components, "id").select("value", "type", "component")


# ---------------------------------------------------------------- triangles


CORNER_ARCS = 2048  # of a vertex in one part, so a key makes about four million pairs


def corner_pairs(arcs: DataFrame, most: int = CORNER_ARCS) -> DataFrame:
    """``(a, one, two, b, c)`` with b < c: the pairs of ends of the arcs ``(low, high)`` that leave ``a``.

    The arcs of a vertex with more than ``most`` are dealt to parts by a hash of their end, and every
    part meets every part under a key of its own, so the pairs of one vertex are made by as many tasks
    as there are pairs of parts. Only crowded vertices are copied, an arc once for each part of its vertex.
    """
    leaving = arcs.groupBy("low").agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    parts = leaving.select("low", F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    dealt = lookup_join(arcs, parts, "low").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    own = F.pmod(F.xxhash64("high"), F.col("_parts")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    first = dealt.select(F.col("low").alias("a"), own.alias("one"), others.alias("two"), F.col("high").alias("b"))
    second = dealt.select(F.col("low").alias("a"), others.alias("one"), own.alias("two"), F.col("high").alias("c"))
    return first.join(second, ["a", "one", "two"]).where("b < c")


def _corners(closed: DataFrame) -> DataFrame:
    """``(id, n)``: what the triangles of ``(a, b, cs)``, one for each of ``cs``, add to their corners."""
    def corner(vertex: Column, n: Column) -> Column:
        return F.struct(vertex.alias("id"), n.cast("long").alias("n"))

    ends = F.array(*[corner(F.col(v), F.size("cs")) for v in ("a", "b")])
    others = F.transform("cs", lambda c: corner(c, F.lit(1)))
    return closed.select(F.explode(F.concat(ends, others)).alias("c")).select("c.id", "c.n")


def triangle_count(
    vertices: DataFrame | None, edges: DataFrame, most: int = CORNER_ARCS
) -> DataFrame:
    """``(id, triangles)`` per vertex, 0 included; direction, repeats and loops do not count.

    Every edge points from the end with fewer neighbours to the end with more (ties by id). A vertex
    then has at most sqrt(2 * edges) outgoing edges, and a hub next to none, so what has to be closed
    stays bounded whatever the degree of the hubs. The ends of a vertex are a list in that order; each
    of them is sent the rest of the list after it, and what its own list has in common closes. Only
    vertices with more than ``most`` outgoing edges have a row for each pair: their own pairs are made in
    parts (``corner_pairs``), and the lists sent to them are taken apart and meet their edges one by one.
    """
    pairs = stage(pairs_of(edges), "pairs")
    once = pairs.where("src <> dst")
    degree = stage(degrees(once), "degrees")
    for end in ("src", "dst"):
        named = degree.select(F.col("id").alias(end), F.col("degree").alias(f"{end}_degree"))
        once = lookup_join(once, named, end, "inner")
    ends = [F.struct(F.col(f"{end}_degree").alias("degree"), F.col(end).alias("id")) for end in ("src", "dst")]
    arcs = once.select(F.least(*ends)["id"].alias("low"), F.greatest(*ends).alias("high"))
    tops = F.transform(F.sort_array(F.collect_list("high")), lambda high: high["id"])
    fans = stage(arcs.groupBy("low").agg(tops.alias("tops")), "fans")

    small = fans.where(F.size("tops") <= most)
    spokes = small.select(F.col("low").alias("a"), "tops", F.posexplode("tops").alias("_i", "b"))
    spokes = spokes.where(F.col("_i") < F.size("tops") - 1).select(
        "b", "a", F.slice("tops", F.col("_i") + 2, F.size("tops")).alias("rest")
    )
    met = lookup_join(spokes, small.select(F.col("low").alias("b"), "tops"), "b", "inner")
    closed = met.select("a", "b", F.array_intersect("rest", "tops").alias("cs")).where(F.size("cs") > 0)
    crowded = stage(fans.where(F.size("tops") > most).select(F.col("low").alias("b"), "tops"), "crowded")
    if not crowded.isEmpty():
        many = crowded.select(F.col("b"), F.explode("tops").alias("c"))
        taken = lookup_join(spokes, crowded.select("b"), "b", "left_semi")
        taken = taken.select("a", "b", F.explode("rest").alias("c")).join(many, ["b", "c"])
        closing = pairs.select(F.col("src").alias("b"), F.col("dst").alias("c")).where("b < c")
        own = corner_pairs(many.select(F.col("b").alias("low"), F.col("c").alias("high")), most)
        for rows in (taken, own.join(closing, ["b", "c"])):
            closed = closed.unionByName(rows.select("a", "b", F.array("c").alias("cs")))

    ids = [degree.select("id"), pairs.where("src <=> dst").select(F.col("src").alias("id"))]
    ids += [] if vertices is None else [vertices.select("id")]
    none = reduce(DataFrame.unionByName, ids).select("id", F.lit(0).cast("long").alias("n"))
    return _corners(closed).unionByName(none).groupBy("id").agg(F.sum("n").alias("triangles"))


# ---------------------------------------------------------------- triplets and messages


def map_vertices(vertices: DataFrame, **columns: Column) -> DataFrame:
    """Replace or add vertex attributes."""
    return vertices.withColumns(columns)


def triplets(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Every edge with the attributes of its ends, as ``src_<name>`` and ``dst_<name>``."""
    joined = edges
    attributes = [c for c in vertices.columns if c != "id"]
    for end in ("src", "dst"):
        named = vertices.select(
            F.col("id").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in attributes]
        )
        joined = lookup_join(joined, named, end, "inner")
    return joined


def neighbour_agg(
    vertices: DataFrame, edges: DataFrame, where: Column | str, **aggregates: Column
) -> DataFrame:
    """Aggregate the attributes of the sources per destination, over the edges that pass ``where``."""
    kept = triplets(vertices, edges).where(where)
    return kept.groupBy(F.col("dst").alias("id")).agg(
        *[expr.alias(name) for name, expr in aggregates.items()]
    )


def message_loop(
    vertices: DataFrame,
    edges: DataFrame,
    to_dst: Callable[[Callable[[str], Column], Callable[[str], Column]], tuple[Column, Column]] | None,
    to_src: Callable[[Callable[[str], Column], Callable[[str], Column]], tuple[Column, Column]] | None,
    merge: Callable[[str], Column],
    apply: dict[str, Column],
    max_rounds: int | None = None,
    complete: bool = True,
) -> DataFrame:
    """Rounds of messages along the edges until none is sent.

    With ``max_rounds`` the loop ends after so many rounds at the latest. If messages are left then,
    that is an error, unless ``complete`` is false: then the state so far is the result.

    ``to_dst`` and ``to_src`` get two functions that name an attribute of the source and of the
    destination, and return ``(condition, message)``. ``merge`` turns the column name of the messages
    of one vertex into an aggregate, and ``apply`` computes the new attributes of a vertex from its
    old ones and the merged ``msg``. Each round is one triplet look-up, one aggregation with map-side
    merging, and one staged vertex table.
    """
    edges = stage(edges.select("src", "dst").distinct(), "message-edges")
    state = stage(vertices, "state")

    def src(name: str) -> Column:
        return F.col(f"src_{name}")

    def dst(name: str) -> Column:
        return F.col(f"dst_{name}")

    for done in count():
        facing = triplets(state, edges)
        sent = []
        for target, rule in (("dst", to_dst), ("src", to_src)):
            if rule is not None:
                condition, message = rule(src, dst)
                sent.append(F.when(condition, F.struct(F.col(target).alias("id"), message.alias("msg"))))
        mail = facing.select(F.explode(F.array(*sent)).alias("mail")).where("mail is not null")
        merged = mail.select("mail.*").groupBy("id").agg(merge("msg").alias("msg"))
        merged = stage(merged, "messages")
        if merged.isEmpty() or done == max_rounds and not complete:
            discard(merged)
            return state
        if done == max_rounds:
            raise RuntimeError(f"messages are left after {max_rounds} rounds")
        marked = merged.withColumn("_got", F.lit(True))
        joined = state.join(marked, "id", "left")
        changed = [
            F.when(F.col("_got"), apply[c]).otherwise(F.col(c)).alias(c) if c in apply else F.col(c)
            for c in state.columns
        ]
        renewed = stage(joined.select(*changed), "state")
        discard(merged)
        discard(state)
        state = renewed


# ---------------------------------------------------------------- exact n-hop neighbours


def _hops_from(start: DataFrame, facing: DataFrame, n: int) -> DataFrame:
    """Level by level from given vertices; a level is compared with the two before it."""
    step = facing.select(F.col("src").alias("reached"), F.col("dst").alias("next"))
    levels = [start.select("id", F.col("id").alias("reached")).distinct()]
    for _ in range(n):
        fresh = levels[-1].join(step, "reached").select("id", F.col("next").alias("reached")).distinct()
        for known in levels[-2:]:
            fresh = fresh.join(known, ["id", "reached"], "left_anti")
        levels.append(stage(fresh, "level"))
    return levels[n]


def exact_hops(edges: DataFrame, n: int, start: DataFrame | None = None) -> DataFrame:
    """``(id, reached)``: the pairs of vertices whose undirected distance is exactly ``n``.

    A vertex with a single neighbour is never inside a shortest path, so the search runs only between
    the other vertices, and the single-neighbour ones are added to its result at the end: their
    distance is that of their neighbour plus one. A hub with millions of such leaves thus costs
    nothing in the search. In an undirected graph a neighbour of a vertex at distance d is at
    distance d - 1, d or d + 1, so each round compares with the last two rounds only.

    Pairs of all vertices can grow with the square of a hub's degree. With ``start``, a table of
    ``id``, only the pairs that begin at these vertices are searched.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    once = stage(undirected(edges), "undirected")
    facing = stage(both_ways(once), "facing")
    if start is not None:
        return _hops_from(start, facing, n)
    if n == 1:
        return facing.select(F.col("src").alias("id"), F.col("dst").alias("reached"))

    degree = degrees(once)
    inner = stage(degree.where("degree > 1").select("id"), "inner")
    by_src = inner.select(F.col("id").alias("src"))
    by_dst = inner.select(F.col("id").alias("dst"))
    core = stage(facing.join(by_src, "src", "left_semi").join(by_dst, "dst", "left_semi"), "core")
    leaves = facing.join(by_src, "src", "left_anti").join(by_dst, "dst", "left_semi")
    leaves = stage(leaves.select(F.col("src").alias("leaf"), F.col("dst").alias("anchor")), "leaves")

    start = inner.select("id", F.col("id").alias("reached"))
    levels = [start, core.select(F.col("src").alias("id"), F.col("dst").alias("reached"))]
    step = core.select(F.col("src").alias("reached"), F.col("dst").alias("next"))
    for _ in range(2, n + 1):
        front = levels[-1].join(step, "reached").select("id", F.col("next").alias("reached"))
        fresh = front.distinct()
        for known in levels[-2:]:
            fresh = fresh.join(known, ["id", "reached"], "left_anti")
        levels.append(stage(fresh, "level"))

    def from_leaf(pairs: DataFrame) -> DataFrame:
        named = leaves.withColumnRenamed("anchor", "id")
        return pairs.join(named, "id").select(F.col("leaf").alias("id"), "reached")

    def to_leaf(pairs: DataFrame) -> DataFrame:
        named = leaves.withColumnRenamed("anchor", "reached")
        return pairs.join(named, "reached").select("id", F.col("leaf").alias("reached"))

    result = levels[n]
    for part in (from_leaf(levels[n - 1]), to_leaf(levels[n - 1])):
        result = result.unionByName(part)
    return result.unionByName(to_leaf(from_leaf(levels[n - 2])).where("id <> reached"))
