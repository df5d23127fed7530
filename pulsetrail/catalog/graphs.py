"""Graphs built from whole tables.

The *place graph* links customers to their nation and orders to their customer; it has one component
per nation. The *trade graph* links the order, the part and the supplier of every line. The *region
graph* links customers and suppliers to nations, and nations to regions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.catalog.registry import query, table
from pulsetrail.operators import graph
from pulsetrail.operators.graph import Relation
from pulsetrail.plans.identity import group_members
from pulsetrail.session import stage

VERTICES_SQL = """select 'customer' as type, cast(c_custkey as varchar) as value from customer
union select 'nation', cast(c_nationkey as varchar) from customer
union select 'customer', cast(o_custkey as varchar) from orders
union select 'order', cast(o_orderkey as varchar) from orders"""

EDGES_SQL = """select 'customer' as src_type, cast(c_custkey as varchar) as src_value,
       'nation' as dst_type, cast(c_nationkey as varchar) as dst_value, 'lives_in' as relation
from customer
union select 'order', cast(o_orderkey as varchar), 'customer', cast(o_custkey as varchar), 'placed_by'
from orders"""

INDEX_SQL = f"select type, value, row_number() over (order by type, value) - 1 as id from ({VERTICES_SQL})"

LINKS_SQL = f"""select s.id as src, d.id as dst, relation from ({EDGES_SQL}) e
join idx s on s.type = e.src_type and s.value = e.src_value
join idx d on d.type = e.dst_type and d.value = e.dst_value"""

COMPONENTS_SQL = f"""with recursive idx as materialized ({INDEX_SQL}),
links as materialized ({LINKS_SQL}),
two as materialized (select src, dst from links union select dst, src from links),
spread(id, label, round) using key (id) as (
    select id, id, 0 from idx
    union
    select * from (
        select two.dst as id, min(f.label) as label, max(f.round) + 1 as round
        from spread f join two on two.src = f.id group by two.dst) n
    where n.label < (select r.label from recurring.spread r where r.id = n.id))
"""


def relations(spark: SparkSession, folder: str) -> list[Relation]:
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders")
    return [
        Relation(customers, "c_custkey", "customer", "c_nationkey", "nation", "lives_in"),
        Relation(orders, "o_orderkey", "order", "o_custkey", "customer", "placed_by"),
    ]


def place_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    links = relations(spark, folder)
    index = stage(graph.index_vertices(graph.typed_vertices(links)), "vertex-index")
    return index, stage(graph.resolve_edges(graph.typed_edges(links), index), "links")


@query("typed_vertices", VERTICES_SQL)
def typed_vertices(spark: SparkSession, folder: str) -> DataFrame:
    return graph.typed_vertices(relations(spark, folder))


@query("dense_index", INDEX_SQL)
def dense_index(spark: SparkSession, folder: str) -> DataFrame:
    return graph.index_vertices(graph.typed_vertices(relations(spark, folder)))


@query("typed_edges", f"with idx as ({INDEX_SQL}) {LINKS_SQL}")
def typed_edges(spark: SparkSession, folder: str) -> DataFrame:
    return place_graph(spark, folder)[1]


@query("components", f"{COMPONENTS_SQL} select id, label as component from spread")
def components(spark: SparkSession, folder: str) -> DataFrame:
    return graph.connected_components(*place_graph(spark, folder))


@query("components_next_day", f"{COMPONENTS_SQL} select id, label as component from spread")
def components_next_day(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the links and their vertices arrive a day later: the labels equal those from scratch."""
    index, links = place_graph(spark, folder)
    links = stage(links, "links")
    late = F.pmod(F.xxhash64("src", "dst"), F.lit(3)) == 0
    early = links.where(~late)
    seen = early.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    first = stage(graph.connected_components(seen, early), "first-day")
    return graph.extend_components(first, links.where(late), index.select("id"))


@query(
    "component_members",
    f"{COMPONENTS_SQL} select value, type, label as component from spread join idx using (id)",
)
def component_members(spark: SparkSession, folder: str) -> DataFrame:
    return group_members(relations(spark, folder))


@query("message_loop", f"{COMPONENTS_SQL} select id, label from spread")
def message_loop(spark: SparkSession, folder: str) -> DataFrame:
    """The smallest id spreads along the links in both directions."""
    index, links = place_graph(spark, folder)
    vertices = graph.map_vertices(index.select("id"), label=F.col("id"))
    return graph.message_loop(
        vertices,
        links,
        to_dst=lambda src, dst: (src("label") < dst("label"), src("label")),
        to_src=lambda src, dst: (dst("label") < src("label"), dst("label")),
        merge=F.min,
        apply={"label": F.least("label", "msg")},
    )


# ---------------------------------------------------------------- trade graph

TRADE_SQL = """select 3 * l_orderkey as src, 3 * l_partkey + 1 as dst from lineitem
union select 3 * l_partkey + 1, 3 * l_suppkey + 2 from lineitem
union select 3 * l_suppkey + 2, 3 * l_orderkey from lineitem"""


def trade_graph(spark: SparkSession, folder: str) -> DataFrame:
    """Three links per line, numbered by kind."""
    order, part, supplier = (
        F.col("l_orderkey") * 3,
        F.col("l_partkey") * 3 + 1,
        F.col("l_suppkey") * 3 + 2,
    )
    links = F.array(
        *[
            F.struct(src.alias("src"), dst.alias("dst"))
            for src, dst in ((order, part), (part, supplier), (supplier, order))
        ]
    )
    lines = table(spark, folder, "lineitem")
    return lines.select(F.explode(links).alias("link")).select("link.*").distinct()


@query(
    "triangles",
    f"""with t as ({TRADE_SQL}),
        u as materialized (select distinct least(src, dst) as a, greatest(src, dst) as b from t where src <> dst),
        tri as materialized (select x.a as a, x.b as b, y.b as c from u x join u y on x.b = y.a
                join u z on z.a = x.a and z.b = y.b),
        corner as (select a as id from tri union all select b from tri union all select c from tri),
        v as (select a as id from u union select b from u)
        select v.id, coalesce(n, 0) as triangles
        from v left join (select id, count(*) as n from corner group by id) using (id)""",
)
def triangles(spark: SparkSession, folder: str) -> DataFrame:
    return graph.triangle_count(None, trade_graph(spark, folder))


PRICED_SQL = """(select p_partkey as id, p_retailprice as worth from part
 union all select 1000000000 + s_suppkey, s_acctbal from supplier)"""
SUPPLY_SQL = """(select distinct l_partkey as src, 1000000000 + l_suppkey as dst from lineitem)"""
TRIPLETS_SQL = f"""select src, dst, round(s.worth, 2) as src_worth, round(d.worth, 2) as dst_worth
from {SUPPLY_SQL} e join {PRICED_SQL} s on s.id = e.src join {PRICED_SQL} d on d.id = e.dst"""


def supply_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parts and suppliers with a worth; a link from each part to each of its suppliers."""
    parts = table(spark, folder, "part").selectExpr("p_partkey as id", "p_retailprice as worth")
    suppliers = table(spark, folder, "supplier")
    suppliers = suppliers.selectExpr("1000000000 + s_suppkey as id", "s_acctbal as worth")
    links = table(spark, folder, "lineitem")
    links = links.selectExpr("l_partkey as src", "1000000000 + l_suppkey as dst").distinct()
    return parts.unionByName(suppliers), stage(links, "supply-links")


@query("triplets", TRIPLETS_SQL)
def triplets(spark: SparkSession, folder: str) -> DataFrame:
    joined = graph.triplets(*supply_graph(spark, folder))
    return joined.withColumns({c: F.round(c, 2) for c in ("src_worth", "dst_worth")})


@query("edge_filter", f"{TRIPLETS_SQL} where s.worth > d.worth")
def edge_filter(spark: SparkSession, folder: str) -> DataFrame:
    return triplets(spark, folder).where("src_worth > dst_worth")


@query("map_vertices", f"select id, round(worth * 2, 4) as worth from {PRICED_SQL}")
def map_vertices(spark: SparkSession, folder: str) -> DataFrame:
    vertices, _ = supply_graph(spark, folder)
    return graph.map_vertices(vertices, worth=F.round(F.col("worth") * 2, 4))


@query(
    "neighbour_avg",
    f"""select dst as id, count(*) as heavier, round(avg(src_worth), 6) as mean_worth
        from ({TRIPLETS_SQL} where s.worth > d.worth) group by dst""",
)
def neighbour_avg(spark: SparkSession, folder: str) -> DataFrame:
    vertices, links = supply_graph(spark, folder)
    return graph.neighbour_agg(
        vertices,
        links,
        "src_worth > dst_worth",
        heavier=F.count("*"),
        mean_worth=F.round(F.avg("src_worth"), 6),
    )


# ---------------------------------------------------------------- region graph

REGION_SQL = """select 'c' || c_custkey as src, 'n' || c_nationkey as dst from customer
union select 's' || s_suppkey, 'n' || s_nationkey from supplier
union select 'n' || n_nationkey, 'r' || n_regionkey from nation"""


def region_graph(spark: SparkSession, folder: str) -> DataFrame:
    def links(name: str, src: str, src_key: str, dst: str, dst_key: str) -> DataFrame:
        return table(spark, folder, name).select(
            F.concat(F.lit(src), src_key).alias("src"), F.concat(F.lit(dst), dst_key).alias("dst")
        )

    customers = links("customer", "c", "c_custkey", "n", "c_nationkey")
    suppliers = links("supplier", "s", "s_suppkey", "n", "s_nationkey")
    nations = links("nation", "n", "n_nationkey", "r", "n_regionkey")
    return customers.unionByName(suppliers).unionByName(nations)


# one numbered edge table; every level is a set, and one anti join takes the earlier ones away
HOPS_SQL = f"""ends as materialized (select src, dst from ({REGION_SQL}) union select dst, src from ({REGION_SQL})),
ids as materialized (select src, row_number() over (order by src) as n from (select distinct src from ends)),
e as materialized (select a.n as src, b.n as dst from ends join ids a on a.src = ends.src
                   join ids b on b.src = ends.dst),
two as materialized (select distinct x.src as id, y.dst as reached from e x join e y on x.dst = y.src),
three as materialized (select distinct two.id, e.dst as reached from two join e on two.reached = e.src),
near as materialized (select src as id, dst as reached from e union select id, reached from two
                      union select n, n from ids),
far as (select id, reached from three except select id, reached from near)"""


@query(
    "n_hop",
    f"""with {HOPS_SQL}
        select a.src as id, b.src as reached from far join ids a on a.n = far.id join ids b on b.n = far.reached""",
)
def n_hop(spark: SparkSession, folder: str) -> DataFrame:
    return graph.exact_hops(region_graph(spark, folder), 3)


@query(
    "n_hop_from",
    f"""with {HOPS_SQL}
        select a.src as id, b.src as reached from far join ids a on a.n = far.id join ids b on b.n = far.reached
        where a.src like 'n%'""",
)
def n_hop_from(spark: SparkSession, folder: str) -> DataFrame:
    """The same from the nations only."""
    nations = table(spark, folder, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"))
    return graph.exact_hops(region_graph(spark, folder), 3, nations)
