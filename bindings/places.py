"""Spatial and graph queries. Coordinates come from the embeddings, streets
from trade between nations, suppliers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import Catalog, r6, table
from vereda.operators import graph as gr, spatial as sp
from vereda.session import materialize

catalog = Catalog()


def coordinate(i: int):
    return F.get("embedding", F.lit(i)).cast("double")


def points(spark, sf, i: int, j: int, key: str):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias(key), coordinate(i).alias("x"), coordinate(j).alias("y"), "label"
    )


def diamonds(spark, sf):
    """One diamond per embedding; every fourth label leaves a hole in it."""
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("area_id"), "label",
        coordinate(2).alias("cx"), coordinate(3).alias("cy"),
        (F.abs(coordinate(4)) * 0.2 + 0.02).alias("wx"), (F.abs(coordinate(5)) * 0.2 + 0.02).alias("wy"),
    )

    def corner(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    cx, cy, wx, wy = (F.col(c) for c in ("cx", "cy", "wx", "wy"))
    outer = F.array(corner(cx + wx, cy), corner(cx, cy + wy), corner(cx - wx, cy), corner(cx, cy - wy))
    hole = F.array(
        corner(cx + wx * 0.5, cy), corner(cx, cy - wy * 0.5), corner(cx - wx * 0.5, cy), corner(cx, cy + wy * 0.5)
    )
    rings = F.when(F.col("label") % 4 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    return rows.select("area_id", rings.alias("rings"))


def _ring(points: list[tuple[str, str]]) -> str:
    following = points[1:] + points[:1]
    return " union all ".join(
        f"select vec_id, label, {a} as x1, {b} as y1, {c} as x2, {d} as y2 from e"
        for (a, b), (c, d) in zip(points, following)
    )


OUTER = [("cx + wx", "cy"), ("cx", "cy + wy"), ("cx - wx", "cy"), ("cx", "cy - wy")]
HOLE = [("cx + wx * 0.5", "cy"), ("cx", "cy - wy * 0.5"), ("cx - wx * 0.5", "cy"), ("cx", "cy + wy * 0.5")]
SHAPES_SQL = f"""
with e as (select vec_id, label, embedding[3]::double as cx, embedding[4]::double as cy,
  abs(embedding[5]::double) * 0.2 + 0.02 as wx, abs(embedding[6]::double) * 0.2 + 0.02 as wy from embeddings),
edges as ({_ring(OUTER)} union all select * from ({_ring(HOLE)}) where label % 4 = 0),
p as (select vec_id as id, label, embedding[1]::double as x, embedding[2]::double as y from embeddings),
inside as (select id, any_value(p.label) as label, vec_id as area_id from p, edges group by id, vec_id
  having sum(case when (y1 > y) <> (y2 > y) and x < x1 + (x2 - x1) * ((y - y1) / (y2 - y1)) then 1 else 0 end) % 2 = 1
  and not bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) and x between least(x1, x2) and greatest(x1, x2) and y between least(y1, y2) and greatest(y1, y2)))
"""


@catalog.add(SHAPES_SQL + "select id, area_id from inside")
def points_in_polygons(spark, sf):
    return sp.points_in_polygons(points(spark, sf, 0, 1, "id"), diamonds(spark, sf), ["id"])


@catalog.add(SHAPES_SQL + """
select area_id, count(*) filter (label % 4 = 0) as vitality_retail, count(*) filter (label % 4 = 1) as vitality_food,
  count(*) filter (label % 4 = 2) as vitality_social from inside group by area_id""")
def poi_area_pivot(spark, sf):
    names = F.array(*[F.lit(c) for c in ("retail", "food_and_drink", "social", "other")])
    pois = points(spark, sf, 0, 1, "id").withColumn("category", F.get(names, F.col("label") % 4))
    columns = {"retail": "vitality_retail", "food_and_drink": "vitality_food", "social": "vitality_social"}
    return sp.category_vitality(pois, diamonds(spark, sf), columns, area="area_id")


@catalog.add(SHAPES_SQL + "select distinct id as node_id from inside")
def study_area_nodes(spark, sf):
    nodes = points(spark, sf, 0, 1, "node_id")
    return sp.inside_study_area(nodes, diamonds(spark, sf), "node_id").select("node_id")


@catalog.add(SHAPES_SQL + """, kept as (select distinct id from inside)
select vec_id as u, (vec_id * 7 + 3) % (select count(*) from embeddings) as v from embeddings
where vec_id in (select id from kept) and (vec_id * 7 + 3) % (select count(*) from embeddings) in (select id from kept)""")
def study_area_edges(spark, sf):
    nodes = points(spark, sf, 0, 1, "node_id")
    total = nodes.agg(F.count("*").alias("n")).scalar()
    edges = nodes.select(F.col("node_id").alias("u"), ((F.col("node_id") * 7 + 3) % total).alias("v"))
    return gr.clip_graph(nodes, edges, diamonds(spark, sf))[1]


@catalog.add(SHAPES_SQL + """
select vec_id as area_id, round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 5) + 0.0 as x,
  round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 5) + 0.0 as y from edges group by vec_id""")
def centroids(spark, sf):
    out = sp.centroids(diamonds(spark, sf))
    return out.select("area_id", r6("x", 5).alias("x"), r6("y", 5).alias("y"))


@catalog.add("""
with n as (select vec_id as node_id, embedding[1]::double as x, embedding[2]::double as y from embeddings),
q as (select vec_id as area_id, embedding[3]::double as qx, embedding[4]::double as qy from embeddings),
d as (select area_id, node_id, sqrt((x - qx) * (x - qx) + (y - qy) * (y - qy)) as distance from q, n)
select area_id, node_id as nearest_node, round(distance, 6) as distance from d
qualify row_number() over (partition by area_id order by d.distance, node_id) = 1""")
def nearest_node(spark, sf):
    out = sp.nearest_node(points(spark, sf, 2, 3, "area_id"), points(spark, sf, 0, 1, "node_id"))
    return out.select("area_id", "nearest_node", r6("distance").alias("distance"))


LCC_SQL = """
with c as (select radians(17.5) as p1, radians(29.5) as p2, radians(12.0) as p0, radians(-102.0) as l0,
  6378137.0::double as a, sqrt(2 / 298.257222101::double - (1 / 298.257222101::double) ** 2) as e),
m as (select *, cos(p1) / sqrt(1 - (e * sin(p1)) ** 2) as m1, cos(p2) / sqrt(1 - (e * sin(p2)) ** 2) as m2,
  tan(pi() / 4 - p0 / 2) / ((1 - e * sin(p0)) / (1 + e * sin(p0))) ** (e / 2) as t0,
  tan(pi() / 4 - p1 / 2) / ((1 - e * sin(p1)) / (1 + e * sin(p1))) ** (e / 2) as t1,
  tan(pi() / 4 - p2 / 2) / ((1 - e * sin(p2)) / (1 + e * sin(p2))) ** (e / 2) as t2 from c),
k as (select *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) as n from m),
f as (select *, a * m1 / (n * t1 ** n) as s from k),
p as (select vec_id, -102 + embedding[1]::double * 40 as lon, 23 + embedding[2]::double * 25 as lat from embeddings),
t as (select vec_id, lon, lat, n, s, t0, l0, s * (tan(pi() / 4 - radians(lat) / 2) / ((1 - e * sin(radians(lat))) / (1 + e * sin(radians(lat)))) ** (e / 2)) ** n as rho from p, f)
"""


@catalog.add(LCC_SQL + """select vec_id, round(2500000 + rho * sin(n * (radians(lon) - l0)), 3) as x,
  round(s * t0 ** n - rho * cos(n * (radians(lon) - l0)), 3) as y from t""")
def reproject_lcc(spark, sf):
    degrees = table(spark, sf, "embeddings").select(
        "vec_id", (coordinate(0) * 40 - 102).alias("lon"), (coordinate(1) * 25 + 23).alias("lat")
    )
    out = sp.reproject(degrees, "lon", "lat")
    return out.select("vec_id", r6("x", 3).alias("x"), r6("y", 3).alias("y"))


@catalog.add("""
select vec_id, round(-102 + embedding[1]::double * 40, 6) as lon, round(23 + embedding[2]::double * 25, 6) as lat from embeddings""")
def reproject_back(spark, sf):
    degrees = table(spark, sf, "embeddings").select(
        "vec_id", (coordinate(0) * 40 - 102).alias("lon"), (coordinate(1) * 25 + 23).alias("lat")
    )
    metres = sp.reproject(degrees, "lon", "lat").select("vec_id", "x", "y")
    out = sp.unproject(metres, "x", "y")
    return out.select("vec_id", r6("lon").alias("lon"), r6("lat").alias("lat"))


TRADE_SQL = """
with recursive edges as (select c_nationkey as u, s_nationkey as v, o_orderpriority as key, 1000000 // (1 + count(*)) as length
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
  group by all),
suit as (select c_nationkey as node_id, greatest(avg(cast(c_acctbal as decimal(18,2))) / 10000, 1e-6) as suitability from customer group by 1),
costed as (select u, v, key, length, length * (1.0 / coalesce(suitability, 1e-6)) as cost from edges left join suit on node_id = u),
pairs as (select least(u, v) as a, greatest(u, v) as b, min(cost) as cost from costed where u <> v group by all)
"""


def trade_edges(spark, sf):
    """Directed edges between nations, one per order priority; the more trade
    the shorter. Lines are counted per order and supplier nation first."""
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    lines = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("l_orderkey", "s_nationkey").agg(F.count("*").alias("n"))
    )
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_nationkey"
    )
    edges = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("c_nationkey").alias("u"), F.col("s_nationkey").alias("v"), F.col("o_orderpriority").alias("key"))
        .agg(F.expr("1000000 div (1 + sum(n))").alias("length"))
    )
    return materialize(edges, "trade")


def trade_areas(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("area_id"), F.col("c_nationkey").alias("nearest_node"),
        (F.col("c_acctbal").cast("decimal(18,2)") / 10000).cast("double").alias("suitability_score"),
    )


def costed_trade(spark, sf):
    return gr.add_edge_cost(trade_edges(spark, sf), gr.suitability_by_node(trade_areas(spark, sf)))


@catalog.add(TRADE_SQL + "select u, v, key, length, round(cost, 3) as cost from costed")
def edge_cost(spark, sf):
    return costed_trade(spark, sf).withColumn("cost", r6("cost", 3))


@catalog.add(TRADE_SQL + "select a, b, round(cost, 3) as cost from pairs")
def undirected_min(spark, sf):
    return gr.undirected_min(costed_trade(spark, sf)).withColumn("cost", r6("cost", 3))


@catalog.add("""
with top as (select c_nationkey as node_id, row_number() over (order by c_acctbal desc, c_custkey) as pos
  from customer qualify pos <= 12)
select node_id, cast(min(pos) as integer) as rank from top group by node_id""")
def top_terminals(spark, sf):
    return gr.select_terminals(trade_areas(spark, sf))


def _relaxed(rounds: int) -> str:
    """Bellman-Ford as a chain of CTEs: one per round of relaxation."""
    steps = ["arcs as (select a as u, b as v, cost from pairs union all select b, a, cost from pairs)",
             "d0 as (select n_nationkey as node, 0.0::double as dist from nation where n_regionkey = 0)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"d{i} as materialized (select node, min(dist) as dist from (select * from d{i - 1} union all"
            f" select v, dist + cost from d{i - 1} join arcs on u = node) group by node)"
        )
    return ", " + ", ".join(steps)


@catalog.add(TRADE_SQL.replace("pairs as (", "pairs as materialized (") + _relaxed(24) + " select node, round(dist, 3) as dist from d24")
def shortest_paths(spark, sf):
    arcs = gr.both_ways(gr.undirected_min(costed_trade(spark, sf)))
    sources = table(spark, sf, "nation").where("n_regionkey = 0").select(F.col("n_nationkey").alias("node"))
    return gr.shortest_paths(arcs, sources).select("node", r6("dist", 3).alias("dist"))


PARTS_FROM = 1_000_000_000


def supply_edges(spark, sf):
    """Suppliers and parts as nodes, joined where one sold the other; the
    length is the quantity per line."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("u"), (F.col("l_partkey") + PARTS_FROM).alias("v"))
        .agg(F.sum("l_quantity").alias("length"))
    )


@catalog.add("""
with e as (select l_suppkey as u, l_partkey + 1000000000 as v, sum(l_quantity) as cost from lineitem group by all)
select count(*) as n_pairs, cast(sum(cost) as double) as total from e""")
def supply_graph(spark, sf):
    pairs = gr.undirected_min(supply_edges(spark, sf).withColumn("cost", F.col("length")))
    return pairs.agg(F.count("*").alias("n_pairs"), F.sum("cost").alias("total"))


@catalog.add()
def steiner_corridor(spark, sf):
    """Edges that connect the twelve dearest parts through their suppliers."""
    edges = materialize(supply_edges(spark, sf).withColumn("cost", F.col("length")), "edges")
    areas = table(spark, sf, "part").select(
        F.col("p_partkey").alias("area_id"), (F.col("p_partkey") + PARTS_FROM).alias("nearest_node"),
        F.col("p_retailprice").alias("suitability_score"),
    )
    tree = materialize(gr.steiner_tree(edges, gr.select_terminals(areas)), "tree")
    return gr.corridor_edges(edges, tree)


def _labels_sql(rounds: int) -> str:
    """Nearest terminal of every node: the least (distance, hops, terminal, node before)."""
    steps = ["l0 as (select node_id as node, 0.0::double as dist, 0 as hops, node_id as source, null::integer as pred from terminals)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"l{i} as materialized (select node, dist, hops, source, pred from (select * from l{i - 1} union all"
            f" select v, dist + cost, hops + 1, source, u from l{i - 1} join arcs on u = node)"
            " qualify row_number() over (partition by node order by dist, hops, source, pred nulls first) = 1)"
        )
    return ", ".join(steps)


CORRIDOR_SQL = TRADE_SQL.replace("pairs as (", "pairs as materialized (").rstrip() + f""",
arcs as (select a as u, b as v, cost from pairs union all select b, a, cost from pairs),
terminals as (select distinct c_nationkey as node_id from (select c_nationkey, row_number() over (order by c_acctbal desc, c_custkey) as pos from customer qualify pos <= 6)),
{_labels_sql(24)},
bridges as (select least(x.source, y.source) as p, greatest(x.source, y.source) as q, x.dist + cost + y.dist as total, a, b
  from pairs join l24 x on a = x.node join l24 y on b = y.node where x.source <> y.source
  qualify row_number() over (partition by least(x.source, y.source), greatest(x.source, y.source) order by x.dist + cost + y.dist, a, b) = 1),
both_ways as (select p as u, q as v, total, a, b from bridges union all select q, p, total, a, b from bridges),
grow(step, seen, a, b) as (
  select 0, [(select min(node_id) from terminals)], null::integer, null::integer
  union all
  select step + 1, list_append(seen, v), a, b from (
    select step, seen, v, w.a, w.b, row_number() over (order by total, least(u, v), greatest(u, v)) as rn
    from grow join both_ways w on list_contains(seen, u) and not list_contains(seen, v)) where rn = 1),
ends as (select unnest([a, b]) as node from grow where a is not null),
ways(node) as (select node from ends union select pred from ways join l24 using (node) where pred is not null),
tree as (select a, b from grow where a is not null
  union select least(node, pred), greatest(node, pred) from ways join l24 using (node) where pred is not null)
"""


@catalog.add(CORRIDOR_SQL + "select a, b, round(cost, 3) as cost from pairs join tree using (a, b)")
def trade_tree(spark, sf):
    """The tree that connects the nations of the six best customers."""
    costed = costed_trade(spark, sf)
    tree = gr.steiner_tree(costed, gr.select_terminals(trade_areas(spark, sf), 6))
    return tree.select("a", "b", r6("cost", 3).alias("cost"))


@catalog.add(CORRIDOR_SQL + """select u, v, key, length, round(costed.cost, 3) as cost from costed
where exists (select 1 from tree where a = least(u, v) and b = greatest(u, v))""")
def trade_corridor(spark, sf):
    """Every trade edge, in either direction, along that tree."""
    costed = materialize(costed_trade(spark, sf), "costed")
    tree = materialize(gr.steiner_tree(costed, gr.select_terminals(trade_areas(spark, sf), 6)), "tree")
    return gr.corridor_edges(costed, tree).withColumn("cost", r6("cost", 3))


@catalog.add(TRADE_SQL.replace("pairs as (", "pairs as materialized (") + """,
arcs as (select a as u, b as v, cost from pairs union all select b, a, cost from pairs),
grow(step, seen, a, b, cost) as (
  select 0, [(select min(a) from pairs)], null::integer, null::integer, 0.0::double
  union all
  select step + 1, list_append(seen, v), least(u, v), greatest(u, v), cost from (
    select step, seen, u, v, arcs.cost, row_number() over (order by arcs.cost, least(u, v), greatest(u, v)) as rn
    from grow join arcs on list_contains(seen, u) and not list_contains(seen, v)) where rn = 1)
select a, b, round(cost, 3) as cost from grow where a is not null""".replace("grow(step", "grow(step", 1))
def spanning_tree(spark, sf):
    pairs = gr.undirected_min(costed_trade(spark, sf))
    return gr.spanning_forest(pairs).select("a", "b", r6("cost", 3).alias("cost"))


@catalog.add("""
with e as (select l_orderkey, l_orderkey * 100 + l_linenumber - 1 as a, l_orderkey * 100 + l_linenumber as b, sum(l_quantity) as length
  from lineitem where l_linenumber > 1 group by all)
select min(a) as a, max(b) as b, sum(length) as length, count(*) as hops from (
  select *, sum(case when gap then 1 else 0 end) over (partition by l_orderkey order by a) as run from (
    select *, a <> coalesce(lag(b) over (partition by l_orderkey order by a), -1) as gap from e)) group by l_orderkey, run""")
def chain_contract(spark, sf):
    """Consecutive lines of an order form a chain; each becomes one edge."""
    node = F.col("l_orderkey") * 100 + F.col("l_linenumber")
    pairs = (
        table(spark, sf, "lineitem").where("l_linenumber > 1")
        .groupBy((node - 1).alias("a"), node.alias("b")).agg(F.sum("l_quantity").alias("length"))
    )
    return gr.contract_chains(pairs)
