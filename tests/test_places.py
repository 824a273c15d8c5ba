import heapq
import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from vereda.functions import geo
from vereda.operators import graph as gr, paths as ph, spatial as sp
from vereda.plans import network

RING = "array<array<struct<x:double,y:double>>>"
SQUARE = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]
HOLED = [[(10.0, 0.0), (14.0, 0.0), (14.0, 4.0), (10.0, 4.0), (10.0, 0.0)], [(11.0, 1.0), (11.0, 3.0), (13.0, 3.0), (13.0, 1.0)]]
CONCAVE = [[(0.0, 10.0), (4.0, 10.0), (4.0, 14.0), (2.0, 11.0), (0.0, 14.0)]]
OVERLAP = [[(3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0)]]
TINY = [[(2.0, 2.0), (2.001, 2.0), (2.001, 2.001)]]


@pytest.fixture(scope="module")
def polygons(spark):
    shapes = [("square", SQUARE), ("holed", HOLED), ("concave", CONCAVE), ("overlap", OVERLAP), ("tiny", TINY)]
    return spark.createDataFrame(shapes, f"area_id string, rings {RING}")


def test_points_in_polygons(spark, polygons):
    pts = {
        "in": (1.0, 1.0), "edge": (4.0, 1.0), "vertex": (0.0, 0.0), "hole": (12.0, 2.0), "rim": (10.5, 2.0),
        "notch": (2.0, 13.0), "both": (3.5, 3.5), "out": (50.0, 50.0), "small": (2.0008, 2.0004),
    }
    df = spark.createDataFrame([(k, *v) for k, v in pts.items()], "pid string, x double, y double")
    got = sorted(map(tuple, sp.points_in_polygons(df, polygons, ["pid"]).collect()))
    assert got == [
        ("both", "overlap"), ("both", "square"), ("in", "square"), ("rim", "holed"), ("small", "square"), ("small", "tiny"),
    ]


def test_points_in_no_polygon_keep_the_schema(spark, polygons):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "pid int, x double, y double")
    out = sp.points_in_polygons(df, polygons.limit(0), ["pid"])
    assert out.columns == ["pid", "area_id"] and out.isEmpty()


def test_vitality_keeps_or_drops_empty_areas(spark, polygons):
    df = spark.createDataFrame([("retail", 1.0, 1.0), ("retail", 2.5, 1.0), ("other", 1.0, 2.0)], "category string, x double, y double")
    cols = {"retail": "shops", "social": "social"}
    assert list(map(tuple, sp.category_vitality(df, polygons, cols, "area_id").collect())) == [("square", 2, 0)]
    assert sp.category_vitality(df, polygons, cols, "area_id", keep_empty=True).count() == 5


def test_centroids(spark, polygons):
    got = {r["area_id"]: (r["x"], r["y"]) for r in sp.centroids(polygons).collect()}
    assert got["square"] == (2.0, 2.0)
    assert got["holed"] == pytest.approx((12.0, 2.0))


def test_projection_origin_and_return(spark):
    df = spark.createDataFrame([(-102.0, 12.0), (-103.35, 20.67)], "lon double, lat double")
    out = sp.reproject(df, "lon", "lat")
    first = out.first()
    assert (first["x"], first["y"]) == pytest.approx((2_500_000.0, 0.0), abs=1e-6)
    back = sp.unproject(out, "x", "y").collect()
    for r, (lon, lat) in zip(back, [(-102.0, 12.0), (-103.35, 20.67)]):
        assert (r[-2], r[-1]) == pytest.approx((lon, lat), abs=1e-9)


@pytest.mark.parametrize("shape", ["uniform", "hot", "line"])
def test_nearest_node_equals_brute_force(spark, shape):
    rng = random.Random(7)

    def place():
        if shape == "hot" and rng.random() < 0.6:
            return 5.0 + rng.random() * 1e-7, 5.0 + rng.random() * 1e-7
        if shape == "line":
            return rng.random() * 100, 3.0
        return rng.random() * 100, rng.random() * 100

    nodes = [(i, *place()) for i in range(400)] + [(900, 5.0, 5.0), (901, 5.0, 5.0)]
    queries = [(i, *place()) for i in range(150)] + [(999, 5.0, 5.0), (998, -40.0, 300.0)]
    got = sp.nearest_node(
        spark.createDataFrame(queries, "area_id int, x double, y double"),
        spark.createDataFrame(nodes, "node_id int, x double, y double"),
        leaf=8,
    ).collect()
    best = {q: min((math.hypot(nx - x, ny - y), n) for n, nx, ny in nodes) for q, x, y in queries}
    assert len(got) == len(queries)
    for r in got:
        d, n = best[r["area_id"]]
        assert r["distance"] == pytest.approx(d, abs=1e-12)
        if r["nearest_node"] != n:
            assert shape != "uniform"
    assert {r["area_id"]: r["nearest_node"] for r in got}[999] == 900


EDGES = [
    (1, 2, 0, 1.0), (2, 1, 0, 3.0), (1, 2, 1, 0.5), (2, 3, 0, 1.0), (3, 3, 0, 9.0), (3, 4, 0, None), (5, 6, 0, 1.0),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "u long, v long, key int, length double")


def test_edge_cost_and_collapse(spark, edges, rows):
    areas = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 1.5), ("c", 2, 0.0)], "area_id string, nearest_node long, suitability_score double")
    suit = gr.suitability_by_node(areas)
    assert rows(suit, "node_id") == [(1, 1.0), (2, 1e-6)]
    costed = gr.add_edge_cost(edges, suit)
    assert {r["cost"] for r in costed.where("u = 1").collect()} == {1.0, 0.5}
    assert costed.where("u = 3 and v = 4").first()["cost"] == pytest.approx(1e6)
    assert rows(gr.undirected_min(costed), "a", "b")[0] == (1, 2, 0.5)
    assert costed.where("u = v").count() == 1 and gr.undirected_min(costed).where("a = b").count() == 0


def test_terminals_collapse_on_shared_nodes(spark, rows):
    areas = spark.createDataFrame(
        [("a", 7, 0.9), ("b", 7, 0.9), ("c", 3, 0.5), ("d", 4, 0.1)], "area_id string, nearest_node long, suitability_score double"
    )
    assert rows(gr.select_terminals(areas, 3), "rank") == [(7, 1), (3, 3)]
    with pytest.raises(ValueError):
        gr.select_terminals(areas.drop("nearest_node"))


def pair_frame(spark, pairs):
    return spark.createDataFrame(pairs, "u long, v long, cost double")


def test_steiner_errors(spark, edges):
    e = pair_frame(spark, [(1, 2, 1.0), (5, 6, 1.0)])
    terms = lambda *t: spark.createDataFrame([(x,) for x in t], "node_id long")
    with pytest.raises(ValueError, match="two different"):
        gr.steiner_tree(e, terms(1, 1))
    with pytest.raises(ValueError, match="fewer than two"):
        gr.steiner_tree(e, terms(1, 99))
    with pytest.raises(ValueError, match="not connected"):
        gr.steiner_tree(e, terms(1, 5))


def best_steiner(pairs, terminals):
    """Cheapest connecting edge set by trying node subsets and spanning trees."""
    nodes = sorted({n for a, b, _ in pairs for n in (a, b)})
    others = [n for n in nodes if n not in terminals]
    best = math.inf
    for k in range(len(others) + 1):
        for extra in itertools.combinations(others, k):
            keep = set(terminals) | set(extra)
            parent = {n: n for n in keep}

            def root(n):
                while parent[n] != n:
                    n = parent[n]
                return n

            total, joined = 0.0, 0
            for c, a, b in sorted((c, a, b) for a, b, c in pairs if a in keep and b in keep):
                if root(a) != root(b):
                    parent[root(a)] = root(b)
                    total, joined = total + c, joined + 1
            if joined == len(keep) - 1:
                best = min(best, total)
    return best


@pytest.mark.parametrize("seed", [1, 2])
def test_steiner_is_a_tree_within_twice_the_optimum(spark, seed):
    rng = random.Random(seed)
    grid = [(r * 3 + c, r * 3 + c + 1) for r in range(3) for c in range(2)] + [(r * 3 + c, r * 3 + c + 3) for r in range(2) for c in range(3)]
    pairs = [(a, b, float(rng.randint(1, 9))) for a, b in grid]
    terminals = [0, 2, 7]
    tree = [tuple(r) for r in gr.steiner_tree(pair_frame(spark, pairs), spark.createDataFrame([(t,) for t in terminals], "node_id long")).collect()]
    nodes = {n for a, b, _ in tree for n in (a, b)}
    degree = {n: sum(n in (a, b) for a, b, _ in tree) for n in nodes}
    assert set(terminals) <= nodes and len(tree) == len(nodes) - 1
    assert all(degree[n] > 1 for n in nodes - set(terminals))
    seen, todo = set(), [terminals[0]]
    while todo:
        n = todo.pop()
        if n not in seen:
            seen.add(n)
            todo += [b if a == n else a for a, b, _ in tree if n in (a, b)]
    assert seen == nodes
    assert sum(c for _, _, c in tree) <= 2 * best_steiner(pairs, terminals)


def dijkstra(arcs, sources):
    """(dist, hops, source, pred) of every reachable node, label by label."""
    out_of = {}
    for u, v, c in arcs:
        out_of.setdefault(u, []).append((v, c))
    best, heap = {}, [(0.0, 0, s, -1, s) for s in sources]
    heapq.heapify(heap)
    while heap:
        d, h, s, p, n = heapq.heappop(heap)
        if n not in best:
            best[n] = (d, h, s, p if h else None)
            for v, c in out_of.get(n, ()):
                heapq.heappush(heap, (d + c, h + 1, s, n, v))
    return best


@pytest.fixture(scope="module")
def city():
    """A grid with ties, a hub next to every third node and a separate pair."""
    r = random.Random(3)
    side = 10
    pairs = [(a * side + b, a * side + b + 1) for a in range(side) for b in range(side - 1)] + [(n, n + side) for n in range(side * (side - 1))]
    pairs = [(a, b, float(r.randint(1, 4))) for a, b in pairs] + [(n, 500, 7.0) for n in range(0, side * side, 3)] + [(900, 901, 1.0)]
    return pairs


@pytest.mark.parametrize("block_arcs", [10**6, 60, 8])
def test_paths_over_blocks_equal_dijkstra(spark, city, block_arcs):
    arcs = [x for a, b, c in city for x in ((a, b, c), (b, a, c))]
    sources = [0, 77, 777]
    got = gr.shortest_paths(pair_frame(spark, arcs), spark.createDataFrame([(s,) for s in sources], "node long"), block_arcs)
    assert {r["node"]: (r["dist"], r["hops"], r["source"], r["pred"]) for r in got.collect()} == dijkstra(arcs, sources)


def test_paths_with_names_as_nodes(spark):
    arcs = spark.createDataFrame([("b", "a", 1.0), ("a", "ü", 2.0), ("b", "c", 3.0), ("c", "ü", 0.0625)], "u string, v string, cost double")
    got = gr.shortest_paths(arcs, spark.createDataFrame([("b",)], "node string"))
    assert {r["node"]: (r["dist"], r["pred"]) for r in got.collect()} == {"b": (0.0, None), "a": (1.0, "b"), "c": (3.0, "b"), "ü": (3.0, "a")}


def test_blocks_are_connected_and_bounded(spark, city):
    arcs = [x for a, b, c in city for x in ((a, b, c), (b, a, c))]
    rows = ph.grow_blocks(pair_frame(spark, arcs), 60).collect()
    members = {}
    for r in rows:
        members.setdefault(r["block"], set()).add(r["node"])
    assert len(rows) == len({r["node"] for r in rows}) == 102 and 500 not in {r["node"] for r in rows}
    assert 2 < len(members) < 60
    for nodes in members.values():
        assert sum(u in nodes for u, _, _ in arcs) <= 60
        seen, todo = set(), [min(nodes)]
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += [v for u, v, _ in arcs if u == n and v in nodes]
        assert seen == nodes


def test_a_long_chain_is_one_round(spark):
    chain = spark.range(1000).selectExpr("id as a", "id + 1 as b", "1.0 as cost")
    start = time.monotonic()
    got = gr.shortest_paths(gr.both_ways(chain), spark.createDataFrame([(0,)], "node long"))
    assert got.agg({"dist": "max", "hops": "max"}).first()["max(dist)"] == 1000.0
    assert time.monotonic() - start < 60


@pytest.mark.parametrize("block_arcs", [10**6, 40])
def test_steiner_tree_over_blocks(spark, city, block_arcs):
    tree = [tuple(r) for r in gr.steiner_tree(pair_frame(spark, city), spark.createDataFrame([(t,) for t in (0, 9, 90, 99, 45)], "node_id long"), block_arcs=block_arcs).collect()]
    nodes = {n for a, b, _ in tree for n in (a, b)}
    assert {0, 9, 90, 99, 45} <= nodes and len(tree) == len(nodes) - 1


def test_forest_on_the_driver_equals_rounds(spark, city):
    pairs = spark.createDataFrame(city, "a long, b long, cost double")
    assert sorted(map(tuple, gr.spanning_forest(pairs).collect())) == sorted(map(tuple, gr.grown_forest(pairs).collect()))


def test_steiner_survives_distances_that_differ_by_rounding(spark):
    # a 4 x 4 grid of equal decimal costs: sums differ in the last digit only
    grid = [(r * 4 + c, r * 4 + c + 1, 0.1) for r in range(4) for c in range(3)]
    grid += [(r * 4 + c, r * 4 + c + 4, 0.7) for r in range(3) for c in range(4)]
    tree = gr.steiner_tree(pair_frame(spark, grid), spark.createDataFrame([(t,) for t in (0, 3, 12, 15)], "node_id long"))
    pairs = [tuple(r) for r in tree.collect()]
    nodes = {n for a, b, _ in pairs for n in (a, b)}
    assert {0, 3, 12, 15} <= nodes and len(pairs) == len(nodes) - 1
    assert sum(c for *_, c in pairs) == pytest.approx(2.7)


def test_chains_and_rings(spark, rows):
    pairs = [(1, 2, 1.0), (2, 3, 2.0), (3, 4, 3.0), (3, 5, 1.0), (5, 6, 1.0), (10, 11, 1.0), (11, 12, 1.0), (10, 12, 1.0)]
    out = gr.contract_chains(spark.createDataFrame(pairs, "a long, b long, length double"))
    assert rows(out, "a", "b") == [(1, 3, 3.0, 2), (3, 4, 3.0, 1), (3, 6, 2.0, 2), (10, 10, 3.0, 3)]


def test_network_job(spark):
    areas = [(f"a{i}", [[(i * 10.0, 0.0), (i * 10 + 10.0, 0.0), (i * 10 + 10.0, 10.0), (i * 10.0, 10.0)]], 1.0 - i / 10) for i in range(4)]
    areas = spark.createDataFrame(areas, f"area_id string, rings {RING}, suitability_score double")
    nodes = spark.createDataFrame([(i, i * 10 + 5.0, 5.0) for i in range(5)], "node_id long, x double, y double")
    edges = spark.createDataFrame([(i, i + 1, 0, 10.0) for i in range(4)] + [(i + 1, i, 0, 10.0) for i in range(4)], "u long, v long, key int, length double")
    got = network.run(areas, nodes, edges, k=3)
    # node 4 lies outside the study area; both directions of two pairs remain
    assert sorted((r["u"], r["v"]) for r in got.collect()) == [(0, 1), (1, 0), (1, 2), (2, 1)]


def ragged(r, n, x, y, size):
    """A polygon of ``n`` corners around a place."""
    turn = [2 * math.pi * (k + r.random() * 0.8) / n for k in range(n)]
    return [[(x + size * r.uniform(0.4, 1.0) * math.cos(t), y + size * r.uniform(0.4, 1.0) * math.sin(t)) for t in turn]]


@pytest.mark.parametrize("heavy,hot", [(10**9, 10**9), (40, 10**9), (40, 50), (10**9, 20)])
def test_cut_and_crowded_cells_change_nothing(spark, heavy, hot):
    r = random.Random(5)
    shapes = [("all", ragged(r, 40, 50, 50, 90)), *[(f"p{i}", ragged(r, r.choice([3, 8, 25]), r.uniform(0, 100), r.uniform(0, 100), r.uniform(1, 30))) for i in range(12)]]
    shapes += [("hole", [[(20.0, 20.0), (80.0, 20.0), (80.0, 80.0), (20.0, 80.0)], [(40.0, 40.0), (60.0, 40.0), (60.0, 60.0), (40.0, 60.0)]])]
    pts = [(i, r.uniform(-5, 105), r.uniform(-5, 105)) for i in range(400)] + [(1000 + i, 30.0, 30.0) for i in range(150)]
    pts += [(2000 + i, 20.0 + i % 5 * 15.0, 20.0) for i in range(20)]
    areas = spark.createDataFrame(shapes, f"area_id string, rings {RING}")
    df = spark.createDataFrame(pts, "pid int, x double, y double").repartition(4)
    got = sorted(map(tuple, sp.points_in_polygons(df, areas, ["pid"], heavy=heavy, hot=hot).collect()))

    def inside(x, y, rings):
        odd = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
                if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    return False
                odd ^= (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * ((y - y1) / (y2 - y1))
        return odd

    assert got == sorted((i, a) for i, x, y in pts for a, rings in shapes if inside(x, y, rings))


def test_a_polygon_over_everything_is_cut(spark):
    grid = sp.Grid(0.0, 0.0, 64.0)
    edges = F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), e)]) for e in ((0, 0, 64, 0), (64, 0, 64, 64), (64, 64, 0, 64), (0, 64, 0, 0))])
    cells = spark.range(1).select(F.lit("all").alias("a"), edges.alias("_edges"), F.lit(0).alias("_level"), F.lit(0).cast("long").alias("_cx"), F.lit(0).cast("long").alias("_cy"))
    out = sp.refined(cells, grid, "a", 4)
    inner = out.where("_edges is null")
    # 16 x 16 cells without the rim, told in cells as large as possible
    assert inner.agg(F.sum(F.expr("pow(4, 4 - _level)"))).first()[0] == 14 * 14
    assert out.where("_edges is not null").count() == 60 and inner.count() < 14 * 14
    assert out.where("_edges is not null").agg(F.max(F.size("_edges"))).first()[0] < 4


def overlapping_diamonds(n):
    """Diamonds and points over each other, some with a hole, and by brute force what lies where."""
    rng = random.Random(11)
    shapes, pts = [], [(i % 290, round(rng.gauss(0, 1), 3), round(rng.gauss(0, 1), 3)) for i in range(300)]
    pts += [(None, 0.01, 0.02), (1, None, 0.0), (700, 9.0, 9.0), (701, 0.5, 0.25)]
    for i in range(n):
        cx, cy, wx, wy = rng.gauss(0, 1), rng.gauss(0, 1), rng.uniform(0.05, 1.5), rng.uniform(0.05, 1.5)
        ring = [(cx + wx, cy), (cx, cy + wy), (cx - wx, cy), (cx, cy - wy)]
        shapes.append((f"d{i}", [ring] + ([[((x - cx) / 2 + cx, (y - cy) / 2 + cy) for x, y in ring]] if i % 4 == 0 else [])))
    shapes.append(("around", [[(0.0, 0.0), (1.0, 0.0), (1.0, 0.25), (0.0, 0.25)]]))

    def inside(x, y, rings):
        odd = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
                if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    return False
                odd ^= (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * ((y - y1) / (y2 - y1))
        return odd

    return shapes, pts, [(k, a) for k, (_, x, y) in enumerate(pts) for a, rings in shapes if x is not None and inside(x, y, rings)]


def test_the_study_area_is_found_without_all_pairs(spark, monkeypatch):
    shapes, pts, pairs = overlapping_diamonds(60)
    want_ids = {pts[k][0] for k, _ in pairs} - {None}
    areas = spark.createDataFrame(shapes, f"area_id string, rings {RING}")
    df = spark.createDataFrame(pts, "pid int, x double, y double")
    filed, grid, box = sp.filed_cells(areas, "area_id", "rings")
    near = filed.join(sp.loads(df.where(box), filed, grid), sp.CELL).agg(F.sum("_n")).first()[0]
    asked = []
    meet = sp.matches

    def counted(points, cells, grid, keep, area, *more):
        asked.append(cells.join(sp.loads(points, cells, grid), sp.CELL).agg(F.sum("_n")).first()[0])
        return meet(points, cells, grid, keep, area, *more)

    monkeypatch.setattr(sp, "matches", counted)
    got = sorted((r["pid"], r["x"], r["y"]) for r in sp.inside_study_area(df, areas, "pid", few=24, few_points=1).select("pid", "x", F.coalesce("y", F.lit(0.0)).alias("y")).fillna(0.0).collect())
    assert got == sorted((i, x or 0.0, y or 0.0) for i, x, y in pts if i in want_ids)
    # polygons met one by one: far fewer than lie near
    assert sum(n or 0 for n in asked) < near / 3


def test_cells_inside_an_area_add_their_counts(spark, monkeypatch):
    shapes, pts, pairs = overlapping_diamonds(40)
    areas = spark.createDataFrame(shapes, f"area_id string, rings {RING}")
    kinds = ["a", "b", None]
    df = spark.createDataFrame([(kinds[k % 3], x, y) for k, (_, x, y) in enumerate(pts)], "category string, x double, y double")
    monkeypatch.setattr(sp, "HEAVY", 40)
    met = []
    meet = sp.matches

    def counted(*args):
        out = meet(*args)
        met.append(out.count())
        return out

    monkeypatch.setattr(sp, "matches", counted)
    got = sorted(map(tuple, sp.category_vitality(df, areas, {"a": "as", "b": "bs"}, "area_id").collect()))
    want = {a: [0, 0] for _, a in pairs}
    for k, a in pairs:
        if k % 3 < 2:
            want[a][k % 3] += 1
    assert got == sorted((a, *n) for a, n in want.items())
    assert 0 < sum(met) < len(pairs) * 0.6
