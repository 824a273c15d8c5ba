"""Street-graph operators on node and edge tables.

Iterative ones write each round to the shared scratch folder: lineage stays
short and a lost executor costs one round at most.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, functions as F

from vereda.functions.numeric import clip_below, edge_cost
from vereda.operators.paths import BLOCK_ARCS, label, owners, shortest_paths, ways
from vereda.operators.spatial import inside_study_area
from vereda.session import materialize

# fixed value: suitability of a node no area maps to, and the lowest allowed
EPSILON = 1e-6


def clip_graph(nodes: DataFrame, edges: DataFrame, polygons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes inside the study area and the edges with both ends inside."""
    kept = materialize(inside_study_area(nodes, polygons, "node_id"), "nodes")
    ids = kept.select("node_id")
    inner = edges.join(ids.withColumnRenamed("node_id", "u"), "u", "left_semi").join(
        ids.withColumnRenamed("node_id", "v"), "v", "left_semi"
    )
    return kept, inner.select(*edges.columns)


def suitability_by_node(areas: DataFrame, suitability: str = "suitability_score", node: str = "nearest_node") -> DataFrame:
    """(node_id, suitability): mean over the areas on a node, at least EPSILON."""
    return (
        areas.where(F.col(node).isNotNull())
        .groupBy(F.col(node).alias("node_id"))
        .agg(clip_below(F.avg(suitability), EPSILON).alias("suitability"))
    )


def add_edge_cost(edges: DataFrame, by_node: DataFrame, out: str = "cost") -> DataFrame:
    """Cost of every directed edge from the suitability of its origin node."""
    suit = by_node.select(F.col("node_id").alias("u"), "suitability")
    return (
        edges.join(suit, "u", "left")
        .withColumn(out, edge_cost(F.col("length"), F.coalesce("suitability", F.lit(EPSILON))))
        .select(*edges.columns, out)
    )


def select_terminals(areas: DataFrame, k: int = 12, suitability: str = "suitability_score") -> DataFrame:
    """(node_id, rank): nodes of the k best areas, each once at its best rank."""
    if "nearest_node" not in areas.columns:
        raise ValueError("areas carry no nearest_node; map them to nodes first")
    top = areas.orderBy(F.desc_nulls_last(suitability), "area_id").limit(k)
    # at most k rows from here on
    listed = top.agg(
        F.sort_array(
            F.collect_list(F.struct((-F.col(suitability)).alias("s"), "area_id", F.col("nearest_node").alias("n")))
        ).alias("rows")
    )
    return (
        listed.select(F.posexplode("rows").alias("pos", "r"))
        .groupBy(F.col("r.n").alias("node_id"))
        .agg((F.min("pos") + 1).alias("rank"))
    )


def undirected_min(edges: DataFrame, weight: str = "cost") -> DataFrame:
    """(a, b, cost) with a < b: the cheapest of parallel and opposite edges."""
    fallback = F.col("length") if "length" in edges.columns else F.lit(1.0)
    w = F.coalesce(F.col(weight), fallback, F.lit(1.0)) if weight in edges.columns else F.coalesce(fallback, F.lit(1.0))
    return (
        edges.where(F.col("u") != F.col("v"))
        .groupBy(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
        .agg(F.min(w.cast("double")).alias("cost"))
    )


def both_ways(pairs: DataFrame) -> DataFrame:
    arcs = F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v"), "cost"),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v"), "cost"),
    )
    return pairs.select(F.inline(arcs))


#: edges of a forest that the driver picks from by itself
LOCAL_PAIRS = 100_000


def small_forest(rows: list) -> list:
    """The rows (a, b, cost, ...) of a minimum spanning forest, ties by the pair."""
    above: dict = {}

    def root(v):
        while above.setdefault(v, v) != v:
            above[v] = v = above[above[v]]
        return v

    out = []
    for r in sorted(rows, key=lambda r: (r["cost"], r["a"], r["b"])):
        x, y = root(r["a"]), root(r["b"])
        if x != y:
            above[x] = y
            out.append(r)
    return out


def spanning_forest(pairs: DataFrame) -> DataFrame:
    """Minimum spanning forest of (a, b, cost, ...) by Borůvka rounds.

    Every round each component takes its cheapest outgoing edge, ties by the
    pair, and components merge along the chosen edges; at least half of them
    disappear per round. A table of at most ``LOCAL_PAIRS`` pairs needs no rounds.
    """
    pairs = materialize(pairs, "pairs")
    few = pairs.collect() if pairs.count() <= LOCAL_PAIRS else None
    if few is not None:
        return pairs.sparkSession.createDataFrame(small_forest(few), pairs.schema)
    return grown_forest(pairs)


def grown_forest(pairs: DataFrame) -> DataFrame:
    """``spanning_forest`` of a stored table of any size."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = materialize(nodes.select("node", F.col("node").alias("comp")), "labels")
    chosen = []
    while True:
        ends = (
            pairs.join(label.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a")
            .join(label.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
            .where("ca <> cb")
        )
        both = F.array(
            F.struct(F.col("ca").alias("comp"), F.col("cb").alias("other")),
            F.struct(F.col("cb").alias("comp"), F.col("ca").alias("other")),
        )
        best = materialize(
            ends.select("cost", "a", "b", F.inline(both))
            .groupBy("comp")
            .agg(F.min(F.struct("cost", "a", "b", "other")).alias("e")),
            "choice",
        )
        live = best.count()
        if live == 0:
            break
        chosen.append(best.select("e.a", "e.b"))
        # each component points to the one it chose; of two that chose each
        # other the smaller is the root
        point = best.select("comp", F.col("e.other").alias("to"))
        back = point.select(F.col("comp").alias("to"), F.col("to").alias("back"))
        root = point.join(back, "to", "left").select(
            "comp", F.when((F.col("back") == F.col("comp")) & (F.col("comp") < F.col("to")), F.col("comp")).otherwise(F.col("to")).alias("to")
        )
        # pointers double per hop; each hop is a stored table, so the plan stays small
        root = materialize(root, "root")
        while True:
            hop = root.select(F.col("comp").alias("to"), F.col("to").alias("next"))
            hopped = root.join(hop, "to", "left").select("comp", F.col("to").alias("from"), F.coalesce("next", "to").alias("to"))
            hopped = materialize(hopped, "root")
            root = hopped.drop("from")
            if hopped.where("from <> to").isEmpty():
                break
        label = materialize(
            label.join(root, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels"
        )
    if not chosen:
        return pairs.limit(0)
    picked = chosen[0]
    for more in chosen[1:]:
        picked = picked.unionByName(more)
    return pairs.join(picked.distinct(), ["a", "b"], "left_semi")


def ancestor_jumps(paths: DataFrame) -> list[DataFrame]:
    """Tables (node, to) that lead 1, 2, 4, ... predecessors up and stop at the
    source; the last one leads every node to its source."""
    jumps = [materialize(paths.select("node", F.coalesce("pred", "node").alias("to")), "jump")]
    while True:
        last = jumps[-1]
        step = last.join(last.select(F.col("node").alias("to"), F.col("to").alias("next")), "to")
        doubled = materialize(step, "jump")
        if doubled.where(F.col("next") != F.col("to")).isEmpty():
            return jumps
        jumps.append(doubled.select("node", F.col("next").alias("to")))


def climbed(paths: DataFrame, ends: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(node, pred) of all nodes from ``ends(node)`` to their sources, by ``ancestor_jumps``."""
    marked = ends.distinct()
    for jump in jumps:
        reached = marked.join(jump, "node").select(F.col("to").alias("node"))
        marked = materialize(marked.unionByName(reached).distinct(), "marked")
    return paths.join(marked, "node", "left_semi").select("node", "pred")


def split_terminals(terminals: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct ``terminals(node_id)`` that are among ``nodes(node_id)``, and the missing ones."""
    distinct, there = terminals.select("node_id").distinct(), nodes.select("node_id")
    return distinct.join(there, "node_id", "left_semi"), distinct.join(there, "node_id", "left_anti")


#: rounds of hops from the terminals, labels that go to every task, and terminals at most
HOP_ROUNDS, HOP_LABELS, HOP_TERMINALS = 24, 300_000, 500


def meeting_paths(pairs: DataFrame, terminals: DataFrame) -> DataFrame | None:
    """(node, dist, source, pred, hops) as ``shortest_paths`` gives them, for the nodes
    around the terminals up to where their territories have met; None if that is
    far or wide.

    Both ends of a bridge are nearer than half its length, for each is at most the
    bridge's edge farther off than the other one. So once bridges connect all terminals,
    nodes beyond half of the longest of them are on no bridge of the tree, nor on a
    way to one. A round goes one hop from the labels that changed; ``pairs``, a
    stored table, is only scanned.
    """
    kind = pairs.schema["a"].dataType
    node = F.col("node").cast(kind)
    fresh = terminals.select(node.alias("node"), label(F.lit(0.0), F.lit(0), node, F.lit(None).cast(kind))).distinct()
    fresh = labels = materialize(fresh, "near-labels")
    k, reach = fresh.count(), float("inf")
    if k > HOP_TERMINALS:
        return None
    arcs = both_ways(pairs)
    near = lambda: F.col("s.dist") <= F.lit(reach)
    for _ in range(HOP_ROUNDS):
        front = fresh.where(near())
        if front.isEmpty():
            return labels.where(near()).select("node", "s.dist", "s.source", "s.pred", "s.hops")
        if labels.count() > HOP_LABELS:
            return None
        offers = (
            arcs.join(F.broadcast(front), F.col("u") == F.col("node"))
            .select(F.col("v").alias("node"), label(F.col("s.dist") + F.col("cost"), F.col("s.hops") + 1, F.col("s.source"), F.col("u")))
            .where(near()).groupBy("node").agg(F.min("s").alias("offer"))
        )
        both = labels.join(offers, "node", "full").select("node", F.least("s", "offer").alias("s"), (F.col("s").isNull() | (F.col("offer") < F.col("s"))).alias("new"))
        both = materialize(both.withColumn("new", F.coalesce("new", F.lit(False))), "near-labels")
        labels, fresh = both.select("node", "s"), both.where("new").select("node", "s")
        if labels.count() > HOP_LABELS:
            return None
        side = lambda n: F.broadcast(labels.select(F.col("node").alias(n), F.col("s.dist").alias(f"d{n}"), F.col("s.source").alias(f"s{n}")))
        met = (
            pairs.join(side("a"), "a").join(side("b"), "b").where("sa <> sb")
            .groupBy(F.least("sa", "sb").alias("a"), F.greatest("sa", "sb").alias("b"))
            .agg(F.min(F.col("da") + F.col("cost") + F.col("db")).alias("cost"))
        )
        tree = small_forest(met.collect())  # a row for two terminals
        if len(tree) == k - 1:
            # a little more, for sums that differ by rounding
            reach = min(reach, max(r["cost"] for r in tree) / 2 * (1 + 1e-9))
            labels = labels.where(near())
    return None


def steiner_tree(edges: DataFrame, terminals: DataFrame, weight: str = "cost", block_arcs: int = BLOCK_ARCS) -> DataFrame:
    """(a, b, cost): a tree that connects the terminals, at most twice as
    expensive as the best one (Mehlhorn 1988).

    Every node is given to its nearest terminal; the cheapest bridge between
    each two neighbouring territories forms a terminal graph; its spanning tree
    is expanded to paths. The paths inside a territory form a tree rooted at its
    terminal, so with the bridges the result is a tree whose leaves are all
    terminals. ``terminals(node_id)``; those outside the graph are skipped. In a graph
    of several blocks only the nodes that ``meeting_paths`` needs are visited, if those are few.
    """
    distinct = terminals.select("node_id").distinct()
    pairs = materialize(undirected_min(edges, weight), "pairs")
    arcs = both_ways(pairs)
    present, _ = split_terminals(distinct, arcs.select(F.col("u").alias("node_id")))
    valid = materialize(present.select(F.col("node_id").alias("node")), "terminals")
    k = valid.count()
    if k < 2:
        if distinct.limit(2).count() < 2:
            raise ValueError("a corridor needs two different terminals")
        raise ValueError("fewer than two terminals lie in the graph")

    paths = meeting_paths(pairs, valid) if 2 * pairs.count() > block_arcs else None
    few = paths is not None
    paths = materialize(paths, "paths") if few else shortest_paths(arcs, valid, block_arcs, stored=True)
    # a node belongs to the terminal its predecessors lead to, which also holds
    # where rounding made two distances equal
    jumps = None if paths.count() <= block_arcs else ancestor_jumps(paths)
    owner = owners(paths) if jumps is None else jumps[-1].select("node", F.col("to").alias("owner"))
    owned = materialize(paths.select("node", "dist").join(owner, "node"), "owned")
    small = F.broadcast if few else lambda df: df
    side = lambda n: small(owned.select(F.col("node").alias(n), F.col("dist").alias(f"d{n}"), F.col("owner").alias(f"s{n}")))
    through = F.col("da") + F.col("cost") + F.col("db")
    bridges = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where("sa <> sb")
        .groupBy(F.least("sa", "sb").alias("p"), F.greatest("sa", "sb").alias("q"))
        .agg(F.min(F.struct(through.alias("total"), "a", "b")).alias("e"))
        .select(F.col("p").alias("a"), F.col("q").alias("b"), F.col("e.total").alias("cost"),
                F.col("e.a").alias("x"), F.col("e.b").alias("y"))
    )
    tree = materialize(spanning_forest(bridges), "tree")
    if tree.count() != k - 1:
        raise ValueError("terminals are not connected")

    # all nodes between the bridge ends and their terminals
    ends = tree.select(F.explode(F.array("x", "y")).alias("node"))
    inner = ways(paths, ends) if jumps is None else climbed(paths, ends, jumps)
    inner = inner.where(F.col("pred").isNotNull()).select(F.least("node", "pred").alias("a"), F.greatest("node", "pred").alias("b"))
    outer = tree.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    on = materialize(inner.unionByName(outer).distinct(), "tree-pairs")
    return pairs.join(on, ["a", "b"], "left_semi").select("a", "b", "cost")


def corridor_edges(edges: DataFrame, tree: DataFrame) -> DataFrame:
    """Every original edge, either direction and parallel ones included, whose
    pair of ends is in the tree."""
    keyed = edges.withColumn("_a", F.least("u", "v")).withColumn("_b", F.greatest("u", "v"))
    pair = tree.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    return keyed.join(pair, ["_a", "_b"], "left_semi").select(*edges.columns)


def contract_chains(pairs: DataFrame) -> DataFrame:
    """(a, b, length, hops): runs of edges through nodes with exactly two
    neighbours become one edge; the total length is unchanged.

    ``pairs(a, b, length)`` is an undirected simple graph. A ring without any
    junction stays as one loop at its smallest node. Parallel results are kept.
    In a round every edge goes to one of its middle nodes, the one with the smaller
    digest; a middle node that receives both of its edges makes them one. At least a
    third of the middle nodes are expected to go each round, and finished edges take no
    part in the next, so all rounds together move a small multiple of the first.
    """
    pairs = materialize(pairs.select("a", "b", F.col("length").cast("double").alias("length")), "pairs")
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("deg"))
    middle = materialize(degree.where("deg = 2").select("node"), "middle")
    for n in ("a", "b"):
        mark = middle.select(F.col("node").alias(n), F.lit(True).alias(f"m{n}"))
        pairs = pairs.join(mark, n, "left").withColumn(f"m{n}", F.coalesce(f"m{n}", F.lit(False)))
    state = materialize(
        pairs.select("a", "b", "ma", "mb", "length", F.lit(1).cast("long").alias("hops"), F.least("a", "b").alias("low")), "runs"
    )
    # a loop at a middle node is a ring
    is_open = (F.col("ma") | F.col("mb")) & (F.col("a") != F.col("b"))
    is_open = F.coalesce(is_open, F.col("ma") | F.col("mb"))
    done = []
    for r in count():
        ended = F.when(F.col("ma") & F.col("mb"), F.col("low"))
        done.append(state.where(~is_open).select(
            F.coalesce(ended, F.least("a", "b")).alias("a"), F.coalesce(ended, F.greatest("a", "b")).alias("b"), "length", "hops"
        ))
        rest = state.where(is_open)
        if rest.isEmpty():
            break
        digest = lambda n: F.struct(F.xxhash64(F.lit(r), n), n)
        at_a = F.col("ma") & (~F.col("mb") | (digest("a") < digest("b")))
        sent = rest.select(
            F.when(at_a, F.col("a")).otherwise(F.col("b")).alias("at"), F.when(at_a, F.col("b")).otherwise(F.col("a")).alias("to"),
            F.when(at_a, F.col("mb")).otherwise(F.col("ma")).alias("mto"), "length", "hops", "low",
        )
        # at most two rows a node
        met = sent.groupBy("at").agg(
            F.count("*").alias("n"), F.min("to").alias("x"), F.max("to").alias("y"), F.count_if("mto").alias("n_middle"),
            F.min(F.when(F.col("mto"), F.col("to"))).alias("m"), F.sum("length").alias("length"), F.sum("hops").alias("hops"), F.min("low").alias("low"),
        )
        both, is_middle = F.col("n") == 2, lambda n: (F.col("n_middle") == 2) | F.col("m").eqNullSafe(F.col(n)) & (F.col("n_middle") > 0)
        state = materialize(
            met.select(
                F.when(both, F.col("x")).otherwise(F.col("at")).alias("a"), F.col("y").alias("b"),
                F.when(both, is_middle("x")).otherwise(F.lit(True)).alias("ma"), is_middle("y").alias("mb"), "length", "hops", "low",
            ),
            "runs",
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
