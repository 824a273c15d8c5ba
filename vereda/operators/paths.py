"""Shortest paths over blocks of a graph.

One hop a round needs as many rounds as the longest path has edges. Here nodes are
gathered into blocks of neighbours, of bounded size; a round settles the paths inside
all blocks that something new has reached, and then crosses to other blocks. A round
writes only the labels that it changed.

Inside a block the built-in operators would have to go hop by hop, so a block's arcs
and labels meet in one Arrow task: Spark groups them, the task relaxes arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DataType

from vereda.session import materialize

#: arcs of a block, at most; stored tables of labels that are read before they are merged
BLOCK_ARCS, MOST_TABLES = 2_000_000, 12
#: rounds of growing, and the share of blocks that a useful round joins
GROW_ROUNDS, LEAST_JOINED = 60, 0.02


def label(dist: Column, hops: Column, source: Column, pred: Column) -> Column:
    return F.struct(dist.alias("dist"), hops.alias("hops"), source.alias("source"), pred.alias("pred")).alias("s")


def grow_blocks(arcs: DataFrame, most: int = BLOCK_ARCS) -> DataFrame:
    """(node, block): connected groups of nodes with at most ``most`` arcs.

    Every node starts as a block. In a round the blocks whose digest says so join the
    neighbour behind their cheapest arc, if that one stays, as long as there is room in
    it. Nodes with more than a quarter of ``most`` arcs are in no block.
    """
    degree = arcs.groupBy(F.col("u").alias("node")).agg(F.count("*").alias("size")).where(F.col("size") <= most // 4)
    state = materialize(degree.withColumn("block", F.col("node")), "blocks")
    sizes = state.select("block", "size")
    for r in range(GROW_ROUNDS):
        side = lambda n: state.join(sizes.withColumnRenamed("size", "all"), "block").select(
            F.col("node").alias(n), F.col("block").alias(f"b{n}"), F.col("all").alias(f"s{n}")
        )
        stays = lambda b: F.pmod(F.xxhash64(F.lit(r), b), F.lit(2)) == 0
        wishes = (
            arcs.join(side("u"), "u").where(~stays(F.col("bu"))).join(side("v"), "v")
            .where(stays(F.col("bv"))).where(F.col("bu") != F.col("bv")).where(F.col("su") + F.col("sv") <= most)
            .groupBy("bu", "su").agg(F.min(F.struct("cost", "bv", "sv")).alias("to"))
        )
        # a block has no more neighbours than arcs
        room = F.sum("su").over(W.partitionBy("to.bv").orderBy("su", "bu").rowsBetween(W.unboundedPreceding, 0))
        joins = materialize(
            wishes.withColumn("taken", room).where(F.col("taken") + F.col("to.sv") <= most)
            .select(F.col("bu").alias("block"), F.col("to.bv").alias("into")),
            "joins",
        )
        state = materialize(
            state.join(joins, "block", "left").select("node", "size", F.coalesce("into", "block").alias("block")), "blocks"
        )
        sizes = materialize(state.groupBy("block").agg(F.sum("size").alias("size")), "block-sizes")
        if joins.count() <= LEAST_JOINED * sizes.count():
            break
    return state.select("node", "block")


class Labels:
    """Best labels of a block's nodes as arrays over the sorted ids."""

    def __init__(self, n: int):
        self.dist = np.full(n, np.inf)
        self.hops, self.source, self.pred = (np.full(n, np.iinfo(np.int64).max) for _ in range(3))

    def better(self, v, d, h, s, p) -> np.ndarray:
        """Which of the offers come before the label of their node."""
        e = d == self.dist[v]
        out = d < self.dist[v]
        for own, new in ((self.hops, h), (self.source, s), (self.pred, p)):
            out |= e & (new < own[v])
            e &= new == own[v]
        return out

    def take(self, v, d, h, s, p) -> np.ndarray:
        """Takes the best offer of each node, if it improves on it; the nodes improved."""
        keep = self.better(v, d, h, s, p)
        v, d, h, s, p = (x[keep] for x in (v, d, h, s, p))
        order = np.lexsort((p, s, h, d, v))
        order = order[np.diff(v[order], prepend=-1) != 0]
        at = v[order]
        self.dist[at], self.hops[at], self.source[at], self.pred[at] = d[order], h[order], s[order], p[order]
        return at


def relax(u: np.ndarray, v: np.ndarray, cost: np.ndarray, labels: Labels, front: np.ndarray) -> np.ndarray:
    """Relaxes arcs (``u`` ascending) from the ``front`` until nothing improves; the nodes that did."""
    n = len(labels.dist)
    begin = np.searchsorted(u, np.arange(n + 1))
    changed = np.zeros(n, bool)
    while len(front):
        changed[front] = True
        count = begin[front + 1] - begin[front]
        arc = np.repeat(begin[front] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        tail = np.repeat(front, count)
        front = labels.take(v[arc], labels.dist[tail] + cost[arc], labels.hops[tail] + 1, labels.source[tail], tail)
    return changed


def settle(arcs: pa.Table, known: pa.Table) -> pa.Table:
    """The labels of a block that are new or change when its arcs are relaxed from the
    fresh ones."""
    columns = [arcs.column("u"), arcs.column("v"), *(known.column(c) for c in ("node", "source", "pred"))]
    ids = pc.unique(pa.chunked_array([k for c in columns for k in c.chunks], type=columns[0].type).drop_null())
    ids = ids.take(pc.sort_indices(ids))
    place = lambda c: pc.fill_null(pc.index_in(c, ids), -1).to_numpy().astype(np.int64)
    u, v, cost = place(arcs.column("u")), place(arcs.column("v")), arcs.column("cost").to_numpy()
    order = np.argsort(u, kind="stable")
    labels = Labels(len(ids))
    node, fresh = place(known.column("node")), known.column("fresh").to_numpy(zero_copy_only=False).astype(bool)
    labels.take(node, known.column("dist").to_numpy(), known.column("hops").to_numpy().astype(np.int64), place(known.column("source")), place(known.column("pred")))
    at = np.flatnonzero(relax(u[order], v[order], cost[order], labels, np.unique(node[fresh])))
    pred = labels.pred[at]
    return pa.table({
        "node": ids.take(pa.array(at)), "dist": pa.array(labels.dist[at]), "hops": pa.array(labels.hops[at].astype(np.int32)),
        "source": ids.take(pa.array(labels.source[at])), "pred": ids.take(pa.array(pred, mask=pred < 0)),
    })


def settled(arcs: DataFrame, known: DataFrame, kind: DataType) -> DataFrame:
    """(node, s): ``settle`` in every block of ``known(block, node, s, fresh)``."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return settle(left, right)

    flat = known.select("block", "node", "s.*", "fresh")
    name = kind.simpleString()
    out = arcs.groupBy("block").cogroup(flat.groupBy("block")).applyInArrow(
        run, f"node {name}, dist double, hops int, source {name}, pred {name}"
    )
    return out.select("node", label(F.col("dist"), F.col("hops"), F.col("source"), F.col("pred")))


def best(tables: list[DataFrame]) -> DataFrame:
    """(node, s): the best of all labels stored so far."""
    if len(tables) == 1:
        return tables[0]
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out.groupBy("node").agg(F.min("s").alias("s"))


def pointers(paths: pa.Table) -> tuple[pa.Array, np.ndarray]:
    """The nodes of ``paths``, and for each the place of the one before it, its own for a source."""
    ids = paths.column("node").combine_chunks()
    pred = pc.fill_null(pc.index_in(paths.column("pred"), ids), -1).to_numpy().astype(np.int64)
    return ids, np.where(pred < 0, np.arange(len(pred)), pred)


def owners(paths: DataFrame) -> DataFrame:
    """(node, owner): the source that the predecessors of every node lead to. ``paths``
    is a stored table of one block."""

    def run(table: pa.Table) -> pa.Table:
        ids, up = pointers(table)
        while True:
            higher = up[up]
            if (higher == up).all():
                return pa.table({"node": ids, "owner": ids.take(pa.array(up))})
            up = higher

    name = paths.schema["node"].dataType.simpleString()
    return paths.select("node", "pred", F.lit(0).alias("block")).groupBy("block").applyInArrow(run, f"node {name}, owner {name}")


def ways(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """(node, pred) of all nodes from ``ends(node)`` to their sources. ``paths`` is a
    stored table of one block."""

    def run(table: pa.Table) -> pa.Table:
        _, up = pointers(table)
        on = table.column("end").to_numpy(zero_copy_only=False).astype(bool)
        at = np.flatnonzero(on)
        while len(at):
            at = np.unique(up[at])
            at = at[~on[at]]
            on[at] = True
        return table.select(["node", "pred"]).filter(pa.array(on))

    name = paths.schema["node"].dataType.simpleString()
    marked = ends.distinct().select("node", F.lit(True).alias("end"))
    rows = paths.select("node", "pred").join(marked, "node", "left").withColumn("end", F.coalesce("end", F.lit(False)))
    return rows.withColumn("block", F.lit(0)).groupBy("block").applyInArrow(run, f"node {name}, pred {name}")


def shortest_paths(arcs: DataFrame, sources: DataFrame, block_arcs: int = BLOCK_ARCS, stored: bool = False) -> DataFrame:
    """(node, dist, source, pred, hops): for every reachable node the nearest
    source, the distance and the node before it.

    ``arcs(u, v, cost)`` with positive costs, ``sources(node)``. Equal distances take
    fewer hops, then the smaller source, then the smaller predecessor. A graph of at
    most ``block_arcs`` arcs is one block. In a larger one, a round relaxes the arcs
    between blocks from the labels that changed in the last round, partial minima being
    formed before the shuffle, so that a node with very many arcs is no hot spot; then
    it settles the blocks that were reached. ``stored`` arcs are not written again.
    """
    kind = arcs.schema["u"].dataType
    arcs = arcs.select("u", "v", F.col("cost").cast("double").alias("cost"))
    if not stored:
        arcs = materialize(arcs, "arcs")
    node = F.col("node").cast(kind)
    start = label(F.lit(0.0), F.lit(0), node, F.lit(None).cast(kind))
    fresh = sources.select(node.alias("node"), start).distinct()
    if arcs.count() <= block_arcs:
        known = fresh.select(F.lit(0).alias("block"), "node", "s", F.lit(True).alias("fresh"))
        found = settled(arcs.withColumn("block", F.lit(0)), known, kind)
        found = materialize(found, "paths")
        return found.select("node", "s.dist", "s.source", "s.pred", "s.hops")

    blocks = grow_blocks(arcs, block_arcs)
    ends = lambda n: blocks.select(F.col("node").alias(n), F.col("block").alias(f"_{n}"))
    placed = materialize(arcs.join(ends("u"), "u", "left").join(ends("v"), "v", "left"), "placed-arcs")
    same = F.coalesce(F.col("_u") == F.col("_v"), F.lit(False))
    inner = placed.where(same).select(F.col("_u").alias("block"), "u", "v", "cost")
    cross = placed.where(~same).select("u", "v", "cost")
    fresh = materialize(fresh, "fresh")
    tables: list[DataFrame] = []
    while not fresh.isEmpty():
        reached = fresh.join(blocks, "node", "left")
        inside = reached.where(F.col("block").isNotNull()).select("block", "node", "s", F.lit(True).alias("fresh"))
        active = inside.select("block").distinct()
        known = inside
        if tables:
            older = best(tables).join(blocks, "node").join(active, "block", "left_semi").select("block", "node", "s", F.lit(False).alias("fresh"))
            known = known.unionByName(older)
        # nodes in no block pass on what reached them
        changed = settled(inner.join(active, "block", "left_semi"), known, kind).unionByName(
            reached.where(F.col("block").isNull()).select("node", "s")
        )
        tables.append(materialize(changed, "paths"))
        offers = (
            tables[-1].join(cross, F.col("node") == F.col("u"))
            .select(F.col("v").alias("node"), label(F.col("s.dist") + F.col("cost"), F.col("s.hops") + 1, F.col("s.source"), F.col("u")))
            .groupBy("node").agg(F.min("s").alias("offer"))
        )
        if len(tables) > MOST_TABLES:
            tables = [materialize(best(tables), "paths")]
        now = offers.join(best(tables), "node", "left").where(F.col("s").isNull() | (F.col("offer") < F.col("s")))
        fresh = materialize(now.select("node", F.col("offer").alias("s")), "fresh")
    return best(tables).select("node", "s.dist", "s.source", "s.pred", "s.hops")
