"""Job: corridor network (areas, nodes and edges in; corridor edges out)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vereda.operators import graph as gr, spatial as sp
from vereda.operators.quality import require_rows
from vereda.session import materialize


def map_areas(areas: DataFrame, nodes: DataFrame) -> DataFrame:
    """Areas (area_id, rings, ...) with the node nearest to their centroid."""
    points = sp.centroids(areas.select("area_id", "rings"))
    near = sp.nearest_node(points, nodes, "area_id", "node_id").select("area_id", "nearest_node")
    return areas.join(near, "area_id", "left")


def run(
    areas: DataFrame, nodes: DataFrame, edges: DataFrame, k: int = 12,
    suitability: str = "suitability_score", clip: bool = True,
) -> DataFrame:
    """Original edges of the corridor that connects the nodes of the k best
    areas. ``nodes(node_id, x, y)``, ``edges(u, v, key, length, ...)``,
    ``areas(area_id, rings, <suitability>)``, all in the same planar system."""
    require_rows(areas, "no areas given")
    if clip:
        nodes, edges = gr.clip_graph(nodes, edges, areas)
    mapped = materialize(map_areas(areas, nodes).drop("rings"), "areas")
    weighted = materialize(gr.add_edge_cost(edges, gr.suitability_by_node(mapped, suitability)), "edges")
    terminals = gr.select_terminals(mapped, k, suitability)
    tree = gr.steiner_tree(weighted, terminals)
    return require_rows(gr.corridor_edges(weighted, tree), "the corridor has no edges")
