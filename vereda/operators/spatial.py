"""Spatial joins on planar coordinates without a spatial index library.

Both joins turn geometry into equi-joins on grid cells whose size follows the
data, so dense places get small cells and no group of pairs grows with density.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vereda.functions import geo
from vereda.functions.text import bind
from vereda.session import materialize

DEEPEST = 40


def reproject(df: DataFrame, lon: str, lat: str, projection: geo.ConicProjection = geo.MEXICO_LCC) -> DataFrame:
    """Replace degrees by metres ``x, y``."""
    return df.withColumn("_p", projection.forward(F.col(lon), F.col(lat))).select(
        *[c for c in df.columns if c not in ("x", "y")], "_p.x", "_p.y"
    )


def unproject(df: DataFrame, x: str, y: str, projection: geo.ConicProjection = geo.MEXICO_LCC) -> DataFrame:
    return df.withColumn("_p", projection.inverse(F.col(x), F.col(y))).select(*df.columns, "_p.lon", "_p.lat")


def centroids(polygons: DataFrame, rings: str = "rings") -> DataFrame:
    """Polygons with their area centroid as ``x, y``."""
    return polygons.withColumn("_c", geo.centroid(geo.polygon_edges(F.col(rings)))).select(
        *polygons.columns, "_c.x", "_c.y"
    )


def _cell(v: Column, origin: Column, size: Column) -> Column:
    return F.floor((v - origin) / size)


class Grid:
    """Quadtree cells over a square: level 0 is the whole of it, each level halves the side."""

    def __init__(self, x: float, y: float, span: float):
        self.x, self.y, self.span = x, y, span

    def size(self, level: Column) -> Column:
        return F.lit(self.span) / F.pow(F.lit(2.0), level)

    def at(self, level: Column, x: Column, y: Column) -> list[Column]:
        size = self.size(level)
        return [_cell(x, F.lit(self.x), size).alias("_cx"), _cell(y, F.lit(self.y), size).alias("_cy")]

    def sides(self, level: Column, cx: Column, cy: Column) -> tuple[Column, ...]:
        """Lower and upper x, then y, a hair wider than the cell, for rounding."""
        size, slack = self.size(level), F.lit(self.span * 1e-9)
        low_x, low_y = F.lit(self.x) + cx * size, F.lit(self.y) + cy * size
        return low_x - slack, low_x + size + slack, low_y - slack, low_y + size + slack


def _crosses(e: Column, x1: Column, x2: Column, y1: Column, y2: Column) -> Column:
    """Whether an edge may touch a box: their boxes meet and no corner test parts them."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    sides = [dx * (y - e["y1"]) - dy * (x - e["x1"]) for x in (x1, x2) for y in (y1, y2)]
    return (
        (F.least(e["x1"], e["x2"]) <= x2) & (F.greatest(e["x1"], e["x2"]) >= x1)
        & (F.least(e["y1"], e["y2"]) <= y2) & (F.greatest(e["y1"], e["y2"]) >= y1)
        & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)
    )


def refined(cells: DataFrame, grid: Grid, area: str, depth: int) -> DataFrame:
    """Boundary cells (area, _edges, _level, _cx, _cy) cut ``depth`` levels finer.

    A finer cell outside the polygon goes; one that no edge crosses lies inside and
    needs no edges any more (``_edges`` is NULL); a boundary cell keeps the edges that
    a ray to the right can meet.
    """
    out = None
    for _ in range(depth):
        halves = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
        child = cells.withColumn("_h", F.explode(halves)).select(
            area, "_edges", (F.col("_level") + 1).alias("_level"),
            (F.col("_cx") * 2 + F.col("_h.i")).alias("_cx"), (F.col("_cy") * 2 + F.col("_h.j")).alias("_cy"),
        )
        x1, x2, y1, y2 = grid.sides(F.col("_level"), F.col("_cx"), F.col("_cy"))
        near = F.filter(
            "_edges",
            lambda e: (F.greatest(e["x1"], e["x2"]) >= x1) & (F.least(e["y1"], e["y2"]) <= y2) & (F.greatest(e["y1"], e["y2"]) >= y1),
        )
        child = child.withColumn("_edges", near).withColumn("_cut", F.exists("_edges", lambda e: _crosses(e, x1, x2, y1, y2)))
        whole = child.where(~F.col("_cut")).where(geo.within((x1 + x2) / 2, (y1 + y2) / 2, F.col("_edges")))
        whole = whole.drop("_cut").withColumn("_edges", F.lit(None).cast(cells.schema["_edges"].dataType))
        out = whole if out is None else out.unionByName(whole)
        cells = child.where("_cut").drop("_cut")
    return cells if out is None else out.unionByName(cells)


#: exact tests that a boundary cell may cost before it is cut finer, by how many levels, and how often;
#: points of a cell that one task looks at, pairs that it looks at, and the number of such parts that are listed at most
HEAVY, FINER, CUTS, HOT, PAIRS, MOST_HOT = 4_000, 4, 4, 1_000_000, 20_000_000, 10_000
#: union of polygons: edges and points of a cell up to which its points are tested, levels that another is cut finer
#: at a time, and how often
FEW_EDGES, FEW_POINTS, STEP, STEPS = 256, 4, 2, 8

CELL = ["_level", "_cx", "_cy"]


def filed_cells(polygons: DataFrame, area: str, rings: str) -> tuple[DataFrame, Grid, Column] | None:
    """(area, _edges, cell): each polygon in the at most four cells of the level whose cells are
    at least as large as its box; the grid; and whether ``x, y`` is in the box of all. None without polygons."""
    boxed = materialize(
        polygons.select(
            F.col(area), geo.polygon_edges(F.col(rings)).alias("_edges"), geo.box(F.col(rings)).alias("_b")
        ).where(F.col("_b.x1").isNotNull()),
        "polygons",
    )
    extent = boxed.agg(
        F.min("_b.x1").alias("x"),
        F.min("_b.y1").alias("y"),
        F.greatest(F.max("_b.x2") - F.min("_b.x1"), F.max("_b.y2") - F.min("_b.y1")).alias("span"),
        F.max("_b.x2").alias("x2"),
        F.max("_b.y2").alias("y2"),
    ).first()
    if extent["span"] is None:
        return None
    span = float(extent["span"]) or 1.0
    grid = Grid(extent["x"], extent["y"], span)

    side = F.greatest(F.col("_b.x2") - F.col("_b.x1"), F.col("_b.y2") - F.col("_b.y1"))
    level = F.when(side <= span / 2.0**DEEPEST, F.lit(DEEPEST)).otherwise(
        F.least(F.floor(F.log2(F.lit(span) / side)), F.lit(DEEPEST))
    )
    filed = boxed.withColumn("_level", level.cast("int"))
    size = grid.size(F.col("_level"))
    for axis, origin in (("x", grid.x), ("y", grid.y)):
        filed = filed.withColumn(
            f"_c{axis}",
            F.explode(F.sequence(_cell(F.col(f"_b.{axis}1"), F.lit(origin), size), _cell(F.col(f"_b.{axis}2"), F.lit(origin), size))),
        )
    inside = F.col("x").between(extent["x"], extent["x2"]) & F.col("y").between(extent["y"], extent["y2"])
    return filed.select(area, "_edges", *CELL), grid, inside


def probes(points: DataFrame, cells: DataFrame, grid: Grid, *columns: str) -> DataFrame:
    """Every point with its cell at each level in use."""
    levels = [r[0] for r in cells.select("_level").distinct().collect()]  # at most DEEPEST + CUTS * FINER numbers
    at_levels = F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>"))
    columns = [c for c in dict.fromkeys(columns) if c not in ("x", "y")]
    return points.select(*columns, "x", "y", at_levels.alias("_level")).select(
        *columns, "x", "y", "_level", *grid.at(F.col("_level"), F.col("x"), F.col("y"))
    )


def loads(points: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """Points in each cell in use; counted before the shuffle."""
    counts = probes(points, cells, grid).groupBy(*CELL).agg(F.count("*").alias("_n"))
    return materialize(counts.join(cells.select(*CELL), CELL, "left_semi"), "loads")


def cover(points: DataFrame, filed: DataFrame, grid: Grid, area: str, heavy: int) -> DataFrame:
    """``filed``, cells that cost more than ``heavy`` exact tests cut finer."""
    done, waiting = None, filed
    for cut in range(CUTS):
        # costs are looked at only where points can be many
        load = loads(points, waiting, grid)
        costly = F.coalesce("_n", F.lit(0)) * F.size("_edges") > heavy
        if cut == 0 and load.agg(F.max("_n")).first()[0] is None:
            break
        marked = waiting.join(load, CELL, "left").withColumn("_costly", F.col("_edges").isNotNull() & costly)
        dense = marked.where("_costly").select(area, "_edges", *CELL)
        if dense.isEmpty():
            break
        light = materialize(marked.where(~F.col("_costly")).select(area, "_edges", *CELL), "cells")
        waiting = materialize(refined(dense, grid, area, FINER), "cells")
        done = light if done is None else done.unionByName(light)
    return waiting if done is None else done.unionByName(waiting)


def matches(points: DataFrame, cells: DataFrame, grid: Grid, keep: list[str], area: str, hot: int = HOT, pairs: int = PAIRS) -> DataFrame:
    """``keep`` columns of the points and ``area`` of the polygons they lie in, by cells. A cell with more than
    ``hot`` points or ``pairs`` pairs is met in parts: its points are dealt out and its polygons repeated for each."""
    rows = probes(points, cells, grid, *keep)
    load = loads(points, cells, grid).join(cells.groupBy(*CELL).agg(F.count("*").alias("_m")), CELL)
    load = materialize(load.withColumn("_pairs", F.col("_n") * F.col("_m")), "loads")
    total = load.agg(F.sum("_n"), F.sum("_pairs")).first()
    part, most = max(hot, (total[0] or 0) // MOST_HOT), max(pairs, (total[1] or 0) // MOST_HOT)
    parts = F.greatest(F.ceil(F.col("_n") / part), F.least(F.ceil(F.col("_pairs") / most), F.col("_n")))
    crowded = load.withColumn("_parts", parts.cast("int")).where("_parts > 1").select(*CELL, "_parts")
    join_on = CELL
    if not crowded.isEmpty():
        # at most two times MOST_HOT rows, so the hint is safe
        crowded = F.broadcast(materialize(crowded, "crowded"))
        rows = rows.join(crowded, CELL, "left").withColumn(
            "_part", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_parts")).cast("int"), F.lit(0))
        ).drop("_parts")
        cells = cells.join(crowded, CELL, "left").withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
        ).drop("_parts")
        join_on = [*CELL, "_part"]
    return (
        rows.join(cells, join_on)
        .where(F.col("_edges").isNull() | geo.within(F.col("x"), F.col("y"), F.col("_edges")))
        .select(*keep, area)
    )


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, keep: list[str], area: str = "area_id", rings: str = "rings",
    heavy: int = HEAVY, hot: int = HOT,
) -> DataFrame:
    """``keep`` columns of every point with the ``area`` it lies strictly
    within; a point in several areas gives several rows.

    Every polygon is filed at the grid level whose cell is at least as large as
    its box, hence in at most four cells. Where that would cost more than ``heavy``
    exact tests, the cell is cut into inner cells, whose points match without a test,
    and boundary cells with only the edges that matter there. A point probes its cell
    at each level in use. A cell with more than ``hot`` points, or with very many pairs, is met
    in parts, so that neither a polygon over everything nor a place with a third of the points is one task's.
    """
    found = filed_cells(polygons, area, rings)
    if found is None:
        kind = polygons.schema[area].dataType
        return points.select(*keep, F.lit(None).cast(kind).alias(area)).limit(0)
    filed, grid, inside = found
    points = points.where(inside)
    return matches(points, cover(points, filed, grid, area, heavy), grid, keep, area, hot)


def inside_study_area(
    points: DataFrame, polygons: DataFrame, id_col: str, rings: str = "rings", few: int = FEW_EDGES, few_points: int = FEW_POINTS
) -> DataFrame:
    """Points inside the union of all polygons; nothing is merged.

    Positions in a cell that lies in some polygon are in, and no other polygon is asked. Where a cell
    has at most ``few`` edges or ``few_points`` positions left, these are tested; others are cut finer. So
    a place that many polygons cover costs a few cells, not all pairs.
    """
    area = "area_id"
    found = filed_cells(polygons, area, rings)
    if found is None:
        return points.limit(0)
    waiting, grid, inside = found
    spots = materialize(points.where(inside).select("x", "y").distinct(), "spots")
    hits = None
    for step in range(STEPS + 1):
        load = loads(spots, waiting, grid)
        live = waiting.join(load, CELL)
        cells = materialize(live.groupBy(*CELL).agg(
            F.first("_n").alias("_n"), F.max(F.col("_edges").isNull()).alias("_whole"), F.sum(F.size("_edges")).alias("_e")
        ), "cells")
        light = (F.col("_e") <= few) | (F.col("_n") <= few_points) | F.lit(step == STEPS)
        taken = cells.where("_whole").select(*CELL)
        tested = waiting.join(cells.where(~F.col("_whole") & light).select(*CELL), CELL, "left_semi")
        new = probes(spots, waiting, grid).join(taken, CELL, "left_semi").select("x", "y").unionByName(
            matches(spots, tested, grid, ["x", "y"], area).select("x", "y")
        )
        new = materialize(new.distinct(), "inside")
        hits = new if hits is None else hits.unionByName(new)
        heavy = materialize(waiting.join(cells.where(~F.col("_whole") & ~light).select(*CELL), CELL, "left_semi"), "heavy")
        if heavy.isEmpty():
            break
        spots = materialize(spots.join(new, ["x", "y"], "left_anti"), "spots")
        waiting = materialize(refined(heavy.select(area, "_edges", *CELL), grid, area, STEP), "cells")
    ids = points.join(hits, ["x", "y"], "left_semi").select(id_col).distinct()
    return points.join(ids, id_col, "left_semi")


def category_vitality(
    pois: DataFrame,
    polygons: DataFrame,
    categories: dict[str, str],
    area: str = "ageb_id",
    rings: str = "rings",
    keep_empty: bool = False,
) -> DataFrame:
    """Points per area and category as columns, 0 where a category is missing.

    ``categories`` maps a category to its column. Areas without any point are
    left out unless ``keep_empty``.
    """
    found = filed_cells(polygons, area, rings)
    counts = [F.count_if(F.col("category") == c).alias(name) for c, name in categories.items()]
    if found is None:
        pivot = polygons.select(area, F.lit(None).cast("string").alias("category")).limit(0).groupBy(area).agg(*counts)
    else:
        filed, grid, inside = found
        pois = pois.where(inside)
        cells = cover(pois, filed, grid, area, HEAVY)
        # a cell inside an area adds its counts, whatever its number of points
        edge, inner = cells.where(F.col("_edges").isNotNull()), cells.where(F.col("_edges").isNull()).select(area, *CELL)
        tally = probes(pois, inner, grid, "category").groupBy(*CELL).agg(*counts)
        each = matches(pois, edge, grid, ["category"], area).groupBy(area).agg(*counts)
        whole = inner.join(materialize(tally, "tally"), CELL).select(area, *categories.values())
        pivot = each.unionByName(whole).groupBy(area).agg(*[F.sum(n).alias(n) for n in categories.values()])
    if not keep_empty:
        return pivot
    return polygons.select(area).distinct().join(pivot, area, "left").fillna(0, list(categories.values()))


def nearest_node(
    queries: DataFrame,
    nodes: DataFrame,
    query_id: str = "area_id",
    node_id: str = "node_id",
    leaf: int = 32,
    max_levels: int = 24,
) -> DataFrame:
    """(query_id, nearest_node, distance): the nearest node of each point,
    ties to the smallest node id.

    Nodes are sorted into a grid that is refined four-fold per axis and level,
    only where a cell holds more than ``leaf`` distinct positions. A query walks
    down from the root: it keeps the cells whose nearest corner is not farther
    than the farthest corner of its best cell. So each query carries a handful
    of cells per level, and a place with a third of all nodes and queries costs
    more levels, not more pairs.
    """
    spots = materialize(
        nodes.where(F.col("x").isNotNull() & F.col("y").isNotNull())
        .groupBy("x", "y")
        .agg(F.min(node_id).alias("_node")),
        "spots",
    )
    box = spots.agg(
        F.min("x").alias("x"), F.min("y").alias("y"),
        F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"),
    ).first()
    if box["span"] is None:
        raise ValueError("nodes is empty")
    span = float(box["span"]) or 1.0
    bits = 2 * max_levels
    # integer position of a node on the finest grid; coarser cells are shifts
    def position(c, origin):
        scaled = F.floor((F.col(c) - F.lit(origin)) / F.lit(span) * F.lit(2.0**bits)).cast("long")
        return F.least(scaled, F.lit(2**bits - 1))

    placed = spots.withColumn("_ix", position("x", box["x"])).withColumn("_iy", position("y", box["y"]))

    def at(level):
        shift = bits - 2 * level
        return F.shiftright("_ix", shift), F.shiftright("_iy", shift)

    live = queries.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        F.col(query_id).alias("_q"), F.col("x").alias("_qx"), F.col("y").alias("_qy"),
        F.array(F.struct(F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"))).alias("_cells"),
    )
    resolved = []
    for level in range(1, max_levels + 1):
        px, py = at(level - 1)
        cx, cy = at(level)
        cells = placed.groupBy(px.alias("px"), py.alias("py"), cx.alias("cx"), cy.alias("cy")).agg(
            F.count("*").alias("n"),
            F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2"),
        )
        qx, qy = F.col("_qx"), F.col("_qy")
        near_x = F.greatest(F.col("x1") - qx, qx - F.col("x2"), F.lit(0.0))
        near_y = F.greatest(F.col("y1") - qy, qy - F.col("y2"), F.lit(0.0))
        far_x = F.greatest(qx - F.col("x1"), F.col("x2") - qx)
        far_y = F.greatest(qy - F.col("y1"), F.col("y2") - qy)
        is_leaf = (F.col("n") <= leaf) if level < max_levels else F.lit(True)
        reached = (
            live.select("_q", "_qx", "_qy", F.explode("_cells").alias("_c"))
            .select("_q", "_qx", "_qy", F.col("_c.cx").alias("px"), F.col("_c.cy").alias("py"))
            .join(cells, ["px", "py"])
            .groupBy("_q", "_qx", "_qy")
            .agg(
                F.collect_list(
                    F.struct(
                        "cx", "cy", is_leaf.alias("leaf"),
                        (near_x * near_x + near_y * near_y).alias("near"),
                        (far_x * far_x + far_y * far_y).alias("far"),
                    )
                ).alias("_all")
            )
        )
        # widened by a hair so that rounding never drops the true answer
        bound = F.array_min(F.transform("_all", lambda c: c["far"])) * F.lit(1 + 1e-9)
        step = materialize(
            reached.select(
                "_q", "_qx", "_qy",
                bind(bound, lambda b: F.filter("_all", lambda c: c["near"] <= b)).alias("_kept"),
            ),
            "descent",
        )

        def some(leafness):
            picked = F.filter("_kept", lambda c: c["leaf"] == F.lit(leafness))
            cells_only = F.transform(picked, lambda c: F.struct(c["cx"].alias("cx"), c["cy"].alias("cy")))
            return step.select("_q", "_qx", "_qy", cells_only.alias("_cells")).where(F.size("_cells") > 0)

        found = (
            some(True)
            .select("_q", "_qx", "_qy", F.inline("_cells"))
            .join(placed.select(cx.alias("cx"), cy.alias("cy"), "x", "y", "_node"), ["cx", "cy"])
        )
        d = F.sqrt((F.col("x") - qx) * (F.col("x") - qx) + (F.col("y") - qy) * (F.col("y") - qy))
        resolved.append(found.select("_q", F.struct(d.alias("distance"), F.col("_node").alias("node")).alias("_best")))
        live = some(False)
        if live.isEmpty():
            break
    best = resolved[0]
    for more in resolved[1:]:
        best = best.unionByName(more)
    return best.groupBy("_q").agg(F.min("_best").alias("_best")).select(
        F.col("_q").alias(query_id), F.col("_best.node").alias("nearest_node"), F.col("_best.distance").alias("distance")
    )
