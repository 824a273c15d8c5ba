"""Column expressions over planar points, rings and a conic projection.

A polygon is ``rings: array<array<struct<x,y>>>``; rings may be closed or
open. Insideness uses the even-odd rule over all rings, so holes and several
parts need no special case.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs including the closing one. A ring that repeats
    its first vertex yields one zero-length edge, which changes nothing."""
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def _cross(e: Column) -> Column:
    return e["x1"] * e["y2"] - e["x2"] * e["y1"]


def signed_area(edges: Column) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + _cross(e)) / 2


def centroid(edges: Column) -> Column:
    """Area centroid by the shoelace sums. Holes must wind against the
    exterior. A polygon without area gives NULL coordinates."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    sums = F.aggregate(
        edges,
        zero,
        lambda acc, e: F.struct(
            (acc["a"] + _cross(e)).alias("a"),
            (acc["x"] + (e["x1"] + e["x2"]) * _cross(e)).alias("x"),
            (acc["y"] + (e["y1"] + e["y2"]) * _cross(e)).alias("y"),
        ),
    )
    return F.struct(
        F.try_divide(sums["x"], 3 * sums["a"]).alias("x"),
        F.try_divide(sums["y"], 3 * sums["a"]).alias("y"),
    )


def on_boundary(x: Column, y: Column, edges: Column) -> Column:
    return F.exists(
        edges,
        lambda e: ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])),
    )


def within(x: Column, y: Column, edges: Column) -> Column:
    """Strictly inside: an odd number of edges to the right, none touching."""
    crossings = F.filter(
        edges,
        lambda e: ((e["y1"] > y) != (e["y2"] > y))
        & (x < e["x1"] + (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"])),
    )
    return (F.size(crossings) % 2 == 1) & ~on_boundary(x, y, edges)


def box(rings: Column) -> Column:
    """Bounding box over every vertex."""
    xs = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"])))
    ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["y"])))
    return F.struct(
        F.array_min(xs).alias("x1"),
        F.array_min(ys).alias("y1"),
        F.array_max(xs).alias("x2"),
        F.array_max(ys).alias("y2"),
    )


class ConicProjection:
    """Lambert conformal conic with two standard parallels on an ellipsoid
    (Snyder 1987, USGS Professional Paper 1395, equations 15-1 to 15-11)."""

    def __init__(self, lat1, lat2, lat0, lon0, false_east, false_north, axis, inverse_flattening):
        f = 1.0 / inverse_flattening
        self.e = math.sqrt(2 * f - f * f)
        m1, m2 = self._m(math.radians(lat1)), self._m(math.radians(lat2))
        t0, t1, t2 = (self._t(math.radians(v)) for v in (lat0, lat1, lat2))
        self.n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
        self.scale = axis * m1 / (self.n * t1**self.n)
        self.rho0 = self.scale * t0**self.n
        self.lon0 = math.radians(lon0)
        self.east, self.north = false_east, false_north

    def _m(self, lat):
        return math.cos(lat) / math.sqrt(1 - (self.e * math.sin(lat)) ** 2)

    def _t(self, lat):
        s = self.e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    def forward(self, lon: Column, lat: Column) -> Column:
        phi, lam = F.radians(lat), F.radians(lon)
        s = F.lit(self.e) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(self.e / 2))
        rho = F.lit(self.scale) * F.pow(t, F.lit(self.n))
        theta = F.lit(self.n) * (lam - F.lit(self.lon0))
        return F.struct(
            (F.lit(self.east) + rho * F.sin(theta)).alias("x"),
            (F.lit(self.north + self.rho0) - rho * F.cos(theta)).alias("y"),
        )

    def inverse(self, x: Column, y: Column, steps: int = 6) -> Column:
        """The latitude series converges below 1e-12 rad in six steps."""
        dx, dy = x - F.lit(self.east), F.lit(self.rho0 + self.north) - y
        rho = F.sqrt(dx * dx + dy * dy) * F.lit(math.copysign(1.0, self.n))
        t = F.pow(rho / F.lit(self.scale), F.lit(1.0 / self.n))
        lam = F.atan2(dx, dy) / F.lit(self.n) + F.lit(self.lon0)
        phi = F.lit(math.pi / 2) - 2 * F.atan(t)
        for _ in range(steps):
            s = F.lit(self.e) * F.sin(phi)
            phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(self.e / 2)))
        return F.struct(F.degrees(lam).alias("lon"), F.degrees(phi).alias("lat"))


# fixed values: Mexico ITRF2008 LCC (EPSG 6372) on the GRS80 ellipsoid
MEXICO_LCC = ConicProjection(
    lat1=17.5, lat2=29.5, lat0=12.0, lon0=-102.0,
    false_east=2_500_000.0, false_north=0.0,
    axis=6_378_137.0, inverse_flattening=298.257222101,
)
