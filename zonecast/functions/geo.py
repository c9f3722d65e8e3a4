"""Geometry as column expressions over ring arrays.

A polygon part is ``rings: ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>``: ring 0 is the
exterior, the others are holes; every ring is closed (last vertex = first vertex).
Spark 4.1 has no ST_Within, so the predicates below are written with higher-order
functions (``aggregate`` / ``exists``) and stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spherical (web) Mercator radius of EPSG:3857, metres.
MERCATOR_RADIUS = 6378137.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _edges(ring: Column) -> Column:
    return F.sequence(F.lit(1), F.size(ring) - 1)


def ring_crossings(ring: Column, px: Column, py: Column) -> Column:
    """Number of ring edges crossed by the ray from (px, py) towards +x."""
    def step(acc, i):
        a = F.get(ring, i - 1)
        b = F.get(ring, i)
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        straddles = (ay > py) != (by > py)
        x_at = F.try_divide((bx - ax) * (py - ay), by - ay) + ax
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))
    return F.aggregate(_edges(ring), F.lit(0), step)


def ring_touches(ring: Column, px: Column, py: Column) -> Column:
    """True when (px, py) lies exactly on an edge or vertex of the ring."""
    def on_edge(i):
        a = F.get(ring, i - 1)
        b = F.get(ring, i)
        ax, ay, bx, by = a["x"], a["y"], b["x"], b["y"]
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        return ((cross == 0)
                & px.between(F.least(ax, bx), F.greatest(ax, bx))
                & py.between(F.least(ay, by), F.greatest(ay, by)))
    return F.exists(_edges(ring), on_edge)


def point_within(rings, px, py) -> Column:
    """Strict point-in-polygon ("within"): inside by crossing parity over all rings
    (holes included), and not on any boundary."""
    rings, px, py = _c(rings), _c(px), _c(py)
    crossings = F.aggregate(rings, F.lit(0), lambda acc, r: acc + ring_crossings(r, px, py))
    touches = F.exists(rings, lambda r: ring_touches(r, px, py))
    return ((crossings % 2) == 1) & ~touches


def ring_bounds(rings) -> dict[str, Column]:
    """Bounding box of the exterior ring."""
    ext = F.get(_c(rings), 0)
    xs = F.transform(ext, lambda p: p["x"])
    ys = F.transform(ext, lambda p: p["y"])
    return {"minx": F.array_min(xs), "maxx": F.array_max(xs),
            "miny": F.array_min(ys), "maxy": F.array_max(ys)}


def mercator_x(lon) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.radians(_c(lon))


def mercator_y(lat) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / 2))


def mercator_lon(x) -> Column:
    return F.degrees(_c(x) / F.lit(MERCATOR_RADIUS))


def mercator_lat(y) -> Column:
    return F.degrees(F.lit(2.0) * F.atan(F.exp(_c(y) / F.lit(MERCATOR_RADIUS))) - F.lit(math.pi / 2))


def ring_area_moments(ring) -> Column:
    """STRUCT(a, ax, ay) for a ring in projected metres: signed shoelace area and area
    moments, computed relative to the first vertex for numerical stability."""
    ring = _c(ring)
    pts = F.transform(ring, lambda p: F.struct(mercator_x(p["x"]).alias("x"), mercator_y(p["y"]).alias("y")))
    x0 = F.get(pts, 0)["x"]
    y0 = F.get(pts, 0)["y"]

    def step(acc, i):
        a = F.get(pts, i - 1)
        b = F.get(pts, i)
        ax, ay = a["x"] - x0, a["y"] - y0
        bx, by = b["x"] - x0, b["y"] - y0
        cr = ax * by - bx * ay
        return F.struct((acc["a"] + cr / 2).alias("a"),
                        (acc["ax"] + (ax + bx) * cr / 6).alias("ax"),
                        (acc["ay"] + (ay + by) * cr / 6).alias("ay"),
                        acc["x0"].alias("x0"), acc["y0"].alias("y0"))
    init = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("ax"), F.lit(0.0).alias("ay"),
                    x0.alias("x0"), y0.alias("y0"))
    return F.aggregate(F.sequence(F.lit(1), F.size(ring) - 1), init, step)


# -- flat edge lists (cell index) ------------------------------------------------------

def edges_crossings(edges, px, py) -> Column:
    """Crossings of the ray from (px, py) towards +x with a list of STRUCT(ax, ay, bx, by)
    edges (same half-open rule as :func:`ring_crossings`)."""
    edges, px, py = _c(edges), _c(px), _c(py)

    def step(acc, e):
        straddles = (e["ay"] > py) != (e["by"] > py)
        x_at = F.try_divide((e["bx"] - e["ax"]) * (py - e["ay"]), e["by"] - e["ay"]) + e["ax"]
        return acc + F.when(straddles & (px < x_at), F.lit(1)).otherwise(F.lit(0))
    return F.aggregate(edges, F.lit(0), step)


def edges_touch(edges, px, py) -> Column:
    edges, px, py = _c(edges), _c(px), _c(py)

    def on_edge(e):
        cross = (e["bx"] - e["ax"]) * (py - e["ay"]) - (e["by"] - e["ay"]) * (px - e["ax"])
        return ((cross == 0)
                & px.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
                & py.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])))
    return F.exists(edges, on_edge)


def point_within_edges(edges, px, py) -> Column:
    return ((edges_crossings(edges, px, py) % 2) == 1) & ~edges_touch(edges, px, py)
