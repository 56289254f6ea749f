"""Geometry as column expressions.

A polygon is ``array<struct<x1,y1,x2,y2>>``: its ring edges in lon/lat degrees, all rings together. Inside means an odd
number of edges crossed by a ray to the east, so holes and several parts work. Edges are straight in lon/lat; a point
exactly on a border may fall on either side.

Distances are measured on a sphere. Points become unit vectors, where the straight (chord) distance grows with the
great-circle distance, so the nearest by chord is the nearest on the sphere, with no special case at poles or at the
180-degree line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelspark.functions.flags import as_column

EARTH_RADIUS_M = 6371010.0  # fixed value: mean radius of the sphere used for distances


def edges_from_wkt(c: str | Column) -> Column:
    """Edges of a POLYGON or MULTIPOLYGON text (the last point of each ring repeats the first)."""
    rings = F.regexp_extract_all(as_column(c), F.lit(r"\(([^()]+)\)"), F.lit(1))

    def ring_edges(ring: Column) -> Column:
        points = F.transform(
            F.split(F.trim(ring), r"\s*,\s*"),
            lambda p: F.transform(F.split(F.trim(p), r"\s+"), lambda v: v.cast("double")),
        )
        starts, ends = F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1)
        return F.zip_with(starts, ends, edge)

    return F.flatten(F.transform(rings, ring_edges))


def edge(start: Column, end: Column) -> Column:
    """One edge struct from two ``[x, y]`` arrays."""
    return F.struct(start[0].alias("x1"), start[1].alias("y1"), end[0].alias("x2"), end[1].alias("y2"))


def box_of(edges: str | Column) -> dict[str, Column]:
    e = as_column(edges)
    xs, ys = F.transform(e, lambda s: s["x1"]), F.transform(e, lambda s: s["y1"])
    return {"box_x0": F.array_min(xs), "box_y0": F.array_min(ys), "box_x1": F.array_max(xs), "box_y1": F.array_max(ys)}


def inside(edges: str | Column, x: str | Column, y: str | Column) -> Column:
    px, py = as_column(x), as_column(y)

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > py) != (e["y2"] > py)
        # a level edge never spans, so the nullif only keeps ANSI mode from raising on it
        at = (e["x2"] - e["x1"]) * (py - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return spans & (px < at)

    return F.size(F.filter(as_column(edges), crosses)) % 2 == 1


def same_side(edges: str | Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether the way from one point up or down and then across to another crosses an even number of the edges.

    Both ends take the same side then, if the edges are all that the way can meet. Ends on the way count as in ``inside``.
    """
    def met(e: Column) -> Column:
        rise, run = e["y2"] - e["y1"], e["x2"] - e["x1"]
        at_y = rise * (x0 - e["x1"]) / F.nullif(run, F.lit(0.0)) + e["y1"]
        at_x = run * (y1 - e["y1"]) / F.nullif(rise, F.lit(0.0)) + e["x1"]
        up = ((e["x1"] > x0) != (e["x2"] > x0)) & ((at_y > y0) != (at_y > y1))
        across = ((e["y1"] > y1) != (e["y2"] > y1)) & ((at_x > x0) != (at_x > x1))
        return F.coalesce(up, F.lit(False)) != F.coalesce(across, F.lit(False))

    return F.size(F.filter(as_column(edges), met)) % 2 == 0


def touching(edges: str | Column, x0: Column, y0: Column, width: Column, height: Column) -> Column:
    """The edges that come into a box, or within a billionth of its size of it."""
    def near(e: Column) -> Column:
        dx, dy = width * 1e-9, height * 1e-9
        boxes = (F.least(e["x1"], e["x2"]) <= x0 + width + dx) & (F.greatest(e["x1"], e["x2"]) >= x0 - dx) \
            & (F.least(e["y1"], e["y2"]) <= y0 + height + dy) & (F.greatest(e["y1"], e["y2"]) >= y0 - dy)
        # the edge's line misses the box if the middle is farther from it, in this measure, than every corner is from the middle
        rise, run = e["y2"] - e["y1"], e["x2"] - e["x1"]
        middle = run * (y0 + height / 2 - e["y1"]) - rise * (x0 + width / 2 - e["x1"])
        return boxes & (F.abs(middle) <= (F.abs(run) * height + F.abs(rise) * width) * (0.5 + 1e-9))

    return F.filter(as_column(edges), near)


def unit_vector(lon: str | Column, lat: str | Column) -> tuple[Column, Column, Column]:
    a, b = F.radians(as_column(lon)), F.radians(as_column(lat))
    return F.cos(b) * F.cos(a), F.cos(b) * F.sin(a), F.sin(b)


def chord_to_metres(squared: Column) -> Column:
    # least() skips NULL, so a missing distance has to be kept missing here
    metres = F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(squared) / F.lit(2.0)))
    return F.when(squared.isNotNull(), metres)


def sphere_distance_m(lon1, lat1, lon2, lat2) -> Column:
    return chord_to_metres(squared_to_point(unit_vector(lon1, lat1), unit_vector(lon2, lat2)))


def squared_to_point(p, q) -> Column:
    return sum((F.pow(u - v, F.lit(2)) for u, v in zip(p, q)), F.lit(0.0))


def position_on_segment(p, a, b) -> Column:
    """Where between ``a`` (0) and ``b`` (1) the segment comes closest to ``p``."""
    d = [v - u for u, v in zip(a, b)]
    length2 = sum((F.pow(v, F.lit(2)) for v in d), F.lit(0.0))
    along = sum(((u - w) * v for u, w, v in zip(p, a, d)), F.lit(0.0))
    # a segment of length zero has no position: its ends are the same point
    share = F.coalesce(along / F.nullif(length2, F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))


def squared_to_segment_at(p, a, b, t: Column) -> Column:
    """Squared distance from ``p`` to the point of the segment at position ``t``."""
    return sum((F.pow(u - (w + t * (v - w)), F.lit(2)) for u, w, v in zip(p, a, b)), F.lit(0.0))
