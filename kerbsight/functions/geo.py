"""Geometry as nested arrays: ``array<array<struct<x,y>>>`` (parts, then vertices).

Everything here is a plain column expression, so geometry work stays inside the
scan stage. Coordinates are LV95 metres unless a name says otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


# --------------------------------------------------------------- coordinate systems
# The published polynomials between LV95 and WGS84.
def lv95_to_lon(east: Column, north: Column) -> Column:
    y, x = (east - 2.6e6) / 1e6, (north - 1.2e6) / 1e6
    return (2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y) * 100 / 36


def lv95_to_lat(east: Column, north: Column) -> Column:
    y, x = (east - 2.6e6) / 1e6, (north - 1.2e6) / 1e6
    return (
        16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x
        - 0.0447 * y * y * x - 0.0140 * x * x * x
    ) * 100 / 36


def wgs84_to_east(lon: Column, lat: Column) -> Column:
    p, k = (lat * 3600 - 169028.66) / 1e4, (lon * 3600 - 26782.5) / 1e4
    return 2600072.37 + 211455.93 * k - 10938.51 * k * p - 0.36 * k * p * p - 44.54 * k * k * k


def wgs84_to_north(lon: Column, lat: Column) -> Column:
    p, k = (lat * 3600 - 169028.66) / 1e4, (lon * 3600 - 26782.5) / 1e4
    return (
        1200147.07 + 308807.95 * p + 3745.25 * k * k + 76.63 * p * p
        - 194.56 * k * k * p + 119.79 * p * p * p
    )


def _each_vertex(geom: Column, fx, fy) -> Column:
    return F.transform(
        geom, lambda part: F.transform(part, lambda v: point(fx(v["x"], v["y"]), fy(v["x"], v["y"])))
    )


def geom_to_wgs84(geom: Column) -> Column:
    return _each_vertex(geom, lv95_to_lon, lv95_to_lat)


def geom_to_lv95(geom: Column) -> Column:
    return _each_vertex(geom, wgs84_to_east, wgs84_to_north)


# ------------------------------------------------------------------------- measures
def compass_bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Initial great-circle bearing in degrees, 0..360."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    east = F.sin(d) * F.cos(b)
    north = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def segments(part: Column) -> Column:
    """Consecutive vertex pairs of one line part as structs ``x1,y1,x2,y2``."""
    n = F.size(part)
    return F.when(
        n > 1,
        F.transform(
            F.sequence(F.lit(1), n - 1),
            lambda i: F.struct(
                F.element_at(part, i)["x"].alias("x1"), F.element_at(part, i)["y"].alias("y1"),
                F.element_at(part, i + 1)["x"].alias("x2"), F.element_at(part, i + 1)["y"].alias("y2"),
            ),
        ),
    )


def geom_segments(geom: Column) -> Column:
    """All segments of all parts in one array."""
    return F.flatten(F.transform(geom, segments))


def part_length(part: Column) -> Column:
    return F.aggregate(
        F.coalesce(segments(part), F.array()),
        F.lit(0.0),
        lambda acc, s: acc + F.sqrt((s["x2"] - s["x1"]) * (s["x2"] - s["x1"]) + (s["y2"] - s["y1"]) * (s["y2"] - s["y1"])),
    )


def has_length(part: Column) -> Column:
    """True unless all vertices coincide."""
    first = F.element_at(part, 1)
    return F.exists(part, lambda v: (v["x"] != first["x"]) | (v["y"] != first["y"]))


def extent(geom: Column) -> tuple[Column, Column, Column, Column]:
    """Smallest and largest x and y over all vertices."""
    vertices = F.flatten(geom)
    xs, ys = F.transform(vertices, lambda v: v["x"]), F.transform(vertices, lambda v: v["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def point_segment_sq(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance from a point to a segment.

    The segment is taken from its smaller end first, so a street stored once in
    each direction gives the same value twice and ties stay ties.
    """
    swap = (x2 < x1) | ((x2 == x1) & (y2 < y1))
    ax, ay = F.when(swap, x2).otherwise(x1), F.when(swap, y2).otherwise(y1)
    bx, by = F.when(swap, x1).otherwise(x2), F.when(swap, y1).otherwise(y2)
    dx, dy = bx - ax, by - ay
    along = F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return ex * ex + ey * ey


# ----------------------------------------------------------------------- visibility
def sight_quad(part: Column, distance: float = 30.0, half_angle: float = 45.0,
               side: str = "left", ray_sign: int = 1) -> Column:
    """Four-vertex ring seen from one line part; NULL for a line without length.

    The base runs from the first to the last vertex. One ray leaves each end, at
    the outward normal turned by the half angle (towards opposite sides at the two
    ends). The ring start, end, end ray, start ray crosses itself exactly when the
    far side is turned round (``base + 2 s d sin(half) < 0``); the far vertices are
    then exchanged, so that every ring is convex.
    """
    if distance <= 0 or not 0 < half_angle <= 85:
        raise ValueError("distance must be positive and the half angle within (0, 85]")
    turn = 90.0 if side.lower() == "left" else -90.0
    a, b = F.element_at(part, 1), F.element_at(part, -1)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    tangent = F.degrees(F.atan2(dy, dx))
    base = F.sqrt(dx * dx + dy * dy)

    def ray(end: Column, offset: float) -> Column:
        angle = F.radians(tangent + offset)
        return point(end["x"] + distance * F.cos(angle), end["y"] + distance * F.sin(angle))

    start_ray = ray(a, turn + ray_sign * half_angle)
    end_ray = ray(b, turn - ray_sign * half_angle)
    outward = ray_sign if turn > 0 else -ray_sign
    crosses = base + 2.0 * outward * distance * math.sin(math.radians(half_angle)) < 0
    ring = F.when(crosses, F.array(a, b, start_ray, end_ray)).otherwise(F.array(a, b, end_ray, start_ray))
    return F.when(has_length(part), ring)


def sight_rings(geom: Column, **options) -> Column:
    """The rings of all parts. Touching any ring is the same as touching their union."""
    rings = F.transform(geom, lambda part: sight_quad(part, **options))
    return F.filter(rings, lambda ring: ring.isNotNull())


def polygon_centroid(vertices: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """Centroid of one ring given as a list of coordinate columns (shoelace formula
    about the first vertex)."""
    ox, oy = vertices[0]
    local = [(x - ox, y - oy) for x, y in vertices]
    twice_area = mx = my = F.lit(0.0)
    for (px, py), (qx, qy) in zip(local, local[1:] + local[:1]):
        cross = px * qy - qx * py
        twice_area, mx, my = twice_area + cross, mx + (px + qx) * cross, my + (py + qy) * cross
    return ox + F.try_divide(mx, 3 * twice_area), oy + F.try_divide(my, 3 * twice_area)


# ------------------------------------------------------------------------ predicates
def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Positive when the point lies left of the directed line a -> b."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def quad_turn(quad: list[tuple[Column, Column]]) -> Column:
    """1.0 for a quad that turns left, -1.0 for one that turns right, 0.0 for one without area."""
    area = sum(
        (quad[i][0] - quad[0][0]) * (quad[i + 1][1] - quad[0][1])
        - (quad[i + 1][0] - quad[0][0]) * (quad[i][1] - quad[0][1])
        for i in (1, 2)
    )
    return F.signum(area)


def quad_meets_segment(quad: list[tuple[Column, Column]], x1: Column, y1: Column, x2: Column, y2: Column,
                       turn: Column | None = None) -> Column:
    """Closed intersection test of a convex quad and a segment (touching counts).

    Two convex shapes are apart exactly when an edge of one of them separates them:
    both segment ends strictly outside one quad edge, or all quad vertices strictly
    on one side of the segment's line. ``turn`` may give the quad's :func:`quad_turn`:
    with it the test stays within what the JVM compiles.
    """
    turn = quad_turn(quad) if turn is None else turn
    apart = F.lit(False)
    for i in range(4):
        (ax, ay), (bx, by) = quad[i], quad[(i + 1) % 4]
        apart = apart | (
            (turn * _side(ax, ay, bx, by, x1, y1) < 0) & (turn * _side(ax, ay, bx, by, x2, y2) < 0)
        )
    sides = [_side(x1, y1, x2, y2, vx, vy) for vx, vy in quad]
    apart = apart | (F.least(*sides) > 0) | (F.greatest(*sides) < 0)
    # a segment without length has no line of its own; the quad edges decide alone
    return ~apart


def within_buffer_sight(px: Column, py: Column, line: Column, buffer: float = 50.0,
                        extension: float = 25.0, circle: float = 50.0) -> Column:
    """Point test of the buffer variant: near the line, but outside the circles
    around the two points that prolong it beyond its ends."""
    a, b = F.element_at(line, 1), F.element_at(line, -1)
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    length = F.sqrt(dx * dx + dy * dy)
    ux, uy = F.try_divide(dx, length), F.try_divide(dy, length)

    def beyond(end: Column, sign: float) -> Column:
        ex, ey = end["x"] + sign * extension * ux - px, end["y"] + sign * extension * uy - py
        return ex * ex + ey * ey > circle * circle

    near = F.array_min(
        F.transform(segments(line), lambda s: point_segment_sq(px, py, s["x1"], s["y1"], s["x2"], s["y2"]))
    )
    return (near <= buffer * buffer) & beyond(a, -1.0) & beyond(b, 1.0)
