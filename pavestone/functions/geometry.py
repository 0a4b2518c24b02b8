"""Planar geometry as column expressions (G-01 .. G-30).

A point is struct<x, y>, a line or ring an array of points (rings are closed:
the last point is the first), a polygon an array of rings, outer ring first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vectors as V

TWO_PI = 2 * math.pi


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def distance(p: Column, q: Column) -> Column:
    return F.sqrt((q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"]))


def segments(line: Column) -> Column:
    """G-15: array of (a, b) of consecutive points."""
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.zip_with(F.slice(line, 1, n), F.slice(line, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def length(line: Column) -> Column:
    """G-01: 0 for fewer than two points."""
    return F.aggregate(segments(line), F.lit(0.0), lambda s, g: s + distance(g["a"], g["b"]))


def n_points(line: Column) -> Column:
    return F.size(line)


def start(line: Column) -> Column:
    return F.try_element_at(line, F.lit(1))


def end(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def azimuth(p: Column, q: Column) -> Column:
    """G-02: clockwise from north, 0 .. 2 pi; null for equal points."""
    same = (p["x"] == q["x"]) & (p["y"] == q["y"])
    return F.when(~same, F.pmod(F.atan2(q["x"] - p["x"], q["y"] - p["y"]), F.lit(TWO_PI)))


def angle_difference(a: Column, b: Column) -> Column:
    """G-03: between two directions in degrees, 0 .. 180."""
    d = F.pmod(a - b, F.lit(360.0)) + 0.0  # no negative zero
    return F.least(d, 360.0 - d)


def angle_difference_undirected(a: Column, b: Column) -> Column:
    """G-03: between two axes in degrees, 0 .. 90."""
    d = F.pmod(a - b, F.lit(180.0)) + 0.0
    return F.least(d, 180.0 - d)


def cumulative(line: Column) -> Column:
    """Distances along the line of its points: starts with 0."""
    return F.aggregate(
        segments(line), F.array(F.lit(0.0)), lambda acc, g: F.concat(acc, F.array(F.try_element_at(acc, F.lit(-1)) + distance(g["a"], g["b"])))
    )


def interpolate_at(line: Column, d: Column) -> Column:
    """G-04: the point at a distance along the line, clamped to its ends."""
    return V.interpolate_at(line, d)


def along(a: Column, b: Column, t: Column) -> Column:
    return point(a["x"] + (b["x"] - a["x"]) * t, a["y"] + (b["y"] - a["y"]) * t)


def interpolate(line: Column, fraction: Column) -> Column:
    """G-04: the point at a fraction of the length."""
    return interpolate_at(line, F.least(F.greatest(fraction, F.lit(0.0)), F.lit(1.0)) * length(line))


def _nearest_on(g: Column, p: Column) -> Column:
    """(distance, t) of the closest point of a segment."""
    dx, dy = g["b"]["x"] - g["a"]["x"], g["b"]["y"] - g["a"]["y"]
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.least(F.greatest(((p["x"] - g["a"]["x"]) * dx + (p["y"] - g["a"]["y"]) * dy) / size, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    return F.struct(distance(along(g["a"], g["b"], t), p).alias("d"), t.alias("t"))


def _closest_segment(line: Column, p: Column) -> Column:
    """(d, i, t) of the segment closest to p: distance, its number from 0, and the fraction along it; the first of equal ones."""
    return F.array_min(F.transform(segments(line), lambda g, i: F.struct(_nearest_on(g, p)["d"].alias("d"), i.alias("i"), _nearest_on(g, p)["t"].alias("t"))))


def locate(line: Column, p: Column) -> Column:
    """G-05: (d, at, total): distance to the line, where its closest point lies along it, and its length; the first of equal ones."""
    near = _closest_segment(line, p)
    last = F.try_element_at(segments(line), near["i"] + 1)
    at = length(F.slice(line, F.lit(1), near["i"] + 1)) + near["t"] * distance(last["a"], last["b"])
    return F.struct(near["d"].alias("d"), at.alias("at"), length(line).alias("total"))


def substring(line: Column, a: Column, b: Column) -> Column:
    """G-06: the part between two distances along the line."""
    return V.substring(line, a, b)


def tangent(line: Column, d: Column, window: float) -> Column:
    """G-08: azimuth (radians) between the points `window` before and after, clamped at the ends."""
    total = length(line)
    return azimuth(interpolate_at(line, F.greatest(d - window, F.lit(0.0))), interpolate_at(line, F.least(d + window, total)))


def project(p: Column, d: Column, az: Column) -> Column:
    """G-10: the point at a distance and azimuth."""
    return point(p["x"] + d * F.sin(az), p["y"] + d * F.cos(az))


def extend(line: Column, before: float, after: float) -> Column:
    """G-09: the line with its first and last segment made longer."""
    first = azimuth(F.try_element_at(line, F.lit(2)), F.try_element_at(line, F.lit(1)))
    last = azimuth(F.try_element_at(line, F.lit(-2)), F.try_element_at(line, F.lit(-1)))
    n = F.size(line)
    return F.concat(F.array(project(F.try_element_at(line, F.lit(1)), F.lit(before), first)), F.slice(line, 2, n - 2), F.array(project(F.try_element_at(line, F.lit(-1)), F.lit(after), last)))


def dedupe_points(line: Column, tolerance: float = 0.0) -> Column:
    """G-11: without points within the tolerance of the one kept before."""
    return F.aggregate(
        F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0))), F.slice(line, 1, 1), lambda acc, p: F.when(distance(F.try_element_at(acc, F.lit(-1)), p) > tolerance, F.concat(acc, F.array(p))).otherwise(acc)
    )


def reverse(line: Column) -> Column:
    return F.reverse(line)


def open_ring(ring: Column) -> Column:
    """G-12: a closed ring without its repeated last point."""
    a, b = start(ring), end(ring)
    return F.when((F.size(ring) > 1) & (a["x"] == b["x"]) & (a["y"] == b["y"]), F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def set_ends(line: Column, first: Column, last: Column) -> Column:
    """G-12: other first and last points; null keeps the old one."""
    return F.concat(F.array(F.coalesce(first, start(line))), F.slice(line, 2, F.size(line) - 2), F.array(F.coalesce(last, end(line))))


def snap_grid(p: Column, size: float) -> Column:
    """G-16."""
    return point(F.round(p["x"] / size) * size, F.round(p["y"] / size) * size)


def signed_area(ring: Column) -> Column:
    """G-17: positive for counter-clockwise rings."""
    return F.aggregate(segments(ring), F.lit(0.0), lambda s, g: s + (g["a"]["x"] * g["b"]["y"] - g["b"]["x"] * g["a"]["y"])) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def force_ccw(ring: Column) -> Column:
    return F.when(signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def centroid(ring: Column) -> Column:
    """G-18: of a ring's area; its first point if it has none."""
    return V.centroid(ring)


def envelope(line: Column) -> Column:
    """G-18: (xmin, ymin, xmax, ymax)."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def oriented_envelope(ring: Column) -> Column:
    """G-19: the least rectangle along any edge: (area, long, short, azimuth of the long side in degrees 0 .. 180)."""
    return V.oriented_envelope(ring)


def contains(polygon: Column, p: Column) -> Column:
    """G-20: even-odd over all rings; a point on an edge may count either way."""
    edges = F.flatten(F.transform(polygon, segments))
    crossed = F.aggregate(edges, F.lit(0), lambda n, g: n + F.when(_crosses_right(g, p), 1).otherwise(0))
    return F.pmod(crossed, F.lit(2)) == 1


def _crosses_right(g: Column, p: Column) -> Column:
    """Whether the ray to the right of p meets the edge."""
    over = (g["a"]["y"] > p["y"]) != (g["b"]["y"] > p["y"])
    return over & (p["x"] < (g["b"]["x"] - g["a"]["x"]) * (p["y"] - g["a"]["y"]) / (g["b"]["y"] - g["a"]["y"]) + g["a"]["x"])


def side_of(p: Column, a: Column, b: Column) -> Column:
    """G-21: 1 left of a -> b, -1 right of it, 0 on it."""
    return F.signum((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])).cast("int")


def convex_hull(points: Column) -> Column:
    """G-22: counter-clockwise from the lowest x, not closed."""
    return V.convex_hull(points)


def corridor_quads(line: Column, half_left: Column, half_right: Column) -> Column:
    """G-23: a quad (four corners) for each segment of a line, with flat ends."""

    def quad(g: Column) -> Column:
        d = distance(g["a"], g["b"])
        nx, ny = (g["b"]["y"] - g["a"]["y"]) / d, -(g["b"]["x"] - g["a"]["x"]) / d
        at = lambda p, w: point(p["x"] + nx * w, p["y"] + ny * w)
        return F.array(at(g["a"], half_right), at(g["b"], half_right), at(g["b"], -half_left), at(g["a"], -half_left))

    return F.transform(F.filter(segments(line), lambda g: distance(g["a"], g["b"]) > 0), quad)


def lens_area(r1: Column, r2: Column, d: Column) -> Column:
    """G-24: the common area of two circles."""
    small = F.least(r1, r2)
    clamp = lambda c: F.least(F.greatest(c, F.lit(-1.0)), F.lit(1.0))
    a1 = F.acos(clamp((d * d + r1 * r1 - r2 * r2) / (2 * d * r1)))
    a2 = F.acos(clamp((d * d + r2 * r2 - r1 * r1) / (2 * d * r2)))
    tri = F.sqrt(F.greatest((-d + r1 + r2) * (d + r1 - r2) * (d - r1 + r2) * (d + r1 + r2), F.lit(0.0)))
    return F.when(d >= r1 + r2, 0.0).when(d <= F.abs(r1 - r2), math.pi * small * small).otherwise(r1 * r1 * a1 + r2 * r2 * a2 - tri / 2)


def edge_key(a: Column, b: Column) -> Column:
    """G-25: the same for both directions of an edge."""
    return F.struct(F.least(a, b).alias("p"), F.greatest(a, b).alias("q"))


EARTH = 6378137.0


def to_mercator(lon: Column, lat: Column) -> Column:
    """G-27: 4326 to 3857."""
    return point(F.radians(lon) * EARTH, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * EARTH)


def from_mercator(p: Column) -> Column:
    """G-27: 3857 to 4326, x is the longitude."""
    return point(F.degrees(p["x"] / EARTH), F.degrees(2 * F.atan(F.exp(p["y"] / EARTH)) - math.pi / 2))


# fixed values: ellipsoid GRS80 and the transverse Mercator of zone 33 north
_FLAT = 1 / 298.257222101
_N = _FLAT / (2 - _FLAT)
_A = EARTH / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3, 13 / 48 * _N**2 - 3 / 5 * _N**3, 61 / 240 * _N**3]
_BETA = [_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, 1 / 48 * _N**2 + 1 / 15 * _N**3, 17 / 480 * _N**3]
_DELTA = [2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3]
_SCALE, _EAST, _LON0 = 0.9996, 500000.0, 15.0


def to_utm33(lon: Column, lat: Column) -> Column:
    """G-27: 4326 to 25833 by the Krueger series."""
    e = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    dl = F.radians(lon - _LON0)
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    y = xi + sum(a * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, a in enumerate(_ALPHA))
    x = eta + sum(a * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, a in enumerate(_ALPHA))
    return point(_EAST + _SCALE * _A * x, _SCALE * _A * y)


def from_utm33(p: Column) -> Column:
    """G-27: 25833 to 4326, x is the longitude."""
    xi, eta = p["y"] / (_SCALE * _A), (p["x"] - _EAST) / (_SCALE * _A)
    xi1 = xi - sum(b * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, b in enumerate(_BETA))
    eta1 = eta - sum(b * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, b in enumerate(_BETA))
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi + sum(d * F.sin(2 * (j + 1) * chi) for j, d in enumerate(_DELTA))
    return point(_LON0 + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))), F.degrees(lat))


def geodesic_area(ring: Column) -> Column:
    """G-28: square metres of a ring of (lon, lat) on the sphere of equal area (within 0.3 % of the ellipsoid)."""
    r = 6371007.181
    return F.abs(F.aggregate(segments(ring), F.lit(0.0), lambda s, g: s + F.radians(g["b"]["x"] - g["a"]["x"]) * (2 + F.sin(F.radians(g["a"]["y"])) + F.sin(F.radians(g["b"]["y"]))))) * (r * r / 2)


def normal_degrees(x: Column) -> Column:
    """G-30: whole degrees of [0, 360)."""
    return F.pmod(F.round(x).cast("int"), F.lit(360))


def closest_point(line: Column, p: Column) -> Column:
    """G-07: the point of a line that is closest to p; the first of equal ones."""
    near = _closest_segment(line, p)
    last = F.try_element_at(segments(line), near["i"] + 1)
    return along(last["a"], last["b"], near["t"])


def connectors(pairs: DataFrame, key: str = "pair_id") -> DataFrame:
    """G-07: (key, d, p, q): the shortest connection of the lines a and b of each row (key, a, b), from a to b; of length 0 where segments of theirs cross."""
    return pairs.select(key, V.connection(F.col("a"), F.col("b")).alias("m")).where("m is not null").select(key, "m.*")


def label_points(polygons: DataFrame, key: str = "poly_id") -> DataFrame:
    """G-29: (key, x, y): a point inside each polygon (key, rings): the centroid of its outer ring, or the middle of the widest stretch inside on the centroid's height."""
    return polygons.select(key, V.label_point(F.col("rings")).alias("p")).select(key, "p.x", "p.y")


def furthest_kept(x, y, tolerance: float):
    """The places of the vertices that Douglas-Peucker keeps, without recursion."""
    import numpy as np

    keep, todo = np.zeros(len(x), bool), [(0, len(x) - 1)]
    keep[[0, -1]] = True
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        size = dx * dx + dy * dy
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        t = np.clip((px * dx + py * dy) / size, 0, 1) if size > 0 else 0.0
        d = np.hypot(px - t * dx, py - t * dy)
        k = int(d.argmax())
        if d[k] > tolerance:
            keep[a + 1 + k] = True
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def simplify(lines: DataFrame, tolerance: float, key: str = "line_id") -> DataFrame:
    """G-26: lines (key, line) simplified by Douglas-Peucker; the search is not a fold over the vertices, so Arrow batches go through numpy."""
    import pyarrow as pa

    def task(it):
        import numpy as np

        for b in it:
            keys, rows = b.column(0), b.column(1)
            flat, offsets = rows.flatten(), np.concatenate([[0], np.cumsum([len(v) if v.is_valid else 0 for v in rows])])
            x, y = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            kept = [np.flatnonzero(furthest_kept(x[s:e], y[s:e], tolerance)) + s if e > s else np.zeros(0, np.int64) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            at = np.concatenate(kept) if kept else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in kept])])
            line = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat.take(pa.array(at, pa.int64())))
            yield pa.RecordBatch.from_arrays([keys, line], b.schema.names)

    some = lines.select(key, "line")
    return some.mapInArrow(task, some.schema)
