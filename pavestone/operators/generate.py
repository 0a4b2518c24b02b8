"""Generators: one row to many (E-01 .. E-42)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import tags as T

# fixed values: interval and first place of the markers of each kind
MARKERS = {"steps": (0.6, 0.0), "access_aisle": (1.0, 0.0), "ties": (0.9, 0.0), "ticks": (2.4, 0.8), "tactile": (1.0, 0.5), "separation": (2.0, 1.0), "bollard": (1.5, 0.0), "palisade": (0.2, 0.0), "retaining_wall": (2.0, 1.0)}


def marker_count(length: Column, interval: float, first: float = 0.0) -> Column:
    """How many markers lie on a line; its end is excluded by 1e-9."""
    room = length - F.lit(first) - 1e-9
    return F.when(room >= 0, F.floor(room / interval) + 1).otherwise(0).cast("int")


def marker_ranges(segments: DataFrame, interval: float, first: float = 0.0) -> DataFrame:
    """E-01, Q-04: segments (x1, y1, x2, y2, at, total, ...) with the numbers of the first (`low`) and last (`high`) marker that fall on them; those without one go."""
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    s = segments.withColumn("len", length).withColumn("stop", F.col("at") + F.col("len"))
    low = F.greatest(F.ceil((F.col("at") - first) / interval), F.lit(0))
    high = F.ceil((F.least("stop", F.col("total") - 1e-9) - first) / interval) - 1
    last = F.floor((F.col("total") - 1e-9 - first) / interval)
    end = F.when(F.col("stop") >= F.col("total"), last).otherwise(high)
    return s.withColumn("low", low).withColumn("high", end).where("high >= low")


def markers(segments: DataFrame, interval: float, first: float = 0.0, key: str = "line_id") -> DataFrame:
    """E-01: (key, k, at, x, y, azimuth) along lines given as segments (key, i, x1, y1, x2, y2, at, total).

    Each segment makes the markers that fall on it, so a long line spreads over tasks.
    """
    s = marker_ranges(segments, interval, first)
    k = s.select(key, "x1", "y1", "x2", "y2", "at", "len", F.explode(F.sequence("low", "high")).alias("k"))
    d = F.col("k") * F.lit(interval) + first
    t = (d - F.col("at")) / F.col("len")
    az = F.pmod(F.atan2(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")), F.lit(2 * math.pi))
    return k.select(key, "k", d.alias("at"), (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"), az.alias("azimuth"))


def marker_totals(segments: DataFrame, interval: float, first: float = 0.0, key: str = "line_id") -> DataFrame:
    """E-01: (key, n, last): how many `markers` each line has and where the last one lies; segments hold ranges of numbers, so no marker is a row."""
    ranges = marker_ranges(segments, interval, first).groupBy(key).agg(F.sum(F.col("high") - F.col("low") + 1).alias("n"), F.max("high").alias("k"))
    return ranges.select(key, "n", (F.col("k") * F.lit(interval) + first).alias("last"))


def bar(x: Column, y: Column, azimuth: Column, half: float, thick: float = 0.1) -> Column:
    """A bar across the line as a closed ring."""
    along = lambda a, b: G.point(x + a * F.cos(azimuth) + b * F.sin(azimuth), y - a * F.sin(azimuth) + b * F.cos(azimuth))
    return F.array(along(half, thick), along(half, -thick), along(-half, -thick), along(-half, thick), along(half, thick))


def triangle(x: Column, y: Column, azimuth: Column, radius: float) -> Column:
    """A triangle that points left of the line, as a closed ring."""
    at = lambda turn: G.point(x + radius * F.sin(azimuth + turn), y + radius * F.cos(azimuth + turn))
    return F.array(at(-math.pi / 2), at(math.pi / 6), at(5 * math.pi / 6), at(-math.pi / 2))


def turn_arrows(lines: DataFrame) -> DataFrame:
    """E-02: arrow places of lines (line_id, total, end_offset): every 12 back from 7.5 before the end offset, 40 at most, and forward from there (k < 0), 5 from the end, 2.5 from the start."""
    ahead = F.greatest(F.least(F.floor((F.col("end_offset") + 2.5) / 12), F.lit(40)), F.lit(0)).cast("int")
    k = F.explode(F.sequence(-ahead, F.lit(39)))
    rows = lines.select("line_id", "total", "end_offset", k.alias("k"))
    at = F.col("total") - F.col("end_offset") - 7.5 - 12 * F.col("k")
    return rows.withColumn("at", at).where((F.col("at") <= F.col("total") - 5) & (F.col("at") >= 2.5)).select("line_id", "k", "at")


def zebra_stripes(lines: DataFrame, every: float = 1.0, width: float = 0.5) -> DataFrame:
    """E-05: centred stripes across lines (line_id, total): floor((total - width) / every) + 1 of them."""
    n = F.floor((F.col("total") - width) / every) + 1
    rows = lines.where(F.col("total") >= width).withColumn("n", n.cast("int"))
    first = (F.col("total") - (F.col("n") - 1) * F.lit(every)) / 2
    return rows.select("line_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"), first.alias("first")).select("line_id", "k", (F.col("first") + F.col("k") * F.lit(every)).alias("at"))


def hex_cell(x: Column, y: Column, size: float) -> Column:
    """E-07: the axial hexagon (q, r) that holds a point, by cube rounding."""
    q, r = (math.sqrt(3) / 3 * x - y / 3) / size, (y * 2 / 3) / size
    s = -q - r
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(s + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    return F.struct(F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq).cast("long").alias("q"), F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -rq - rs).otherwise(rr).cast("long").alias("r"))


def hex_centre(q: Column, r: Column, size: float) -> Column:
    return G.point(size * math.sqrt(3) * (q + r / 2), size * 1.5 * r)


def fill_cells(boxes: DataFrame, trees: DataFrame, size: float = 6.0) -> DataFrame:
    """E-07: one stable point in each hexagon whose centre lies in a box (area_id, x0, y0, x1, y1) and that holds no tree (x, y).

    Synthetic ids are negative; shifts, crowns and leaf types come from stable fractions of the cell.
    """
    r0, r1 = F.ceil(F.col("y0") / (1.5 * size)), F.floor(F.col("y1") / (1.5 * size))
    rows = boxes.where(r1 >= r0).select("*", F.explode(F.sequence(r0, r1)).alias("r"))
    step = size * math.sqrt(3)
    q0, q1 = F.ceil(F.col("x0") / step - F.col("r") / 2), F.floor(F.col("x1") / step - F.col("r") / 2)
    cells = rows.where(q1 >= q0).select("area_id", "r", F.explode(F.sequence(q0, q1)).alias("q"))
    taken = trees.select(hex_cell(F.col("x"), F.col("y"), size).alias("c")).select("c.q", "c.r").distinct()
    free = cells.join(taken.hint("merge"), ["q", "r"], "left_anti").groupBy("q", "r").agg(F.min("area_id").alias("area_id"))
    key = F.col("q") * 1000003 + F.col("r")
    a, b, c, d = (T.stable_fraction(key, salt) for salt in (104729, 130363, 15485863, 32452843))
    p = hex_centre(F.col("q"), F.col("r"), size)
    return free.select(
        (-F.abs(key) - 1).alias("tree_id"), "area_id", "q", "r", (p["x"] + (a - 0.5) * size * 0.67).alias("x"), (p["y"] + (b - 0.5) * size * 0.67).alias("y"),
        T.round_half_up(F.lit(8.0) + c * 9, 1).alias("crown"), F.when(d < 0.33, "needleleaved").otherwise("broadleaved").alias("leaf_type"),
    )


def stop_line(nodes: DataFrame) -> DataFrame:
    """E-18: (node_id, x1, y1, x2, y2): a bar across the widest road at a node.

    `nodes` has a row per node and road: node_id, x, y, azimuth (degrees), width, placement_offset, angle (or null), road_id.
    """
    widest = nodes.groupBy("node_id").agg(F.min(F.struct((-F.col("width")).alias("w"), "road_id", "x", "y", "azimuth", "width", "placement_offset", "angle")).alias("m")).select("node_id", "m.*")
    az = F.radians(F.coalesce("angle", F.col("azimuth") + 90))
    back, ahead = F.col("width") / 2 - F.col("placement_offset"), F.col("width") / 2 + F.col("placement_offset")
    return widest.select("node_id", (F.col("x") - F.sin(az) * back).alias("x1"), (F.col("y") - F.cos(az) * back).alias("y1"), (F.col("x") + F.sin(az) * ahead).alias("x2"), (F.col("y") + F.cos(az) * ahead).alias("y2"))


def restriction_patterns(envelopes: DataFrame) -> DataFrame:
    """E-27: (area_id, k, at): zigzag places along the long side of an envelope (area_id, long, short), in steps of min(2 * short, 7)."""
    step = F.least(2 * F.col("short"), F.lit(7.0))
    n = F.greatest(F.floor(F.col("long") / step), F.lit(1)).cast("int")
    rows = envelopes.where("short > 0").withColumn("n", n)
    return rows.select("area_id", "n", "long", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("k")).select("area_id", "k", (F.col("k") * F.col("long") / F.col("n")).alias("at"), F.when(F.col("k") % 2 == 0, "front").otherwise("back").alias("side"))


def split_between_touches(touches: DataFrame) -> DataFrame:
    """E-40: (line_id, cut) between consecutive touches (line_id, at, width, direction): nearer the narrower one, the middle if both have no width."""
    one = touches.withColumn("at", F.round("at", 5)).groupBy("line_id", "at").agg(F.min(F.struct((-F.col("width")).alias("w"), "direction")).alias("m")).select("line_id", "at", (-F.col("m.w")).alias("width"))
    w = Window.partitionBy("line_id").orderBy("at")
    pairs = one.withColumn("p", F.lag("at").over(w)).withColumn("pw", F.lag("width").over(w)).where("p is not null")
    both = F.col("pw") + F.col("width")
    share = F.when(both > 0, F.col("pw") / F.nullif(both, F.lit(0.0))).otherwise(0.5)
    return pairs.select("line_id", (F.col("p") + (F.col("at") - F.col("p")) * share).alias("cut"))


def visible_area(areas: DataFrame, pairs: DataFrame) -> DataFrame:
    """E-37: (id, visible, exact): an area less the smaller ones over it (pairs: l_id, r_id, area, and `copies` of r_id if they are counted); not exact where those overlap each other."""
    small = pairs.join(areas.select(F.col("id").alias("l_id"), F.col("area").alias("la")).hint("merge"), "l_id").join(areas.select(F.col("id").alias("r_id"), F.col("area").alias("ra")).hint("merge"), "r_id").where("ra < la")
    copies = F.col("copies") if "copies" in pairs.columns else F.lit(1)
    cover = small.groupBy(F.col("l_id").alias("id")).agg(F.sum(pairs["area"] * copies).alias("covered"), F.sum(copies).alias("n"))
    return areas.join(cover.hint("merge"), "id", "left").select("id", F.greatest(F.col("area") - F.coalesce("covered", F.lit(0.0)), F.lit(0.0)).alias("visible"), (F.coalesce("n", F.lit(0)) <= 1).alias("exact"))


def visible_of_copies(areas: DataFrame, cell: float = 16.0) -> DataFrame:
    """E-37 for areas (id, rings, area) among themselves: equal areas hide nothing of each other, so each shape is looked at once and counts its copies."""
    from .spatial import as_shapes, shape_areas

    own = as_shapes(areas.withColumnRenamed("id", "l_id"), "l")
    right = own.select(F.col("l_id").alias("r_id"), F.col("l_shape").alias("r_shape"), "rings")
    n = own.groupBy(F.col("l_shape").alias("r_id")).agg(F.count(F.lit(1)).alias("copies"))
    met = shape_areas(own, right, cell).where("area > 1e-9 and l_shape <> r_shape").select(F.col("l_shape").alias("l_id"), F.col("r_shape").alias("r_id"), "area")
    pairs = met.join(n.hint("merge"), "r_id")
    seen = visible_area(own.where("l_id = l_shape").select(F.col("l_id").alias("id"), "area"), pairs)
    return own.select(F.col("l_id"), "l_shape").join(seen.withColumnRenamed("id", "l_shape").hint("merge"), "l_shape").select(F.col("l_id").alias("id"), "visible", "exact")


def face_road(nodes: DataFrame, major: DataFrame, others: DataFrame) -> DataFrame:
    """E-16: (l_id, r_id, step, degrees): furniture looks at the nearest point of a major road (20), else of any way (10)."""
    from .spatial import match_cascade, nearest_within

    look = lambda m: m.withColumn("degrees", F.degrees(F.pmod(F.atan2(F.col("rx") - F.col("lx"), F.col("ry") - F.col("ly")), F.lit(2 * math.pi))))
    got = match_cascade(nodes, [lambda t: nearest_within(t, major, 20.0), lambda t: nearest_within(t, others, 10.0)])
    return look(got).select("l_id", "r_id", "step", "degrees")


def one_side(df: DataFrame, azimuth: str = "azimuth") -> DataFrame:
    """E-38: of two-sided streets the piece that bears 90 to 270 degrees."""
    return df.where((F.col(azimuth) >= 90) & (F.col(azimuth) < 270))


def hatch(polygons: DataFrame, degrees: float, spacing: float) -> DataFrame:
    """E-06: (poly_id, k, x1, y1, x2, y2): parallel lines at an angle (clockwise from north), clipped to polygons (poly_id, rings).

    In a frame turned by the angle the lines are upright; each edge gives the heights at which lines cross it, and
    the heights of a line, in order, bound its parts inside (even-odd, so holes stay free).
    """
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    e = polygons.select("poly_id", F.explode("rings").alias("ring")).select("poly_id", F.explode(G.segments(F.col("ring"))).alias("e"))
    u = lambda p: F.col(f"e.{p}.x") * c - F.col(f"e.{p}.y") * s
    v = lambda p: F.col(f"e.{p}.x") * s + F.col(f"e.{p}.y") * c
    e = e.select("poly_id", u("a").alias("u1"), v("a").alias("v1"), u("b").alias("u2"), v("b").alias("v2"))
    low, high = F.ceil(F.least("u1", "u2") / spacing), F.ceil(F.greatest("u1", "u2") / spacing) - 1
    at = e.withColumn("low", low).withColumn("high", high).where("high >= low").select("*", F.explode(F.sequence("low", "high")).alias("k"))
    height = F.col("v1") + (F.col("k") * F.lit(spacing) - F.col("u1")) * (F.col("v2") - F.col("v1")) / (F.col("u2") - F.col("u1"))
    lines = at.groupBy("poly_id", "k").agg(F.array_sort(F.collect_list(height)).alias("h"))  # bounded by a polygon's edges
    pairs = F.transform(F.sequence(F.lit(1), (F.size("h") / 2).cast("int")), lambda i: F.struct(F.element_at("h", 2 * i - 1).alias("a"), F.element_at("h", 2 * i).alias("b")))
    parts = lines.where(F.size("h") >= 2).select("poly_id", "k", F.explode(pairs).alias("p"), (F.col("k") * F.lit(spacing)).alias("u")).where("p.b > p.a")
    back = lambda h: (F.col("u") * c + F.col(h) * s, F.col(h) * c - F.col("u") * s)
    (x1, y1), (x2, y2) = back("p.a"), back("p.b")
    return parts.select("poly_id", "k", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
