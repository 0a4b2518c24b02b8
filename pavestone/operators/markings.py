"""Markings derived from lanes, stop lines and crossings (E-19 .. E-26, E-28, E-29, E-41, E-42).

Lines and bars are given by their segments and intervals along them; areas made here are quads, never unions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..storage import written
from . import linear as L
from .aggregates import circular_mean, similar_or_overlapping
from .arrangement import outlines
from .components import connected_components
from .generate import zebra_stripes
from .network import merge_undirected
from .overlay import line_in_polygon, touching_intervals
from .spatial import CELL, along_cells, home_cell, overlap_area
from .windows import anchored_chains, drop_prefix_before, ring_chains

# fixed values: stroke widths in metres
NARROW, WIDE = 0.12, 0.25


def lane_sides(lanes: DataFrame, *columns: str) -> DataFrame:
    """A row per side of a lane (lane_id, line, width, marking_left, marking_right, type, class, direction) with a marking: edge_id, side, marking, and how far its edge lies to the right."""
    one = lambda side, sign: F.struct(F.lit(side).alias("side"), F.col(f"marking_{side}").alias("marking"), (F.col("width") / 2 * sign).alias("shift"), *[F.col(f"{c}_{side}").alias(c) for c in columns])
    rows = lanes.where("width > 0").select("*", F.explode(F.array(one("left", -1), one("right", 1))).alias("s"))
    keep = [c for c in lanes.columns if not c.startswith(("marking_", *[f"{x}_" for x in columns]))]
    return rows.where(~F.col("s.marking").isin("no", "none")).select(*keep, "s.*").withColumn("edge_id", F.concat_ws("/", F.col("lane_id").cast("string"), "side"))


def lane_edges(lanes: DataFrame, service: DataFrame | None = None) -> DataFrame:
    """E-23: (edge_id, lane_id, side, stroke, stroke_width, line, from_m, to_m): an edge line for each marked side of a lane, less the gaps where service ways (cor_id, x1, y1, x2, y2, half) cross.

    Lines are wide beside bus and centre-running lanes, on the inner side of cycle lanes and around barred areas.
    """
    sides = lane_sides(lanes).where(F.col("marking").contains("line") | (F.col("marking") == "barred_area"))
    stroke = F.when(F.col("marking") == "barred_area", "solid").otherwise(F.regexp_replace("marking", "_line$", ""))
    inner = F.col("side") == F.when(F.col("direction") == "backward", "right").otherwise("left")
    wide = (F.col("marking") == "barred_area") | F.coalesce(F.col("class").isin("center_running", "crossing"), F.lit(False)) | (F.col("type") == "bus") | ((F.col("type") == "bicycle") & inner)
    told = sides.select("edge_id", "lane_id", "side", "direction", "line", "shift", stroke.alias("stroke"), F.when(wide, WIDE).otherwise(NARROW).alias("stroke_width"))
    moved = L.offset_lines(told.select(F.col("edge_id").alias("line_id"), "line", "shift"), F.col("shift")).select(F.col("line_id").alias("edge_id"), "line")
    edges = told.drop("line", "shift").join(moved.hint("merge"), "edge_id").withColumn("line", F.when(F.col("direction") == "backward", F.reverse("line")).otherwise(F.col("line"))).drop("direction")
    whole = edges.select(F.col("edge_id").alias("line_id"), F.lit(0.0).alias("from_m"), G.length(F.col("line")).alias("to_m"))
    if service is not None:
        gaps = L.corridor_intervals(L.line_segments(edges.select(F.col("edge_id").alias("line_id"), "line")), service)
        whole = L.subtract_intervals(whole, gaps.select("line_id", "from_m", "to_m"))
    return edges.join(whole.withColumnRenamed("line_id", "edge_id").hint("merge"), "edge_id")


def _quads_beside(lines: DataFrame, key: str, left: Column, right: Column) -> DataFrame:
    """(key, k, ring): closed quads beside lines (key, line), one per segment."""
    quads = G.corridor_quads(F.col("line"), left, right)
    return lines.select(key, F.posexplode(F.transform(quads, lambda q: F.concat(q, F.slice(q, 1, 1)))).alias("k", "ring"))


def barred_areas(lanes: DataFrame, mapped: DataFrame) -> DataFrame:
    """E-24: (edge_id, k, ring): corridors of `buffer` beside lane sides marked as barred, unless a mapped area (r_id, rings) is alike or covers a quarter of one."""
    sides = lane_sides(lanes, "buffer").where("marking = 'barred_area' and buffer > 0")
    moved = L.offset_lines(sides.select(F.col("edge_id").alias("line_id"), "line", "shift"), F.col("shift")).select(F.col("line_id").alias("edge_id"), "line")
    edges = moved.join(sides.select("edge_id", "side", "buffer").hint("merge"), "edge_id")
    left = F.when(F.col("side") == "left", F.col("buffer")).otherwise(0.0)
    rings = _quads_beside(edges.withColumn("_l", left).withColumn("_r", F.col("buffer") - left), "edge_id", F.col("_l"), F.col("_r"))
    own = rings.groupBy("edge_id").agg(F.sum(G.area(F.col("ring"))).alias("area_a"), F.max(G.length(F.col("ring"))).alias("_p"))
    other = mapped.select("r_id", G.area(F.col("rings")[0]).alias("area_b"), G.length(F.col("rings")[0]).alias("_q"))
    # overlap by the pieces of an edge; the half outline stands for the diameter
    pieces = rings.withColumn("l_id", F.concat_ws("#", "edge_id", F.col("k").cast("string")))
    common = overlap_area(pieces.select("l_id", F.array(G.force_ccw(F.col("ring"))).alias("rings")), mapped.select("r_id", "rings")).where("area > 1e-9")
    common = common.groupBy(F.substring_index("l_id", "#", 1).alias("edge_id"), "r_id").agg(F.sum("area").alias("common"))
    pairs = common.join(own.hint("merge"), "edge_id").join(other.hint("merge"), "r_id").select("edge_id", "area_a", "area_b", (F.col("_p") / 2).alias("diameter_a"), (F.col("_q") / 2).alias("diameter_b"), "common")
    return rings.join(similar_or_overlapping(pairs).select("edge_id").distinct().hint("merge"), "edge_id", "left_anti")


def barred_outlines(rings: DataFrame) -> DataFrame:
    """E-24: (edge_id, ring, place, x1, y1, x2, y2): the corridors (edge_id, k, ring) of each edge as one area, without inner edges."""
    polygons = rings.select(F.col("edge_id").alias("grp"), F.col("k").cast("string").alias("poly_id"), F.array("ring").alias("rings"))
    return outlines(polygons).withColumnRenamed("grp", "edge_id")


def buffer_markings(places: DataFrame, mapped: DataFrame, back: float = 4.0, front: float = 2.0, depth: float = 1.5, parallel: float = 25.0, most: float = 4.0) -> DataFrame:
    """E-25: (place_id, ring): trapezoids at crossings' sides (place_id, x, y, facing, road: degrees; cycle_az, cycle_width: of a cycle lane beside it, or null).

    Beside a cycle lane that runs along the road the place moves past it; a trapezoid that shares more than `most` with a mapped area (r_id, rings) goes.
    """
    along = F.coalesce(G.angle_difference_undirected(F.col("cycle_az"), F.col("road")) <= parallel, F.lit(False))
    facing, road = F.radians("facing"), F.radians("road")
    ref = G.project(G.point(F.col("x"), F.col("y")), F.when(along, F.col("cycle_width")).otherwise(0.0), facing)
    rows = places.withColumn("_ref", ref).withColumn("_front", G.project(F.col("_ref"), F.lit(depth), facing))
    side = lambda p, half, turn: G.project(F.col(p), F.lit(half), road + turn)
    pi = 3.141592653589793
    corners = [side("_ref", back / 2, 0.0), side("_front", front / 2, 0.0), side("_front", front / 2, pi), side("_ref", back / 2, pi)]
    made = rows.select("place_id", G.force_ccw(F.array(*corners, corners[0])).alias("ring"))
    over = overlap_area(made.select(F.col("place_id").alias("l_id"), F.array("ring").alias("rings")), mapped).where(F.col("area") > most).select(F.col("l_id").alias("place_id")).distinct()
    return made.join(over.hint("merge"), "place_id", "left_anti")


def tunnel_symbols(parts: DataFrame) -> DataFrame:
    """E-26: (line_id, poly_id, at): the middle of a line's longest part (line_id, poly_id, from_m, to_m) in the area that it shares most with."""
    length = F.col("to_m") - F.col("from_m")
    totals = parts.groupBy("line_id", "poly_id").agg(F.sum(length).alias("total"), F.min(F.struct((-length).alias("l"), ((F.col("from_m") + F.col("to_m")) / 2).alias("at"))).alias("m"))
    return totals.groupBy("line_id").agg(F.min(F.struct((-F.col("total")).alias("t"), "poly_id", F.col("m.at").alias("at"))).alias("m")).select("line_id", "m.poly_id", "m.at")


def space_directions(spaces: DataFrame, parallel: float = 25.0) -> DataFrame:
    """E-28: adds `direction` to spaces (long_az: of the long edge, road_az, to_road, lane_az; degrees or null).

    Without a road it is that of the long edge; across a road, the end that looks to it; along it, the end against the lane's course.
    """
    opposite = F.pmod(F.col("long_az") + 180, F.lit(360.0))
    toward = lambda az: F.when(G.angle_difference(F.col("long_az"), az) <= G.angle_difference(opposite, az), F.col("long_az")).otherwise(opposite)
    beside = G.angle_difference_undirected(F.col("long_az"), F.col("road_az")) <= parallel
    along = F.pmod(F.when(F.col("lane_az").isNull(), F.col("long_az")).otherwise(toward(F.col("lane_az"))) + 180, F.lit(360.0))
    return spaces.withColumn("direction", F.when(F.col("road_az").isNull(), F.col("long_az")).when(~beside, toward(F.col("to_road"))).otherwise(along))


def surface_colours(lanes: DataFrame, areas: DataFrame, inset: float = 0.125) -> DataFrame:
    """E-29: (source, id, colour, ring): corridors of coloured lanes (lane_id, line, width, colour), `inset` narrower on each side, and mapped coloured areas (area_id, colour, ring)."""
    named = lambda df: df.where(~F.col("colour").isin("no", "none"))
    wide = named(lanes).where(F.col("width") > 2 * inset)
    half = F.col("width") / 2 - inset
    quads = G.corridor_quads(F.col("line"), half, half)
    of_lanes = wide.select(F.lit("lane_colour").alias("source"), F.col("lane_id").alias("id"), "colour", F.explode(F.transform(quads, lambda q: F.concat(q, F.slice(q, 1, 1)))).alias("ring"))
    of_areas = named(areas).select(F.lit("area_colour").alias("source"), F.col("area_id").alias("id"), "colour", "ring").where(G.area(F.col("ring")) > 0.01)
    return of_lanes.unionByName(of_areas)


def limit_to_lanes(stops: DataFrame, lanes: DataFrame, cell: float = 64.0, more: float = NARROW) -> DataFrame:
    """E-19: (stop_id, from_m, to_m): stop lines (stop_id, direction, x1, y1, x2, y2) limited to the lanes that approach them.

    `lanes` has segments (lane_id, type, direction, width, buffer_left, buffer_right, x1, y1, x2, y2).  A lane takes the stretch of the
    stop line around the place where it crosses; of a lane for both ways, where it is the only one, only the half on the approaching side.
    """
    s = along_cells(stops.select("stop_id", "direction", *[F.col(c).alias(f"s{c}") for c in ("x1", "y1", "x2", "y2")]), "sx1", "sy1", "sx2", "sy2", cell)
    l = lanes.where("type is null or type <> 'parking'").select("lane_id", F.col("direction").alias("lane_direction"), "width", "buffer_left", "buffer_right", "x1", "y1", "x2", "y2")
    l = along_cells(l, "x1", "y1", "x2", "y2", cell)
    sx, sy = F.col("sx2") - F.col("sx1"), F.col("sy2") - F.col("sy1")
    lx, ly = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cross = F.nullif(sx * ly - sy * lx, F.lit(0.0))
    t = ((F.col("x1") - F.col("sx1")) * ly - (F.col("y1") - F.col("sy1")) * lx) / cross
    u = ((F.col("x1") - F.col("sx1")) * sy - (F.col("y1") - F.col("sy1")) * sx) / cross
    length = F.sqrt(sx * sx + sy * sy)
    # whether the lane's left lies to the high end of the stop line
    left_high = (sx * ly - sy * lx) < 0
    met = s.join(l.hint("merge"), CELL).withColumn("t", t).withColumn("u", u).where("t between 0 and 1 and u between 0 and 1")
    home = home_cell(F.least(F.greatest(F.col("sx1") + F.col("t") * sx, F.least("sx1", "sx2")), F.greatest("sx1", "sx2")), F.least(F.greatest(F.col("sy1") + F.col("t") * sy, F.least("sy1", "sy2")), F.greatest("sy1", "sy2")), cell)
    met = met.where(home).select("stop_id", "direction", "lane_id", "lane_direction", (F.col("t") * length).alias("at"), length.alias("total"), left_high.alias("left_high"), (F.col("width") / 2 + F.col("buffer_left") + more).alias("left"), (F.col("width") / 2 + F.col("buffer_right") + more).alias("right"))
    both = met.groupBy("stop_id").agg(F.countDistinct(F.when(F.col("lane_direction") == "both_ways", F.col("lane_id"))).alias("n_both"))
    ok = met.join(both.hint("merge"), "stop_id").where("lane_direction = direction or (lane_direction = 'both_ways' and n_both = 1)")
    # a lane for both ways: traffic keeps right, so forward takes its right half
    shared = F.col("lane_direction") == "both_ways"
    left = F.when(shared & (F.col("direction") == "forward"), 0.0).otherwise(F.col("left"))
    right = F.when(shared & (F.col("direction") == "backward"), 0.0).otherwise(F.col("right"))
    low, high = F.when(F.col("left_high"), right).otherwise(left), F.when(F.col("left_high"), left).otherwise(right)
    return ok.groupBy("stop_id").agg(F.greatest(F.min(F.col("at") - low), F.lit(0.0)).alias("from_m"), F.least(F.max(F.col("at") + high), F.max("total")).alias("to_m"))


def outline_groups(edges: DataFrame, anchors: DataFrame, reach: float = 25.0) -> DataFrame:
    """E-20: (stop_id, area_id, idx, position: from 1 along the run): the run of outline segments around a stop's own one that look the same way.

    `edges` has (area_id, idx: from 1 along the outline, n, az: degrees), `anchors` (stop_id, area_id, idx).  Segments within `reach` of the
    anchor's azimuth form chains around the ring; the anchor's chain counts, and it goes if its mean is farther off than `reach`.
    """
    ref = anchors.join(edges.select("area_id", "idx", F.col("az").alias("own_az")).hint("merge"), ["area_id", "idx"]).select("stop_id", "area_id", F.col("idx").alias("anchor"), "own_az")
    near = edges.join(ref.hint("merge"), "area_id").where(G.angle_difference(F.col("az"), F.col("own_az")) <= reach)
    chains = ring_chains(near.select("stop_id", "idx", "n"), "stop_id", "idx", "n")
    kept = anchored_chains(chains, ref.select("stop_id", F.col("anchor").alias("idx")), "stop_id", "idx").select("stop_id", "idx", "position")
    own = kept.join(near.select("stop_id", "area_id", "idx", "az", "own_az").hint("merge"), ["stop_id", "idx"])
    mean = circular_mean(own, "stop_id", "az", "idx")
    return own.join(mean.hint("merge"), "stop_id").where(G.angle_difference(F.col("angle"), F.col("own_az")) <= reach).select("stop_id", "area_id", "idx", "position")


def stop_anchors(stops: DataFrame, edges: DataFrame) -> DataFrame:
    """E-20: (stop_id, area_id, idx): of the outline segments (area_id, idx, az, x1, y1, x2, y2) that begin or end at a stop (stop_id, area_id, x, y, road_az), the one closest to straight across its road, then the smaller idx."""
    ends = edges.select("area_id", "idx", "az", F.explode(F.array(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2")))).alias("p"))
    met = stops.withColumn("p", G.point(F.col("x"), F.col("y"))).join(ends.hint("merge"), ["area_id", "p"])
    off = G.angle_difference_undirected(F.col("az"), F.col("road_az") + 90)
    return met.groupBy("stop_id", "area_id").agg(F.min(F.struct(off.alias("off"), "idx")).alias("m")).select("stop_id", "area_id", "m.idx")


def lane_touches(edges: DataFrame, lanes: DataFrame, cell: float = 64.0) -> DataFrame:
    """E-20: (area_id, idx, lanes_touch, lanes_az) of outline segments (area_id, idx, x1, y1, x2, y2) that lanes, as segments (lane_id, direction, x1, y1, x2, y2), cross or touch.

    `lanes_touch` is forward, backward or, with lanes of both kinds, mixed; `lanes_az` is the circular mean over the lanes of each one's mean where it meets the segment.
    Segments without a row are untouched.
    """
    from .areas import crossing_segments

    az = F.atan2(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    l = lanes.where(F.col("direction").isin("forward", "backward")).select(F.struct("lane_id", "direction", az.alias("az")).alias("b_id"), "x1", "y1", "x2", "y2")
    met = crossing_segments(edges.select(F.struct("area_id", "idx").alias("a_id"), "x1", "y1", "x2", "y2"), l, cell)
    mean = lambda c: F.atan2(F.avg(F.sin(c)), F.avg(F.cos(c)))
    each = met.select("a_id.area_id", "a_id.idx", "b_id.lane_id", "b_id.direction", F.col("b_id.az").alias("az")).groupBy("area_id", "idx", "lane_id", "direction").agg(mean(F.col("az")).alias("az"))
    both = F.min("direction") != F.max("direction")
    return each.groupBy("area_id", "idx").agg(F.when(both, "mixed").otherwise(F.min("direction")).alias("lanes_touch"), F.pmod(F.degrees(mean(F.col("az"))), F.lit(360.0)).alias("lanes_az"))


def approach_outline(groups: DataFrame, touches: DataFrame, key: str = "stop_id") -> DataFrame:
    """E-20: what is left of a stop's outline (key, area_id, idx, position, az, stop_direction) by the lanes that touch it (rows of `lane_touches`), with `lanes_touch`.

    Untouched segments go if a later one of their group is touched by lanes of the other direction alone, and those go too.  A segment whose lanes
    don't run into the area (forward) or out of it (backward) is not valid: it goes with the untouched ones right before it.
    """
    rows = groups.join(touches.hint("merge"), ["area_id", "idx"], "left").withColumn("lanes_touch", F.coalesce("lanes_touch", F.lit("untouched")))
    one_way = F.col("lanes_touch").isin("forward", "backward")
    rows = rows.withColumn("_against", one_way & (F.col("lanes_touch") != F.col("stop_direction")))
    later = Window.partitionBy(key).orderBy("position").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("_later", F.coalesce(F.max("_against").over(later), F.lit(False)))
    rows = rows.where(~F.col("_against") & ~((F.col("lanes_touch") == "untouched") & F.col("_later")))
    # areas lie left of their outline, so a lane that enters runs along azimuth - 90
    course = F.when(F.col("lanes_touch") == "backward", F.col("lanes_az") + 180).otherwise(F.col("lanes_az"))
    invalid = F.coalesce(one_way & (G.angle_difference(course, F.col("az") - 90) > 90), F.lit(False))
    return drop_prefix_before(rows, key, "position", F.col("lanes_touch") == "untouched", invalid).drop("_against", "_later", "lanes_az")


def crossing_lines(nodes: DataFrame, paths: DataFrame, reach: float = 45.0, extension: float = 5.0, generic: float = 3.0) -> DataFrame:
    """E-21: (node_id, kind, x1, y1, x2, y2): the centreline of a crossing (node_id, x, y, road_az: degrees) from the paths that meet it (path_id, node_id, x, y: the far end, kerb_bounded).

    On each side of the road the path closest to the crossing's axis counts (within `reach`); both give a two-sided line, one is mirrored, none leaves a
    straight line across the road.  Ends that no kerb bounds are made longer by `extension`.
    """
    p = paths.select("path_id", "node_id", F.col("x").alias("px"), F.col("y").alias("py"), "kerb_bounded").join(nodes.hint("merge"), "node_id")
    az = F.degrees(G.azimuth(G.point(F.col("x"), F.col("y")), G.point(F.col("px"), F.col("py"))))
    # side 1 lies at the road's right
    side = lambda s: F.pmod(F.col("road_az") + 90.0 * s, F.lit(360.0))
    told = p.where("px <> x or py <> y").withColumn("az", az).withColumn("side", F.when(G.angle_difference(F.col("az"), side(1)) <= 90, 1).otherwise(-1))
    told = told.withColumn("off", G.angle_difference(F.col("az"), F.when(F.col("side") == 1, side(1)).otherwise(side(-1)))).where(F.col("off") <= reach)
    best = told.groupBy("node_id", "side").agg(F.min(F.struct("off", "path_id", "px", "py", "kerb_bounded")).alias("m"))
    by_side = best.groupBy("node_id").agg(*[F.max(F.when(F.col("side") == s, F.col("m"))).alias(n) for s, n in ((1, "right"), (-1, "left"))])
    rows = nodes.join(by_side.hint("merge"), "node_id", "left")
    here = G.point(F.col("x"), F.col("y"))
    mirrored = lambda m: G.point(2 * F.col("x") - F.col(f"{m}.px"), 2 * F.col("y") - F.col(f"{m}.py"))
    across = lambda s: G.project(here, F.lit(generic), F.radians(side(s)))
    end = lambda m, other, s: F.when(F.col(m).isNotNull(), G.point(F.col(f"{m}.px"), F.col(f"{m}.py"))).when(F.col(other).isNotNull(), mirrored(other)).otherwise(across(s))
    kind = F.when(F.col("left").isNotNull() & F.col("right").isNotNull(), "two_sided").when(F.col("left").isNotNull() | F.col("right").isNotNull(), "one_sided").otherwise("generic")
    ends = rows.select("node_id", kind.alias("kind"), here.alias("here"), end("left", "right", -1).alias("a"), end("right", "left", 1).alias("b"), F.coalesce("left.kerb_bounded", F.lit(False)).alias("ka"), F.coalesce("right.kerb_bounded", F.lit(False)).alias("kb"))
    longer = lambda p, bounded: F.when(F.col(bounded) | (F.col("kind") == "generic"), F.col(p)).otherwise(G.project(F.col(p), F.lit(extension), G.azimuth(F.col("here"), F.col(p))))
    out = ends.select("node_id", "kind", longer("a", "ka").alias("a"), longer("b", "kb").alias("b"))
    return out.select("node_id", "kind", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"))


def crossing_clusters(pieces: DataFrame, style: list[str], tolerance: float = 45.0) -> DataFrame:
    """E-21: (seg_id, cluster): pieces (seg_id, ax, ay, bx, by, *style) that meet end to end, look alike and turn by `tolerance` degrees at most, to any depth.

    At a node the axes lie on a circle of 180 degrees, and those next to each other are linked: that joins the same pieces as all pairs would.
    """
    axis = F.pmod(F.degrees(F.atan2(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))), F.lit(180.0))
    end = F.explode(F.array(G.point(F.col("ax"), F.col("ay")), G.point(F.col("bx"), F.col("by"))))
    at = pieces.select("seg_id", F.to_json(F.struct(*style)).alias("style"), axis.alias("d"), end.alias("p"))
    w = Window.partitionBy("style", "p").orderBy("d", "seg_id")
    whole = Window.partitionBy("style", "p")
    first = F.min(F.struct("d", "seg_id")).over(whole)
    nxt = F.coalesce(F.lead(F.struct("d", "seg_id")).over(w), F.struct((first["d"] + 180.0).alias("d"), first["seg_id"].alias("seg_id")))
    pairs = at.select(F.col("seg_id").alias("a"), nxt["seg_id"].alias("b"), (nxt["d"] - F.col("d")).alias("off")).where((F.col("off") <= tolerance) & (F.col("a") != F.col("b")))
    found = connected_components(pairs).withColumnRenamed("node", "seg_id")
    return pieces.select("seg_id").join(found.hint("merge"), "seg_id", "left").select("seg_id", F.coalesce("component", "seg_id").alias("cluster"))


def merge_crossings(pieces: DataFrame, style: list[str], columns: list[str], tolerance: float = 45.0) -> tuple[DataFrame, DataFrame]:
    """E-21: connected crossing pieces (seg_id, crossing_id, ax, ay, bx, by, touches, temporary, *style, *columns) as lines.

    Returns (seg_id, cluster, line, place, reversed), the pieces in order along their line, and (cluster, crossing_id, *style, *columns, temporary): attributes of the
    piece that touches a crossing node, then the longest, then the smallest crossing and piece; temporary if any piece is.
    """
    known = written(crossing_clusters(pieces, style, tolerance).join(pieces.hint("merge"), "seg_id"), "clusters")
    length = F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2))
    own = [*style, *columns]
    won = known.groupBy("cluster").agg(F.min(F.struct((~F.col("touches")).alias("t"), (-length).alias("l"), "crossing_id", "seg_id", *own)).alias("m"), F.bool_or("temporary").alias("temporary"))
    lines = merge_undirected(known.select(F.col("seg_id").alias("edge_id"), "cluster", G.point(F.col("ax"), F.col("ay")).alias("a"), G.point(F.col("bx"), F.col("by")).alias("b")), "cluster")
    placed = known.select("seg_id", "cluster").join(lines.withColumnRenamed("edge_id", "seg_id").hint("merge"), "seg_id")
    return placed, won.select("cluster", "m.crossing_id", *[F.col(f"m.{c}").alias(c) for c in own], "temporary")


def clip_by_zones(rows: DataFrame, inside: DataFrame) -> DataFrame:
    """E-22: what is left of markings (line_id, crossing_id, is_bicycle, total) outside the clip zones of other crossings.

    `inside` has (line_id, zone_crossing, zone_is_bicycle, from_m, to_m).  A marking's own zone never cuts it; bicycle edges are cut
    by every other zone, those for walkers only by zones that are not for bicycles.
    """
    cuts = inside.join(rows.select("line_id", "crossing_id", "is_bicycle").hint("merge"), "line_id").where((~F.col("zone_crossing").eqNullSafe(F.col("crossing_id"))) & (F.col("is_bicycle") | ~F.col("zone_is_bicycle")))
    return L.subtract_intervals(rows.select("line_id", F.lit(0.0).alias("from_m"), F.col("total").alias("to_m")), cuts.select("line_id", "from_m", "to_m"))


def junction_zones(junctions: DataFrame, stops: DataFrame, areas: DataFrame, reach: float = 18.0, marked: bool = False) -> DataFrame:
    """E-41: (zone, source, layer, ring): junction footprints (junction_id, layer, x, y, ring), hulls of each stop line (stop_id, x1, y1, x2, y2) with its nearest junction, and areas (area_id, layer, markings, ring) whose markings don't go through.

    Zones stay separate convex parts, so that lanes can be cut by each of them; `zone_outlines` joins them.  `marked`: the
    second pass for arrows, which is cut by the areas alone whose markings do go through.
    """
    from .spatial import nearest_within

    through = F.coalesce(F.col("markings") == "yes", F.lit(False))
    more = areas.where(through if marked else ~through).select(F.concat_ws("/", F.lit("area"), F.col("area_id").cast("string")).alias("zone"), F.lit("area").alias("source"), "layer", "ring")
    if marked:
        return more
    mid = stops.select(F.col("stop_id").alias("l_id"), ((F.col("x1") + F.col("x2")) / 2).alias("lx"), ((F.col("y1") + F.col("y2")) / 2).alias("ly"))
    near = nearest_within(mid, junctions.select(F.col("junction_id").alias("r_id"), F.col("x").alias("rx"), F.col("y").alias("ry")), reach).select(F.col("l_id").alias("stop_id"), F.col("r_id").alias("junction_id"))
    both = near.join(stops.hint("merge"), "stop_id").join(junctions.select("junction_id", "layer", "ring").hint("merge"), "junction_id")
    hull = G.convex_hull(F.concat("ring", F.array(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2")))))
    hulls = both.select(F.concat_ws("/", F.lit("stop"), F.col("stop_id").cast("string")).alias("zone"), F.lit("hull").alias("source"), "layer", hull.alias("h")).select("zone", "source", "layer", F.concat("h", F.slice("h", 1, 1)).alias("ring"))
    own = junctions.select(F.concat_ws("/", F.lit("junction"), F.col("junction_id").cast("string")).alias("zone"), F.lit("junction").alias("source"), "layer", "ring")
    return own.unionByName(hulls).unionByName(more)


def zone_outlines(zones: DataFrame) -> DataFrame:
    """E-41: (layer, ring, place, x1, y1, x2, y2): zones (zone, layer, ring) of a layer as one area each, without inner edges."""
    grp = F.to_json(F.struct("layer"))
    rows = outlines(zones.select(grp.alias("grp"), F.col("zone").alias("poly_id"), F.array("ring").alias("rings")))
    return rows.withColumn("layer", F.from_json("grp", f"layer {dict(zones.dtypes)['layer']}")["layer"]).drop("grp")


def regenerate_stripes(lines: DataFrame, zones: DataFrame, cell: float = 64.0) -> DataFrame:
    """E-42: (line_id, piece, k, at): stripes on the pieces of centrelines (line_id, line) that lie outside restriction areas (poly_id, rings)."""
    inside = touching_intervals(line_in_polygon(L.line_segments(lines), zones, cell))
    left = L.subtract_intervals(lines.select("line_id", F.lit(0.0).alias("from_m"), G.length(F.col("line")).alias("to_m")), inside.select("line_id", "from_m", "to_m"))
    pieces = left.withColumn("piece", F.row_number().over(Window.partitionBy("line_id").orderBy("from_m")))
    key = F.concat_ws("#", F.col("line_id").cast("string"), F.col("piece").cast("string")).alias("line_id")
    made = zebra_stripes(pieces.select(key, (F.col("to_m") - F.col("from_m")).alias("total")))
    named = pieces.select(key.alias("_key"), "line_id", "piece", "from_m")
    return made.withColumnRenamed("line_id", "_key").join(named.hint("merge"), "_key").select("line_id", "piece", "k", (F.col("at") + F.col("from_m")).alias("at"))
