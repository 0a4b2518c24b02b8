"""Derivations over lines, lanes and buildings (J-07, J-08, J-21, F-05, F-06, F-09 .. F-21, R-08, E-03, E-13, E-39)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..storage import written
from .linear import overlaps, subtract_intervals
from .spatial import in_blocks, match_cascade, nearest_within, out_of_blocks

# fixed values: turns that a lane can only go on with
CLOSED_TURNS = ["left", "sharp_left", "merge_to_left", "right", "sharp_right", "merge_to_right", "left;right", "reverse"]


def connect_snapped(ends: DataFrame, size: float) -> DataFrame:
    """J-07: (a, b), a <> b: ends (seg, x, y) that fall on the same grid point."""
    at = ends.select("seg", F.round(F.col("x") / size).alias("gx"), F.round(F.col("y") / size).alias("gy")).distinct()
    at = at.withColumn("more", F.count(F.lit(1)).over(Window.partitionBy("seg")) > 1)

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        """Copies of a place meet in blocks; the rows are made after the join."""
        name = lambda df, p: in_blocks(df.select(F.col("seg").alias(f"{p}_id"), "gx", "gy"), p, ["gx", "gy"])
        met = name(left, "l").join(name(right, "r").hint("merge"), ["gx", "gy"])
        return out_of_blocks(met, ["l_id"], ["r_id"]).select(F.col("l_id").alias("a"), F.col("r_id").alias("b")).where("a <> b")

    # a pair can only meet twice if both have several places: no other pair is dealt out again
    one, more = at.where("not more"), at.where("more")
    return pairs(one, at).unionByName(pairs(more, one)).unionByName(pairs(more, more).distinct())


def best_by_angle(left: DataFrame, right: DataFrame) -> DataFrame:
    """J-08: for each left (l_id, name, class, la) the right (r_id, name, class, ra) of the smallest angle between axes, then the smaller id; ids are unique, angles not null.

    Pairs are not made: right axes of a name and class stand in a circle, each with its two smallest ids (one may be the asking row's own), and a left axis
    asks the two on either side of it.
    """
    kind = ["name", "class"]
    axis = lambda c: F.pmod(F.col(c), F.lit(180.0)).alias("axis")
    firsts = right.select(*kind, axis("ra"), "r_id").withColumn("_n", F.row_number().over(Window.partitionBy(*kind, "axis").orderBy("r_id"))).where("_n <= 2")
    spots = firsts.groupBy(*kind, "axis").agg(F.min("r_id").alias("a"), F.max(F.when(F.col("_n") == 2, F.col("r_id"))).alias("b"))
    circle = Window.partitionBy(*kind).orderBy("axis")
    whole = circle.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spots = spots.select(*kind, "axis", F.struct("axis", "a", "b").alias("s"))
    spots = spots.withColumn("p", F.coalesce(F.lag("s").over(circle), F.last("s").over(whole))).withColumn("n", F.coalesce(F.lead("s").over(circle), F.first("s").over(whole)))
    spots = spots.withColumn("m", F.coalesce(F.lead("n").over(circle), F.first("n").over(whole))).select(*kind, "axis", F.struct("p", "s", "n", "m").alias("near"))
    asks = left.select(*kind, axis("la")).distinct().select("*", F.lit(None).cast(spots.schema["near"].dataType).alias("near"), F.lit(True).alias("asks"))
    # the last axis up to the asked one, or round the circle the last of all
    told = spots.withColumn("asks", F.lit(False)).unionByName(asks)
    told = told.withColumn("near", F.coalesce(F.last("near", True).over(circle.rangeBetween(Window.unboundedPreceding, Window.currentRow)), F.last("near", True).over(whole))).where("asks and near is not null").drop("asks")
    met = left.select("*", axis("la")).join(told.hint("merge"), [*kind, "axis"])
    off = lambda c: G.angle_difference_undirected(F.col("la"), F.col(f"near.{c}.axis"))
    found = [F.when(F.col(f"near.{c}.{i}") != F.col("l_id"), F.struct(off(c).alias("off"), F.col(f"near.{c}.{i}").alias("r_id"))) for c in "psnm" for i in "ab"]
    return met.select("l_id", F.least(*found).alias("m")).where("m is not null").select("l_id", "m.r_id", "m.off")


def lane_candidates(junctions: DataFrame, lanes: DataFrame, most: float = 5.0, close: float = 1.5, width: float = 0.5) -> DataFrame:
    """J-21: lane pairs across junctions (segment_a, a_end, segment_b, b_end).

    `lanes` has segment, lane_index, type, direction, width, turn, sx, sy, ex, ey.
    Same type group (vehicle and bus are one), directions that lead on, a turn
    that only goes on with itself, close enough; farther than `close` only with equal lane counts.
    """
    group = F.when(F.col("type").isin("vehicle", "bus"), "motor").otherwise(F.col("type"))
    l = lanes.withColumn("group", group)
    n = l.groupBy("segment", "group", "direction").agg(F.count(F.lit(1)).alias("lanes"))
    l = l.join(n.hint("merge"), ["segment", "group", "direction"])
    pick = lambda p: l.select(*[F.col(c).alias(f"{p}_{c}") for c in ("segment", "lane_index", "group", "direction", "width", "turn", "sx", "sy", "ex", "ey", "lanes")])
    j = junctions.select(F.col("segment_a").alias("a_segment"), "a_end", F.col("segment_b").alias("b_segment"), "b_end")
    both = j.join(pick("a").hint("merge"), "a_segment").join(pick("b").hint("merge"), "b_segment").where("a_group = b_group").where(F.abs(F.col("a_width") - F.col("b_width")) <= width)
    ad, bd, ae, be = F.col("a_direction"), F.col("b_direction"), F.col("a_end"), F.col("b_end")
    on = (
        ((ae == "end") & (be == "start") & (ad == bd) & (ad != "backward"))
        | ((ae == "end") & (be == "end") & (ad == "forward") & (bd == "backward"))
        | ((ae == "start") & (be == "start") & (ad == "backward") & (bd == "forward"))
        | ((ae == "start") & (be == "end") & (ad == "backward") & (bd == "backward"))
    )
    closed = F.coalesce(F.col("a_turn").isin(CLOSED_TURNS), F.lit(False))
    both = both.where(on & (~closed | (F.col("a_turn") == F.col("b_turn"))))
    at = lambda p, end, when: F.when(end == when, F.struct(F.col(f"{p}_ex").alias("x"), F.col(f"{p}_ey").alias("y"))).otherwise(F.struct(F.col(f"{p}_sx").alias("x"), F.col(f"{p}_sy").alias("y")))
    both = both.withColumn("d", G.distance(at("a", ae, "end"), at("b", be, "end"))).where(F.col("d") <= most)
    both = both.where((F.col("d") <= close) | (F.col("a_lanes") == F.col("b_lanes")))
    return both.select("a_segment", "a_lane_index", "b_segment", "b_lane_index", "d", F.when(closed, 0).otherwise(1).alias("turn_priority"))


def clip_to_segment(lanes: DataFrame, segments: DataFrame) -> DataFrame:
    """F-06: lanes (lane_id, segment, line) cut to between the places nearest to their segment's ends (segment, sx, sy, ex, ey): (lane_id, from_m, to_m)."""
    both = lanes.join(segments.hint("merge"), "segment")
    a = G.locate(F.col("line"), G.point(F.col("sx"), F.col("sy")))["at"]
    b = G.locate(F.col("line"), G.point(F.col("ex"), F.col("ey")))["at"]
    return both.select("lane_id", a.alias("a"), b.alias("b")).select("lane_id", F.least("a", "b").alias("from_m"), F.greatest("a", "b").alias("to_m")).where("to_m > from_m")


def best_overlap_piece(windows: DataFrame, pieces: DataFrame, key: str = "line_id") -> DataFrame:
    """F-09: for each window (a_id) of a line the piece (b_id) that it shares most with, then the smaller id."""
    o = overlaps(windows, pieces, key)
    return o.groupBy(key, "a_id").agg(F.min(F.struct((-F.col("common")).alias("c"), "b_id")).alias("m")).select(key, "a_id", "m.b_id", (-F.col("m.c")).alias("common"))


def keep_anchored(parts: DataFrame, anchors: DataFrame, reach: float, key: str = "line_id") -> DataFrame:
    """F-10: parts (key, from_m, to_m) that come within `reach` of an anchor (key, at)."""
    near = parts.join(anchors.select(key, F.col("at").alias("anchor")).hint("merge"), key).where((F.col("from_m") <= F.col("anchor") + reach) & (F.col("to_m") >= F.col("anchor") - reach))
    return near.select(*parts.columns).distinct()


def trim_tail(lines: DataFrame, cuts: DataFrame, reach: float = 3.0, tail: float = 2.0, key: str = "line_id") -> DataFrame:
    """F-11: (key, to_m) of lines (key, total): cut at the nearest stop (key, at, distance: of the end) if what lies behind is short."""
    ok = lines.join(cuts.hint("merge"), key).where((F.col("distance") <= reach) & (F.col("at") / F.col("total") > 0.01) & (F.col("at") / F.col("total") < 0.999) & (F.col("total") - F.col("at") < tail))
    best = ok.groupBy(key).agg(F.min(F.struct("distance", "at")).alias("m")).select(key, F.col("m.at").alias("cut"))
    return lines.join(best.hint("merge"), key, "left").select(key, F.coalesce("cut", "total").alias("to_m"))


def style_inside(lines: DataFrame, zones: DataFrame, whole: float = 0.67, least: float = 0.3, key: str = "line_id") -> DataFrame:
    """F-05: (key, from_m, to_m, inside) of lines (key, total); a line mostly inside is inside as a whole; short pieces go.

    `zones` has merged intervals (key, from_m, to_m) inside the zones.
    """
    share = zones.groupBy(key).agg(F.sum(F.col("to_m") - F.col("from_m")).alias("in_m"))
    mostly = lines.join(share.hint("merge"), key).where(F.col("in_m") >= F.col("total") * whole).select(key, F.lit(0.0).alias("from_m"), F.col("total").alias("to_m"), F.lit(True).alias("inside"))
    rest = lines.join(mostly.select(key).hint("merge"), key, "left_anti")
    inside = zones.join(rest.select(key).hint("merge"), key, "left_semi").select(key, "from_m", "to_m").withColumn("inside", F.lit(True))
    outside = subtract_intervals(rest.select(key, F.lit(0.0).alias("from_m"), F.col("total").alias("to_m")), zones.select(key, "from_m", "to_m"), 0.0, key).withColumn("inside", F.lit(False))
    return mostly.unionByName(inside).unionByName(outside).where(F.col("to_m") - F.col("from_m") >= least)


def drop_connectors(segments: DataFrame, longest: float = 25.0, snap: float = 0.5, tolerance: float = 25.0) -> DataFrame:
    """F-16: segments (id, name, highway, class, len, az, ax, ay, bx, by) without short links and short connectors.

    A connector joins more than one other street at both ends and has no
    collinear same-name continuation at either.
    """
    ends = segments.select("id", "name", "class", "az", F.explode(F.array(F.struct(F.lit("a").alias("which"), F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.lit("b").alias("which"), F.col("bx").alias("x"), F.col("by").alias("y")))).alias("e"))
    ends = ends.select("id", "name", "class", "az", "e.which", F.round(F.col("e.x") / snap).alias("gx"), F.round(F.col("e.y") / snap).alias("gy"))
    short = segments.where(F.col("len") <= longest)
    stats = at_nodes(ends, ["name", "class"], tolerance).join(short.select("id").hint("merge"), "id", "left_semi").withColumnRenamed("others", "n")
    bad = stats.where("n > 1 and not goes_on").groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k = 2").select("id")
    links = short.where(F.col("highway").endswith("_link")).select("id")
    return segments.join(bad.unionByName(links).distinct().hint("merge"), "id", "left_anti")


def outline_edges(edges: DataFrame, covered: DataFrame) -> DataFrame:
    """F-19: edges (key_x1, key_y1, key_x2, key_y2, id) of areas that no cover has, each shared one once (the smaller id)."""
    keys = ["key_x1", "key_y1", "key_x2", "key_y2"]
    return edges.join(covered.select(*keys).distinct().hint("merge"), keys, "left_anti").groupBy(*keys).agg(F.min("id").alias("id"))


def height_steps(pieces: DataFrame, bearing: float = 40.0) -> DataFrame:
    """F-21: stretches where parts of different height touch, the lower part on the left: (lower, upper, x1, y1, x2, y2, facing).

    `pieces` are those of `areas.wall_pieces`, so walls need to coincide in a stretch only.
    """
    both = pieces.where("left.height <> right.height")
    turned = F.col("left.height") > F.col("right.height")
    pick = lambda a, b: F.when(turned, F.col(a)).otherwise(F.col(b))
    rows = both.select(pick("right.part", "left.part").alias("lower"), pick("left.part", "right.part").alias("upper"), pick("x2", "x1").alias("x1"), pick("y2", "y1").alias("y1"), pick("x1", "x2").alias("x2"), pick("y1", "y2").alias("y2"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    n = F.sqrt(dx * dx + dy * dy)
    facing = (-dy / n) * F.sin(F.radians(F.lit(bearing))) + (dx / n) * F.cos(F.radians(F.lit(bearing)))
    return rows.select("lower", "upper", "x1", "y1", "x2", "y2", F.round(facing, 2).alias("facing"))


def node_azimuth(approaches: DataFrame) -> DataFrame:
    """R-08: (node, azimuth) from approach parts (node, road, degrees, service); service roads only where there are no others."""
    from .aggregates import circular_mean

    main = approaches.where("not service")
    rest = approaches.where("service").join(main.select("node").distinct().hint("merge"), "node", "left_anti")
    return circular_mean(main.unionByName(rest), "node", "degrees", "road").withColumnRenamed("angle", "azimuth")


def snap_to_lane(nodes: DataFrame, own: DataFrame, both_ways: DataFrame, reach: float = 10.0) -> DataFrame:
    """E-39: markings moved to the nearest lane of their direction, else to a lane for both ways: (l_id, r_id, step)."""
    return match_cascade(nodes, [lambda t: nearest_within(t, own, reach).select("l_id", "r_id"), lambda t: nearest_within(t, both_ways, reach).select("l_id", "r_id")])


def fit_rectangle(polygons: DataFrame) -> DataFrame:
    """E-13: (id, long, short, direction, x, y) of rings that fill more than 0.9 of their oriented envelope."""
    e = polygons.select("id", "ring", G.oriented_envelope(F.col("ring")).alias("e"), G.area(F.col("ring")).alias("a")).where("e.area > 0")
    c = G.centroid(F.col("ring"))
    return e.where(F.col("a") / F.col("e.area") > 0.9).select("id", F.col("e.long").alias("long"), F.col("e.short").alias("short"), F.col("e.azimuth").alias("direction"), c["x"].alias("x"), c["y"].alias("y"))


def link_lane_ends(lanes: DataFrame) -> DataFrame:
    """F-18: ends of linked lanes (id, next_id, n: lanes of the road in its direction, sx, sy, ex, ey: in the direction of travel, spread_exit) brought together, in order.

    First, exits at spread ends of dual carriageways move to the entry of the next lane.  Then an entry moves to the exit of the lane before, where
    its road has no more lanes than that one's.  Exits whose next lane did not move take its entry.  Of several lanes before, the smallest id counts.
    """
    start = lanes.select(F.col("id").alias("next_id"), F.col("sx").alias("nx"), F.col("sy").alias("ny"))
    with_next = lanes.join(start.hint("merge"), "next_id", "left")
    out = lambda c, n: F.when(F.col("spread_exit") & F.col(n).isNotNull(), F.col(n)).otherwise(F.col(c)).alias(c)
    spread = with_next.select("id", "next_id", "n", "sx", "sy", out("ex", "nx"), out("ey", "ny"))
    before = spread.where("next_id is not null").groupBy(F.col("next_id").alias("id")).agg(F.min(F.struct("id", "n", "ex", "ey")).alias("p"))
    moved = spread.join(before.hint("merge"), "id", "left").withColumn("moved", F.coalesce(F.col("n") <= F.col("p.n"), F.lit(False)))
    entered = moved.select("id", "next_id", F.when(F.col("moved"), F.col("p.ex")).otherwise(F.col("sx")).alias("sx"), F.when(F.col("moved"), F.col("p.ey")).otherwise(F.col("sy")).alias("sy"), "ex", "ey")
    still = moved.where("not moved").select(F.col("id").alias("next_id"), F.col("sx").alias("nx"), F.col("sy").alias("ny"))
    return entered.join(still.hint("merge"), "next_id", "left").select("id", "next_id", "sx", "sy", F.coalesce("nx", "ex").alias("ex"), F.coalesce("ny", "ey").alias("ey"))


def first_cut(cuts: DataFrame, key: str = "line_id") -> DataFrame:
    """F-12: the first place along each line where it is crossed."""
    return cuts.groupBy(key).agg(F.min("at").alias("cut"))


def head_and_tail(lines: DataFrame, cuts: DataFrame, least: float = 0.0, key: str = "line_id") -> DataFrame:
    """F-12: (key, part, from_m, to_m): lines (key, total) as `head` up to their first cut (key, at) strictly inside and `tail` behind it, or `head` alone; parts no longer than `least` go."""
    inside = cuts.join(lines.hint("merge"), key).where("at > 0 and at < total")
    both = lines.join(first_cut(inside.select(key, "at"), key).hint("merge"), key, "left")
    head = F.struct(F.lit("head").alias("part"), F.lit(0.0).alias("from_m"), F.coalesce("cut", "total").alias("to_m"))
    tail = F.struct(F.lit("tail").alias("part"), F.coalesce("cut", "total").alias("from_m"), F.col("total").alias("to_m"))
    return both.select(key, F.explode(F.array(head, tail)).alias("p")).select(key, "p.*").where(F.col("to_m") - F.col("from_m") > least)


def reattribute(lines: DataFrame, edges: DataFrame, style: list[str], columns: list[str]) -> DataFrame:
    """F-15: attributes of merged lines from the longest source that lies on the line as a whole; else from the longest that shares a stretch or a node with it; then the smaller id.

    `lines` has (edge_id, line), `edges` (edge_id, source_id, a, b: nodes, len, *style, *columns): a source may be cut into edges that went to
    several lines.  At a node only the longest source of a style can win, so nothing pairs the lines and sources of a node.
    """
    key = F.to_json(F.struct(*style))
    e = edges.withColumn("_style", key)
    sources = e.groupBy("source_id", "_style").agg(F.sum("len").alias("total"), F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in columns])
    won = F.struct((-F.col("total")).alias("t"), "source_id", *columns)
    placed = written(e.join(lines.hint("merge"), "edge_id"), "placed")
    held = placed.groupBy("line", "source_id").agg(F.count(F.lit(1)).alias("held")).join(sources.hint("merge"), "source_id")
    whole = held.where("held = n").groupBy("line").agg(F.min(won).alias("m"))
    whole = written(whole, "whole")
    nodes = lambda df, *more: df.select(*more, "_style", F.explode(F.array("a", "b")).alias("node"))
    best = nodes(e.select("source_id", "_style", "a", "b").join(sources.hint("merge"), ["source_id", "_style"]), "source_id", "total", *columns).groupBy("_style", "node").agg(F.min(won).alias("m"))
    open_ = nodes(placed.join(whole.select("line").hint("merge"), "line", "left_anti"), "line").distinct()
    touching = open_.join(best.hint("merge"), ["_style", "node"]).groupBy("line").agg(F.min("m").alias("m"))
    out = whole.select("line", "m", F.lit(True).alias("whole")).unionByName(touching.select("line", "m", F.lit(False).alias("whole")))
    return out.select("line", "m.source_id", *[F.col(f"m.{c}").alias(c) for c in columns], "whole")


def snap_endpoints(ends: DataFrame, tolerance: float) -> DataFrame:
    """F-13: (l_id, lx, ly) moved to the nearest end of another line of the same kind and layer that is narrower, or as narrow with a smaller id.

    `ends` has l_id, line, kind, layer (null is 0), width, lx, ly.  Nothing pairs the ends of two places: an end asks each place around for the smallest id
    among those of lower rank, a running minimum, so the work grows with the ends times the places around them.
    """
    from .spatial import points_within

    e = ends.where("kind is not null and line is not null").select("l_id", "line", "kind", F.coalesce("layer", F.lit(0)).alias("layer"), "width", "lx", "ly")
    near = points_within(e.select("lx", "ly").distinct(), e.select(F.col("lx").alias("rx"), F.col("ly").alias("ry")).distinct(), tolerance)
    # ends stand at their place, and ask at the places around: both in order of rank, an end that asks before its equals
    own = e.select(F.col("lx").alias("rx"), F.col("ly").alias("ry"), "kind", "layer", "width", "line", F.lit(None).cast("double").alias("d"), F.col("l_id").alias("id"), F.lit(1).alias("stands"))
    asks = e.join(near.hint("merge"), ["lx", "ly"]).select("rx", "ry", "kind", "layer", "width", "line", "d", F.col("l_id").alias("id"), F.lit(0).alias("stands"))
    place = Window.partitionBy("rx", "ry", "kind", "layer").orderBy("width", "line", "stands")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    rows = own.unionByName(asks).withColumn("r", F.when(F.col("stands") == 1, F.struct("id", "line"))).withColumn("first", F.min("r").over(before))
    # the first is the smallest id so far; the second, the smallest of another line, once stood behind a first of another line or was one
    behind = F.when(F.col("r.line") != F.col("first.line"), F.greatest("r", "first"))
    rows = rows.withColumn("second", F.min(behind).over(before)).where("stands = 0")
    found = F.when(F.col("first.line") != F.col("line"), F.col("first.id")).otherwise(F.col("second.id"))
    best = rows.select(F.col("id").alias("l_id"), "d", found.alias("r_id"), "rx", "ry").where("r_id is not null").groupBy("l_id").agg(F.min(F.struct("d", "r_id", "rx", "ry")).alias("m"))
    return ends.join(best.hint("merge"), "l_id", "left").select("l_id", "line", F.coalesce("m.rx", "lx").alias("lx"), F.coalesce("m.ry", "ly").alias("ly"))


def turn_of(a: Column, b: Column) -> Column:
    """Signed turn from one direction to another, -180 .. 180."""
    return F.pmod(b - a + 180.0, F.lit(360.0)) - 180.0


def running_share(df: DataFrame, key: str, order: str, weight: str) -> DataFrame:
    """W-09: adds `run`, the running sum of the weight."""
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("run", F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def at_nodes(ends: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """(id, which, others, goes_on) per end (id, which, *keys, az: degrees, gx, gy) of a line that meets others: how many, and whether one with equal `keys` lies within `tolerance` of its axis.

    Nothing pairs the ends of a node: they are counted, and the nearest axis of another line is one of the three
    rows before or after in order of azimuth, as a line has two ends at a node at most.
    """
    node = ["gx", "gy"]
    there = ends.groupBy(*node).agg((F.countDistinct("id") - 1).alias("others")).where("others > 0")
    axis = F.pmod(F.col("az").cast("double"), F.lit(180.0))
    own = ends.select("id", "which", *keys, *node, axis.alias("d"))
    named = own.where(" and ".join(f"{k} is not null" for k in keys))
    # axes are a circle of 180 degrees: those near its ends stand beyond the other end too
    ghosts = named.where((F.col("d") <= tolerance) | (F.col("d") >= 180.0 - tolerance)).select("id", F.lit(None).cast("string").alias("which"), *keys, *node, F.when(F.col("d") <= tolerance, F.col("d") + 180.0).otherwise(F.col("d") - 180.0).alias("d"))
    rows = named.withColumn("which", F.col("which").cast("string")).unionByName(ghosts)
    w = Window.partitionBy(*keys, *node).orderBy("d", "id")
    close = [F.coalesce((step("id", n).over(w) != F.col("id")) & (F.abs(step("d", n).over(w) - F.col("d")) <= tolerance), F.lit(False)) for step in (F.lag, F.lead) for n in (1, 2, 3)]
    on = close[0]
    for c in close[1:]:
        on = on | c
    told = rows.withColumn("on", on).where("which is not null and on").select("id", "which").distinct().withColumn("_on", F.lit(True))
    counted = ends.select("id", F.col("which").cast("string").alias("which"), *node).distinct().join(there.hint("merge"), node).select("id", "which", "others")
    return counted.join(told.hint("merge"), ["id", "which"], "left").select("id", "which", "others", F.coalesce("_on", F.lit(False)).alias("goes_on"))


def end_stats(ends: DataFrame, tolerance: float = 25.0) -> DataFrame:
    """A-15: per end of a line (id, which, name, az, gx, gy): the other lines there, and whether one of its name goes straight on."""
    return at_nodes(ends, ["name"], tolerance)


def end_offset(ends: DataFrame, stops: DataFrame, touching: DataFrame, near: float = 7.5, far: float = 15.0) -> DataFrame:
    """E-03: (line_id, stop_id, end_offset): signed distance of a line's end (line_id, x, y) from its best stop line (stop_id, x1, y1, x2, y2, backward).

    Stop lines count that come within `near` of the end, or that the line or one of its way touches (line_id, stop_id) if not farther than `far`.
    Left of the bar is positive; bars for the opposite direction are turned.
    """
    from .spatial import CELL, at_cell, in_cells

    l, r = F.least, F.greatest
    bar = F.struct(G.point(F.col("x1"), F.col("y1")).alias("a"), G.point(F.col("x2"), F.col("y2")).alias("b"))
    side = F.signum((F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("x") - F.col("x1"))) * F.when(F.col("backward"), -1).otherwise(1)
    told = F.struct(G._nearest_on(bar, G.point(F.col("x"), F.col("y")))["d"].alias("d"), "stop_id", side.alias("side"))
    # cells are as wide as the short reach, the long one goes by key; ends of one place and equal bars meet once
    size = max(2 * near, 1.0)
    one = stops.groupBy("x1", "y1", "x2", "y2", "backward").agg(F.min("stop_id").alias("stop_id"))
    bars = in_cells(one, l("x1", "x2") - near, l("y1", "y2") - near, r("x1", "x2") + near, r("y1", "y2") + near, size)
    close = at_cell(ends.select("x", "y").distinct(), F.col("x"), F.col("y"), size).join(bars.hint("merge"), CELL).select("x", "y", told.alias("m")).where(F.col("m.d") <= near)
    found = ends.join(close.groupBy("x", "y").agg(F.min("m").alias("m")).hint("merge"), ["x", "y"]).select("line_id", "m")
    known = ends.join(touching.hint("merge"), "line_id").join(stops.hint("merge"), "stop_id").select("line_id", told.alias("m")).where(F.col("m.d") <= max(near, far))
    best = found.unionByName(known).groupBy("line_id").agg(F.min("m").alias("m"))
    return best.select("line_id", "m.stop_id", (F.col("m.d") * F.col("m.side")).alias("end_offset"))


def close_or_touching(pairs: DataFrame, touching: DataFrame, near: float, far: float) -> DataFrame:
    """Pairs (line_id, stop_id, d) within `near`, or touching and within `far`."""
    known = touching.select("line_id", "stop_id", F.lit(True).alias("touches")).distinct()
    return pairs.join(known.hint("merge"), ["line_id", "stop_id"], "left").where((F.col("d") <= near) | (F.coalesce("touches", F.lit(False)) & (F.col("d") <= far))).drop("touches")


def spread_ends(ends: DataFrame, singles: DataFrame) -> DataFrame:
    """F-17: ends of dual-carriageway pieces (end_id, name, highway, x, y, az, left_offset) moved beside the road they come from.

    `singles` has ends of other roads (s_id, name, highway, x, y, az: degrees away from the point).  The road of the same name and class
    with the smallest angle counts, else a road of the class if it is the only one there; without one an end stays.
    """
    off = G.angle_difference(F.col("az"), F.col("s_az"))
    s = singles.select("s_id", F.col("name").alias("s_name"), "highway", "x", "y", F.col("az").alias("s_az"))
    place = ["highway", "x", "y"]
    # directions at a place are compared once for each name, however many ends and roads have them; a road that is alone needs no pairs
    asks, kinds = ends.select(*place, "name", "az").distinct(), s.groupBy(*place, F.col("s_name").alias("name"), "s_az").agg(F.min("s_id").alias("s_id"))
    same = asks.join(kinds.hint("merge"), [*place, "name"]).groupBy(*place, "name", "az").agg(F.min(F.struct(off.alias("off"), "s_id", "s_az")).alias("same"))
    alone = s.groupBy(*place).agg(F.min(F.struct("s_id", "s_az")).alias("any"), F.max("s_id").alias("last")).where("any.s_id = last").drop("last")
    l, r = ends.alias("l"), same.alias("r")
    on = F.col("l.az").eqNullSafe(F.col("r.az"))
    for c in (*place, "name"):
        on = on & (F.col(f"l.{c}") == F.col(f"r.{c}"))
    told = l.join(r.hint("merge"), on, "left").select("l.*", "r.same").join(alone.hint("merge"), place, "left")
    moved = told.withColumn("turn", F.radians(F.coalesce("same.s_az", "any.s_az") + 90))
    shift = lambda c, f: F.when(F.col("turn").isNotNull(), F.col(c) - f("turn") * F.col("left_offset")).otherwise(F.col(c))
    return moved.select("end_id", shift("x", F.sin).alias("x"), shift("y", F.cos).alias("y"), F.col("turn").isNotNull().alias("moved"))


def line_to_symbol(lines: DataFrame) -> DataFrame:
    """E-04: arrow ways (line_id, line, direction, length) as symbols in their middle: (line_id, x, y, direction, length)."""
    total = G.length(F.col("line"))
    rows = lines.withColumn("_n", total).where("_n > 0.01")
    az = F.degrees(G.azimuth(G.interpolate_at(F.col("line"), F.col("_n") * 0.02), G.interpolate_at(F.col("line"), F.col("_n") * 0.98)))
    mid = G.interpolate_at(F.col("line"), F.col("_n") * 0.5)
    return rows.select("line_id", mid.alias("p"), F.round(F.coalesce("direction", az), 1).alias("direction"), F.coalesce("length", F.round("_n", 1)).alias("length")).select("line_id", "p.x", "p.y", "direction", "length")


def to_node(polygons: DataFrame, nodes: DataFrame, largest: float = 50.0, cell: float = 16.0) -> DataFrame:
    """E-14: small polygons (l_id, ring) that hold no node (r_id, rx, ry) as their centroids."""
    from .spatial import CELL, at_cell, in_cells

    small = polygons.select("l_id", "ring", G.area(F.col("ring")).alias("area")).where(F.col("area") < largest)
    e = G.envelope(F.col("ring"))
    # equal rings ask once, and nodes of one place answer once
    cells = in_cells(small.select("ring").distinct(), e["xmin"], e["ymin"], e["xmax"], e["ymax"], cell)
    spots = at_cell(nodes.select("rx", "ry").distinct(), F.col("rx"), F.col("ry"), cell)
    held = cells.join(spots.hint("merge"), CELL).where(G.contains(F.array("ring"), G.point(F.col("rx"), F.col("ry")))).select("ring").distinct()
    c = G.centroid(F.col("ring"))
    return small.join(held.hint("merge"), "ring", "left_anti").select("l_id", c["x"].alias("x"), c["y"].alias("y"))


def sign_direction(signs: DataFrame, vertices: DataFrame) -> DataFrame:
    """E-17: (sign_id, degrees) of signs (sign_id, x, y, direction: null, forward or backward) that stand on a vertex of a line but not its first (line_id, i, x, y).

    A forward sign looks against the line's course to the next vertex, or from the one before at the end; of several lines the smallest counts.
    """
    w = Window.partitionBy("line_id").orderBy("i")
    v = vertices.select("line_id", "i", "x", "y", F.lag("x").over(w).alias("px"), F.lag("y").over(w).alias("py"), F.lead("x").over(w).alias("nx"), F.lead("y").over(w).alias("ny")).where("px is not null")
    met = signs.join(v.hint("merge"), ["x", "y"])
    here, before, after = G.point(F.col("x"), F.col("y")), G.point(F.col("px"), F.col("py")), G.point(F.col("nx"), F.col("ny"))
    forward = F.coalesce(F.col("direction") == "forward", F.lit(True))
    az = F.when(forward & F.col("nx").isNotNull(), G.azimuth(here, after)).otherwise(G.azimuth(before, here))
    turned = F.round(F.degrees(az)) + F.when(forward, 180).otherwise(0)
    return met.groupBy("sign_id").agg(F.min(F.struct("line_id", "i", F.pmod(turned, F.lit(360.0)).alias("degrees"))).alias("m")).select("sign_id", "m.degrees")
