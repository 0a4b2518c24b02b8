"""Linear-referencing operators: lines as rows, overlays as intervals along a line (G-13, F-01 .. F-25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..storage import written


def vertices(lines: DataFrame, key: str = "line_id", line: str = "line", carry: Sequence[str] = ()) -> DataFrame:
    """W-08: (key, *carry, i, x, y, at, total): vertices with their distance along the line; repeated points are dropped."""
    w = Window.partitionBy(key).orderBy("i")
    v = lines.select(key, *carry, F.posexplode(line).alias("i", "p")).select(key, *carry, "i", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2))
    v = v.withColumn("step", step).where("step is null or step > 0")
    v = v.withColumn("at", F.coalesce(F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0)))
    return v.withColumn("total", F.max("at").over(Window.partitionBy(key))).drop("step")


def collect_line(points: DataFrame, key: str, order: str, name: str = "line") -> DataFrame:
    """A-16: points (key, order, x, y) as one line per key."""
    return points.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "x", "y"))).alias("v")).select(key, F.transform("v", lambda p: G.point(p["x"], p["y"])).alias(name))


def offset_lines(lines: DataFrame, offset: Column, transition: Column | None = None, pin_start: Column | None = None, pin_end: Column | None = None, key: str = "line_id") -> DataFrame:
    """G-13, G-14: (key, line) shifted sideways, positive to the right.

    Each vertex moves along its normal (ends: of their segment; others: of the
    sum of the unit vectors before and after, or of the one after where they
    cancel) by offset + transition * (its fraction of the length).  Pinned ends
    stay.  Lines shorter than 0.001 are dropped.  `offset` and the others are
    expressions over the columns of `lines`.
    """
    zero, no = F.lit(0.0), F.lit(False)
    # the rules go with the vertices: nothing is joined back
    ruled = lines.select(key, "line", offset.cast("double").alias("o"), (zero if transition is None else transition).alias("t"), (no if pin_start is None else pin_start).alias("p1"), (no if pin_end is None else pin_end).alias("p2"))
    # one segment has one normal: such lines are never taken apart
    one = ruled.where(F.size("line") == 2).select(key, F.get("line", F.lit(0)).alias("a"), F.get("line", F.lit(1)).alias("b"), "o", "t", "p1", "p2")
    one = one.withColumn("_n", G.distance(F.col("a"), F.col("b"))).where("_n >= 0.001")
    n = F.nullif(F.col("_n"), F.lit(0.0))
    ux, uy = (F.col("b.x") - F.col("a.x")) / n, (F.col("b.y") - F.col("a.y")) / n
    moved = lambda p, by: G.point(F.col(f"{p}.x") + uy * by, F.col(f"{p}.y") - ux * by)
    one = one.select(key, F.array(moved("a", F.when(F.col("p1"), zero).otherwise(F.col("o"))), moved("b", F.when(F.col("p2"), zero).otherwise(F.col("o") + F.col("t")))).alias("line"))
    ruled = ruled.where(F.size("line") != 2)
    w = Window.partitionBy(key).orderBy("i")
    v = vertices(ruled, key, carry=["o", "t", "p1", "p2"]).where("total >= 0.001")
    d = lambda f: F.struct((f("x") - F.col("x")).alias("x"), (f("y") - F.col("y")).alias("y"))
    v = v.withColumn("n", d(lambda c: F.lead(c).over(w))).withColumn("b", d(lambda c: F.lag(c).over(w)))
    nl, bl = F.sqrt(F.pow("n.x", 2) + F.pow("n.y", 2)), F.sqrt(F.pow("b.x", 2) + F.pow("b.y", 2))
    v = v.withColumn("ax", F.col("n.x") / nl).withColumn("ay", F.col("n.y") / nl).withColumn("px", -F.col("b.x") / bl).withColumn("py", -F.col("b.y") / bl)
    v = v.withColumn("sx", F.coalesce("ax", zero) + F.coalesce("px", zero)).withColumn("sy", F.coalesce("ay", zero) + F.coalesce("py", zero))
    size = F.sqrt(F.col("sx") * F.col("sx") + F.col("sy") * F.col("sy"))
    v = v.withColumn("size", size).withColumn("tx", F.when(F.col("size") < 1e-12, F.col("ax")).otherwise(F.col("sx") / F.col("size"))).withColumn("ty", F.when(F.col("size") < 1e-12, F.col("ay")).otherwise(F.col("sy") / F.col("size")))
    shift = F.when((F.col("p1") & F.col("px").isNull()) | (F.col("p2") & F.col("ax").isNull()), zero).otherwise(F.col("o") + F.col("t") * F.col("at") / F.col("total"))
    moved = v.select(key, "i", (F.col("x") + F.col("ty") * shift).alias("x"), (F.col("y") - F.col("tx") * shift).alias("y"))
    return one.unionByName(collect_line(moved, key, "i"))


def merge_intervals(intervals: DataFrame, key: str | Sequence[str] = "line_id", low: str = "from_m", high: str = "to_m") -> DataFrame:
    """F-04: overlapping and touching intervals of a key as one (islands by a running maximum)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(low, high)
    far = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.select(*keys, low, high).withColumn("new", F.when(far.isNull() | (F.col(low) > far), 1).otherwise(0))
    numbered = marked.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("island")


def gaps_between(cuts: DataFrame, key: str = "line_id") -> DataFrame:
    """(key, g0, g1): the gaps before, between and behind the cuts (key, from_m, to_m) of a key, in one pass; null where a gap has no end."""
    w = Window.partitionBy(key).orderBy("from_m", "to_m")
    c = cuts.where("to_m > from_m").select(key, "from_m", "to_m")
    c = c.withColumn("far", F.max("to_m").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("last", F.lead("from_m").over(w).isNull())
    c = c.where("far is null or from_m > far or last")
    behind = F.when(F.col("last"), F.struct(F.greatest("far", "to_m").alias("g0"), F.lit(None).cast("double").alias("g1")))
    return c.select(key, F.explode(F.array(F.struct(F.col("far").cast("double").alias("g0"), F.col("from_m").cast("double").alias("g1")), behind)).alias("g")).where("g is not null").select(key, "g.*")


def subtract_intervals(lines: DataFrame, cuts: DataFrame, least: float = 0.0, key: str = "line_id") -> DataFrame:
    """F-04: the parts (key, from_m, to_m) of lines (key, from_m, to_m) outside the cuts that are longer than `least`."""
    # dealt by the key alone, which the join needs too
    whole = lines.where("from_m is not null and to_m is not null").select(key, F.col("from_m").alias("l0"), F.col("to_m").alias("l1")).repartition(key).distinct()
    parts = whole.join(gaps_between(cuts, key).hint("merge"), key, "left").select(key, F.greatest("l0", "g0").alias("from_m"), F.least("l1", "g1").alias("to_m"))
    return parts.where((F.col("to_m") > F.col("from_m")) & (F.col("to_m") - F.col("from_m") > least))


def split_at(lines: DataFrame, places: DataFrame, key: str = "line_id") -> DataFrame:
    """F-01: lines (key, from_m, to_m) in pieces (with `piece` from 0) at places (key, at) strictly inside."""
    inside = lines.join(places.hint("merge"), key).where("at > from_m and at < to_m").select(key, "from_m", "to_m", "at").distinct()
    marks = inside.select(key, "from_m", "to_m", "at").unionByName(lines.select(key, "from_m", "to_m", F.col("from_m").alias("at")))
    w = Window.partitionBy(key, "from_m").orderBy("at")
    return marks.select(key, (F.row_number().over(w) - 1).alias("piece"), F.col("at").alias("a"), F.coalesce(F.lead("at").over(w), "to_m").alias("b")).select(key, "piece", F.col("a").alias("from_m"), F.col("b").alias("to_m"))


def overlaps(a: DataFrame, b: DataFrame, key: str = "line_id") -> DataFrame:
    """A-07, F-09: pairs of intervals (key, a_id, from_m, to_m) and (key, b_id, ...) on the same line, with their common length."""
    l = a.select(key, "a_id", F.col("from_m").alias("a0"), F.col("to_m").alias("a1"))
    r = b.select(key, "b_id", F.col("from_m").alias("b0"), F.col("to_m").alias("b1"))
    return l.join(r.hint("merge"), key).withColumn("common", F.least("a1", "b1") - F.greatest("a0", "b0")).where("common > 0").select(key, "a_id", "b_id", "common")


def label_windows(lines: DataFrame, chop: float = 1200.0, window: float = 300.0, least: float = 200.0, key: str = "line_id") -> DataFrame:
    """F-08: lines (key, total) in pieces of up to `chop`; of pieces longer than `least`, the middle `window`."""
    n = F.ceil(F.col("total") / chop).cast("int")
    piece = lines.where("total > 0").select(key, "total", F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    piece = piece.select(key, "piece", (F.col("piece") * F.lit(chop)).alias("a"), F.least((F.col("piece") + 1) * F.lit(chop), F.col("total")).alias("b")).where(F.col("b") - F.col("a") > least)
    half = F.least(F.lit(window), F.col("b") - F.col("a")) / 2
    mid = (F.col("a") + F.col("b")) / 2
    return piece.select(key, "piece", (mid - half).alias("from_m"), (mid + half).alias("to_m"))


def near_equal_pieces(lines: DataFrame, junctions: DataFrame, longest: float, snap: float, apart: float = 1.0, key: str = "line_id") -> DataFrame:
    """F-07: lines (key, total) in ceil(total / longest) near-equal pieces; each cut moves to the closest junction (key, at) within `snap`."""
    n = F.ceil(F.col("total") / longest).cast("int")
    long = lines.withColumn("n", n)
    # a junction can only move the cuts within its reach: those are listed, a few for each junction, and all others stay on their line's row
    of = lambda m: F.col("n") * m / F.col("total")
    low, high = F.greatest(F.ceil(of(F.col("j") - snap)) - 1, F.lit(1)).cast("int"), F.least(F.floor(of(F.col("j") + snap)) + 1, F.col("n") - 1).cast("int")
    met = long.where("n > 1").join(junctions.select(key, F.col("at").alias("j")).hint("merge"), key).withColumn("_lo", low).withColumn("_hi", high).where("_lo <= _hi")
    near = met.select(key, "j", "n", "total", F.explode(F.sequence("_lo", "_hi")).alias("k"))
    near = near.withColumn("d", F.abs(F.col("j") - F.col("total") * F.col("k") / F.col("n"))).where(F.col("d") <= snap)
    best = near.groupBy(key, "k").agg(F.min(F.struct("d", "j")).alias("m"))
    moved = best.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("k", F.col("m.j").alias("j")))).alias("moved"))
    row = long.join(moved.hint("merge"), key, "left").withColumn("moved", F.coalesce("moved", F.create_map().cast("map<int,double>")))
    cuts = F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda k: F.coalesce(F.try_element_at("moved", k), F.col("total") * k / F.col("n")))
    row = row.withColumn("cuts", F.when(F.col("n") > 1, F.sort_array(F.array_distinct(cuts))).otherwise(F.array().cast("array<double>")))
    kept = F.filter("cuts", lambda c, i: ((i == 0) | (c - F.get("cuts", i - 1) > apart)) & (c > 0) & (c < F.col("total")))
    row = row.select(key, "total", kept.alias("kept"))
    # both ends stand in the array: a row of a piece does not carry those of its line
    pairs = F.arrays_zip(F.concat(F.array(F.lit(0.0)), "kept").alias("a"), F.concat("kept", F.array("total")).alias("b"))
    return row.select(key, F.posexplode(pairs).alias("piece", "p")).select(key, "piece", F.col("p.a").alias("from_m"), F.col("p.b").alias("to_m"))


def crossing_places(segments: DataFrame, others: DataFrame, cell: float = 64.0, key: str = "line_id") -> DataFrame:
    """(key, at): where lines, as segments (key, x1, y1, x2, y2, at), are crossed or touched by segments of other lines (other_id, x1, y1, x2, y2)."""
    from .areas import crossing_segments

    a = segments.select(F.struct(key, "at", F.col("x1").alias("ax"), F.col("y1").alias("ay")).alias("a_id"), "x1", "y1", "x2", "y2")
    b = others.select(F.col("other_id").alias("b_id"), "x1", "y1", "x2", "y2")
    met = crossing_segments(a, b, cell).where(F.col("b_id") != F.col(f"a_id.{key}"))
    step = F.sqrt(F.pow(F.col("x") - F.col("a_id.ax"), 2) + F.pow(F.col("y") - F.col("a_id.ay"), 2))
    return met.select(F.col(f"a_id.{key}").alias(key), (F.col("a_id.at") + step).alias("at")).distinct()


def connected_ends(ends: DataFrame, roads: DataFrame, reach: float = 3.0, least: int = 2, cell: float = 16.0) -> DataFrame:
    """(end_id) of ends (end_id, x, y) that have `least` roads or more, as segments (road_id, x1, y1, x2, y2), within `reach`."""
    from .spatial import CELL, along_cells, in_cells

    at = in_cells(ends, F.col("x") - reach, F.col("y") - reach, F.col("x") + reach, F.col("y") + reach, cell)
    bar = F.struct(G.point(F.col("x1"), F.col("y1")).alias("a"), G.point(F.col("x2"), F.col("y2")).alias("b"))
    near = at.join(along_cells(roads, "x1", "y1", "x2", "y2", cell).hint("merge"), CELL).where(G._nearest_on(bar, G.point(F.col("x"), F.col("y")))["d"] <= reach)
    # enough to know the smallest and the largest where two are asked for
    n = F.countDistinct("road_id") >= least if least != 2 else F.min("road_id") != F.max("road_id")
    return near.groupBy("end_id").agg(n.alias("ok")).where("ok").select("end_id")


def trim_ends(pieces: DataFrame, cut: float = 12.0, least: float = 5.0) -> DataFrame:
    """Pieces (from_m, to_m, trim_a, trim_b, ...) shortened by `cut` at the ends that are to be trimmed, if more than that is left; pieces of `least` or less go."""
    a, b = F.when(F.col("trim_a"), cut).otherwise(0.0), F.when(F.col("trim_b"), cut).otherwise(0.0)
    enough = F.col("to_m") - F.col("from_m") > a + b
    low, high = F.when(enough, F.col("from_m") + a).otherwise(F.col("from_m")), F.when(enough, F.col("to_m") - b).otherwise(F.col("to_m"))
    return pieces.withColumn("_low", low).withColumn("to_m", high).withColumn("from_m", F.col("_low")).drop("_low").where(F.col("to_m") - F.col("from_m") > least)


def label_pieces(lines: DataFrame, blade: float = 1.0, least: float = 5.0, reach: float = 3.0, cut: float = 12.0, cell: float = 64.0) -> DataFrame:
    """F-07: (line_id, from_m, to_m): street lines (line_id, line, main) split where other main roads meet them (`blade` metres go on both sides), and trimmed by `cut` at ends that are connected to another road; short pieces go."""
    segments = written(line_segments(lines), "segments")
    main = segments.join(lines.where("main").select("line_id").hint("merge"), "line_id", "left_semi").select(F.col("line_id").alias("other_id"), "x1", "y1", "x2", "y2")
    at = crossing_places(segments, main, cell)
    whole = segments.groupBy("line_id").agg(F.max("total").alias("to_m")).select("line_id", F.lit(0.0).alias("from_m"), "to_m")
    parts = written(subtract_intervals(whole, at.select("line_id", (F.col("at") - blade).alias("from_m"), (F.col("at") + blade).alias("to_m")), least), "parts")
    # the place of both ends of each part, on the segment that holds it
    both = parts.select("line_id", "from_m", F.explode(F.array(F.struct(F.lit("a").alias("which"), F.col("from_m").alias("m")), F.struct(F.lit("b").alias("which"), F.col("to_m").alias("m")))).alias("e")).select("line_id", "from_m", "e.*")
    n = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    on = both.join(segments.withColumn("n", n).hint("merge"), "line_id").where("m >= at and m <= at + n + 1e-9")
    t = (F.col("m") - F.col("at")) / F.col("n")
    ends = on.select(F.struct("line_id", "from_m", "which").alias("end_id"), (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"))
    found = connected_ends(ends, segments.select(F.col("line_id").alias("road_id"), "x1", "y1", "x2", "y2"), reach).select("end_id.*")
    flags = found.groupBy("line_id", "from_m").agg(F.bool_or(F.col("which") == "a").alias("trim_a"), F.bool_or(F.col("which") == "b").alias("trim_b"))
    told = parts.join(flags.hint("merge"), ["line_id", "from_m"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("trim_a", "trim_b")})
    return trim_ends(told, cut, least).select("line_id", "from_m", "to_m")


def chunk_line(line: Column, most: int = 256) -> Column:
    """F-23: a line as pieces of at most `most` vertices that share their ends."""
    n = F.size(line)
    starts = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)), F.lit(most - 1))
    return F.transform(starts, lambda s: F.slice(line, s, F.lit(most)))


def cut_lines(lines: DataFrame, parts: DataFrame, key: str = "line_id") -> DataFrame:
    """G-06: the geometry of parts (key, from_m, to_m, ...) of lines (key, line)."""
    return parts.join(lines.select(key, "line").hint("merge"), key).withColumn("line", G.substring(F.col("line"), F.col("from_m"), F.col("to_m")))


def disc_intervals(lines: DataFrame, discs: DataFrame, key: str = "line_id", cell: float = 64.0, far: bool = False) -> DataFrame:
    """F-03: where lines run inside discs: (key, disc_id, from_m, to_m).

    `lines` has segments (key, x1, y1, x2, y2, at: distance at the segment's
    start); `discs` (disc_id, x, y, radius).  Segments and discs meet by grid
    cells, of a size for each class of radii; a pair counts in the cell of the segment's point closest to
    the disc's centre, so it comes once.  The roots of the distance along the segment bound the interval.
    With `far`, for segments that run far beyond the discs, a map of the discs' cells is made first, and segments are dealt into those cells only.
    """
    from .spatial import CELL, along_cells, home_cell, in_cells, occupied

    r = F.col("radius")
    # classes double in size: a disc covers few cells of its own class, and there are few classes
    of = F.greatest(F.ceil(F.log2(2 * r / cell)), F.lit(0)).cast("int")
    sized = discs.where("radius > 0").withColumn("class", of)
    classes = sorted(row["class"] for row in sized.select("class").distinct().collect())
    out = None
    for k in classes:
        size = cell * 2.0**k
        disc = in_cells(sized.where(F.col("class") == k).select("disc_id", "x", "y", "radius"), F.col("x") - r, F.col("y") - r, F.col("x") + r, F.col("y") + r, size)
        seg = along_cells(lines.select(key, "x1", "y1", "x2", "y2", "at"), "x1", "y1", "x2", "y2", size, occupied(disc) if far else None)
        dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
        fx, fy = F.col("x1") - F.col("x"), F.col("y1") - F.col("y")
        qa, qb, qc = dx * dx + dy * dy, 2 * (fx * dx + fy * dy), fx * fx + fy * fy - r * r
        # the join looks for roots only, which is short code; what comes of a pair is made after it, by a generator that no filter is pushed through
        met = seg.join(disc.hint("merge"), CELL).where((qa > 0) & (qb * qb - 4 * qa * qc > 0))
        pair = met.select(key, "disc_id", "at", "x1", "y1", "x2", "y2", *CELL, F.explode(F.array(F.struct(qa.alias("qa"), qb.alias("qb"), (qb * qb - 4 * qa * qc).alias("disc2")))).alias("q"))
        pair = pair.select(key, "disc_id", "at", "x1", "y1", "x2", "y2", *CELL, "q.*")
        t = F.least(F.greatest(-F.col("qb") / (2 * F.col("qa")), F.lit(0.0)), F.lit(1.0))
        inside = lambda v, a, b: F.least(F.greatest(v, F.least(a, b)), F.greatest(a, b))
        pair = pair.where(home_cell(inside(F.col("x1") + t * dx, F.col("x1"), F.col("x2")), inside(F.col("y1") + t * dy, F.col("y1"), F.col("y2")), size))
        t0 = F.greatest((-F.col("qb") - F.sqrt("disc2")) / (2 * F.col("qa")), F.lit(0.0))
        t1 = F.least((-F.col("qb") + F.sqrt("disc2")) / (2 * F.col("qa")), F.lit(1.0))
        got = pair.select(key, "disc_id", (F.col("at") + t0 * F.sqrt("qa")).alias("from_m"), (F.col("at") + t1 * F.sqrt("qa")).alias("to_m")).where("to_m > from_m")
        out = got if out is None else out.unionByName(got)
    if out is None:  # no discs
        none = F.lit(None).cast("double")
        return lines.join(discs.select("disc_id").limit(0), F.lit(True), "inner").select(key, "disc_id", none.alias("from_m"), none.alias("to_m"))
    return out


def disc_intervals_of_copies(lines: DataFrame, discs: DataFrame, key: str = "line_id", cell: float = 64.0, far: bool = False) -> DataFrame:
    """F-03: `disc_intervals` where many discs are equal: lines meet each once, and only the last join, which nothing is dealt out after, makes a row per copy."""
    shapes = discs.groupBy("x", "y", "radius").agg(F.min("disc_id").alias("shape"))
    met = disc_intervals(lines, shapes.withColumnRenamed("shape", "disc_id"), key, cell, far).withColumnRenamed("disc_id", "shape")
    members = discs.select("disc_id", "x", "y", "radius").join(shapes.hint("merge"), ["x", "y", "radius"]).select("disc_id", "shape")
    return met.join(members.hint("merge"), "shape").select(key, "disc_id", "from_m", "to_m")


def line_segments(lines: DataFrame, key: str = "line_id", carry: Sequence[str] = ()) -> DataFrame:
    """(key, *carry, i, x1, y1, x2, y2, at, total) of the segments of lines (key, line)."""
    # lines of one segment are never taken apart
    one = lines.where(F.size("line") == 2).select(key, *carry, F.lit(0).alias("i"), F.get("line", F.lit(0)).alias("a"), F.get("line", F.lit(1)).alias("b"))
    one = one.select(key, *carry, "i", F.col("a.x").alias("x1"), F.col("a.y").alias("y1"), F.col("b.x").alias("x2"), F.col("b.y").alias("y2"), F.lit(0.0).alias("at"), G.distance(F.col("a"), F.col("b")).alias("total")).where("total > 0")
    w = Window.partitionBy(key).orderBy("i")
    v = vertices(lines.where(F.size("line") != 2), key, carry=carry)
    rest = v.select(key, *carry, "i", F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2"), "at", "total").where("x2 is not null")
    return one.unionByName(rest)


def corridor_intervals(segments: DataFrame, corridors: DataFrame, cell: float = 64.0) -> DataFrame:
    """F-03: (line_id, cor_id, from_m, to_m) where segments (line_id, i, x1, y1, x2, y2, at) run within `half` of corridors (cor_id, x1, y1, x2, y2, half).

    What lies within a distance of a segment is a disc at each end and a rectangle between; intervals of one corridor overlap.
    """
    from .overlay import line_in_polygon

    ends = F.explode(F.array(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2"))))
    discs = corridors.select(F.col("cor_id").alias("disc_id"), ends.alias("p"), F.col("half").alias("radius")).select("disc_id", "p.x", "p.y", "radius")
    round_ = disc_intervals(segments, discs, "line_id", cell).withColumnRenamed("disc_id", "cor_id")
    # one segment has one rectangle, which takes no lambdas
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    sized = corridors.withColumn("_n", F.sqrt(dx * dx + dy * dy)).where("_n > 0")
    at = lambda c, sign: G.point(F.col(f"x{c}") + dy / F.col("_n") * F.col("half") * sign, F.col(f"y{c}") - dx / F.col("_n") * F.col("half") * sign)
    ring = F.array(at(1, 1), at(2, 1), at(2, -1), at(1, -1), at(1, 1))
    rings = sized.select(F.col("cor_id").alias("poly_id"), F.array(ring).alias("rings"))
    between = line_in_polygon(segments, rings, cell).withColumnRenamed("poly_id", "cor_id").drop("inside_m")
    return round_.unionByName(between)


def cut_by(lines: DataFrame, zones: DataFrame, long_tunnel: float = 100.0, least: float = 0.0, key: str = "line_id") -> DataFrame:
    """F-22: what is left of label lines (key, total, tunnel) outside zones (key, from_m, to_m); tunnels longer than `long_tunnel` go as a whole."""
    kept = lines.where(~(F.col("tunnel") & (F.col("total") > long_tunnel)))
    return subtract_intervals(kept.select(key, F.lit(0.0).alias("from_m"), F.col("total").alias("to_m")), zones.select(key, "from_m", "to_m"), least, key)
