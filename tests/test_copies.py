"""Joins on cells are never broadcast, and copies of a place or a shape are looked at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pavestone.operators import areas as A
from pavestone.operators import linear as L
from pavestone.operators import overlay as O
from pavestone.operators import spatial as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def points(spark, p, n=40):
    return spark.range(n).select(F.col("id").alias(f"{p}_id"), (F.col("id") % 4 * 1.0).alias(f"{p}x"), F.lit(0.0).alias(f"{p}y"))


@pytest.mark.parametrize("name", ["points_within", "nearest_within", "places_within"])
def test_points_are_not_broadcast(spark, name):
    """The planner counts no row of an explode, so a side that looks small may be any size."""
    got = plan(getattr(S, name)(points(spark, "l"), points(spark, "r"), 1.5))
    assert "SortMergeJoin" in got and "Broadcast" not in got


def test_segments_and_boxes_are_not_broadcast(spark):
    s = spark.range(20).select(F.col("id").alias("line_id"), (F.col("id") * 5.0).alias("x1"), F.lit(0.0).alias("y1"), (F.col("id") * 5.0 + 9).alias("x2"), F.lit(1.0).alias("y2"), F.lit(0.0).alias("at"))
    other = s.select(F.col("line_id").alias("other_id"), "x1", "y1", "x2", "y2")
    box = lambda p: s.select(F.col("line_id").alias(f"{p}_id"), *[F.col(c).alias(f"{p}{c[0]}{int(c[1]) - 1}") for c in ("x1", "y1", "x2", "y2")])
    ring = F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in [("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"), ("x1", "y1")]])
    frames = [
        L.crossing_places(s, other), S.box_pairs(box("l"), box("r"), 16.0), O.line_in_polygon(s.withColumn("i", F.lit(0)), s.select(F.col("line_id").alias("poly_id"), F.array(ring).alias("rings")), 16.0),
        A.crossing_segments(s.withColumnRenamed("line_id", "a_id"), s.withColumnRenamed("line_id", "b_id")),
    ]
    for df in frames:
        got = plan(df)
        assert "SortMergeJoin" in got and "Broadcast" not in got


def test_nearest_of_copies(spark):
    """Ten right points of one place are one row of the join; the smallest id answers every left copy."""
    got = S.nearest_within(points(spark, "l").where("l_id < 8"), points(spark, "r").withColumn("tag", F.col("r_id") * 2), 0.5)
    assert sorted(map(tuple, got.select("l_id", "r_id", "d", "tag").collect())) == [(i, i % 4, 0.0, i % 4 * 2) for i in range(8)]


def test_overlap_depth_counts_copies(spark):
    c = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 0.0, 0.0, 1.0), (3, 0.0, 0.0, 2.0), (4, 9.0, 0.0, 1.0)], "id int, x double, y double, r double")
    got = {r["id"]: r["s"] / 3.141592653589793 for r in S.overlap_depth(c, 2.0).collect()}
    assert got == pytest.approx({1: 2.0, 2: 2.0, 3: 2.0, 4: 0.0})


def test_overlap_area_of_copies(spark):
    rows = [(i, [[(0.0, 0.0), (2.0, 0.0), (2.0, 1.0 + i % 2), (0.0, 1.0 + i % 2), (0.0, 0.0)]]) for i in range(6)]
    p = spark.createDataFrame(rows, "id int, rings array<array<struct<x:double,y:double>>>")
    got = S.overlap_area(p.withColumnRenamed("id", "l_id"), p.withColumnRenamed("id", "r_id")).collect()
    assert sorted((r["l_id"], r["r_id"], round(r["area"], 9)) for r in got) == [(i, j, 4.0 if i % 2 and j % 2 else 2.0) for i in range(6) for j in range(6)]


def test_best_overlap_leaves_out_its_own_copy(spark):
    rows = [(i, [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]]) for i in range(3)] + [(9, [[(50.0, 0.0), (52.0, 0.0), (52.0, 2.0), (50.0, 2.0), (50.0, 0.0)]])]
    p = spark.createDataFrame(rows, "id int, rings array<array<struct<x:double,y:double>>>")
    got = S.best_overlap(p.withColumnRenamed("id", "l_id"), p.withColumnRenamed("id", "r_id")).collect()
    assert sorted(map(tuple, got)) == [(0, 1), (1, 0), (2, 0)]


def test_near_equal_pieces_deal_out_no_cuts(spark):
    """A line of 50,000 pieces stays one row until its pieces are made; cuts within reach of a junction move there."""
    lines = spark.createDataFrame([(1, 75_000_000.0), (2, 3000.0), (3, 10.0)], "line_id int, total double")
    got = L.near_equal_pieces(lines, spark.createDataFrame([(2, 1600.0), (2, 1450.0), (2, 2900.0)], "line_id int, at double"), 1500.0, 200.0)
    tree = plan(got)
    assert "Exchange" not in tree[: tree.index("Generate posexplode")]
    rows = got.where("line_id <> 1").orderBy("line_id", "piece").collect()
    assert [tuple(r) for r in rows] == [(2, 0, 0.0, 1450.0), (2, 1, 1450.0, 3000.0), (3, 0, 0.0, 10.0)]
    assert got.where("line_id = 1").count() == 50_000


def test_spread_ends_compare_directions_once(spark):
    from pavestone.operators import derive as D

    e = spark.createDataFrame([(i, 1, "a", 0.0, 0.0, 90.0, 2.0) for i in range(4)] + [(9, None, "b", 0.0, 0.0, 0.0, 2.0)], "end_id int, name int, highway string, x double, y double, az double, left_offset double")
    s = spark.createDataFrame([(1, 1, "a", 0.0, 0.0, 80.0), (2, 1, "a", 0.0, 0.0, 90.0), (3, 1, "a", 0.0, 0.0, 90.0), (4, 5, "b", 0.0, 0.0, 0.0)], "s_id int, name int, highway string, x double, y double, az double")
    got = {r["end_id"]: (round(r["x"], 9), round(r["y"], 9)) for r in D.spread_ends(e, s).collect()}
    assert got == {**{i: (0.0, 2.0) for i in range(4)}, 9: (-2.0, 0.0)}


def test_stops_and_their_segments_are_not_broadcast(spark, data):
    """Segments are made by an explode, eight times as many as the planner counts."""
    from __spark_entry__ import queries

    for name in ("e20_approach_outline", "e20_outline_groups", "e25_buffer_markings"):
        got = plan(queries()[name](spark, str(data)))
        assert "SortMergeJoin" in got and "Broadcast" not in got


def test_sums_half_way_between_two_roundings(spark):
    """In sf0.1 there are customers whose cuts add up to a half of the last digit."""
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    path = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute("SET threads = 1")  # its own sums depend on the order of its threads
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}/orders.parquet'")
    want = dict(con.execute(oracle_sql()["e40_split_between_touches"]).fetchall())
    assert {r["line_id"]: r["cuts"] for r in queries()["e40_split_between_touches"](spark, path).collect()} == want


def test_markers_are_counted_without_being_made(spark):
    """A segment has the numbers of its first and last marker; a row per marker is made only where markers are asked for."""
    from pavestone.operators import generate as E

    s = spark.createDataFrame([(1, 0, 0.0, 0.0, 30.0, 0.0, 0.0, 1e6), (1, 1, 30.0, 0.0, 1e6, 0.0, 30.0, 1e6), (2, 0, 0.0, 0.0, 50.0, 0.0, 0.0, 50.0)], "line_id int, i int, x1 double, y1 double, x2 double, y2 double, at double, total double")
    n = E.marker_ranges(s, 50.0).groupBy("line_id").agg(F.sum(F.col("high") - F.col("low") + 1).alias("n"))
    assert "Generate" not in plan(n)
    assert {r["line_id"]: r["n"] for r in n.collect()} == {1: 20_000, 2: 1}
    short = s.where("line_id = 2").unionByName(s.where("line_id = 2").withColumn("line_id", F.lit(3)).withColumn("x2", F.lit(101.0)).withColumn("total", F.lit(101.0)))
    assert sorted((r["line_id"], r["k"]) for r in E.markers(short, 50.0).collect()) == [(2, 0), (3, 0), (3, 1), (3, 2)]


def test_boxes_of_a_shape_are_compared_once(spark):
    b = spark.range(60).select(F.col("id"), (F.col("id") % 3 * 4.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") % 3 * 4.0 + 6).alias("x1"), F.lit(5.0).alias("y1"))
    side = lambda p: b.select(*[F.col(c).alias(f"{p}_id" if c == "id" else f"{p}{c}") for c in b.columns])
    seen = []
    keep = lambda pairs: (seen.append(pairs.count()), pairs)[1]
    got = {tuple(r) for r in S.box_pairs_of_copies(side("l"), side("r"), 16.0, keep).collect()}
    rows = b.collect()
    want = {(p.id, q.id) for p in rows for q in rows if p.x0 <= q.x1 and q.x0 <= p.x1}
    assert got == want and seen == [7]
    points = spark.range(90).select(F.col("id").alias("l_id"), (F.col("id") % 30 * 1.0).alias("lx"), F.lit(1.0).alias("ly"))
    held = {r["l_id"]: r["r_id"] for r in S.first_box(points, side("r"), 16.0).collect()}
    assert held == {p: min(q.id for q in rows if q.x0 <= p % 30 <= q.x1) for p in range(90) if any(q.x0 <= p % 30 <= q.x1 for q in rows)}


def test_pairs_of_copies_meet_in_blocks(spark):
    """100,000 copies of two places send at most 64 rows a place into the join, and every pair comes out."""
    l = spark.range(300).select(F.col("id").alias("l_id"), (F.col("id") % 2 * 9.0).alias("lx"), F.lit(0.0).alias("ly"))
    r = l.select(F.col("l_id").alias("r_id"), F.col("lx").alias("rx"), F.col("ly").alias("ry"))
    got = S.points_within_of_copies(l, r, 2.0)
    assert got.columns == ["l_id", "r_id", "lx", "ly", "rx", "ry", "d"]
    assert {(a["l_id"] % 2, a["r_id"] % 2, a["d"]) for a in got.collect()} == {(0, 0, 0.0), (1, 1, 0.0)} and got.distinct().count() == 2 * 150 * 150
    many = spark.range(100_000).select(F.col("id").alias("l_id"), (F.col("id") % 2 * 9.0).alias("lx"), F.lit(0.0).alias("ly"))
    assert S.in_blocks(many, "l", ["lx", "ly"]).count() <= 2 * S.BLOCKS
    tree = plan(got)
    assert tree.index("Generate explode(l_rows") < tree.index("SortMergeJoin") and "Exchange" not in tree[: tree.index("SortMergeJoin")]


def test_circle_pairs_of_copies(spark):
    c = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 0.0, 0.0, 1.0), (3, 1.5, 0.0, 2.0), (4, 3.0, 0.0, 1.0), (None, 9.0, 0.0, 1.0)], "id int, x double, y double, r double")
    got = sorted((r["l_id"], r["r_id"]) for r in S.circle_pairs(c, 2.0).collect())
    assert got == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2), (3, 4), (4, 3)]
    tree = plan(S.circle_pairs(c, 2.0))
    assert "Generate explode(l_rows" in tree and "Exchange" not in tree[: tree.index("SortMergeJoin")]


def test_snapped_ends_ask_places(spark):
    """Like comparing all ends; a place is asked for its running minimum, so no row pairs two ends."""
    import random

    from pavestone.operators import derive as D

    rnd = random.Random(5)
    rows = [(i, rnd.choice([None, *range(9)]), rnd.choice([None, 1, 2]), rnd.choice([None, 0, 1]), rnd.choice([None, 1, 2, 3]), float(rnd.randrange(4)), float(rnd.randrange(3))) for i in range(400)]
    ends = spark.createDataFrame(rows, "l_id int, line int, kind int, layer int, width int, lx double, ly double")
    low = lambda v: (v is not None, v or 0)
    want = {}
    for i, line, kind, layer, width, x, y in rows:
        near = [(((x - q[5]) ** 2 + (y - q[6]) ** 2) ** 0.5, q[0], q[5], q[6]) for q in rows if None not in (line, kind, q[1], q[2]) and line != q[1] and kind == q[2] and (layer or 0) == (q[3] or 0) and (low(q[4]), q[1]) < (low(width), line)]
        best = min([n for n in near if n[0] <= 1.0], default=(0, 0, x, y))
        want[i] = (line, *best[2:])
    got = D.snap_endpoints(ends, 1.0)
    assert {r["l_id"]: (r["line"], r["lx"], r["ly"]) for r in got.collect()} == want
    copies = ends.crossJoin(spark.range(20)).select((F.col("l_id") * 20 + F.col("id")).cast("int").alias("l_id"), "line", "kind", "layer", "width", "lx", "ly")
    asked = D.snap_endpoints(copies, 1.0)
    asked.count()
    assert "r_line" not in plan(asked)


def test_through_pairs_are_dealt_out_once(spark):
    """One exchange for the pairs and one for the nodes of two; nothing is joined."""
    import random

    from pavestone.operators import network as R

    rnd = random.Random(3)
    rows = [(rnd.randrange(30), i, rnd.choice([rnd.uniform(-400, 800), rnd.randrange(24) * 15.0, None])) for i in range(300)]
    ends = spark.createDataFrame(rows, "node int, seg int, degrees double")
    want = set()
    for node in {r[0] for r in rows}:
        at = [r for r in rows if r[0] == node]
        off = lambda p, q: min((p[2] - q[2] + 180) % 360, 360 - (p[2] - q[2] + 180) % 360)
        if len(at) == 2:
            want.add((node, at[0][1], at[1][1]))
        best = {p[1]: min([(off(p, q), q[1]) for q in at if p[1] != q[1] and None not in (p[2], q[2]) and off(p, q) <= 25.0], default=(0, None))[1] for p in at}
        if len(at) > 2:
            want |= {(node, a, b) for a, b in best.items() if b is not None and a < b and best[b] == a}
    got = R.through_pairs(ends)
    tree = plan(got)
    assert set(map(tuple, got.collect())) == want
    assert "SortMergeJoin" not in tree and tree.count("Exchange") == 2


def test_subtracted_cuts_are_sorted_once(spark):
    lines = spark.createDataFrame([(1, 0.0, 10.0), (1, 20.0, 30.0), (2, 0.0, 5.0), (2, 0.0, 5.0), (3, 0.0, 4.0), (4, 1.0, 3.0)], "line_id int, from_m double, to_m double")
    cuts = spark.createDataFrame([(1, 2.0, 4.0), (1, 3.0, 6.0), (1, 3.5, 4.0), (1, 6.0, 7.0), (1, 25.0, 99.0), (3, -1.0, 4.0), (4, 2.0, 2.0), (4, None, 9.0), (9, 0.0, 1.0)], "line_id int, from_m double, to_m double")
    got = L.subtract_intervals(lines, cuts)
    assert sorted(map(tuple, got.collect())) == [(1, 0.0, 2.0), (1, 7.0, 10.0), (1, 20.0, 25.0), (2, 0.0, 5.0), (4, 1.0, 3.0)]
    assert sorted(map(tuple, L.subtract_intervals(lines, cuts, 3.0).collect())) == [(1, 20.0, 25.0), (2, 0.0, 5.0)]
    tree = plan(L.subtract_intervals(lines, cuts))
    assert tree.count("SortMergeJoin") == 1 and tree.count("Window [") == 1


def test_carriageways_meet_areas_of_their_layer_only(spark):
    """The layer is a key of the join on cells, null a layer of its own; roads are dealt out once for their gaps."""
    at = lambda x, y: (float(x), float(y))
    roads = [(k, k, layer, "a", 6.0, 0.0, [at(0, 20 * k), at(50, 20 * k), at(100, 20 * k)]) for k, layer in enumerate([None, 0, 1])]
    r = spark.createDataFrame(roads, "road_id int, chain int, layer int, surface string, width double, placement_offset double, line array<struct<x:double,y:double>>")
    box = lambda x0, x1: [[at(x0, -5), at(x1, -5), at(x1, 60), at(x0, 60), at(x0, -5)]]
    a = spark.createDataFrame([(1, None, box(10, 20)), (2, 0, box(30, 40)), (3, 1, box(60, 100)), (4, 7, box(0, 100))], "poly_id int, layer int, rings array<array<struct<x:double,y:double>>>")
    got = A.carriageways(r, a)
    tree = plan(got)
    want = {0: {(-1.0, 11.0), (19.0, 50.0), (50.0, 101.0)}, 1: {(-1.0, 31.0), (39.0, 50.0), (50.0, 101.0)}, 2: {(-1.0, 50.0), (50.0, 61.0)}}
    found = {}
    for row in got.collect():
        xs = [p["x"] for p in row["ring"]]
        found.setdefault(row["road_id"], set()).add((round(min(xs), 6), round(max(xs), 6)))
    assert found == want
    # crossings, starts (two) and the gaps
    assert tree.count("SortMergeJoin") == 4


def test_disc_intervals_of_copies_and_occupied_cells(spark):
    """Equal discs meet a line once; a line far longer than the discs reach has the same intervals from their cells alone."""
    s = spark.createDataFrame([(1, 0.0, 0.0, 1e5, 0.0, 0.0), (2, 0.0, 900.0, 1e5, 900.0, 0.0)], "line_id int, x1 double, y1 double, x2 double, y2 double, at double")
    discs = spark.createDataFrame([(k, 100.0 + k % 3 * 5000, 1.0, 4.0) for k in range(12)] + [(50, 100.0, 901.0, 30.0)], "disc_id int, x double, y double, radius double")
    want = sorted(map(tuple, L.disc_intervals(s, discs).collect()))
    got = L.disc_intervals_of_copies(s, discs, far=True)
    assert sorted(map(tuple, got.collect())) == want and len(want) == 13
    assert L.disc_intervals_of_copies(s, discs.limit(0), far=True).count() == 0


def test_best_by_angle_makes_no_pairs(spark):
    """A thousand rows of one name and class: each asks its neighbours in the circle of axes; ties go to the smaller id, and a row is never its own partner."""
    from pavestone.operators import derive as D

    def want(rows):
        off = lambda a, b: min((a - b) % 180.0, 180.0 - (a - b) % 180.0)
        return {i: min(((off(a, b), j) for j, n, b in rows if n == m and j != i), default=None) for i, m, a in rows}

    rows = [(i, i % 3, float(i * 7 % 360)) for i in range(400)] + [(1000, 7, 10.0), (1001, 8, 20.0), (1002, 8, 199.0), (1003, 9, 5.0), (1004, 9, 175.0), (1005, 9, 185.0)]
    c = spark.createDataFrame(rows, "id int, name int, a double").selectExpr("*", "'x' as class")
    side = lambda p: c.select(F.col("id").alias(f"{p}_id"), "name", "class", F.col("a").alias(f"{p}a"))
    got = D.best_by_angle(side("l"), side("r"))
    assert {r["l_id"]: (r["off"], r["r_id"]) for r in got.collect()} == {k: v for k, v in want(rows).items() if v}
    # the join asks an equal axis, where pairs of a kind were made before
    assert "axis" in plan(got).split("SortMergeJoin")[1].split("\n")[0]


def test_marker_totals_make_no_markers(spark):
    from pavestone.operators import generate as E

    lines = spark.createDataFrame([(1, [(0.0, 0.0), (30.0, 0.0), (30.0, 70.0)]), (2, [(0.0, 0.0), (0.5, 0.0)]), (3, [(0.0, 0.0), (26.0, 0.0)])], "line_id int, line array<struct<x:double,y:double>>")
    s = L.line_segments(lines)
    want = E.markers(s, 25.0, 1.0).groupBy("line_id").agg(F.count(F.lit(1)), F.max("at"))
    got = E.marker_totals(s, 25.0, 1.0)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and "explode(sequence" not in plan(got)
    far = E.marker_totals(L.line_segments(spark.createDataFrame([(1, [(0.0, 0.0), (5e12, 0.0)])], lines.schema)), 25.0, 1.0)
    assert [r["n"] for r in far.collect()] == [200_000_000_000]


def test_connected_ends_of_copies(spark):
    """Ends of one place meet in blocks; only pairs of segments that both have several places are made distinct."""
    from pavestone.operators import derive as D

    rows = [(i, float(i % 3 * 100), 0.0) for i in range(30)] + [(i, 500.0, float(i % 2 * 100)) for i in range(10, 24)] + [(3, 1.0, 2.0)]
    ends = spark.createDataFrame(rows, "seg int, x double, y double")
    want = {(a, b) for a, ax, ay in rows for b, bx, by in rows if a != b and (round(ax / 10), round(ay / 10)) == (round(bx / 10), round(by / 10))}
    got = D.connect_snapped(ends, 10.0)
    found = [tuple(r) for r in got.select("a", "b").collect()]
    assert len(found) == len(set(found)) and set(found) == want
    one = spark.range(40).selectExpr("id as seg", "0.0D as x", "0.0D as y")
    assert D.connect_snapped(one, 10.0).count() == 40 * 39


def test_to_node_asks_places_and_shapes_once(spark):
    from pavestone.operators import derive as D

    box = lambda x: [(x, 0.0), (x + 2.0, 0.0), (x + 2.0, 2.0), (x, 2.0), (x, 0.0)]
    polygons = spark.createDataFrame([(i, box(i % 4 * 10.0)) for i in range(40)] + [(99, [(0.0, 0.0), (90.0, 0.0), (90.0, 9.0), (0.0, 0.0)])], "l_id int, ring array<struct<x:double,y:double>>")
    nodes = spark.createDataFrame([(i, 11.0, 1.0) for i in range(50)] + [(50, 500.0, 1.0)], "r_id int, rx double, ry double")
    got = D.to_node(polygons, nodes)
    assert sorted(tuple(r) for r in got.collect()) == [(i, i % 4 * 10.0 + 1, 1.0) for i in range(40) if i % 4 != 1]
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("Aggregate [") >= 3 and "Aggregate [rx" in tree
