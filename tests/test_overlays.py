"""Overlays, pairs and medians on random shapes against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from pavestone.functions import geometry as G
from pavestone.operators import aggregates, generate, linear, network, overlay, spatial
from pavestone.plans import parking


def line(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def segments_of(spark, lines):
    df = spark.createDataFrame([(i, line(p)) for i, p in lines.items()], "line_id long, line array<struct<x:double,y:double>>")
    return linear.line_segments(df)


def inside(ring_list, x, y):
    odd = False
    for ring in ring_list:
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def place(points, at):
    for (ax, ay), (bx, by) in zip(points[:-1], points[1:], strict=True):
        d = math.hypot(bx - ax, by - ay)
        if at <= d:
            return ax + (bx - ax) * at / d, ay + (by - ay) * at / d
        at -= d
    return points[-1]


def test_lines_in_polygons_with_holes_and_long_segments(spark):
    r = random.Random(3)
    lines = {i: [(r.uniform(-400, 400), r.uniform(-400, 400)) for _ in range(r.randint(2, 5))] for i in range(12)}
    lines[90], lines[91] = [(0.0, -500.0), (0.0, 500.0)], [(-500.0, 1.0), (500.0, 1.0)]
    polygons = {}
    for p in range(8):
        cx, cy, n = r.uniform(-200, 200), r.uniform(-200, 200), r.randint(5, 11)
        star = [(cx + r.uniform(40, 150) * math.cos(2 * math.pi * k / n), cy + r.uniform(40, 150) * math.sin(2 * math.pi * k / n)) for k in range(n)]
        hole = [(cx + 15 * math.cos(-2 * math.pi * k / 4), cy + 15 * math.sin(-2 * math.pi * k / 4)) for k in range(4)]
        polygons[p] = [star + star[:1], hole + hole[:1]]
    df = spark.createDataFrame([(p, [line(x) for x in rings]) for p, rings in polygons.items()], "poly_id long, rings array<array<struct<x:double,y:double>>>")
    got = {}
    for x in overlay.line_in_polygon(segments_of(spark, lines), df, 32.0).collect():
        got.setdefault((x.line_id, x.poly_id), []).append((x.from_m, x.to_m))
    for i, points in lines.items():
        total = sum(math.dist(a, b) for a, b in zip(points[:-1], points[1:], strict=True))
        for p, rings in polygons.items():
            parts = got.get((i, p), [])
            for k in range(200):
                at = (k + 0.5) * total / 200
                if all(min(abs(at - a), abs(at - b)) > 1e-6 for a, b in parts):
                    assert inside(rings, *place(points, at)) == any(a < at < b for a, b in parts), (i, p, at)


def test_discs_of_very_different_sizes(spark):
    r = random.Random(5)
    lines = {i: [(r.uniform(-900, 900), r.uniform(-900, 900)) for _ in range(3)] for i in range(15)}
    discs = [(k, r.uniform(-900, 900), r.uniform(-900, 900), r.choice([0.5, 3.0, 40.0, 300.0, 0.0])) for k in range(40)]
    df = spark.createDataFrame(discs, "disc_id long, x double, y double, radius double")
    got = {}
    for x in linear.disc_intervals(segments_of(spark, lines), df, cell=16.0).collect():
        got.setdefault((x.line_id, x.disc_id), []).append((x.from_m, x.to_m))
    for i, points in lines.items():
        total = sum(math.dist(a, b) for a, b in zip(points[:-1], points[1:], strict=True))
        for k, x, y, radius in discs:
            parts = got.get((i, k), [])
            for n in range(400):
                at = (n + 0.5) * total / 400
                d = math.dist(place(points, at), (x, y))
                if abs(d - radius) > 1e-6:
                    assert (d < radius) == any(a <= at <= b for a, b in parts), (i, k, at)
    assert linear.disc_intervals(segments_of(spark, lines), df.limit(0)).count() == 0


def test_cells_along_segments_are_few_and_enough(spark):
    r = random.Random(1)
    rows = [(i, r.uniform(-500, 500), r.uniform(-500, 500), r.uniform(-500, 500), r.uniform(-500, 500)) for i in range(60)] + [(100, 5.0, -300.0, 5.0, 300.0), (101, -300.0, 7.0, 300.0, 7.0), (102, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, x1 double, y1 double, x2 double, y2 double")
    cells = {}
    for x in spatial.along_cells(df, "x1", "y1", "x2", "y2", 16.0).collect():
        cells.setdefault(x.id, set()).add((x.cx, x.cy))
    for i, x1, y1, x2, y2 in rows:
        through = {(math.floor((x1 + (x2 - x1) * t / 3000) / 16), math.floor((y1 + (y2 - y1) * t / 3000) / 16)) for t in range(3001)}
        assert through <= cells[i] and len(cells[i]) <= len(through) * 1.2 + 4


def test_through_pairs_of_hubs(spark):
    r = random.Random(9)
    rows = [(node, node * 1000 + k, float(r.randrange(0, 720, r.choice([1, 5, 45])))) for node, n in ((1, 2), (2, 3), (3, 40), (4, 1), (5, 200)) for k in range(n)]
    got = {(x.node, x.a, x.b) for x in network.through_pairs(spark.createDataFrame(rows, "node long, seg long, degrees double")).collect()}
    want = set()
    for node in {x[0] for x in rows}:
        ends = [(s, d) for n, s, d in rows if n == node]
        if len(ends) == 2:
            want.add((node, ends[0][0], ends[1][0]))
            continue
        best = {}
        for s, d in ends:
            off = lambda e: min((d - e + 180) % 360, 360 - (d - e + 180) % 360)  # noqa: E731, B023
            near = sorted((off(e), q) for q, e in ends if q != s and off(e) <= 25)
            if near:
                best[s] = near[0][1]
        want |= {(node, a, b) for a, b in best.items() if a < b and best.get(b) == a}
    assert got == want


def test_medians_of_counted_values(spark):
    r = np.random.default_rng(2)
    rows = [(f"c{r.integers(3)}", *map(int, r.integers(0, 256, 6))) for _ in range(500)]
    df = spark.createDataFrame(rows, "class string, a_r int, a_g int, a_b int, b_r int, b_g int, b_b int")
    from pavestone.functions.tags import delta_e, lab

    want = df.groupBy("class").agg(*[F.expr(f"percentile({c}, 0.5)").alias(c) for c in df.columns[1:]])
    want = want.select("class", delta_e(lab(F.col("a_r"), F.col("a_g"), F.col("a_b")), lab(F.col("b_r"), F.col("b_g"), F.col("b_b"))).alias("d"))
    got = {x["class"]: x.delta_e for x in aggregates.class_difference(df).collect()}
    assert all(abs(got[x["class"]] - x.d) < 1e-9 for x in want.collect()) and len(got) == 3
    weighted = spark.createDataFrame([("k", 5, 1.0, 1), ("k", 3, 1.0, 2), ("k", 3, 1.0, 3), ("k", 9, 0.5, 4), ("j", 1, 0.0, 5)], "key string, v int, w double, i int")
    assert {x.key: x.v for x in aggregates.weighted_median(weighted, "key", "v", "w", "i").collect()} == {"k": 3, "j": 1}


def test_simplified_lines_are_those_of_a_recursive_search(spark):
    def search(p, a, b, keep):
        best, at = -1.0, None
        for k in range(a + 1, b):
            (x1, y1), (x2, y2), (x, y) = p[a], p[b], p[k]
            size = (x2 - x1) ** 2 + (y2 - y1) ** 2
            t = min(max(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / size, 0), 1) if size else 0
            d = math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1))
            if d > best:
                best, at = d, k
        if at is not None and best > 5.0:
            keep.add(at)
            search(p, a, at, keep)
            search(p, at, b, keep)

    r = random.Random(4)
    lines = {i: [(r.uniform(0, 60), r.uniform(0, 60)) for _ in range(r.randint(2, 30))] for i in range(20)}
    df = spark.createDataFrame([(i, line(p)) for i, p in lines.items()], "line_id long, line array<struct<x:double,y:double>>").repartition(3)
    for x in G.simplify(df, 5.0).collect():
        keep = {0, len(lines[x.line_id]) - 1}
        search(lines[x.line_id], 0, len(lines[x.line_id]) - 1, keep)
        assert [(q.x, q.y) for q in x.line] == [lines[x.line_id][k] for k in sorted(keep)]


def test_hatch_at_an_angle_covers_an_area(spark):
    ring = line([(0, 0), (40, 0), (40, 30), (0, 30), (0, 0)])
    hole = line([(10, 10), (10, 20), (20, 20), (20, 10), (10, 10)])
    df = spark.createDataFrame([(1, [ring, hole])], "poly_id long, rings array<array<struct<x:double,y:double>>>")
    got = generate.hatch(df, 30.0, 0.05).collect()
    assert abs(sum(math.dist((x.x1, x.y1), (x.x2, x.y2)) for x in got) * 0.05 - 1100) < 5
    for x in got[::50]:
        mx, my = (x.x1 + x.x2) / 2, (x.y1 + x.y2) / 2
        assert 0 <= mx <= 40 and 0 <= my <= 30 and not (10 < mx < 20 and 10 < my < 20)
        assert abs(math.degrees(math.atan2(x.x2 - x.x1, x.y2 - x.y1)) % 180 - 30) < 1e-6


def test_mapped_places_replace_inferred_ones(spark):
    """A mapped bay on a tagged side: its own vehicles stand there, and none are inferred on top; a bus stop clears its own street only."""
    roads = [(1, {"highway": "residential", "parking:right": "lane", "width": "8", "name": "a"}, line([(0, 0), (200, 0)])), (2, {"highway": "residential", "parking:left": "lane", "width": "8", "name": "b"}, line([(0, -14), (200, -14)]))]
    roads = spark.createDataFrame(roads, "line_id long, tags map<string,string>, line array<struct<x:double,y:double>>")
    nodes = spark.createDataFrame([(5, {"highway": "bus_stop"}, 20.0, -4.0)], "node_id long, tags map<string,string>, x double, y double")
    bay = [(7, {"amenity": "parking", "parking": "street_side", "capacity": "4"}, line([(100, -3.5), (130, -3.5), (130, -2.0), (100, -2.0), (100, -3.5)]))]
    areas = spark.createDataFrame(bay, "area_id long, tags map<string,string>, ring array<struct<x:double,y:double>>")
    alone = parking.street_parking(roads, nodes).collect()
    both = parking.street_parking(roads, nodes, areas).collect()
    mine = [x for x in both if x.source_key.startswith("separate/way/7")]
    assert 3 <= len(mine) <= 5 and not [x for x in alone if x.source_key.startswith("separate")]
    inferred = lambda rows, road: [x for x in rows if x.source_key.startswith(f"{road}/")]
    assert [x for x in inferred(alone, 1) if 100 < x.x < 130] and not [x for x in inferred(both, 1) if 101 < x.x < 129]
    assert not [x for x in inferred(alone, 1) if 8 < x.x < 32] and [x for x in inferred(alone, 2) if 8 < x.x < 32]


def test_long_segments_stand_in_occupied_cells_only(spark):
    """A line of a million metres beside a few boxes is dealt into their cells, not into those of its length, and what it has inside is the same."""
    r = random.Random(11)
    lines = {i: [(r.uniform(-4000, 4000), r.uniform(-4000, 4000)) for _ in range(3)] for i in range(12)} | {99: [(0.0, 3.0), (1e6, 3.0)]}
    box = lambda x, y: [[(x, y), (x + 9.0, y), (x + 9.0, y + 7.0), (x, y + 7.0), (x, y)]]
    polygons = spark.createDataFrame([(k, box(r.uniform(-300, 300), r.uniform(-300, 300))) for k in range(60)] + [(70, box(5.0, 0.0)), (71, box(9000.0, 0.0))], "poly_id int, rings array<array<struct<x:double,y:double>>>")
    s = segments_of(spark, lines)
    rows = [sorted(tuple(x) for x in overlay.line_in_polygon(s, polygons, 16.0, far=far).collect()) for far in (False, True)]
    assert rows[0] == rows[1] and {x[1] for x in rows[1] if x[0] == 99} >= {70, 71}
    cells = spatial.in_cells(spark.createDataFrame([(5.0, 0.0), (9000.0, 0.0)], "x double, y double"), *[F.col(c) for c in "xyxy"], 16.0)
    assert spatial.along_cells(s.where("line_id = 99"), "x1", "y1", "x2", "y2", 16.0, spatial.occupied(cells)).count() < 20
    assert overlay.line_in_polygon(s, polygons.limit(0), 16.0, far=True).count() == 0
