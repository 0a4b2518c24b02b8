"""Geometry over Arrow batches: against plain loops, and taken once a line (F23, F34, F37, F38, F42, F43, F44)."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from pavestone.functions import geometry as G
from pavestone.functions import vectors as V

SHAPE = "id int, line array<struct<x:double,y:double>>"


def lines(n: int, most: int, span: int, seed: int) -> list[list[tuple[float, float]]]:
    r = random.Random(seed)
    return [[(float(r.randrange(span)), float(r.randrange(span))) for _ in range(r.randrange(1, most))] for _ in range(n)]


def hull(points):
    pts = sorted(set(points))
    if len(pts) < 3:
        return pts
    out = []
    for way in (pts, pts[::-1]):
        part = []
        for p in way:
            while len(part) > 1 and (part[-1][0] - part[-2][0]) * (p[1] - part[-2][1]) - (part[-1][1] - part[-2][1]) * (p[0] - part[-2][0]) <= 0:
                part.pop()
            part.append(p)
        out += part[:-1]
    return out


def at(line, d):
    for a, b in zip(line, line[1:]):
        n = math.dist(a, b)
        if d <= n:
            t = d / n if n else 0.0
            return a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t
        d -= n
    return line[-1]


def test_hulls_and_places_are_those_of_plain_loops(spark):
    # one long line whose chain falls back point by point, so that rounds do not end it
    deep = [(float(k), float(k * k)) for k in range(60)] + [(60.0, -9.0)]
    some = [*lines(300, 9, 6, 1), *lines(20, 40, 50, 2), deep]
    df = spark.createDataFrame([*((i, [dict(x=x, y=y) for x, y in l]) for i, l in enumerate(some)), (-1, None), (-2, [])], SHAPE)
    c = F.col("line")
    got = {r["id"]: r for r in df.select("id", G.convex_hull(c).alias("h"), G.interpolate_at(c, F.lit(3.5)).alias("p"), G.substring(c, F.lit(1.25), F.lit(4.0)).alias("s")).collect()}
    for i, l in enumerate(some):
        assert [tuple(p) for p in got[i]["h"]] == hull(l)
        assert tuple(got[i]["p"]) == pytest.approx(at(l, 3.5))
        far, inner = 0.0, []
        for a, b in zip(l, l[1:]):
            far += math.dist(a, b)
            inner += [b] if 1.25 < far < 4.0 else []
        want = [at(l, 1.25), *inner, at(l, 4.0)]
        assert [v for p in got[i]["s"] for v in p] == pytest.approx([v for p in want for v in p])
    assert got[-1]["h"] is None and got[-1]["p"] is None and got[-2]["h"] == [] and got[-2]["p"] is None


def test_shortest_connections_are_found_in_their_row(spark):
    a, b = lines(200, 7, 12, 3), lines(200, 7, 12, 4)
    row = lambda l: [dict(x=x, y=y) for x, y in l]
    df = spark.createDataFrame([(i, row(p), row(q)) for i, (p, q) in enumerate(zip(a, b))], f"{SHAPE.replace('id', 'k').replace('line', 'a')}, b array<struct<x:double,y:double>>")
    made = G.connectors(df, "k")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan
    got = {r["k"]: r for r in made.collect()}

    def near(p, s, e):
        n = math.dist(s, e) ** 2
        t = min(max(((p[0] - s[0]) * (e[0] - s[0]) + (p[1] - s[1]) * (e[1] - s[1])) / n, 0), 1) if n else 0
        return math.dist(p, (s[0] + (e[0] - s[0]) * t, s[1] + (e[1] - s[1]) * t))

    def cross(p, q, r, s):
        d = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
        if d == 0:
            return False
        t, u = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / d, ((r[0] - p[0]) * (q[1] - p[1]) - (r[1] - p[1]) * (q[0] - p[0])) / d
        return 0 <= t <= 1 and 0 <= u <= 1

    for i, (p, q) in enumerate(zip(a, b)):
        pairs = [(s, e, g, h) for s, e in zip(p, p[1:]) for g, h in zip(q, q[1:])]
        if not pairs:
            assert i not in got
            continue
        want = min(0.0 if cross(*x) else min(near(x[0], *x[2:]), near(x[1], *x[2:]), near(x[2], *x[:2]), near(x[3], *x[:2])) for x in pairs)
        assert got[i]["d"] == pytest.approx(want, abs=1e-12)
        assert math.dist(got[i]["p"], got[i]["q"]) == pytest.approx(want, abs=1e-9)


def test_a_filter_does_not_repeat_the_work(spark):
    df = spark.createDataFrame([(1, [dict(x=float(k % 7), y=float(k % 5)) for k in range(30)])], SHAPE)
    h = df.select(G.convex_hull(F.col("line")).alias("h"), G.oriented_envelope(F.col("line")).alias("e")).where("size(h) >= 3 and e.area > 0 and e.long > 1")
    plan = h._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython") == 1
    assert h.count() == 1


def test_stations_are_the_places_of_single_distances(spark):
    """Places along bent lines of many lengths, found together for a part, are those that `interpolate_at` finds one by one, bit by bit."""
    rows = [(i, [{"x": x, "y": y} for x, y in l], 0.5 + i % 3, 1.0 + i % 7 / 3, i % 12) for i, l in enumerate(lines(80, 6, 9, 3))] + [(900, [{"x": 1.0, "y": 2.0}], 0.0, 1.0, 2), (901, [], 0.0, 1.0, 2), (902, None, 0.0, 1.0, 2)]
    df = spark.createDataFrame(rows, "id int, line array<struct<x:double,y:double>>, first double, step double, n int").withColumn("total", G.length(F.col("line")))
    near = F.col("total") * 0.001
    got = df.select("id", F.explode(V.stations(F.col("line"), F.col("first"), F.col("step"), F.col("n"), F.col("total"), near)).alias("s")).select("id", "s.*")
    one = df.where("n > 0 and size(line) > 0").select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k")).withColumn("at", F.least(F.greatest(F.col("first") + F.col("step") * F.col("k"), F.lit(0.0)), F.col("total")))
    want = one.select("id", "k", G.interpolate_at(F.col("line"), F.col("at")).alias("base"), G.interpolate_at(F.col("line"), F.greatest(F.col("at") - near, F.lit(0.0))).alias("lo"), G.interpolate_at(F.col("line"), F.least(F.col("at") + near, F.col("total"))).alias("hi"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 200


def test_contract_makes_points_once(spark):
    from pavestone.plans import parking as P

    rows = [("a", 1.0, 2.0, "parallel", 1), ("a", None, 2.0, "parallel", 1), ("b", float("nan"), 2.0, "sideways", 0), ("a", 1.0, 1.0, None, None)]
    points = spark.createDataFrame(rows, "space_id string, x double, y double, orientation string, capacity int")
    checks = P.contract_violations(points)
    assert {r["check"]: r["n"] for r in checks.collect()} == {"coordinates": 2, "orientation": 2, "capacity": 2, "space_id": 2}
    assert {r["check"]: r["n"] for r in P.contract_violations(points.limit(0)).collect()} == {"coordinates": 0, "orientation": 0, "capacity": 0, "space_id": 0}
    assert checks._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + checks._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1


def test_written_tables_run_in_small_methods(spark):
    from pavestone import storage

    held = spark.conf.get(storage.LIMIT)
    with storage.small_methods(spark):
        assert int(spark.conf.get(storage.LIMIT)) <= 8000
    assert spark.conf.get(storage.LIMIT) == held
