"""Nearest points at any distance, hubs, image headers and merged lines against brute force and on odd tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pavestone.operators import checks, derive, network, spatial

L, R = "l_id long, lx double, ly double", "r_id long, rx double, ry double"


def points(n, seed, spread):
    r = random.Random(seed)
    out = []
    for i in range(n):
        near = r.random() < 0.7
        out.append((i, r.gauss(0, 0.5) if near else r.uniform(-spread, spread), r.gauss(0, 0.5) if near else r.uniform(-spread, spread)))
    return out


@pytest.mark.parametrize("spread", [3.0, 1e7])
def test_nearest(spark, spread):
    left, right = points(120, 1, spread), points(700, 2, spread / 100)
    right += [(900 + i, *right[i][1:]) for i in range(20)] + [(2000 + i, 50.0, 50.0) for i in range(200)]
    left += [(500, 50.0, 50.0), (501, *right[3][1:])]
    got = {r.l_id: (r.d, r.r_id) for r in spatial.nearest(spark.createDataFrame(left, L), spark.createDataFrame(right, R)).collect()}
    for i, x, y in left:
        d, k = min((math.hypot(x - rx, y - ry), r) for r, rx, ry in right)
        assert got[i][0] == pytest.approx(d, rel=1e-12) and got[i][1] == k


def test_nearest_of_few(spark):
    one = spark.createDataFrame([(7, 1.0, 1.0)], R)
    got = spatial.nearest(spark.createDataFrame([(1, 1e9, -1e9), (2, 1.0, 1.0)], L), one).collect()
    assert sorted((r.l_id, r.r_id) for r in got) == [(1, 7), (2, 7)]
    assert spatial.nearest(spark.createDataFrame([(1, 0.0, 0.0)], L), spark.createDataFrame([], R)).count() == 0
    assert spatial.nearest(spark.createDataFrame([], L), one).count() == 0


def test_pairs_grow_with_the_points(spark):
    """Candidate cells of a question do not depend on how dense the cluster is that it lies far from."""
    r = random.Random(3)
    asked = []
    for n in (1000, 8000):
        right = spark.createDataFrame([(i, r.gauss(0, 1), r.gauss(0, 1)) for i in range(n)], "x long, rx double, ry double").select(F.col("x").alias("r_id"), "rx", "ry")
        cells, placed = spatial._tree(right.select(F.col("rx").alias("x"), F.col("ry").alias("y"), F.struct("r_id").alias("r")))
        leaves = placed.groupBy("level", "cx", "cy").count()
        assert leaves.agg(F.max("count")).first()[0] <= spatial.LEAF and placed.count() == n
        asked.append(leaves.count() / n)
    assert asked[1] < 2 * asked[0]


def test_hub(spark):
    r = random.Random(5)
    ends = [(i, w, r.choice(["a", "b", None]), r.choice([0.0, 5.0, 89.0, 90.0, 178.0, 179.5, r.uniform(0, 360)]), r.choice([0, 0, 0, 1, 2]), 0) for i in range(60) for w in "ab"]
    got = {(x.id, x.which): (x.others, x.goes_on) for x in derive.end_stats(spark.createDataFrame(ends, "id long, which string, name string, az double, gx long, gy long"), 25.0).collect()}
    off = lambda a, b: min((a - b) % 180, 180 - (a - b) % 180)
    want = {}
    for i, w, name, az, gx, _ in ends:
        there = [e for e in ends if e[4] == gx and e[0] != i]
        if there:
            want[i, w] = (len({e[0] for e in there}), any(e[2] == name and name is not None and off(e[3], az) <= 25 for e in there))
    assert got == want


def jpeg(width, height, *before):
    head = b"\xff\xd8" + b"".join(before)
    return head + b"\xff\xc0\x00\x11\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + b"\x03" + bytes(9) + b"\xff\xda\x00\x02\x01\xff\xd9"


def test_image_headers(spark):
    app, table = b"\xff\xe0\x00\x06\xff\xc0\x00\x00", b"\xff\xc4\x00\x04\x00\x00"
    png = b"\x89PNG\r\n\x1a\n" + b"\x00\x00\x00\rIHDR" + (256).to_bytes(4, "big") * 2
    whole = jpeg(256, 256, app, table, b"\xff\xff\xff\xfe\x00\x02")
    files = {"a.jpg": whole, "b.jpg": jpeg(300, 200), "c.jpg": whole[:20], "d.jpg": b"\xff\xd8", "e.jpg": b"\xff\xd8\xff\xd9", "f.png": png, "g.png": png[:23], "h.png": b"", "i.txt": b"text", "j.jpg": b"\xff\xd8\x00\x00\x00\x00", "k.jpg": None}
    rows = [(k, len(v or b""), v) for k, v in files.items()]
    got = {r.path: (r.kind, r.width, r.height, r.valid) for r in checks.tile_inventory(spark.createDataFrame(rows, "path string, length long, content binary"), 256).collect()}
    assert got["a.jpg"] == ("jpeg", 256, 256, True) and got["b.jpg"] == ("jpeg", 300, 200, False) and got["f.png"] == ("png", 256, 256, True)
    assert all(got[k][1:] == (None, None, False) for k in ("c.jpg", "d.jpg", "e.jpg", "g.png", "h.png", "i.txt", "j.jpg", "k.jpg"))
    assert len(got) == len(files)


def test_undirected_lines_and_rings(spark):
    # a chain drawn both ways, a fork that parts lines, a ring, a loop
    edges = [(1, "g", "a", "b"), (2, "g", "c", "b"), (3, "g", "c", "d"), (4, "g", "d", "e"), (5, "g", "d", "f"), (6, "h", "p", "q"), (7, "h", "r", "q"), (8, "h", "r", "p"), (9, "i", "z", "z")]
    got = {r.edge_id: (r.line, r.place, r.reversed) for r in network.merge_undirected(spark.createDataFrame(edges, "edge_id long, grp string, a string, b string"), "grp").collect()}
    assert [got[k] for k in (1, 2, 3)] == [(1, 0, False), (1, 1, True), (1, 2, False)]
    assert got[4] == (4, 0, False) and got[5] == (5, 0, False) and got[9] == (9, 0, False)
    assert {got[k][0] for k in (6, 7, 8)} == {6} and sorted(got[k][1] for k in (6, 7, 8)) == [0, 1, 2]
