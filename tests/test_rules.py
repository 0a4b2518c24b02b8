"""Fixed cases of the rules, the parking fixture, and properties of the operators."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavestone.functions import geometry as G
from pavestone.functions import tags as T
from pavestone.operators import checks, generate, linear, network
from pavestone.operators.components import connected_components
from pavestone.plans import parking
from pavestone.sources import tables


def one(spark, value, schema, expr):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_numbers_and_directions(spark):
    cases = [("4", 4.0), ("2.3 m", 2.3), ("150 cm", 1.5), ("wide road", None), ("", None), (None, None)]
    df = spark.createDataFrame(cases, "v string, want double")
    assert df.where(~T.metric_number("v").eqNullSafe(F.col("want"))).count() == 0
    cases = [("255;75", 255.0), ("E;W", 90.0), ("300-80", 10.0), ("-90", 270.0), ("NNW", 337.0), ("westnordost", None), ("45;50", None), ("x", None), (None, None)]
    df = spark.createDataFrame(cases, "v string, want double")
    assert df.where(~T.direction_degrees("v").eqNullSafe(F.col("want"))).count() == 0
    cases = [("left_of:1", 0.0), ("right_of:2", 2.0), ("middle_of:1", 0.5), ("transition", None)]
    df = spark.createDataFrame(cases, "v string, want double")
    assert df.where(~T.placement("v").eqNullSafe(F.col("want"))).count() == 0


def test_metres_needs_a_factor(spark):
    import pytest

    with pytest.raises(Exception, match="no scale factor"):
        spark.range(1).select(T.metres(F.lit(1.0), F.lit(None).cast("double"))).collect()


def bent(spark):
    return spark.sql("SELECT 1L AS line_id, array(named_struct('x', 0D, 'y', 0D), named_struct('x', 4D, 'y', 0D), named_struct('x', 4D, 'y', 4D)) AS line")


def test_tangents_on_the_bent_line(spark):
    for at, (x, y) in {3.0: (3 / math.sqrt(10), 1 / math.sqrt(10)), 0.0: (1, 0), 8.0: (0, 1)}.items():
        az = bent(spark).select(G.tangent(F.col("line"), F.lit(at), 2.0).alias("r")).first()["r"]
        assert abs(math.sin(az) - x) < 1e-9 and abs(math.cos(az) - y) < 1e-9


def test_offset_identity_pins_and_side(spark):
    rows = lambda **k: linear.offset_lines(bent(spark), **k).first()["line"]
    assert [(p.x, p.y) for p in rows(offset=F.lit(0.0))] == [(0, 0), (4, 0), (4, 4)]
    right = rows(offset=F.lit(1.0))
    assert (right[0].x, right[0].y) == (0, -1) and (right[2].x, right[2].y) == (5, 4)
    pinned = rows(offset=F.lit(1.0), pin_start=F.lit(True), pin_end=F.lit(True))
    assert (pinned[0].x, pinned[0].y, pinned[2].x, pinned[2].y) == (0, 0, 4, 4)


def test_utm_of_a_known_point(spark):
    p = spark.range(1).select(G.to_utm33(F.lit(15.0), F.lit(52.0)).alias("p")).first()["p"]
    assert abs(p.x - 500000) < 1e-6 and abs(p.y - 5761038.21) < 0.5


def test_parking_fixture_gives_three_points(spark):
    raw = [(1, {"highway": "residential", "parking:right": "lane", "parking:right:orientation": "parallel", "parking:right:capacity": "3", "width": "8"}, [(13.4, 52.4), (13.402, 52.4)]), (2, {"highway": "service", "service": "driveway"}, [(13.401, 52.3995), (13.401, 52.4005)])]
    roads = spark.createDataFrame([(i, t, [{"lon": a, "lat": b} for a, b in p]) for i, t, p in raw], "line_id long, tags map<string,string>, p array<struct<lon:double,lat:double>>")
    roads = roads.select("line_id", "tags", F.transform("p", lambda q: G.to_utm33(q["lon"], q["lat"])).alias("line"))
    nodes = spark.createDataFrame([(10, {"highway": "crossing", "crossing": "zebra"}, 13.401, 52.4), (11, {"amenity": "parking_space", "parking:orientation": "parallel"}, 13.4003, 52.4)], "node_id long, tags map<string,string>, lon double, lat double")
    nodes = nodes.withColumn("p", G.to_utm33(F.col("lon"), F.col("lat"))).select("node_id", "tags", "p.x", "p.y")
    points = parking.street_parking(roads, nodes)
    got = points.collect()
    assert len(got) == 3 and len({r.space_id for r in got}) == 3 and {r.orientation for r in got} == {"parallel"}
    assert {r.n for r in parking.contract_violations(points).collect()} == {0}


def test_side_tags(spark):
    cases = [({"parking:left": "diagonal", "parking:both": "lane", "parking:left:orientation": "perpendicular"}, "left", "no"), ({"parking:left": "no", "parking:right": "separate"}, "left", "no")]
    roads = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(cases)], "line_id long, tags map<string,string>")
    got = {(r.line_id, r.side): (r.parking, r.orientation) for r in parking.parking_sides(roads).collect()}
    assert got[(0, "left")] == ("no", "perpendicular") and got[(0, "right")] == ("lane", "parallel")
    assert got[(1, "left")] == ("no", None) and got[(1, "right")] == ("separate", None)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=25))
def test_components_do_not_depend_on_edge_order(spark, edges):
    parent = {v: v for e in edges for v in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    random.shuffle(edges)
    df = spark.createDataFrame(edges, "a int, b int")
    assert {(r.node, r.component) for r in connected_components(df).collect()} == {(v, find(v)) for v in parent}


def test_intervals_and_complement_make_the_length(spark):
    cuts = spark.createDataFrame([(1, 2.0, 5.0), (1, 4.0, 6.0), (1, 9.0, 20.0), (2, -5.0, 0.0)], "line_id long, from_m double, to_m double")
    whole = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, 3.0), (3, 0.0, 7.0)], "line_id long, from_m double, to_m double")
    got = {(r.line_id, r.from_m, r.to_m) for r in linear.subtract_intervals(whole, cuts).collect()}
    assert got == {(1, 0.0, 2.0), (1, 6.0, 9.0), (2, 0.0, 3.0), (3, 0.0, 7.0)}


def test_rings_of_edges_are_opened_at_their_smallest(spark):
    e = spark.createDataFrame([(1, "a", "b"), (2, "b", "c"), (3, "c", "a"), (5, "x", "y"), (6, "y", "z")], "edge_id long, a string, b string").withColumn("style", F.lit("s"))
    got = {(r.edge_id, r.line, r.place) for r in network.merge_lines(e, ["style"]).collect()}
    assert got == {(1, 1, 0), (2, 1, 1), (3, 1, 2), (5, 5, 0), (6, 5, 1)}


def test_marker_counts_leave_out_the_end(spark):
    df = spark.createDataFrame([(10.0, 5), (10.1, 6), (0.0, 0), (2.0, 1)], "total double, want int")
    assert df.where(generate.marker_count(F.col("total"), 2.0) != F.col("want")).count() == 0


def test_sources(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(1, 2.0, 3.0, "a"), (2, 5.0, 6.0, None)], "id long, x double, y double, source string")
    n = tables.write_geojson(df, "id", ["id", "source"], str(tmp_path / "out")).first()
    assert n.n == 2 and len(n.digest) == 64
    assert tables.replace_by_source(df, df.limit(0), ["a"]).count() == 1
    with pytest.raises(ValueError):
        tables.within_bbox(df, (3, 0, 2, 1))
    made = []
    for _ in range(2):
        tables.run_stage(spark, str(tmp_path / "ledger"), "s", "r1", lambda: made.append(1) or df, str(tmp_path / "s"))
    assert made == [1]
    assert tables.snapshot(df, str(tmp_path / "snap")).count() == 2 and tables.snapshot(df.limit(1), str(tmp_path / "snap")).count() == 2
    name, schema = tables.layer_schema("highway", "way", ["lanes", "name"], {"lanes": "integer"})
    assert name == "highway_way" and tables.empty_like(spark, schema).count() == 0
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (256).to_bytes(4, "big") + (128).to_bytes(4, "big") + b"rest"
    (tmp_path / "t.png").write_bytes(png)
    r = checks.tile_inventory(spark.read.format("binaryFile").load(str(tmp_path / "t.png"))).first()
    assert (r.kind, r.width, r.height, r.valid) == ("png", 256, 128, True)


def test_turn_arrows_go_forward_from_a_large_end_offset(spark):
    rows = [(1, 100.0, 8.0), (2, 100.0, 9.5), (3, 100.0, 40.0), (4, 20.0, 15.0)]
    got = {}
    for r in generate.turn_arrows(spark.createDataFrame(rows, "line_id int, total double, end_offset double")).collect():
        got.setdefault(r.line_id, []).append(r["at"])
    want = {}
    for i, total, off in rows:
        places = [total - off - 7.5 - 12 * k for k in range(-40, 40)]
        want[i] = sorted(p for p in places if 2.5 <= p <= total - 5)
    assert {i: sorted(v) for i, v in got.items()} == want
    assert max(got[2]) == 95.0 and max(got[3]) == 88.5
