"""Geometry expressions and derivations, each by itself."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..operators import checks as Q
from ..operators import derive as D
from ..operators import generate as E
from ..operators import linear as L
from ..operators import network as R
from ..operators import spatial as S
from ..registry import query, table
from .geometric import LINES, _ring, lines
from .spatial import _MERGED, NODE, PLACE, cuts, nodes, places


@query("g02_azimuth", f"WITH {LINES} SELECT line_id, i, round(sin(atan2(qx - ax, qy - ay)), 6) + 0.0 AS sine, round(cos(atan2(qx - ax, qy - ay)), 6) + 0.0 AS cosine FROM s WHERE d > 0")
def g02(spark, sf):
    e = lines(spark, sf).select("line_id", F.posexplode(G.segments(F.col("line"))).alias("p", "g"))
    az = G.azimuth(F.col("g.a"), F.col("g.b"))
    return e.select("line_id", (F.col("p") + 1).cast("long").alias("i"), az.alias("az")).where("az is not null").select("line_id", "i", (F.round(F.sin("az"), 6) + 0.0).alias("sine"), (F.round(F.cos("az"), 6) + 0.0).alias("cosine"))


_U = "SELECT c_custkey AS k, c_custkey % 9 + 1.0::DOUBLE AS w, c_custkey % 7 + 1.0::DOUBLE AS h FROM customer"


def _u_shapes(spark, sf):
    """U-shaped polygons: a base of 3.5 w by h, a left arm of w and a right arm of 1.5 w, each 2 h high."""
    k = F.col("c_custkey")
    w, h = k % 9 + 1, k % 7 + 1
    at = [(0, 0), (3.5, 0), (3.5, 3), (2, 3), (2, 1), (1, 1), (1, 3), (0, 3), (0, 0)]
    return table(spark, sf, "customer").select(k.alias("k"), w.alias("w"), h.alias("h"), F.array(*[G.point(w * a, h * b) for a, b in at]).alias("ring"))


@query("g07_closest_and_distance", f"WITH u AS ({_U}) SELECT k, 0.0::DOUBLE AS crossing, round(h * 1.0, 6) AS apart, round(w * 1.5, 6) AS x, round(h * 1.0, 6) AS y FROM u")
def g07(spark, sf):
    """A line through the arms crosses them; one above the arms is h apart; the closest point of the notch's floor to one above its middle lies below that."""
    w, h = F.col("w"), F.col("h")
    floor = F.array(G.point(w, h), G.point(2 * w, h))
    p = G.closest_point(floor, G.point(1.5 * w, 2 * h))
    d = _u_shapes(spark, sf)
    through = G.connectors(d.select("k", F.col("ring").alias("a"), F.array(G.point(-w, 2 * h), G.point(5 * w, 2 * h)).alias("b")), "k").select("k", F.col("d").alias("crossing"))
    above = G.connectors(d.select("k", F.col("ring").alias("a"), F.array(G.point(w * 0, h * 4), G.point(w * 4, h * 4)).alias("b")), "k").select("k", F.round("d", 6).alias("apart"))
    return d.select("k", F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y")).join(through, "k").join(above, "k")


@query("g29_label_point", f"WITH u AS ({_U}) SELECT k, round(w * 2.75, 6) AS x, round(h * 11.75 / 8.5, 6) AS y FROM u")
def g29(spark, sf):
    p = G.label_points(_u_shapes(spark, sf).select("k", F.array("ring").alias("rings")), "k")
    return p.select("k", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("g26_simplify")
def g26(spark, sf):
    """Vertices that are left of the lines within 20 of their course; held against a recursive search in the tests."""
    s = G.simplify(lines(spark, sf), 20.0)
    return s.select("line_id", F.size("line").alias("n_points"), F.round(G.length(F.col("line")), 3).alias("length"))


@query(
    "g08_tangent",
    f"""WITH {LINES}, q AS (SELECT line_id, total, greatest(total * 0.7 - 3, 0) AS lo, least(total * 0.7 + 3, total) AS hi FROM s WHERE i = 1 AND total > 0),
p AS (SELECT q.line_id, k, (SELECT struct_pack(x := ax + (qx - ax) * CASE WHEN d > 0 THEN (t - before) / d ELSE 0 END, y := ay + (qy - ay) * CASE WHEN d > 0 THEN (t - before) / d ELSE 0 END)
   FROM s WHERE s.line_id = q.line_id AND t <= before + d + 1e-12 * total ORDER BY i LIMIT 1) AS p FROM (SELECT line_id, total, unnest([1, 2]) AS k, unnest([lo, hi]) AS t FROM q) q)
SELECT a.line_id, round(sin(atan2(b.p.x - a.p.x, b.p.y - a.p.y)), 4) + 0.0 AS sine, round(cos(atan2(b.p.x - a.p.x, b.p.y - a.p.y)), 4) + 0.0 AS cosine FROM p a JOIN p b ON a.line_id = b.line_id AND a.k = 1 AND b.k = 2
WHERE pow(b.p.x - a.p.x, 2) + pow(b.p.y - a.p.y, 2) > 1e-6""",
)
def g08(spark, sf):
    c = F.col("line")
    at = lines(spark, sf).withColumn("total", G.length(c)).where("total > 0")
    lo, hi = G.interpolate_at(c, F.greatest(F.col("total") * 0.7 - 3, F.lit(0.0))), G.interpolate_at(c, F.least(F.col("total") * 0.7 + 3, F.col("total")))
    t = at.select("line_id", G.tangent(c, F.col("total") * 0.7, 3.0).alias("az"), G.distance(lo, hi).alias("apart")).where("apart * apart > 1e-6")
    return t.select("line_id", (F.round(F.sin("az"), 4) + 0.0).alias("sine"), (F.round(F.cos("az"), 4) + 0.0).alias("cosine"))


@query("g10_project", "SELECT o_orderkey AS k, round(o_orderkey % 100 + 5 * sin(radians(o_orderkey * 7 % 360)), 6) AS x, round(o_orderkey % 70 + 5 * cos(radians(o_orderkey * 7 % 360)), 6) AS y FROM orders")
def g10(spark, sf):
    k = F.col("o_orderkey")
    p = G.project(G.point(k % 100, k % 70), F.lit(5.0), F.radians(k * 7 % 360))
    return table(spark, sf, "orders").select(k.alias("k"), F.round(p["x"], 6).alias("x"), F.round(p["y"], 6).alias("y"))


@query("g11_dedupe_points", "WITH t AS (SELECT p_partkey AS k, p_partkey % 10 * 0.1::DOUBLE + 0.1 AS step FROM part) SELECT k, CAST(19 // (CAST(floor(1.05 / step) AS INTEGER) + 1) + 1 AS INTEGER) AS points FROM t")
def g11(spark, sf):
    k = F.col("p_partkey")
    line = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: G.point(i * (k % 10 * 0.1 + 0.1), F.lit(0)))
    return table(spark, sf, "part").select(k.alias("k"), F.size(G.dedupe_points(line, 1.05)).alias("points"))


@query(
    "g12_ends",
    f"WITH {LINES}, e AS (SELECT line_id, min(i) AS lo, max(i) AS hi FROM v WHERE n >= 2 GROUP BY 1) SELECT a.line_id, -1.0::DOUBLE AS first_x, z.x AS last_x, z.x AS reversed_x, CAST(a.n AS INTEGER) AS opened FROM e JOIN v a ON a.line_id = e.line_id AND a.i = lo JOIN v z ON z.line_id = e.line_id AND z.i = hi",
)
def g12(spark, sf):
    c = F.col("line")
    ends = G.set_ends(c, G.point(F.lit(-1), F.lit(-1)), F.lit(None).cast("struct<x:double,y:double>"))
    closed = F.when((G.start(c)["x"] == G.end(c)["x"]) & (G.start(c)["y"] == G.end(c)["y"]), F.concat(c, F.array(G.start(c)))).otherwise(F.concat(c, F.slice(c, 1, 1)))
    return lines(spark, sf).select("line_id", G.start(ends)["x"].alias("first_x"), G.end(ends)["x"].alias("last_x"), G.start(G.reverse(c))["x"].alias("reversed_x"), F.size(G.open_ring(closed)).alias("opened"))


@query("g14_pinned_offset", f"WITH {LINES} SELECT v.line_id, v.x AS x, v.y AS y FROM v WHERE i = 1 AND line_id IN (SELECT line_id FROM s GROUP BY 1 HAVING sum(d) >= 0.001)")
def g14(spark, sf):
    moved = L.offset_lines(lines(spark, sf), F.lit(4.0), pin_start=F.lit(True))
    return moved.select("line_id", G.start(F.col("line"))["x"].alias("x"), G.start(F.col("line"))["y"].alias("y"))


@query("g18_envelope", "SELECT c_custkey, round(sqrt(pow(c_custkey % 9 + 1, 2) + pow(2.0::DOUBLE * (c_custkey % 7 + 1), 2)), 6) AS diagonal, c_custkey * 53 % 1000 * 1.0::DOUBLE AS xmin FROM customer")
def g18(spark, sf):
    e = G.envelope(F.col("ring"))
    d = table(spark, sf, "customer").select("c_custkey", _ring().alias("ring"))
    return d.select("c_custkey", F.round(F.sqrt(F.pow(e["xmax"] - e["xmin"], 2) + F.pow(e["ymax"] - e["ymin"], 2)), 6).alias("diagonal"), e["xmin"].alias("xmin"))


@query("g20_contains", "SELECT c_custkey AS k, (c_custkey % 13 + 0.5 < 10 AND c_custkey % 11 + 0.5 < 8) AND NOT (c_custkey % 13 + 0.5 BETWEEN 2 AND 5 AND c_custkey % 11 + 0.5 BETWEEN 3 AND 6) AS inside FROM customer")
def g20(spark, sf):
    box = lambda x0, y0, x1, y1: F.array(*[G.point(F.lit(a), F.lit(b)) for a, b in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]])
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k.alias("k"), G.contains(F.array(box(0, 0, 10, 8), box(2, 3, 5, 6)), G.point(k % 13 + 0.5, k % 11 + 0.5)).alias("inside"))


@query("g23_corridor_quads", f"WITH {LINES} SELECT line_id, round(sum(d) * 3.5, 3) AS area, CAST(count(*) FILTER (d > 0) AS INTEGER) AS quads FROM s GROUP BY line_id")
def g23(spark, sf):
    q = G.corridor_quads(F.col("line"), F.lit(1.5), F.lit(2.0))
    area = F.aggregate("q", F.lit(0.0), lambda s, r: s + G.area(F.concat(r, F.slice(r, 1, 1))))
    return lines(spark, sf).select("line_id", q.alias("q")).select("line_id", F.round(area, 3).alias("area"), F.size("q").alias("quads"))


@query("g25_edge_key", "SELECT least(o_custkey, o_orderkey % 100) AS a, greatest(o_custkey, o_orderkey % 100) AS b, count(*) AS n FROM orders GROUP BY 1, 2")
def g25(spark, sf):
    k = G.edge_key(F.col("o_custkey"), F.col("o_orderkey") % 100)
    return table(spark, sf, "orders").select(k.alias("k")).groupBy(F.col("k.p").alias("a"), F.col("k.q").alias("b")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "j15_circle_pairs",
    """WITH n AS (SELECT p_partkey AS id, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, p_size % 9 + 4.0 AS r FROM part)
SELECT a.id AS l_id, b.id AS r_id FROM n a JOIN n b ON a.id <> b.id AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) < a.r + b.r""",
)
def j15(spark, sf):
    k = F.col("p_partkey")
    c = table(spark, sf, "part").select(k.alias("id"), (k * 37 % 1000).cast("double").alias("x"), (k * 91 % 1000).cast("double").alias("y"), (F.col("p_size") % 9 + 4).cast("double").alias("r"))
    return S.circle_pairs(c, 12.0).select("l_id", "r_id")


@query("w07_first_as_reference", "SELECT o_orderkey, o_orderkey * 7 % 360 - first_value(o_orderkey * 7 % 360) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS off FROM orders")
def w07(spark, sf):
    d = F.col("o_orderkey") * 7 % 360
    return table(spark, sf, "orders").select("o_orderkey", (d - F.first(d).over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))).alias("off"))


@query("w09_running_weight", "SELECT o_orderkey, CAST(sum(o_orderkey % 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM orders")
def w09(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 100).alias("w"))
    return D.running_share(o, "o_custkey", "o_orderkey", "w").select("o_orderkey", "run")


_ENDS = """e AS (SELECT c_custkey AS id, 'a' AS which, c_nationkey % 5 AS name, c_custkey * 7 % 180 AS az, c_custkey % 400 AS v FROM customer UNION ALL SELECT c_custkey, 'b', c_nationkey % 5, c_custkey * 7 % 180, c_custkey * 7 % 400 FROM customer)"""


@query(
    "a15_end_stats",
    f"""WITH {_ENDS} SELECT c.id, c.which, count(DISTINCT o.id) AS others, bool_or(o.name = c.name AND least((c.az - o.az + 180) % 180, 180 - (c.az - o.az + 180) % 180) <= 25) AS goes_on FROM e c JOIN e o ON c.v = o.v AND c.id <> o.id GROUP BY 1, 2""",
)
def a15(spark, sf):
    k = F.col("c_custkey")
    e = table(spark, sf, "customer").select(k.alias("id"), F.explode(F.array(F.struct(F.lit("a").alias("which"), (k % 400).alias("gx")), F.struct(F.lit("b").alias("which"), (k * 7 % 400).alias("gx")))).alias("e"), (F.col("c_nationkey") % 5).alias("name"), (k * 7 % 180).cast("double").alias("az"))
    return D.end_stats(e.select("id", "e.which", "name", "az", "e.gx", F.lit(0).alias("gy")))


@query(
    "f13_snap_endpoints",
    f"""WITH {NODE}, e AS (SELECT id, id // 2 AS line, id % 3 AS kind, CASE WHEN id % 4 > 0 THEN id % 2 END AS layer, size % 5 AS width, x, y FROM n),
p AS (SELECT a.id, b.id AS r, b.x AS rx, b.y AS ry, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM e a JOIN e b ON a.line <> b.line AND a.kind = b.kind AND coalesce(a.layer, 0) = coalesce(b.layer, 0) AND (b.width, b.line) < (a.width, a.line)),
m AS (SELECT id, arg_min(struct_pack(x := rx, y := ry), (d, r)) AS m FROM p WHERE d <= 25 GROUP BY id)
SELECT e.id AS l_id, coalesce(m.m.x, e.x) AS lx, coalesce(m.m.y, e.y) AS ly FROM e LEFT JOIN m USING (id)""",
)
def f13(spark, sf):
    k = F.col("l_id")
    e = nodes(spark, sf, "l").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_id"), (F.col("p_size") % 5).alias("width")), "l_id")
    e = e.select("l_id", F.floor(k / 2).alias("line"), (k % 3).alias("kind"), F.when(k % 4 > 0, k % 2).alias("layer"), "width", "lx", "ly")
    return D.snap_endpoints(e, 25.0).select("l_id", "lx", "ly")


@query(
    "f15_reattribute",
    """WITH e AS (SELECT o_orderkey AS e, o_orderkey * 7 % 11 + 1 AS len, (o_orderkey + 2) // 3 AS src, o_orderkey // 5 AS line, o_orderkey // 500 AS style FROM orders),
s AS (SELECT src, style, sum(len) AS total, count(*) AS n FROM e GROUP BY 1, 2),
h AS (SELECT line, e.style, src, count(*) AS held FROM e GROUP BY 1, 2, 3),
w AS (SELECT line, arg_min(src, (-total, src)) AS src FROM h JOIN s USING (src, style) WHERE held = n GROUP BY line),
v AS (SELECT line, style, e AS node FROM e UNION SELECT line, style, e + 1 FROM e), u AS (SELECT src, style, e AS node FROM e UNION SELECT src, style, e + 1 FROM e),
t AS (SELECT line, arg_min(src, (-total, src)) AS src FROM v JOIN u USING (style, node) JOIN s USING (src, style) WHERE line NOT IN (SELECT line FROM w) GROUP BY line)
SELECT line, src AS source_id, src * 3 % 7 AS colour, true AS whole FROM w UNION ALL SELECT line, src, src * 3 % 7, false FROM t""",
)
def f15(spark, sf):
    """Edges of long roads: sources of three edges, merged lines of five that cut some of them; gaps where keys are missing."""
    k = F.col("o_orderkey")
    src, style = F.floor((k + 2) / 3), F.floor(k / 500)
    # a source that lies in two styles is one of each
    e = table(spark, sf, "orders").select(k.alias("edge_id"), F.floor(k / 5).alias("line"), src.alias("source_id"), style.alias("style"), k.alias("a"), (k + 1).alias("b"), (k * 7 % 11 + 1).alias("len"), (src * 3 % 7).alias("colour"))
    return D.reattribute(e.select("edge_id", "line"), e.drop("line"), ["style"], ["colour"])


@query(
    "f17_spread_ends",
    """WITH d AS (SELECT c_custkey AS id, c_nationkey AS name, c_mktsegment AS hw, c_custkey % 150 AS x, c_custkey * 7 % 360 AS az, c_custkey % 5 + 1.0::DOUBLE AS off FROM customer), s AS (SELECT s_suppkey AS id, s_nationkey AS name, CASE s_suppkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'FURNITURE' END AS hw, s_suppkey * 3 % 150 AS x, s_suppkey * 11 % 360 AS az FROM supplier),
m AS (SELECT d.id, s.id AS s_id, d.name = s.name AS same, s.az, least((d.az - s.az + 360) % 360, 360 - (d.az - s.az + 360) % 360) AS a FROM d JOIN s ON d.hw = s.hw AND d.x = s.x),
t AS (SELECT id, coalesce(arg_min(az, (a, s_id)) FILTER (same), CASE WHEN count(DISTINCT s_id) = 1 THEN min(az) END) AS az FROM m GROUP BY id)
SELECT d.id AS end_id, round(CASE WHEN t.az IS NULL THEN d.x ELSE d.x - sin(radians(t.az + 90)) * off END, 6)::DOUBLE AS x, round(CASE WHEN t.az IS NULL THEN 0 ELSE -cos(radians(t.az + 90)) * off END, 6)::DOUBLE + 0.0 AS y FROM d LEFT JOIN t USING (id)""",
)
def f17(spark, sf):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    zero = F.lit(0.0)
    ends = table(spark, sf, "customer").select(k.alias("end_id"), F.col("c_nationkey").alias("name"), F.col("c_mktsegment").alias("highway"), (k % 150).cast("double").alias("x"), zero.alias("y"), (k * 7 % 360).cast("double").alias("az"), (k % 5 + 1.0).alias("left_offset"))
    kind = F.when(s % 3 == 0, "BUILDING").when(s % 3 == 1, "MACHINERY").otherwise("FURNITURE")
    singles = table(spark, sf, "supplier").select(s.alias("s_id"), F.col("s_nationkey").alias("name"), kind.alias("highway"), (s * 3 % 150).cast("double").alias("x"), zero.alias("y"), (s * 11 % 360).cast("double").alias("az"))
    return D.spread_ends(ends, singles).select("end_id", F.round("x", 6).alias("x"), (F.round("y", 6) + 0.0).alias("y"))


@query(
    "f18_link_lane_ends",
    """WITH l AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 > 0 THEN c_custkey + 1 + (c_custkey % 8 = 1)::INT END AS nxt, c_custkey % 3 AS n, c_custkey * 10.0::DOUBLE AS sx, c_custkey * 10.0::DOUBLE + 9 AS ex, c_custkey % 5 = 0 AS spread FROM customer),
o AS (SELECT l.id, l.nxt, l.n, l.sx, CASE WHEN l.spread AND b.id IS NOT NULL THEN b.sx ELSE l.ex END AS ex FROM l LEFT JOIN l b ON b.id = l.nxt),
p AS (SELECT nxt AS id, arg_min(n, id) AS pn, arg_min(ex, id) AS pex FROM o WHERE nxt IS NOT NULL GROUP BY 1),
e AS (SELECT o.id, o.nxt, CASE WHEN coalesce(o.n <= pn, false) THEN pex ELSE o.sx END AS sx, o.sx AS old, o.ex, coalesce(o.n <= pn, false) AS moved FROM o LEFT JOIN p USING (id))
SELECT e.id, e.sx, CASE WHEN NOT b.moved THEN b.old ELSE e.ex END AS ex FROM e LEFT JOIN e b ON b.id = e.nxt""",
)
def f18(spark, sf):
    """Lanes in rows; some have two lanes before them, one in five ends at a spread carriageway."""
    k = F.col("c_custkey")
    zero = F.lit(0.0)
    l = table(spark, sf, "customer").select(k.alias("id"), F.when(k % 4 > 0, k + 1 + (k % 8 == 1).cast("int")).alias("next_id"), (k % 3).alias("n"), (k * 10.0).alias("sx"), zero.alias("sy"), (k * 10.0 + 9).alias("ex"), zero.alias("ey"), (k % 5 == 0).alias("spread_exit"))
    return D.link_lane_ends(l).select("id", "sx", "ex")


@query(
    "f22_cut_by",
    f"""WITH {_MERGED}, l AS (SELECT DISTINCT line_id, line_id % 5 = 0 AS tunnel, line_id % 7 * 50 + 80.0::DOUBLE AS total FROM m), p AS (SELECT m.line_id, lag(b) OVER (PARTITION BY m.line_id ORDER BY a) AS a0, a AS b0 FROM m UNION ALL SELECT line_id, max(b), NULL FROM m GROUP BY line_id),
q AS (SELECT line_id, greatest(coalesce(a0, 0), 0) AS from_m, least(coalesce(b0, total), total) AS to_m FROM p JOIN l USING (line_id) WHERE NOT (tunnel AND total > 100))
SELECT line_id, from_m, to_m FROM q WHERE to_m > from_m""",
)
def f22(spark, sf):
    c, k = cuts(spark, sf), F.col("line_id")
    l = c.select("line_id").distinct().select("line_id", (k % 5 == 0).alias("tunnel"), (k % 7 * 50 + 80.0).alias("total"))
    return L.cut_by(l, c)


@query(
    "r09_compatible_pairs",
    f"""WITH {PLACE}, d AS (SELECT *, CASE WHEN id % 3 > 0 THEN id % 3 - 1 END AS layer, CASE WHEN id % 5 > 0 THEN id % 2 END AS pat, CASE WHEN id % 4 > 0 THEN id % 2 END AS colour FROM c)
SELECT a.id AS l_id, b.id AS r_id FROM d a JOIN d b ON a.id < b.id AND a.x <= b.x + b.w AND b.x <= a.x + a.w AND a.y <= b.y + b.h AND b.y <= a.y + a.h
WHERE coalesce(a.layer, 0) = coalesce(b.layer, 0) AND a.colour IS NOT DISTINCT FROM b.colour AND (a.pat IS NULL OR b.pat IS NULL OR a.pat = b.pat)""",
)
def r09(spark, sf):
    from .spatial import boxes

    more = lambda p: boxes(spark, sf, p).select("*", F.when(F.col(f"{p}_id") % 3 > 0, F.col(f"{p}_id") % 3 - 1).alias(f"{p}_layer"), F.when(F.col(f"{p}_id") % 5 > 0, F.col(f"{p}_id") % 2).alias(f"{p}_pattern"), F.when(F.col(f"{p}_id") % 4 > 0, F.col(f"{p}_id") % 2).alias(f"{p}_colour"))
    return R.compatible_pairs(S.box_pairs(more("l"), more("r"), 16.0).where("l_id < r_id")).select("l_id", "r_id")


# ---- generated ----


@query(
    "e03_end_offset",
    f"""WITH {NODE}, {PLACE}, b AS (SELECT id AS stop_id, x AS x1, y AS y1, x + 5 AS x2, y + 3 AS y2, id % 2 = 0 AS back FROM c), t AS (SELECT n.id, c.id AS stop_id FROM n JOIN c ON c.id = n.id % 150 + 1),
p AS (SELECT n.id, b.*, n.x, n.y, least(greatest(((n.x - x1) * 5 + (n.y - y1) * 3) / 34, 0), 1) AS u FROM n, b), d AS (SELECT p.*, sqrt(pow(x - x1 - 5 * u, 2) + pow(y - y1 - 3 * u, 2)) AS d, t.id IS NOT NULL AS touch FROM p LEFT JOIN t ON t.id = p.id AND t.stop_id = p.stop_id)
SELECT id AS line_id, arg_min(stop_id, (d, stop_id)) AS stop_id, round(arg_min(d * sign(5 * (y - y1) - 3 * (x - x1)) * CASE WHEN back THEN -1 ELSE 1 END, (d, stop_id)), 6) + 0.0 AS end_offset FROM d WHERE d <= 7.5 OR (touch AND d <= 150) GROUP BY id""",
)
def e03(spark, sf):
    ends = nodes(spark, sf, "l").select(F.col("l_id").alias("line_id"), F.col("lx").alias("x"), F.col("ly").alias("y"))
    k = F.col("r_id")
    stops = places(spark, sf, "r").select(k.alias("stop_id"), F.col("rx").alias("x1"), F.col("ry").alias("y1"), (F.col("rx") + 5).alias("x2"), (F.col("ry") + 3).alias("y2"), (k % 2 == 0).alias("backward"))
    touching = ends.select("line_id", (F.col("line_id") % 150 + 1).alias("stop_id"))
    return D.end_offset(ends, stops, touching, 7.5, 150.0).select("line_id", "stop_id", (F.round("end_offset", 6) + 0.0).alias("end_offset"))


@query(
    "e04_line_to_symbol",
    f"""WITH {LINES}, q AS (SELECT line_id, total FROM s WHERE i = 1 AND total > 0.01),
p AS (SELECT q.line_id, (SELECT struct_pack(x := ax + (qx - ax) * CASE WHEN d > 0 THEN (total * 0.5 - before) / d ELSE 0 END, y := ay + (qy - ay) * CASE WHEN d > 0 THEN (total * 0.5 - before) / d ELSE 0 END)
   FROM s WHERE s.line_id = q.line_id AND q.total * 0.5 <= before + d + 1e-12 * total ORDER BY i LIMIT 1) AS p, total FROM q)
SELECT line_id, round(p.x, 3) AS x, round(p.y, 3) AS y, CASE WHEN line_id % 3 = 0 THEN 90.0 END::DOUBLE AS direction, CASE WHEN line_id % 2 = 0 THEN 5.0 ELSE round(total, 1) END::DOUBLE AS length FROM p""",
)
def e04(spark, sf):
    k = F.col("line_id")
    l = lines(spark, sf).select("line_id", "line", F.when(k % 3 == 0, 90.0).alias("direction"), F.when(k % 2 == 0, 5.0).alias("length"))
    return D.line_to_symbol(l).select("line_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.when(k % 3 == 0, F.col("direction")).alias("direction"), "length")


@query(
    "e06_hatch",
    """WITH b AS (SELECT c_custkey AS id, c_custkey * 53 % 1000 AS x0, c_custkey % 9 + 1 AS w, c_custkey % 7 + 1.0::DOUBLE AS h FROM customer)
SELECT id AS poly_id, CAST(ceil((x0 + w) / 0.75) - ceil(x0 / 0.75) AS BIGINT) AS n, round((ceil((x0 + w) / 0.75) - ceil(x0 / 0.75)) * h, 6) AS length FROM b WHERE ceil((x0 + w) / 0.75) > ceil(x0 / 0.75)""",
)
def e06(spark, sf):
    from .spatial import boxes, rings

    h = E.hatch(rings(boxes(spark, sf, "l"), "l").withColumnRenamed("l_id", "poly_id"), 0.0, 0.75)
    return h.groupBy("poly_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.abs(F.col("y2") - F.col("y1"))), 6).alias("length"))


@query(
    "e14_to_node",
    f"""WITH {NODE}, {PLACE} SELECT c.id, round(x + w / 2, 6) AS x, round(y + h / 2, 6) AS y FROM c WHERE w * h < 30 AND NOT EXISTS (SELECT 1 FROM n WHERE n.x + 0.5 BETWEEN c.x AND c.x + c.w AND n.y + 0.5 BETWEEN c.y AND c.y + c.h)""",
)
def e14(spark, sf):
    from .spatial import boxes, rings

    p = rings(boxes(spark, sf, "l"), "l").select("l_id", F.col("rings")[0].alias("ring"))
    n = nodes(spark, sf, "r").select("r_id", (F.col("rx") + 0.5).alias("rx"), (F.col("ry") + 0.5).alias("ry"))
    return D.to_node(p, n, 30.0).select(F.col("l_id").alias("id"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "e17_sign_direction",
    f"""WITH {LINES}, g AS (SELECT p_partkey AS id, p_partkey AS x, s_suppkey AS y, CASE p_partkey % 3 WHEN 0 THEN 'forward' WHEN 1 THEN 'backward' END AS dir FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier) + 1),
u AS (SELECT line_id, i, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM (SELECT line_id, i, x, y FROM v WHERE n >= 2 QUALIFY lag(x) OVER (PARTITION BY line_id ORDER BY i) IS DISTINCT FROM x OR lag(y) OVER (PARTITION BY line_id ORDER BY i) IS DISTINCT FROM y) WINDOW w AS (PARTITION BY line_id ORDER BY i)),
m AS (SELECT g.id, line_id, i, CASE WHEN dir IS DISTINCT FROM 'backward' AND nx IS NOT NULL THEN degrees(atan2(nx - u.x, ny - u.y)) ELSE degrees(atan2(u.x - px, u.y - py)) END AS a, dir FROM g JOIN u ON g.x = u.x AND g.y = u.y WHERE px IS NOT NULL)
SELECT id AS sign_id, arg_min((round((a + 360) % 360) + CASE WHEN dir IS DISTINCT FROM 'backward' THEN 180 ELSE 0 END) % 360, (line_id, i)) AS degrees FROM m GROUP BY id""",
)
def e17(spark, sf):
    k = F.col("p_partkey")
    n = table(spark, sf, "supplier").count()
    signs = table(spark, sf, "part").select(k.alias("sign_id"), k.cast("double").alias("x"), (k % n + 1).cast("double").alias("y"), F.when(k % 3 == 0, "forward").when(k % 3 == 1, "backward").alias("direction"))
    return D.sign_direction(signs, L.vertices(lines(spark, sf)))


@query(
    "e39_snap_to_lane",
    f"""WITH {NODE}, {PLACE}, p AS (SELECT n.id AS l_id, c.id AS r_id, sqrt(pow(n.x - c.x, 2) + pow(n.y - c.y, 2)) AS d FROM n JOIN c ON abs(n.x - c.x) <= 30 AND abs(n.y - c.y) <= 30),
a AS (SELECT l_id, r_id FROM p WHERE d <= 30 AND r_id % 4 = 1 QUALIFY row_number() OVER (PARTITION BY l_id ORDER BY d, r_id) = 1), b AS (SELECT l_id, r_id FROM p WHERE d <= 30 AND r_id % 4 = 2 AND l_id NOT IN (SELECT l_id FROM a) QUALIFY row_number() OVER (PARTITION BY l_id ORDER BY d, r_id) = 1)
SELECT l_id, r_id, 1 AS step FROM a UNION ALL SELECT l_id, r_id, 2 FROM b""",
)
def e39(spark, sf):
    c = places(spark, sf, "r")
    return D.snap_to_lane(nodes(spark, sf, "l"), c.where("r_id % 4 = 1"), c.where("r_id % 4 = 2"), 30.0)


@query("q07_tile_inventory", "SELECT p_partkey % 4 AS zoom, count(*) AS tiles, count(*) FILTER (p_partkey % 5 > 0) AS valid, CAST(max(CASE WHEN p_partkey % 5 > 0 THEN 256 + p_partkey % 3 END) AS BIGINT) AS widest FROM part GROUP BY 1")
def q07(spark, sf):
    """Image headers as a tile tree would hold them: one in five is cut short."""
    k = F.col("p_partkey")
    be = lambda n: F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0"))
    png = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), be(256 + k % 3), be(F.lit(256)), F.unhex(F.lit("00")))
    # a JPEG with an application segment, a table and, for some, fill bytes before its frame header
    be2 = lambda n: F.unhex(F.lpad(F.hex(n.cast("long")), 4, "0"))
    jpeg = F.concat(F.unhex(F.lit("FFD8FFE000064A464946FFC400040000")), F.when(k % 7 == 0, F.unhex(F.lit("FFFF"))).otherwise(F.unhex(F.lit(""))), F.when(k % 3 == 0, F.unhex(F.lit("FFC2"))).otherwise(F.unhex(F.lit("FFC0"))), F.unhex(F.lit("001108")), be2(F.lit(256)), be2(256 + k % 3), F.unhex(F.lit("03011100021101031101")))
    image = F.when(k % 2 == 0, png).otherwise(jpeg)
    content = F.when(k % 5 > 0, image).otherwise(F.substring(image, 1, 6 + k % 3))
    tiles = table(spark, sf, "part").select(F.concat(F.lit("/tiles/"), (k % 4).cast("string"), F.lit("/"), k.cast("string"), F.lit("/1.png")).alias("path"), F.octet_length(content).cast("long").alias("length"), content.alias("content"))
    t = Q.tile_inventory(tiles)
    zoom = F.regexp_extract("path", r"/tiles/(\d+)/", 1).cast("long")
    return t.groupBy(zoom.alias("zoom")).agg(F.count(F.lit(1)).alias("tiles"), F.count_if(F.coalesce("valid", F.lit(False))).alias("valid"), F.max(F.when(F.col("valid"), F.col("width"))).cast("long").alias("widest"))
