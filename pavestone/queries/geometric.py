"""Geometry over lines derived from lineitem: one line per order, vertices (l_partkey, l_suppkey)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import linear as L
from ..registry import query, table


def lines(spark, sf) -> DataFrame:
    """(line_id, line) of the orders with at least two vertices."""
    v = F.struct(F.col("l_linenumber").cast("long").alias("n"), F.col("l_partkey").cast("long").alias("p"), F.col("l_suppkey").cast("long").alias("s"))
    per = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("line_id")).agg(F.array_sort(F.collect_list(v)).alias("v")).where(F.size("v") >= 2)
    return per.select("line_id", F.transform("v", lambda p: G.point(p["p"], p["s"])).alias("line"))


#: The same lines in SQL: v (line_id, i, x, y) and s (consecutive pairs with length and distance before).
LINES = """
v AS (SELECT l_orderkey AS line_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, CAST(l_partkey AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y,
  count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
s0 AS (SELECT line_id, i, n, x AS ax, y AS ay, lead(x) OVER w AS qx, lead(y) OVER w AS qy FROM v WHERE n >= 2 WINDOW w AS (PARTITION BY line_id ORDER BY i)),
s1 AS (SELECT *, sqrt((qx - ax) * (qx - ax) + (qy - ay) * (qy - ay)) AS d FROM s0 WHERE qx IS NOT NULL),
s AS (SELECT *, coalesce(sum(d) OVER (PARTITION BY line_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(d) OVER (PARTITION BY line_id) AS total FROM s1)"""


@query(
    "g01_line_metrics",
    f"""WITH {LINES}
SELECT s.line_id, CAST(max(s.n) AS INTEGER) AS n_points, round(sum(s.d), 4) AS length, any_value(a.x) AS start_x, any_value(z.y) AS end_y,
  round(any_value(CASE WHEN a.x <> z.x OR a.y <> z.y THEN (degrees(atan2(z.x - a.x, z.y - a.y)) + 360) % 360 END), 6) AS azimuth
FROM s JOIN v a ON a.line_id = s.line_id AND a.i = 1 JOIN v z ON z.line_id = s.line_id AND z.i = z.n GROUP BY s.line_id""",
)
def g01(spark, sf):
    c = F.col("line")
    return lines(spark, sf).select("line_id", G.n_points(c).alias("n_points"), F.round(G.length(c), 4).alias("length"), G.start(c)["x"].alias("start_x"), G.end(c)["y"].alias("end_y"), F.round(F.degrees(G.azimuth(G.start(c), G.end(c))), 6).alias("azimuth"))


@query(
    "g03_angle_difference",
    """SELECT o_orderkey, least((o_orderkey * 7 % 360 - o_orderkey * 11 % 360 + 360) % 360, 360 - (o_orderkey * 7 % 360 - o_orderkey * 11 % 360 + 360) % 360)::DOUBLE AS directed,
  least((o_orderkey * 7 % 360 - o_orderkey * 11 % 360 + 360) % 180, 180 - (o_orderkey * 7 % 360 - o_orderkey * 11 % 360 + 360) % 180)::DOUBLE AS undirected FROM orders""",
)
def g03(spark, sf):
    k = F.col("o_orderkey")
    a, b = (k * 7 % 360).cast("double"), (k * 11 % 360).cast("double")
    return table(spark, sf, "orders").select(k, G.angle_difference(a, b).alias("directed"), G.angle_difference_undirected(a, b).alias("undirected"))


@query(
    "g04_place_along",
    f"""WITH {LINES}, q AS (SELECT line_id, total, total * 0.4 AS d, greatest(total * 0.4 - 2, 0) AS lo, least(total * 0.4 + 2, total) AS hi FROM s WHERE i = 1 AND total > 0),
p AS (SELECT q.line_id, k, (SELECT struct_pack(x := ax + (qx - ax) * CASE WHEN d > 0 THEN (t - before) / d ELSE 0 END, y := ay + (qy - ay) * CASE WHEN d > 0 THEN (t - before) / d ELSE 0 END)
   FROM s WHERE s.line_id = q.line_id AND t <= before + d + 1e-12 * total ORDER BY i LIMIT 1) AS p
   FROM (SELECT line_id, total, unnest([1, 2, 3]) AS k, unnest([d, lo, hi]) AS t FROM q) q)
SELECT a.line_id, round(a.p.x, 4) AS x, round(a.p.y, 4) AS y, round(atan2(c.p.x - b.p.x, c.p.y - b.p.y) , 3) AS tangent
FROM p a JOIN p b ON a.line_id = b.line_id AND a.k = 1 AND b.k = 2 JOIN p c ON c.line_id = a.line_id AND c.k = 3""",
)
def g04(spark, sf):
    c = F.col("line")
    at = lines(spark, sf).withColumn("total", G.length(c)).where("total > 0")
    d = F.col("total") * 0.4
    p, lo, hi = G.interpolate_at(c, d), G.interpolate_at(c, F.greatest(d - 2, F.lit(0.0))), G.interpolate_at(c, F.least(d + 2, F.col("total")))
    return at.select("line_id", p.alias("p"), lo.alias("lo"), hi.alias("hi")).select("line_id", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"), F.round(F.atan2(F.col("hi.x") - F.col("lo.x"), F.col("hi.y") - F.col("lo.y")), 3).alias("tangent"))


@query(
    "g05_locate",
    f"""WITH {LINES}, q AS (SELECT *, line_id % 2000 * 1.0 AS px, line_id % 97 * 1.0 AS py FROM s),
t AS (SELECT *, CASE WHEN d > 0 THEN least(greatest(((px - ax) * (qx - ax) + (py - ay) * (qy - ay)) / (d * d), 0), 1) ELSE 0 END AS t FROM q),
e AS (SELECT *, sqrt(pow(ax + (qx - ax) * t - px, 2) + pow(ay + (qy - ay) * t - py, 2)) AS dist FROM t)
SELECT line_id, round(min(dist), 4) AS distance FROM e GROUP BY line_id""",
)
def g05(spark, sf):
    p = G.point(F.col("line_id") % 2000, F.col("line_id") % 97)
    return lines(spark, sf).select("line_id", F.round(G.locate(F.col("line"), p)["d"], 4).alias("distance"))


@query("g06_substring", f"WITH {LINES} SELECT line_id, round(max(total) * 0.5, 3) AS length FROM s GROUP BY line_id")
def g06(spark, sf):
    c = F.col("line")
    cut = G.substring(c, F.col("total") * 0.25, F.col("total") * 0.75)
    return lines(spark, sf).withColumn("total", G.length(c)).select("line_id", F.round(G.length(cut), 3).alias("length"))


@query(
    "g09_extend",
    f"WITH {LINES} SELECT line_id, round(max(total) + 7, 3) AS length FROM s GROUP BY line_id HAVING min(CASE WHEN i = 1 OR i = n - 1 THEN d END) > 0",
)
def g09(spark, sf):
    c = F.col("line")
    ok = (G.distance(G.start(c), F.try_element_at(c, F.lit(2))) > 0) & (G.distance(G.end(c), F.try_element_at(c, F.lit(-2))) > 0)
    return lines(spark, sf).where(ok).select("line_id", F.round(G.length(G.extend(c, 3.0, 4.0)), 3).alias("length"))


@query(
    "g13_line_offset",
    f"""WITH {LINES}, o AS (SELECT line_id, i, ax, ay, (qx - ax) / d AS ux, (qy - ay) / d AS uy, qx, qy, n, d FROM s WHERE line_id NOT IN (SELECT line_id FROM s WHERE d = 0)),
w AS (SELECT v.line_id, v.i, v.x, v.y, v.n, b.ux AS bux, b.uy AS buy, a.ux AS aux, a.uy AS auy FROM v JOIN (SELECT DISTINCT line_id FROM o) USING (line_id)
  LEFT JOIN o a ON a.line_id = v.line_id AND a.i = v.i LEFT JOIN o b ON b.line_id = v.line_id AND b.i = v.i - 1),
n AS (SELECT *, coalesce(bux, 0) + coalesce(aux, 0) AS sx, coalesce(buy, 0) + coalesce(auy, 0) AS sy FROM w),
m AS (SELECT *, sqrt(sx * sx + sy * sy) AS l FROM n),
r AS (SELECT line_id, x + 2.5 * CASE WHEN l < 1e-12 THEN auy ELSE sy / l END AS x, y - 2.5 * CASE WHEN l < 1e-12 THEN aux ELSE sx / l END AS y FROM m)
SELECT line_id, round(sum(x), 3) AS sum_x, round(sum(y), 3) AS sum_y FROM r GROUP BY line_id""",
)
def g13(spark, sf):
    c = F.col("line")
    simple = ~F.exists(G.segments(c), lambda g: G.distance(g["a"], g["b"]) == 0)
    moved = L.offset_lines(lines(spark, sf).where(simple), F.lit(2.5)).select("line_id", F.explode("line").alias("p"))
    return moved.groupBy("line_id").agg(F.round(F.sum("p.x"), 3).alias("sum_x"), F.round(F.sum("p.y"), 3).alias("sum_y"))


@query(
    "g15_edge_keys",
    f"""WITH {LINES} SELECT least(ax, qx) AS x1, greatest(ax, qx) AS x2, count(*) AS n, count(DISTINCT line_id) AS n_lines FROM s WHERE ax <> qx GROUP BY 1, 2 HAVING count(*) > 1""",
)
def g15(spark, sf):
    e = lines(spark, sf).select("line_id", F.explode(G.segments(F.col("line"))).alias("g")).where("g.a.x <> g.b.x")
    k = G.edge_key(F.col("g.a"), F.col("g.b"))
    return e.select("line_id", k["p"]["x"].alias("x1"), k["q"]["x"].alias("x2")).groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("line_id").alias("n_lines")).where("n > 1")


@query(
    "g16_snap_and_clean",
    f"""WITH {LINES}, g AS (SELECT line_id, i, round(x / 10) * 10 AS x, round(y / 10) * 10 AS y FROM v WHERE n >= 2),
k AS (SELECT line_id, lag(x) OVER w IS NOT DISTINCT FROM x AND lag(y) OVER w IS NOT DISTINCT FROM y AS same, x FROM g WINDOW w AS (PARTITION BY line_id ORDER BY i))
SELECT line_id, CAST(count(*) FILTER (NOT same) AS INTEGER) AS n_points, sum(x) FILTER (NOT same) AS sum_x FROM k GROUP BY line_id""",
)
def g16(spark, sf):
    snapped = G.dedupe_points(F.transform("line", lambda p: G.snap_grid(p, 10.0)))
    return lines(spark, sf).select("line_id", snapped.alias("line")).select("line_id", F.size("line").alias("n_points"), F.aggregate("line", F.lit(0.0), lambda s, p: s + p["x"]).alias("sum_x"))


def _ring():
    """A pentagon from a customer's key; convex, counter-clockwise, closed."""
    k = F.col("c_custkey")
    x, y, w, h = k * 53 % 1000, k * 29 % 1000, k % 9 + 1, k % 7 + 1
    at = [(x, y), (x + w, y), (x + w, y + h), (x + w / 2, y + 2 * h), (x, y + h), (x, y)]
    return F.array(*[G.point(a, b) for a, b in at])


@query(
    "g17_rings",
    """WITH r AS (SELECT c_custkey AS k, c_custkey * 53 % 1000 AS x, c_custkey * 29 % 1000 AS y, c_custkey % 9 + 1 AS w, c_custkey % 7 + 1 AS h FROM customer)
SELECT k AS c_custkey, w * h * 1.5::DOUBLE AS area, round(x + w / 2.0::DOUBLE, 6) AS cx, round(y + (w * h * (h / 2.0::DOUBLE) + w * h / 2.0::DOUBLE * (h + h / 3.0::DOUBLE)) / (1.5::DOUBLE * w * h), 6) AS cy, x + w * 1.0::DOUBLE AS xmax, y + 2.0::DOUBLE * h AS ymax, TRUE AS ccw,
 TRUE AS inside, FALSE AS outside FROM r""",
)
def g17(spark, sf):
    r = F.col("ring")
    c, e = G.centroid(r), G.envelope(r)
    d = table(spark, sf, "customer").select("c_custkey", _ring().alias("ring"))
    inside, outside = G.point(e["xmin"] + 0.31, e["ymin"] + 0.17), G.point(e["xmin"] + 0.01, e["ymax"] - 0.01)
    return d.select("c_custkey", G.area(r).alias("area"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"), e["xmax"].alias("xmax"), e["ymax"].alias("ymax"), (G.signed_area(G.force_ccw(F.reverse(r))) > 0).alias("ccw"), G.contains(F.array(r), inside).alias("inside"), G.contains(F.array(r), outside).alias("outside"))


@query(
    "g19_oriented_envelope",
    """WITH r AS (SELECT c_custkey AS k, c_custkey % 9 + 2 AS a, c_custkey % 7 + 1 AS b FROM customer)
SELECT k AS c_custkey, round(5.0::DOUBLE * greatest(a, b), 6) AS long, round(5.0::DOUBLE * least(a, b), 6) AS short,
  round(CASE WHEN a >= b THEN degrees(atan2(4.0, 3.0)) ELSE degrees(atan2(-3.0, 4.0)) + 180 END, 6) AS azimuth FROM r WHERE a <> b""",
)
def g19(spark, sf):
    k = F.col("c_custkey")
    a, b = k % 9 + 2, k % 7 + 1
    # a rectangle of 5a qy 5b turned along (4, 3)
    at = [(F.lit(0), F.lit(0)), (4 * a, 3 * a), (4 * a - 3 * b, 3 * a + 4 * b), (-3 * b, 4 * b), (F.lit(0), F.lit(0))]
    e = G.oriented_envelope(F.array(*[G.point(x, y) for x, y in at]))
    return table(spark, sf, "customer").where(a != b).select(k, e.alias("e")).select(k, F.round("e.long", 6).alias("long"), F.round("e.short", 6).alias("short"), F.round("e.azimuth", 6).alias("azimuth"))


@query(
    "g21_side_of",
    f"""WITH {LINES} SELECT line_id, i, CAST(sign((qx - ax) * (50 - ay) - (qy - ay) * (900 - ax)) AS INTEGER) AS side FROM s""",
)
def g21(spark, sf):
    e = lines(spark, sf).select("line_id", F.posexplode(G.segments(F.col("line"))).alias("p", "g"))
    return e.select("line_id", (F.col("p") + 1).cast("long").alias("i"), G.side_of(G.point(F.lit(900), F.lit(50)), F.col("g.a"), F.col("g.b")).alias("side"))


@query(
    "g22_convex_hull",
    f"""WITH {LINES}, p AS (SELECT DISTINCT line_id, x, y FROM v WHERE n >= 3),
q AS (SELECT a.line_id, a.x, a.y, b.x AS qx, b.y AS qy FROM p a JOIN p b ON a.line_id = b.line_id AND (a.x, a.y) <> (b.x, b.y)),
e AS (SELECT q.line_id, q.x, q.y, q.qx, q.qy FROM q JOIN p c ON c.line_id = q.line_id GROUP BY ALL
  HAVING min((q.qx - q.x) * (c.y - q.y) - (q.qy - q.y) * (c.x - q.x)) >= 0 AND max((q.qx - q.x) * (c.y - q.y) - (q.qy - q.y) * (c.x - q.x)) > 0
   AND bool_and((q.qx - q.x) * (c.y - q.y) - (q.qy - q.y) * (c.x - q.x) <> 0 OR (c.x - q.x) * (c.x - q.qx) + (c.y - q.y) * (c.y - q.qy) <= 0))
SELECT line_id, round(sum(x * qy - qx * y) / 2, 4) AS area, CAST(count(*) AS INTEGER) AS corners FROM e GROUP BY line_id""",
)
def g22(spark, sf):
    c = lines(spark, sf).where(F.size("line") >= 3).select("line_id", G.convex_hull(F.col("line")).alias("h")).where(F.size("h") >= 3)
    closed = F.concat("h", F.slice("h", 1, 1))
    return c.select("line_id", F.round(G.signed_area(closed), 4).alias("area"), F.size("h").alias("corners")).where("area > 0")


@query(
    "g24_lens_area",
    """WITH c AS (SELECT p_partkey, p_size % 5 + 1.0::DOUBLE AS r, p_partkey % 4 + 1.0::DOUBLE AS q, p_partkey % 9 + 0.5::DOUBLE AS d FROM part),
a AS (SELECT *, least(greatest((d*d + r*r - q*q) / (2*d*r), -1), 1) AS u, least(greatest((d*d + q*q - r*r) / (2*d*q), -1), 1) AS w FROM c)
SELECT p_partkey, round(CASE WHEN d >= r + q THEN 0 WHEN d <= abs(r - q) THEN pi() * least(r, q) * least(r, q) ELSE r*r*acos(u) + q*q*acos(w) - 0.5 * sqrt((-d+r+q)*(d+r-q)*(d-r+q)*(d+r+q)) END, 6) AS area FROM a""",
)
def g24(spark, sf):
    r, q, d = (F.col("p_size") % 5 + 1).cast("double"), (F.col("p_partkey") % 4 + 1).cast("double"), F.col("p_partkey") % 9 + 0.5
    return table(spark, sf, "part").select("p_partkey", F.round(G.lens_area(r, q, d), 6).alias("area"))


@query(
    "g27_reproject",
    """SELECT c_custkey, round(radians(c_custkey % 120 - 60) * 6378137.0::DOUBLE, 3) AS x, round(ln(tan(pi() / 4 + radians(c_custkey % 100 - 50) / 2)) * 6378137.0::DOUBLE, 3) + 0.0 AS y,
  c_custkey % 120 - 60.0::DOUBLE AS lon, c_custkey % 100 - 50.0::DOUBLE AS lat, TRUE AS utm_returns FROM customer""",
)
def g27(spark, sf):
    k = F.col("c_custkey")
    lon, lat = (k % 120 - 60).cast("double"), (k % 100 - 50).cast("double")
    m = G.to_mercator(lon, lat)
    back = G.from_mercator(m)
    near, up = 12 + (k % 60) / 10.0, 45 + (k % 100) / 10.0
    again = G.from_utm33(G.to_utm33(near, up))
    close = (F.abs(again["x"] - near) < 1e-8) & (F.abs(again["y"] - up) < 1e-8)
    return table(spark, sf, "customer").select(k, F.round(m["x"], 3).alias("x"), F.round(m["y"], 3).alias("y"), F.round(back["x"], 6).alias("lon"), F.round(back["y"], 6).alias("lat"), close.alias("utm_returns"))


@query(
    "g28_geodesic_area",
    """SELECT c_custkey, round(6371007.181::DOUBLE * 6371007.181::DOUBLE * radians(0.01::DOUBLE) * (sin(radians(c_custkey % 80 + 0.02::DOUBLE)) - sin(radians(c_custkey % 80))) / 1e6, 3) AS km2 FROM customer""",
)
def g28(spark, sf):
    x, y = F.lit(13.0), (F.col("c_custkey") % 80).cast("double")
    # the area between parallels is exact for edges along them; meridians add nothing
    ring = F.array(*[G.point(a, b) for a, b in [(x, y), (x + 0.01, y), (x + 0.01, y + 0.02), (x, y + 0.02), (x, y)]])
    return table(spark, sf, "customer").select("c_custkey", F.round(G.geodesic_area(ring) / 1e6, 3).alias("km2"))
