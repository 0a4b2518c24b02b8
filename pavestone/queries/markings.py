"""Markings and areas derived from lanes, roads and outlines of simple shapes, whose results SQL can write down."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import areas as A
from ..operators import linear as L
from ..operators import markings as M
from ..plans import parking as P
from ..registry import query, table
from .derived import _parts, _pick, _tags
from .spatial import _OVERLAP, PLACE, boxes, nodes, places


def _box(x0, y0, x1, y1):
    c = lambda v: v if not isinstance(v, (int, float)) else F.lit(float(v))
    x0, y0, x1, y1 = map(c, (x0, y0, x1, y1))
    return F.array(*[G.point(a, b) for a, b in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]])


_MARKS, _KINDS = ["solid_line", "no", "barred_area", None, "dashed_line"], ["vehicle", "bicycle", "bus"]


def _lanes(spark, sf):
    """A lane per order: 100 m along y = 20 k, 3 m wide, with markings."""
    k = F.col("o_orderkey")
    y = k * 20.0
    return table(spark, sf, "orders").select(
        k.alias("lane_id"), F.array(G.point(F.lit(0), y), G.point(F.lit(100), y)).alias("line"), F.lit(3.0).alias("width"), _pick(_MARKS, k).alias("marking_left"), _pick(_MARKS, F.floor(k / 5)).alias("marking_right"),
        _pick(_KINDS, k).alias("type"), F.lit(None).cast("string").alias("class"), F.when(k % 7 == 0, "backward").otherwise("forward").alias("direction"), (k % 3 * 0.5).alias("buffer_left"), F.lit(1.0).alias("buffer_right"),
        F.when(k % 4 == 0, "red").when(k % 4 == 1, "none").alias("colour"),
    )


def _sql_pick(values, key):
    lit = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{lit}])[CAST({key} % {len(values)} + 1 AS INTEGER)]"


_SIDES = f"""l AS (SELECT o_orderkey AS k, o_orderkey * 20.0::DOUBLE AS y, {_sql_pick(_MARKS, 'o_orderkey')} AS ml, {_sql_pick(_MARKS, '(o_orderkey // 5)')} AS mr, {_sql_pick(_KINDS, 'o_orderkey')} AS type, o_orderkey % 7 = 0 AS back FROM orders),
e AS (SELECT *, 'left' AS side, ml AS m, y + 1.5 AS ey, o_orderkey_buffer AS buf FROM (SELECT *, k % 3 * 0.5 AS o_orderkey_buffer FROM l) UNION ALL SELECT *, 'right', mr, y - 1.5, 1.0 FROM (SELECT *, 0.0 AS o_orderkey_buffer FROM l))"""


@query(
    "e23_lane_edges",
    f"""WITH {_SIDES}, p AS (SELECT k, unnest(CASE WHEN k % 4 = 0 THEN [0.0, 52.0] ELSE [0.0] END) AS a, unnest(CASE WHEN k % 4 = 0 THEN [48.0, 100.0] ELSE [100.0] END) AS b FROM l)
SELECT e.k AS lane_id, side, CASE WHEN m = 'barred_area' THEN 'solid' ELSE replace(m, '_line', '') END AS stroke, CASE WHEN m = 'barred_area' OR type = 'bus' OR (type = 'bicycle' AND side = CASE WHEN back THEN 'right' ELSE 'left' END) THEN 0.25 ELSE 0.12 END::DOUBLE AS stroke_width,
 ey AS y, CASE WHEN back THEN 100 - b ELSE a END::DOUBLE AS from_m, CASE WHEN back THEN 100 - a ELSE b END::DOUBLE AS to_m FROM e JOIN p ON e.k = p.k WHERE m LIKE '%line%' OR m = 'barred_area'""",
)
def e23(spark, sf):
    k = F.col("o_orderkey")
    service = table(spark, sf, "orders").where("o_orderkey % 4 = 0").select(k.alias("cor_id"), F.lit(50.0).alias("x1"), (k * 20.0 - 8).alias("y1"), F.lit(50.0).alias("x2"), (k * 20.0 + 8).alias("y2"), F.lit(2.0).alias("half"))
    e = M.lane_edges(_lanes(spark, sf), service)
    return e.select("lane_id", "side", "stroke", "stroke_width", G.start(F.col("line"))["y"].alias("y"), F.round("from_m", 6).alias("from_m"), F.round("to_m", 6).alias("to_m"))


@query(
    "e24_barred_areas",
    f"""WITH {_SIDES} SELECT k || '/' || side AS edge_id, round(100 * buf, 6)::DOUBLE AS area FROM e WHERE m = 'barred_area' AND buf > 0 AND NOT (k % 3 = 1 AND side = 'left')""",
)
def e24(spark, sf):
    """A mapped area covers two fifths of the left corridor of one lane in three, and a tenth of that of others: the first make it go."""
    k = F.col("o_orderkey")
    y = k * 20.0 + 1.5
    mapped = table(spark, sf, "orders").select(k.alias("r_id"), F.array(_box(F.lit(0.0), y, F.when(k % 3 == 1, 40.0).otherwise(10.0), y + 1)).alias("rings"))
    return M.barred_areas(_lanes(spark, sf), mapped).groupBy("edge_id").agg(F.round(F.sum(G.area(F.col("ring"))), 6).alias("area"))


@query(
    "e25_buffer_markings",
    "WITH t AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN 2.0 ELSE 0.0 END::DOUBLE AS y FROM part) SELECT k AS place_id, y AS low, 4.5::DOUBLE AS area FROM t WHERE NOT (k % 5 = 0 AND y = 0)",
)
def e25(spark, sf):
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(k.alias("place_id"), (k * 50.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("facing"), F.lit(90.0).alias("road"), F.when(k % 4 == 0, 280.0).when(k % 4 == 1, 20.0).alias("cycle_az"), F.lit(2.0).alias("cycle_width"))
    mapped = table(spark, sf, "part").where("p_partkey % 5 = 0").select(k.alias("r_id"), F.array(_box(k * 50.0 - 3, F.lit(0.0), k * 50.0 + 3, F.lit(1.6))).alias("rings"))
    ring = F.col("ring")
    return M.buffer_markings(p, mapped).select("place_id", (F.round(G.envelope(ring)["ymin"], 6) + 0.0).alias("low"), F.round(G.area(ring), 6).alias("area"))


@query(
    "e26_tunnel_symbols",
    """WITH i AS (SELECT l_orderkey AS line_id, l_partkey % 50 AS poly_id, l_suppkey * 10.0::DOUBLE AS a, l_suppkey * 10.0::DOUBLE + l_quantity AS b FROM lineitem), t AS (SELECT line_id, poly_id, sum(b - a) AS total, arg_min((a + b) / 2, (a - b, (a + b) / 2)) AS pos FROM i GROUP BY 1, 2)
SELECT line_id, arg_min(poly_id, (-total, poly_id)) AS poly_id, arg_min(pos, (-total, poly_id)) AS "at" FROM t GROUP BY line_id""",
)
def e26(spark, sf):
    s = F.col("l_suppkey") * 10.0
    i = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("line_id"), (F.col("l_partkey") % 50).alias("poly_id"), s.alias("from_m"), (s + F.col("l_quantity")).alias("to_m"))
    return M.tunnel_symbols(i)


def _diff(a: str, b: str) -> str:
    return f"least((({a}) - ({b}) + 720) % 360, 360 - (({a}) - ({b}) + 720) % 360)"


def _axis(a: str, b: str) -> str:
    return f"least((({a}) - ({b}) + 720) % 180, 180 - (({a}) - ({b}) + 720) % 180)"


@query(
    "e28_space_directions",
    f"""WITH t AS (SELECT o_orderkey AS k, o_orderkey * 7 % 180 AS lo, CASE WHEN o_orderkey % 6 > 0 THEN o_orderkey * 11 % 360 END AS road, o_orderkey * 13 % 360 AS tr, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey * 17 % 360 END AS lane FROM orders),
u AS (SELECT *, CASE WHEN {_diff('lo', 'tr')} <= {_diff('lo + 180', 'tr')} THEN lo ELSE lo + 180 END AS to_road, CASE WHEN lane IS NULL THEN lo WHEN {_diff('lo', 'lane')} <= {_diff('lo + 180', 'lane')} THEN lo ELSE lo + 180 END AS to_lane FROM t)
SELECT k, (CASE WHEN road IS NULL THEN lo WHEN {_axis('lo', 'road')} > 25 THEN to_road ELSE to_lane + 180 END % 360)::DOUBLE AS direction FROM u""",
)
def e28(spark, sf):
    k = F.col("o_orderkey")
    d = lambda m, n: (k * m % n).cast("double")
    s = table(spark, sf, "orders").select(k.alias("k"), d(7, 180).alias("long_az"), F.when(k % 6 > 0, d(11, 360)).alias("road_az"), d(13, 360).alias("to_road"), F.when(k % 5 > 0, d(17, 360)).alias("lane_az"))
    return M.space_directions(s).select("k", "direction")


@query("e29_surface_colours", "SELECT 'lane_colour' AS source, 'red' AS colour, count(*) AS n, round(count(*) * 275.0, 3)::DOUBLE AS area FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT 'area_colour', 'green', count(*), sum((c_custkey % 9 + 1) * (c_custkey % 7 + 1))::DOUBLE FROM customer WHERE c_custkey % 3 = 0")
def e29(spark, sf):
    k = F.col("l_id")
    b = boxes(spark, sf, "l").select(k.alias("area_id"), F.when(k % 3 == 0, "green").otherwise("no").alias("colour"), _box(F.col("lx0"), F.col("ly0"), F.col("lx1"), F.col("ly1")).alias("ring"))
    c = M.surface_colours(_lanes(spark, sf), b)
    return c.groupBy("source", "colour").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(G.area(F.col("ring"))), 3).alias("area"))


@query(
    "e19_limit_to_lanes",
    """WITH o AS (SELECT o_orderkey AS k, o_orderkey % 3 * 0.1::DOUBLE AS b FROM orders)
SELECT k AS stop_id, round(CASE WHEN k % 5 = 0 THEN 6.5 - (1.5 + 0.2 + 0.12) ELSE 9.5 - (1.5 + 0.2 + 0.12) END, 6)::DOUBLE AS from_m, round(12.5 + 1.5 + b + 0.12, 6)::DOUBLE AS to_m FROM o""",
)
def e19(spark, sf):
    """Stop lines of 16 m across four lanes: two backward ones (one of them for both ways at every fifth), two forward ones."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    s = o.select(k.alias("stop_id"), F.lit("forward").alias("direction"), F.lit(50.0).alias("x1"), (k * 20.0 - 8).alias("y1"), F.lit(50.0).alias("x2"), (k * 20.0 + 8).alias("y2"))
    j = F.col("j")
    l = o.select(k, F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j")).select(
        (k * 4 + j).alias("lane_id"), F.when(j == 3, "bus").otherwise("vehicle").alias("type"), F.when(j >= 2, "forward").when((j == 1) & (k % 5 == 0), "both_ways").otherwise("backward").alias("direction"), F.lit(3.0).alias("width"), (k % 3 * 0.1).alias("buffer_left"), F.lit(0.2).alias("buffer_right"),
        F.lit(0.0).alias("x1"), (k * 20.0 + (j - 1.5) * 3).alias("y1"), F.lit(100.0).alias("x2"), (k * 20.0 + (j - 1.5) * 3).alias("y2"),
    )
    return M.limit_to_lanes(s, l).select("stop_id", F.round("from_m", 6).alias("from_m"), F.round("to_m", 6).alias("to_m"))


@query(
    "e20_outline_groups",
    "SELECT c_custkey AS stop_id, CAST(c_custkey % 12 // 3 * 3 + 1 + i AS INTEGER) AS idx FROM customer, (SELECT unnest(range(3)) AS i)",
)
def e20(spark, sf):
    """Outlines of twelve segments in groups of three; groups that don't touch look the same way in pairs."""
    k = F.col("c_custkey")
    i = F.explode(F.sequence(F.lit(1), F.lit(12)))
    e = table(spark, sf, "customer").select(k.alias("area_id"), F.lit(12).alias("n"), i.alias("idx")).withColumn("az", (F.floor((F.col("idx") - 1) / 3) % 2 * 90 + F.col("idx") % 3 * 5.0).cast("double"))
    a = table(spark, sf, "customer").select(k.alias("stop_id"), k.alias("area_id"), (k % 12 + 1).cast("int").alias("idx"))
    return M.outline_groups(e, a).select("stop_id", "idx")


@query(
    "e21_crossing_lines",
    """WITH n AS (SELECT c_custkey AS k, c_custkey % 2 = 0 AS s, c_custkey % 3 = 0 AS n, CASE WHEN c_custkey % 5 = 0 THEN 1.0 ELSE 1 + 5 / sqrt(101) END AS fs, 1 + 5 / sqrt(65) AS fn FROM customer)
SELECT k AS node_id, CASE WHEN s AND n THEN 'two_sided' WHEN s OR n THEN 'one_sided' ELSE 'generic' END AS kind,
 round(CASE WHEN n THEN 8 * fn WHEN s THEN 10 * (1 + 5 / sqrt(101)) ELSE 3 END, 6)::DOUBLE AS y1, round(CASE WHEN s THEN -10 * fs WHEN n THEN -8 * fn ELSE -3 END, 6)::DOUBLE AS y2 FROM n""",
)
def e21(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer")
    n = c.select(k.alias("node_id"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(90.0).alias("road_az"))
    path = lambda i, x, y, kerb: F.struct((k * 4 + i).alias("path_id"), F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), kerb.alias("kerb_bounded"))
    # a path along the road never counts, and of two on a side the straighter one
    each = F.array_compact(F.array(F.when(k % 2 == 0, path(0, 1, -10, k % 5 == 0)), F.when(k % 2 == 0, path(1, 4, -9, F.lit(True))), F.when(k % 3 == 0, path(2, -1, 8, F.lit(False))), path(3, 10, 1, F.lit(True))))
    p = c.select(k.alias("node_id"), F.explode(each).alias("p")).select("p.path_id", "node_id", "p.x", "p.y", "p.kerb_bounded")
    return M.crossing_lines(n, p).select("node_id", "kind", F.round("y1", 6).alias("y1"), F.round("y2", 6).alias("y2"))


@query(
    "e22_clip_by_zones",
    """WITH i AS (SELECT l_orderkey AS line_id, l_suppkey * 10.0::DOUBLE AS a, l_suppkey * 10.0::DOUBLE + l_quantity AS b FROM lineitem WHERE l_partkey % 5 <> l_orderkey % 5 AND (l_orderkey % 2 = 0 OR l_partkey % 3 > 0)),
m0 AS (SELECT *, max(b) OVER (PARTITION BY line_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM i), m1 AS (SELECT *, sum(CASE WHEN far IS NULL OR a > far THEN 1 ELSE 0 END) OVER (PARTITION BY line_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM m0), m AS (SELECT line_id, min(a) AS a, max(b) AS b FROM m1 GROUP BY line_id, g),
p AS (SELECT line_id, lag(b) OVER (PARTITION BY line_id ORDER BY a) AS a0, a AS b0 FROM m UNION ALL SELECT line_id, max(b), NULL FROM m GROUP BY line_id UNION ALL SELECT DISTINCT l_orderkey, NULL, NULL FROM lineitem WHERE l_orderkey NOT IN (SELECT line_id FROM m)),
q AS (SELECT line_id, greatest(coalesce(a0, 0), 0) AS from_m, least(coalesce(b0, 600), 600) AS to_m FROM p) SELECT line_id, from_m, to_m FROM q WHERE to_m > from_m""",
)
def e22(spark, sf):
    s, k = F.col("l_suppkey") * 10.0, F.col("l_orderkey")
    l = table(spark, sf, "lineitem")
    inside = l.select(k.alias("line_id"), (F.col("l_partkey") % 5).alias("zone_crossing"), (F.col("l_partkey") % 3 == 0).alias("zone_is_bicycle"), s.alias("from_m"), (s + F.col("l_quantity")).alias("to_m"))
    rows = l.select(k.alias("line_id"), (k % 5).alias("crossing_id"), (k % 2 == 0).alias("is_bicycle"), F.lit(600.0).alias("total")).distinct()
    return M.clip_by_zones(rows, inside)


@query(
    "e41_junction_zones",
    f"""WITH {PLACE}, j AS (SELECT s_suppkey AS id, s_suppkey * 97 % 1000 AS x, s_suppkey * 61 % 1000 AS y FROM supplier)
SELECT 'junction' AS source, count(*) AS n, (count(*) * 16)::DOUBLE AS area FROM j UNION ALL SELECT 'area', count(*), sum(w * h)::DOUBLE FROM c WHERE id % 4 <> 1
UNION ALL SELECT 'hull', count(*), NULL FROM c WHERE EXISTS (SELECT 1 FROM j WHERE pow(c.x + 1 - j.x, 2) + pow(c.y + 1 - j.y, 2) <= 324)""",
)
def e41(spark, sf):
    k, c = F.col("s_suppkey"), F.col("l_id")
    x, y = (k * 97 % 1000).cast("double"), (k * 61 % 1000).cast("double")
    j = table(spark, sf, "supplier").select(k.alias("junction_id"), F.lit(0).alias("layer"), x.alias("x"), y.alias("y"), _box(x - 2, y - 2, x + 2, y + 2).alias("ring"))
    b = boxes(spark, sf, "l")
    s = b.select(c.alias("stop_id"), F.col("lx0").alias("x1"), F.col("ly0").alias("y1"), (F.col("lx0") + 2).alias("x2"), (F.col("ly0") + 2).alias("y2"))
    a = b.select(c.alias("area_id"), F.lit(0).alias("layer"), F.when(c % 4 == 1, "yes").when(c % 4 == 2, "no").alias("markings"), _box(F.col("lx0"), F.col("ly0"), F.col("lx1"), F.col("ly1")).alias("ring"))
    z = M.junction_zones(j, s, a)
    return z.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("source") != "hull", G.area(F.col("ring")))).alias("area"))


@query(
    "e42_regenerate_stripes",
    "SELECT o_orderkey AS line_id, CASE WHEN o_orderkey % 3 = 0 THEN 8 ELSE 10 END::BIGINT AS n, CASE WHEN o_orderkey % 3 = 0 THEN 0.5 + 1.5 + 2.5 + 5.5 + 6.5 + 7.5 + 8.5 + 9.5 ELSE 50.0 END::DOUBLE AS sum_at FROM orders",
)
def e42(spark, sf):
    k = F.col("o_orderkey")
    y = k * 20.0
    l = table(spark, sf, "orders").select(k.alias("line_id"), F.array(G.point(F.lit(0), y), G.point(F.lit(10), y)).alias("line"))
    z = table(spark, sf, "orders").where("o_orderkey % 3 = 0").select(k.alias("poly_id"), F.array(_box(F.lit(3.0), y - 1, F.lit(5.0), y + 1)).alias("rings"))
    return M.regenerate_stripes(l, z).groupBy("line_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("at"), 6).alias("sum_at"))


# ---- areas ----


@query(
    "e30_carriageways",
    """WITH r AS (SELECT o_orderkey AS k, o_orderkey % 5 + 6.0::DOUBLE AS w, o_orderkey % 3 - 1.0::DOUBLE AS po FROM orders)
SELECT k AS road_id, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS quads, round(CASE WHEN k % 3 = 0 THEN 84 * w ELSE 102 * w END, 4)::DOUBLE AS area, round(w / 2 - po, 6)::DOUBLE AS left_reach FROM r""",
)
def e30(spark, sf):
    """Straight roads of 100 m; a mapped area of the same layer takes the middle fifth of one in three, others lie on another layer."""
    k = F.col("o_orderkey")
    y = k * 40.0
    o = table(spark, sf, "orders")
    roads = o.select(k.alias("road_id"), F.floor(k / 2).alias("chain"), F.when(k % 2 == 0, 1).alias("layer"), F.lit("asphalt").alias("surface"), (k % 5 + 6.0).alias("width"), (k % 3 - 1.0).alias("placement_offset"), F.array(G.point(F.lit(0), y), G.point(F.lit(100), y)).alias("line"))
    own = F.when(k % 2 == 0, 1)
    areas = o.where("o_orderkey % 3 < 2").select(k.alias("poly_id"), F.when(k % 3 == 0, own).otherwise(7).alias("layer"), F.array(_box(F.lit(40.0), y - 10, F.lit(60.0), y + 10)).alias("rings"))
    q = A.carriageways(roads, areas).withColumn("y", F.col("road_id") * 40.0)
    return q.groupBy("road_id").agg(F.count(F.lit(1)).alias("quads"), F.round(F.sum(G.area(F.col("ring"))), 4).alias("area"), F.round(F.max(G.envelope(F.col("ring"))["ymax"] - F.col("y")), 6).alias("left_reach"))


@query(
    "e30_junction_pairs",
    f"WITH {_OVERLAP} SELECT l_id, r_id, round(area, 6)::DOUBLE AS area FROM p WHERE area > 0 AND l_id % 7 < r_id % 7 AND (CASE WHEN l_id % 3 > 0 THEN l_id % 3 END) IS NOT DISTINCT FROM (CASE WHEN r_id % 3 > 0 THEN r_id % 3 END)",
)
def e30b(spark, sf):
    k = F.col("l_id")
    q = boxes(spark, sf, "l").select(k.alias("quad_id"), (k % 7).alias("chain"), F.when(k % 3 > 0, k % 3).alias("layer"), _box(F.col("lx0"), F.col("ly0"), F.col("lx1"), F.col("ly1")).alias("ring"))
    return A.junction_pairs(q).select("l_id", "r_id", F.round("area", 6).alias("area"))


@query(
    "e31_junction_votes",
    """WITH p AS (SELECT l_orderkey AS zone, l_partkey * 100000 + l_suppkey * 100 + l_linenumber AS id, CASE WHEN l_partkey % 4 > 0 THEN 's' || l_partkey % 4 END AS surface, l_quantity AS area, l_suppkey % 7 AS highway FROM lineitem WHERE l_quantity >= 10),
s AS (SELECT zone, surface, sum(area) AS w FROM p GROUP BY 1, 2), b AS (SELECT zone, surface FROM s QUALIFY row_number() OVER (PARTITION BY zone ORDER BY w DESC, surface NULLS LAST) = 1)
SELECT zone, surface, highway, id AS part_id FROM (SELECT p.* FROM p JOIN b ON p.zone = b.zone AND p.surface IS NOT DISTINCT FROM b.surface) QUALIFY row_number() OVER (PARTITION BY zone ORDER BY area DESC, id) = 1""",
)
def e31(spark, sf):
    p = F.col("l_partkey")
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("zone"), (p * 100000 + F.col("l_suppkey") * 100 + F.col("l_linenumber")).alias("part_id"), F.when(p % 4 > 0, F.concat(F.lit("s"), (p % 4).cast("string"))).alias("surface"), F.col("l_quantity").alias("area"), (F.col("l_suppkey") % 7).alias("highway"))
    return A.junction_votes(rows, 10.0).select("zone", "surface", "highway", "part_id")


@query("e32_merge_areas", "SELECT c_custkey AS id, 'mapped' AS source, c_mktsegment AS markings FROM customer UNION ALL SELECT p_partkey, 'centerline', NULL FROM part")
def e32a(spark, sf):
    mapped = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("markings"))
    return A.merge_areas(mapped, table(spark, sf, "part").select(F.col("p_partkey").alias("id"))).select("id", "source", "markings")


@query(
    "e32_parking_class",
    f"""WITH {_OVERLAP}, v AS (SELECT l_id AS k, r_class AS cl, r_id % 9 AS h, area, l_id % 2 = r_id % 2 AS same FROM p WHERE area > 0 AND l_id % 3 = 0 AND r_id % 3 <> 0), f AS (SELECT *, bool_or(same) OVER (PARTITION BY k) AS any_same FROM v),
s AS (SELECT k, cl, sum(area) AS t, min(h) AS h FROM f WHERE same OR NOT any_same GROUP BY 1, 2), b AS (SELECT k, cl FROM s QUALIFY row_number() OVER (PARTITION BY k ORDER BY t DESC, h, cl) = 1),
n AS (SELECT p_partkey AS id, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, p_brand AS brand FROM part), d AS (SELECT c.id AS k, n.id, n.brand, sqrt(pow(c.x - n.x, 2) + pow(c.y - n.y, 2)) AS d FROM c JOIN n ON abs(c.x - n.x) <= 20 AND abs(c.y - n.y) <= 20 WHERE c.id % 3 = 0 AND c.id NOT IN (SELECT k FROM b))
SELECT k AS parking_id, cl AS road_class, 1 AS step FROM b UNION ALL SELECT k, brand, 2 FROM d WHERE d <= 20 QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, id) = 1""",
)
def e32b(spark, sf):
    from .spatial import rings

    l, r = boxes(spark, sf, "l").where("l_id % 3 = 0"), boxes(spark, sf, "r").where("r_id % 3 <> 0")
    ways = rings(r, "r").join(r.select("r_id", F.col("r_class").alias("road_class"), (F.col("r_id") % 9).alias("hierarchy"), (F.col("r_id") % 2).alias("layer")).hint("merge"), "r_id")
    o, members = A.parking_overlaps(rings(l, "l").withColumn("layer", F.col("l_id") % 2), ways)
    roads = nodes(spark, sf, "r").join(table(spark, sf, "part").select(F.col("p_partkey").alias("r_id"), F.col("p_brand").alias("road_class")), "r_id")
    return A.parking_class(o, places(spark, sf, "l").where("l_id % 3 = 0"), roads, members=members)


@query(
    "e33_tactile_lines",
    """SELECT 'kerb' AS class, o_orderkey AS line_id, o_orderkey % 80 + 10 - CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 2.5 END::DOUBLE AS from_m, o_orderkey % 80 + 10 + CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 2.5 END::DOUBLE AS to_m FROM orders WHERE o_orderkey % 3 > 0
UNION ALL SELECT 'highway', c_custkey, 0.0, c_custkey % 50 + 1.0 FROM customer""",
)
def e33(spark, sf):
    k = F.col("o_orderkey")
    y = k * 20.0
    o = table(spark, sf, "orders")
    kerbs = o.select(k.alias("line_id"), F.array(G.point(F.lit(0), y), G.point(F.lit(100), y)).alias("line"))
    n = o.where("o_orderkey % 3 > 0").select(k.alias("disc_id"), (k % 80 + 10.0).alias("x"), y.alias("y"), k.alias("line_id"), F.when(k % 2 == 0, 4.0).alias("width"))
    ways = table(spark, sf, "customer").select(F.lit("highway").alias("class"), F.col("c_custkey").alias("line_id"), (F.col("c_custkey") % 50 + 1.0).alias("total"))
    return A.tactile_lines(kerbs, n, ways.unionByName(ways)).select("class", "line_id", F.round("from_m", 6).alias("from_m"), F.round("to_m", 6).alias("to_m"))


@query(
    "e34_inset_points",
    """SELECT k AS point_id, round(k * 50 + CASE k % 5 WHEN 1 THEN 2.0 WHEN 2 THEN 6 + sqrt(2) WHEN 3 THEN 5.0 ELSE 5.0 END, 4)::DOUBLE AS x, round(CASE k % 5 WHEN 0 THEN -3.0 WHEN 1 THEN 2.0 WHEN 2 THEN 6 - sqrt(2) WHEN 3 THEN 4.0 ELSE 2.0 END, 4)::DOUBLE AS y, k % 5 > 0 AS moved FROM (SELECT o_orderkey AS k FROM orders)""",
)
def e34(spark, sf):
    """Buildings like an L: numbers beside a wall, in a corner (where shifted walls meet), at the corner that turns outward (where an arc joins them), and outside."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    x, case = k * 50.0, k % 5
    px = F.when(case == 1, 0.5).when(case == 2, 6.5).when(case == 3, 5.0).otherwise(5.0)
    py = F.when(case == 0, -3.0).when(case == 1, 0.5).when(case == 2, 5.5).when(case == 3, 5.5).otherwise(0.5)
    p = o.select(k.alias("point_id"), (x + px).alias("x"), py.alias("y"))
    corners = [(0, 0), (10, 0), (10, 10), (6, 10), (6, 6), (0, 6), (0, 0)]
    ring = F.array(*[G.point(x + a, F.lit(b)) for a, b in corners])
    w = o.select(k, F.posexplode(G.segments(ring)).alias("i", "e"))
    w = w.select(k.alias("building"), (k * 6 + F.col("i")).alias("wall_id"), F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
    return A.inset_points(p, A.inset_outline(w)).select("point_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), "moved")


@query("e35_bridge_ends", "SELECT o_orderkey AS bridge_id, CAST(r AS BIGINT) AS run FROM orders, (SELECT unnest([2, 4]) AS r) WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 > 0")
def e35(spark, sf):
    """Rectangles whose left and right sides a way crosses, on the same layer for two in three."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    y = k * 20.0
    e = o.select(k.alias("bridge_id"), F.when(k % 3 == 1, 0).alias("layer"), F.posexplode(G.segments(_box(F.lit(0.0), y, F.lit(10.0), y + 10))).alias("i", "e"))
    e = e.select("bridge_id", (F.col("i") + 1).alias("idx"), "layer", F.degrees(G.azimuth(F.col("e.a"), F.col("e.b"))).alias("az"), F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))
    w = o.where("o_orderkey % 2 = 0").select(k.alias("way_id"), F.when(k % 3 == 0, 2).alias("layer"), F.lit(-5.0).alias("x1"), (y + 5).alias("y1"), F.lit(15.0).alias("x2"), (y + 6).alias("y2"))
    return A.bridge_ends(e, w)


@query(
    "e36_building_walls",
    """WITH c AS (SELECT c_custkey AS id, c_custkey % 40 AS x, c_custkey // 40 AS y, c_custkey % 7 AS h FROM customer WHERE c_custkey % 5 <> 0), e AS (SELECT id, h, x, y, 'h' AS d FROM c UNION ALL SELECT id, h, x, y + 1, 'h' FROM c UNION ALL SELECT id, h, x, y, 'v' FROM c UNION ALL SELECT id, h, x + 1, y, 'v' FROM c),
g AS (SELECT x, y, d, count(*) AS n, arg_min(h, id) AS h FROM e GROUP BY 1, 2, 3) SELECT CASE WHEN n > 1 THEN 'covered' ELSE 'uncovered' END AS class, count(*) AS walls, round(sum(CASE WHEN n = 1 THEN 5.0::DOUBLE * (1 - exp(-h / 30.0::DOUBLE)) END), 4) AS reach FROM g GROUP BY 1""",
)
def e36(spark, sf):
    w = A.building_walls(A.wall_pieces(_parts(spark, sf)))
    return w.groupBy("class").agg(F.count(F.lit(1)).alias("walls"), F.round(F.sum("reach"), 4).alias("reach"))


_AREA_KINDS, _PATTERNS, _ROAD_MARKS = ["road_marking", "landuse"], ["zigzag", "stripes", None, "cross"], ["restriction", "crossing", "barred_area"]


@query(
    "e15_area_direction",
    f"""WITH t AS (SELECT o_orderkey AS k, {_sql_pick(_AREA_KINDS, 'o_orderkey')} AS kind, {_sql_pick(_PATTERNS, '(o_orderkey // 2)')} AS p, {_sql_pick(_ROAD_MARKS, '(o_orderkey // 8)')} AS m, o_orderkey * 7 % 180 AS lo, (o_orderkey * 7 + 90) % 180 AS sh, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey * 11 % 360 END AS road, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey * 13 % 360 END AS link FROM orders),
u AS (SELECT *, CASE WHEN road IS NOT NULL AND {_axis('sh', 'road')} < {_axis('lo', 'road')} THEN sh ELSE lo END AS axis, CASE WHEN {_axis('lo', 'link')} <= {_axis('sh', 'link')} THEN lo ELSE sh END AS z FROM t)
SELECT k, CAST(CASE WHEN kind = 'road_marking' AND p = 'zigzag' THEN CASE WHEN link IS NULL THEN sh WHEN {_diff('z', 'link')} > 90 THEN z + 180 ELSE z END
 WHEN kind = 'road_marking' AND m IN ('restriction', 'barred_area') THEN CASE WHEN road IS NOT NULL AND (p IS NULL OR p = 'stripes') THEN road ELSE axis END + 45 WHEN kind = 'road_marking' AND p = 'stripes' AND road IS NOT NULL THEN road ELSE axis END % 360 AS INTEGER) AS direction FROM u""",
)
def e15(spark, sf):
    k = F.col("o_orderkey")
    d = lambda v: v.cast("double")
    a = table(spark, sf, "orders").select(k.alias("k"), _pick(_AREA_KINDS, k).alias("kind"), _pick(_PATTERNS, F.floor(k / 2)).alias("pattern"), _pick(_ROAD_MARKS, F.floor(k / 8)).alias("road_marking"), d(k * 7 % 180).alias("long_az"), d((k * 7 + 90) % 180).alias("short_az"), F.when(k % 5 > 0, d(k * 11 % 360)).alias("road_az"), F.when(k % 5 > 0, d(k * 13 % 360)).alias("link_az"))
    return A.area_direction(a).select("k", "direction")


@query("f03_corridors", "SELECT o_orderkey AS line_id, 40.0 - o_orderkey % 3 - 1.0 AS from_m, 60.0 + o_orderkey % 3 + 1.0::DOUBLE AS to_m FROM orders WHERE o_orderkey % 2 = 0")
def f03c(spark, sf):
    """Lines through capsules that lie along them: the stretch between the ends and half a width beyond."""
    k = F.col("o_orderkey")
    y = k * 20.0
    l = table(spark, sf, "orders").select(k.alias("line_id"), F.array(G.point(F.lit(0), y), G.point(F.lit(100), y)).alias("line"))
    c = table(spark, sf, "orders").where("o_orderkey % 2 = 0").select(k.alias("cor_id"), F.lit(40.0).alias("x1"), y.alias("y1"), F.lit(60.0).alias("x2"), y.alias("y2"), (k % 3 + 1.0).alias("half"))
    m = L.merge_intervals(L.corridor_intervals(L.line_segments(l), c))
    return m.select("line_id", F.round("from_m", 6).alias("from_m"), F.round("to_m", 6).alias("to_m"))


# ---- street parking ----


@query(
    "e09_obstructions",
    """WITH t AS (SELECT o_orderkey AS k, o_orderkey % 8 AS m FROM orders)
SELECT k || '/crossing' AS disc_id, NULL AS side, CASE m WHEN 0 THEN 4.5 WHEN 1 THEN 2.0 ELSE 0 END::DOUBLE AS radius FROM t WHERE m < 3 UNION ALL SELECT k || '/crossing_protected', 'left', 3.0 FROM t WHERE m = 2
UNION ALL SELECT k || '/turning', NULL, CASE m WHEN 3 THEN 10.0 ELSE 15.0 END FROM t WHERE m IN (3, 4) UNION ALL SELECT k || '/bus_stop', NULL, 15.0 FROM t WHERE m = 5 UNION ALL SELECT k || '/obstacle', NULL, 2.0 FROM t WHERE m = 6""",
)
def e09(spark, sf):
    k = F.col("o_orderkey")
    m = k % 8
    t = _tags(("crossing", F.when(m == 0, "zebra").when(m == 1, "marked").when(m == 2, "unmarked")), ("crossing:kerb_extension", F.when(m == 2, "left")), ("highway", F.when(m == 3, "turning_circle").when(m == 4, "turning_loop").when(m == 5, "bus_stop")), ("amenity", F.when(m == 6, "bicycle_parking").when(m == 7, "bench")))
    n = table(spark, sf, "orders").select(k.alias("node_id"), t.alias("tags"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return P.obstructions(n).select("disc_id", F.col("disc_side").alias("side"), "radius")


@query(
    "e10_driveway_cuts",
    """SELECT d.o_orderkey // 5 AS place, greatest(CASE d.o_orderkey % 3 WHEN 0 THEN 6.0 ELSE 2.5 END / 2, 2.0)::DOUBLE AS radius, d.o_orderkey // 5 * 10 + 5.0::DOUBLE AS x FROM orders d JOIN orders s ON s.o_orderkey = d.o_orderkey + 1 WHERE d.o_orderkey % 5 = 0""",
)
def e10(spark, sf):
    """Every fifth order is a driveway across the street of the next one; others are streets elsewhere."""
    k = F.col("o_orderkey")
    g = F.floor(k / 5)
    x, y = g * 10.0, (k % 5 - 1) * 1000.0
    drive = F.array(G.point(x + 5, F.lit(-3)), G.point(x + 5, F.lit(3)))
    t = _tags(("highway", F.when(k % 5 == 0, "service").otherwise("residential")), ("service", F.when(k % 5 == 0, "driveway")), ("width", F.when((k % 5 == 0) & (k % 3 == 0), "6")))
    r = table(spark, sf, "orders").select(k.alias("line_id"), t.alias("tags"), F.when(k % 5 == 0, drive).otherwise(F.array(G.point(x, y), G.point(x + 10, y))).alias("line"))
    c = P.driveway_cuts(r)
    return c.select(F.floor((F.col("x") - 5) / 10 + 0.5).alias("place"), "radius", F.round("x", 6).alias("x"))


@query(
    "e12_parking_points",
    """WITH t AS (SELECT o_orderkey AS k, o_orderkey % 40 + 5.0::DOUBLE AS len, ['parallel', 'diagonal', 'perpendicular'][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS w FROM orders), p AS (SELECT *, CASE w WHEN 'parallel' THEN 5.2 WHEN 'diagonal' THEN 3.1 ELSE 2.5 END AS pitch FROM t),
c AS (SELECT *, greatest(CAST(floor(len / pitch) AS INTEGER), 1) AS n FROM p), f AS (SELECT *, CASE WHEN n < 2 THEN len / 2 ELSE (len - pitch * (n - 1)) / 2 END AS first FROM c)
SELECT k, n::BIGINT AS n, round(first + CASE WHEN w = 'diagonal' THEN -1.2 ELSE 0 END, 4)::DOUBLE AS x_min, round(first + pitch * (n - 1) + CASE WHEN w = 'diagonal' THEN -1.2 ELSE 0 END, 4)::DOUBLE AS x_max, CASE w WHEN 'parallel' THEN 1.0 WHEN 'diagonal' THEN 2.1 ELSE 2.2 END::DOUBLE AS y FROM f""",
)
def e12(spark, sf):
    k = F.col("o_orderkey")
    length = k % 40 + 5.0
    way = _pick(["parallel", "diagonal", "perpendicular"], k)
    pitch = F.when(way == "parallel", 5.2).when(way == "diagonal", 3.1).otherwise(2.5)
    n = F.greatest(F.floor(length / pitch).cast("int"), F.lit(1))
    none = F.lit(None).cast("string")
    p = table(spark, sf, "orders").select(
        k.cast("string").alias("source_key"), F.lit("right").alias("side"), F.lit("lane").alias("parking"), way.alias("orientation"), none.alias("condition_class"), none.alias("vehicle_designated"), none.alias("vehicle_excluded"), F.lit(False).alias("is_bus"), none.alias("oneway"),
        F.lit("inferred").alias("source_type"), F.lit(None).cast("double").alias("mapped_capacity"), n.alias("capacity"), length.alias("length"), F.array(G.point(F.lit(0), F.lit(0)), G.point(length, F.lit(0))).alias("line"),
    )
    got = P.parking_points(p)
    return got.groupBy(F.col("source_key").cast("long").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.round(F.min("x"), 4).alias("x_min"), F.round(F.max("x"), 4).alias("x_max"), F.round(F.avg("y"), 4).alias("y"))


@query(
    "e11_separate_nodes",
    """SELECT 'separate/node/' || o_orderkey AS source_key, CASE o_orderkey % 4 WHEN 1 THEN 'perpendicular' ELSE 'parallel' END AS orientation, o_orderkey * 50 + 20 - 1.25::DOUBLE AS x_min, 2.5::DOUBLE AS length FROM orders WHERE o_orderkey % 4 < 3 AND o_orderkey % 5 > 0""",
)
def e11n(spark, sf):
    """Places beside straight roads; every fourth is not on the street, and every fifth lies too far from any road."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    roads = o.select(k.alias("line_id"), F.array(G.point(k * 50, F.lit(0)), G.point(k * 50 + 40, F.lit(0))).alias("line"))
    t = _tags(("amenity", F.when(k % 4 == 0, "parking_space").otherwise("bench")), ("parking:position", F.when(k % 4 == 1, "lane")), ("parking", F.when(k % 4 == 2, "street_side").when(k % 4 == 3, "surface")), ("orientation", F.when(k % 4 == 1, "perpendicular")))
    n = o.select(k.alias("node_id"), t.alias("tags"), (k * 50 + 20.0).alias("x"), F.when(k % 5 == 0, 25.0).otherwise(4.0).alias("y"))
    s = P.separate_nodes(n, roads)
    return s.select("source_key", "orientation", F.round(F.least(F.col("line")[0]["x"], F.col("line")[1]["x"]), 6).alias("x_min"), F.round(G.length(F.col("line")), 6).alias("length"))


@query(
    "e11_separate_areas",
    """WITH t AS (SELECT o_orderkey AS k, o_orderkey % 3 AS m FROM orders WHERE o_orderkey % 4 < 3)
SELECT 'separate/way/' || k AS source_key, 'parallel' AS orientation, 30.0::DOUBLE AS length, CASE m WHEN 0 THEN 9.0 ELSE 12.0 END::DOUBLE AS capacity, n::BIGINT AS n FROM (SELECT k, m, CASE WHEN m = 2 THEN 1 ELSE 2 END AS n FROM t WHERE m < 2)
UNION ALL SELECT 'separate/way/' || k, 'perpendicular', 69.6, NULL, 1 FROM t WHERE m = 2""",
)
def e11a(spark, sf):
    """Bays of 30 by 4.8 m beside straight roads: both long sides run along the road; a mapped orientation takes the whole outline; every fourth is no street parking."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders")
    roads = o.select(k.alias("line_id"), F.array(G.point(k * 100, F.lit(0)), G.point(k * 100 + 90, F.lit(0))).alias("line"))
    t = _tags(("amenity", F.lit("parking")), ("parking", F.when(k % 4 == 3, "surface").otherwise("street_side")), ("capacity", F.when(k % 3 == 0, "9")), ("orientation", F.when(k % 3 == 2, "perpendicular")))
    a = o.select(k.alias("area_id"), t.alias("tags"), _box(k * 100 + 10.0, F.lit(3.0), k * 100 + 40.0, F.lit(7.8)).alias("ring"))
    s = P.separate_areas(a, roads)
    line = F.when(F.col("orientation") == "perpendicular", G.length(F.concat("line", F.slice("line", 1, 1)))).otherwise(G.length(F.col("line")))
    return s.select("source_key", "orientation", F.round(line, 4).alias("length"), F.col("mapped_capacity").alias("capacity")).groupBy("source_key", "orientation", "length", "capacity").agg(F.count(F.lit(1)).alias("n"))
