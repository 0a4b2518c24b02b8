"""Classification and derivations over keys of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import classify as C
from ..operators import derive as D
from ..operators import linear as L
from ..operators.areas import wall_pieces
from ..registry import query, table
from .geometric import lines
from .spatial import _MERGED, cuts, nodes, places

_CLASSES = ["motorway_link", "primary", "residential", "service", "track", "footway", "cycleway", "construction", "corridor", "banana", "tertiary_link"]


def _pick(values, k):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def _tags(*pairs):
    return F.map_filter(F.create_map(*[x for n, v in pairs for x in (F.lit(n), v)]), lambda _, v: v.isNotNull())


@query(
    "p15_classify_highway",
    f"""WITH t AS (SELECT o_orderkey AS k, {_CLASSES}[CAST(o_orderkey % 11 + 1 AS INTEGER)] AS h FROM orders), v AS (SELECT *, CASE WHEN h = 'construction' AND k % 2 = 0 THEN 'secondary' ELSE h END AS e FROM t)
SELECT k, CASE WHEN e = 'motorway_link' THEN 'motorway' WHEN e IN ('primary', 'residential', 'secondary', 'tertiary_link') THEN 'road' WHEN e IN ('service', 'track') THEN 'service' WHEN e IN ('footway', 'cycleway', 'corridor') THEN 'path' END AS type,
 CASE WHEN e = 'service' THEN 'driveway' WHEN e = 'track' THEN 'grade2' WHEN e = 'footway' THEN 'sidewalk' WHEN e LIKE '%\\_link' ESCAPE '\\' THEN 'link' END AS class,
 CAST(CASE h WHEN 'motorway_link' THEN 50 WHEN 'primary' THEN 11 WHEN 'residential' THEN 25 WHEN 'service' THEN 65 WHEN 'track' THEN 66 WHEN 'footway' THEN 82 WHEN 'cycleway' THEN 81 WHEN 'construction' THEN 90 WHEN 'corridor' THEN 89 WHEN 'tertiary_link' THEN 54 ELSE 999 END AS INTEGER) AS hierarchy FROM v""",
)
def p15(spark, sf):
    k = F.col("o_orderkey")
    t = _tags(("highway", _pick(_CLASSES, k)), ("construction", F.when(k % 2 == 0, "secondary")), ("service", F.lit("driveway")), ("tracktype", F.lit("grade2")), ("footway", F.lit("sidewalk")))
    return C.classify_highway(table(spark, sf, "orders").select(k.alias("k"), t.alias("tags"))).select("k", "type", "class", "hierarchy")


@query(
    "p16_area_type_class",
    """WITH t AS (SELECT p_partkey AS k, ['yes', 'no', NULL, 'roundabout', ''][CAST(p_partkey % 5 + 1 AS INTEGER)] AS j, [NULL, 'yes', 'zebra', 'none'][CAST(p_partkey % 4 + 1 AS INTEGER)] AS c FROM part)
SELECT k, CASE WHEN j IN ('yes', 'roundabout') THEN 'junction' WHEN c IN ('yes', 'zebra') THEN 'crossing' END AS type, CASE WHEN j = 'roundabout' THEN j WHEN j = 'yes' THEN NULL WHEN c = 'zebra' THEN c END AS class FROM t""",
)
def p16(spark, sf):
    k = F.col("p_partkey")
    t = _tags(("junction", _pick(["yes", "no", None, "roundabout", ""], k)), ("crossing", _pick([None, "yes", "zebra", "none"], k)))
    return table(spark, sf, "part").select(k.alias("k"), t.alias("t")).select("k", C.area_type_class(F.col("t")).alias("a")).select("k", "a.type", "a.class")


@query(
    "p18_marking_defaults",
    """WITH t AS (SELECT p_partkey AS k, ['lane_divider', 'stop_line', 'traffic_sign', 'crossing', 'edge_line'][CAST(p_partkey % 5 + 1 AS INTEGER)] AS m, ['way', 'node'][CAST(p_partkey // 5 % 2 + 1 AS INTEGER)] AS kind, p_partkey % 3 AS x FROM part)
SELECT k, CASE WHEN x = 1 THEN 'solid;dashed' WHEN kind = 'way' THEN CASE WHEN m = 'lane_divider' THEN 'dashed' ELSE 'solid' END END AS stroke,
 CASE WHEN x = 2 THEN 0.25 WHEN m = 'stop_line' THEN 0.5 WHEN m IN ('lane_divider', 'edge_line') THEN 0.12 END::DOUBLE AS width,
 CASE WHEN m NOT IN ('traffic_sign', 'crossing') THEN CASE WHEN x = 0 THEN 'yellow' ELSE 'white' END END AS colour,
 CASE WHEN m = 'traffic_sign' THEN '274:30' END AS symbol, CASE WHEN m = 'traffic_sign' THEN 'DE' END AS class FROM t""",
)
def p18(spark, sf):
    k = F.col("p_partkey")
    x = k % 3
    t = _tags(("stroke:left", F.when(x == 1, "solid")), ("stroke:right", F.when(x == 1, "dashed")), ("width", F.when(x == 2, "25 cm")), ("temporary", F.when(x == 0, "yes")), ("traffic_sign", F.lit("DE:274:30")))
    df = table(spark, sf, "part").select(k.alias("k"), t.alias("tags"), _pick(["lane_divider", "stop_line", "traffic_sign", "crossing", "edge_line"], k).alias("road_marking"), _pick(["way", "node"], F.floor(k / 5)).alias("kind"))
    return C.marking_defaults(df).select("k", "stroke", "width", "colour", "symbol", "class")


@query(
    "p13_classify_feature",
    """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'amenity' WHEN 1 THEN 'man_made' ELSE 'sport' END AS namespace, CASE p_partkey % 4 WHEN 0 THEN 'bench' WHEN 1 THEN 'mast' ELSE 'table_tennis' END AS class, p_partkey % 4 = 1 AS disused FROM part WHERE p_partkey % 4 < 3""",
)
def p13(spark, sf):
    k = F.col("p_partkey")
    t = _tags(("amenity", F.when(k % 4 == 0, "bench").when(k % 4 == 3, "school")), ("disused:man_made", F.when(k % 4 == 1, "mast")), ("sport", F.when(k % 4 == 2, "table_tennis")), ("leisure", F.when(k % 4 == 2, "pitch")))
    return C.classify_feature(table(spark, sf, "part").select(k.alias("k"), t.alias("tags"))).drop("tags")


@query(
    "p20_route_elements",
    """SELECT layer, direction, count(*) AS n FROM (SELECT p_partkey % 6 AS k FROM part), (VALUES (0, 'highway', NULL), (1, 'building', NULL), (2, 'tree', NULL), (2, 'barrier', NULL), (3, 'road_marking', 'forward'), (3, 'road_marking', 'backward'), (4, 'road_marking', NULL)) AS v(m, layer, direction) WHERE k = m GROUP BY ALL""",
)
def p20(spark, sf):
    k = F.col("p_partkey") % 6
    t = _tags(("highway", F.when(k == 0, "residential")), ("building", F.when(k == 1, "yes")), ("natural", F.when(k == 2, "tree")), ("barrier", F.when(k == 2, "bollard")), ("road_marking", F.when(k.isin(3, 4), "arrow")), ("direction", F.when(k == 3, "both")))
    return C.route_elements(table(spark, sf, "part").select(t.alias("tags"))).groupBy("layer", "direction").agg(F.count(F.lit(1)).alias("n"))


@query("j07_connect_snapped", "WITH e AS (SELECT c_custkey AS s, round(c_custkey * 53 % 1000 / 10.0) AS x, round(c_custkey * 29 % 1000 / 10.0) AS y FROM customer) SELECT DISTINCT a.s AS a, b.s AS b FROM e a JOIN e b ON a.x = b.x AND a.y = b.y AND a.s <> b.s")
def j07(spark, sf):
    return D.connect_snapped(places(spark, sf, "").select(F.col("_id").alias("seg"), "x", "y"), 10.0)


@query(
    "j08_best_by_angle",
    """WITH s AS (SELECT c_custkey AS id, c_nationkey AS name, c_mktsegment AS class, c_custkey * 7 % 360 AS a FROM customer)
SELECT l.id AS l_id, arg_min(r.id, (least((l.a - r.a + 360) % 180, 180 - (l.a - r.a + 360) % 180), r.id)) AS r_id FROM s l JOIN s r ON l.name = r.name AND l.class = r.class AND l.id <> r.id GROUP BY l.id""",
)
def j08(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("name"), F.col("c_mktsegment").alias("class"), (F.col("c_custkey") * 7 % 360).cast("double").alias("a"))
    pick = lambda p: c.select(F.col("id").alias(f"{p}_id"), "name", "class", F.col("a").alias(f"{p}a"))
    return D.best_by_angle(pick("l"), pick("r")).select("l_id", "r_id")


@query(
    "j21_lane_candidates",
    """WITH l AS (SELECT c_custkey // 4 AS seg, c_custkey % 4 AS i, CASE WHEN c_custkey % 5 = 0 THEN 'bus' WHEN c_custkey % 7 = 0 THEN 'bicycle' ELSE 'vehicle' END AS ty, CASE WHEN c_custkey % 3 = 0 THEN 'backward' ELSE 'forward' END AS d, 3 + c_custkey % 3 * 0.25 AS w, CASE WHEN c_custkey % 6 = 0 THEN 'left' WHEN c_custkey % 6 = 1 THEN 'through' END AS t,
 c_custkey // 4 * 10.0 AS sx, c_custkey % 4 * 1.0 AS sy, c_custkey // 4 * 10.0 + 10 AS ex, c_custkey % 4 * 1.2 AS ey FROM customer),
g AS (SELECT *, CASE WHEN ty IN ('vehicle', 'bus') THEN 'motor' ELSE ty END AS grp FROM l), n AS (SELECT *, count(*) OVER (PARTITION BY seg, grp, d) AS k FROM g),
p AS (SELECT a.seg AS sa, a.i AS ia, b.seg AS sb, b.i AS ib, a.t, b.t AS bt, a.k AS ka, b.k AS kb, CASE WHEN a.d = 'forward' THEN sqrt(pow(a.ex - b.sx, 2) + pow(a.ey - b.sy, 2)) END AS dist FROM n a JOIN n b ON b.seg = a.seg + 1 AND a.grp = b.grp AND abs(a.w - b.w) <= 0.5 AND a.d = 'forward' AND b.d = 'forward')
SELECT sa AS a_segment, ia AS a_lane_index, sb AS b_segment, ib AS b_lane_index, round(dist, 6) AS d, CASE WHEN t = 'left' THEN 0 ELSE 1 END AS turn_priority FROM p WHERE (t IS DISTINCT FROM 'left' OR t = bt) AND dist <= 5 AND (dist <= 1.5 OR ka = kb)""",
)
def j21(spark, sf):
    k = F.col("c_custkey")
    seg, i = F.floor(k / 4), k % 4
    l = table(spark, sf, "customer").select(
        seg.alias("segment"), i.alias("lane_index"), F.when(k % 5 == 0, "bus").when(k % 7 == 0, "bicycle").otherwise("vehicle").alias("type"), F.when(k % 3 == 0, "backward").otherwise("forward").alias("direction"),
        (3 + k % 3 * 0.25).alias("width"), F.when(k % 6 == 0, "left").when(k % 6 == 1, "through").alias("turn"), (seg * 10.0).alias("sx"), (i * 1.0).alias("sy"), (seg * 10.0 + 10).alias("ex"), (i * 1.2).alias("ey"),
    )
    j = l.select(F.col("segment").alias("segment_a"), F.lit("end").alias("a_end"), (F.col("segment") + 1).alias("segment_b"), F.lit("start").alias("b_end")).distinct()
    return D.lane_candidates(j, l).withColumn("d", F.round("d", 6))


@query(
    "f05_style_inside",
    f"""WITH {_MERGED}, z AS (SELECT line_id, greatest(a, 0) AS a, least(b, 500) AS b FROM m WHERE a < 500), s AS (SELECT line_id, sum(b - a) AS t FROM z GROUP BY 1)
SELECT line_id, round(CASE WHEN t >= 335 THEN 500 ELSE t END, 4)::DOUBLE AS in_m, round(CASE WHEN t >= 335 THEN 0 ELSE 500 - t END, 4)::DOUBLE AS out_m FROM s""",
)
def f05(spark, sf):
    m = L.merge_intervals(cuts(spark, sf)).where("from_m < 500").withColumn("to_m", F.least("to_m", F.lit(500.0)))
    whole = m.select("line_id").distinct().withColumn("total", F.lit(500.0))
    s = D.style_inside(whole, m, 0.67, 0.0)
    part = lambda c: F.round(F.sum(F.when(c, F.col("to_m") - F.col("from_m")).otherwise(0.0)), 4)
    return s.groupBy("line_id").agg(part(F.col("inside")).alias("in_m"), part(~F.col("inside")).alias("out_m"))


@query(
    "f09_best_overlap_piece",
    """WITH a AS (SELECT l_orderkey AS k, l_linenumber AS i, l_suppkey AS x, l_suppkey + l_quantity AS y, l_partkey AS p FROM lineitem),
o AS (SELECT w.k, w.p AS a_id, b.p AS b_id, least(w.y, b.y) - greatest(w.x, b.x) AS c FROM a w JOIN a b ON w.k = b.k AND w.i = 1 AND b.i > 1 AND least(w.y, b.y) > greatest(w.x, b.x))
SELECT k AS line_id, a_id, arg_min(b_id, (-c, b_id)) AS b_id FROM o GROUP BY k, a_id""",
)
def f09(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("line_id"), "l_linenumber", F.col("l_partkey").alias("p"), F.col("l_suppkey").cast("double").alias("from_m"), (F.col("l_suppkey") + F.col("l_quantity")).cast("double").alias("to_m"))
    return D.best_overlap_piece(l.where("l_linenumber = 1").withColumnRenamed("p", "a_id"), l.where("l_linenumber > 1").withColumnRenamed("p", "b_id")).select("line_id", "a_id", "b_id")


@query("f10_keep_anchored", f"WITH {_MERGED} SELECT line_id, a AS from_m, b AS to_m FROM m WHERE a <= line_id % 900 + 20 AND b >= line_id % 900 - 20")
def f10(spark, sf):
    m = L.merge_intervals(cuts(spark, sf))
    return D.keep_anchored(m, m.select("line_id", (F.col("line_id") % 900).cast("double").alias("at")).distinct(), 20.0)


@query(
    "f11_trim_tail",
    """WITH l AS (SELECT o_orderkey AS k, o_totalprice % 50 + 1 AS t FROM orders), c AS (SELECT k, t, t - k % 4 * 0.75 AS pos, k % 5 * 0.9 AS d FROM l WHERE k % 3 = 0)
SELECT l.k AS line_id, round(coalesce((SELECT pos FROM c WHERE c.k = l.k AND d <= 3 AND pos / c.t > 0.01 AND pos / c.t < 0.999 AND c.t - pos < 2), t), 4) AS to_m FROM l""",
)
def f11(spark, sf):
    k = F.col("line_id")
    l = table(spark, sf, "orders").select(F.col("o_orderkey").alias("line_id"), (F.col("o_totalprice") % 50 + 1).alias("total"))
    c = l.where("line_id % 3 = 0").select("line_id", (F.col("total") - k % 4 * 0.75).alias("at"), (k % 5 * 0.9).alias("distance"))
    return D.trim_tail(l, c).select("line_id", F.round("to_m", 4).alias("to_m"))


@query("f12_first_cut", "SELECT l_orderkey AS line_id, CAST(min(l_suppkey) AS DOUBLE) AS cut FROM lineitem GROUP BY 1")
def f12(spark, sf):
    return D.first_cut(cuts(spark, sf).select("line_id", (F.col("from_m") / 10).alias("at")))


@query(
    "f12_head_and_tail",
    """WITH l AS (SELECT o_orderkey AS line_id, o_orderkey % 90 + 10.0::DOUBLE AS total FROM orders), c AS (SELECT l_orderkey AS line_id, l_linenumber * 17 % 60 - 5.0::DOUBLE AS pos FROM lineitem),
f AS (SELECT line_id, min(pos) AS cut FROM c JOIN l USING (line_id) WHERE pos > 0 AND pos < total GROUP BY 1)
SELECT line_id, 'head' AS part, 0.0::DOUBLE AS from_m, coalesce(cut, total) AS to_m FROM l LEFT JOIN f USING (line_id) UNION ALL SELECT line_id, 'tail', cut, total FROM l JOIN f USING (line_id)""",
)
def f12_parts(spark, sf):
    """Lines cut at the first of their crossings; some crossings lie off the line, some lines have none."""
    k = F.col("o_orderkey")
    l = table(spark, sf, "orders").select(k.alias("line_id"), (k % 90 + 10.0).alias("total"))
    c = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("line_id"), (F.col("l_linenumber") * 17 % 60 - 5.0).alias("at"))
    return D.head_and_tail(l, c)


@query(
    "f16_drop_connectors",
    """WITH s AS (SELECT c_custkey AS id, c_nationkey % 5 AS name, CASE WHEN c_custkey % 9 = 0 THEN 'primary_link' ELSE 'residential' END AS h, c_mktsegment AS class, c_custkey % 60 + 0.0 AS len, c_custkey * 7 % 180 AS az, c_custkey % 400 AS a, c_custkey * 7 % 400 AS b FROM customer),
e AS (SELECT id, name, class, az, 'a' AS w, a AS v FROM s UNION ALL SELECT id, name, class, az, 'b', b FROM s), u AS (SELECT DISTINCT id, name, class, az, v FROM e),
t AS (SELECT c.id, c.w, count(DISTINCT o.id) AS n, bool_or(o.name = c.name AND o.class = c.class AND least((c.az - o.az + 180) % 180, 180 - (c.az - o.az + 180) % 180) <= 25) AS goes FROM e c JOIN u o ON c.v = o.v AND c.id <> o.id WHERE c.id IN (SELECT id FROM s WHERE len <= 25) GROUP BY 1, 2)
SELECT id FROM s WHERE id NOT IN (SELECT id FROM t WHERE n > 1 AND NOT goes GROUP BY id HAVING count(*) = 2) AND NOT (len <= 25 AND h = 'primary_link')""",
)
def f16(spark, sf):
    k = F.col("c_custkey")
    zero = F.lit(0.0)
    s = table(spark, sf, "customer").select(k.alias("id"), (F.col("c_nationkey") % 5).alias("name"), F.when(k % 9 == 0, "primary_link").otherwise("residential").alias("highway"), F.col("c_mktsegment").alias("class"), (k % 60).cast("double").alias("len"), (k * 7 % 180).cast("double").alias("az"), (k % 400).cast("double").alias("ax"), zero.alias("ay"), (k * 7 % 400).cast("double").alias("bx"), zero.alias("by"))
    return D.drop_connectors(s).select("id")


def _parts(spark, sf):
    """Unit squares on a grid, counter-clockwise, with a height each."""
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").where("c_custkey % 5 <> 0").select(k.alias("part"), (k % 40).cast("double").alias("x"), F.floor(k / 40).cast("double").alias("y"), (k % 7).alias("height"))
    x, y = F.col("x"), F.col("y")
    ring = F.array(*[G.point(a, b) for a, b in [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)]])
    return c.select("part", "height", F.array(ring).alias("rings"))


def _walls(spark, sf):
    e = _parts(spark, sf).select("part", "height", F.explode(G.segments(F.col("rings")[0])).alias("e"))
    return e.select("part", "height", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


@query(
    "f21_height_steps",
    """WITH c AS (SELECT c_custkey AS id, c_custkey % 40 AS x, c_custkey // 40 AS y, c_custkey % 7 AS h FROM customer WHERE c_custkey % 5 <> 0)
SELECT a.id AS lower, b.id AS upper, round(CASE WHEN b.y > a.y THEN -cos(radians(40)) WHEN b.y < a.y THEN cos(radians(40)) WHEN b.x > a.x THEN -sin(radians(40)) ELSE sin(radians(40)) END, 2) AS facing FROM c a JOIN c b ON abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.h > a.h""",
)
def f21(spark, sf):
    return D.height_steps(wall_pieces(_parts(spark, sf))).select("lower", "upper", "facing")


@query(
    "f19_outline_edges",
    """WITH c AS (SELECT c_custkey AS id, c_custkey % 40 AS x, c_custkey // 40 AS y FROM customer WHERE c_custkey % 5 <> 0), e AS (SELECT id, x, y, 'h' AS d FROM c UNION ALL SELECT id, x, y + 1, 'h' FROM c UNION ALL SELECT id, x, y, 'v' FROM c UNION ALL SELECT id, x + 1, y, 'v' FROM c)
SELECT count(*) AS edges, CAST(sum(id) AS BIGINT) AS ids FROM (SELECT x, y, d, min(id) AS id FROM e WHERE NOT (d = 'h' AND y % 3 = 0) GROUP BY ALL)""",
)
def f19(spark, sf):
    w = _walls(spark, sf).withColumn("k", G.edge_key(G.point(F.col("x1"), F.col("y1")), G.point(F.col("x2"), F.col("y2"))))
    e = w.select(F.col("part").alias("id"), F.col("k.p.x").alias("key_x1"), F.col("k.p.y").alias("key_y1"), F.col("k.q.x").alias("key_x2"), F.col("k.q.y").alias("key_y2"))
    kerb = e.where("key_y1 = key_y2 and key_y1 % 3 = 0")
    return D.outline_edges(e, kerb).agg(F.count(F.lit(1)).alias("edges"), F.sum("id").alias("ids"))


@query(
    "r08_node_azimuth",
    """WITH a AS (SELECT o_custkey AS node, o_orderkey AS road, o_orderkey * 7 % 360 AS d, o_orderpriority = '1-URGENT' AS s FROM orders), m AS (SELECT * FROM a WHERE NOT s UNION ALL SELECT * FROM a WHERE s AND node NOT IN (SELECT node FROM a WHERE NOT s)),
f AS (SELECT node, arg_min(d, road) AS ref, count(*) AS n FROM m GROUP BY 1), t AS (SELECT m.node, ref, n, radians(CASE WHEN least((d - ref + 360) % 360, 360 - (d - ref + 360) % 360) > 90 THEN d + 180 ELSE d END) AS r FROM m JOIN f USING (node)),
g AS (SELECT node, any_value(n) AS n, any_value(ref) AS ref, avg(sin(r)) AS s, avg(cos(r)) AS c FROM t GROUP BY 1)
SELECT node, round(cos(radians(CASE WHEN n = 1 THEN ref ELSE degrees(atan2(s, c)) END)), 6) + 0.0 AS cosine FROM g""",
)
def r08(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("node"), F.col("o_orderkey").alias("road"), (F.col("o_orderkey") * 7 % 360).cast("double").alias("degrees"), (F.col("o_orderpriority") == "1-URGENT").alias("service"))
    return D.node_azimuth(o).select("node", (F.round(F.cos(F.radians("azimuth")), 6) + 0.0).alias("cosine"))


@query(
    "e13_fit_rectangle",
    """SELECT c_custkey AS id, round(5.0::DOUBLE * greatest(c_custkey % 9 + 2, c_custkey % 7 + 1), 6) AS long, round(2 * (c_custkey % 9 + 2) - 1.5 * (c_custkey % 7 + 1), 6)::DOUBLE AS x FROM customer WHERE c_custkey % 9 + 2 <> c_custkey % 7 + 1""",
)
def e13(spark, sf):
    k = F.col("c_custkey")
    a, b = k % 9 + 2, k % 7 + 1
    at = [(F.lit(0), F.lit(0)), (4 * a, 3 * a), (4 * a - 3 * b, 3 * a + 4 * b), (-3 * b, 4 * b), (F.lit(0), F.lit(0))]
    p = table(spark, sf, "customer").where(a != b).select(k.alias("id"), F.array(*[G.point(x, y) for x, y in at]).alias("ring"))
    return D.fit_rectangle(p).select("id", F.round("long", 6).alias("long"), F.round("x", 6).alias("x"))


@query(
    "e16_face_road",
    """WITH n AS (SELECT p_partkey AS id, CAST(p_partkey * 37 % 1000 AS DOUBLE) AS x, CAST(p_partkey * 91 % 1000 AS DOUBLE) AS y FROM part), c AS (SELECT c_custkey AS id, CAST(c_custkey * 53 % 1000 AS DOUBLE) AS x, CAST(c_custkey * 29 % 1000 AS DOUBLE) AS y FROM customer),
p AS (SELECT n.id AS l_id, c.id AS r_id, sqrt(pow(n.x - c.x, 2) + pow(n.y - c.y, 2)) AS d FROM n JOIN c ON abs(n.x - c.x) <= 20 AND abs(n.y - c.y) <= 20),
a AS (SELECT l_id, r_id FROM p WHERE d <= 20 AND r_id % 3 = 0 QUALIFY row_number() OVER (PARTITION BY l_id ORDER BY d, r_id) = 1), b AS (SELECT l_id, r_id FROM p WHERE d <= 10 AND l_id NOT IN (SELECT l_id FROM a) QUALIFY row_number() OVER (PARTITION BY l_id ORDER BY d, r_id) = 1)
SELECT l_id, r_id, 1 AS step FROM a UNION ALL SELECT l_id, r_id, 2 FROM b""",
)
def e16(spark, sf):
    from ..operators.generate import face_road

    c = places(spark, sf, "r")
    return face_road(nodes(spark, sf, "l"), c.where("r_id % 3 = 0"), c).select("l_id", "r_id", "step")


@query(
    "f06_clip_to_segment",
    """WITH v AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 2) SELECT k AS lane_id, TRUE AS inside FROM v""",
)
def f06(spark, sf):
    l = lines(spark, sf).select(F.col("line_id").alias("lane_id"), F.col("line_id").alias("segment"), "line")
    s = l.select("segment", G.start(F.col("line"))["x"].alias("sx"), G.start(F.col("line"))["y"].alias("sy"), G.end(F.col("line"))["x"].alias("ex"), G.end(F.col("line"))["y"].alias("ey"))
    cut = D.clip_to_segment(l, s).join(l, "lane_id")
    return cut.select("lane_id", ((F.col("from_m") >= 0) & (F.col("to_m") <= G.length(F.col("line")) + 1e-6)).alias("inside"))
