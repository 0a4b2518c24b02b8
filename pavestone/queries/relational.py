"""Aggregations, windows and networks over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import aggregates as A
from ..operators import network as R
from ..operators import windows as W
from ..operators.components import connected_components
from ..operators.spatial import first_per
from ..registry import query, table


@query(
    "a01_dominant",
    """WITH s AS (SELECT o_custkey, o_orderpriority, sum(round(o_totalprice * 100)::BIGINT) AS w FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY w DESC, o_orderpriority) AS k FROM s) SELECT o_custkey, o_orderpriority, CAST(w AS BIGINT) AS weight FROM r WHERE k = 1""",
)
def a01(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("long").alias("w"))
    return A.dominant(o, "o_custkey", "o_orderpriority", "w").withColumn("weight", F.col("weight").cast("long"))


@query(
    "a02_winner_row",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1""",
)
def a02(spark, sf):
    return A.winner_row(table(spark, sf, "orders"), ["o_custkey"], [-F.col("o_totalprice"), F.col("o_orderkey")], ["o_orderkey", "o_orderpriority"])


@query(
    "a03_weighted_median",
    """WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, round(o_totalprice * 100)::BIGINT AS w FROM orders),
c AS (SELECT *, sum(w) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY o_custkey) AS total FROM o)
SELECT o_custkey, min(o_orderdate) AS o_orderdate FROM c WHERE run * 2 >= total GROUP BY o_custkey""",
)
def a03(spark, sf):
    o = table(spark, sf, "orders").withColumn("w", F.round(F.col("o_totalprice") * 100).cast("long"))
    return A.weighted_median(o, "o_custkey", "o_orderdate", "w", "o_orderkey")


@query(
    "a04_filtered",
    """SELECT o_custkey, coalesce(max(o_orderkey) FILTER (o_orderstatus = 'F'), max(o_orderkey)) AS best, bool_or(o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderstatus = 'O') AS n_open FROM orders GROUP BY o_custkey""",
)
def a04(spark, sf):
    finished = F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.coalesce(finished, F.max("o_orderkey")).alias("best"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))


@query(
    "a05_vertex_degree",
    """WITH v AS (SELECT l_partkey AS x, l_suppkey AS y, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT x, y, CAST(sum(CASE WHEN i = 1 OR i = n THEN 1 ELSE 2 END) AS BIGINT) AS degree FROM v WHERE n >= 2 GROUP BY x, y""",
)
def a05(spark, sf):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    l = table(spark, sf, "lineitem")
    n = l.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    v = l.withColumn("i", F.row_number().over(w)).join(n, "l_orderkey").where("n >= 2")
    return A.vertex_degree(v.select(F.col("l_partkey").alias("x"), F.col("l_suppkey").alias("y"), ((F.col("i") > 1) & (F.col("i") < F.col("n"))).alias("inner")))


@query(
    "a06_circular_mean",
    """WITH a AS (SELECT o_custkey, o_orderkey, o_orderkey * 7 % 360 AS d FROM orders), f AS (SELECT o_custkey, arg_min(d, o_orderkey) AS ref, count(*) AS n FROM a GROUP BY 1),
t AS (SELECT a.o_custkey, ref, n, radians(CASE WHEN least((d - ref + 360) % 360, 360 - (d - ref + 360) % 360) > 90 THEN d + 180 ELSE d END) AS r FROM a JOIN f USING (o_custkey)),
m AS (SELECT o_custkey, any_value(n) AS n, any_value(ref) AS ref, avg(sin(r)) AS s, avg(cos(r)) AS c FROM t GROUP BY 1)
SELECT o_custkey, round(sin(radians(CASE WHEN n = 1 THEN ref ELSE degrees(atan2(s, c)) END)), 6) + 0.0 AS sine FROM m WHERE n = 1 OR s * s + c * c > 1e-6""",
)
def a06(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") * 7 % 360).cast("double").alias("d"))
    return A.circular_mean(o, "o_custkey", "d", "o_orderkey").select("o_custkey", (F.round(F.sin(F.radians("angle")), 6) + 0.0).alias("sine"))


@query(
    "a09_covered",
    """WITH l AS (SELECT o_custkey, sum(o_totalprice % 500) AS total FROM orders GROUP BY 1), p AS (SELECT o_custkey, sum(o_totalprice % 500) AS explicit FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
n AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT l.o_custkey, round(coalesce(explicit, 0) + greatest(coalesce(n, 0) - 1, 0) * 2.0, 4) AS covered FROM l LEFT JOIN p USING (o_custkey) LEFT JOIN n USING (o_custkey)""",
)
def a09(spark, sf):
    o = table(spark, sf, "orders").withColumn("length", F.col("o_totalprice") % 500)
    lines = o.groupBy("o_custkey").agg(F.sum("length").alias("total"))
    out = A.covered(lines, o.where("o_orderstatus = 'F'").select("o_custkey", "length"), o.where("o_orderstatus = 'O'").select("o_custkey"), 2.0, 1 / 3, "o_custkey")
    return out.select("o_custkey", F.round("covered", 4).alias("covered"))


@query(
    "a11_allocate",
    """WITH s AS (SELECT o_custkey, o_orderkey, round(o_totalprice * 100)::BIGINT AS w, o_custkey % 17 AS t FROM orders)
SELECT o_orderkey, CAST(round(t * w / sum(w) OVER (PARTITION BY o_custkey)::DOUBLE) AS INTEGER) AS share FROM s""",
)
def a11(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("w"), (F.col("o_custkey") % 17).alias("t"))
    return A.allocate(o, "o_custkey", "t", "w").select("o_orderkey", "share")


@query(
    "a12_capacity",
    """WITH t AS (SELECT o_orderkey AS k, o_totalprice % 100 AS len, ['parallel', 'diagonal', 'perpendicular'][CAST(o_orderkey % 3 + 1 AS INTEGER)] AS w, o_orderkey % 5 = 0 AS bus FROM orders)
SELECT k, CAST(floor(CASE WHEN bus THEN CASE w WHEN 'parallel' THEN len / 12 WHEN 'diagonal' THEN (len + 5 - (sqrt(2.5 * 0.5 * 2.5) + sqrt(12 * 0.5 * 12))) / 5 ELSE (len + 4 - 2.5) / 4 END
 ELSE CASE w WHEN 'parallel' THEN (len + 5.2 - 4.4) / 5.2 WHEN 'diagonal' THEN (len + 3.1 - (sqrt(1.8 * 0.5 * 1.8) + sqrt(4.4 * 0.5 * 4.4))) / 3.1 ELSE (len + 2.5 - 1.8) / 2.5 END END) AS INTEGER) AS capacity FROM t""",
)
def a12(spark, sf):
    k = F.col("o_orderkey")
    way = F.when(k % 3 == 0, "parallel").when(k % 3 == 1, "diagonal").otherwise("perpendicular")
    return table(spark, sf, "orders").select(k.alias("k"), A.capacity(F.col("o_totalprice") % 100, way, k % 5 == 0).alias("capacity"))


@query(
    "a13_conflicts",
    """SELECT user_id, string_agg(DISTINCT event_type || '=' || CAST(CAST(floor(value) AS BIGINT) % 3 AS VARCHAR), '; ' ORDER BY event_type || '=' || CAST(CAST(floor(value) AS BIGINT) % 3 AS VARCHAR)) AS conflicts FROM events GROUP BY user_id""",
)
def a13(spark, sf):
    return A.conflicts(table(spark, sf, "events"), "user_id", F.concat("event_type", F.lit("="), (F.floor("value") % 3).cast("string")))


@query(
    "a16_collect_line",
    """SELECT o_custkey, array_to_string(list(o_orderkey ORDER BY o_orderdate, o_orderkey), ',') AS path FROM orders GROUP BY o_custkey""",
)
def a16(spark, sf):
    v = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey")))
    return table(spark, sf, "orders").groupBy("o_custkey").agg(v.alias("v")).select("o_custkey", F.array_join(F.transform("v", lambda p: p["o_orderkey"].cast("string")), ",").alias("path"))


@query(
    "a17_class_difference",
    """WITH p AS (SELECT p_brand AS class, p_partkey % 256 AS a_r, p_size * 5 % 256 AS a_g, p_partkey * 3 % 256 AS a_b FROM part)
SELECT class, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share FROM p GROUP BY class""",
)
def a17(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    px = table(spark, sf, "part").select(F.col("p_brand").alias("class"), (k % 256).alias("a_r"), (s * 5 % 256).alias("a_g"), (k * 3 % 256).alias("a_b"), (s * 4 % 256).alias("b_r"), (k * 7 % 256).alias("b_g"), F.lit(128).alias("b_b"))
    return A.class_difference(px).select("class", "n", F.round("share", 6).alias("share"))


@query(
    "a19_tile_difference",
    """WITH t AS (SELECT p_brand AS tile, greatest(abs(p_partkey % 256 - p_size * 5 % 256), abs(p_size % 100 - p_partkey % 100), 3) AS d FROM part)
SELECT tile, round(avg(d), 6) AS mean_difference, round(avg(CASE WHEN d > 12 THEN 1.0 ELSE 0.0 END), 6) AS share_above FROM t GROUP BY tile""",
)
def a19(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    base = table(spark, sf, "part").select(F.col("p_brand").alias("tile"), k.alias("px"), s.alias("py"))
    a = base.select("*", (F.col("px") % 256).alias("r"), (F.col("py") % 100).alias("g"), F.lit(3).alias("b"))
    b = base.select("*", (F.col("py") * 5 % 256).alias("r"), (F.col("px") % 100).alias("g"), F.lit(0).alias("b"))
    return A.tile_difference(a, b).select("tile", F.round("mean_difference", 6).alias("mean_difference"), F.round("share_above", 6).alias("share_above"))


@query("a18_counts", "SELECT event_type, CAST(user_id % 10 AS BIGINT) AS source, count(*) AS n FROM events GROUP BY ALL")
def a18(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", (F.col("user_id") % 10).alias("source")).agg(F.count(F.lit(1)).alias("n"))


RING = "SELECT DISTINCT user_id, event_id % 24 + 1 AS idx FROM events"


def ring(spark, sf):
    return table(spark, sf, "events").select("user_id", (F.col("event_id") % 24 + 1).alias("idx")).distinct()


@query(
    "w01_first_per_key",
    "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS k FROM events) WHERE k = 1",
)
def w01(spark, sf):
    return first_per(table(spark, sf, "events"), ["user_id", "event_type"], [F.desc("ts"), "event_id"]).select("user_id", "event_id", "event_type")


@query(
    "w02_runs",
    """WITH e AS (SELECT o_custkey, o_orderkey, o_orderkey * 7 % 360 AS d FROM orders), l AS (SELECT *, lag(d) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM e)
SELECT o_custkey, o_orderkey, CAST(coalesce(sum(CASE WHEN least((d - p + 360) % 360, 360 - (d - p + 360) % 360) > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS run FROM l""",
)
def w02(spark, sf):
    from ..functions.geometry import angle_difference

    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") * 7 % 360).cast("double").alias("d"))
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return W.runs(o, "o_custkey", "o_orderkey", angle_difference(F.col("d"), F.lag("d").over(w)) > 30).select("o_custkey", "o_orderkey", "run")


@query(
    "w03_cyclic_lag",
    f"""WITH r AS ({RING}) SELECT user_id, idx, coalesce(lag(idx) OVER (PARTITION BY user_id ORDER BY idx), max(idx) OVER (PARTITION BY user_id)) AS previous FROM r""",
)
def w03(spark, sf):
    return W.cyclic_lag(ring(spark, sf), "user_id", "idx", "idx")


_CHAINS = f"""r AS (SELECT * FROM ({RING}) WHERE (user_id + idx) % 3 <> 0),
g AS (SELECT *, coalesce(idx - lag(idx) OVER (PARTITION BY user_id ORDER BY idx), idx + 24 - max(idx) OVER (PARTITION BY user_id)) AS gap FROM r),
s AS (SELECT user_id, arg_min(idx, (-gap, idx)) AS start FROM g GROUP BY user_id),
t AS (SELECT g.*, (idx - start + 24) % 24 AS turn FROM g JOIN s USING (user_id)),
c AS (SELECT user_id, idx, row_number() OVER (PARTITION BY user_id ORDER BY turn) AS position,
 CAST(1 + sum(CASE WHEN gap > 1 AND turn > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chain FROM t)"""


def _chains(spark, sf):
    r = ring(spark, sf).where("(user_id + idx) % 3 <> 0").withColumn("n", F.lit(24))
    return W.ring_chains(r, "user_id", "idx", "n").select("user_id", "idx", F.col("position").cast("long").alias("position"), "chain")


@query("w04_ring_chains", f"WITH {_CHAINS} SELECT user_id, idx, position, chain FROM c")
def w04(spark, sf):
    return _chains(spark, sf)


@query(
    "w05_anchored_chains",
    f"""WITH {_CHAINS}, a AS (SELECT DISTINCT user_id, chain FROM c WHERE idx % 5 = 0), n AS (SELECT *, dense_rank() OVER (PARTITION BY user_id ORDER BY chain) AS chain_no FROM a)
SELECT user_id, idx, CAST(chain_no AS INTEGER) AS chain_no FROM c JOIN n USING (user_id, chain)""",
)
def w05(spark, sf):
    c = _chains(spark, sf)
    return W.anchored_chains(c, c.where("idx % 5 = 0"), "user_id", "idx").select("user_id", "idx", "chain_no")


@query(
    "w08_consecutive_pairs",
    "SELECT o_custkey, o_orderkey AS a, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS b FROM orders QUALIFY b IS NOT NULL",
)
def w08(spark, sf):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("a"), F.lead("o_orderkey").over(w).alias("b")).where("b is not null")


@query(
    "w10_number_parts",
    "SELECT l_orderkey, l_partkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS INTEGER) AS part_index FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)",
)
def w10(spark, sf):
    return W.number_parts(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey").distinct(), "l_orderkey", "l_partkey")


@query(
    "w11_drop_prefix_before",
    """WITH e AS (SELECT user_id, event_id, CASE event_id % 5 WHEN 0 THEN 'bad' WHEN 1 THEN 'good' WHEN 2 THEN 'good' END AS k FROM events)
SELECT user_id, event_id FROM (SELECT *, first_value(k IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt FROM e) WHERE nxt IS DISTINCT FROM 'bad'""",
)
def w11(spark, sf):
    k = F.col("event_id") % 5
    return W.drop_prefix_before(table(spark, sf, "events"), "user_id", "event_id", k >= 3, k == 0).select("user_id", "event_id")


# every row links its order with a group of three orders, or with the next group: components are chains of groups
_EDGES = "SELECT DISTINCT l_orderkey AS a, 1000000000 + l_orderkey // 3 + CASE WHEN l_linenumber = 7 AND l_partkey % 4 = 0 THEN 1 ELSE 0 END AS b FROM lineitem"


@query(
    "r01_components",
    f"""WITH RECURSIVE e AS ({_EDGES}), u AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), c(n, m) AS (SELECT x, x FROM u UNION SELECT u.y, c.m FROM c JOIN u ON u.x = c.n)
SELECT n AS node, min(m) AS component FROM c GROUP BY n""",
)
def r01(spark, sf):
    k = F.col("l_orderkey")
    group = F.lit(1000000000) + F.floor(k / 3) + F.when((F.col("l_linenumber") == 7) & (F.col("l_partkey") % 4 == 0), 1).otherwise(0)
    return connected_components(table(spark, sf, "lineitem").select(k.cast("long").alias("a"), group.cast("long").alias("b")).distinct())


@query("r01_components_whole")
def r01_whole(spark, sf):
    """One large component: orders and suppliers (as -1 - key) of all rows."""
    l = table(spark, sf, "lineitem")
    return connected_components(l.select(F.col("l_orderkey").alias("a"), (-1 - F.col("l_suppkey")).alias("b")).distinct())


@query(
    "r02_road_segments",
    """WITH RECURSIVE ends AS (SELECT c_custkey AS seg, c_custkey % 300 AS x, 0 AS y FROM customer UNION ALL SELECT c_custkey, c_custkey * 7 % 300, 0 FROM customer),
j AS (SELECT x, y FROM ends GROUP BY x, y HAVING count(*) > 9), m AS (SELECT * FROM ends WHERE (x, y) NOT IN (SELECT x, y FROM j)),
c(s, r) AS (SELECT seg, seg FROM m UNION SELECT b.seg, c.r FROM c JOIN m a ON a.seg = c.s JOIN m b ON a.x = b.x AND a.y = b.y)
SELECT seg, coalesce(min(r), seg) AS chain FROM (SELECT DISTINCT seg FROM ends) LEFT JOIN c ON c.s = seg GROUP BY seg""",
)
def r02(spark, sf):
    k = F.col("c_custkey")
    ends = table(spark, sf, "customer").select(k.alias("seg"), F.explode(F.array(k % 300, k * 7 % 300)).alias("x"), F.lit(0).alias("y"))
    return R.road_segments(ends, ends.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 9"))


@query(
    "r03_chain_order",
    """SELECT c_custkey AS node, c_custkey - c_custkey % 50 AS head, c_custkey % 50 AS place FROM customer WHERE c_custkey < (SELECT max(c_custkey) - max(c_custkey) % 50 FROM customer)""",
)
def r03(spark, sf):
    c = table(spark, sf, "customer")
    top = c.agg((F.max("c_custkey") - F.max("c_custkey") % 50).alias("top"))
    links = c.crossJoin(F.broadcast(top)).where("c_custkey % 50 < 49 and c_custkey < top").select(F.col("c_custkey").alias("node"), (F.col("c_custkey") + 1).alias("next"))
    return R.chain_order(links)


_CANDIDATES = "SELECT DISTINCT l_partkey AS a, l_suppkey AS b, abs(l_partkey % 100 - l_suppkey) AS d, l_partkey % 2 AS p FROM lineitem"


@query(
    "r04_matching",
    f"""WITH c AS ({_CANDIDATES}), f AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS k FROM c), g AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY p, d, a) AS q FROM f WHERE k = 1),
m AS (SELECT a, b FROM g WHERE q = 1), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS z FROM c WHERE a NOT IN (SELECT a FROM m) AND b NOT IN (SELECT b FROM m))
SELECT a, b, 1 AS pass FROM m UNION ALL SELECT a, b, 3 FROM r WHERE z = 1""",
)
def r04(spark, sf):
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    c = table(spark, sf, "lineitem").select(p.alias("a"), s.alias("b"), F.abs(p % 100 - s).alias("d"), (p % 2).alias("p")).distinct()
    return R.match_one_to_one(c, "a", "b", ["d"], ["p", "d"])


@query(
    "r05_prev_next",
    """WITH m AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem)
SELECT s_suppkey AS n, (SELECT min(b) FROM m WHERE a = s_suppkey) AS next_id, (SELECT min(a) FROM m WHERE b = s_suppkey) AS prev_id FROM supplier""",
)
def r05(spark, sf):
    m = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b")).distinct()
    return R.link_prev_next(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("n")), m, "n", "a", "b")


@query(
    "r06_through_pairs",
    """WITH e AS (SELECT o_custkey AS node, o_orderkey AS seg, o_orderkey * 7 % 360 AS d FROM orders), n AS (SELECT node, count(*) AS n FROM e GROUP BY 1),
p AS (SELECT l.node, n, l.seg AS a, r.seg AS b, least((l.d - r.d + 540) % 360, 360 - (l.d - r.d + 540) % 360) AS off FROM e l JOIN e r ON l.node = r.node AND l.seg <> r.seg JOIN n ON n.node = l.node),
k AS (SELECT node, a, arg_min(b, (off, b)) AS b FROM p WHERE n > 2 AND off <= 25 GROUP BY node, a)
SELECT node, a, b FROM p WHERE n = 2 AND a < b UNION ALL SELECT x.node, x.a, x.b FROM k x JOIN k y ON x.node = y.node AND x.a = y.b AND x.b = y.a WHERE x.a < x.b""",
)
def r06(spark, sf):
    return R.through_pairs(table(spark, sf, "orders").select(F.col("o_custkey").alias("node"), F.col("o_orderkey").alias("seg"), (F.col("o_orderkey") * 7 % 360).cast("double").alias("degrees")))


@query(
    "r07_merge_clusters",
    """WITH RECURSIVE p AS (SELECT o_orderkey AS a, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders), e AS (SELECT * FROM p WHERE b IS NOT NULL AND (a + b) % 3 <> 0),
u AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), c(n, m) AS (SELECT x, x FROM u UNION SELECT u.y, c.m FROM c JOIN u ON u.x = c.n),
k AS (SELECT n, min(m) AS m FROM c GROUP BY n), r AS (SELECT o.*, coalesce(k.m, o_orderkey) AS cluster FROM orders o LEFT JOIN k ON k.n = o_orderkey)
SELECT cluster, arg_min(o_orderpriority, (-o_totalprice, o_orderkey)) AS o_orderpriority, count(*) AS members, min(o_orderstatus) <> max(o_orderstatus) AS mixed FROM r GROUP BY cluster""",
)
def r07(spark, sf):
    o = table(spark, sf, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    pairs = o.select(F.col("o_orderkey").alias("a"), F.lead("o_orderkey").over(w).alias("b")).where("b is not null and (a + b) % 3 <> 0")
    rows = o.withColumn("rank", -F.col("o_totalprice"))
    return R.merge_clusters(rows, pairs, "o_orderkey", ["rank", "o_orderkey"], ["o_orderpriority"], "o_orderstatus")


@query(
    "f14_merge_lines",
    """WITH e AS (SELECT c_custkey AS edge_id, c_custkey AS a, c_custkey + 1 AS b, c_mktsegment AS style, lag(c_mktsegment) OVER (ORDER BY c_custkey) IS DISTINCT FROM c_mktsegment AS new FROM customer),
n AS (SELECT *, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (ORDER BY edge_id) AS g FROM e)
SELECT edge_id, min(edge_id) OVER (PARTITION BY g) AS line, edge_id - min(edge_id) OVER (PARTITION BY g) AS place FROM n""",
)
def f14(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("edge_id"), F.col("c_custkey").alias("a"), (F.col("c_custkey") + 1).alias("b"), F.col("c_mktsegment").alias("style"))
    return R.merge_lines(c, ["style"])
