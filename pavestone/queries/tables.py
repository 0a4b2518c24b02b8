"""Sources, sinks and checks over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as Q
from ..registry import query, table
from ..sources import tables as S


def _places(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k, (k % 360 - 180).cast("double").alias("x"), (k * 7 % 180 - 90).cast("double").alias("y"), F.col("c_mktsegment").alias("source"), "c_acctbal")


@query("s05_within_bbox", "SELECT c_custkey FROM customer WHERE c_custkey % 360 - 180 BETWEEN -20 AND 60 AND c_custkey * 7 % 180 - 90 BETWEEN 10 AND 55")
def s05(spark, sf):
    return S.within_bbox(_places(spark, sf), (-20, 10, 60, 55)).select("c_custkey")


@query("s07_feature_lines", """SELECT c_custkey, '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (c_custkey % 360 - 180) || '.0,' || (c_custkey * 7 % 180 - 90) || '.0]},"properties":{"c_custkey":' || c_custkey || ',"source":"' || c_mktsegment || '"}}' AS line FROM customer""")
def s07(spark, sf):
    return S.feature_lines(_places(spark, sf), "c_custkey", ["c_custkey", "source"])


@query(
    "s09_replace_by_source",
    "SELECT c_custkey, c_mktsegment AS source FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') UNION ALL SELECT p_partkey, 'BUILDING' FROM part WHERE p_size > 40",
)
def s09(spark, sf):
    new = table(spark, sf, "part").where("p_size > 40").select(F.col("p_partkey").alias("c_custkey"), F.lit("BUILDING").alias("source"))
    return S.replace_by_source(_places(spark, sf).select("c_custkey", "source"), new, ["BUILDING", "MACHINERY"])


@query("s13_publish", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_mktsegment AS VARCHAR) AS source FROM customer")
def s13(spark, sf):
    return S.publish(_places(spark, sf), {"c_custkey": "string", "source": "string"})


@query(
    "s14_combined_extent",
    "WITH a AS (SELECT c_custkey % 360 - 180.0::DOUBLE AS x, c_custkey * 7 % 180 - 90.0::DOUBLE AS y FROM customer UNION ALL SELECT p_size * 5.0::DOUBLE, -p_size * 1.0::DOUBLE FROM part) SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM a",
)
def s14(spark, sf):
    p = table(spark, sf, "part").select((F.col("p_size") * 5).cast("double").alias("x"), (-F.col("p_size")).cast("double").alias("y"))
    return S.combined_extent(_places(spark, sf), p)


@query(
    "s04_exclude_hidden",
    "SELECT event_id FROM events WHERE CASE event_id % 4 WHEN 0 THEN FALSE WHEN 1 THEN event_type = 'click' ELSE TRUE END",
)
def s04(spark, sf):
    k = F.col("event_id") % 4
    pairs = F.create_map(F.lit("location"), F.when(k == 0, "underground"), F.lit("indoor"), F.when(k == 1, F.when(F.col("event_type") == "click", "no").otherwise("yes")))
    return S.exclude_hidden(table(spark, sf, "events").select("event_id", F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("tags"))).select("event_id")


@query(
    "s01_tags_from_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL",
)
def s01(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.from_json("props", "map<string,string>").alias("tags"))
    return e.where(F.map_contains_key("tags", "k")).select("event_id", F.col("tags")["k"].cast("int").alias("k"))


@query(
    "q01_conflicting_tags",
    """WITH p AS (SELECT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'zebra' ELSE 'marked' END AS a, CASE WHEN o_orderkey % 3 = 0 THEN 'zebra' ELSE 'marked' END AS b FROM orders)
SELECT o_custkey, string_agg(DISTINCT 'crossing: ' || a || ' / ' || b, '; ' ORDER BY 'crossing: ' || a || ' / ' || b) AS conflicts FROM p WHERE a <> b GROUP BY o_custkey""",
)
def q01(spark, sf):
    k = F.col("o_orderkey")
    tag = lambda m: F.create_map(F.lit("crossing"), F.when(k % m == 0, "zebra").otherwise("marked"))
    return Q.conflicting_tags(table(spark, sf, "orders").select("o_custkey", tag(2).alias("a"), tag(3).alias("b")), "o_custkey", ["crossing"])


@query(
    "q01_mapping_issues",
    """WITH n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'zebra' ELSE 'marked' END AS c, CASE WHEN c_custkey % 3 > 0 THEN 'yes' END AS m FROM customer),
p AS (SELECT o_custkey AS id, o_orderkey AS path_id, o_orderkey % 4 < 2 AS is_crossing, CASE WHEN o_orderkey % 3 = 0 THEN 'zebra' WHEN o_orderkey % 3 = 1 THEN 'marked' END AS c, CASE WHEN o_orderkey % 5 = 0 THEN 'no' END AS m FROM orders),
b AS (SELECT id, path_id, is_crossing, n.c AS nc, n.m AS nm, p.c AS pc, p.m AS pm FROM n JOIN p USING (id)),
i AS (SELECT 'critical' AS severity, id AS element_id, path_id, concat_ws('; ', CASE WHEN nc <> pc THEN 'crossing: ' || nc || ' / ' || pc END, CASE WHEN nm <> pm THEN 'crossing:markings: ' || nm || ' / ' || pm END) AS issue FROM b WHERE is_crossing
UNION ALL SELECT 'warning', id, path_id, concat_ws('; ', CASE WHEN pc IS NOT NULL THEN 'crossing' END, CASE WHEN pm IS NOT NULL THEN 'crossing:markings' END) FROM b WHERE NOT is_crossing)
SELECT * FROM i WHERE issue <> ''""",
)
def q01_issues(spark, sf):
    """Crossing nodes and the paths through them: conflicts with crossing paths, and paths that only look like one."""
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    tags = lambda kind, marks: F.map_filter(F.create_map(F.lit("crossing"), kind, F.lit("crossing:markings"), marks), lambda k, v: v.isNotNull())
    nodes = table(spark, sf, "customer").select(c.alias("node_id"), tags(F.when(c % 2 == 0, "zebra").otherwise("marked"), F.when(c % 3 > 0, "yes")).alias("tags"))
    paths = table(spark, sf, "orders").select(F.col("o_custkey").alias("node_id"), o.alias("path_id"), F.when(o % 4 < 2, "crossing").alias("class"), tags(F.when(o % 3 == 0, "zebra").when(o % 3 == 1, "marked"), F.when(o % 5 == 0, "no")).alias("tags"))
    return Q.mapping_issues(nodes, paths, ["crossing", "crossing:markings"])


@query(
    "q05_combinations",
    "SELECT lang, source, coalesce(lang, '') = 'en' AS expected, source IN ('src0', 'src1', 'src5') AS actual, count(*) AS n FROM documents GROUP BY ALL HAVING expected IS DISTINCT FROM actual",
)
def q05(spark, sf):
    return Q.combinations(table(spark, sf, "documents"), ["lang", "source"], F.coalesce("lang", F.lit("")) == "en", F.col("source").isin("src0", "src1", "src5"))


@query(
    "q06_compare_runs",
    """WITH b AS (SELECT event_type, user_id % 20 AS u, round(avg(value), 6) AS v FROM events WHERE event_id % 2 = 0 GROUP BY ALL), a AS (SELECT event_type, user_id % 20 AS u, round(avg(value), 6) AS v FROM events WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT coalesce(a.event_type || a.u, b.event_type || b.u) AS class, b.v AS before, a.v AS after, round(a.v - b.v, 5) AS moved FROM a FULL JOIN b ON a.event_type = b.event_type AND a.u = b.u WHERE a.v - b.v IS NULL OR abs(a.v - b.v) >= 0.5""",
)
def q06(spark, sf):
    e = table(spark, sf, "events").withColumn("class", F.concat("event_type", (F.col("user_id") % 20).cast("string")))
    run = lambda r: e.where(F.col("event_id") % 2 == r).groupBy("class").agg(F.round(F.avg("value"), 6).alias("v"))
    return Q.compare_runs(run(0), run(1), "class", "v").withColumn("moved", F.round("moved", 5))


@query("q08_suppressed", "SELECT c_custkey, 'negative' AS reason FROM customer WHERE c_acctbal < 0")
def q08(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return Q.suppressed(c, c.where("c_acctbal >= 0"), "c_custkey", "negative").select("c_custkey", "reason")
