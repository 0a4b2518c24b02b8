"""Rules on tags that other rules use, each by itself, and layers of elements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tags as T
from ..operators import classify as C
from ..operators import lanes as N
from ..registry import query, table
from ..sources.geojson import read_geojson
from ..sources import tables as S
from .derived import _pick, _tags
from .generated import _LANES, _roads


def _sql_pick(values: list, key: str, step: int = 1) -> str:
    lit = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"([{lit}])[CAST({key} // {step} % {len(values)} + 1 AS INTEGER)]"


_WORDS = ["N", "west-north-west", "SSE", "up", "East", None]


@query("p04_cardinal", f"SELECT o_orderkey AS k, CASE {_sql_pick(_WORDS, 'o_orderkey')} WHEN 'N' THEN 0.0 WHEN 'west-north-west' THEN 292.0 WHEN 'SSE' THEN 157.0 WHEN 'East' THEN 90.0 END::DOUBLE AS degrees FROM orders")
def p04(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k.alias("k"), T.cardinal_degrees(_pick(_WORDS, k)).alias("degrees"))


@query(
    "p06_mid_angle",
    """WITH t AS (SELECT o_orderkey AS k, o_orderkey * 7 % 360 AS a, o_orderkey * 13 % 360 AS b FROM orders)
SELECT k, CASE WHEN abs(a - b) > 180 THEN ((a + b) / 2.0 + 180) - CASE WHEN (a + b) / 2.0 + 180 >= 360 THEN 360 ELSE 0 END ELSE (a + b) / 2.0 END::DOUBLE AS mid FROM t""",
)
def p06(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k.alias("k"), T.mid_angle(k * 7 % 360, k * 13 % 360).cast("double").alias("mid"))


_VALUES = ["yes", "no", "", None, "none", "zebra"]


@query("p10_tag_present", f"SELECT p_partkey AS k, coalesce({_sql_pick(_VALUES, 'p_partkey')} NOT IN ('', 'no', 'none'), FALSE) AS present FROM part")
def p10(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("k"), T.tag_present(_pick(_VALUES, k)).alias("present"))


@query(
    "p11_pass_through",
    """SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'red' WHEN p_partkey % 2 = 0 THEN 'blue' END AS colour, CASE p_partkey % 4 WHEN 0 THEN p_size * 1.0 WHEN 1 THEN p_size / 100.0 END::DOUBLE AS width, p_brand AS name FROM part""",
)
def p11(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    t = _tags(("surface:colour", F.when(k % 3 == 0, "red")), ("colour", F.when(k % 2 == 0, "blue")), ("width", F.when(k % 4 == 0, F.concat(size, F.lit(" m"))).when(k % 4 == 1, F.concat(size, F.lit(" cm"))).otherwise("wide")), ("name", F.col("p_brand")))
    s = table(spark, sf, "part").select(k.alias("k"), T.pass_through(t, ["surface:colour", "width", "name"], ["width"]).alias("s"))
    return s.select("k", F.col("s.`surface:colour`").alias("colour"), "s.width", "s.name")


_AMENITY, _PLACE, _USE = ["parking", "parking_space", "motorcycle_parking", "bench"], ["lane", "street_side", "surface", None], ["disabled", "yes", "charging", None, "loading"]


@query(
    "p17_parking_areas",
    f"""WITH t AS (SELECT p_partkey AS k, {_sql_pick(_AMENITY, 'p_partkey')} AS a, {_sql_pick(_PLACE, 'p_partkey', 4)} AS p, {_sql_pick(_PLACE, 'p_partkey', 16)} AS q, {_sql_pick(_USE, 'p_partkey')} AS u, p_partkey % 7 = 0 AS d FROM part),
r AS (SELECT *, CASE WHEN p IN ('lane', 'street_side') THEN p WHEN a = 'motorcycle_parking' AND q IN ('lane', 'street_side') THEN q END AS place FROM t)
SELECT k, CASE a WHEN 'parking_space' THEN a WHEN 'parking' THEN a ELSE 'parking_two_wheel' END AS area_highway, CASE WHEN a = 'parking_space' THEN a ELSE place END AS type,
 CASE WHEN a = 'parking_space' AND u <> 'yes' THEN u END AS class, CASE WHEN a = 'parking_space' THEN CASE WHEN u = 'disabled' OR d THEN 'wheelchair' WHEN u = 'charging' THEN 'charging' WHEN u = 'loading' THEN 'loading' END END AS symbol
FROM r WHERE a = 'parking_space' OR (a <> 'bench' AND place IS NOT NULL)""",
)
def p17(spark, sf):
    k = F.col("p_partkey")
    t = _tags(("amenity", _pick(_AMENITY, k)), ("parking", _pick(_PLACE, F.floor(k / 4))), ("position", _pick(_PLACE, F.floor(k / 16))), ("parking_space", _pick(_USE, k)), ("disabled:conditional", F.when(k % 7 == 0, "designated @ (Mo-Fr)")))
    return table(spark, sf, "part").select(k.alias("k"), T.parking_area(t).alias("a")).where("a is not null").select("k", "a.*")


@query(
    "p19_first_namespace",
    f"SELECT p_partkey AS k, CASE WHEN {_sql_pick(['grass', 'commercial', None], 'p_partkey')} = 'grass' THEN 'grass' WHEN p_partkey % 4 = 1 THEN 'wood' WHEN p_partkey % 5 = 2 THEN 'park' END AS landuse FROM part",
)
def p19(spark, sf):
    k = F.col("p_partkey")
    t = _tags(("landuse", _pick(["grass", "commercial", None], k)), ("natural", F.when(k % 4 == 1, "wood").otherwise("cliff")), ("leisure", F.when(k % 5 == 2, "park")))
    return table(spark, sf, "part").select(k.alias("k"), C.first_in(t, ["landuse", "landcover", "natural", "leisure", "amenity"], ["grass", "wood", "park"]).alias("landuse"))


_COND = ["yes @ (Mo-Fr)", "no @ (Sa); yes@(Su)", "designated @ wet", "yesterday @ x", None]


@query("p23_conditional_has", f"SELECT p_partkey AS k, coalesce(regexp_matches({_sql_pick(_COND, 'p_partkey')}, '(^|;\\s*)yes\\s*@'), FALSE) AS says FROM part")
def p23(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("k"), T.conditional_has(_pick(_COND, k), "yes").alias("says"))


_BUS, _TAXI = ["designated", "no", None], ["no", None, "yes", None]


@query(
    "p25_vehicles",
    f"""WITH t AS (SELECT o_orderkey AS k, {_sql_pick(_BUS, 'o_orderkey')} AS b, {_sql_pick(_TAXI, 'o_orderkey')} AS t, o_orderkey % 5 = 0 AS h, o_orderkey % 11 = 0 AS c FROM orders)
SELECT k, nullif(concat_ws(';', CASE WHEN b = 'designated' THEN 'bus' END, CASE WHEN t = 'yes' THEN 'taxi' END, CASE WHEN h THEN 'hgv' END, CASE WHEN c THEN 'car_sharing' END), '') AS designated,
 nullif(concat_ws(';', CASE WHEN b = 'no' THEN 'bus' END, CASE WHEN t = 'no' THEN 'taxi' END), '') AS excluded FROM t""",
)
def p25(spark, sf):
    k = F.col("o_orderkey")
    t = _tags(("parking:left:bus", _pick(_BUS, k)), ("parking:both:taxi", _pick(_TAXI, k)), ("parking:left:restriction:hgv", F.when(k % 5 == 0, "none")), ("parking:both:car_sharing:conditional", F.when(k % 11 == 0, "designated @ (Mo)")))
    rows = C.parking_conditions(table(spark, sf, "orders").select(k.alias("k"), t.alias("tags"), F.lit("left").alias("side")))
    return rows.select("k", F.col("vehicle_designated").alias("designated"), F.col("vehicle_excluded").alias("excluded"))


@query("p27_drop_token", "SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'a;c' WHEN 1 THEN NULL ELSE 'c' END AS rest FROM part")
def p27(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("k"), T.drop_token(F.when(k % 3 == 0, "a;b;c").when(k % 3 == 1, "b").otherwise("b;c;b"), "b").alias("rest"))


@query("p29_min_zoom", "SELECT o_orderkey AS k, round(16 + ln(120000.0 / (o_totalprice + 1)) / ln(2), 6) AS zoom FROM orders")
def p29(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.round(T.min_zoom(F.col("o_totalprice") + 1, 120000.0), 6).alias("zoom"))


_CLASS, _SUB = ["bench", "post_box", "entrance", "guard_stone", "unknown", "vending_machine"], [None, "backrest_no;x", "PIN Mail", "subway"]


@query(
    "p30_symbols",
    f"""WITH t AS (SELECT p_partkey AS k, {_sql_pick(_CLASS, 'p_partkey')} AS c, {_sql_pick(_SUB, 'p_partkey', 6)} AS s, CASE WHEN p_partkey % 5 <> 0 THEN p_size * 1.0 END::DOUBLE AS d FROM part)
SELECT k, CASE c WHEN 'bench' THEN CASE WHEN s LIKE '%backrest_no%' THEN 'icon-amenity-bench-backrest-no' ELSE 'icon-amenity-bench' END WHEN 'post_box' THEN CASE WHEN s = 'PIN Mail' THEN 'icon-amenity-post-box-yellow' ELSE 'icon-amenity-post-box-green' END
  WHEN 'entrance' THEN CASE WHEN s = 'subway' THEN 'icon-public-transport-subway' END WHEN 'guard_stone' THEN 'marker-guard-stone' WHEN 'vending_machine' THEN 'marker-vending-machine' END AS symbol,
 CASE c WHEN 'bench' THEN 1.7 WHEN 'post_box' THEN 1.2 WHEN 'entrance' THEN CASE WHEN s = 'subway' THEN 2.0 ELSE 1.6 END WHEN 'guard_stone' THEN 0.8 WHEN 'vending_machine' THEN 0.5 ELSE 1.6 END::DOUBLE AS size,
 CASE c WHEN 'bench' THEN coalesce(d - 180, 0) WHEN 'guard_stone' THEN coalesce(d, 0) - 90 WHEN 'vending_machine' THEN coalesce(d, 0) + 90 ELSE 0 END::DOUBLE AS rotation FROM t""",
)
def p30(spark, sf):
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(k.alias("k"), _pick(_CLASS, k).alias("class"), _pick(_SUB, F.floor(k / 6)).alias("subclass"), F.when(k % 5 != 0, F.col("p_size").cast("double")).alias("direction"))
    return T.symbolise(rows).select("k", "symbol", "size", "rotation")


@query("p33_sign_size", "SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 2.0 ELSE 1.2 END::DOUBLE AS width, CASE WHEN p_partkey % 4 = 0 THEN 5.0 ELSE CASE WHEN p_partkey % 3 = 0 THEN 2.0 ELSE 1.2 END * 2.5 END::DOUBLE AS length FROM part")
def p33(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("k"), T.sign_size(F.when(k % 3 == 0, 2.0), F.when(k % 4 == 0, 5.0), 1.2, 2.5).alias("s")).select("k", "s.width", "s.length")


@query("p34_stratum", "SELECT p_partkey AS k, CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE least(greatest(p_partkey % 13 - 6, -2), 3) END AS stratum FROM part")
def p34(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("k"), T.stratum(F.when(k % 6 != 0, k % 13 - 6)).alias("stratum"))


@query("p36_shade_length", "SELECT p_partkey AS k, round(0.5::DOUBLE + 4.5::DOUBLE * (1 - exp(-p_size / 20.0::DOUBLE)), 8) AS reach FROM part")
def p36(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.round(T.shade_length(F.col("p_size"), 0.5, 5.0, 20.0), 8).alias("reach"))


@query("p38_carriageway", f"SELECT p_partkey AS k FROM part WHERE {_sql_pick(['road', 'path', 'service', None, 'motorway'], 'p_partkey')} IN ('road', 'motorway', 'service')")
def p38(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").where(C.is_carriageway(_pick(["road", "path", "service", None, "motorway"], k))).select(k.alias("k"))


_CROSS, _MARK = ["zebra", "traffic_signals", "unmarked", None, "marked"], ["ladder:skewed", "dots", "no", "surface", None, "lines:paired", "pictograms"]


@query(
    "p39_crossing_kind",
    f"""WITH t AS (SELECT o_orderkey AS k, {_sql_pick(_CROSS, 'o_orderkey')} AS c, {_sql_pick(_MARK, 'o_orderkey', 5)} AS m, o_orderkey % 3 = 0 AS b FROM orders),
f AS (SELECT *, coalesce(c = 'zebra', FALSE) AS z, coalesce(c = 'zebra' OR m LIKE 'ladder%' OR m LIKE 'pictograms%', FALSE) OR coalesce(c = 'zebra', FALSE) OR coalesce(m LIKE 'ladder%' OR m LIKE 'pictograms%', FALSE) AS along,
 coalesce(c IN ('traffic_signals', 'marked', 'zebra'), FALSE) OR coalesce(m NOT IN ('no', 'surface'), FALSE) AS signed FROM t)
SELECT k, CASE WHEN along THEN 'centerline' WHEN b AND NOT signed THEN 'side' WHEN (signed OR b) AND m IS DISTINCT FROM 'surface' THEN 'edge' END AS kind,
 CASE WHEN z THEN 'zebra' WHEN m LIKE 'ladder%' THEN 'ladder' WHEN m LIKE 'pictograms%' THEN 'pictograms' WHEN m = 'dots' THEN 'dots' WHEN m = 'lines:paired' THEN 'double_solid' WHEN c IN ('traffic_signals', 'marked') THEN 'dashed' END AS stroke FROM f""",
)
def p39(spark, sf):
    k = F.col("o_orderkey")
    m = _pick(_MARK, F.floor(k / 5))
    kind = T.crossing_kind(_pick(_CROSS, k), F.lit(None).cast("string"), m, F.when(k % 3 == 0, "both"), F.coalesce(m == "surface", F.lit(False)))
    return table(spark, sf, "orders").select(k.alias("k"), kind.alias("c")).select("k", "c.kind", "c.stroke")


@query("g30_normal_degrees", "SELECT o_orderkey AS k, CAST((CAST(round(o_totalprice % 1000 - 500) AS INTEGER) % 360 + 360) % 360 AS INTEGER) AS degrees FROM orders")
def g30(spark, sf):
    from ..functions.geometry import normal_degrees

    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), normal_degrees(F.col("o_totalprice") % 1000 - 500).alias("degrees"))


# ---- lanes ----

_HW = ["primary", "service", "cycleway", "construction", "footway", "residential"]


@query(
    "l09_needs_lanes",
    f"""WITH t AS (SELECT o_orderkey AS k, {_sql_pick(_HW, 'o_orderkey')} AS h, o_orderkey % 5 = 0 AS link, o_orderkey % 7 = 0 AS turn, o_orderkey % 4 = 3 AS built FROM orders),
v AS (SELECT *, CASE WHEN h = 'construction' AND built THEN 'secondary' ELSE h END AS e FROM t)
SELECT k FROM v WHERE (e IN ('primary', 'secondary', 'residential', 'cycleway') OR turn) AND NOT (e = 'cycleway' AND link)""",
)
def l09(spark, sf):
    k = F.col("o_orderkey")
    t = _tags(("highway", _pick(_HW, k)), ("cycleway", F.when(k % 5 == 0, "link")), ("turn:lanes:forward", F.when(k % 7 == 0, "left|through")), ("construction", F.when(k % 4 == 3, "secondary")), ("turn:lanes", F.when(k % 3 == 0, "none")))
    return table(spark, sf, "orders").where(T.needs_lanes(t, C.TYPES["motorway"] + C.TYPES["road"])).select(k.alias("k"))


@query(
    "l02_lane_totals",
    f"""WITH {_LANES} SELECT k AS line_id, CAST(fwd AS INTEGER) AS forward, CAST(CASE WHEN k % 6 = 0 THEN 1 WHEN k % 4 = 1 THEN 2 ELSE 0 END AS INTEGER) AS bus, CAST(CASE WHEN k % 5 = 0 THEN 2 ELSE 0 END AS INTEGER) AS cycle FROM d""",
)
def l02(spark, sf):
    k = F.col("line_id")
    more = F.map_concat("tags", _tags(("bus:lanes", F.when(k % 6 == 0, "yes||designated")), ("lanes:psv", F.when((k % 6 != 0) & (k % 4 == 1), "2")), ("cycleway:lanes", F.when(k % 5 == 0, "lane||lane"))))
    c = N.lane_totals(F.col("tags"))
    return _roads(spark, sf).select("line_id", more.alias("tags")).select("line_id", c["forward"].alias("forward"), c["bus"].alias("bus"), c["cycle"].alias("cycle"))


_LANE_ROWS = f"""{_LANES}, e AS (SELECT k, unnest(list_concat(list_transform(range(back), lambda i: {{'d': 'backward', 'i': back - i}}), list_transform(range(fwd), lambda i: {{'d': 'forward', 'i': i + 1}})), recursive := true), fwd + back AS n FROM d),
w AS (SELECT k, d, row_number() OVER (PARTITION BY k ORDER BY CASE WHEN d = 'backward' THEN -i ELSE i END) AS lane, n,
 CASE WHEN d = 'forward' AND k % 2 = 0 AND i <= 2 THEN CASE i WHEN 1 THEN 3.5 ELSE 2.5 END WHEN k % 11 = 0 THEN 12.0::DOUBLE / n ELSE 3.0 END::DOUBLE AS width FROM e)"""


@query("l03_derive_lanes", f"WITH {_LANE_ROWS} SELECT k AS line_id, CAST(lane AS INTEGER) AS lane_index, d AS direction, round(width, 6) AS width FROM w")
def l03(spark, sf):
    return N.derive_lanes(_roads(spark, sf)).select("line_id", "lane_index", "direction", F.round("width", 6).alias("width"))


def _sides(spark, sf, kind: str, left: float, right: float):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k.alias("line_id"), F.explode(F.array_compact(F.array(F.when(k % 2 == 0, "left"), F.when(k % 3 == 0, "right")))).alias("side"))
    return o.select("line_id", "side", F.lit(kind).alias("type"), F.when(F.col("side") == "left", left).otherwise(right).alias("width"))


@query(
    "l04_cycle_lanes",
    f"""WITH {_LANE_ROWS}, z AS (SELECT k, lane AS pos, d, width, 'vehicle' AS type FROM w UNION ALL SELECT k, 0, 'backward', 1.5, 'bicycle' FROM (SELECT DISTINCT k FROM w) WHERE k % 2 = 0 UNION ALL SELECT k, 1000, 'forward', 1.85, 'bicycle' FROM (SELECT DISTINCT k FROM w) WHERE k % 3 = 0)
SELECT k AS line_id, CAST(row_number() OVER (PARTITION BY k ORDER BY pos) AS INTEGER) AS lane_index, d AS direction, round(width, 6)::DOUBLE AS width, type FROM z""",
)
def l04(spark, sf):
    return N.add_side_lanes(N.derive_lanes(_roads(spark, sf)), _sides(spark, sf, "bicycle", 1.5, 1.85)).select("line_id", "lane_index", "direction", F.round("width", 6).alias("width"), "type")


@query(
    "l05_parking_lanes",
    f"""WITH {_LANE_ROWS}, n AS (SELECT DISTINCT k FROM w) SELECT w.k AS line_id, count(*) + any_value(CASE WHEN w.k % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN w.k % 3 = 0 THEN 1 ELSE 0 END) AS lanes,
 round(sum(width) + any_value(CASE WHEN w.k % 2 = 0 THEN 2.0 ELSE 0 END + CASE WHEN w.k % 3 = 0 THEN 5.0 ELSE 0 END), 4)::DOUBLE AS width FROM w GROUP BY w.k""",
)
def l05(spark, sf):
    every = N.add_side_lanes(N.derive_lanes(_roads(spark, sf)), _sides(spark, sf, "parking", 2.0, 5.0))
    return every.groupBy("line_id").agg(F.count(F.lit(1)).alias("lanes"), F.round(F.sum("width"), 4).alias("width"))


@query(
    "l07_effective_width",
    """WITH t AS (SELECT l_orderkey AS k, l_linenumber AS i, l_partkey AS p, l_suppkey AS s, l_partkey % 2 = 0 AS free, CASE WHEN l_partkey % 2 = 0 THEN 3.0 ELSE l_quantity / 10 END::DOUBLE AS width, CASE WHEN l_orderkey % 3 > 0 THEN l_orderkey % 20 + 4.0 END::DOUBLE AS road FROM lineitem),
f AS (SELECT *, sum(CASE WHEN free THEN 0 ELSE width END) OVER (PARTITION BY k) AS fixed, count(*) FILTER (free) OVER (PARTITION BY k) AS n FROM t)
SELECT k AS line_id, i, p, s, round(CASE WHEN free AND road IS NOT NULL THEN greatest((road - fixed) / n, 2.0) ELSE width END, 6)::DOUBLE AS width FROM f""",
)
def l07(spark, sf):
    k, free = F.col("l_orderkey"), F.col("l_partkey") % 2 == 0
    t = table(spark, sf, "lineitem").select(k.alias("line_id"), F.col("l_linenumber").alias("i"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), free.alias("is_default"), F.when(free, 3.0).otherwise(F.col("l_quantity") / 10).alias("width"), F.when(k % 3 > 0, k % 20 + 4.0).alias("road_width"))
    return N.effective_width(t).select("line_id", "i", "p", "s", F.round("width", 6).alias("width"))


# ---- tables of elements ----


@query("s02_layer_schema", "SELECT count(*) AS n, 0::BIGINT AS lanes FROM orders")
def s02(spark, sf):
    """Rows of a layer as its declared columns and types, those it lacks being null."""
    name, schema = S.layer_schema("highway", "way", ["lanes", "width", "name"], {"lanes": "integer", "width": "real"})
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("osm_id"), F.col("o_orderpriority").alias("name"))
    full = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    return full.agg(F.count(F.lit(1)).alias("n"), F.count("lanes").alias("lanes"))


@query("s03_relevant_ways", "SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 4 = 1")
def s03(spark, sf):
    k = F.col("o_orderkey")
    t = _tags(("highway", F.when(k % 3 == 0, "residential")), ("parking:both", F.when(k % 4 == 1, "lane")), ("name", F.lit("x")))
    return S.relevant_ways(table(spark, sf, "orders").select(k.alias("k"), t.alias("tags"))).select("k")


@query("s10_with_geom", "SELECT c_custkey, c_name, c_custkey * 2.0::DOUBLE AS x FROM customer")
def s10(spark, sf):
    from ..functions.geometry import point

    c = table(spark, sf, "customer").select("c_custkey", "c_name", F.lit(None).cast("struct<x:double,y:double>").alias("geom"))
    return S.with_geom(c, point(F.col("c_custkey") * 2, F.lit(0))).select("c_custkey", "c_name", "geom.x")


def _in_shared(spark, name: str) -> str:
    from ..storage import new_path

    return new_path(spark, name)


@query("s06_read_geojson", "SELECT c_custkey AS id, c_mktsegment AS segment, c_custkey % 360 - 180.0::DOUBLE AS x, c_custkey % 90 - 0.5::DOUBLE AS y FROM customer")
def s06(spark, sf):
    """The customers as GeoJSON collections of a few hundred features each, read again."""
    k = F.col("c_custkey")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array((k % 360 - 180).cast("double"), k % 90 - F.lit(0.5)).alias("coordinates")).alias("geometry"), F.struct(k.alias("id"), F.col("c_mktsegment").alias("segment")).alias("properties"))
    path = _in_shared(spark, "geojson")
    each = table(spark, sf, "customer").groupBy(F.floor(k / 300).alias("part")).agg(F.collect_list(feature).alias("features"))
    each.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_geojson(spark, path, {"id": "long", "segment": "string"}).select("id", "segment", "x", "y")


@query("s08_snapshot", "SELECT p_partkey FROM part")
def s08(spark, sf):
    """A snapshot is written once: another input under the same path changes nothing."""
    path, p = _in_shared(spark, "snapshot"), table(spark, sf, "part").select("p_partkey")
    S.snapshot(p, path)
    return S.snapshot(p.where("p_partkey < 0"), path)


@query("s11_run_stage", "SELECT o_orderstatus AS status, count(*) AS n, 1::BIGINT AS made FROM orders GROUP BY 1")
def s11(spark, sf):
    """A stage that ran under a run id is read the second time."""
    ledger, path, made = _in_shared(spark, "ledger"), _in_shared(spark, "stage"), []

    def make():
        made.append(1)
        return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))

    for _ in range(2):
        out = S.run_stage(spark, ledger, "counts", "run-1", make, path)
    return out.withColumn("made", F.lit(len(made)).cast("long"))


@query("s12_empty_like", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def s12(spark, sf):
    """A missing optional input is an empty table of its columns, which adds nothing."""
    n = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return n.unionByName(S.empty_like(spark, n.schema))


# ---- set operations ----


@query("u01_union_all", "SELECT c_custkey AS id, 'customer' AS source, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, 'supplier', NULL FROM supplier")
def u01(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("source"), F.col("c_acctbal").alias("balance"))
    return a.unionByName(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("source")), allowMissingColumns=True)


@query("u03_distinct_keys", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def u03(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()


@query("u04_delete", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def u04(spark, sf):
    o, poor = table(spark, sf, "orders"), table(spark, sf, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return o.where("o_orderstatus <> 'F'").join(poor, "o_custkey", "left_anti").select("o_orderkey")


@query("u05_ordered_export", "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS place, p_partkey FROM part")
def u05(spark, sf):
    """Rows in order of a stable id: ranges are sorted apart, and each row's place is its range's first place plus its own."""
    from ..storage import written

    p = table(spark, sf, "part").select("p_partkey").repartitionByRange(F.col("p_partkey")).sortWithinPartitions("p_partkey")
    p = written(p.withColumn("at", F.monotonically_increasing_id()), "ranges")
    part, own = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    from pyspark.sql.window import Window

    sizes = p.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))  # one row a partition
    return p.withColumn("part", part).join(first, "part").select((F.col("first") + own).alias("place"), "p_partkey")
