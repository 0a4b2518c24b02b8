"""Tag and number rules over columns of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tags as T
from ..registry import query, table


@query(
    "p01_metric_number",
    """
WITH t AS (SELECT p_partkey, p_size, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN p_size || ' cm' WHEN 2 THEN (p_size || '.5 m') ELSE 'wide ' || p_size END AS v FROM part)
SELECT p_partkey, v, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN p_size / 100.0 WHEN 2 THEN p_size + 0.5 END AS metres FROM t
""",
)
def p01(spark, sf):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    v = F.when(k == 0, n).when(k == 1, F.concat(n, F.lit(" cm"))).when(k == 2, F.concat(n, F.lit(".5 m"))).otherwise(F.concat(F.lit("wide "), n))
    return table(spark, sf, "part").select("p_partkey", v.alias("v")).withColumn("metres", T.metric_number("v"))


@query(
    "p02_parking_number",
    """
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS DOUBLE) + 0.25 WHEN 1 THEN CAST(c_custkey AS DOUBLE) END AS n FROM customer
""",
)
def p02(spark, sf):
    n, k = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    v = F.when(k == 0, F.concat(n, F.lit(",25 m wide"))).when(k == 1, F.concat(n, F.lit("m"))).otherwise(F.concat(F.lit("approx "), n))
    return table(spark, sf, "customer").select("c_custkey", T.parking_number(v).alias("n"))


@query(
    "p03_tag_list",
    """
SELECT doc_id, list_sort(list_filter(string_split(replace(coalesce(lang, '') || ';;' || coalesce(source, '') || ',' || doc_id, ',', ';'), ';'), lambda x: x <> ''))[1] AS first,
  len(list_filter(string_split(replace(coalesce(lang, '') || ';;' || coalesce(source, '') || ',' || doc_id, ',', ';'), ';'), lambda x: x <> '')) AS n,
  nullif(array_to_string(list_filter(string_split(lang || ';' || source, ';'), lambda x: x <> 'en'), ';'), '') AS without_en
FROM documents
""",
)
def p03(spark, sf):
    v = F.concat(F.coalesce("lang", F.lit("")), F.lit(";;"), F.coalesce("source", F.lit("")), F.lit(","), F.col("doc_id").cast("string"))
    parts = T.tag_list(v, ";,")
    both = F.concat("lang", F.lit(";"), "source")
    return table(spark, sf, "documents").select("doc_id", F.array_min(parts).alias("first"), F.size(parts).cast("long").alias("n"), T.drop_token(both, "en").alias("without_en"))


@query(
    "p05_direction",
    """
WITH t AS (SELECT o_orderkey AS k, o_orderkey * 7 % 360 AS a, o_orderkey * 11 % 360 AS b FROM orders)
SELECT k, CASE k % 5 WHEN 0 THEN CAST(a - 180 AS DOUBLE) + CASE WHEN a < 180 THEN 360 ELSE 0 END
  WHEN 1 THEN CASE k % 3 WHEN 0 THEN 45.0 WHEN 1 THEN 292.0 ELSE 180.0 END
  WHEN 2 THEN CASE WHEN a < 180 THEN CAST(a AS DOUBLE) END
  WHEN 3 THEN CASE WHEN abs(a - b) > 180 THEN CAST((a + b) AS DOUBLE) / 2 + 180 - CASE WHEN (a + b) / 2.0 + 180 >= 360 THEN 360 ELSE 0 END ELSE (a + b) / 2.0 END
  END AS degrees FROM t
""",
)
def p05(spark, sf):
    k = F.col("o_orderkey")
    a, b = k * 7 % 360, k * 11 % 360
    s = lambda x: x.cast("string")
    words = F.when(k % 3 == 0, "NE").when(k % 3 == 1, "west-north-west").otherwise("South")
    v = F.when(k % 5 == 0, s(a - 180)).when(k % 5 == 1, words).when(k % 5 == 2, F.concat(s(a), F.lit(";"), F.when(a < 180, s(a + 180)).otherwise(s(a - 90)))).when(k % 5 == 3, F.concat(s(a), F.lit("-"), s(b))).otherwise("somewhere")
    return table(spark, sf, "orders").select(k.alias("k"), T.direction_degrees(v).alias("degrees"))


@query(
    "p07_stable_fraction",
    "SELECT o_orderkey AS id, round((((o_orderkey % 2147483647) + 104729) % 2147483647 * 48271 % 2147483647) / 2147483647.0::DOUBLE, 9) AS fraction FROM orders",
)
def p07(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.round(T.stable_fraction("o_orderkey", 104729), 9).alias("fraction"))


@query(
    "p08_row_mean",
    """
SELECT o_orderkey, round(list_avg(list_filter([CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS DOUBLE) END], lambda x: x IS NOT NULL)), 6) AS mean FROM orders
""",
)
def p08(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k, F.round(T.row_mean(F.when(k % 2 == 0, F.col("o_totalprice")), F.when(k % 3 == 0, F.col("o_custkey").cast("double"))), 6).alias("mean"))


@query(
    "p09_access",
    """
SELECT event_id, CASE WHEN event_type = 'click' THEN 'yes' WHEN user_id % 2 = 0 THEN 'no' ELSE event_type END AS car,
  CASE WHEN event_type = 'click' THEN 'yes' ELSE event_type END AS foot,
  CASE WHEN event_type = 'click' THEN TRUE WHEN user_id % 2 = 0 THEN FALSE ELSE TRUE END AS present
FROM events
""",
)
def p09(spark, sf):
    t = F.map_filter(F.create_map(F.lit("motor"), F.when(F.col("event_type") == "click", "yes"), F.lit("vehicle"), F.when(F.col("user_id") % 2 == 0, "no"), F.lit("access"), F.col("event_type")), lambda k, v: v.isNotNull())
    d = table(spark, sf, "events").select("event_id", t.alias("t"))
    car = T.access_for(F.col("t"), "motor")
    return d.select("event_id", car.alias("car"), T.access_for(F.col("t"), "motor", foot=True).alias("foot"), T.tag_present(car).alias("present"))


@query(
    "p12_crown_diameter",
    """
WITH t AS (SELECT p_partkey AS id, p_size AS s, p_partkey % 6 AS k,
  (((p_partkey % 2147483647) + 104729) % 2147483647 * 48271 % 2147483647) / 2147483647.0::DOUBLE AS f FROM part)
SELECT id, CASE k WHEN 0 THEN CAST(s AS DOUBLE)
  WHEN 1 THEN floor(greatest(2.0::DOUBLE, least(25.0::DOUBLE, s * 0.6::DOUBLE)) * 10 + 0.5) / 10
  WHEN 2 THEN floor(greatest(2.0::DOUBLE, least(25.0::DOUBLE, CASE WHEN s < 50 THEN (s * 7.6::DOUBLE + (2030 - 1900 - s) * 0.2::DOUBLE) / 2 ELSE (2030 - 1900 - s) * 0.2::DOUBLE END)) * 10 + 0.5) / 10
  WHEN 3 THEN NULL WHEN 4 THEN floor((f * 4 + 5) * 10 + 0.5) / 10 ELSE floor((f * 3 + 3) * 10 + 0.5) / 10 END AS crown FROM t
""",
)
def p12(spark, sf):
    k, s = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    pairs = [
        ("natural", F.when(k == 3, "tree_stump").when(k == 5, "shrub").otherwise("tree")), ("diameter_crown", F.when(k == 0, F.concat(s, F.lit(" m")))), ("height", F.when(k == 1, s)),
        ("circumference", F.when(k == 2, s)), ("start_date", F.when(k == 2, F.concat((F.lit(1900) + F.col("p_size")).cast("string"), F.lit("-05-01")))),
    ]
    t = F.map_filter(F.create_map(*[x for n, v in pairs for x in (F.lit(n), v)]), lambda _, v: v.isNotNull())
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), t.alias("t")).select("id", T.crown_diameter(F.col("t"), F.col("id"), 2030).alias("crown"))


@query(
    "p21_lane_values",
    """
SELECT p_partkey, list_count(list_transform(string_split(p_size || '||' || p_partkey % 3 || '|x', '|'), lambda x: nullif(x, ''))) AS filled,
  len(list_filter(string_split(p_size || '||' || p_partkey % 3 || '|x', '|'), lambda x: x = '1')) AS ones,
  CASE p_partkey % 3 WHEN 0 THEN p_size - 1.0 WHEN 1 THEN p_size - 0.0 ELSE p_size - 0.5 END AS place FROM part
""",
)
def p21(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size").cast("string")
    slots = T.pipe_values(F.concat(n, F.lit("||"), (k % 3).cast("string"), F.lit("|x")))
    kind = F.when(k % 3 == 0, "left_of:").when(k % 3 == 1, "right_of:").otherwise("middle_of:")
    return table(spark, sf, "part").select("p_partkey", F.size(F.array_compact(slots)).cast("long").alias("filled"), T.count_value(slots, "1").cast("long").alias("ones"), T.placement(F.concat(kind, n)).alias("place"))


def _parking_tags():
    k = F.col("o_orderkey")
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(k / pick.step) % len(values) + 1).cast("int"))
    out = []
    for step, key, values in PARKING_KEYS:
        pick.step = step
        out += [F.lit(key), pick(*values)]
    return F.map_filter(F.create_map(*out), lambda _, v: v.isNotNull())


PARKING_KEYS = [
    (1, "parking:left", ["lane", None, "no", "half_on_kerb", "bogus"]), (2, "parking:both", [None, "street_side", "yes"]), (3, "parking:right:orientation", ["diagonal", None, "perpendicular", "sideways"]),
    (1, "parking:right:fee", [None, "yes", "no"]), (2, "parking:both:zone", [None, "12", "none"]), (1, "parking:right:access", [None, "private", "no", "yes", "customers"]),
    (3, "parking:right:maxstay", [None, "2 hours"]), (2, "parking:right:restriction", [None, "loading_only", "no_parking", "charging_only"]), (1, "parking:right:disabled", [None, None, "designated", "no"]),
    (4, "parking:both:restriction:conditional", [None, "no_stopping @ (Mo-Fr)", "none @ (Sa); no_standing @ (Su)"]), (1, "highway", ["residential", "primary", "service", "footway"]),
    (2, "service", [None, "driveway"]), (3, "width", [None, "7,5", "wide", "6 m"]),
]


def _parking_sql():
    """The same tags as columns in SQL, named by their keys."""
    out = []
    for step, key, values in PARKING_KEYS:
        lit = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
        out.append(f"([{lit}])[CAST(o_orderkey // {step} % {len(values)} + 1 AS INTEGER)] AS \"{key}\"")
    return "SELECT o_orderkey, " + ", ".join(out) + " FROM orders"


@query(
    "p22_parking_sides",
    f"""
WITH t AS ({_parking_sql()}), s AS (
  SELECT o_orderkey, 'left' AS side, coalesce("parking:left", "parking:both") AS v, NULL AS o FROM t
  UNION ALL SELECT o_orderkey, 'right', "parking:both", "parking:right:orientation" FROM t)
SELECT o_orderkey, side, CASE WHEN v = 'yes' THEN 'lane' WHEN v IN ('lane', 'half_on_kerb', 'on_kerb', 'street_side', 'shoulder', 'separate', 'no') THEN v ELSE 'no' END AS parking,
  CASE WHEN v NOT IN ('no', 'separate') THEN CASE WHEN o IN ('parallel', 'diagonal', 'perpendicular') THEN o ELSE 'parallel' END END AS orientation,
  CASE WHEN v NOT IN ('lane', 'half_on_kerb', 'on_kerb', 'street_side', 'shoulder', 'separate', 'no', 'yes') THEN 'invalid_parking' END AS value_error
FROM s WHERE v IS NOT NULL
""",
)
def p22(spark, sf):
    from ..plans.parking import parking_sides

    roads = table(spark, sf, "orders").select("o_orderkey", _parking_tags().alias("tags"))
    return parking_sides(roads).select("o_orderkey", "side", "parking", "orientation", "value_error")


@query(
    "p24_condition_class",
    f"""
WITH t AS ({_parking_sql()}), v AS (
  SELECT o_orderkey, coalesce("parking:right:fee", '') AS fee, coalesce("parking:both:zone", '') AS zone, coalesce("parking:right:access", '') AS acc, coalesce("parking:right:maxstay", '') AS stay,
    coalesce("parking:right:restriction", '') AS rule, coalesce("parking:both:restriction:conditional", '') AS rule_c, "parking:right:disabled" AS dis FROM t),
p AS (SELECT *, CASE WHEN fee = 'yes' AND zone NOT IN ('', 'no', 'none') THEN 'mixed' WHEN acc = 'private' AND zone NOT IN ('', 'no', 'none') THEN 'residents'
    WHEN fee = 'yes' AND acc IN ('', 'yes', 'permissive', 'designated') AND zone IN ('', 'no', 'none') THEN 'paid'
    WHEN fee = 'no' AND stay IN ('', 'no', 'none') AND zone IN ('', 'no', 'none') THEN 'free' END AS a,
    CASE WHEN rule = 'loading_only' THEN 'loading' END AS b, CASE WHEN rule = 'charging_only' THEN 'charging' END AS c,
    CASE WHEN stay NOT IN ('', 'no', 'none') THEN 'time_limited' END AS d, CASE WHEN dis = 'designated' AND acc = 'no' THEN 'disabled' END AS e FROM v)
SELECT o_orderkey, nullif(concat_ws(';', a, b, c, d, e,
    CASE WHEN acc NOT IN ('', 'yes', 'destination', 'designated', 'permissive') AND NOT regexp_matches(concat_ws(';', a, b, c, d, e), 'residents|paid|loading|charging|vehicle_restriction') THEN 'access_restriction' END,
    CASE WHEN rule = 'no_parking' THEN 'no_parking' END, CASE WHEN contains(rule_c, 'no_standing @') THEN 'no_standing' END, CASE WHEN contains(rule_c, 'no_stopping @') THEN 'no_stopping' END), '') AS condition,
  CASE WHEN dis = 'designated' THEN 'disabled' END AS designated, CASE WHEN dis = 'no' THEN 'disabled' END AS excluded FROM p
""",
)
def p24(spark, sf):
    from ..operators.classify import parking_conditions

    roads = table(spark, sf, "orders").select("o_orderkey", _parking_tags().alias("tags"), F.lit("right").alias("side"))
    return parking_conditions(roads).select("o_orderkey", F.col("condition_class").alias("condition"), F.col("vehicle_designated").alias("designated"), F.col("vehicle_excluded").alias("excluded"))


@query(
    "p26_road_width",
    f"""
WITH t AS ({_parking_sql()})
SELECT o_orderkey, coalesce(CASE width WHEN '7,5' THEN 7.5 WHEN '6 m' THEN 6.0 END,
  CASE WHEN highway = 'primary' THEN 17 WHEN highway = 'service' AND service = 'driveway' THEN 2.5 WHEN highway IN ('service', 'residential') THEN 8 ELSE 4 END)::DOUBLE AS width FROM t
""",
)
def p26(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.road_width(_parking_tags()).alias("width"))


@query(
    "p28_presentation",
    """
SELECT o_orderkey, 'r' || lpad(CAST((CAST(floor((o_orderkey * 7 % 720 - 100) / 15.0 + 0.5) AS BIGINT) * 15 % 360 + 360) % 360 AS VARCHAR), 3, '0') AS bucket,
  'r' || lpad(CAST((CAST(floor((o_orderkey * 7 % 720 - 100) / 15.0 + 0.5) AS BIGINT) * 15 + 45 + 720) % 360 AS VARCHAR), 3, '0') AS shifted,
  round(16 + ln(50000.0 / o_totalprice) / ln(2), 6) AS zoom, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE least(greatest(o_orderkey % 9 - 5, -2), 3) END AS stratum FROM orders
""",
)
def p28(spark, sf):
    k = F.col("o_orderkey")
    d = (k * 7 % 720 - 100).cast("double")
    return table(spark, sf, "orders").select(
        k, T.rotation_bucket(d).alias("bucket"), T.rotation_bucket(d, 15, 45).alias("shifted"), F.round(T.min_zoom(F.col("o_totalprice"), 50000.0), 6).alias("zoom"),
        T.stratum(F.when(k % 9 != 0, k % 9 - 5)).alias("stratum"),
    )


@query(
    "p35_building_height",
    """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size * 3.0::DOUBLE WHEN p_partkey % 3 = 1 THEN 3.0 ELSE 5.0 END AS height,
  round(5.0::DOUBLE * (1 - exp(-CASE WHEN p_partkey % 3 = 0 THEN p_size * 3.0::DOUBLE WHEN p_partkey % 3 = 1 THEN 3.0 ELSE 5.0 END / 30)), 6) AS shade FROM part
""",
)
def p35(spark, sf):
    k = F.col("p_partkey") % 3
    h = T.building_height(F.when(k == 0, F.col("p_size")), F.when(k == 1, "roof"))
    return table(spark, sf, "part").select("p_partkey", h.alias("height"), F.round(T.shade_length(h), 6).alias("shade"))


@query(
    "p37_metres",
    "SELECT c_custkey, round(c_custkey % 50 * (1 / cos(radians(least(greatest(c_custkey % 181 - 90.0, -85), 85)))), 6) AS units FROM customer",
)
def p37(spark, sf):
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(k, F.round(T.metres((k % 50).cast("double"), T.crs_factor((k % 181 - 90).cast("double"))), 6).alias("units"))


@query(
    "p40_colour_difference",
    """
WITH c AS (SELECT p_partkey, [p_partkey % 256, p_size * 5 % 256, p_partkey * 3 % 256] AS p, [p_size * 4 % 256, p_partkey * 7 % 256, 128] AS q FROM part),
lin AS (SELECT p_partkey, list_transform(p, lambda v: CASE WHEN v / 255.0 <= 0.04045 THEN v / 255.0 / 12.92 ELSE pow((v / 255.0 + 0.055) / 1.055, 2.4) END) AS p,
  list_transform(q, lambda v: CASE WHEN v / 255.0 <= 0.04045 THEN v / 255.0 / 12.92 ELSE pow((v / 255.0 + 0.055) / 1.055, 2.4) END) AS q FROM c),
xyz AS (SELECT p_partkey, unnest([1, 2]) AS which, unnest([p, q]) AS v FROM lin),
f AS (SELECT p_partkey, which, list_transform([(0.4124564::DOUBLE * v[1] + 0.3575761::DOUBLE * v[2] + 0.1804375::DOUBLE * v[3]) / 0.95047, 0.2126729::DOUBLE * v[1] + 0.7151522::DOUBLE * v[2] + 0.0721750::DOUBLE * v[3],
  (0.0193339::DOUBLE * v[1] + 0.1191920::DOUBLE * v[2] + 0.9503041::DOUBLE * v[3]) / 1.08883], lambda t: CASE WHEN t > 0.008856 THEN pow(t, 1.0::DOUBLE / 3) ELSE 7.787 * t + 16.0::DOUBLE / 116 END) AS f FROM xyz),
lab AS (SELECT p_partkey, which, 116 * f[2] - 16 AS l, 500 * (f[1] - f[2]) AS a, 200 * (f[2] - f[3]) AS b FROM f)
SELECT x.p_partkey, round(x.l, 4) AS l, round(sqrt(pow(x.l - y.l, 2) + pow(x.a - y.a, 2) + pow(x.b - y.b, 2)), 4) AS delta_e FROM lab x JOIN lab y ON x.p_partkey = y.p_partkey AND x.which = 1 AND y.which = 2
""",
)
def p40(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    p, q = T.lab(k % 256, s * 5 % 256, k * 3 % 256), T.lab(s * 4 % 256, k * 7 % 256, F.lit(128))
    return table(spark, sf, "part").select(k, p.alias("p"), q.alias("q")).select("p_partkey", F.round("p.l", 4).alias("l"), F.round(T.delta_e(F.col("p"), F.col("q")), 4).alias("delta_e"))


@query(
    "p41_tile_key",
    """
SELECT c_custkey, '16/' || CAST(floor((c_custkey * 1009 + 20037508.342789244::DOUBLE) / (40075016.685578488::DOUBLE / 65536)) AS BIGINT) || '/' ||
  CAST(floor((20037508.342789244::DOUBLE - c_custkey * 733) / (40075016.685578488::DOUBLE / 65536)) AS BIGINT) AS tile FROM customer
""",
)
def p41(spark, sf):
    k = F.col("c_custkey").cast("double")
    return table(spark, sf, "customer").select("c_custkey", T.tile_key(k * 1009, k * 733, 16).alias("tile"))


@query(
    "p14_traffic_sign",
    """WITH t AS (SELECT p_partkey AS k, p_partkey % 6 AS m, p_size AS s FROM part)
SELECT k, CASE m WHEN 0 THEN 'DE' WHEN 1 THEN 'DE' WHEN 2 THEN 'AT' WHEN 3 THEN 'DE' END AS country_code,
 CASE m WHEN 0 THEN '274.1' WHEN 1 THEN '274-' || s WHEN 2 THEN '52' WHEN 3 THEN '311' WHEN 4 THEN '101-10' END AS sign_main,
 CASE m WHEN 0 THEN '274.1[30];1042' WHEN 1 THEN '274-' || s WHEN 2 THEN '52' WHEN 3 THEN '311' WHEN 4 THEN '101-10;1040' END AS sign_list FROM t""",
)
def p14(spark, sf):
    k = F.col("p_partkey") % 6
    sign = F.when(k == 0, "DE:274.1[30],1042").when(k == 1, "maxspeed").when(k == 2, "AT:52").when(k == 3, "no;city_limit").when(k == 4, "101-10;1040").otherwise("none")
    pairs = F.create_map(F.lit("traffic_sign"), sign, F.lit("maxspeed"), F.col("p_size").cast("string"), F.lit("city_limit"), F.lit("end"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("k"), pairs.alias("t")).select("k", T.parse_traffic_sign(F.col("t")).alias("s")).select("k", "s.country_code", "s.sign_main", "s.sign_list")


@query(
    "p31_icon_rotation",
    """WITH t AS (SELECT o_orderkey AS k, o_orderkey % 3 AS m, o_orderkey * 7 % 360 AS a, o_orderkey % 2 = 0 AS l, o_orderkey % 60 AS lat FROM orders)
SELECT k, round((((CASE m WHEN 0 THEN a + CASE WHEN l THEN 180 ELSE 0 END WHEN 1 THEN a + CASE WHEN l THEN 126 ELSE 54 END ELSE a - 90 END - 1 / cos(radians(lat))) + 360)::DOUBLE % 360 + 360) % 360, 6) AS rotation FROM t""",
)
def p31(spark, sf):
    k = F.col("o_orderkey")
    way = F.when(k % 3 == 0, "parallel").when(k % 3 == 1, "diagonal").otherwise("perpendicular")
    r = T.car_rotation(way, (k * 7 % 360).cast("double"), k % 2 == 0, k.cast("string"), (k % 60).cast("double"))
    return table(spark, sf, "orders").select(k.alias("k"), F.round(r, 6).alias("rotation"))


@query(
    "p32_dashes",
    """WITH t AS (SELECT p_partkey AS k, ['dashed', 'solid', 'sharks_teeth', 'dashed;solid', NULL][CAST(p_partkey % 5 + 1 AS INTEGER)] AS s, ['crossing_edge', 'edge_line', 'lane_divider'][CAST(p_partkey % 3 + 1 AS INTEGER)] AS m, ['bus', NULL][CAST(p_partkey % 2 + 1 AS INTEGER)] AS ty FROM part)
SELECT k, CASE WHEN s LIKE '%dashed%' OR s = 'sharks_teeth' THEN CASE WHEN k % 7 = 0 THEN '9;9' WHEN m = 'crossing_edge' THEN '0.5;0.25' WHEN ty = 'bus' THEN '5;1' WHEN s = 'sharks_teeth' THEN '0.5;0.25' WHEN m = 'edge_line' THEN '1;1' ELSE '3;3' END END AS dashes,
 round(CASE WHEN k % 4 = 0 THEN 2.0 ELSE 1.5 END * 2, 3)::DOUBLE AS length FROM t""",
)
def p32(spark, sf):
    k = F.col("p_partkey")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))
    d = T.dash_default(pick(["dashed", "solid", "sharks_teeth", "dashed;solid", None]), pick(["crossing_edge", "edge_line", "lane_divider"]), pick(["bus", None]), F.when(k % 7 == 0, " 9;9 ").otherwise(" "))
    size = T.sign_size(F.when(k % 4 == 0, 2.0), F.lit(None).cast("double"), 1.5)
    return table(spark, sf, "part").select(k.alias("k"), d.alias("dashes"), size["length"].alias("length"))
