"""Typed layers from free-form tags (P-13 .. P-20, P-24, P-25, P-38)."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import MODES, conditional_has, joined, metric_number, side_tag, tag_present

# fixed values: rank of road classes, lower is more important
HIERARCHY = {
    "motorway": 1, "trunk": 2, "primary": 11, "secondary": 12, "tertiary": 13, "unclassified": 20, "residential": 25, "living_street": 30, "pedestrian": 40,
    "motorway_link": 50, "trunk_link": 51, "primary_link": 52, "secondary_link": 53, "tertiary_link": 54,
    "raceway": 60, "service": 65, "track": 66, "bus_guideway": 70, "busway": 71, "escape": 72, "road": 79,
    "path": 80, "cycleway": 81, "footway": 82, "steps": 83, "bridleway": 84, "via_ferrata": 85, "corridor": 89, "construction": 90, "proposed": 95,
    "parking_space": 130, "parking_two_wheel": 140, "parking": 150,
}
# fixed values: types of road classes
TYPES = {
    "motorway": ["motorway", "motorway_link", "trunk", "trunk_link"],
    "road": ["primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street", "pedestrian", "road"],
    "service": ["service", "track", "bus_guideway", "busway", "escape", "raceway"],
    "path": ["path", "footway", "cycleway", "bridleway", "steps", "corridor", "via_ferrata"],
}
# fixed values: objects by their key
FEATURES = {
    "advertising": ["column"],
    "amenity": ["bench", "bicycle_parking", "bicycle_rental", "charging_station", "clock", "drinking_water", "fountain", "grit_bin", "loading_ramp", "mobility_hub", "parking_entrance", "post_box", "public_bookcase", "recycling", "shelter", "small_electric_vehicle_parking", "telephone", "toilets", "vending_machine", "waste_basket", "waste_disposal"],
    "emergency": ["fire_hydrant"],
    "highway": ["street_lamp", "traffic_sign", "bus_stop"],
    "historic": ["memorial"],
    "leisure": ["outdoor_seating", "picnic_table", "table", "parklet"],
    "man_made": ["chimney", "flagpole", "guard_stone", "manhole", "mast", "monitoring_station", "pier", "planter", "pole", "street_cabinet", "water_well"],
    "tourism": ["artwork", "information", "viewpoint"],
    "waterway": ["lock_gate"],
}


def classify_highway(df: DataFrame) -> DataFrame:
    """P-15: adds type, class and hierarchy (999 if unknown); a road being built counts as what it will be, except in rank."""
    t = F.col("tags")
    value = F.when((t["highway"] == "construction") & t["construction"].isNotNull(), t["construction"]).otherwise(t["highway"])
    kind = F.coalesce(*[F.when(value.isin(names), name) for name, names in TYPES.items()])
    sub = F.when(value == "service", t["service"]).when(value == "track", t["tracktype"]).when(value == "footway", t["footway"]).when(value == "cycleway", t["cycleway"]).when(value == "path", t["path"]).when(value.endswith("_link"), "link")
    rank = F.create_map(*[F.lit(x) for x in chain(*HIERARCHY.items())])
    return df.withColumn("type", kind).withColumn("class", sub).withColumn("hierarchy", F.coalesce(rank[t["highway"]], F.lit(999)))


def area_type_class(tags: Column) -> Column:
    """P-16: (type, class): junction before crossing; `yes` gives a type only."""
    one = lambda k: F.struct(F.lit(k).alias("type"), F.when(tags[k] != "yes", tags[k]).alias("class"))
    none = F.struct(F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("class"))
    return F.when(tag_present(tags["junction"]), one("junction")).when(tag_present(tags["crossing"]), one("crossing")).otherwise(none)


def marking_defaults(df: DataFrame) -> DataFrame:
    """P-18: rows (tags, road_marking, kind: way, node or polygon) with stroke, width, colour, symbol and class."""
    t, m = F.col("tags"), F.col("road_marking")
    given = lambda k: F.nullif(t[k], F.lit(""))
    both = F.when(given("stroke:left").isNotNull() & given("stroke:right").isNotNull(), F.concat(t["stroke:left"], F.lit(";"), t["stroke:right"]))
    stroke = F.coalesce(given("stroke"), both, F.when(F.col("kind") == "way", F.when(m.isin("lane_divider", "crossing_edge"), "dashed").otherwise("solid")))
    width = F.coalesce(metric_number(t["width"]), F.when(m == "stop_line", 0.5).when(m.isin("lane_divider", "edge_line", "crossing_edge"), 0.12))
    colour = F.coalesce(given("colour"), given("surface:colour"), F.when(~F.coalesce(m.isin("traffic_sign", "crossing"), F.lit(False)), F.when(tag_present(t["temporary"]), "yellow").otherwise("white")))
    sign = given("traffic_sign")
    head = F.substring_index(sign, ":", 1)
    rest = F.when(sign.contains(":"), F.substring(sign, F.length(head) + 2, F.length(sign))).otherwise(sign)
    is_sign = F.coalesce(m == "traffic_sign", F.lit(False))
    symbol = F.when(is_sign, F.coalesce(rest, given("symbol"))).otherwise(t["symbol"])
    return df.withColumn("stroke", stroke).withColumn("width", width).withColumn("colour", colour).withColumn("symbol", symbol).withColumn("class", F.when(is_sign & sign.contains(":"), head))


def classify_feature(df: DataFrame) -> DataFrame:
    """P-13: adds namespace and class of the first key that names an object, also where it is disused."""
    t = F.col("tags")
    rules = [F.when((t["sport"] == "table_tennis") & (t["leisure"] == "pitch"), F.struct(F.lit("sport").alias("namespace"), t["sport"].alias("class"), F.lit(False).alias("disused")))]
    for k, names in FEATURES.items():
        for key, disused in ((k, False), (f"disused:{k}", True)):
            rules.append(F.when(t[key].isin(names), F.struct(F.lit(k).alias("namespace"), t[key].alias("class"), F.lit(disused).alias("disused"))))
    found = F.coalesce(*rules)
    return df.withColumn("f", found).where("f is not null").select(*df.columns, "f.namespace", "f.class", "f.disused")


def first_in(tags: Column, keys: list[str], known: list[str]) -> Column:
    """P-19: the value of the first key whose value is known."""
    return F.coalesce(*[F.when(tags[k].isin(known), tags[k]) for k in keys])


def is_carriageway(c: Column) -> Column:
    """P-38: classes that carry vehicles."""
    return c.isin("road", "motorway", "service")


def route_elements(df: DataFrame) -> DataFrame:
    """P-20: one row per layer that an element belongs to; markings of a node for both directions give two."""
    t = F.col("tags")
    rule = lambda when, layer, direction=None: F.when(when, F.struct(F.lit(layer).alias("layer"), F.lit(direction).cast("string").alias("direction")))
    layers = [
        rule(t["highway"].isin([v for names in TYPES.values() for v in names]), "highway"),
        rule(t["area:highway"].isNotNull(), "highway_area"),
        rule(t["building"].isNotNull() | t["building:part"].isNotNull(), "building"),
        rule(t["natural"].isin("tree", "shrub", "tree_stump"), "tree"),
        rule(t["barrier"].isNotNull(), "barrier"),
        rule(t["road_marking"].isNotNull() & ~F.coalesce(t["direction"] == "both", F.lit(False)), "road_marking"),
        rule(t["road_marking"].isNotNull() & (t["direction"] == "both"), "road_marking", "forward"),
        rule(t["road_marking"].isNotNull() & (t["direction"] == "both"), "road_marking", "backward"),
    ]
    return df.select(*df.columns, F.explode(F.array_compact(F.array(*layers))).alias("l")).select(*df.columns, "l.layer", "l.direction")


# fixed values: keys of a side that decide who may park there
CONDITION_KEYS = ["fee", "zone", "maxstay", "restriction", "access", "fee:conditional", "access:conditional", "maxstay:conditional", "restriction:conditional"]
# fixed values: values that say nothing, and those of a public access
NOTHING, PUBLIC = ["", "no", "none"], ["", "yes", "permissive", "designated"]


def parking_conditions(df: DataFrame) -> DataFrame:
    """P-24, P-25: rows (tags, side) with condition_class, vehicle_designated and vehicle_excluded.

    Tags are looked up once, as columns; conditions are columns over them, and each rule is a label with its condition.
    """
    t, side = F.col("tags"), F.col("side")
    own = lambda k: side_tag(t, "parking", side, k)
    empty = F.lit("")
    looked = [F.coalesce(own(k), *([t["motor_vehicle"], t["vehicle"], t["access"]] if k == "access" else []), empty).alias(f"_{k}") for k in CONDITION_KEYS]
    # a look-up walks over a row's keys, so modes that none of them names are not looked up
    named = lambda m, key: F.when(F.col("_keys").contains(m), own(key))
    modes = [c for m in MODES for c in (named(m, m).alias(f"_m_{m}"), named(m, f"restriction:{m}").alias(f"_r_{m}"), named(m, f"{m}:conditional").alias(f"_c_{m}"))]
    c = lambda k: F.col(f"`_{k}`")
    says = lambda k, v: (c(k) == v) | conditional_has(c(f"{k}:conditional"), v)
    plain = {m: F.coalesce(c(f"m_{m}").isin("yes", "designated") | (c(f"r_{m}") == "none"), F.coalesce(c(f"r_{m}") == "none", F.lit(False))) for m in MODES}
    sometimes = {m: conditional_has(c(f"c_{m}"), "yes") | conditional_has(c(f"c_{m}"), "designated") for m in MODES}
    closed_to = {m: F.coalesce(c(f"m_{m}") == "no", F.lit(False)) | conditional_has(c(f"c_{m}"), "no") for m in MODES}
    flags = df.select("*", F.concat_ws("|", F.map_keys(t)).alias("_keys")).select("*", *looked, *modes).select(
        *df.columns, *[c(k) for k in CONDITION_KEYS], (~c("zone").isin(NOTHING)).alias("_zoned"), says("fee", "yes").alias("_paid"), says("access", "no").alias("_closed"),
        *[plain[m].alias(f"_p_{m}") for m in MODES],
        joined([(m, plain[m] | sometimes[m]) for m in MODES]).alias("vehicle_designated"), joined([(m, closed_to[m]) for m in MODES]).alias("vehicle_excluded"),
    )
    zoned, paid = F.col("_zoned"), F.col("_paid")
    payment = F.coalesce(*[F.when(cond, F.lit(label)) for label, cond in [
        ("mixed", paid & zoned),
        ("residents", says("access", "private") & zoned),
        ("paid", paid & c("access").isin(PUBLIC)),
        ("free", says("fee", "no") & c("maxstay").isin(NOTHING) & ~zoned),
    ]])
    held = lambda m: F.col(f"_p_{m}")
    vehicle = F.when(F.col("_closed") & reduce(or_, map(held, MODES)), F.coalesce(*[F.when(held(m), F.lit(m)) for m in ("disabled", "taxi", "car_sharing")], F.lit("vehicle_restriction")))
    uses = [("loading", says("restriction", "loading_only")), ("charging", says("restriction", "charging_only")), ("time_limited", ~c("maxstay").isin(NOTHING) | (c("maxstay:conditional") != ""))]
    stops = [(k, says("restriction", k)) for k in ("no_parking", "no_standing", "no_stopping")]
    told = flags.withColumn("_who", F.concat_ws(";", payment, joined(uses), vehicle))
    private = ~c("access").isin([*PUBLIC, "destination"]) & ~F.col("_who").rlike("residents|paid|loading|charging|vehicle_restriction")
    found = F.nullif(F.concat_ws(";", F.nullif(F.col("_who"), empty), joined([("access_restriction", private), *stops])), empty)
    return told.select(*df.columns, found.alias("condition_class"), "vehicle_designated", "vehicle_excluded")
