"""Scalar rules on tags as column expressions (P-01 .. P-41); no Python runs per row."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: degrees of cardinal words
CARDINAL = {
    "north": 0, "east": 90, "south": 180, "west": 270,
    "n": 0, "nne": 22, "ne": 45, "ene": 67, "e": 90, "ese": 112, "se": 135, "sse": 157, "s": 180, "ssw": 202, "sw": 225, "wsw": 247, "w": 270, "wnw": 292, "nw": 315, "nnw": 337,
    "northnortheast": 22, "northeast": 45, "eastnortheast": 67, "eastsoutheast": 112, "southeast": 135, "southsoutheast": 157, "southsouthwest": 202, "southwest": 225, "westsouthwest": 247,
    "westnorthwest": 292, "northwest": 315, "northnorthwest": 337,
    "north-north-east": 22, "north-east": 45, "east-north-east": 67, "east-south-east": 112, "south-east": 135, "south-south-east": 157, "south-south-west": 202, "south-west": 225,
    "west-south-west": 247, "west-north-west": 292, "north-west": 315, "north-north-west": 337,
}
# fixed values: modes of the parking rules, in their order
MODES = ["motorcar", "disabled", "bus", "taxi", "psv", "hgv", "goods", "car_sharing", "emergency", "motorhome"]
MODULUS, MULTIPLIER = 2147483647, 48271


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x: Column, digits: int = 0) -> Column:
    """floor(x * 10**d + 0.5) / 10**d."""
    f = 10.0**digits
    return F.floor(x * f + F.lit(0.5)) / F.lit(f)


def metric_number(x: Column | str) -> Column:
    """P-01: a bare number, or one with `m` or `cm` behind a space; else null."""
    t = F.trim(_c(x))
    number = r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$"
    bare = F.when(t.rlike(number), t.try_cast("double"))
    cm = F.regexp_extract(t, r"^(.*\S)\s+cm$", 1)
    m = F.regexp_extract(t, r"^(.*\S)\s+m$", 1)
    return F.when(bare.isNotNull(), bare).when(cm.rlike(number), cm.try_cast("double") / 100).when(m.rlike(number), m.try_cast("double"))


def parking_number(x: Column | str) -> Column:
    """P-02: comma as point, cut at the first character that can't be part of a number; null if unparsable."""
    t = F.regexp_replace(F.replace(_c(x), F.lit(","), F.lit(".")), "[^0-9.+-].*$", "")
    return F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), t.try_cast("double"))


def tag_list(x: Column | str, separators: str = ";") -> Column:
    """P-03: the parts between any of the separators, without empty ones."""
    return F.filter(F.split(_c(x), f"[{separators}]"), lambda p: p != "")


def cardinal_degrees(x: Column | str) -> Column:
    """P-04: degrees of a cardinal word, any case; null for others."""
    table = F.create_map(*[F.lit(v) for kv in CARDINAL.items() for v in (kv[0], float(kv[1]))])
    return table[F.lower(_c(x))]


def mid_angle(a: Column, b: Column) -> Column:
    """P-06: the middle of two angles, across north where they are more than 180 degrees apart."""
    a, b = F.pmod(a, F.lit(360.0)), F.pmod(b, F.lit(360.0))
    mid = (a + b) / 2
    return F.when(F.abs(a - b) > 180, F.pmod(mid + 180, F.lit(360.0))).otherwise(mid)


def direction_degrees(x: Column | str) -> Column:
    """P-05: a number (below 0: plus 360), a cardinal word, two opposite values (the first), or a range (its middle)."""
    t = _c(x)
    number = F.when(t.rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)\s*$"), F.trim(t).try_cast("double"))
    parts = tag_list(t)
    one = lambda i: F.try_element_at(parts, F.lit(i))
    num = lambda i: F.when(one(i).rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)\s*$"), F.trim(one(i)).try_cast("double"))
    opposite = F.when(F.size(parts) == 2, F.when(F.abs(num(1) - num(2)) == 180, num(1)).when(F.abs(cardinal_degrees(one(1)) - cardinal_degrees(one(2))) == 180, cardinal_degrees(one(1))))
    low = F.regexp_extract(t, r"^(-?\d+)-(\d+)$", 1).try_cast("double")
    high = F.regexp_extract(t, r"^(-?\d+)-(\d+)$", 2).try_cast("double")
    return (
        F.when(number.isNotNull(), F.when(number < 0, number + 360).otherwise(number))
        .when(cardinal_degrees(t).isNotNull(), cardinal_degrees(t))
        .when(t.contains(";"), opposite)
        .when(low.isNotNull() & high.isNotNull(), mid_angle(low, high))
    )


def stable_fraction(x: Column | str, salt: int) -> Column:
    """P-07: a repeatable fraction of [0, 1) from an id; whole numbers only, no hash."""
    s = F.pmod(F.pmod(_c(x).cast("long"), F.lit(MODULUS)) + salt, F.lit(MODULUS))
    return F.pmod(s * MULTIPLIER, F.lit(MODULUS)) / F.lit(float(MODULUS))


def row_mean(*xs: Column) -> Column:
    """P-08: the mean of the columns that aren't null."""
    got = F.filter(F.array(*xs), lambda v: v.isNotNull())
    return F.when(F.size(got) > 0, F.aggregate(got, F.lit(0.0), lambda s, v: s + v) / F.size(got))


def access_for(tags: Column, mode: str, foot: bool = False) -> Column:
    """P-09: the mode's own key, then vehicle (not on foot), then access."""
    keys = [mode, *([] if foot else ["vehicle"]), "access"]
    return F.coalesce(*[tags[k] for k in keys])


def tag_present(x: Column) -> Column:
    """P-10: not null, empty, no or none."""
    return F.coalesce(~x.isin("", "no", "none"), F.lit(False))


def pipe_values(x: Column | str) -> Column:
    """P-21: slots between pipes; empty ones are null."""
    return F.transform(F.split(_c(x), r"\|"), lambda p: F.nullif(p, F.lit("")))


def count_value(slots: Column, value: str) -> Column:
    return F.size(F.filter(slots, lambda p: p == value))


def placement(x: Column | str) -> Column:
    """P-21: left_of:n is n - 1, right_of:n is n, middle_of:n is n - 0.5."""
    n = F.regexp_extract(_c(x), r"^(left_of|right_of|middle_of):(\d+)$", 2).try_cast("double")
    kind = F.regexp_extract(_c(x), r"^(left_of|right_of|middle_of):(\d+)$", 1)
    return F.when(kind == "left_of", n - 1).when(kind == "right_of", n).when(kind == "middle_of", n - 0.5)


def side_tag(tags: Column, base: str, side: str | Column, key: str = "") -> Column:
    """P-22: base:side[:key], then base:both[:key]; the side may differ by row."""
    end = f":{key}" if key else ""
    own = tags[f"{base}:{side}{end}"] if isinstance(side, str) else tags[F.concat(F.lit(f"{base}:"), side, F.lit(end))]
    return F.coalesce(own, tags[f"{base}:both{end}"])


def conditional_has(x: Column, value: str) -> Column:
    """P-23: whether a conditional tag gives `value @ ...`."""
    return F.coalesce(x.rlike(rf"(^|;\s*){value}\s*@"), F.lit(False))


def joined(labels: list[tuple[str, Column]]) -> Column:
    """The labels whose condition holds, in order, joined by semicolons; null if none does."""
    # concat_ws passes over nulls, and stays inside generated code, which functions with a lambda leave
    return F.nullif(F.concat_ws(";", *[F.when(c, F.lit(k)) for k, c in labels]), F.lit(""))


def road_width(tags: Column) -> Column:
    """P-26: the first number of width:carriageway, width and est_width, else a default by class."""
    kind = tags["highway"]
    default = (
        F.when(kind == "primary", 17.0).when(kind == "secondary", 15.0).when(kind == "tertiary", 13.0).when((kind == "service") & (tags["service"] == "driveway"), 2.5)
        .when(kind.isin("service", "track", "pedestrian", "living_street", "unclassified", "residential", "road"), 8.0).otherwise(4.0)
    )
    return F.coalesce(parking_number(tags["width:carriageway"]), parking_number(tags["width"]), parking_number(tags["est_width"]), default)


def drop_token(x: Column, token: str) -> Column:
    """P-27: a `;` list without one token; null if nothing is left."""
    return F.nullif(F.array_join(F.array_remove(F.split(x, ";"), token), ";"), F.lit(""))


def rotation_bucket(degrees: Column, step: int = 15, shift: int = 0) -> Column:
    """P-28: rNNN, the nearest multiple of `step` (half up), mod 360."""
    n = F.pmod(F.floor(degrees / step + F.lit(0.5)).cast("long") * step + shift, F.lit(360))
    return F.concat(F.lit("r"), F.lpad(n.cast("string"), 3, "0"))


def min_zoom(area: Column, scale: float) -> Column:
    """P-29: the zoom from which a place of this area is named."""
    return 16 + F.log(F.lit(scale) / area) / F.lit(math.log(2))


def stratum(layer: Column) -> Column:
    """P-34: drawing layer, clamped to -2 .. 3; null is 0."""
    return F.least(F.greatest(F.coalesce(layer, F.lit(0)), F.lit(-2)), F.lit(3))


def building_height(levels: Column, part_of: Column) -> Column:
    """P-35: three metres a level; roofs and service parts 3, others 5."""
    return F.when(levels.isNotNull(), levels * 3.0).when(part_of.isin("roof", "service"), 3.0).otherwise(5.0)


def shade_length(height: Column, base: float = 0.0, most: float = 5.0, scale: float = 30.0) -> Column:
    """P-36: how far a wall of this height throws its shade."""
    return F.lit(base) + F.lit(most - base) * (1 - F.exp(-height / F.lit(scale)))


def crs_factor(latitude: Column, epsg: int = 3857) -> Column:
    """P-37: map units per ground metre."""
    if epsg != 3857:
        return F.lit(1.0)
    return 1 / F.cos(F.radians(F.least(F.greatest(latitude, F.lit(-85.0)), F.lit(85.0))))


def metres(x: Column, factor: Column) -> Column:
    """P-37: ground metres in map units; a missing factor is an error, never 1."""
    return F.when(factor.isNull(), F.raise_error(F.lit("no scale factor")).cast("double")).otherwise(x * factor)


def lab(r: Column, g: Column, b: Column) -> Column:
    """P-40: sRGB (0..255) as CIE Lab (D65)."""
    lin = lambda c: F.when(c / 255.0 <= 0.04045, c / 255.0 / 12.92).otherwise(F.pow((c / 255.0 + 0.055) / 1.055, F.lit(2.4)))
    r, g, b = lin(r), lin(g), lin(b)
    # fixed values: sRGB to XYZ over the D65 white point
    xyz = [(0.4124564 * r + 0.3575761 * g + 0.1804375 * b) / 0.95047, 0.2126729 * r + 0.7151522 * g + 0.0721750 * b, (0.0193339 * r + 0.1191920 * g + 0.9503041 * b) / 1.08883]
    f = lambda t: F.when(t > 0.008856, F.pow(t, F.lit(1 / 3))).otherwise(7.787 * t + 16 / 116)
    x, y, z = map(f, xyz)
    return F.struct((116 * y - 16).alias("l"), (500 * (x - y)).alias("a"), (200 * (y - z)).alias("b"))


def delta_e(p: Column, q: Column) -> Column:
    """P-40: CIE76 difference of two Lab colours."""
    return F.sqrt(F.pow(p["l"] - q["l"], 2) + F.pow(p["a"] - q["a"], 2) + F.pow(p["b"] - q["b"], 2))


HALF_WORLD = 20037508.342789244


def tile_key(x: Column, y: Column, zoom: int) -> Column:
    """P-41: z/x/y of the tile that holds a Web-Mercator point."""
    n = 1 << zoom
    size = 2 * HALF_WORLD / n
    return F.concat_ws("/", F.lit(str(zoom)), F.floor((x + HALF_WORLD) / size).cast("string"), F.floor((F.lit(HALF_WORLD) - y) / size).cast("string"))


def crown_diameter(tags: Column, osm_id: Column, year: int) -> Column:
    """P-12: mapped, or the mean of what height, trunk and age tell (2..25 m), or stable variation; null for stumps."""
    height, trunk = metric_number(tags["height"]), metric_number(tags["circumference"])
    born = F.substring(tags["start_date"], 1, 4).try_cast("double")
    now = float(max(2025, min(2050, year)))
    guess = row_mean(height * 0.6, F.when(trunk < 50, trunk * 7.6), (F.lit(now) - born) * 0.2)
    part = stable_fraction(osm_id, 104729)
    free = F.when(tags["natural"] == "tree", round_half_up(part * 4 + 5, 1)).otherwise(round_half_up(part * 3 + 3, 1))
    size = F.coalesce(metric_number(tags["diameter_crown"]), F.when(guess.isNotNull(), round_half_up(F.greatest(F.lit(2.0), F.least(F.lit(25.0), guess)), 1)), free)
    return F.when(F.coalesce(tags["natural"] == "tree_stump", F.lit(False)), F.lit(None).cast("double")).otherwise(size)


def car_rotation(way: Column, angle: Column, left_of_one_way: Column, space_id: Column, latitude: Column) -> Column:
    """P-31: icon rotation by orientation and side, less 1 / cos(latitude), mod 360; unknown orientations vary by id."""
    free = F.pmod(F.conv(F.substring(F.sha2(space_id, 256), 1, 8), 16, 10).cast("long"), F.lit(360)).cast("double")
    turn = (
        F.when(way == "parallel", angle + F.when(left_of_one_way, 180).otherwise(0))
        .when(way == "diagonal", angle + F.when(left_of_one_way, 126).otherwise(54))
        .when(way == "perpendicular", angle - 90)
        .otherwise(free)
    )
    return F.pmod(turn - 1 / F.cos(F.radians(latitude)) + 360, F.lit(360.0))


# fixed values: dash arrays by marking or type, the first that fits
DASHES = [("road_marking", "crossing_edge", "0.5;0.25"), ("type", "bicycle", "1;1"), ("type", "bus", "5;1"), ("type", "parking", "1;1"), ("road_marking", "stop_line", "0.5;0.25"), ("stroke", "sharks_teeth", "0.5;0.25"), ("road_marking", "edge_line", "1;1")]
DASH_DEFAULT = "3;3"


def dash_default(stroke: Column, marking: Column, kind: Column, given: Column) -> Column:
    """P-32: dashes only for dashed strokes and sharks' teeth: as tagged, else by marking or type."""
    of = {"stroke": stroke, "road_marking": marking, "type": kind}
    by_rule = F.coalesce(*[F.when(of[c] == v, d) for c, v, d in DASHES], F.lit(DASH_DEFAULT))
    dashed = F.coalesce(stroke.contains("dashed") | (stroke == "sharks_teeth"), F.lit(False))
    return F.when(dashed, F.coalesce(F.nullif(F.trim(given), F.lit("")), by_rule))


def sign_size(width: Column, length: Column, default: float, factor: float = 2.0) -> Column:
    """P-33: width and length of a painted sign; the length is `factor` times the width."""
    w = F.coalesce(width, F.lit(default))
    return F.struct(w.alias("width"), F.coalesce(length, w * factor).alias("length"))


# fixed values: sign numbers of words
SIGNS = {"city_limit": "310", "maxspeed": "274", "stop": "206", "give_way": "205", "maxwidth": "264", "maxheight": "265", "maxweight": "262", "stop_ahead": "205,1004-32", "yield_ahead": "205,1004-30", "signal_ahead": "131", "hazard": "101"}


def parse_traffic_sign(tags: Column, country: str = "DE") -> Column:
    """P-14: (country_code, sign_main, sign_list) of a traffic_sign tag; null without a sign.

    Words become numbers (maxspeed with its value), and give the default country.
    """
    value = F.regexp_replace(tags["traffic_sign"], "(none|no|yes|street_name_sign)[;,]?", "")
    code = F.nullif(F.regexp_extract(value, r"^([^:\[\],;]*):", 1), F.lit(""))
    rest = F.when(code.isNotNull(), F.substring(value, F.length(code) + 2, F.length(value))).otherwise(value)
    parts = tag_list(rest, ";,")
    table = F.create_map(*[F.lit(x) for kv in SIGNS.items() for x in kv])

    def number(sign: Column) -> Column:
        speed = F.when(tags["maxspeed"] == "implicit", "278").when(tags["maxspeed"].try_cast("double").isNotNull(), F.concat(F.lit("274-"), tags["maxspeed"])).otherwise("274")
        return F.when((sign == "city_limit") & F.coalesce(tags["city_limit"] == "end", F.lit(False)), "311").when(sign == "maxspeed", speed).otherwise(F.coalesce(table[sign], sign))

    worded = F.exists(parts, lambda s: table[s].isNotNull())
    numbers = F.transform(parts, number)
    main = F.regexp_replace(F.try_element_at(numbers, F.lit(1)), r"\[[^\]]*\]", "")
    found = F.struct(F.coalesce(code, F.when(worded, country)).alias("country_code"), main.alias("sign_main"), F.array_join(numbers, ";").alias("sign_list"))
    return F.when(F.size(parts) > 0, found)


def pass_through(tags: Column, columns: list[str], numbers: list[str]) -> Column:
    """P-11: the tags of a layer's columns as a struct: those in `numbers` as metric numbers; a surface colour may stand under `colour`."""
    text = lambda k: F.coalesce(tags[k], tags["colour"]) if k == "surface:colour" else tags[k]
    return F.struct(*[(metric_number(text(k)) if k in numbers else text(k)).alias(k) for k in columns])


# fixed values: parking positions on the carriageway, and uses that a space's symbol shows, first ones first
ON_CARRIAGEWAY = ["lane", "street_side"]
SPACE_SYMBOLS = [("wheelchair", "disabled", "disabled", "designated"), ("charging", "charging", "restriction", "charging_only"), ("loading", "loading", "restriction", "loading_only")]


def parking_area(tags: Column) -> Column:
    """P-17: (area_highway, type, class, symbol) of a parking area that belongs to the carriageway; null for others."""
    row = lambda area, kind, sub=None, symbol=None: F.struct(F.lit(area).alias("area_highway"), kind.alias("type"), (F.lit(None).cast("string") if sub is None else sub).alias("class"), (F.lit(None).cast("string") if symbol is None else symbol).alias("symbol"))
    use = tags["parking_space"]
    shows = lambda value, key, word: F.coalesce(use == value, F.lit(False)) | F.coalesce(tags[key] == word, F.lit(False)) | F.coalesce(tags[f"{key}:conditional"].contains(word), F.lit(False))
    symbol = F.coalesce(*[F.when(shows(value, key, word), F.lit(name)) for name, value, key, word in SPACE_SYMBOLS])
    placed = lambda k: F.when(tags[k].isin(ON_CARRIAGEWAY), tags[k])
    two_wheel = F.coalesce(placed("parking"), placed("position"))
    return (
        F.when(tags["amenity"] == "parking_space", row("parking_space", F.lit("parking_space"), F.when(~use.isin("", "yes", "no", "none"), use), symbol))
        .when((tags["amenity"] == "motorcycle_parking") & two_wheel.isNotNull(), row("parking_two_wheel", two_wheel))
        .when((tags["amenity"] == "parking") & placed("parking").isNotNull(), row("parking", placed("parking")))
    )


# fixed values: strokes of crossing markings by how the value begins, and those of exact values
CROSSING_AREAS = ["zebra", "ladder", "pictograms"]
CROSSING_LINES = {"dots": "dots", "dashes": "dashed", "lines": "solid", "lines:paired": "double_solid"}


def crossing_kind(crossing: Column, reference: Column, markings: Column, buffer: Column, is_surface: Column) -> Column:
    """P-39: (kind, stroke): marked along the centreline (zebra, ladder, pictograms), by a buffer at its side, or at its edges."""
    begins = lambda word: F.coalesce(markings.startswith(word), F.lit(False))
    zebra = begins("zebra") | F.coalesce(crossing == "zebra", F.lit(False)) | F.coalesce(reference == "zebra", F.lit(False))
    along = zebra | begins("ladder") | begins("pictograms")
    signed = F.coalesce(crossing.isin("traffic_signals", "marked", "zebra"), F.lit(False)) | F.coalesce(~markings.isin("no", "surface"), F.lit(False))
    kind = F.when(along, "centerline").when(buffer.isNotNull() & ~signed, "side").when((signed | buffer.isNotNull()) & ~is_surface, "edge")
    lines = F.create_map(*[F.lit(x) for kv in CROSSING_LINES.items() for x in kv])
    stroke = F.coalesce(F.when(zebra, F.lit("zebra")), *[F.when(begins(w), F.lit(w)) for w in CROSSING_AREAS[1:]], lines[markings], F.when(crossing.isin("traffic_signals", "marked"), F.lit("dashed")))
    return F.struct(kind.alias("kind"), stroke.alias("stroke"))


def needs_lanes(tags: Column, roads: list[str]) -> Column:
    """L-09: whether a way gets lanes: roads of these classes, cycleways that are no links, marked ways and those with turn lanes."""
    value = F.when((tags["highway"] == "construction") & tag_present(tags["construction"]), tags["construction"]).otherwise(tags["highway"])
    turns = F.size(F.map_filter(tags, lambda k, v: ((k == "turn") | (k == "turn:lanes") | k.startswith("turn:lanes:")) & tag_present(v))) > 0
    some = F.coalesce(value.isin([*roads, "cycleway"]), F.lit(False)) | F.coalesce(tags["road_marking"] == "yes", F.lit(False)) | turns
    link = F.coalesce((value == "cycleway") & (tags["cycleway"] == "link"), F.lit(False))
    return some & ~link


# fixed values: symbols by class, then by what the subclass holds; the first rule that fits counts
SYMBOLS = [
    ("bench", "backrest_no", "icon-amenity-bench-backrest-no", 1.7), ("bench", "", "icon-amenity-bench", 1.7), ("bicycle_parking", "cargo_bike", "icon-amenity-bicycle", 2.2), ("bicycle_parking", "", "icon-amenity-bicycle", 1.8),
    ("fountain", "", "icon-amenity-fountain", 3.2), ("information", "guidepost", "icon-tourism-guidepost", 1.8), ("information", "", "icon-tourism-information", 1.2), ("manhole", "", "icon-man-made-manhole", 0.75),
    ("post_box", "PIN Mail", "icon-amenity-post-box-yellow", 1.2), ("post_box", "", "icon-amenity-post-box-green", 1.2), ("recycling", "", "icon-amenity-recycling", 1.4), ("telephone", "", "icon-amenity-telephone", 1.2),
    ("toilets", "", "icon-amenity-toilets", 1.6), ("entrance", "subway", "icon-public-transport-subway", 2.0), ("entrance", "s-train", "icon-public-transport-s-train", 2.2),
    ("street_lamp", "", "marker-street-lamp", 1.0), ("street_cabinet", "", "marker-street-cabinet", 1.0), ("vending_machine", "parking_tickets", "marker-parking-tickets", 0.7), ("vending_machine", "", "marker-vending-machine", 0.5),
    ("charging_station", "", "marker-charging-station", 0.7), ("planter", "", "marker-planter", 1.0), ("pole", "", "marker-pole", 0.6), ("mast", "", "marker-mast", 0.9), ("guard_stone", "", "marker-guard-stone", 0.8),
]
# fixed values: turns of symbols against the direction of what they show; the second is the direction where there is none
SYMBOL_TURNS = {"bench": (-180.0, None), "street_cabinet": (90.0, 0.0), "vending_machine": (90.0, 0.0), "charging_station": (0.0, 0.0), "guard_stone": (-90.0, 0.0), "traffic_sign": (180.0, 0.0)}


def symbolise(df: DataFrame, rules: list[tuple[str, str, str, float]] | None = None, turns: dict[str, tuple[float, float | None]] | None = None) -> DataFrame:
    """P-30: adds symbol, size and rotation to rows (class, subclass, direction); classes without a rule have no symbol, and size 1.6."""
    kind, sub = F.col("class"), F.coalesce("subclass", F.lit(""))
    found = F.coalesce(*[F.when((kind == c) & sub.contains(s), F.struct(F.lit(name).alias("symbol"), F.lit(size).alias("size"))) for c, s, name, size in rules or SYMBOLS])
    turn = F.coalesce(*[F.when(kind == c, (F.col("direction") if start is None else F.coalesce("direction", F.lit(start))) + by) for c, (by, start) in (turns or SYMBOL_TURNS).items()], F.lit(0.0))
    return df.withColumn("_s", found).select(*df.columns, F.col("_s.symbol").alias("symbol"), F.coalesce("_s.size", F.lit(1.6)).alias("size"), turn.alias("rotation"))
