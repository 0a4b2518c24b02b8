"""Lanes of a road as ordered rows (L-01 .. L-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.tags import count_value, pipe_values

DEFAULT_WIDTH = 3.0


def lane_counts(tags: Column) -> Column:
    """L-01: lanes forward, backward and both ways, from the tags or by class and one-way."""
    number = lambda k: tags[k].try_cast("int")
    total = number("lanes")
    one_way = F.coalesce(tags["oneway"].isin("yes", "1", "true"), F.lit(False))
    both = F.coalesce(number("lanes:both_ways"), F.lit(0))
    default = F.when(one_way | tags["highway"].isin("service", "track", "living_street"), 1).otherwise(2)
    all_ = F.coalesce(total, F.when(number("lanes:forward").isNotNull() & number("lanes:backward").isNotNull(), number("lanes:forward") + number("lanes:backward") + both), default)
    backward = F.when(one_way, F.coalesce(number("lanes:backward"), F.lit(0))).otherwise(F.coalesce(number("lanes:backward"), F.when(number("lanes:forward").isNotNull(), F.greatest(all_ - both - number("lanes:forward"), F.lit(0))), F.floor((all_ - both) / 2).cast("int")))
    forward = F.coalesce(number("lanes:forward"), F.greatest(all_ - both - backward, F.lit(0)))
    return F.struct(forward.cast("int").alias("forward"), backward.cast("int").alias("backward"), both.alias("both"))


def lane_totals(tags: Column) -> Column:
    """L-02: vehicle lanes and the bus and cycle lanes that lists of slots add or mark."""
    c = lane_counts(tags)
    bus = F.greatest(count_value(pipe_values(F.coalesce(tags["bus:lanes"], tags["psv:lanes"], F.lit(""))), "designated"), F.coalesce(tags["lanes:bus"].try_cast("int"), tags["lanes:psv"].try_cast("int"), F.lit(0)))
    cycle = count_value(pipe_values(F.coalesce(tags["cycleway:lanes"], F.lit(""))), "lane")
    return F.struct(c["forward"].alias("forward"), c["backward"].alias("backward"), c["both"].alias("both"), bus.alias("bus"), cycle.alias("cycle"))


def derive_lanes(roads: DataFrame) -> DataFrame:
    """L-03: a row per lane (line_id, lane_index from the left, direction, width): backward lanes first, in reverse."""
    tags = F.col("tags")
    c = lane_counts(tags)
    slots = lambda key: pipe_values(F.coalesce(tags[key], F.lit("")))
    own = lambda key, i: F.try_element_at(slots(key), i).try_cast("double")
    lane = lambda d, i, w: F.struct(F.lit(d).alias("direction"), w.alias("width"))
    upto = lambda n: F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    share = tags["width"].try_cast("double") / F.nullif(c["forward"] + c["backward"] + c["both"], F.lit(0))
    width = lambda key, i: F.coalesce(own(key, i), share, F.lit(DEFAULT_WIDTH))
    back = F.reverse(F.transform(upto(c["backward"]), lambda i: lane("backward", i, width("width:lanes:backward", i))))
    mid = F.transform(upto(c["both"]), lambda i: lane("both_ways", i, width("width:lanes:both_ways", i)))
    ahead = F.transform(upto(c["forward"]), lambda i: lane("forward", i, F.coalesce(own("width:lanes:forward", i), own("width:lanes", i), share, F.lit(DEFAULT_WIDTH))))
    return roads.select("line_id", F.posexplode(F.concat(back, mid, ahead)).alias("p", "l")).select("line_id", (F.col("p") + 1).alias("lane_index"), "l.direction", "l.width")


def add_side_lanes(lanes: DataFrame, sides: DataFrame) -> DataFrame:
    """L-04, L-05: lanes with side lanes (line_id, side, type, width) put before the first or after the last, and numbered anew."""
    w = Window.partitionBy("line_id")
    last = lanes.groupBy("line_id").agg(F.max("lane_index").alias("n"))
    extra = sides.join(last.hint("merge"), "line_id").select("line_id", F.when(F.col("side") == "left", F.lit(0)).otherwise(F.col("n") + 1).alias("lane_index"), F.when(F.col("side") == "left", "backward").otherwise("forward").alias("direction"), "width", "type")
    every = lanes.withColumn("type", F.lit("vehicle")).select("line_id", "lane_index", "direction", "width", "type").unionByName(extra)
    return every.withColumn("lane_index", F.row_number().over(w.orderBy("lane_index", "type")))


def neighbour_rules(lanes: DataFrame) -> DataFrame:
    """L-06: adds `class` (bicycle lanes between motor lanes of one direction run in the centre) and `marking_left`, told once per border."""
    w = Window.partitionBy("line_id").orderBy("lane_index")
    motor = lambda c: c.isin("vehicle", "bus")
    before, after = F.lag("type").over(w), F.lead("type").over(w)
    same = (F.lag("direction").over(w) == F.col("direction")) & (F.lead("direction").over(w) == F.col("direction"))
    centre = (F.col("type") == "bicycle") & motor(before) & motor(after) & same
    return lanes.withColumn("class", F.when(F.coalesce(centre, F.lit(False)), "center_running")).withColumn("marking_left", F.when(F.lag("type").over(w).isNotNull(), F.when(F.lag("direction").over(w) != F.col("direction"), "solid_line").otherwise("dashed_line")))


def effective_width(lanes: DataFrame, least: float = 2.0) -> DataFrame:
    """L-07: spreads what a road's mapped width (road_width) leaves over its lanes of default width (is_default), `least` at least."""
    sums = lanes.groupBy("line_id").agg(F.sum(F.when(~F.col("is_default"), F.col("width")).otherwise(0.0)).alias("fixed"), F.count_if("is_default").alias("free"))
    spread = F.greatest((F.col("road_width") - F.col("fixed")) / F.nullif(F.col("free"), F.lit(0)), F.lit(least))
    return lanes.join(sums.hint("merge"), "line_id").withColumn("width", F.when(F.col("is_default") & F.col("road_width").isNotNull(), spread).otherwise(F.col("width"))).drop("fixed", "free")


def lane_offsets(lanes: DataFrame) -> DataFrame:
    """L-08: adds `offset` of a lane's middle from the road's line: the left border is half the sum of widths, then a running sum."""
    w = Window.partitionBy("line_id").orderBy("lane_index")
    total = F.sum("width").over(Window.partitionBy("line_id"))
    before = F.coalesce(F.sum("width").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return lanes.withColumn("offset", -total / 2 + before + F.col("width") / 2)


def flow_counts(lanes: DataFrame) -> DataFrame:
    """L-11: (line_id, forward, backward): lanes along and against the way; a lane for both counts in each."""
    return lanes.groupBy("line_id").agg(F.count_if(F.col("direction").isin("forward", "both_ways")).alias("forward"), F.count_if(F.col("direction").isin("backward", "both_ways")).alias("backward"))


def split_both_ways(lanes: DataFrame) -> DataFrame:
    """L-12: a lane for both ways as two of half the width, a quarter of it to each side."""
    both = F.col("direction") == "both_ways"
    half = lambda d, sign: F.struct(F.lit(d).alias("direction"), (F.col("width") / 2).alias("width"), (F.col("offset") + sign * F.col("width") / 4).alias("offset"))
    same = F.struct("direction", "width", "offset")
    out = lanes.withColumn("s", F.explode(F.when(both, F.array(half("backward", -1), half("forward", 1))).otherwise(F.array(same))))
    return out.select(*[c for c in lanes.columns if c not in ("direction", "width", "offset")], "s.*")
