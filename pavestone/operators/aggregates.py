"""Aggregations (A-01 .. A-19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dominant(df: DataFrame, key: str, value: str, weight: str, count_null: bool = True) -> DataFrame:
    """A-01: per key the value of the largest summed weight, the smaller value on ties; null may win when counted."""
    rows = df if count_null else df.where(F.col(value).isNotNull())
    sums = rows.groupBy(key, value).agg(F.sum(weight).alias("w"))
    # a maximum of (weight, then the smaller value) needs no sort; nulls lose ties
    best = sums.groupBy(key).agg(F.min(F.struct((-F.col("w")).alias("w"), F.col(value).isNull().alias("n"), F.col(value).alias("v"))).alias("m"))
    return best.select(key, F.col("m.v").alias(value), (-F.col("m.w")).alias("weight"))


def winner_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """A-02: columns of the first row of each key, by a running minimum instead of a sort."""
    o = [c.alias(f"o{i}") for i, c in enumerate(order)]
    return df.groupBy(*keys).agg(F.min(F.struct(*o, *columns)).alias("m")).select(*keys, *[F.col(f"m.{c}").alias(c) for c in columns])


def weighted_median(df: DataFrame, key: str, value: str, weight: str, row_id: str) -> DataFrame:
    """A-03: per key the first value, in order of (value, row id), whose running weight reaches half of all; weights are not negative.

    Rows of equal values are summed first: a key of very many rows is then as long as its distinct values.
    """
    sums = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(weight).alias("_w"))
    w = Window.partitionBy(key).orderBy(value)
    rows = sums.withColumn("_run", F.sum("_w").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_w").over(Window.partitionBy(key)))
    return rows.where(F.col("_run") * 2 >= F.col("_all")).groupBy(key).agg(F.min(value).alias(value))


def vertex_degree(points: DataFrame) -> DataFrame:
    """A-05: points (x, y, inner): each end of a line counts 1, each inner vertex 2."""
    return points.groupBy("x", "y").agg(F.sum(F.when(F.col("inner"), 2).otherwise(1)).alias("degree"))


def circular_mean(df: DataFrame, key: str, degrees: str, order: str) -> DataFrame:
    """A-06: mean angle per key after turning every angle more than 90 degrees off the first one around."""
    ref = df.groupBy(key).agg(F.min(F.struct(order, degrees)).alias("m"), F.count(F.lit(1)).alias("n")).select(key, F.col(f"m.{degrees}").alias("ref"), "n")
    d = F.pmod(F.col(degrees) - F.col("ref"), F.lit(360.0))
    turned = F.radians(F.when(F.least(d, 360.0 - d) > 90, F.col(degrees) + 180).otherwise(F.col(degrees)))
    rows = df.join(ref.hint("merge"), key).select(key, "ref", "n", F.sin(turned).alias("s"), F.cos(turned).alias("c"))
    mean = rows.groupBy(key).agg(F.avg("s").alias("s"), F.avg("c").alias("c"), F.first("ref").alias("ref"), F.first("n").alias("n"))
    return mean.select(key, F.when(F.col("n") == 1, F.col("ref")).otherwise(F.pmod(F.degrees(F.atan2("s", "c")), F.lit(360.0))).alias("angle"))


def allocate(df: DataFrame, key: str, total: str, weight: str) -> DataFrame:
    """A-11: adds `share`, the key's total dealt out by weight and rounded."""
    sums = df.groupBy(key).agg(F.sum(weight).alias("_all"))
    return df.join(sums.hint("merge"), key).withColumn("share", F.round(F.col(total) * F.col(weight) / F.nullif(F.col("_all"), F.lit(0))).cast("int")).drop("_all")


def capacity(length: Column, way: Column, bus: Column) -> Column:
    """A-12: vehicles that fit: floor((length + gap) / pitch), the gap being pitch less extent."""
    pitch = F.when(bus, F.when(way == "parallel", 12.0).when(way == "diagonal", 5.0).otherwise(4.0)).otherwise(F.when(way == "parallel", 5.2).when(way == "diagonal", 3.1).otherwise(2.5))
    long, wide = F.when(bus, 12.0).otherwise(4.4), F.when(bus, 2.5).otherwise(1.8)
    extent = F.when(way == "parallel", long).when(way == "diagonal", F.sqrt(wide * wide / 2) + F.sqrt(long * long / 2)).otherwise(wide)
    return F.floor((length + pitch - extent) / pitch).cast("int")


def covered(lines: DataFrame, pieces: DataFrame, points: DataFrame, spacing: float, share: float, key: str = "line_id") -> DataFrame:
    """A-09: lines (key, total) whose pieces (key, length) and points (key), a spacing apart, cover at least `share` of them."""
    p = pieces.groupBy(key).agg(F.sum("length").alias("explicit"))
    n = points.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    both = lines.join(p.hint("merge"), key, "left").join(n.hint("merge"), key, "left")
    length = F.coalesce("explicit", F.lit(0.0)) + F.greatest(F.coalesce("n", F.lit(0)) - 1, F.lit(0)) * F.lit(spacing)
    return both.select(key, length.alias("covered"), (length >= F.col("total") * share).alias("is_covered"))


def conflicts(df: DataFrame, key: str, label: Column) -> DataFrame:
    """A-13: the distinct labels of a key, sorted and joined."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(label)), "; ").alias("conflicts"))


def class_difference(pixels: DataFrame) -> DataFrame:
    """A-17: per class the medians of two colours (a_*, b_* channels), their difference, and its weight by the class's share."""
    from ..functions.tags import delta_e, lab

    names = [f"{p}_{c}" for p in "ab" for c in "rgb"]
    # channels have few values: counts of each come first, so no class is held in memory
    each = pixels.select("class", F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("v")) for c in names])).alias("e"))
    counts = each.groupBy("class", "e.channel", "e.v").agg(F.count(F.lit(1)).alias("k"))
    own = lambda c: F.expr(f"percentile(CASE WHEN channel = '{c}' THEN v END, 0.5, CASE WHEN channel = '{c}' THEN k ELSE 0 END)").alias(c)
    med = counts.groupBy("class").agg(*[own(c) for c in names]).join(pixels.groupBy("class").agg(F.count(F.lit(1)).alias("n")).hint("merge"), "class")
    total = F.sum("n").over(Window.partitionBy())
    d = delta_e(lab(F.col("a_r"), F.col("a_g"), F.col("a_b")), lab(F.col("b_r"), F.col("b_g"), F.col("b_b")))
    return med.select("class", "n", d.alias("delta_e"), (F.col("n") / total).alias("share")).withColumn("impact", F.col("delta_e") * F.col("share"))


def tile_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """A-19: per tile the mean of the largest channel difference, and the share of pixels above 12."""
    j = a.alias("a").join(b.alias("b").hint("merge"), ["tile", "px", "py"])
    worst = F.greatest(*[F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) for c in "rgb"])
    return j.groupBy("tile").agg(F.avg(worst).alias("mean_difference"), F.avg((worst > 12).cast("int")).alias("share_above"))


def similar_or_overlapping(pairs: DataFrame, ratio: float = 2.0, share: float = 0.25) -> DataFrame:
    """A-10: pairs (area_a, area_b, diameter_a, diameter_b, common) alike in area and diameter, or overlapping by `share` of a."""
    within = lambda x, y: (x / y).between(1 / ratio, ratio)
    alike = within(F.col("area_a"), F.col("area_b")) & within(F.col("diameter_a"), F.col("diameter_b"))
    return pairs.where(alike | (F.col("common") >= share * F.col("area_a")))
