"""Quality checks as data jobs (Q-01 .. Q-08)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conflicting_tags(pairs: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Q-01: (key, conflicts): tags (map a, map b) that both elements carry with different values."""
    label = lambda n: F.when(F.col("a")[n] != F.col("b")[n], F.concat(F.lit(f"{n}: "), F.col("a")[n], F.lit(" / "), F.col("b")[n]))
    found = pairs.select(key, F.array_compact(F.array(*[label(n) for n in names])).alias("c")).where(F.size("c") > 0)
    return found.groupBy(key).agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("c")))), "; ").alias("conflicts"))


def combinations(df: DataFrame, columns: Sequence[str], expected: Column, actual: Column) -> DataFrame:
    """Q-05: every combination of the columns with its count, what is expected and what there is, where they differ or vary."""
    got = df.groupBy(*columns, expected.alias("expected"), actual.alias("actual")).agg(F.count(F.lit(1)).alias("n"))
    return got.where(~F.col("expected").eqNullSafe(F.col("actual")))


def compare_runs(before: DataFrame, after: DataFrame, key: str, metric: str, least: float = 0.5) -> DataFrame:
    """Q-06: classes of either run whose metric moved by `least` or that only one run has."""
    b, a = before.select(key, F.col(metric).alias("before")), after.select(key, F.col(metric).alias("after"))
    both = b.join(a.hint("merge"), key, "full")
    return both.withColumn("moved", F.col("after") - F.col("before")).where(F.col("moved").isNull() | (F.abs("moved") >= least))


def jpeg_size(data: bytes) -> tuple[int, int] | None:
    """Width and height of a JPEG file by a walk over its segments to the frame header; None where it is cut short or damaged before the end of that header."""
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF:  # a fill byte
            at += 1
            continue
        if kind == 0x01 or 0xD0 <= kind <= 0xD7:  # markers without a length
            at += 2
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        if size < 2 or kind in (0xD8, 0xD9, 0xDA):  # image data before a frame header
            return None
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if size < 8 or at + 2 + size > len(data):
                return None
            return int.from_bytes(data[at + 7 : at + 9], "big"), int.from_bytes(data[at + 5 : at + 7], "big")
        at += 2 + size
    return None


def _jpeg_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        sizes = [jpeg_size(x.as_py()) if x.is_valid else None for x in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s and s[0] for s in sizes], pa.int32()), pa.array([s and s[1] for s in sizes], pa.int32())], ["path", "length", "width", "height"])


def tile_inventory(files: DataFrame, side: int | None = None) -> DataFrame:
    """Q-07: (path, kind, width, height, valid) of images (path, length, content).

    PNG sizes stand at a fixed place, those of a JPEG are found by a walk over its segments.  A file is valid if it is not
    empty, its header is whole and, where `side` is given, both sizes are that.
    """
    head = F.hex(F.substring("content", 1, 24))
    kind = F.when(head.startswith("89504E470D0A1A0A"), "png").when(head.startswith("FFD8"), "jpeg")
    number = lambda at: F.when((F.col("kind") == "png") & (F.length(head) == 48), F.conv(F.substring(head, at, 8), 16, 10)).cast("int")
    told = files.withColumn("kind", kind)
    png = told.where("kind is null or kind = 'png'").select("path", "kind", "length", number(33).alias("width"), number(41).alias("height"))
    jpeg = told.where("kind = 'jpeg'").select("path", "length", "content").mapInArrow(_jpeg_task, "path string, length long, width int, height int")
    every = png.unionByName(jpeg.withColumn("kind", F.lit("jpeg")))
    whole = F.col("width").isNotNull() & F.col("height").isNotNull() & (F.col("length") > 0)
    if side is not None:
        whole = whole & (F.col("width") == side) & (F.col("height") == side)
    return every.select("path", "kind", "width", "height", F.coalesce(whole, F.lit(False)).alias("valid"))


def mapping_issues(crossings: DataFrame, paths: DataFrame, names: Sequence[str]) -> DataFrame:
    """Q-01: (severity, element_id, path_id, issue): crossing nodes (node_id, tags) and the paths (node_id, path_id, class, tags) that run through them.

    Tags that node and crossing path both carry with different values are `critical`; a path that has crossing tags of
    its own at a crossing, but is no crossing, is a `warning`.
    """
    met = crossings.select("node_id", F.col("tags").alias("a")).join(paths.select("node_id", "path_id", "class", F.col("tags").alias("b")).hint("merge"), "node_id")
    own = conflicting_tags(met.where("class = 'crossing'").select(F.struct("node_id", "path_id").alias("key"), "a", "b"), "key", names)
    critical = own.select(F.lit("critical").alias("severity"), F.col("key.node_id").alias("element_id"), "key.path_id", F.col("conflicts").alias("issue"))
    tagged = F.array_compact(F.array(*[F.when(F.col("b")[n].isNotNull(), F.lit(n)) for n in names]))
    warning = met.where(~F.coalesce(F.col("class") == "crossing", F.lit(False))).withColumn("_t", tagged).where(F.size("_t") > 0)
    warning = warning.select(F.lit("warning").alias("severity"), F.col("node_id").alias("element_id"), "path_id", F.array_join(F.array_sort("_t"), "; ").alias("issue")).distinct()
    return critical.unionByName(warning)


def suppressed(before: DataFrame, after: DataFrame, key: str, reason: str) -> DataFrame:
    """Q-08: rows of `before` that are not in `after`, with the reason."""
    return before.join(after.select(key).hint("merge"), key, "left_anti").withColumn("reason", F.lit(reason))
