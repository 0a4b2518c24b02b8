"""GeoJSON collections of any size (S-06): many tasks read one file, which may be a single line.

Spark splits a file at closing braces.  What a task reads are pieces of bounded size that begin behind such a
brace, so no piece begins behind a backslash.  Whether it begins inside a string, and how deep, is a sum over the
pieces before it: each piece tells its quotes and its brackets for both cases.  Then every piece gives its
whole features, and those that lie over several pieces are put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import written

PIECE_BYTES = 4 << 20
#: Objects of `features` stand at this depth: the collection, its array, the feature.
DEPTH = 3


class Piece:
    """Brackets and quotes of a piece of JSON text that does not begin behind a backslash."""

    def __init__(self, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        quote, slash = data == 34, data == 92
        if slash.any() and quote.any():
            at = np.arange(len(data))
            plain = np.maximum.accumulate(np.where(slash, -1, at))
            before = np.concatenate([[-1], plain[:-1]])
            quote &= (at - 1 - before) % 2 == 0  # an odd number of backslashes before it escapes a quote
        self.data = data
        self.odd = (np.cumsum(quote) - quote) % 2 == 1
        self.parity = int(quote.sum()) % 2
        self.step = ((data == 123) | (data == 91)).astype(np.int64) - ((data == 125) | (data == 93))

    def depths(self, inside: bool) -> np.ndarray:
        """The change of depth at each place if the piece begins inside a string or not."""
        return np.where(self.odd == inside, self.step, 0)


def _pieces_task(most: int):
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("no", pa.int32()), ("text", pa.binary()), ("parity", pa.int32()), ("outside", pa.int64()), ("inside", pa.int64())])

    def piece(file: str, start: int, no: int, held: list[bytes]) -> pa.RecordBatch:
        text = b"}".join(held) + b"}"
        p = Piece(text)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((file, start, no, text, p.parity, int(p.depths(False).sum()), int(p.depths(True).sum())), schema.types, strict=True)], schema=schema)

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at, no = [], 0, None, 0
        for b in it:
            for value, file, start in zip(b.column(0), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if at != (file, start) or size >= most:
                    if held:
                        yield piece(*at, no, held)
                    no = no + 1 if at == (file, start) else 0
                    held, size, at = [], 0, (file, start)
                held.append(value.as_buffer().to_pybytes())
                size += len(held[-1]) + 1
        if held:
            yield piece(*at, no, held)

    return task


def _features_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole features of each piece, and what belongs to one that began before it or ends behind it."""
    for b in it:
        for file, start, no, text, inside, depth in zip(*[b.column(k).to_pylist() for k in range(6)], strict=True):
            p = Piece(text)
            step = p.depths(bool(inside))
            after = depth + np.cumsum(step)
            first = np.flatnonzero((step > 0) & (after == DEPTH))
            end = np.flatnonzero((step < 0) & (after == DEPTH - 1)) + 1
            kind, part = [], []
            if depth >= DEPTH:
                stop = int(end[0]) if len(end) else len(text)
                kind.append("rest")
                part.append(text[:stop])
                end = end[1:]
            for a, z in zip(first.tolist(), [*end.tolist(), None]):
                kind.append("open" if z is None else "whole")
                part.append(text[a:z])
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(kind), pa.string()), pa.array([start] * len(kind), pa.int64()), pa.array([no] * len(kind), pa.int32()), pa.array(range(len(kind)), pa.int32()), pa.array(kind, pa.string()), pa.array(part, pa.binary())], ["file", "start", "no", "k", "kind", "part"])


def features(spark: SparkSession, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(file, feature): the JSON text of every feature of the collections below `path`."""
    parts = spark.read.option("lineSep", "}").text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pieces = written(parts.mapInArrow(_pieces_task(piece_bytes), "file string, start long, no int, text binary, parity int, outside long, inside long"), "pieces")
    # a few numbers per piece; a window holds those of one file
    before = Window.partitionBy("file").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, -1)
    told = pieces.select("file", "start", "no", "parity", "outside", "inside").withColumn("odd", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    told = told.withColumn("depth", F.coalesce(F.sum(F.when(F.col("odd") == 1, F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))
    begun = pieces.select("file", "start", "no", "text").join(told.select("file", "start", "no", "odd", "depth"), ["file", "start", "no"])
    found = written(begun.select("file", "start", "no", "text", F.col("odd").cast("int"), "depth").mapInArrow(_features_task, "file string, start long, no int, k int, kind string, part binary"), "features")
    order = Window.partitionBy("file").orderBy("start", "no", "k").rowsBetween(Window.unboundedPreceding, 0)
    cut = found.where("kind <> 'whole'").withColumn("n", F.sum((F.col("kind") == "open").cast("int")).over(order))
    joined = cut.groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("start", "no", "k", F.hex("part").alias("part")))).alias("v"))
    whole = found.where("kind = 'whole'").select("file", "part").unionByName(joined.select("file", F.unhex(F.array_join(F.transform("v", lambda x: x["part"]), "")).alias("part")))
    return whole.select("file", F.decode("part", "UTF-8").alias("feature"))


def read_geojson(spark: SparkSession, path: str, properties: dict[str, str], piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """S-06: point features of GeoJSON collections with the named properties (name -> type)."""
    props = ", ".join(f"`{k}`: {v}" for k, v in properties.items())
    schema = f"type string, geometry struct<type: string, coordinates: array<double>>, properties struct<{props}>"
    # other objects may stand as deep as features, but are none
    f = features(spark, path, piece_bytes).select(F.from_json("feature", schema).alias("f")).where("f.type = 'Feature'")
    return f.select(*[F.col(f"f.properties.`{k}`").alias(k) for k in properties], F.col("f.geometry.coordinates")[0].alias("x"), F.col("f.geometry.coordinates")[1].alias("y"))
