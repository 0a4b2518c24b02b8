"""Operator 4, sharding: a consistent-hash ring with virtual nodes and bounded loads.

A key starts at the first virtual node clockwise of its place on the ring.  In
each round all keys that wait at a node ask its shard for room; a shard that
fills up accepts a prefix of them (nodes in ring order, rows in hash order) and
the others move on to the next node clockwise.  The loads of the shards are bounded by
quotas that add up to the number of rows, so counts differ by at most one (law
`rows`).  Keys at one node ask the same shards in the same order, so only the
number of keys per node decides which ranks go where: the rounds run over
`shards * nodes` counts, however large the table is, and the rows look their
shard up by (node, rank).

Defined results: a null text has size 1 and CRC 0 like an empty one; a null
doc_id is a key like any other; repeated rows are placed one by one (equal rows are
interchangeable), however many share a doc_id; a long text counts by its bytes alone; an empty table gives an empty
result; other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only, ranked, values_table

SHARDS, NODES = 16, 64
_CELL_BITS = 12
#: Places on the ring are 63-bit numbers.
_RING_BITS = 63


def ring_points(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(place, shard) of the virtual nodes, in ring order."""
    place = lambda s, v: int.from_bytes(hashlib.md5(f"shard {s} node {v}".encode()).digest()[:8]) >> 1
    return sorted((place(s, v), s) for s in range(shards) for v in range(nodes))


def place_of_key() -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id"), 1)


def rank_of_row() -> Column:
    """The order of rows at a node: by all that tells them apart, as a doc_id (null, say) may stand on very many."""
    return F.xxhash64("doc_id", "size", "text_crc32", F.lit("rank"))


def with_node(df: DataFrame, points: Sequence[tuple[int, int]]) -> DataFrame:
    """Adds `node`, the index of the first ring point at or after the row's `place`."""
    spark = df.sparkSession
    shift = _RING_BITS - _CELL_BITS
    cells: list[tuple[int, int, list[int]]] = []
    at = 0
    for c in range(1 << _CELL_BITS):
        inside = []
        base = at
        while at < len(points) and points[at][0] >> shift == c:
            inside.append(points[at][0])
            at += 1
        cells.append((c, base, inside))
    table = spark.range(1).select(
        F.explode(F.from_json(F.lit(str([list((c, b, p)) for c, b, p in cells])), "array<array<string>>")).alias("r")
    ).select(F.col("r")[0].cast("long").alias("ring_cell"), F.col("r")[1].cast("int").alias("base"), F.from_json(F.col("r")[2], "array<long>").alias("inside"))
    near = df.withColumn("ring_cell", F.shiftrightunsigned("place", shift)).join(F.broadcast(table), "ring_cell")
    node = F.col("base") + F.size(F.filter("inside", lambda p: p < F.col("place")))
    return near.withColumn("node", F.pmod(node, F.lit(len(points)))).drop("ring_cell", "base", "inside")


def allot(counts: Sequence[int], owner: Sequence[int], quotas: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """The rounds of the ring: rows (node, first rank, end rank, shard, first slot).

    `counts[i]` keys start at node i, whose shard is `owner[i]`.
    """
    waiting = list(counts)
    used = [0] * len(quotas)
    out = []
    for step in range(len(owner)):
        if not any(waiting):
            break
        for i, left in enumerate(waiting):
            if not left:
                continue
            shard = owner[(i + step) % len(owner)]
            taken = min(left, quotas[shard] - used[shard])
            if taken:
                first = counts[i] - left
                out.append((i, first, first + taken, shard, used[shard]))
                used[shard] += taken
                waiting[i] -= taken
    return out


def bounded_ring(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: only the law `key` has it)."""
    spark = docs.sparkSession
    points = ring_points(shards, nodes)
    text = F.coalesce("text", F.lit(""))
    rows = only(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), place_of_key().alias("place")
    )
    at_node = with_node(rows, points)
    # at most shards * nodes counts: a bound that does not grow with the table
    found = {r["node"]: r["n"] for r in with_node(only(docs, "doc_id", "text").select(place_of_key().alias("place")), points).groupBy("node").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [found.get(i, 0) for i in range(len(points))]
    total = sum(counts)
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    spans = allot(counts, [s for _, s in points], quotas)
    bits = math.ceil(max(counts, default=0).bit_length() / 2)
    rank = ranked(at_node, ["node"], rank_of_row(), [F.col(c) for c in ("doc_id", "size", "text_crc32")], cell_bits=bits)
    table = values_table(spark, "node int, first long, end long, shard int, slot0 long", spans)
    at = rank.join(F.broadcast(table), "node").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    return at.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    return bounded_ring(spark.read.parquet(f"{sf_dir}/documents.parquet"))
