"""What the operators of this subpackage share: tables cut from their lineage, ranks, small tables."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import drop_written, new_path, shared_dir, width, written, written_by_key  # noqa: F401


def values_table(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A small driver-made table as a JSON literal (no Python data source in the plan)."""
    import json

    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    one = spark.range(1).select(F.explode(F.from_json(F.lit(text), f"array<struct<{schema_to_struct(schema)}>>")).alias("r"))
    return one.select("r.*")


def schema_to_struct(schema: str) -> str:
    return ",".join(":".join(x.strip().split(" ", 1)) for x in schema.split(","))


def ranked(df: DataFrame, keys: Sequence[str], order: Column, ties: Sequence[Column], name: str = "rank", cell_bits: int = 12) -> DataFrame:
    """Gapless ranks from 0 within `keys`, by the unsigned 64-bit `order` (a uniform hash) and then `ties`.

    A key may hold any share of the rows: its rows are dealt into 2**cell_bits
    cells by the leading bits of `order`, counted (with partial sums before the
    shuffle), and numbered within a cell, so that no task sees a whole key.  Rows equal in all columns are
    one row with a count until they have their ranks, so no number of copies makes a cell large.
    """
    once = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    cell = F.shiftrightunsigned("_order", 64 - cell_bits) if cell_bits else F.lit(0).cast("long")  # a shift by 64 would do nothing
    cells = once.withColumn("_order", order).withColumn("_cell", cell)
    counts = cells.groupBy(*keys, "_cell").agg(F.sum("_copies").alias("_n"))
    before = counts.select(*keys, "_cell", (F.sum("_n").over(Window.partitionBy(*keys).orderBy("_cell")) - F.col("_n")).alias("_before"))
    # signed order of a cell's rows is their unsigned order: the leading bits are equal
    upto = F.sum("_copies").over(Window.partitionBy(*keys, "_cell").orderBy("_order", *ties).rowsBetween(Window.unboundedPreceding, 0))
    same = F.lit(True)
    left, right = cells.withColumn("_first", upto - F.col("_copies")).alias("l"), before.alias("r")
    for k in [*keys, "_cell"]:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    placed = left.join(right, same).select("l.*", (F.col("r._before") + F.col("l._first")).cast("long").alias("_rank"))
    each = placed.select(*df.columns, "_rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_k"))
    return each.select(*df.columns, (F.col("_rank") + F.col("_k")).alias(name))


def parts_before(totals: DataFrame, name: str = "before", per_block: int = 1024) -> DataFrame:
    """(part, total) -> (part, `name`): the sum over smaller parts, by blocks of parts, so that no window holds a long list."""
    block = F.expr(f"part div {per_block}").alias("_block")
    rows = totals.select("part", "total", block)
    inside = rows.select("part", "_block", (F.sum("total").over(Window.partitionBy("_block").orderBy("part")) - F.col("total")).alias("_inside"))
    blocks = rows.groupBy("_block").agg(F.sum("total").alias("_sum"))
    outer = blocks.select("_block", (F.sum("_sum").over(Window.orderBy("_block")) - F.col("_sum")).alias("_outer"))
    return inside.join(outer, "_block").select("part", (F.col("_inside") + F.col("_outer")).cast("long").alias(name))


def in_order(rows: DataFrame, order: Sequence[Column], name: str, parts: int | None = None) -> DataFrame:
    """`rows`, a written table, by `order` over all partitions, with `part` and the place `at` inside it; not written yet.

    Rows equal in `order` follow their place in the input, so no number of them ends in one partition.
    """
    n = parts or width(rows.sparkSession)
    order = [*order, F.col("_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_tie")
    # the number of a row is 2**33 times its partition plus its place there
    return dealt.withColumn("_m", F.monotonically_increasing_id()).select(*rows.columns, F.shiftright("_m", 33).alias("part"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))


def batches(it: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose buffers hold about `most_bytes` at most, or one row."""
    for b in it:
        n = max(1, -(-b.nbytes // most_bytes))
        step = max(1, -(-b.num_rows // n))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def places_of(columns: Sequence[str], *names: str) -> list[int]:
    """Where the named columns stand: by their exact name, else by the first that differs in case only."""
    exact, loose = {}, {}
    for i, c in enumerate(columns):
        exact.setdefault(c, i)
        loose.setdefault(c.lower(), i)
    return [exact[n] if n in exact else loose[n.lower()] for n in names]


def by_place(df: DataFrame) -> DataFrame:
    """`df` with its columns named _c0, _c1, ...: names that clash, with each other or with an operator's own, don't matter."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))])


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of an input; others, even with clashing names, don't matter."""
    plain = by_place(df)
    return plain.select(*[F.col(f"_c{i}").alias(n) for i, n in zip(places_of(df.columns, *names), names, strict=True)])


def environment() -> None:
    """In a Python worker: numeric libraries use one thread, as Spark places one task per core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
