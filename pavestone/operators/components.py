"""Connected components of an edge table (R-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import drop_written, width, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")


def _toward_smallest(pairs: DataFrame) -> DataFrame:
    """For each a: the smallest of its b and itself, as (a, m)."""
    return pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


#: Links that one task works on, and up to which number nearest nodes are not written before they are joined.
ROWS_PER_TASK, FEW = 200_000, 1_000_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Large-star and small-star rounds (Kiveris et al.) until every node points at
    the smallest of its component: rounds grow with the logarithm of the
    longest path.  Rounds are written, so plans stay small, by as many tasks as their counted links need.  Self loops give a
    component of one node; null ends are dropped; repeated edges do no harm.
    """
    rows = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    rows = written(rows.distinct(), "edges")
    nodes = _both_ways(rows).select(F.col("a").alias("node")).distinct()
    n = rows.count()
    most = width(edges.sparkSession)
    write = lambda df, name: written(df.coalesce(min(most, -(-n // ROWS_PER_TASK) or 1)), name)
    links = write(rows.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(most_rounds):
        # of many links, the smallest are written first: both sides of the join are then plain exchanges, and a node of very many edges can be split
        held = (lambda df, name: df) if n <= FEW else write
        pairs = _both_ways(links)
        # large star: neighbours above a node move to the smallest around it
        near = held(_toward_smallest(pairs), "nearest")
        large = pairs.join(near.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = write(large.where("a <> b").distinct(), "links")
        # small star: a node and its smaller neighbours move to the smallest of them
        least = held(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least.hint("merge"), "a")
        small = joined.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        small = write(small.where("a <> b").distinct(), "links")
        drop_written(links, large, *[x for x in (near, least) if n > FEW])
        links = small
        # done when no node is both above and below another, and each has one parent
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        state = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not state.where("up > 1 or (up = 1 and down = 1)").limit(1).count():
            break
        n = links.count()
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return nodes.join(links.withColumnRenamed("a", "node").hint("merge"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))
