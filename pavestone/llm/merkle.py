"""Operator 12, a Merkle manifest of a table as a content-addressed DAG.

Every row is a leaf: the SHA-256 of its fields, each with its length.  The leaves of one tree (a
language) in order of doc_id are joined in runs of FAN, level by level, and the roots of the trees in turn
form the tree above them.  Each node is stored as a record from its digest to its
children's digests, by height; equal nodes are one record.

Proofs come by descent: requests start at the root, and at each height the records
of that height give the children; the digit of a leaf's rank (base FAN) picks the next node, and the
children that are not picked are one segment of the path.  Leaves that share a prefix of
digits descend together, so a height moves one row per node and not one per
leaf.  At the leaf the path's segments are reversed.

Ranks within a tree come from one order over ranges, so a tree may hold any share of the rows.
Digests are 32 bytes in all tables; a hash takes them as hex text.

Defined results: a null field is `-` (an empty one `0:`); a null lang is a tree of its own, the first; a null
doc_id comes first in its tree and counts as untampered; rows of one doc_id follow by their digest, equal rows have equal
leaves at places of their own, and each has its proof; a text of any length is one leaf; an empty table gives
no rows; other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_order, only, parts_before, written

FAN, BITS = 8, 3
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(digests: Column) -> Column:
    """The digest of digests laid end to end, as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields: `-` for a null, else its bytes' number, a colon, and its text."""
    part = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.unhex(F.sha2(F.concat(*[part(c.cast("string")) for c in fields]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, leaf, and `altered`: the digest with the text's A-Z in lower case where 3 divides the CRC-32 of the doc_id."""
    rows = only(docs, *FIELDS)
    rows = rows.select(F.col("doc_id").cast("long"), "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in FIELDS]
    tampered = [*fields[:-1], F.translate("text", UPPER, LOWER)]
    changes = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return rows.select("doc_id", "lang", leaf_digest(fields).alias("leaf"), F.when(changes, leaf_digest(tampered)).alias("altered"))


def in_trees(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (doc_id, lang, leaf, altered) with their `tree`, its size `n` and their `rank` in it, and the trees: (tree, lang, n), numbered in order of lang."""
    lang, doc = F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first()
    ordered = written(in_order(written(rows, "leaves"), [lang, doc, F.col("leaf")], "leaves"), "ordered")
    # where each tree begins in each partition of the order; no group is larger than a partition
    runs = ordered.groupBy("part", "lang").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    runs = runs.withColumn("before", F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n"))
    runs = written(runs, "runs")
    trees = in_order(written(runs.groupBy("lang").agg(F.sum("n").alias("n")), "trees"), [lang], "trees")
    trees = written(trees, "trees")
    sizes = trees.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    trees = written(trees.join(F.broadcast(parts_before(sizes)), "part").select((F.col("before") + F.col("at")).alias("tree"), "lang", "n"), "trees")
    l, r = runs.alias("l"), trees.alias("r")
    known = l.join(r.hint("merge"), F.col("l.lang").eqNullSafe(F.col("r.lang"))).select("l.part", "l.lang", "l.first", "l.before", "r.tree", "r.n")
    l, r = ordered.alias("l"), known.alias("r")
    same = (F.col("l.part") == F.col("r.part")) & F.col("l.lang").eqNullSafe(F.col("r.lang"))
    ranked = l.join(r.hint("merge"), same).select("l.doc_id", "l.leaf", "l.altered", "r.tree", "r.n", (F.col("r.before") + F.col("l.at") - F.col("r.first")).alias("rank"))
    return written(ranked, "ranked"), trees


def levels_of(n: int) -> int:
    """How many times `n` nodes are joined in runs until one remains."""
    out = 0
    while n > 1:
        n, out = -(-n // FAN), out + 1
    return out


class Dag:
    """Records of digest to children, one table per height, and the roots (tree, digest, height)."""

    def __init__(self, nodes: DataFrame) -> None:
        """`nodes`: (tree, idx, digest, n) with n leaves in the tree; a tree of one leaf has height 0."""
        self.height = levels_of(nodes.agg(F.max("n")).first()[0] or 0)
        self.records: list[DataFrame] = []
        roots = nodes.where("n = 1").select("tree", "digest", F.lit(0).alias("height"))
        for h in range(1, self.height + 1):
            run = F.sort_array(F.collect_list(F.struct("idx", F.hex("digest").alias("d"))))
            joined = nodes.where("n > 1").groupBy("tree", F.shiftright("idx", BITS).alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n")).agg(F.unhex(F.array_join(F.transform(run, lambda x: x["d"]), "")).alias("children"))
            # written: the next level and the descent read it
            level = written(joined.withColumn("digest", hashed(F.col("children"))), "level")
            self.records.append(level)
            nodes = level.select("tree", "idx", "digest", "n")
            roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest", F.lit(h).alias("height")))
        self.roots = written(roots, "roots")

    def children(self, h: int) -> DataFrame:
        """(digest, children): the records of a height, equal nodes once."""
        return written(self.records[h - 1].select("digest", "children").distinct(), "records")

    def descend(self, starts: DataFrame, requests: DataFrame | None = None) -> DataFrame:
        """From `starts` (tree, digest, height, path) to the parents of leaves: (tree, idx, digest, height, path, children), and trees of one leaf as they are.

        `requests` (tree, rank) are the leaves that ask for a proof; without them every leaf asks.  A
        path is an array of (l, r), the digests left and right of the node that was picked, root first.  Other columns of `starts` go down with it.
        """
        more = [c for c in starts.columns if c not in ("tree", "digest", "height", "path")]
        single = starts.where("height = 0").select("tree", F.lit(0).cast("long").alias("idx"), "path", F.col("digest").alias("children"), "height", *more)
        asked = None if requests is None else requests.select("tree", "rank")
        front = None
        for h in range(self.height, 0, -1):
            new = starts.where(F.col("height") == h).select("tree", F.lit(0).cast("long").alias("idx"), "digest", "path", "height", *more)
            front = new if front is None else front.unionByName(new)
            if asked is not None:
                digits = asked.select("tree", F.shiftright("rank", BITS * h).alias("idx")).distinct()
                front = front.join(digits.hint("merge"), ["tree", "idx"], "left_semi")
            met = front.join(self.children(h).hint("merge"), "digest")
            if h == 1:
                return met.select("tree", "idx", "path", "children", "height", *more).unionByName(single)
            met = met.withColumn("digit", F.explode(F.sequence(F.lit(0), (F.octet_length("children") / DIGEST).cast("int") - 1)))
            picked, segment = self.pick(F.col("children"), F.col("digit"))
            idx = F.shiftleft("idx", BITS) + F.col("digit")
            front = written(met.select("tree", idx.alias("idx"), picked.alias("digest"), F.concat("path", F.array(segment)).alias("path"), "height", *more), "front")
        return single

    @staticmethod
    def pick(children: Column, digit: Column) -> tuple[Column, Column]:
        """The child at a digit, and the children left and right of it."""
        at = digit * DIGEST
        l, r = F.substring(children, F.lit(1), at), F.substring(children, at + DIGEST + 1, F.octet_length(children))
        return F.substring(children, at + 1, F.lit(DIGEST)), F.struct(l.alias("l"), r.alias("r"))


def proofs(leaves: DataFrame, dag: Dag, starts: DataFrame, key: str = "rank", every: bool = True) -> DataFrame:
    """`leaves` (tree, `key`, ...) with `path`: segments (l, r) from the leaf to the root, and the other columns of `starts`."""
    more = [c for c in starts.columns if c not in ("tree", "digest", "height", "path")]
    parents = dag.descend(starts, None if every else leaves.select("tree", F.col(key).alias("rank")))
    parents = parents.select("tree", F.col("idx").alias("_up"), F.col("path").alias("_path"), "children", F.col("height").alias("_height"), *more)
    met = leaves.withColumn("_up", F.shiftright(key, BITS)).join(parents.hint("merge"), ["tree", "_up"])
    _, segment = Dag.pick(F.col("children"), F.col(key).bitwiseAND(F.lit(FAN - 1)).cast("int"))
    own = F.when(F.col("_height") > 0, F.concat("_path", F.array(segment))).otherwise(F.col("_path"))
    return met.select(*leaves.columns, *more, F.reverse(own).alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: hashed(F.concat(s["l"], acc, s["r"])))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings of a path, laid end to end."""
    return hashed(F.unhex(F.array_join(F.transform(path, lambda s: F.hex(F.concat(s["l"], s["r"]))), "")))


EMPTY_PATH = "cast(array() as array<struct<l: binary, r: binary>>)"


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    ranked, trees = in_trees(leaves(docs))
    count = trees.count()
    low = Dag(ranked.select("tree", F.col("rank").alias("idx"), F.col("leaf").alias("digest"), "n"))
    top = Dag(written(low.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(count).cast("long").alias("n")), "subroots"))
    root = top.roots.select("digest").first()
    # the segments from a tree's root up to the root of all, root first
    above = proofs(low.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "digest", "height"), top, top.roots.withColumn("path", F.expr(EMPTY_PATH)))
    # the root of its tree goes down with each path: leaves don't meet at the few trees again
    starts = written(above.select(F.col("rank").alias("tree"), "digest", "height", F.reverse("path").alias("path"), F.col("digest").alias("subroot")), "starts")
    rows = proofs(ranked, low, starts)
    top_root = F.lit(bytes(root[0]) if root else b"")
    out = rows.withColumn("_folded", folded(F.coalesce("altered", "leaf"), F.col("path")))
    return out.select("doc_id", text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"), text_of(top_root).alias("root"), text_of(proof_digest(F.col("path"))).alias("proof_sha256"), text_of(F.col("_folded")).alias("folded_root"), (F.col("_folded") == top_root).alias("verified"))


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
