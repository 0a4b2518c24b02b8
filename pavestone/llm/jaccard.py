"""Operator 3, n-gram Jaccard join with set-relation skipping.

Documents become sets of word shingles.  Two sets with a Jaccard similarity of
at least t are linked, and the links' connected components are returned.

1. Shingles that no other document has can't be shared, so a set with fewer
   than t of its shingles shared links with nothing (counts by chunked slots).
2. Equal sets are one set from here on.
3. Shingles are ordered rarest first.  Only a prefix of each set is indexed, with
   positions.  If x and y (at positions p and q of their first common shingle)
   link, then p + q <= (|x| + |y|) (1 - t) / (1 + t).  An index list is kept in order of that
   slack, in blocks; a block whose first entry can't meet it with the least slack of the whole list is
   skipped, and so are all behind it.  What is left joins the sets of a list into families.
   Each chunk sends one entry per list, so a list of very many sets is never in one task.
4. Families are joined exactly: the overlaps of a set with
   all others are derived from those of a highly similar set by the index
   lists of the shingles in which the two differ, or else counted in full.
   A family larger than a block is joined block by block first; a central set of each component
   found in a block goes on to the next round, in which there are far fewer.  Sets of a
   family's largest component are connected by then, so only the sets outside it are
   joined once more with the others.  A set is sent a number of times that does not grow with its family.
   Tasks hand on a spanning forest of the links.
5. The number of links of each document (`links=True`) needs every pair of different sets of a family:
   pairs of blocks are joined, and each set's links are weighted by the rows of its partners,
   so pairs of copies are never rows.

Hashes of shingles have 64 bits.  Defined results: no words, or a null text: an
empty set, linked with nothing; fewer words than a shingle: the whole sequence is
the one shingle; rows are the nodes, so rows that share a doc_id are linked by
their texts like any others; a null doc_id is passed over for the smallest of a
component; a text of any length is one set (a chunk holds one row at least, and a block of a family so many
bytes of shingles); an empty table gives an empty result; other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.components import connected_components
from .chunks import Answers, Ranges, answered, block_rows, chunk_table, document_chunks, emit_from_chunks, emit_with_answers, in_several, join_parts, pack_ints, pack_sorted, ranges_of, split_parts, unpack_ints, unpack_sorted, with_answers
from .common import by_place, drop_written, places_of, width, written
from .textkit import Words, mix, window_hashes, window_starts

SHINGLE, PERCENT = 5, 80
#: Sets, and bytes of shingles, per block of a family; a task joins two blocks at most.
BLOCK_SETS, BLOCK_BYTES = 128, 16 << 20
#: Entries per block of an index list.
LIST_BLOCK = 32
#: Sets whose full overlaps a task keeps to derive others from.
PIVOTS = 24


def shingles(w: Words, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, sorted by both; texts with fewer words have one shingle."""
    h = w.hashes()
    start, doc = window_starts(w.doc_start, length)
    keys = window_hashes(h, length)[start] if len(start) else np.zeros(0, np.uint64)
    short = np.flatnonzero((w.n_words > 0) & (w.n_words < length))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for k in range(length - 1):
            has = w.n_words[short] > k
            own[has] = mix(own[has] * np.uint64(0x9E3779B97F4A7C15) + h[w.doc_start[short[has]] + k] + np.uint64(k))
        doc, keys = np.concatenate([doc, short]), np.concatenate([keys, mix(own ^ np.uint64(0x5851F42D4C957F2D))])
    order = np.lexsort((keys, doc))
    doc, keys = doc[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], keys[new]


def _sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of the values of each text; `doc` is sorted."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.searchsorted(doc, np.arange(n + 1))
    return total[ends[1:]] - total[ends[:-1]]


SETS = "doc_id long, n_shingles long, sid long, tokens binary, linkable boolean"


def _set_rows(table: pa.Table, own: Answers, ranges: Ranges, length: int, percent: int) -> pa.RecordBatch:
    w = Words(table["text"], lower=True)
    n = len(w.n_words)
    doc, keys = shingles(w, length)
    slots = ranges.slots(keys)
    distinct, inverse, counts = np.unique(slots, return_inverse=True, return_counts=True)
    flags = np.frombuffer(own.take(0, ranges.cuts(distinct, ranges.slot_bits)), np.uint8) > 0
    shared = (flags | (counts > 1))[inverse]
    size = np.bincount(doc, minlength=n)
    n_shared = np.bincount(doc, shared, minlength=n).astype(np.int64)
    linkable = (size > 0) & (100 * n_shared >= percent * size)
    sid = mix(_sums(mix(keys), doc, n) ^ mix(size.astype(np.uint64))).view(np.int64)
    ends = np.searchsorted(doc, np.arange(n + 1))
    seen: set = set()
    tokens = []
    for d in range(n):
        if linkable[d] and sid[d] not in seen:  # one copy of equal sets is enough
            seen.add(sid[d])
            tokens.append(keys[ends[d] : ends[d + 1]].tobytes())
        else:
            tokens.append(None)
    return pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(size, pa.int64()), pa.array(sid), pa.array(tokens, pa.binary()), pa.array(linkable)], ["doc_id", "n_shingles", "sid", "tokens", "linkable"])


def document_sets(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: its set's size and id; the shingles of the sets that can link at all."""
    chunks = document_chunks(docs)
    ranges = ranges_of(chunks)

    def emit(table: pa.Table) -> dict[int, bytes]:
        _, keys = shingles(Words(table["text"], lower=True), length)
        slots = np.unique(ranges.slots(keys))
        return block_rows(ranges.cuts(slots, ranges.slot_bits), lambda a, b: pack_sorted(slots[a:b]))

    answers = written(answered(emit_from_chunks(chunks, emit), 0, in_several), "shared")
    sets = written(with_answers(chunks, answers, lambda table, own: _set_rows(table, own, ranges, length, percent), SETS), "sets")
    drop_written(chunks, answers)
    return sets


class SetChunk:
    """The sets of one chunk as flat arrays: set of each token, token hashes."""

    def __init__(self, table: pa.Table) -> None:
        self.sid = table["sid"].combine_chunks().to_numpy(zero_copy_only=False)
        flat = table["tokens"].combine_chunks().cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1, flat.offset * 8)) // 8 if len(flat) else np.zeros(0, np.int64)
        self.keys = np.concatenate([np.frombuffer(t.as_buffer(), np.uint64) for t in flat]) if len(flat) else np.zeros(0, np.uint64)
        self.size = sizes
        self.of = np.repeat(np.arange(len(sizes)), sizes)


def _frequencies(chunks: list[int], blocks: list[bytes]) -> list[bytes]:
    """A class for each slot: 0 if one set has it, else a rank that grows with the number of sets."""
    parts = [split_parts(b) for b in blocks]
    keys = [unpack_sorted(p[0]) for p in parts]
    counts = np.concatenate([unpack_ints(p[1]) for p in parts])
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, counts)[inverse]
    rank = np.minimum(255, np.rint(6 * np.log2(np.maximum(total, 1)))).astype(np.uint8)
    ends = np.cumsum([len(k) for k in keys])
    return [rank[e - len(k) : e].tobytes() for e, k in zip(ends, keys, strict=True)]


def _postings(table: pa.Table, own: Answers, ranges: Ranges, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The indexed prefix of each set, as lists: shingle, set and slack (100 + t) p - (100 - t) |x|, by shingle, slack and set."""
    s = SetChunk(table)
    distinct, inverse = np.unique(ranges.slots(s.keys), return_inverse=True)
    rank = np.frombuffer(own.take(0, ranges.cuts(distinct, ranges.slot_bits)), np.uint8)[inverse]
    order = np.lexsort((s.keys, rank, s.of))
    of, keys, rank = s.of[order], s.keys[order], rank[order]
    first = np.cumsum(s.size) - s.size
    position = np.arange(len(keys)) - first[of]
    size = s.size[of]
    need = -(-percent * size // 100)
    use = (rank > 0) & (position <= size - need)
    of, keys, position, size = of[use], keys[use], position[use], size[use]
    slack = (100 + percent) * position - (100 - percent) * size
    sid = s.sid[of]
    order = np.lexsort((sid, slack, keys))
    return keys[order], sid[order], slack[order]


def _heads(keys: np.ndarray) -> np.ndarray:
    """Where each list begins."""
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(head)


def _least_entries(chunks: list[int], blocks: list[bytes]) -> list[bytes]:
    """For each list of each chunk: the entry of least slack of all chunks, as 16 bytes (set, slack)."""
    parts = [split_parts(b) for b in blocks]
    keys = [unpack_sorted(p[0]) for p in parts]
    flat = np.concatenate(keys)
    sid = np.concatenate([np.frombuffer(p[1], np.int64) for p in parts])
    slack = np.concatenate([unpack_ints(p[2]) for p in parts])
    order = np.lexsort((sid, slack, flat))
    at = _heads(flat[order])
    first = np.empty(len(flat), np.int64)
    first[order] = np.repeat(order[at], np.diff(np.append(at, len(flat))))
    told = np.stack([sid[first], slack[first]], 1)
    ends = np.cumsum([len(k) for k in keys])
    return [told[e - len(k) : e].tobytes() for e, k in zip(ends, keys, strict=True)]


def open_entries(at: np.ndarray, slack: np.ndarray, least: np.ndarray, block: int = LIST_BLOCK) -> np.ndarray:
    """Entries that can meet the least slack of their list; `at`: where lists begin, entries in order of slack.

    Only the first entry of a block is looked at where that can't meet it: the block is skipped.
    """
    n = np.diff(np.append(at, len(slack)))
    many = -(-n // block)
    of = np.repeat(np.arange(len(at)), many)
    head = at[of] + block * (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many))
    kept = slack[head] + least[of] <= 0
    head, of = head[kept], of[kept]
    size = np.minimum(block, at[of] + n[of] - head)
    entry = np.repeat(head - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return entry[slack[entry] + np.repeat(least[of], size) <= 0]


def _chunk_edges(table: pa.Table, own: Answers, ranges: Ranges, percent: int) -> pa.RecordBatch:
    """Edges from the entry of least slack of each index list to this chunk's entries that it can meet."""
    keys, sid, slack = _postings(table, own, ranges, percent)
    at = _heads(keys)
    told = np.frombuffer(own.take(1, ranges.cuts(keys[at]), 16), np.int64).reshape(-1, 2)
    entry = open_entries(at, slack, told[:, 1])
    least = told[np.searchsorted(at, entry, "right") - 1, 0]
    pairs = np.stack([np.minimum(least, sid[entry]), np.maximum(least, sid[entry])], 1)
    pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def families(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(sid, family): sets that may link are in one family."""
    chunks = chunk_table(sets.select("sid", "tokens"), "setchunks")
    total = sets.agg(F.sum("size")).first()[0] or 0
    ranges = Ranges(total, 2 * width(sets.sparkSession))

    def emit(table: pa.Table) -> dict[int, bytes]:
        slots, counts = np.unique(ranges.slots(SetChunk(table).keys), return_counts=True)
        return block_rows(ranges.cuts(slots, ranges.slot_bits), lambda a, b: join_parts(pack_sorted(slots[a:b]), pack_ints(counts[a:b])))

    def emit_least(table: pa.Table, own: Answers) -> dict[int, bytes]:
        keys, sid, slack = _postings(table, own, ranges, percent)
        at = _heads(keys)
        keys, sid, slack = keys[at], sid[at], slack[at]
        return block_rows(ranges.cuts(keys), lambda a, b: join_parts(pack_sorted(keys[a:b]), sid[a:b].tobytes(), pack_ints(slack[a:b])))

    classes = written(answered(emit_from_chunks(chunks, emit), 0, _frequencies), "classes")
    least = written(answered(emit_with_answers(chunks, classes, emit_least), 1, _least_entries), "least")
    edges = with_answers(chunks, classes.unionByName(least), lambda table, own: _chunk_edges(table, own, ranges, percent), "a long, b long")
    found = connected_components(edges).select(F.col("node").alias("sid"), F.col("component").alias("family"))
    drop_written(chunks, classes, least)
    return found


class Lists:
    """The inverted index of a block of sets: for each shingle that several of them have, those sets."""

    def __init__(self, tokens: list[np.ndarray]) -> None:
        self.m = len(tokens)
        self.size = np.array([len(t) for t in tokens], np.int64)
        of = np.repeat(np.arange(self.m), self.size)
        _, inverse, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        use = counts[inverse] > 1
        number = np.cumsum(counts > 1) - 1
        token, of = number[inverse[use]], of[use]
        order = np.argsort(token, kind="stable")
        self.sets = of[order]
        self.start = np.searchsorted(token[order], np.arange(int((counts > 1).sum()) + 1))
        ends = np.searchsorted(of, np.arange(self.m + 1))
        self.tokens = [np.sort(token[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def counted(self, tokens: np.ndarray) -> np.ndarray:
        """How many of the shingles each set has."""
        start, n = self.start[tokens], self.start[tokens + 1] - self.start[tokens]
        begin = np.cumsum(n) - n
        return np.bincount(self.sets[np.repeat(start - begin, n) + np.arange(n.sum())], minlength=self.m)


def links_within(tokens: list[np.ndarray], percent: int = PERCENT, asked: np.ndarray | None = None, forest: bool = False, label: np.ndarray | None = None, lists: Lists | None = None) -> list[tuple[int, int]]:
    """All linked pairs of sets, each once; with `asked` (flags), those of an asked set; with `forest`, a spanning forest of the links.

    `label`: sets of the same number are connected already, and stay so; a forest joins those of different ones.
    """
    lists = lists or Lists(tokens)
    size = lists.size
    label = np.arange(lists.m) if label is None else label
    done = np.zeros(lists.m, bool)
    pivots: list[tuple[int, np.ndarray]] = []
    out = []
    order = np.argsort(-size, kind="stable")
    for x in order:
        if asked is not None and not asked[x]:
            continue
        done[x] = True
        fits = (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x])) & (label != label[x] if forest else ~done)
        if not fits.any():
            continue
        own, overlap = lists.tokens[x], None
        if pivots:
            # the most similar set whose overlaps are known
            known = [(len(own) + len(lists.tokens[p]) - 2 * int(o[x]), k) for k, (p, o) in enumerate(pivots)]
            apart, k = min(known)
            if 2 * apart < len(own):
                p, base = pivots[k]
                overlap = base + lists.counted(np.setdiff1d(own, lists.tokens[p], True)) - lists.counted(np.setdiff1d(lists.tokens[p], own, True))
        if overlap is None:
            overlap = lists.counted(own)
            pivots.append((x, overlap))
            if len(pivots) > PIVOTS:
                pivots.pop(0)
        for y in np.flatnonzero(fits & ((100 + percent) * overlap >= percent * (size + size[x]))):
            if forest and label[y] == label[x]:
                continue
            if forest:
                label[label == label[y]] = label[x]
            out.append((int(x), int(y)))
    return out


def spanning(pairs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The pairs that join two components, in their order."""
    label, out = np.arange(n), []
    for x, y in pairs:
        if label[x] != label[y]:
            label[label == label[y]] = label[x]
            out.append((x, y))
    return out


def _columns(group: pa.Table, *names: str) -> list[np.ndarray]:
    return [group[c].combine_chunks().to_numpy(zero_copy_only=False) for c in names]


def _tokens(group: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(t.as_buffer(), np.uint64) for c in group["tokens"].chunks for t in c]


def _edge_table(sid: np.ndarray, pairs: list[tuple[int, int]]) -> pa.Table:
    at = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(sid[at[:, 0]], pa.int64()), "b": pa.array(sid[at[:, 1]], pa.int64())})


ROUND = "a long, b long, family long, size long, tokens binary"


def _round_block(percent: int):
    """Edges (a, b) of a spanning forest of a block; of a family of several blocks also the central set of each of its components (a, family, size, tokens)."""

    def task(group: pa.Table) -> pa.Table:
        sid, size, blocks = _columns(group, "sid", "size", "blocks")
        tokens, label = _tokens(group), np.arange(len(sid))
        lists = Lists(tokens)
        edges = _edge_table(sid, links_within(tokens, percent, forest=True, label=label, lists=lists))
        lead = np.zeros(0, np.int64)
        if blocks[0] > 1:
            # central: whose shingles most sets of the block have
            common = np.array([np.diff(lists.start)[t].sum() for t in lists.tokens]) / size
            order = np.lexsort((sid, -common, label))
            lead = order[np.append(True, label[order][1:] != label[order][:-1])]
        none = pa.nulls(edges.num_rows)
        n = len(lead)
        a, b = pa.concat_arrays([edges["a"].combine_chunks(), pa.array(sid[lead], pa.int64())]), pa.concat_arrays([edges["b"].combine_chunks(), pa.nulls(n, pa.int64())])
        family = pa.concat_arrays([none.cast(pa.int64()), pa.array(group["family"][0].as_py() for _ in range(n)).cast(pa.int64())])
        sizes = pa.concat_arrays([none.cast(pa.int64()), pa.array(size[lead], pa.int64())])
        kept = pa.concat_arrays([none.cast(pa.binary()), pa.array([tokens[k].tobytes() for k in lead], pa.binary())])
        return pa.table({"a": a, "b": b, "family": family, "size": sizes, "tokens": kept})

    return task


def _blocks_of(nodes: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per key: n and, as column `name`, the number of blocks for its sets (sid, size)."""
    n = F.count(F.lit(1))
    return nodes.groupBy(*keys).agg(n.alias("n"), F.greatest(F.ceil(n / BLOCK_SETS), F.ceil(8 * F.sum("size") / BLOCK_BYTES)).cast("int").alias(name))


def _part(blocks: str, salt: int):
    return F.pmod(F.xxhash64("sid", F.lit(salt)), F.col(blocks)).cast("int")


def joined_in_rounds(sets: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) over the sids that connect what is linked inside the families (sid, family); sets: (sid, size, tokens)."""
    nodes = sets.join(family, "sid").select("sid", "family", "size", "tokens")
    counts = written(_blocks_of(sets.select("sid", "size").join(family, "sid"), ["family"], "blocks"), "counts")
    many = written(counts.where("blocks > 1").select("family"), "many")
    edges, step = None, 0
    now, made = counts, [counts]
    while True:
        rows = nodes.join(now.select("family", "n", "blocks"), "family").select("sid", "family", "size", "tokens", "blocks", _part("blocks", step).alias("part"))
        got = written(rows.groupBy("family", "part").applyInArrow(_round_block(percent), ROUND), "round")
        found = got.where("b is not null").select("a", "b")
        edges = found if edges is None else edges.unionByName(found)
        nodes = got.where("b is null").select(F.col("a").alias("sid"), "family", "size", "tokens")
        after = _blocks_of(nodes, ["family"], "blocks").select("family", F.col("n").alias("n2"), F.col("blocks").alias("blocks2"))
        # families whose sets hardly link among each other gain nothing by another round
        after = after.join(now.select("family", "n"), "family").where("2 * n2 <= n").select("family", F.col("n2").alias("n"), F.col("blocks2").alias("blocks"))
        now, step = written(after, "counts"), step + 1
        made += [got, now]
        if now.limit(1).count() == 0:
            break
    edges = written(edges, "forest")
    drop_written(*made)
    large = written(family.join(many, "family").select("sid", "family"), "large")
    if large.limit(1).count() == 0:
        return edges
    # what is not in the largest component of its family is joined with all sets of the family that it isn't connected with
    linked = connected_components(edges.join(large.select(F.col("sid").alias("a")), "a", "left_semi"))
    named = large.join(linked.withColumnRenamed("node", "sid"), "sid", "left").select("sid", "family", F.coalesce("component", "sid").alias("label"))
    named = written(named, "labels")
    most = named.groupBy("family", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("family").agg(F.max(F.struct("n", "label")).alias("m")).select("family", F.col("m.label").alias("most"))
    rest = written(named.join(most, "family").where("label <> most").select("sid", "family", "label"), "rest")
    if rest.limit(1).count() == 0:
        return edges
    # sets that link have sizes in the same or in neighbouring classes: the larger is at most 1 / t times the smaller
    sized = sets.withColumn("class", F.floor(F.log("size") / F.log(F.lit(100 / percent + 0.01))).cast("int")).select("sid", "size", "tokens", "class")
    own = sized.join(rest, "sid")
    own_blocks = written(_blocks_of(own, ["family", "class"], "own_blocks").select("family", "class", "own_blocks"), "counts")
    own = own.join(own_blocks, ["family", "class"]).withColumn("j", _part("own_blocks", 1))
    all_ = sized.join(named.join(rest.select("family").distinct(), "family", "left_semi"), "sid")
    all_blocks = written(_blocks_of(all_, ["family", "class"], "blocks").select("family", "class", "blocks"), "counts")
    all_ = all_.join(all_blocks, ["family", "class"]).withColumn("i", _part("blocks", 2))
    near = F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1))
    # each task: block i of a class, and block j of what is left of a neighbouring one
    to_own = own_blocks.select("family", F.col("class").alias("own_class"), near.alias("class"), "own_blocks")
    left = all_.join(to_own, ["family", "class"]).select("sid", "tokens", "label", F.lit(False).alias("asked"), "family", "class", "i", "own_class", F.explode(F.sequence(F.lit(0), F.col("own_blocks") - 1)).alias("j"))
    to_all = all_blocks.select("family", F.col("class").alias("all_class"), near.alias("class"), "blocks")
    right = own.join(to_all, ["family", "class"]).select("sid", "tokens", "label", F.lit(True).alias("asked"), "family", F.col("all_class").alias("class"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), F.col("class").alias("own_class"), "j")

    def task(group: pa.Table) -> pa.Table:
        sid, label, asked = _columns(group, "sid", "label", "asked")
        return _edge_table(sid, links_within(_tokens(group), percent, asked.astype(bool), True, np.unique(label, return_inverse=True)[1]))

    more = left.unionByName(right).groupBy("family", "class", "i", "own_class", "j").applyInArrow(task, "a long, b long")
    return edges.unionByName(written(more, "more"))


FOUND = "a long, b long, n long"


def _join_blocks(percent: int):
    """Edges (a, b) of a spanning forest, and (a, n): links of set a found here, in rows of its partners."""

    def task(group: pa.Table) -> pa.Table:
        sid, own, copies = _columns(group, "sid", "own", "copies")
        i, j, blocks = (group[c][0].as_py() for c in ("i", "j", "blocks"))
        # a block's own links are counted once: with the next block, or the last block with the one before
        once = {i} if j == i + 1 or blocks == 1 else set()
        if j == blocks - 1 and i == j - 1:
            once.add(j)
        asked = (own == i) | np.isin(own, list(once))
        pairs = [(x, y) for x, y in links_within(_tokens(group), percent, asked) if own[x] != own[y] or own[x] in once]
        degree = np.zeros(len(sid), np.int64)
        if pairs:
            x, y = np.array(pairs).T
            np.add.at(degree, x, copies[y])
            np.add.at(degree, y, copies[x])
        edges = _edge_table(sid, spanning(pairs, len(sid)))
        some = np.flatnonzero(degree)
        a = pa.concat_arrays([edges["a"].combine_chunks(), pa.array(sid[some], pa.int64())])
        b = pa.concat_arrays([edges["b"].combine_chunks(), pa.nulls(len(some), pa.int64())])
        return pa.table({"a": a, "b": b, "n": pa.concat_arrays([pa.nulls(edges.num_rows, pa.int64()), pa.array(degree[some], pa.int64())])})

    return task


def counted_links(sets: DataFrame, family: DataFrame, percent: int) -> DataFrame:
    """FOUND rows over the sids of sets (sid, size, tokens, copies): forest edges, and each set's links by task."""
    blocks = written(_blocks_of(sets.select("sid", "size").join(family, "sid"), ["family"], "blocks").select("family", "blocks"), "blocks")
    own = family.join(blocks, "family").select("sid", "family", "blocks", _part("blocks", 0).alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = sets.join(own, "sid").select("sid", "tokens", "copies", "family", "blocks", "own", other.alias("other"))
    # a family of one block is one task; else each pair of different blocks is one, which also joins either block with itself
    rows = rows.where("blocks = 1 or own <> other").select("sid", "tokens", "copies", "family", "blocks", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return rows.groupBy("family", "i", "j").applyInArrow(_join_blocks(percent), FOUND)


def similar_documents(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT, links: bool = True) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and, with `links`, n_links (other rows linked with it)."""
    rows = document_sets(docs, length, percent)
    copies = rows.where("linkable").groupBy("sid").agg(F.count(F.lit(1)).alias("copies"))
    one = rows.where("tokens is not null").select("sid", F.col("n_shingles").alias("size"), "tokens").dropDuplicates(["sid"])
    sets = written(one.join(copies, "sid") if links else one, "distinct")
    family = written(families(sets, percent), "families")
    if links:
        found = written(counted_links(sets, family, percent), "found")
        edges = found.where("b is not null").select("a", "b")
    else:
        edges = joined_in_rounds(sets, family, percent)
    linked = written(connected_components(edges), "linked")
    if not links:
        drop_written(sets, family)
    able = rows.where("linkable").select("doc_id", "sid")
    classed = able.join(linked, able["sid"] == linked["node"], "left").select("doc_id", "sid", F.coalesce("component", "sid").alias("class"))
    smallest = written(classed.groupBy("class").agg(F.min("doc_id").alias("component_id")), "smallest")
    named = classed.select("sid", "class").distinct().join(smallest, "class").select("sid", "component_id")
    count: list[str] = []
    if links:
        count = ["n_links"]
        to_others = found.where("b is null").groupBy(F.col("a").alias("sid")).agg(F.sum("n").alias("n"))
        # a set's copies are linked with each other
        named = named.join(sets.select("sid", "copies"), "sid", "left").join(to_others, "sid", "left")
        named = named.select("sid", "component_id", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    named = written(named, "named")
    size = F.col("n_shingles")
    alone = rows.where("not linkable").select("doc_id", size, F.col("doc_id").alias("component_id"), *[F.lit(0).cast("long").alias(c) for c in count])
    grouped = rows.where("linkable").join(named, "sid").select("doc_id", size, "component_id", *count)
    return alone.unionByName(grouped)


def first_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` (all columns) with one document of each component: the one of the smallest doc_id.

    Rows equal in doc_id and text are one document; without a doc_id, different texts all stay.
    """
    found = similar_documents(docs, SHINGLE, percent, links=False).where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    found = written(found, "kept")
    plain = by_place(docs)
    own_id, text = (F.col(f"_c{i}") for i in places_of(docs.columns, "doc_id", "text"))
    # the join deals the texts by doc_id, and the numbering below needs no other place for them
    stay = plain.where(own_id.isNotNull()).join(found, own_id == F.col("kept_id"), "left_semi")
    first = lambda df, *key: df.withColumn("again", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))).where("again = 1").drop("again")
    nameless = first(plain.where(own_id.isNull()), F.xxhash64(text))
    return first(stay, own_id, F.xxhash64(text)).unionByName(nameless).toDF(*docs.columns)


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), links=False)


def op3_ngram_jaccard_links(spark, sf_dir: str) -> DataFrame:
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
