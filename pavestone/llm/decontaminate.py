"""Operator 2, benchmark decontamination with one FM-index per training shard.

A shard is a batch of documents inside a task.  Its words become symbols: a
word of the benchmark keeps its number, and everything else is a separator
that no phrase can cross.  The shard's suffixes are sorted (prefix doubling),
the Burrows-Wheeler transform goes into a wavelet tree of bit vectors with rank
samples, and suffix positions are kept at every 16th place.  All phrases are
searched backwards at once, the places of their occurrences are found by walking
to sampled positions, and overlapping occurrences merge into removal spans.

The phrases are the stated query set.  Where the benchmark's text is measured to fit one block, it goes with the tasks, which read the
documents once and move none.  A larger one stays a table: documents are dealt in groups of chunks, each group
meets all blocks of items, and its task searches them one after the other, so the documents are read once in
either way and the driver never holds more than one block.  Both ways give the same rows.

Defined results: a null text or item has no words; an item shorter than a window is one window; a text of any length is
searched whole; an empty table (either) gives no hits; items of one id count once; repeated documents each get a row;
other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import document_chunks, pack_table, unpack_table
from .common import batches, only
from .substrings import _runs, cut_spans
from .textkit import ALNUM, Words, lanes_of, same_bytes

WINDOW = 10
SAMPLE = 16
#: Bytes of text in a shard, and of benchmark text in a block of phrases.
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 2 << 20


class Phrases:
    """The windows of a block of items: a row of word numbers each, shorter ones padded at the front with -1."""

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW) -> None:
        w = Words(pa.array(texts, pa.string()), ALNUM, lower=True)
        h = w.hashes()
        first, kind = w.distinct(h)
        # words in order of their hashes; those that share one follow each other
        order = np.argsort(h[first], kind="stable")
        self.vocabulary, self.words, self.start, self.size = h[first][order], w.data, w.start[first][order], (w.end - w.start)[first][order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        numbers = back[kind]
        rows, item = [], []
        for d in range(len(texts)):
            own = numbers[w.doc_start[d] : w.doc_start[d + 1]] + 1
            if 0 < len(own) < window:
                rows.append(np.concatenate([np.full(window - len(own), -1), own]))
                item.append(d)
            for k in range(len(own) - window + 1):
                rows.append(own[k : k + window])
                item.append(d)
        table = np.array(rows, np.int32).reshape(len(rows), window)
        # equal windows are searched once
        self.rows, inverse = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, np.zeros(0, np.int64))
        pairs = np.unique(np.stack([inverse.reshape(-1), np.array(item, np.int64)], 1), axis=0) if len(item) else np.zeros((0, 2), np.int64)
        self.item_start = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.item = pairs[:, 1]
        self.length = (self.rows >= 0).sum(1)
        self.ids = [None if i is None else str(i) for i in ids]

    def numbers(self, w: Words, hashes: np.ndarray) -> np.ndarray:
        """The number of each word in this vocabulary, -1 for others; bytes are compared, not hashes alone."""
        place = np.searchsorted(self.vocabulary, hashes)
        out = np.full(len(hashes), -1, np.int64)
        lanes, size = lanes_of(self.words), w.end - w.start
        left = np.flatnonzero(place < len(self.vocabulary))
        while len(left):
            k = place[left]
            left, k = left[self.vocabulary[k] == hashes[left]], k[self.vocabulary[k] == hashes[left]]
            equal = self.size[k] == size[left]
            equal[equal] = same_bytes(w.lanes, w.start[left[equal]], lanes, self.start[k[equal]], size[left[equal]])
            out[left[equal]] = k[equal]
            left = left[~equal]  # another word of this hash may follow
            place[left] += 1
            left = left[place[left] < len(self.vocabulary)]
        return out

    def items_of(self, row: int) -> list[str]:
        """The ids of the items that have a window; a null id is not listed."""
        return [self.ids[i] for i in self.item[self.item_start[row] : self.item_start[row + 1]] if self.ids[i] is not None]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffix array of symbols whose value 0 is a separator: separators differ from each other, by place.

    Prefix doubling over the suffixes that are not told apart yet.
    """
    n = len(symbols)
    zero = symbols == 0
    rank = symbols.astype(np.int64) + n
    rank[zero] = np.arange(int(zero.sum()))
    order = np.argsort(rank, kind="stable")
    s = rank[order]
    head = np.ones(n, bool)
    head[1:] = s[1:] != s[:-1]
    place = np.empty(n, np.int64)
    place[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    last = np.append(head[1:], True)
    open_at = np.flatnonzero(~(head & last))
    while len(open_at):
        own = order[open_at]
        after = own + step
        follow = np.where(after < n, place[np.minimum(after, n - 1)], -1)
        group = place[own]
        again = np.lexsort((follow, group))
        own, follow, group = own[again], follow[again], group[again]
        order[open_at] = own
        head = np.ones(len(own), bool)
        head[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        place[own] = np.maximum.accumulate(np.where(head, open_at, 0))
        last = np.append(head[1:], True)
        open_at = open_at[~(head & last)]
        step *= 2
    return order


class Bits:
    """A bit vector with counts of ones before every 64th place."""

    def __init__(self, bits: np.ndarray) -> None:
        self.n = len(bits)
        padded = np.zeros(-(-self.n // 64) * 64 + 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """A wavelet matrix: at each level, a bit of the symbols, zeros sorted before ones."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[Bits, int]] = []
        s = symbols
        for k in range(bits - 1, -1, -1):
            bit = (s >> k & 1).astype(np.uint8)
            zeros = int(len(s) - bit.sum())
            self.levels.append((Bits(bit), zeros))
            s = np.concatenate([s[bit == 0], s[bit == 1]])
        self.bits = bits

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often `symbol` stands before place i."""
        low, high = np.zeros_like(i), i
        for k, (b, zeros) in enumerate(self.levels):
            one = symbol >> (self.bits - 1 - k) & 1 == 1
            a, c = b.ones(low), b.ones(high)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + c, high - c)
        return high - low

    def symbol(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for b, zeros in self.levels:
            bit = b.at(i).astype(np.int64)
            ones = b.ones(i)
            out = out << 1 | bit
            i = np.where(bit == 1, zeros + ones, i - ones)
        return out


class Index:
    """The FM-index of one shard's symbols (0: separator)."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = self.n = len(symbols)
        order = suffix_order(symbols)
        top = int(symbols.max()) if n else 0
        self.bits = max(1, top.bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.tree = Wavelet(symbols[order - 1].astype(np.int64) if n else symbols.astype(np.int64), self.bits)
        kept = (order % SAMPLE == 0) | (symbols[order - 1] == 0) if n else np.zeros(0, bool)
        self.kept = Bits(kept.astype(np.uint8))
        self.sampled = order[kept]
        self.top = top

    def search(self, p: Phrases, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of each phrase; `number` maps the phrases' words to this shard's symbols (0: absent)."""
        many, width = p.rows.shape
        low, high = np.zeros(many, np.int64), np.full(many, self.n, np.int64)
        alive = np.arange(many)
        for k in range(width - 1, -1, -1):
            word = p.rows[alive, k]
            alive = alive[(word < 0) | (number[np.maximum(word, 0)] > 0)]
            # phrases with a word that the shard doesn't have are gone
            step = alive[p.rows[alive, k] >= 0]
            s = number[p.rows[step, k]]
            low[step] = self.first[s] + self.tree.rank(s, low[step])
            high[step] = self.first[s] + self.tree.rank(s, high[step])
            alive = alive[low[alive] < high[alive]]
        dead = np.ones(many, bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text places of suffix ranks, by walking back to sampled ones."""
        out = np.zeros(len(at), np.int64)
        here, walk, todo = at.copy(), 0, np.arange(len(at))
        while len(todo):
            done = self.kept.at(here).astype(bool)
            out[todo[done]] = self.sampled[self.kept.ones(here[done])] + walk
            todo, here = todo[~done], here[~done]
            s = self.tree.symbol(here)
            here = self.first[s] + self.tree.rank(s, here)
            walk += 1
        return out


def shard_hits(w: Words, hashes: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word) of every occurrence of the phrases in a shard's texts."""
    place = p.numbers(w, hashes)
    known = place >= 0
    # a run of known words inside one text that is shorter than the shortest phrase holds none
    doc = w.doc_of_word()
    edge = np.ones(len(hashes) + 1, bool)
    edge[1:-1] = (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])
    bounds = np.flatnonzero(edge)
    size = np.diff(bounds)
    use = known[bounds[:-1]] & (size >= p.length.min())
    first, size = bounds[:-1][use], size[use]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # the runs with a separator before each and after the last
    begin = np.cumsum(size + 1) - size
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    source = np.repeat(first, size) + inner
    target = np.repeat(begin, size) + inner
    symbols = np.zeros(int(begin[-1] + size[-1] + 1), np.int64)
    local, numbers = np.unique(place[source], return_inverse=True)
    symbols[target] = numbers + 1
    number = np.zeros(len(p.vocabulary) + 1, np.int64)
    number[local + 1] = np.arange(1, len(local) + 1)
    index = Index(symbols)
    low, high = index.search(p, number)
    many = high - low
    phrase = np.repeat(np.arange(len(many)), many)
    rank = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
    at = index.locate(rank)
    back = np.full(len(symbols), -1, np.int64)
    back[target] = source
    return phrase, back[at]


HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, text_sha256 string, spans array<struct<first:long,end:long>>"


class Found:
    """What was found in a batch of texts so far, block by block."""

    def __init__(self, texts: pa.Array) -> None:
        self.w = Words(texts, ALNUM, lower=True)
        self.hashes = self.w.hashes()
        self.edges = np.zeros(len(self.w.start) + 1, np.int32)
        self.items: dict[int, set[str]] = {}

    def search(self, p: Phrases) -> None:
        if not len(p.rows):
            return
        phrase, at = shard_hits(self.w, self.hashes, p)
        np.add.at(self.edges, at, 1)
        np.add.at(self.edges, at + p.length[phrase], -1)
        doc = np.searchsorted(self.w.doc_start, at, "right") - 1
        for d, x in np.unique(np.stack([doc, phrase], 1), axis=0).tolist():
            self.items.setdefault(d, set()).update(p.items_of(x))

    def rows(self, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        w, hit = self.w, np.cumsum(self.edges[:-1]) > 0
        n_hit, spans, text = [0] * len(ids), [[] for _ in range(len(ids))], [None] * len(ids)
        for d in self.items:
            a, c = w.doc_start[d], w.doc_start[d + 1]
            n_hit[d] = int(hit[a:c].sum())
            first, end = _runs(hit[a:c])
            spans[d] = [{"first": int(x), "end": int(y)} for x, y in zip(w.start[a + first] - w.offsets[d], w.end[a + end - 1] - w.offsets[d], strict=True)]
            text[d] = hashlib.sha256(texts[d].as_buffer()).hexdigest()
        items = [sorted(self.items.get(d, ())) for d in range(len(ids))]
        digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(w.n_words), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digest, pa.string()), pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(items, pa.list_(pa.string())), pa.array(text, pa.string()), pa.array(spans, span)],
            [x.strip().split(" ")[0] for x in ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "text_sha256", "spans"]],
        )


def _task(p: Phrases):
    def task(it):
        for b in batches(it, SHARD_BYTES):
            found = Found(b.column(1))
            found.search(p)
            yield found.rows(b.column(0), b.column(1))

    return task


def _item_blocks(block_bytes: int):
    """Items (item_id, text) in blocks of bounded size, or one item: (payload)."""

    def task(it):
        for b in it:
            at, size = 0, 0
            lengths = [len(t.as_buffer()) if t.is_valid else 0 for t in b.column(1)]
            for i, n in enumerate(lengths, 1):
                size += n
                if size >= block_bytes or i == len(lengths):
                    yield pa.RecordBatch.from_arrays([pa.array([pack_table(pa.Table.from_batches([b.slice(at, i - at)]))], pa.binary())], ["payload"])
                    at, size = i, 0

    return task


def _group_task(window: int):
    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        blocks = list(right["payload"])

        @lru_cache(16)  # a task keeps the phrases of so many blocks, and makes those of others anew for each chunk
        def phrases(k: int) -> Phrases:
            items = unpack_table(blocks[k].as_buffer())
            return Phrases(items["item_id"].to_pylist(), items["text"].to_pylist(), window)

        out = [Found(pa.array([], pa.string())).rows(pa.array([], pa.int64()), pa.array([], pa.string()))]
        for payload in left["payload"]:
            docs = unpack_table(payload.as_buffer()).combine_chunks()
            texts = docs["text"].combine_chunks()
            found = Found(texts)
            for k in range(len(blocks)):
                found.search(phrases(k))
            out.append(found.rows(docs["doc_id"].combine_chunks(), texts))
        return pa.Table.from_batches(out)

    return task


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, text_sha256 (of hit texts), spans (bytes)."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    items = only(benchmark, "item_id", "text")
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    if size <= block_bytes:  # measured: all items are one block
        got = items.collect()
        return rows.mapInArrow(_task(Phrases([r["item_id"] for r in got], [r["text"] for r in got], window)), HITS)
    chunks = document_chunks(rows)
    tasks = max(1, chunks.select("grp").distinct().count())
    left = chunks.select(F.pmod(F.xxhash64("grp"), F.lit(tasks)).alias("task"), "payload")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tasks - 1).cast("long"))).alias("task")
    right = items.mapInArrow(_item_blocks(block_bytes), "payload binary").select(every, "payload")
    return left.groupBy("task").cogroup(right.groupBy("task")).applyInArrow(_group_task(window), HITS)


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` (all columns) without the spans of benchmark passages."""
    spans = benchmark_hits(docs, benchmark, window).where("contaminated").select("doc_id", "text_sha256", "spans")
    return cut_spans(docs, spans)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    found = benchmark_hits(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
