"""Operator 6, best-fit packing after Martello-Toth dominance reduction.

Texts become token ids (with an id 0 at the end of each), only texts longer
than a sequence are cut, and the pieces are packed.  How many pieces there are
of each length (at most `capacity` numbers) decides the packing: the reduction
fixes bins that dominate every other choice for their largest piece, and the
remainder is packed by best fit, longest first.  A bin pattern says which ranks
within a length it takes, and the pieces look their place up by (length, rank).

Tokens are looked up per distinct word of a batch: the vocabulary's rules never
join characters across white space, so a text's ids are its words' ids in turn.

Defined results: a null text is empty and packs as the single id 0; repeated
rows are packed one by one; a text longer than a sequence is cut, whatever its length; an empty table gives an
empty result; other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, environment, only, ranked, values_table, written
from .textkit import Words

CAPACITY = 2048
END_ID = 0
#: Distinct words that a task keeps the ids of before it starts afresh.
MOST_WORDS = 2_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of words by their bytes; words not seen before are encoded once."""

    #: Letters that lower case one to one and have no decomposed form, then plain signs (an apostrophe may begin a piece of its own).
    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\\[-`{-~]*)")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        environment()
        self.tokenizer = Tokenizer.from_file(path)
        # the vocabulary alone: pieces are given to it as they are
        self.merges = Tokenizer(self.tokenizer.model)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE shows the other bytes as 256 + i
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.reset()

    def reset(self) -> None:
        #: Words and pieces of words by number; a word is a piece or two (-1: none), a piece a run of the pool.
        self.known: dict[bytes, int] = {}
        self.pieces: dict[str, int] = {}
        self.parts = np.zeros((1 << 12, 2), np.int64)
        self.first = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.n_pieces = 0

    def keep(self, ids: np.ndarray, count: np.ndarray) -> None:
        """Takes up new pieces: their ids one after the other, and how many each has."""
        total, n = self.used + len(ids), self.n_pieces + len(count)
        while total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        while n > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros(len(x), np.int64)]) for x in (self.first, self.count))
        self.pool[self.used : total] = ids
        self.first[self.n_pieces : n] = np.cumsum(count) - count + self.used
        self.count[self.n_pieces : n] = count
        self.used, self.n_pieces = total, n

    def learn(self, words: list[bytes]) -> None:
        """Encodes words not seen before: plain ones as letters and signs, each piece once, the others as a whole."""
        pieces, other, heads, tails = {}, [], [], []
        begin, seen, match = self.n_pieces, self.pieces, self.PLAIN.fullmatch
        text = b"\n".join(words).decode("utf-8", "replace")
        # plain words lower case letter by letter, so their pieces stand where they stood
        for word, low in zip(text.split("\n"), text.lower().split("\n"), strict=True):
            if not (plain := match(word)):
                heads.append(~len(other))
                tails.append(-1)
                other.append(word)
                continue
            n = plain.end(1)
            own = -1
            for s in (low[n:], low[:n]) if n < len(low) else (low,):
                last, own = own, seen.get(s)
                if own is None and (own := pieces.get(s)) is None:
                    own = pieces[s] = begin + len(pieces)
            heads.append(own)
            tails.append(last)
        if pieces:
            got = self.merges.encode([s if s.isascii() else s.encode().decode("latin-1").translate(self.letters) for s in pieces], is_pretokenized=True, add_special_tokens=False)
            self.keep(np.array(got.ids, np.uint32), np.bincount(np.array(got.word_ids, np.int64), minlength=len(pieces)))
            self.pieces.update(pieces)
        after = self.n_pieces
        if other:
            found = [x.ids for x in self.tokenizer.encode_batch(other, add_special_tokens=False)]
            self.keep(np.array([i for ids in found for i in ids], np.uint32), np.array([len(x) for x in found], np.int64))
        head = np.array(heads, np.int64)
        rows = np.stack([np.where(head < 0, after + ~head, head), np.array(tails, np.int64)], axis=1)
        old = len(self.known) - len(words)
        while len(self.known) > len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros_like(self.parts)])
        self.parts[old : len(self.known)] = rows

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a batch's words, and how many each word has."""
        at, kind = w.distinct()
        if len(self.known) + len(at) > MOST_WORDS:
            self.reset()
        raw, known = w.data.tobytes(), self.known
        words = [raw[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)]
        found = list(map(known.get, words))
        missing = [i for i, k in enumerate(found) if k is None]
        if missing:
            new = [words[i] for i in missing]
            numbers = range(len(known), len(known) + len(new))
            known.update(zip(new, numbers, strict=True))
            self.learn(new)
        place = np.array([-1 if k is None else k for k in found] if missing else found, np.int64)
        if missing:
            place[missing] = numbers
        pieces = self.parts[place[kind]]
        each = np.where(pieces >= 0, self.count[pieces], 0)
        own = pieces[pieces >= 0]
        count, first = self.count[own], self.first[own]
        begin = np.cumsum(count) - count
        return self.pool[np.repeat(first - begin, count) + np.arange(count.sum())], each.sum(axis=1)


def pieces_of(path: str, capacity: int, with_ids: bool = False):
    """A task over (doc_id, text) batches that returns the pieces of each text."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        for b in batches(it, 2 << 20):
            w = Words(b.column(1))
            ids, count = words.of(w)
            ends = np.concatenate([[0], np.cumsum(count)])[w.doc_start]
            doc, piece, start, length, crc, kept = [], [], [], [], [], []
            for d in range(len(b)):
                own = np.append(ids[ends[d] : ends[d + 1]], np.uint32(END_ID)).astype("<u4")
                for k in range(0, len(own), capacity):
                    part = own[k : k + capacity]
                    doc.append(d)
                    piece.append(k // capacity)
                    start.append(k)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            cols = [b.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return task


def tokenised(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces of each text; `with_ids` adds the token ids themselves."""
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces_of(path or vocabulary_path(), capacity, with_ids), schema)


class Counts:
    """How many pieces of each length are left, with the lengths that occur kept in order."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.n = {s: c for s, c in counts.items() if c}
        self.sizes = sorted(self.n)

    def take(self, size: int, many: int) -> None:
        self.n[size] -= many
        if not self.n[size]:
            del self.n[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def largest(self, most: int) -> int:
        """The largest length up to `most`, or 0."""
        k = bisect_right(self.sizes, most)
        return self.sizes[k - 1] if k else 0

    def fit(self, room: int, limit: int = 3) -> int:
        """How many of the smallest pieces fit into `room`, counted up to `limit`."""
        k = 0
        for s in self.sizes:
            m = min(self.n[s], limit - k, room // s)
            k += m
            room -= m * s
            if k >= limit or m < self.n[s]:
                break
        return k


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Martello-Toth reduction: bins (lengths, how many such bins) fixed for good, and the counts left.

    For each length j, longest first: alone if nothing fits beside it; with the
    longest piece i that fits if that fills the bin or if at most one piece
    fits; if at most two fit, with i when no feasible pair is longer than i, or
    with the pair (i, b) when every feasible pair is at most as long place by place.
    """
    left = Counts(counts)
    bins: list[tuple[tuple[int, ...], int]] = []

    def fix(pattern: tuple[int, ...]) -> None:
        many = min(left.n[s] // pattern.count(s) for s in set(pattern))
        for s in set(pattern):
            left.take(s, many * pattern.count(s))
        bins.append((pattern, many))

    for j in sorted(counts, reverse=True):
        while left.n.get(j):
            room = capacity - j
            left.n[j] -= 1  # j itself is not a partner of j
            gone = left.n[j] == 0
            if gone:
                left.sizes.pop(bisect_left(left.sizes, j))
            k, i = left.fit(room), left.largest(room)
            pattern: tuple[int, ...] | None = None
            if k == 0:
                pattern = (j,)
            elif k == 1 or i == room:
                pattern = (j, i)
            elif k == 2:
                pairs = _best_pair(left, room)
                if pairs is None or i >= sum(pairs[0]):
                    pattern = (j, i)
                elif pairs[0][0] == i and pairs[0][1] >= pairs[1]:
                    pattern = (j, *pairs[0])
            left.n[j] += 1
            if gone:
                insort(left.sizes, j)
            if pattern is None:
                break
            fix(pattern)
    return bins, dict(left.n)


def _best_pair(left: Counts, room: int) -> tuple[tuple[int, int], int] | None:
    """The feasible pair of the largest sum (the longest first piece on ties), and the largest shorter piece of any feasible pair."""
    best: tuple[int, int] | None = None
    second = 0
    for a in reversed(left.sizes):
        b = left.largest(min(a, room - a)) if room > a else 0
        if b == a and left.n[a] < 2:
            b = left.largest(min(a - 1, room - a))
        if b:
            second = max(second, b)
            if best is None or a + b > sum(best):
                best = (a, b)
    return (best, second) if best else None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best fit, longest first: bins (((length, count), ...), how many such bins)."""
    open_bins: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: tuple[tuple[int, int], ...], many: int) -> None:
        if many:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append((pattern, many))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        # the tightest bin that takes s stays the tightest until it is full, so each takes room // s pieces
        while n and (k := bisect_left(rooms, s)) < len(rooms):
            room = rooms[k]
            pattern, many = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(k)
            each = room // s
            full = min(many, n // each)
            put(room - each * s, (*pattern, (s, each)), full)
            n -= full * each
            rest = many - full
            if rest and n:  # fewer than `each` pieces are left
                put(room - n * s, (*pattern, (s, n)), 1)
                rest -= 1
                n = 0
            put(room, pattern, rest)
        if n:
            each = capacity // s
            put(capacity - each * s, ((s, each),), n // each)
            if n % each:
                put(capacity - (n % each) * s, ((s, n % each),), 1)
    return [x for found in open_bins.values() for x in found]


def places(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, offset, pieces per bin) for all pieces."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    patterns = [(tuple((s, p.count(s)) for s in sorted(set(p), reverse=True)), many) for p, many in fixed] + best_fit(rest, capacity)
    taken = dict.fromkeys(counts, 0)
    out, sequence = [], 0
    for pattern, many in patterns:
        offset = 0
        for s, each in pattern:
            out.append((s, taken[s], taken[s] + many * each, sequence, offset, each))
            taken[s] += many * each
            offset += s * each
        sequence += many
    assert taken == {s: n for s, n in counts.items()}
    return out


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a stable table of pieces (doc_id, piece, length, ids_crc32, ...)."""
    # at most `capacity` counts, whatever the size of the table
    counts = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = values_table(pieces.sparkSession, "length long, first long, end long, seq0 long, off0 long, each long", places(counts, capacity))
    bits = math.ceil(max(counts.values(), default=0).bit_length() / 2)
    rank = ranked(pieces, ["length"], F.xxhash64("doc_id", "piece", "ids_crc32"), [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], cell_bits=bits)
    at = rank.join(F.broadcast(table), "length").where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    inner = F.col("rank") - F.col("first")
    return at.select(
        *pieces.columns, (F.col("seq0") + F.expr("(rank - first) div each")).alias("sequence_id"), (F.col("off0") + F.pmod(inner, F.col("each")) * F.col("length")).alias("offset")
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packed(written(tokenised(docs, capacity, path), "pieces"), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The packed token sequences themselves: sequence_id, ids, and the piece that each run comes from."""
    own = packed(written(tokenised(docs, capacity, path, with_ids=True), "pieces"), capacity)
    part = F.struct("offset", "doc_id", "piece", "ids")
    return own.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["doc_id"].alias("doc_id"), p["piece"].alias("piece"))).alias("parts")
    )


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
