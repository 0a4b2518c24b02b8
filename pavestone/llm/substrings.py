"""Operator 7, substring dedup by level-wise doubling.

Windows of a short length that occur once alone cannot be part of a longer
repeated window, so each level keeps only windows both of whose halves were
repeated, and doubles the length (5, 10, 20 words) until the wanted one is reached,
or no candidate survives: then nothing is removed and no further level runs.  Below the last level a chunk sends slots (leading bits of a window's
hash); a slot that two windows share by chance only keeps a candidate longer.
At the last level it sends full 64-bit hashes with the smallest doc_id of each, so
that every chunk learns which of its windows start earlier elsewhere.

Order of occurrences: doc_id, then start; rows that share a doc_id follow their
chunk and place.  Defined results: a null text has no words; a null doc_id comes
first; texts shorter than the window lose nothing; a very long text is a chunk of its own and loses its own repeats too;
of repeated rows the first stays whole; an empty table gives an empty result; other columns, clashing names among them, are
ignored here and kept by `remove_repeats`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .chunks import STATE, Answers, Ranges, answered, block_rows, document_chunks, emit_from_chunks, emit_with_answers, in_several, join_parts, pack_ints, pack_sorted, ranges_of, split_parts, unpack_ints, unpack_sorted, with_answers
from .common import by_place, drop_written, places_of, written
from .textkit import Words, window_hashes, window_starts

WINDOW, FIRST_LEVEL = 20, 5
NULL_ID = -(1 << 63)


def levels(window: int, first: int) -> list[int]:
    """Lengths by doubling that end at `window`."""
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= first:
        out.insert(0, out[0] // 2)
    return out


class Windows:
    """The windows of a chunk's texts that can still be repeated, level by level."""

    def __init__(self, table: pa.Table, ranges: Ranges, lengths: list[int], alive: bytes | None = None) -> None:
        self.words = Words(table["text"])
        self.ids = table["doc_id"].combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        self.hashes = self.words.hashes()
        self.ranges, self.lengths = ranges, lengths
        self.starts, self.doc = window_starts(self.words.doc_start, lengths[-1])
        self.alive = np.ones(len(self.starts), bool) if alive is None else np.unpackbits(np.frombuffer(alive, np.uint8), count=len(self.starts)).astype(bool)

    def slots(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct slots of the level's windows inside candidates, with each window's place, count and start."""
        length = self.lengths[level]
        # a candidate's inner windows start at its own start and up to `reach` words behind
        edges = np.zeros(len(self.hashes) + 2, np.int32)
        alive, reach = self.starts[self.alive], self.lengths[-1] - length
        edges[alive] = 1
        np.subtract.at(edges, alive + reach + 1, 1)
        at = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        slots = self.ranges.slots(window_hashes(self.hashes, length)[at])
        distinct, inverse, counts = np.unique(slots, return_inverse=True, return_counts=True)
        return distinct, inverse, counts, at

    def settle(self, level: int, own: Answers) -> None:
        """Keeps the candidates all of whose windows at this level are repeated."""
        distinct, inverse, counts, at = self.slots(level)
        flags = np.frombuffer(own.take(level, self.ranges.cuts(distinct, self.ranges.slot_bits)), np.uint8)
        repeated = np.zeros(len(self.hashes) + 1, bool)
        repeated[at] = ((flags > 0) | (counts > 1))[inverse]
        length = self.lengths[level]
        for shift in range(0, self.lengths[-1] - length + 1, length):
            self.alive &= repeated[self.starts + shift]

    def last(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of the candidates, the first candidate of each, and each candidate's place and start."""
        start = self.starts[self.alive]
        keys = window_hashes(self.hashes, self.lengths[-1])[start] if len(start) else np.zeros(0, np.uint64)
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return distinct, first, inverse, start


def earlier_elsewhere(chunks: list[int], blocks: list[bytes]) -> list[bytes]:
    """1 for each hash that starts earlier in another chunk, by (doc_id, chunk)."""
    parts = [split_parts(b) for b in blocks]
    keys = [unpack_sorted(p[0]) for p in parts]
    flat = np.concatenate(keys)
    ids = np.concatenate([unpack_ints(p[1]) for p in parts])
    of = np.repeat(np.array(chunks, np.int64), [len(k) for k in keys])
    order = np.lexsort((of, ids, flat))
    s = flat[order]
    flag = np.zeros(len(flat), np.uint8)
    flag[order[1:][s[1:] == s[:-1]]] = 1
    ends = np.cumsum([len(k) for k in keys])
    return [flag[e - len(k) : e].tobytes() for e, k in zip(ends, keys, strict=True)]


def removed_words(docs: DataFrame, finish, schema: str, window: int = WINDOW, first: int = FIRST_LEVEL, keep: str | None = None) -> DataFrame:
    """Runs the levels and gives `finish(table, words, removed)` each chunk with its flags of words to remove.

    With `keep`, the result is written under that name and what led to it is removed.
    """
    chunks = document_chunks(docs)
    ranges = ranges_of(chunks)
    lengths = levels(window, first)
    found: DataFrame | None = None
    made: list[DataFrame] = [chunks]

    def state(table: pa.Table, level: int, own: Answers | None) -> Windows:
        """The candidates before a level: those that the level before told, of those that this chunk had then."""
        w = Windows(table, ranges, lengths, own.state() if level > 1 else None)
        if level:
            w.settle(level - 1, own)
        return w

    def emitter(level: int):
        def emit(table: pa.Table, own: Answers | None = None) -> dict[int, bytes]:
            w = state(table, level, own)
            if level < len(lengths) - 1:
                slots = w.slots(level)[0]
                blocks = block_rows(ranges.cuts(slots, ranges.slot_bits), lambda a, b: pack_sorted(slots[a:b]))
            else:
                keys, first_at, _, _ = w.last()
                ids = w.ids[w.doc[w.alive]][first_at]
                blocks = block_rows(ranges.cuts(keys), lambda a, b: join_parts(pack_sorted(keys[a:b]), pack_ints(ids[a:b])))
            if level:
                blocks[STATE] = np.packbits(w.alive).tobytes()
            return blocks

        return emit

    survive = True
    for level in range(len(lengths)):
        blocks = emit_from_chunks(chunks, emitter(level)) if found is None else emit_with_answers(chunks, found, emitter(level))
        new = written(answered(blocks, level, in_several if level < len(lengths) - 1 else earlier_elsewhere), "answers")
        made.append(new)
        found = new
        if new.where("range >= 0").limit(1).count() == 0:  # no window of this length can be repeated, nor a longer one
            survive = False
            break

    def end(table: pa.Table, own: Answers) -> pa.RecordBatch:
        if not survive:
            words = Words(table["text"])
            return finish(table, words, np.zeros(len(words.start), bool))
        w = Windows(table, ranges, lengths, own.state() if len(lengths) > 1 else None)
        keys, first_at, inverse, start = w.last()
        later = (np.frombuffer(own.take(len(lengths) - 1, ranges.cuts(keys)), np.uint8) > 0)[inverse]
        later |= first_at[inverse] != np.arange(len(start))
        edges = np.zeros(len(w.hashes) + 1, np.int32)
        np.add.at(edges, start[later], 1)
        np.add.at(edges, start[later] + window, -1)
        return finish(table, w.words, np.cumsum(edges[:-1]) > 0)

    out = with_answers(chunks, found, end, schema)
    if keep is None:
        return out
    out = written(out, keep)
    drop_written(*made)
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _digest(table: pa.Table, w: Words, removed: np.ndarray) -> pa.RecordBatch:
    raw = w.data.tobytes()
    n_removed = np.add.reduceat(np.append(removed, False).astype(np.int64), np.minimum(w.doc_start[:-1], len(removed))) * (w.n_words > 0) if len(w.n_words) else np.zeros(0, np.int64)
    out = []
    for d in range(len(w.n_words)):
        a, b = w.doc_start[d], w.doc_start[d + 1]
        keep = np.arange(a, b)[~removed[a:b]] if n_removed[d] else range(a, b)
        out.append(hashlib.sha256(b" ".join([raw[w.start[i] : w.end[i]] for i in keep])).hexdigest())
    return pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(w.n_words), pa.array(n_removed), pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeat_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256."""
    return removed_words(docs, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string", window)


def _spans(table: pa.Table, w: Words, removed: np.ndarray) -> pa.RecordBatch:
    """Byte spans to cut from each text that loses words: from a removed word to the next kept one, or the end."""
    ids, text_hash, spans = [], [], []
    touched = np.unique(np.searchsorted(w.doc_start, np.flatnonzero(removed), "right") - 1)
    for d in touched:
        a, b = w.doc_start[d], w.doc_start[d + 1]
        first, end = _runs(removed[a:b])
        base = w.offsets[d]
        stop = np.where(end < b - a, w.start[np.minimum(a + end, len(w.start) - 1)], w.offsets[d + 1])
        ids.append(d)
        text_hash.append(hashlib.sha256(w.data[w.offsets[d] : w.offsets[d + 1]].tobytes()).hexdigest())
        spans.append([{"first": int(x), "end": int(y)} for x, y in zip(w.start[a + first] - base, stop - base, strict=True)])
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks().take(pa.array(ids, pa.int64())), pa.array(text_hash, pa.string()), pa.array(spans, span)], ["doc_id", "text_sha256", "spans"])


def _cut_task(text_at: int, length_at: int | None):
    def task(it):
        for b in it:
            out, cols = [], list(b.columns)
            for text, cut in zip(cols[text_at], cols.pop(), strict=True):
                if not cut.is_valid:
                    out.append(text.as_py())
                    continue
                raw, at, kept = text.as_buffer().to_pybytes(), 0, []
                for s in cut.as_py():
                    kept.append(raw[at : s["first"]])
                    at = s["end"]
                kept.append(raw[at:])
                out.append(b"".join(kept).rstrip(b" \t\n\r\x0b\x0c").decode())
            cols[text_at] = pa.array(out, pa.string())
            if length_at is not None:  # the length of a text that isn't null
                kind = cols[length_at].type
                cols[length_at] = pa.array([n if t is None else len(t) for t, n in zip(out, cols[length_at].to_pylist(), strict=True)], kind)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    return task


def cut_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`docs` (all columns, n_chars brought up to date) with byte spans cut from their texts.

    `spans`: (doc_id, text_sha256, spans); rows are matched by doc_id and the text's SHA-256.
    Of rows equal in both, as many are cut as `spans` has rows for them.
    """
    plain = by_place(docs)
    id_at, text_at = places_of(docs.columns, "doc_id", "text")
    length_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    keys = lambda i, sha: (F.coalesce(i.cast("long"), F.lit(NULL_ID)).alias("k_id"), i.isNull().alias("k_null"), sha.alias("k_sha"))
    own = spans.select(*keys(F.col("doc_id"), F.col("text_sha256")), "spans").groupBy("k_id", "k_null", "k_sha").agg(F.collect_list("spans").alias("cuts"))
    told = plain.select("*", *keys(F.col(f"_c{id_at}"), F.sha2(F.col(f"_c{text_at}").cast("binary"), 256)))
    joined = told.join(own, ["k_id", "k_null", "k_sha"], "left")
    # equal rows are numbered where the join has dealt them
    number = F.row_number().over(Window.partitionBy("k_id", "k_null", "k_sha").orderBy(F.lit(1)))
    joined = joined.withColumn("number", number).select(*plain.columns, F.get("cuts", F.col("number") - 1).alias("spans"))
    return joined.mapInArrow(_cut_task(text_at, length_at), plain.schema).toDF(*docs.columns)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` (all columns) without the words of repeated windows; white space around what stays is kept."""
    return cut_spans(docs, removed_words(docs, _spans, "doc_id long, text_sha256 string, spans array<struct<first:long,end:long>>", window, keep="spans"))


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeat_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
