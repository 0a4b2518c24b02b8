"""Operator 10, quality rules: how much of a text lies inside repeated n-grams and lines.

Per text, in numpy: rolling hashes of several n-gram lengths find the n-grams
that occur twice or more, and the characters of the words that they cover are
measured; lines equal to an earlier line are measured the same way.  Hash
groups are compared word by word, so a collision cannot change a result.

Defined results: a null or empty text has no words, counts of 0 and fails the
base rule (fewer than 20 words); rows are independent, so ties and repeated rows each
get their own row; a text of any length is measured whole; an empty table gives an empty result; other columns of the input, clashing
names among them, are ignored here and kept by `kept_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches, by_place, only, places_of
from .textkit import Words, mix, window_hashes

#: n-gram length -> largest share (in percent) of a text's word characters that may lie in repeated n-grams.
#: The base rule bounds the words in repeated 8-grams by 30, so those of 8 to 10 words lie at it and below, and
#: above what clean texts reach (a repeated header line gives a short one about 20).
NGRAM_LIMITS = {5: 60, 6: 56, 7: 52, 8: 30, 9: 28, 10: 26}
#: Largest share (in percent) of word characters in lines equal to an earlier line.
LINE_LIMIT = 30
MIN_WORDS = 20
REPEAT_WINDOW, REPEAT_LIMIT = 8, 30
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, " + ", ".join(f"dup_chars_{n} long" for n in NGRAM_LIMITS)
)


def repeated_windows(h: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Flags of the window starts (words) whose `width` words occur twice or more in the same text.

    `h`: word hashes; `doc`: the text of each word.
    """
    flags = np.zeros(len(h), bool)
    if len(h) < width:
        return flags
    start = np.flatnonzero(doc[: len(h) - width + 1] == doc[width - 1 :])
    if not len(start):
        return flags
    key = window_hashes(h, width)[start]
    key ^= doc[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    if not same.any():
        return flags
    at = np.flatnonzero(same)
    a, b = start[order[at]], start[order[at + 1]]
    real = doc[a] == doc[b]
    for k in range(width):
        real &= h[a + k] == h[b + k]
    if real.all():
        flags[a] = flags[b] = True
        return flags
    # two different windows share a hash: compare this rare group in full
    groups = {}
    for i in np.unique(np.concatenate([a, b])):
        groups.setdefault((doc[i], *h[i : i + width].tolist()), []).append(i)
    for found in groups.values():
        if len(found) > 1:
            flags[found] = True
    return flags


def cover(starts: np.ndarray, width: int) -> np.ndarray:
    """Flags of the words inside any flagged window; windows don't cross texts."""
    edges = np.zeros(len(starts) + 1, np.int32)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, np.minimum(at + width, len(starts)), -1)
    return np.cumsum(edges[:-1]) > 0


def _measure(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    w = Words(texts)
    n_docs = len(ids)
    doc = w.doc_of_word()
    # the kinds of words decide, not their hashes: equal numbers are equal bytes
    h = mix(w.distinct()[1].astype(np.uint64))
    per_doc = lambda values: np.add.reduceat(np.append(values, 0), np.minimum(w.doc_start[:-1], len(values)))[:n_docs] * (w.n_words > 0) if n_docs else np.zeros(0, np.int64)
    heads = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int64)])
    chars = heads[w.end] - heads[w.start]
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[w.data], dtype=np.int64)])
    word_chars = per_doc(chars)

    # lines: runs of words of the same line; the key of a line is its exact bytes
    newline = np.flatnonzero(w.data == 10)
    line = np.searchsorted(newline, w.start)
    first = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (doc[1:] != doc[:-1]))) if len(line) else np.zeros(0, np.int64)
    n_dup_lines = np.zeros(n_docs, np.int64)
    dup_line_chars = np.zeros(n_docs, np.int64)
    if len(first):
        ends = np.append(first[1:], len(line))
        line_doc = doc[first]
        left = np.maximum(np.where(line[first] > 0, newline[np.maximum(line[first] - 1, 0)] + 1 if len(newline) else 0, 0), w.offsets[line_doc])
        nl = np.append(newline, len(w.data))
        right = np.minimum(nl[line[first]], w.offsets[line_doc + 1])
        char_sum = np.concatenate([[0], np.cumsum(chars)])
        raw = w.data.tobytes()
        word_total = np.concatenate([[np.uint64(0)], np.cumsum(h)])
        rough = (word_total[ends] - word_total[first]) ^ (line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (right - left).astype(np.uint64)
        _, inverse, counts = np.unique(rough, return_inverse=True, return_counts=True)
        seen: set = set()
        for i in np.flatnonzero(counts[inverse] > 1):  # only lines whose rough key repeats are compared
            d = line_doc[i]
            key = (d, raw[left[i] : right[i]])
            if key in seen:
                n_dup_lines[d] += 1
                dup_line_chars[d] += char_sum[ends[i]] - char_sum[first[i]]
            else:
                seen.add(key)

    dup_chars = {}
    n_repeat = np.zeros(n_docs, np.int64)
    alive = None  # a repeated (n+1)-gram starts with a repeated n-gram
    for n in NGRAM_LIMITS:
        found = repeated_windows(h, doc, n)
        covered = cover(found, n)
        dup_chars[n] = per_doc(np.where(covered, chars, 0))
        if n == REPEAT_WINDOW:
            n_repeat = per_doc(covered.astype(np.int64))
        alive = found
        if not alive.any():
            for m in NGRAM_LIMITS:
                dup_chars.setdefault(m, np.zeros(n_docs, np.int64))
            break
    failed = (w.n_words < MIN_WORDS) | (100 * n_repeat > REPEAT_LIMIT * w.n_words)
    kept = ~failed & (100 * dup_line_chars <= LINE_LIMIT * word_chars)
    for n, most in NGRAM_LIMITS.items():
        kept &= 100 * dup_chars[n] <= most * word_chars
    cols = [ids.cast(pa.int64()), w.n_words, word_chars, symbols[w.offsets[1:]] - symbols[w.offsets[:-1]], n_dup_lines, n_repeat, failed, kept, dup_line_chars, *dup_chars.values()]
    names = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names)


def _task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(it, 2 << 20):
        yield _measure(b.column(0), b.column(1))


def repetition_rules(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): the base counts, `base_failed`, the characters in repeated lines and n-grams, and `kept`."""
    return only(docs, "doc_id", "text").mapInArrow(_task, SCHEMA)


def _filter_task(id_at: int, text_at: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 2 << 20):
            yield b.filter(_measure(pa.nulls(len(b), pa.int64()), b.column(text_at)).column("kept"))

    return task


def kept_documents(docs: DataFrame) -> DataFrame:
    """`docs` (all columns) without the documents that the rules reject."""
    plain = by_place(docs)
    return plain.mapInArrow(_filter_task(*places_of(docs.columns, "doc_id", "text")), plain.schema).toDF(*docs.columns)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    return repetition_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
