"""Operator 13, importance resampling towards a target by hashed n-grams.

Per batch of words a task interns the n-grams in an open-addressed table held in
NumPy arrays: keys are the xxhash64 of an n-gram's bytes, a slot is taken by
linear probing, and an occurrence is at home in a slot only if its bytes equal
those of the slot's first occurrence.  A slot stores the n-gram's bucket and its
count.  The first pass adds counts up by bucket over all documents and over the
target; in the second each occurrence's slot id gathers the gain of its
bucket, and a document's weight is the sum.  What the driver holds is one number
per bucket, whatever the data.

The draw adds Gumbel noise from a hash of the seed and the doc_id, and takes the
highest scores: ranks come from one order over ranges of the narrow scores.

Defined results: a null text has no words, weight 0, and is never drawn; a text of any length is counted whole, in batches of
words that overlap by two; an empty target or table gives gains from counts of 0; rows of one doc_id have the same noise, and
equal rows follow in any order; a null doc_id is hashed as the empty word and comes last among ties;
other columns are ignored, also those whose names differ in case only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, in_order, only, parts_before, written
from .textkit import ALNUM, Words, crc32, lanes_of, same_bytes, xxh64

BUCKETS, MAX_N, SEED, PERCENT, LEAST_WORDS = 10_000, 3, 42, 5, 20
#: Words that start the n-grams of a table.
BATCH_WORDS = 1 << 15


class Interned:
    """An open-addressed table of the spans of a batch: the slot of each occurrence, and bucket and count of each slot."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, buckets: int = BUCKETS, hashed=xxh64) -> None:
        lanes = lanes_of(data)
        key = hashed(lanes, data, start, length)
        size = 1 << max(4, (2 * len(start)).bit_length())
        mask = np.uint64(size - 1)
        owner = np.full(size, -1, np.int32)
        self.slot = np.zeros(len(start), np.int32)
        left, at = np.arange(len(start), dtype=np.int32), (key & mask).astype(np.int32)
        while len(left):
            free = owner[at] < 0
            owner[at[free]] = left[free]  # of several that claim a slot, one gets it
            own = owner[at]
            home = own == left
            check = np.flatnonzero(~home & (key[own] == key[left]) & (length[own] == length[left]))
            i, j = left[check], own[check]
            home[check] = same_bytes(lanes, start[i], lanes, start[j], length[i])
            self.slot[left[home]] = at[home]
            left, at = left[~home], (at[~home] + np.int32(1)) & np.int32(size - 1)
        self.count = np.bincount(self.slot, minlength=size)
        self.used = np.flatnonzero(owner >= 0)
        first = owner[self.used]
        self.bucket = np.zeros(size, np.int64)
        self.bucket[self.used] = crc32(lanes, data, start[first], length[first]) % np.uint32(buckets)


def spans_of(w: Words, max_n: int = MAX_N) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch of words: their bytes joined by single spaces, and start, length and text of all runs of 1 to `max_n` words that begin there."""
    doc, data = w.doc_of_word(), np.append(w.data, np.uint8(32))
    for a in range(0, len(w.start), BATCH_WORDS):
        b = min(a + BATCH_WORDS, len(w.start))
        to = min(b + max_n - 1, len(w.start))
        n = w.end[a:to] - w.start[a:to] + 1
        end = np.cumsum(n)
        begin = end - n
        joined = data[np.repeat(w.start[a:to] - begin, n) + np.arange(end[-1])]
        joined[end - 1] = 32
        start, length, of = [], [], []
        for k in range(max_n):
            i = np.arange(min(b, to - k) - a)
            i = i[doc[a + i] == doc[a + i + k]]
            start.append(begin[i])
            length.append(end[i + k] - 1 - begin[i])
            of.append(doc[a + i])
        yield joined, np.concatenate(start), np.concatenate(length), np.concatenate(of)


def _counts_task(buckets: int, max_n: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches(it, 1 << 20):
            for data, start, length, _ in spans_of(Words(b.column(0), ALNUM, lower=True), max_n):
                t = Interned(data, start, length, buckets)
                total += np.bincount(t.bucket[t.used], t.count[t.used], buckets).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return task


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""
    rows = only(docs, "text").mapInArrow(_counts_task(buckets, max_n), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # a number per bucket
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log-ratio of a bucket's smoothed shares in target and corpus, rounded down."""
    k, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + k) / ((a + 1) * (t + k)))) for a, b in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weights_task(gain: np.ndarray, max_n: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1 << 20):
            w = Words(b.column(1), ALNUM, lower=True)
            weight = np.zeros(len(b), np.int64)
            for data, start, length, doc in spans_of(w, max_n):
                t = Interned(data, start, length, len(gain))
                # whole numbers far below 2**53 add up exactly
                weight += np.bincount(doc, gain[t.bucket][t.slot], len(b)).astype(np.int64)
            features = sum(np.maximum(w.n_words - k, 0) for k in range(max_n))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(w.n_words.astype(np.int64)), pa.array(features.astype(np.int64)), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return task


def importance_weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, n_features, weight towards the texts of `target`."""
    gain = gains(bucket_counts(docs, buckets, max_n), bucket_counts(target, buckets, max_n))
    return only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(_weights_task(gain, max_n), "doc_id long, n_words long, n_features long, weight long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """All rows with doc_id, n_features, weight, score and rank (from 1; null: not drawn)."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))
    scored = written(importance_weights(docs, target, buckets, max_n).withColumn("score", (F.col("weight") + noise).cast("long")), "scores")
    able = F.col("n_words") >= least_words
    ordered = written(in_order(scored, [able.desc(), F.desc("score"), F.col("doc_id").asc_nulls_last()], "scores"), "order")
    totals = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    drawn = ordered.where(able).count() * percent // 100
    # one row per partition of the order
    places = ordered.join(F.broadcast(parts_before(totals)), "part")
    rank = F.col("before") + F.col("at") + 1
    return places.select("doc_id", "n_features", "weight", "score", F.when(able & (rank <= drawn), rank).alias("rank"))


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resampled(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
