"""Vectorised word handling for Arrow string columns.

Everything here works on one Arrow batch inside a Spark task: words are found
on the UTF-8 bytes of the whole batch at once and hashed (xxhash64) together, so
no Python loop runs over words.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1

#: Bytes of `[^\x20\x09-\x0D]`: white space is ASCII, so UTF-8 bytes decide.
WORD = np.ones(256, bool)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`: digits, a-z and all that is not ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64
#: Fixed values of the xxhash64 function.
_P1, _P2, _P3, _P4, _P5 = _U(11400714785074694791), _U(14029467366897019727), _U(1609587929392839161), _U(9650029242287828579), _U(2870177450012600261)
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first k bytes
#: Spans that are hashed at once, and the length from which they are hashed one by one.
_STEP, _LONG = 1 << 15, 256


def lanes_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded.tobytes(), 0, (1,)).copy()


def _by_length(length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length with the numbers of its spans, some at a time."""
    if not len(length):
        return
    order = np.argsort(length.astype(np.uint16) if int(length.max()) < 1 << 16 else length, kind="stable")
    sizes, first = np.unique(length[order], return_index=True)
    for size, a, b in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        for i in range(a, b, _STEP):
            yield size, order[i : min(i + _STEP, b)]


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << _U(bits)) | (x >> _U(64 - bits))


def _mixed(acc, lane: np.ndarray) -> np.ndarray:
    return _turned(acc + lane * _P2, 31) * _P1


def xxh64(lanes: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The xxhash64 (seed 0) of the spans of `data` from `start` of `length` bytes, all spans of a length at once."""
    import xxhash

    out = np.empty(len(start), np.uint64)
    zero = _U(0)
    for size, at in _by_length(length):
        s = start[at]
        if size > _LONG:
            out[at] = [xxhash.xxh64_intdigest(data[x : x + size].tobytes()) for x in s.tolist()]
            continue
        k = 0
        if size >= 32:
            acc = [np.full(len(s), v, np.uint64) for v in (np.add(_P1, _P2, dtype=np.uint64), _P2, zero, np.subtract(zero, _P1, dtype=np.uint64))]
            while size - k >= 32:
                acc = [_mixed(v, lanes[s + (k + 8 * j)]) for j, v in enumerate(acc)]
                k += 32
            h = _turned(acc[0], 1) + _turned(acc[1], 7) + _turned(acc[2], 12) + _turned(acc[3], 18)
            for v in acc:
                h = (h ^ _mixed(zero, v)) * _P1 + _P4
        else:
            h = np.full(len(s), _P5, np.uint64)
        h += _U(size)
        while size - k >= 8:
            h = _turned(h ^ _mixed(zero, lanes[s + k]), 27) * _P1 + _P4
            k += 8
        if size - k >= 4:
            h = _turned(h ^ ((lanes[s + k] & _FIRST[4]) * _P1), 23) * _P2 + _P3
            k += 4
        while k < size:
            h = _turned(h ^ ((lanes[s + k] & _FIRST[1]) * _P5), 11) * _P1
            k += 1
        h = (h ^ (h >> _U(33))) * _P2
        h = (h ^ (h >> _U(29))) * _P3
        out[at] = h ^ (h >> _U(32))
    return out


def _crc_tables() -> np.ndarray:
    """[k][b]: the CRC-32 of byte b followed by k zeros, without the inversions."""
    out = np.zeros((8, 256), np.uint32)
    for b in range(256):
        x = b
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        out[0, b] = x
    for k in range(1, 8):
        out[k] = (out[k - 1] >> np.uint32(8)) ^ out[0][out[k - 1] & np.uint32(255)]
    return out


_CRC = _crc_tables()


def crc32(lanes: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The unsigned CRC-32 of spans, all spans of a length at once, eight bytes a step."""
    import zlib

    out = np.empty(len(start), np.uint32)
    byte = np.uint32(255)
    for size, at in _by_length(length):
        s = start[at]
        if size > _LONG:
            out[at] = [zlib.crc32(data[x : x + size].tobytes()) for x in s.tolist()]
            continue
        c, k = np.full(len(s), 0xFFFFFFFF, np.uint32), 0
        while size - k >= 8:
            lane = lanes[s + k]
            low, high = lane.astype(np.uint32) ^ c, (lane >> _U(32)).astype(np.uint32)
            c = _CRC[7][low & byte]
            for j in (1, 2, 3):
                c ^= _CRC[7 - j][(low >> np.uint32(8 * j)) & byte]
            for j in range(4):
                c ^= _CRC[3 - j][(high >> np.uint32(8 * j)) & byte]
            k += 8
        if k < size:
            lane = lanes[s + k]
            for j in range(size - k):
                c = _CRC[0][(c ^ (lane >> _U(8 * j)).astype(np.uint32)) & byte] ^ (c >> np.uint32(8))
        out[at] = ~c
    return out


def same_bytes(a_lanes: np.ndarray, a: np.ndarray, b_lanes: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of `length` bytes at `a` and at `b` are equal."""
    same, left, k = np.ones(len(a), bool), np.flatnonzero(length > 0), 0
    while len(left):
        rest = length[left] - k
        differ = ((a_lanes[a[left] + k] ^ b_lanes[b[left] + k]) & _FIRST[np.minimum(rest, 8)]) != 0
        same[left[differ]] = False
        left = left[(rest > 8) & ~differ]
        k += 8
    return same


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])), offsets - offsets[0]


class Words:
    """Words of a batch: byte spans `start:end`, `doc_start` (n + 1 word offsets of the texts)."""

    def __init__(self, col: pa.Array, inside: np.ndarray = WORD, lower: bool = False) -> None:
        self.data, self.offsets = text_bytes(col)
        if lower:
            self.data = _LOWER[self.data]
        word = inside[self.data]
        n = len(word)
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            edges = self.offsets[:-1][np.diff(self.offsets) > 0]
            before[edges] = False
            after[edges[1:] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.doc_start = np.searchsorted(self.start, self.offsets)
        self.n_words = np.diff(self.doc_start)

    @cached_property
    def lanes(self) -> np.ndarray:
        return lanes_of(self.data)

    def hashes(self) -> np.ndarray:
        """The xxhash64 of each word's bytes: other words of any length may share one, by chance alone."""
        return xxh64(self.lanes, self.data, self.start, self.end - self.start)

    def distinct(self, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """A word of each kind, and the kind of each word: kinds differ exactly where the bytes do, whatever the hashes."""
        h = self.hashes() if hashes is None else hashes
        _, first, kind = np.unique(h, return_index=True, return_inverse=True)
        size = self.end - self.start
        own = first[kind]
        equal = size == size[own]
        at = np.flatnonzero(equal & (own != np.arange(len(own))))
        equal[at] = same_bytes(self.lanes, self.start[at], self.lanes, self.start[own[at]], size[at])
        if not equal.all():  # words with one hash and other bytes become kinds of their own
            raw, known, more = self.data.tobytes(), {}, []
            for i in np.flatnonzero(~equal).tolist():
                word = raw[self.start[i] : self.end[i]]
                if word not in known:
                    known[word] = len(first) + len(more)
                    more.append(i)
                kind[i] = known[word]
            first = np.concatenate([first, np.array(more, first.dtype)])
        return first, kind

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_words)), self.n_words)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` word hashes, as if all words were one text."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= np.uint64(_BASE)
        out += words[k : k + n]
    return mix(out)


def window_starts(doc_start: np.ndarray, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which a window of `width` lies inside one text, and the text of each."""
    n = np.diff(doc_start)
    counts = np.maximum(n - width + 1, 0)
    doc = np.repeat(np.arange(len(n)), counts)
    first = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - first[doc] + doc_start[:-1][doc], doc
