"""Which keys of a corpus occur more than once, without a row per key.

Texts are kept in chunks of a few MB, one compressed row each, and neighbouring
chunks form a group, dealt once.  A group sends the distinct keys of its chunks (hashes of windows) as
sorted blocks, one row per range of keys; the task of a range sees that range of every
chunk, and answers with one flag or byte per key, in the same order.  The answers of
a group meet it again by its number.  So a key costs a few bytes in the shuffle, no
group of equal keys is ever gathered, and a very frequent key counts once per chunk.

A block row holds about `keys of a group / number of ranges` keys.  Groups are as large as
the input's partitions, up to GROUP_BYTES, and ranges as large as RANGE_KEYS, so block rows stay
few compared with keys: at 30 GB in partitions of 128 MB about 1,300 keys a row, at 1 TB about 40.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only, width, written_by_key

CHUNK_BYTES = 2 << 20
#: Bytes of text of a group of chunks, which one task handles chunk by chunk.
GROUP_BYTES = 64 << 20
#: Keys that one range should hold; small inputs have smaller ranges, but not below LEAST_KEYS.
RANGE_KEYS, LEAST_KEYS = 1 << 20, 1 << 18
CHUNKS = "grp long, chunk long, n_words long, payload binary"
BLOCKS = "range int, grp long, block binary"
#: Key of a chunk's own state among its blocks: it comes back to the group with the answers.
STATE = -2
ANSWERS = "grp long, level int, range int, answer binary"


def pack_table(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_table(payload) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(payload)).read_all()


def _chunk_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = ordinal = group = grouped = 0

    def close() -> pa.RecordBatch:
        nonlocal held, size, ordinal, group, grouped
        if grouped >= GROUP_BYTES:
            group, grouped = group + 1, 0
        grouped += size
        table = pa.Table.from_batches(held).combine_chunks()
        table = table.sort_by("doc_id") if "doc_id" in table.column_names else table
        weight = size // 6
        one = lambda x: pa.array([x], pa.int64())
        out = pa.RecordBatch.from_arrays([one(base + group), one(base + ordinal), one(weight), pa.array([pack_table(table)], pa.binary())], ["grp", "chunk", "n_words", "payload"])
        held, size, ordinal = [], 0, ordinal + 1
        return out

    for b in it:
        parts = max(1, -(-b.nbytes // CHUNK_BYTES))
        step = max(1, -(-b.num_rows // parts))
        for i in range(0, b.num_rows, step):
            part = b.slice(i, step)
            # a slice's nbytes counts its own rows only
            held.append(part)
            size += part.nbytes
            if size >= CHUNK_BYTES:
                yield close()
    if held:
        yield close()


def chunk_table(rows: DataFrame, name: str = "chunks") -> DataFrame:
    """The rows in chunks (CHUNKS), written once and dealt by group; rows are sorted by doc_id inside a chunk."""
    return written_by_key(rows.mapInArrow(_chunk_task, CHUNKS), "grp", width(rows.sparkSession), name)


def document_chunks(docs: DataFrame) -> DataFrame:
    return chunk_table(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text"))


class Ranges:
    """How keys are dealt: `bits` leading bits name a range; slots keep `slot_bits` leading bits of a key."""

    def __init__(self, total: int, tasks: int = 1) -> None:
        log = lambda x: max(0, math.ceil(math.log2(max(1, x))))
        self.bits = max(log(total / RANGE_KEYS), min(log(tasks), log(total / LEAST_KEYS)))
        # five bits more than the number of keys: one slot in 32 is taken by chance
        self.slot_bits = min(64, max(24, math.ceil(math.log2(max(2, total))) + 5))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.slot_bits)

    def cuts(self, sorted_keys: np.ndarray, key_bits: int = 64) -> np.ndarray:
        """Where each range begins in sorted keys of `key_bits` bits, and their end."""
        edges = (np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(key_bits - self.bits)) if self.bits else np.zeros(0, np.uint64)
        return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]])


def ranges_of(chunks: DataFrame) -> Ranges:
    return Ranges(chunks.agg(F.sum("n_words")).first()[0] or 0, 2 * width(chunks.sparkSession))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as a first key and steps of 1 to 8 bytes, of a width that nine in ten steps fit; what larger ones have above it is listed apart."""
    if not len(keys):
        return b"\0"
    steps = np.diff(keys)
    if not len(steps):
        return bytes([1]) + int(keys[0]).to_bytes(8, "little") + bytes(4)
    common = int(np.partition(steps, at := len(steps) * 9 // 10)[at])
    size = max(1, -(-common.bit_length() // 8))
    big = np.flatnonzero(steps >> np.uint64(8 * size)) if size < 8 else np.zeros(0, np.int64)
    low = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)
    return b"".join([bytes([size]), int(keys[0]).to_bytes(8, "little"), len(big).to_bytes(4, "little"), big.astype("<u4").tobytes(), (steps[big] >> np.uint64(8 * size)).astype("<u8").tobytes() if size < 8 else b"", low.tobytes()])


def unpack_sorted(block: bytes) -> np.ndarray:
    if block[0] == 0:
        return np.zeros(0, np.uint64)
    size, n_big = block[0], int.from_bytes(block[9:13], "little")
    at = 13 + 12 * n_big
    low = np.frombuffer(block, np.uint8, offset=at).reshape(size, -1)
    out = np.zeros((low.shape[1] + 1, 8), np.uint8)
    out[1:, :size] = low.T
    out = out.view("<u8").reshape(-1)
    if n_big:
        out[np.frombuffer(block, "<u4", n_big, 13) + 1] += np.frombuffer(block, "<u8", n_big, 13 + 4 * n_big) << np.uint64(8 * size)
    out[0] = int.from_bytes(block[1:9], "little")
    return np.cumsum(out, dtype=np.uint64)


def pack_ints(x: np.ndarray) -> bytes:
    """Integers as a smallest one and differences of 1, 2, 4 or 8 bytes."""
    if not len(x):
        return b"\0"
    low = int(x.min())
    most = int(x.max()) - low
    code = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([code]) + low.to_bytes(8, "little", signed=True) + (x.astype(np.int64).view(np.uint64) - np.uint64(low & (1 << 64) - 1)).astype(f"<u{code}").tobytes()


def unpack_ints(block: bytes) -> np.ndarray:
    if block[0] == 0:
        return np.zeros(0, np.int64)
    low = int.from_bytes(block[1:9], "little", signed=True)
    return (np.frombuffer(block, f"<u{block[0]}", offset=9).astype(np.uint64) + np.uint64(low & (1 << 64) - 1)).view(np.int64)


def join_parts(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def split_parts(block: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(block):
        n = int.from_bytes(block[at : at + 4], "little")
        out.append(block[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def block_rows(cuts: np.ndarray, pack: Callable[[int, int], bytes]) -> dict[int, bytes]:
    """The blocks of a chunk, by range, for those that have keys; `pack` gets the range's first and end place."""
    return {int(r): pack(int(cuts[r]), int(cuts[r + 1])) for r in np.flatnonzero(np.diff(cuts))}


class Answers:
    """What a group of chunks was told; each chunk in turn takes its own, in the order in which it sent its keys."""

    def __init__(self, table: pa.Table) -> None:
        rows = list(zip(table["level"].to_pylist(), table["range"].to_pylist(), table["answer"].to_pylist(), strict=True))
        self.told = {(k, r): a for k, r, a in rows if r >= 0}
        self.states = iter([p for _, r, a in rows if r <= STATE for p in split_parts(a)])
        self.at: dict[tuple[int, int], int] = {}

    def state(self) -> bytes:
        """The state that this chunk sent with its blocks."""
        return next(self.states)

    def take(self, level: int, cuts: np.ndarray, size: int = 1) -> bytes:
        """The answers of a chunk's keys, of `size` bytes each; `cuts` are those that it sent its keys with."""
        out = []
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            a = self.at.get((level, r), 0)
            self.at[level, r] = b = a + size * int(cuts[r + 1] - cuts[r])
            out.append(self.told[level, r][a:b])
            assert len(out[-1]) == b - a
        return b"".join(out)


def _in_order(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    table = table.sort_by("chunk")
    for chunk, payload in zip(table["chunk"].to_pylist(), table["payload"], strict=True):
        yield chunk, unpack_table(payload.as_buffer())


def _merged(group: int, blocks: Iterator[tuple[int, dict[int, bytes]]]) -> pa.Table:
    """The blocks of a group's chunks, one row per range: each chunk's number, then its block."""
    by_range: dict[int, list[bytes]] = {}
    for chunk, own in blocks:
        for r, block in own.items():
            by_range.setdefault(r if r >= 0 else STATE - group % (1 << 30), []).append(chunk.to_bytes(8, "little") + block if r >= 0 else block)
    return pa.table({"range": pa.array(list(by_range), pa.int32()), "grp": pa.array([group] * len(by_range), pa.int64()), "block": pa.array([join_parts(*v) for v in by_range.values()], pa.binary())})


def emit_from_chunks(chunks: DataFrame, emit: Callable[[pa.Table], dict[int, bytes]]) -> DataFrame:
    """BLOCKS of all groups; `emit` gives those of a chunk by range."""

    def task(group: pa.Table) -> pa.Table:
        return _merged(group["grp"][0].as_py(), ((chunk, emit(table)) for chunk, table in _in_order(group)))

    return chunks.groupBy("grp").applyInArrow(task, BLOCKS)


def _told(chunks: DataFrame, answers: DataFrame, task, schema: str) -> DataFrame:
    # a group without keys is told nothing; one empty answer keeps it in the join
    every = chunks.select("grp", F.lit(-1).alias("level"), F.lit(-1).alias("range"), F.lit(b"").alias("answer"))
    return chunks.groupBy("grp").cogroup(answers.unionByName(every).groupBy("grp")).applyInArrow(task, schema)


def emit_with_answers(chunks: DataFrame, answers: DataFrame, emit: Callable[[pa.Table, Answers], dict[int, bytes]]) -> DataFrame:
    """Like `emit_from_chunks`, for chunks that know their answers."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        own = Answers(right)
        return _merged(left["grp"][0].as_py(), ((chunk, emit(table, own)) for chunk, table in _in_order(left)))

    return _told(chunks, answers, task, BLOCKS)


def with_answers(chunks: DataFrame, answers: DataFrame, work: Callable[[pa.Table, Answers], pa.RecordBatch], schema: str) -> DataFrame:
    """`work` of each chunk and the answers of its group."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        own = Answers(right)
        return pa.Table.from_batches([work(table, own) for _, table in _in_order(left)])

    return _told(chunks, answers, task, schema)


def answered(blocks: DataFrame, level: int, answer: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """Per range of keys: `answer` gets the chunks and their blocks, and returns each one's answer, so many bytes per key."""

    def task(group: pa.Table) -> pa.Table:
        if group["range"][0].as_py() < 0:  # states go back as they are
            return pa.table({"grp": group["grp"], "level": pa.array([level] * group.num_rows, pa.int32()), "range": group["range"], "answer": group["block"]}).combine_chunks()
        parts = [split_parts(b) for b in group["block"].to_pylist()]
        chunks = [int.from_bytes(p[:8], "little") for own in parts for p in own]
        told = iter(answer(chunks, [p[8:] for own in parts for p in own]))
        out = [b"".join([next(told) for _ in own]) for own in parts]
        return pa.table({"grp": group["grp"].combine_chunks(), "level": pa.array([level] * len(out), pa.int32()), "range": group["range"].combine_chunks(), "answer": pa.array(out, pa.binary())})

    return blocks.groupBy("range").applyInArrow(task, ANSWERS)


def in_several(chunks: list[int], blocks: list[bytes]) -> list[bytes]:
    """1 for each slot that another chunk has too."""
    keys = [unpack_sorted(b) for b in blocks]
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    s = flat[order]
    same = s[1:] == s[:-1]
    flag = np.zeros(len(flat), np.uint8)
    flag[order[1:][same]] = 1
    flag[order[:-1][same]] = 1
    ends = np.cumsum([len(k) for k in keys])
    return [flag[e - len(k) : e].tobytes() for e, k in zip(ends, keys, strict=True)]
