"""Operator 11, token ids in files of compressed planes.

A file holds the ids of whole documents in ascending order.  They are cut in
blocks of BLOCK_IDS ids; a block is transposed into planes (of single bits, or
of bytes), each plane is one zstandard frame, and a plane of zeros is no frame
at all.  The chunk index behind the frames has the ids of each block and the
length of each of its frames, so a range of ids is read by its blocks alone.

    magic | frames | chunk index | documents | footer

`documents` are the doc_ids and lengths, compressed; the footer says where the
parts lie, and has a checksum of index and documents.  Files are the rows of a
table (part, file, n_docs, n_ids, content), which Spark writes uncompressed, as
the planes are compressed already: any store that Spark writes will do.

Documents are tokenised where they are read, and only their ids are dealt into
ranges of doc_id.  How many ids come before a file is a sum over the narrow
table of the files.

Defined results: a null text is empty, and has the end id alone; rows of one doc_id
follow in the order of a hash of their ids, rows equal in both in any order; a null doc_id comes first; a
document is never cut, so a file is longer than FILE_IDS only if its one document is; an empty
table gives no files and no rows; other columns are ignored, also those whose names differ in case only.
A damaged or cut file raises ValueError.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, drop_written, in_order, new_path, only, parts_before, width, written
from .packing import WordIds, vocabulary_path
from .textkit import Words

MAGIC = b"PVPLANE1"
BLOCK_IDS = 1 << 15
#: Ids of a file, and bytes of ids that a task writes on average at most.
FILE_IDS, TASK_BYTES = 1 << 20, 128 << 20
END_ID = 1
BITS, BYTES = 1, 8
LEVEL = 3
FOOTER = struct.Struct("<QQQQIIIII8s")  # places of index and documents, documents, ids, blocks, ids of a block, bits of a plane, planes, checksum, magic


def split_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block, lowest first: as many as its largest id needs."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = -(-int(ids.max()).bit_length() // bits) if len(ids) else 0
    if bits == BYTES:
        return [ids.view(np.uint8)[k::4].tobytes() for k in range(n)]
    return [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1, bitorder="little").tobytes() for k in range(n)]


def join_planes(planes: list[bytes | None], n: int, bits: int) -> np.ndarray:
    """The ids of a block from its planes; None is a plane of zeros."""
    if bits == BYTES:
        raw = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            if p is not None:
                raw[:, k] = np.frombuffer(p, np.uint8)
        return raw.view("<u4").reshape(-1)
    out = np.zeros(n, np.uint32)
    for k, p in enumerate(planes):
        if p is not None:
            out |= np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little").astype(np.uint32) << np.uint32(k)
    return out


def encode_file(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, bits: int = BYTES, block_ids: int = BLOCK_IDS, level: int = LEVEL) -> bytes:
    """One file: `ids` of documents of these `lengths`, one after the other."""
    import zstandard

    press = zstandard.ZstdCompressor(level=level)
    blocks = [split_planes(ids[a : a + block_ids], bits) for a in range(0, len(ids), block_ids)]
    planes = max(map(len, blocks), default=0)
    frames = [[press.compress(p) if p.strip(b"\0") else b"" for p in [*own, *[b""] * (planes - len(own))]] for own in blocks]
    counts = np.array([min(block_ids, len(ids) - a) for a in range(0, len(ids), block_ids)], "<u4")
    index = counts.tobytes() + np.array([[len(f) for f in own] for own in frames], "<u4").tobytes()
    documents = press.compress(np.ascontiguousarray(doc_ids, "<i8").tobytes() + np.packbits(nulls).tobytes() + np.ascontiguousarray(lengths, "<u8").tobytes())
    body = MAGIC + b"".join(f for own in frames for f in own)
    tail = index + documents
    return body + tail + FOOTER.pack(len(body), len(body) + len(index), len(doc_ids), len(ids), len(blocks), block_ids, bits, planes, zlib.crc32(tail), MAGIC)


class TokenFile:
    """Reads a file's bytes; only the blocks of the ids asked for are decompressed."""

    def __init__(self, content: bytes) -> None:
        import zstandard

        self.data = memoryview(content)
        if len(content) < len(MAGIC) + FOOTER.size or content[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self.index_at, docs_at, self.n_docs, self.n_ids, n_blocks, self.block_ids, self.bits, planes, crc, magic = FOOTER.unpack(self.data[-FOOTER.size :])
        tail = self.data[self.index_at : len(content) - FOOTER.size]
        if magic != MAGIC or zlib.crc32(tail) != crc:
            raise ValueError("damaged token file")
        self.press = zstandard.ZstdDecompressor()
        self.counts = np.frombuffer(tail, "<u4", n_blocks)
        self.sizes = np.frombuffer(tail, "<u4", n_blocks * planes, 4 * n_blocks).reshape(n_blocks, planes)
        self.ends = np.cumsum(self.sizes, dtype=np.int64).reshape(n_blocks, planes) + len(MAGIC)
        if (self.ends[-1, -1] if self.ends.size else len(MAGIC)) != self.index_at or int(self.counts.sum()) != self.n_ids:
            raise ValueError("damaged token file")
        self.docs = self.data[docs_at : len(content) - FOOTER.size]

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_ids, which of them are null, and lengths."""
        raw, n = self.press.decompress(self.docs), self.n_docs
        mask = -(-n // 8)
        return np.frombuffer(raw, "<i8", n), np.unpackbits(np.frombuffer(raw, np.uint8, mask, 8 * n), count=n).astype(bool), np.frombuffer(raw, "<u8", n, 8 * n + mask).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        planes = []
        for size, end in zip(self.sizes[k].tolist(), self.ends[k].tolist(), strict=True):
            planes.append(self.press.decompress(self.data[end - size : end]) if size else None)
        return join_planes(planes, int(self.counts[k]), self.bits)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids at start:stop."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        return np.concatenate([self.block(k) for k in range(first, last + 1)])[start - first * self.block_ids : stop - first * self.block_ids]


def _ids_task(path: str, end_id: int):
    """A task over (doc_id, text): the ids of each text and the end id, as 16-bit numbers where all fit."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        kind = "<u2" if max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for b in batches(it, 2 << 20):
            w = Words(b.column(1))
            ids, count = words.of(w)
            n = np.concatenate([[0], np.cumsum(count)])[w.doc_start]
            flat = np.insert(ids.astype(kind), n[1:], end_id)
            ends = np.concatenate([[0], n[1:] + np.arange(1, len(b) + 1)])
            size = flat.dtype.itemsize
            blob = pa.Array.from_buffers(pa.large_binary(), len(b), [None, pa.py_buffer(np.ascontiguousarray(ends * size, "<i8")), pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends)), pa.array(np.full(len(b), size, np.int32)), blob.cast(pa.binary())], ["doc_id", "n", "size", "ids"])

    return task


def token_ids(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n, size (bytes of an id), ids (little-endian)."""
    return only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(_ids_task(path or vocabulary_path(), end_id), "doc_id long, n long, size int, ids binary")


FILES = "part long, file int, n_docs long, n_ids long, content binary"


def _files_task(file_ids: int, bits: int, block_ids: int):
    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, file = TaskContext.get().partitionId(), 0
        kept: list[tuple[pa.RecordBatch, int]] = []

        def flush() -> pa.RecordBatch:
            nonlocal file
            t = pa.Table.from_batches([b for b, _ in kept]).combine_chunks()
            blobs = [np.frombuffer(x, f"<u{size}").astype("<u4") for x, size in zip(t["ids"].to_pylist(), t["size"].to_pylist(), strict=True)]
            doc, ids = t["doc_id"].combine_chunks(), np.concatenate(blobs)
            content = encode_file(ids, doc.fill_null(0).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), t["n"].to_numpy(), bits, block_ids)
            kept.clear()
            file += 1
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([file - 1], pa.int32()), pa.array([len(doc)], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([content], pa.binary())], ["part", "file", "n_docs", "n_ids", "content"])

        held = 0
        for b in it:
            n, at = b.column(1).to_numpy(), 0
            while at < len(b):
                # as many documents as the file has room for, one at least
                room = int(np.searchsorted(np.cumsum(n[at:]), file_ids - held, "right"))
                if not room and held:
                    yield flush()
                    held = 0
                    continue
                take = max(room, 1)
                kept.append((b.slice(at, take), 0))
                held += int(n[at : at + take].sum())
                at += take
                if held >= file_ids:
                    yield flush()
                    held = 0
        if kept:
            yield flush()

    return task


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS, bits: int = BYTES, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all documents as files below `path`."""
    tokens = written(token_ids(docs, vocabulary, end_id), "tokens")
    total = tokens.agg(F.sum(F.col("n") * F.col("size"))).first()[0] or 0
    parts = max(width(docs.sparkSession), -(-total // TASK_BYTES))
    rows = in_order(tokens, [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")], "tokens", parts).select("doc_id", "n", "size", "ids")
    rows.mapInArrow(_files_task(file_ids, bits, block_ids), FILES).write.option("compression", "none").parquet(path)
    drop_written(tokens)


def _read_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for part, file, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            found = TokenFile(content.as_py())
            doc, null, n = found.documents()
            raw, ends = memoryview(found.ids().astype("<u4").tobytes()), np.cumsum(n)
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            cols = [pa.array(np.full(len(doc), part)), pa.array(np.full(len(doc), file, np.int32)), pa.array(doc, mask=null), pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["part", "file", "doc_id", "inside", "n_tokens", "ids_crc32"])


def file_starts(files: DataFrame) -> DataFrame:
    """(part, file, first): how many ids stand in the files before each."""
    from pyspark.sql.window import Window

    narrow = files.select("part", "file", "n_ids")
    before = parts_before(narrow.groupBy("part").agg(F.sum("n_ids").alias("total")))
    inside = narrow.select("part", "file", (F.sum("n_ids").over(Window.partitionBy("part").orderBy("file")) - F.col("n_ids")).alias("_inside"))
    return inside.join(before, "part").select("part", "file", (F.col("before") + F.col("_inside")).alias("first"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files below `path`: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.schema(FILES).parquet(path)
    rows = files.select("part", "file", "content").mapInArrow(_read_task, "part long, file int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(file_starts(files), ["part", "file"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def _range_task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        for first, lo, hi, content in zip(*[b.column(k).to_pylist() for k in range(4)], strict=True):
            ids = TokenFile(content).ids(lo, hi).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(first + lo, first + lo + len(ids))), pa.array(ids)], ["at", "id"])


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(at, id) of the ids at start:stop of all files, read by the blocks of the chunk indexes alone."""
    files = spark.read.schema(FILES).parquet(path)
    lo, hi = F.greatest(F.lit(0).cast("long"), F.lit(start) - F.col("first")).alias("lo"), F.least(F.col("n_ids"), F.lit(stop) - F.col("first")).alias("hi")
    touched = file_starts(files).join(files, ["part", "file"]).select("first", lo, hi, "content").where("lo < hi")
    return touched.mapInArrow(_range_task, "at long, id long")


def op11_token_planes(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_token_files(spark, path)
