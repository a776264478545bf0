"""Token ids in binary files: blocks of ids, transposed into byte or bit planes, each compressed with zstandard."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nightshare.llm.common import saved, shared_dir, store
from nightshare.llm.tokens import WORD_BPE, encoder, tokenizer_path

MAGIC, BLOCK, END, LEVEL = b"IDPLANE1", 1 << 16, 2, 3


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of little-endian 32-bit ids."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        return [np.packbits(p, bitorder="little").tobytes() for p in np.unpackbits(rows, axis=1, bitorder="little").T]
    return [np.ascontiguousarray(p).tobytes() for p in rows.T]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if bits:
        rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little", count=n) for p in planes], axis=1)
        return np.packbits(rows, axis=1, bitorder="little").reshape(-1).view("<u4")
    return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")


class Writer:
    """One file: chunks of planes, sections of document ids and lengths, at the end the index of both."""

    def __init__(self, out, block: int = BLOCK, bits: bool = False, level: int = LEVEL):
        self.out, self.block, self.bits = out, block, bits
        self.zip = zstandard.ZstdCompressor(level=level)
        self.chunks, self.sections, self.pos = [], [], 0
        self.held, self.n_held, self.ids, self.sizes = [], 0, [], []
        self.tokens = self.docs = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.pos += len(data)
        return len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.sizes.append(len(ids))
        self.docs, self.tokens = self.docs + 1, self.tokens + len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block:
            self._flush(self.n_held - self.n_held % self.block)
        if len(self.ids) >= self.block:
            self._section()

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held)
        for i in range(0, n, self.block):
            part, at = ids[i : min(n, i + self.block)], self.pos
            self.chunks.append([at, len(part), [self._put(self.zip.compress(p)) for p in to_planes(part, self.bits)]])
        self.held, self.n_held = [ids[n:].copy()], len(ids) - n

    def _section(self) -> None:
        known = np.array([i is not None for i in self.ids], np.uint8)
        data = known.tobytes() + np.array([i or 0 for i in self.ids], "<i8").tobytes() + np.array(self.sizes, "<i8").tobytes()
        at = self.pos
        self.sections.append([at, self._put(self.zip.compress(data)), len(self.ids)])
        self.ids, self.sizes = [], []

    def close(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        if self.ids:
            self._section()
        index = self.zip.compress(json.dumps({"bits": self.bits, "chunks": self.chunks, "sections": self.sections}).encode())
        self._put(index + struct.pack("<Q", len(index)) + MAGIC)
        self.out.close()


class Reader:
    """Reads the index first, then any range of ids by its chunks."""

    def __init__(self, file):
        self.file, self.zip = file, zstandard.ZstdDecompressor()
        size = file.size()
        tail = self._get(size - 16, 16)
        if tail[8:] != MAGIC or self._get(0, 8) != MAGIC:
            raise ValueError("not a file of id planes")
        n = struct.unpack("<Q", tail[:8])[0]
        index = json.loads(self.zip.decompress(self._get(size - 16 - n, n)))
        self.bits, self.chunks, self.sections = index["bits"], index["chunks"], index["sections"]

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def chunk(self, c: int) -> np.ndarray:
        at, n, sizes = self.chunks[c]
        data, planes, lo = self._get(at, sum(sizes)), [], 0
        for s in sizes:
            planes.append(self.zip.decompress(data[lo : lo + s]))
            lo += s
        return from_planes(planes, n, self.bits)

    def ids(self) -> Iterator[np.ndarray]:
        return map(self.chunk, range(len(self.chunks)))

    def directory(self) -> Iterator[tuple[int | None, int]]:
        for at, size, n in self.sections:
            data = self.zip.decompress(self._get(at, size))
            known, ids, sizes = np.frombuffer(data, np.uint8, n), np.frombuffer(data, "<i8", n, n), np.frombuffer(data, "<i8", n, 9 * n)
            yield from ((i if k else None, s) for k, i, s in zip(known.tolist(), ids.tolist(), sizes.tolist(), strict=True))

    def digests(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, start in the file, length, CRC-32 of the ids) of each document, one chunk in memory at a time."""
        chunks, held, start = self.ids(), np.zeros(0, "<u4"), 0
        for doc_id, size in self.directory():
            crc, left = 0, size
            while left:
                if not len(held):
                    held = next(chunks)
                part, held = held[:left], held[left:]
                crc, left = zlib.crc32(part.tobytes(), crc), left - len(part)
            yield doc_id, start, size, crc
            start += size


def write_ids(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, block: int = BLOCK, bits: bool = False, end: int = END) -> DataFrame:
    """Write all texts' ids in ascending id order below ``root``; returns the manifest (shard, file, docs, tokens).

    Rows are dealt by ranges of the id and sorted; each task writes one file under a name of its
    own attempt, and only files named in the manifest count, so lost or doubled tasks do no harm.
    """
    path = path or tokenizer_path(WORD_BPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        fs.create_dir(base, recursive=True)
        shard, writer, name = TaskContext.get().partitionId(), None, ""
        encode = encoder(path).encode_all
        for batch in batches:
            for doc_id, found in zip(batch.column(0), encode(batch.column(1)), strict=True):
                if writer is None:
                    name = f"ids-{shard:06d}-{uuid.uuid4().hex}.planes"
                    writer = Writer(fs.open_output_stream(f"{base}/{name}", compression=None), block, bits)
                writer.add(doc_id.as_py(), np.append(found, np.uint32(end)))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (shard, name, writer.docs, writer.tokens)], names=["shard", "file", "docs", "tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return saved(ordered.mapInArrow(run, "shard bigint, file string, docs bigint, tokens bigint"), "manifest")


def read_digests(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    # One row per shard: a table as long as the number of files.
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = saved(manifest.withColumn("base", F.coalesce(before, F.lit(0))).select("shard", "file", "base"), "offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = store(root)
        for batch in batches:
            for name, first in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                with fs.open_input_file(f"{base}/{name}") as file:
                    rows = []
                    for row in Reader(file).digests():
                        rows.append(row)
                        if len(rows) == 8192:
                            yield made(rows, first)
                            rows = []
                    if rows:
                        yield made(rows, first)

    def made(rows: list, first: int) -> pa.RecordBatch:
        ids, start, size, crc = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (ids, [first + s for s in start], size, crc)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(max(1, files.count())).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def id_files_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, block: int = BLOCK, bits: bool = False) -> DataFrame:
    """Write the id files of a table and read them back.

    Null and empty texts are the end id alone; null ids come first; rows of one id are ordered by
    text; a text of any length passes through in blocks of ``block`` ids; other columns are ignored;
    an empty table writes no file and gives no row.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "id-planes")
    return read_digests(spark, write_ids(docs, root, id_col, text_col, path, block, bits), root)
