"""Token ids in binary files: byte planes of fixed-size blocks, compressed with zstandard, with a chunk index.

Layout of a file, all integers little-endian::

    magic "TPLANE01"
    blocks: the ids of BLOCK tokens as 32-bit integers, transposed into four
            byte planes (all first bytes, all second bytes, ...), each plane a
            zstandard frame; a plane of zeros is left out
    document index: a zstandard frame of 64-bit triples (id, id is null, tokens)
    chunk index: per block the position, the ids in it and four plane lengths (64-bit)
    footer: positions of both indexes, their entries, tokens, magic (64-bit each)

Documents stand in ascending order of id, nulls first; equal ids are ordered by
their text's hash.  A range of ids is a file, so a hot id with many texts is many
files.  Files are written by tasks under names of their own, and a manifest
(Parquet) names the ones that count: what a lost or repeated attempt has left is
never read.

Cases: null and empty texts hold the end id only; very long texts span blocks
and are never held as one list; an empty table gives a manifest without files;
further columns are ignored.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tribuna.llm.common import one_row, text_of
from tribuna.llm.tokens import loaded, slices, vocabulary_path
from tribuna.session import work_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK = 1 << 18
MAGIC = b"TPLANE01"
FOOTER = struct.Struct("<5q8s")
#: Bytes of text that a file holds, about.
FILE_BYTES = 64 << 20
#: Files at most: beyond, files grow.
MAX_FILES = 100_000

MANIFEST = "no_id boolean, first_id long, first_hash long, path string, docs long, tokens long"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI that Spark was given."""
    return pafs.FileSystem.from_uri(path)


class PlaneWriter:
    """Writes ids block by block; holds one block and the lengths of the documents."""

    def __init__(self, sink, level: int = 3):
        import zstandard

        self.sink, self.at = sink, 0
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.held: list[bytes] = []
        self.n_held = 0
        self.chunks: list[tuple] = []
        self.docs: list[tuple[int, int, int]] = []
        self.tokens = 0
        self.put(MAGIC)

    def put(self, data: bytes) -> int:
        self.sink.write(data)
        self.at += len(data)
        return len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id or 0, int(doc_id is None), n))
        self.tokens += n
        self.held.append(ids)
        self.n_held += n
        while self.n_held >= BLOCK:
            data = b"".join(self.held)
            self.block(data[: 4 * BLOCK])
            self.held = [data[4 * BLOCK :]]
            self.n_held -= BLOCK

    def block(self, data: bytes) -> None:
        planes = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(-1, 4).T)
        start = self.at
        sizes = [self.put(self.zstd.compress(p.tobytes())) if p.any() else 0 for p in planes]
        self.chunks.append((start, len(data) // 4, *sizes))

    def close(self) -> None:
        if self.n_held:
            self.block(b"".join(self.held))
        docs_at = self.at
        self.put(self.zstd.compress(np.array(self.docs, dtype="<i8").tobytes()))
        chunks_at = self.at
        self.put(np.array(self.chunks, dtype="<i8").reshape(-1, 6).tobytes())
        self.put(FOOTER.pack(docs_at, chunks_at, len(self.docs), len(self.chunks), self.tokens, MAGIC))


class PlaneReader:
    """Reads a file by its indexes; one block is held at a time."""

    def __init__(self, source):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        size = source.size()
        *numbers, magic = FOOTER.unpack(self.read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file, or one that was not finished")
        docs_at, chunks_at, n_docs, n_chunks, self.tokens = numbers
        self.chunks = np.frombuffer(self.read(chunks_at, 48 * n_chunks), dtype="<i8").reshape(-1, 6)
        docs = self.zstd.decompress(self.read(docs_at, chunks_at - docs_at), max_output_size=24 * n_docs)
        self.docs = np.frombuffer(docs, dtype="<i8").reshape(-1, 3)

    def read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def block(self, k: int) -> bytes:
        at, n, *sizes = self.chunks[k].tolist()
        planes = np.zeros((4, n), dtype=np.uint8)
        for i, size in enumerate(sizes):
            if size:
                planes[i] = np.frombuffer(self.zstd.decompress(self.read(at, size), max_output_size=n), dtype=np.uint8)
                at += size
        return planes.T.tobytes()

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[bytes]]]:
        """Id, first place and the ids, in parts, of each document; the parts must be used up in order."""
        state = {"block": 0, "data": b"", "at": 0}

        def parts(left: int) -> Iterator[bytes]:
            while left:
                if state["at"] == len(state["data"]):
                    state.update(block=state["block"] + 1, data=self.block(state["block"]), at=0)
                part = state["data"][state["at"] : state["at"] + left]
                state["at"] += len(part)
                left -= len(part)
                yield part

        start = 0
        for doc_id, no_id, n in self.docs.tolist():
            yield None if no_id else doc_id, start, parts(4 * n)
            start += n


def write_partition(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """Encodes the sorted documents of one range into one file, and tells of it."""
    pieces = loaded(vocabulary, False)
    end = np.array([end_id], dtype="<u4").tobytes()
    fs, base = open_fs(folder)
    writer = sink = None
    first: tuple = ()
    path = f"{base}/{uuid.uuid4().hex}.tok"
    for batch in batches:
        for rows in slices(batch, "text"):
            offsets, data = pieces.encode(rows.column("text"))
            ends = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1][offsets]
            raw = memoryview(data.buffers()[2]) if data.buffers()[2] is not None else memoryview(b"")
            keys = zip(rows.column("no_id").to_pylist(), rows.column("id").to_pylist(), rows.column("h").to_pylist())
            for (no_id, doc_id, h), a, b in zip(keys, ends[:-1].tolist(), ends[1:].tolist()):
                if writer is None:
                    first = (no_id, doc_id, h)
                    fs.create_dir(base, recursive=True)
                    sink = fs.open_output_stream(path)
                    writer = PlaneWriter(sink)
                writer.add(None if no_id else doc_id, bytes(raw[a:b]) + end)
    if writer is not None:
        writer.close()
        sink.close()
        row = [[first[0]], [first[1]], [first[2]], [path], [len(writer.docs)], [writer.tokens]]
        types = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """Writes the ids of all documents below ``folder`` and returns the manifest, with ``file_start`` per file.

    The texts move once, into ranges of ids; encoding, sorting and writing of a
    range are one task.
    """
    path = vocabulary or vocabulary_path(VOCABULARY)
    slim = docs.select(
        F.col(doc_id).isNull().alias("no_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("h"), text_of(text).alias("text"),
    )
    size = one_row(slim.agg(F.sum(F.octet_length("text").cast("long"))))[0] or 0
    order = [F.col("no_id").desc(), F.col("id"), F.col("h")]
    ranged = slim.repartitionByRange(min(MAX_FILES, max(1, math.ceil(size / file_bytes))), *order).sortWithinPartitions(*order)
    target = f"{folder.rstrip('/')}/ids"
    written = ranged.mapInArrow(lambda it: write_partition(it, target, path, end_id), MANIFEST)
    written.write.mode("overwrite").parquet(f"{folder}/manifest")
    manifest = docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy(F.col("no_id").desc(), "first_id", "first_hash").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("file_start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, _ = open_fs(folder)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for path, base in zip(batch.column("path").to_pylist(), batch.column("file_start").to_pylist()):
            with fs.open_input_file(path) as source:
                rows: list[tuple] = []
                for doc_id, start, parts in PlaneReader(source).documents():
                    n, crc = 0, 0
                    for part in parts:
                        n += len(part) // 4
                        crc = zlib.crc32(part, crc)
                    rows.append((doc_id, base + start, n, crc))
                    if len(rows) == 65_536:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: its first place among all ids, its ids, and their checksum."""
    n = max(1, one_row(manifest.agg(F.count(F.lit(1))))[0])
    spread = manifest.select("path", "file_start").repartition(n, "path")
    return spread.mapInArrow(lambda it: read_files(it, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, **how) -> DataFrame:
    """Writes the table's ids to a new folder of the shared work folder and reads them back."""
    folder = work_path(docs.sparkSession, "ids")
    return read_tokens(write_tokens(docs, folder, **how), folder)
