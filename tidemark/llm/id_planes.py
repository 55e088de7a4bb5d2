"""Token-id files with bit-plane shuffling.

A shard file holds the ids of consecutive documents:

    magic, version line | planes of block 0 | planes of block 1 | ... | footer | footer offset, magic

A block is a fixed number of ids (the last may be shorter). Its ids are transposed into byte
planes (all lowest bytes, then all second bytes, ...) or bit planes, only as many as its largest
id needs, and each plane is compressed by itself with zstandard. The footer has the chunk index
(for each block: file position, number of ids, compressed size of each plane) and the documents'
ids and lengths, so any block or document can be read without the others.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import buckets, columns_of, shared_folder, written
from .encode import encoder, text_slices

MAGIC = b"IDPLANE1"
SHARDS = "shard long, file string, n_docs long, n_ids long, n_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long, shard long"
#: Ids after which a file is closed and another begun.
FILE_IDS = 4_000_000
#: Documents that a reader hands on at once.
ROWS = 20_000


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The ids' byte (or bit) planes from the lowest up; none if all ids are 0."""
    ids = ids.astype("<u4")
    top = int(ids.max()) if len(ids) else 0
    if bits:
        table = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        return [np.packbits(table[:, k]).tobytes() for k in range(top.bit_length())]
    return [ids.view(np.uint8)[k::4].tobytes() for k in range((top.bit_length() + 7) // 8)]


def from_planes(planes: list[bytes], n: int, bits: bool = False) -> np.ndarray:
    if bits:
        table = np.zeros((n, 32), np.uint8)
        for k, plane in enumerate(planes):
            table[:, k] = np.unpackbits(np.frombuffer(plane, np.uint8), count=n)
        return np.packbits(table, axis=1, bitorder="little").view("<u4").ravel()
    out = np.zeros(4 * n, np.uint8)
    for k, plane in enumerate(planes):
        out[k::4] = np.frombuffer(plane, np.uint8)
    return out.view("<u4")


class ShardWriter:
    """Writes one shard to a binary stream; holds less than a block of ids beside document lengths."""

    def __init__(self, stream, block: int = 65_536, bits: bool = False, level: int = 3):
        import zstandard

        self.stream, self.block, self.bits = stream, block, bits
        self.zip = zstandard.ZstdCompressor(level=level).compress
        self.at, self.rest, self.n_ids = stream.write(MAGIC), np.zeros(0, np.uint32), 0
        self.index: list[list] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, docs: list, lengths: list[int], ids: np.ndarray) -> None:
        self.docs += docs
        self.lengths += lengths
        self.n_ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // self.block * self.block
        for k in range(0, whole, self.block):
            self._block(ids[k : k + self.block])
        self.rest = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        sizes, begin = [], self.at
        for plane in to_planes(ids, self.bits):
            sizes.append(len(data := self.zip(plane)))
            self.at += self.stream.write(data)
        self.index.append([begin, len(ids), sizes])

    def close(self) -> int:
        if len(self.rest):
            self._block(self.rest)
        none = [k for k, d in enumerate(self.docs) if d is None]
        head = json.dumps({"bits": self.bits, "index": self.index, "n_docs": len(self.docs), "none": none}).encode()
        tables = np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array(self.lengths, "<i8").tobytes()
        footer = self.zip(struct.pack("<Q", len(head)) + head + tables)
        self.stream.write(footer + struct.pack("<Q", self.at) + MAGIC)
        return self.at + len(footer) + 16


class ShardReader:
    """Reads a shard from a seekable binary stream."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.unzip = stream, zstandard.ZstdDecompressor().decompress
        size = stream.seek(0, io.SEEK_END) or stream.tell()
        at, end = struct.unpack("<Q8s", self._read(size - 16, 16))
        if end != MAGIC or self._read(0, 8) != MAGIC:
            raise ValueError("not a token-id file, or cut off")
        footer = self.unzip(self._read(at, size - 16 - at))
        n = struct.unpack("<Q", footer[:8])[0]
        head = json.loads(footer[8 : 8 + n])
        self.bits, self.index = head["bits"], head["index"]
        tables = np.frombuffer(footer[8 + n :], "<i8").reshape(2, -1)
        none = set(head["none"])
        self.docs = [None if k in none else d for k, d in enumerate(tables[0].tolist())]
        self.lengths = tables[1]

    def _read(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(n)

    def block(self, k: int) -> np.ndarray:
        at, n, sizes = self.index[k]
        data, planes, used = self._read(at, sum(sizes)), [], 0
        for size in sizes:
            planes.append(self.unzip(data[used : used + size]))
            used += size
        return from_planes(planes, n, self.bits)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents in order with their ids; holds one document and one block."""
        k, have = 0, np.zeros(0, np.uint32)
        for doc, n in zip(self.docs, self.lengths.tolist()):
            parts, missing = [have[:n]], n - len(have)
            have = have[n:]
            while missing > 0:
                have = self.block(k)
                k += 1
                parts.append(have[:missing])
                have, missing = have[missing:], missing - len(parts[-1])
            yield doc, np.concatenate(parts)


def _open(path: str, write: bool = False):
    """A stream of any store that Arrow knows (file, hdfs, s3, gs, ...)."""
    from pyarrow.fs import FileSystem

    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path[5:]}"  # the way Hadoop writes local paths
    fs, inner = FileSystem.from_uri(path)
    return fs.open_output_stream(inner) if write else fs.open_input_file(inner)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, block: int = 65_536,
              bits: bool = False, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode whole texts and write their ids in ascending doc_id order; a row for each shard file.

    Rows are range-partitioned by doc_id (null first; equal ids by the text's hash) and each
    partition writes its files one after the other: a file that has ``file_ids`` ids is closed, so
    files and what their writer and reader hold do not grow with the input or with a partition.
    A task that runs again writes files with other names, and only the files of tasks that ended
    well are in the returned list, which is itself stored. Null texts count as empty, empty texts
    give the end id alone, repeated rows are written as often. An empty table gives no shard.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = columns_of(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.repartitionByRange(buckets(docs.sparkSession), *order[:2]).sortWithinPartitions(*order)

    def write(batches):
        from pyspark import TaskContext

        coder, shard, writer = encoder(tokenizer), TaskContext.get().partitionId() << 32, None

        def ended():
            size = writer.close()
            writer.stream.close()
            return pa.RecordBatch.from_pydict({
                "shard": [shard], "file": [name], "n_docs": [len(writer.docs)], "n_ids": [writer.n_ids], "n_bytes": [size]})

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for a, b, texts in text_slices(batch.column(1)):
                if writer is None:
                    name = f"{path}/{shard:015d}-{uuid.uuid4().hex}.ids"
                    writer = ShardWriter(_open(name, write=True), block, bits)
                got, lengths = coder.encode(texts)
                got = np.insert(got.astype(np.uint32), np.cumsum(lengths), end_id)
                writer.add(ids[a:b], (lengths + 1).tolist(), got)
                if writer.n_ids >= file_ids:
                    yield ended()
                    writer, shard = None, shard + 1
        if writer is not None:
            yield ended()

    return written(rows.mapInArrow(write, SHARDS), "shards")


def read_ids(shards: DataFrame) -> DataFrame:
    """A row for each document of the shards: position among all ids, number and crc32 of its ids.

    Only the shards' totals, one row for each file, meet in one place to add up positions.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("shard", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    placed = placed.repartition(buckets(shards.sparkSession))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at, found = row["base"], []
                with _open(row["file"]) as stream:
                    for doc, ids in ShardReader(stream).documents():
                        found.append((doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), row["shard"]))
                        at += len(ids)
                        if len(found) == ROWS:
                            yield rows(found)
                            found = []
                if found:
                    yield rows(found)

    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    return placed.mapInArrow(read, DOCUMENTS)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the ids of all documents to new files in the shared folder and read them back."""
    return read_ids(write_ids(docs, shared_folder(docs.sparkSession), tokenizer, end_id))
