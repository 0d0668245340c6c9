"""Token ids in files of bit or byte planes.

A shard file holds blocks of a fixed number of ids. A block is transposed into planes, the first
bytes (or bits) of all ids, then the second ones, and so on; each plane is compressed with
zstandard. A chunk index at the end has each block's place and the lengths of its planes, a document index
has each document's id and number of tokens. All numbers are little-endian.

    magic | planes of block 0 | planes of block 1 | ... | chunk index | document index | tail

Documents are written in ascending doc_id order, nulls first, equal ids by text. Shards are ranges
of that order; the manifest, a table with a row per shard, names the files that count: a task that
runs twice writes two files and one of them is named. Null texts count as empty and hold the end id alone. An empty table gives no
rows. The shared folder must be one that pyarrow can open (local, HDFS, object stores).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourwatt.llm.bpe import encode_texts, vocabulary_path
from hourwatt.llm.common import handed_over, split_even
from hourwatt.session import new_folder

MAGIC, BLOCK, END_ID, LEVEL = b"HWPLANE1", 65_536, 1, 3
TAIL = "<QQQQIB8s"  # index place, index bytes, documents place, bytes, block, planes, magic
NO_ID = b"-"


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The planes of a block, lowest byte or bit first."""
    columns = ids.astype("<u4").view(np.uint8).reshape(len(ids), 4)
    if not bits:
        return [np.ascontiguousarray(columns[:, k]).tobytes() for k in range(4)]
    single = np.unpackbits(columns, axis=1, bitorder="little")
    return [np.packbits(single[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        columns = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        single = [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes]
        columns = np.packbits(np.stack(single, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(columns).view("<u4").reshape(n)


class ShardWriter:
    """Appends documents to one file; holds one block of ids at a time."""

    def __init__(self, stream, block: int = BLOCK, bits: bool = False):
        self.stream, self.block, self.bits = stream, block, bits
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.place = 0
        self.index: list[tuple[int, ...]] = []
        self.documents: list[tuple[bytes, int]] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.place += len(data)

    def add(self, doc_id: str | None, ids: np.ndarray | list[int]) -> None:
        self.documents.append((NO_ID if doc_id is None else str(doc_id).encode(), len(ids)))
        self.waiting.append(np.asarray(ids, dtype=np.uint32))
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= self.block or (last and at < len(ids)):
            part = ids[at : at + self.block]
            planes = [self.pack.compress(p) for p in to_planes(part, self.bits)]
            self.index.append((self.place, len(part), *map(len, planes)))
            self._put(b"".join(planes))
            at += len(part)
        self.waiting, self.n_waiting = [ids[at:]], len(ids) - at

    def close(self) -> None:
        self._flush(True)
        planes = 32 if self.bits else 4
        index = self.pack.compress(np.array(self.index, dtype="<u8").tobytes())
        docs = self.pack.compress(b"\n".join(b"%s %d" % d for d in self.documents))
        spot = self.place
        self._put(index)
        self._put(docs)
        self._put(struct.pack(TAIL, spot, len(index), spot + len(index), len(docs), self.block, planes, MAGIC))


@dataclass
class ShardReader:
    """Random access to a shard by the chunk index."""

    stream: object
    size: int

    def __post_init__(self) -> None:
        self.unpack = zstandard.ZstdDecompressor()
        a, an, d, dn, self.block, planes, magic = struct.unpack(
            TAIL, self._at(self.size - struct.calcsize(TAIL), struct.calcsize(TAIL))
        )
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        index = np.frombuffer(self._plain(a, an), "<u8").reshape(-1, 2 + planes)
        self.index = index.astype(np.int64)
        lines = self._plain(d, dn).split(b"\n") if dn else []
        pairs = [line.split(b" ") for line in lines if line]
        self.documents = [(None if k == NO_ID else k.decode(), int(n)) for k, n in pairs]

    def _at(self, place: int, n: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(n)

    def _plain(self, place: int, n: int) -> bytes:
        return self.unpack.decompressobj().decompress(self._at(place, n))

    def ids_of_block(self, k: int) -> np.ndarray:
        place, n, *lengths = self.index[k].tolist()
        data, planes, at = self._at(place, sum(lengths)), [], 0
        for length in lengths:
            planes.append(self.unpack.decompressobj().decompress(data[at : at + length]))
            at += length
        return from_planes(planes, n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only their blocks are read."""
        first, last = start // self.block, max(start, stop - 1) // self.block
        if start >= stop:
            return np.zeros(0, np.uint32)
        found = np.concatenate([self.ids_of_block(k) for k in range(first, last + 1)])
        return found[start - first * self.block : stop - first * self.block]

    def each(self) -> Iterator[tuple[str | None, Iterator[np.ndarray]]]:
        """Documents in order, each as the pieces of the blocks that hold it."""
        left, k = np.zeros(0, np.uint32), 0
        for doc_id, n in self.documents:
            pieces = []
            while n:
                if not len(left):
                    left, k = self.ids_of_block(k), k + 1
                pieces.append(left[:n])
                left, n = left[n:], n - len(pieces[-1])
            yield doc_id, pieces


def opened(uri: str):
    system, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return system, path


def write_shards(docs: DataFrame, folder: str, text: str = "text", path: str | None = None, block: int = BLOCK, bits: bool = False, end_id: int = END_ID) -> DataFrame:
    """Write the ids of all texts below ``folder``; the manifest: shard, uri, n_docs, n_tokens, start."""
    path = path or vocabulary_path()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        writer, stream = None, None
        uri = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.ids"
        system, place = opened(uri)
        for big in batches:
            for at in range(0, len(big), 1024):
                batch = big.iloc[at : at + 1024]
                if writer is None:
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    stream = system.open_output_stream(place)
                    writer = ShardWriter(stream, block, bits)
                for doc_id, ids in zip(batch.doc_id, encode_texts(path, batch.text.tolist())):
                    writer.add(doc_id, np.append(ids, np.uint32(end_id)))
        if writer is not None:
            writer.close()
            stream.close()
            yield pd.DataFrame(
                {"shard": [shard], "uri": [uri], "n_docs": [len(writer.documents)], "n_tokens": [writer.n_ids]}
            )

    key = docs["doc_id"].cast("long")
    rows = docs.select(key.alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.asc_nulls_first("doc_id"), F.col("tie"))
    rows = rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", "text")
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    shards = handed_over(rows.mapInPandas(write, "shard long, uri string, n_docs long, n_tokens long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, start in zip(batch.uri, batch.start):
                system, place = opened(uri)
                with system.open_input_file(place) as stream:
                    rows, at = [], int(start)
                    for doc_id, pieces in ShardReader(stream, stream.size()).each():
                        crc = n = 0
                        for piece in pieces:
                            crc, n = zlib.crc32(piece.astype("<u4").tobytes(), crc), n + len(piece)
                        rows.append((doc_id, at, n, crc))
                        at += n
                        if len(rows) == 50_000:
                            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = split_even(manifest.select("uri", "start"), "uri")
    out = spread.mapInPandas(read, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def written_and_read(docs: DataFrame, text: str = "text", **settings) -> DataFrame:
    """Write the token files to the shared folder and describe every document from them."""
    folder = new_folder(docs.sparkSession, "token-ids")
    return read_shards(write_shards(docs, folder, text, **settings))
