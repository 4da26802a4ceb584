"""Token ids in fixed-width bit-packed files with random access.

A file holds a header, blocks, a footer and a trailer. Each block packs up to
``block_ids`` ids in the minimum bits of the vocabulary. The footer has the
offset of every block and, for every document, its id and first position, so a
reader fetches any run of ids from the blocks that hold it.

Rows: documents with equal ids are ordered by a hash of their text; a NULL id
comes first and stays NULL; a NULL text is empty and holds the end id alone. An
empty table gives no file and no rows. Columns besides the named two are
ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plateia.llm.common import new_folder, only, written
from plateia.llm.tokens import encoder

MAGIC = b"PLATIDS1"
HEADER = struct.Struct("<8sII")  # magic, bits, ids in a block
TRAILER = struct.Struct("<QQQQ8s")  # footer offset, ids, blocks, documents, magic
MANIFEST = "shard BIGINT, path STRING, ids BIGINT, documents BIGINT, bytes BIGINT"
BLOCKS_AT_ONCE = 32


def bits_for(vocabulary: int) -> int:
    """The least width that holds the ids 0 to vocabulary - 1."""
    if not 0 < vocabulary <= 1 << 32:
        raise ValueError("a vocabulary has 1 to 2^32 ids")
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, low bits first; eight ids fill ``bits`` whole bytes."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    padded = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    padded[: len(ids)] = ids
    groups = padded.reshape(-1, 8)
    out = np.empty((len(groups), bits), np.uint8)
    for byte in range(bits):
        value = np.zeros(len(groups), np.uint64)
        for place in range(8 * byte // bits, min(7, (8 * byte + 7) // bits) + 1):
            shift = place * bits - 8 * byte
            part = groups[:, place]
            value |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
        out[:, byte] = value & np.uint64(255)
    return out.tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    groups = np.frombuffer(data, np.uint8).reshape(-1, bits).astype(np.uint64)
    out = np.empty((len(groups), 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for place in range(8):
        value = np.zeros(len(groups), np.uint64)
        for byte in range(place * bits // 8, (place * bits + bits - 1) // 8 + 1):
            shift = 8 * byte - place * bits
            part = groups[:, byte]
            value |= part << np.uint64(shift) if shift >= 0 else part >> np.uint64(-shift)
        out[:, place] = value & mask
    return out.ravel()[:count]


class ShardWriter:
    """Streams the ids of documents into one file."""

    def __init__(self, path: str, bits: int, block_ids: int):
        if block_ids % 8:
            raise ValueError("blocks hold a multiple of 8 ids")
        self.path, self.bits, self.block_ids = path, bits, block_ids
        store, place = fs.FileSystem.from_uri(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(place, compression=None)
        self.out.write(HEADER.pack(MAGIC, bits, block_ids))
        self.waiting, self.ids = bytearray(), 0
        self.offsets: list[int] = []
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids) // 4
        self.waiting += ids
        if len(self.waiting) >= 4 * self.block_ids * BLOCKS_AT_ONCE:
            self._flush(len(self.waiting) // (4 * self.block_ids))

    def _flush(self, blocks: int) -> None:
        taken = bytes(self.waiting[: 4 * blocks * self.block_ids])
        del self.waiting[: len(taken)]
        ids = np.frombuffer(taken, "<u4")
        for at in range(0, len(ids), self.block_ids):
            self.offsets.append(self.out.tell())
            self.out.write(pack(ids[at : at + self.block_ids], self.bits))

    def close(self) -> int:
        self._flush(-(-len(self.waiting) // (4 * self.block_ids)))
        footer = self.out.tell()
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        known = np.array([d is not None for d in self.doc_ids], np.uint8)
        self.out.write(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(known.tobytes())
        self.out.write(
            TRAILER.pack(footer, self.ids, len(self.offsets), len(self.doc_ids), MAGIC)
        )
        size = self.out.tell()
        self.out.close()
        return size


class ShardReader:
    """Random access to one file: header, footer and block offsets are read on opening."""

    def __init__(self, path: str):
        store, place = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(place)
        magic, self.bits, self.block_ids = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        end = self.file.size() - TRAILER.size
        footer, self.ids, blocks, documents, last = TRAILER.unpack(
            self.file.read_at(TRAILER.size, end)
        )
        if magic != MAGIC or last != MAGIC:
            raise ValueError(f"{path} is not a whole token file")
        data = self.file.read_at(end - footer, footer)
        self.offsets = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(footer))
        self.doc_ids = np.frombuffer(data, "<i8", documents, 8 * blocks)
        self.starts = np.frombuffer(data, "<u8", documents, 8 * (blocks + documents)).astype(np.int64)
        self.known = np.frombuffer(data, np.uint8, documents, 8 * (blocks + 2 * documents))

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids at positions start to stop, from the blocks that hold them alone."""
        stop = min(stop, self.ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        begin, end = int(self.offsets[first]), int(self.offsets[last + 1])
        data = self.file.read_at(end - begin, begin)
        here = first * self.block_ids
        count = min(self.ids, (last + 1) * self.block_ids) - here
        return unpack(data, self.bits, count)[start - here : stop - here]

    def documents(self) -> Iterator[tuple[int | None, int, list[np.ndarray]]]:
        """Each document's id, start and ids, the latter in runs of bounded length."""
        step = self.block_ids * BLOCKS_AT_ONCE
        at, ids = 0, np.empty(0, np.uint32)
        ends = np.append(self.starts[1:], self.ids)
        for doc_id, known, start, end in zip(
            self.doc_ids.tolist(), self.known.tolist(), self.starts.tolist(), ends.tolist()
        ):
            runs, place = [], start
            while place < end:
                if place >= at + len(ids):
                    at = place // step * step
                    ids = self.read(at, at + step)
                runs.append(ids[place - at : end - at])
                place += len(runs[-1])
            yield doc_id if known else None, start, runs

    def close(self) -> None:
        self.file.close()


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, block_ids: int = 4096
) -> DataFrame:
    """Encode every text, append ``end_id`` and write shards in ascending doc_id order.

    One range partition is one shard. A repeated task writes a file of another
    name, and the manifest, written by Spark, lists the files of the attempts
    that count. Returns the manifest.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, kept_chunks=1 << 18)
        bits = bits_for(max(encode.tokenizer.get_vocab_size(), end_id + 1))
        end = struct.pack("<I", end_id)
        shard, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                if writer is None:
                    name = f"{folder}/shard-{shard:06d}-{uuid4().hex}.ids"
                    writer = ShardWriter(name, bits, block_ids)
                writer.add(doc_id, encode.encode(text.as_py() or "") + end)
        if writer is not None:
            row = (shard, writer.path, writer.ids, len(writer.doc_ids), writer.close())
            yield pa.RecordBatch.from_arrays(
                [pa.array([value]) for value in row], ["shard", "path", "ids", "documents", "bytes"]
            )

    rows = only(docs, doc_id=F.col("doc_id").cast("bigint"), text="text")
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return written(ordered.mapInArrow(shards, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32, and its shard.

    The running start of the shards is a window over one row per shard.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, rows = ShardReader(row["path"]), []
                for doc_id, start, runs in reader.documents():
                    crc = 0
                    for run in runs:
                        crc = zlib.crc32(np.ascontiguousarray(run, "<u4"), crc)
                    rows.append((doc_id, row["start"] + start, sum(map(len, runs)), crc, row["shard"]))
                reader.close()
                for at in range(0, len(rows), 10_000):
                    columns = zip(*rows[at : at + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "shard"],
                    )

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("bigint")))
    return placed.repartition(max(1, manifest.count()), "shard").mapInArrow(
        documents, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT, shard BIGINT"
    )


def token_files(
    spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, block_ids: int = 4096
) -> DataFrame:
    """Write token files to the shared folder and read every document back."""
    folder = new_folder(spark, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, end_id, folder, block_ids))
