"""WARC archives with a shared Zstandard dictionary, one frame per record.

An archive starts with a skippable frame that holds the dictionary, itself
compressed; a warcinfo record and the page records follow, each a frame of its
own that is read without its neighbours. The dictionary is trained on slices of a
bounded, documented number of payloads (``sample_rows``, ``sample_bytes``); with
too little to train on, their plain bytes serve as its content, and without any
the frame is left out.

Of records with equal payloads of at least ``least_bytes``, the one with the
largest page_id is a response and the others are revisits of it.

Rows: a NULL html is an empty payload; a NULL url is written as an empty one; a
row without a page_id is a response that nothing refers to. Repeated rows of the
largest page_id are all responses. An empty table gives no archive and no rows.
Columns besides the named three are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateia.llm.common import new_folder, only, written

DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path STRING, records BIGINT, bytes BIGINT"
READ_BYTES = 1 << 15


def decide_records(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to of every page."""
    rows = only(
        pages,
        page_id=F.col("page_id").cast("bigint"),
        url="url",
        payload=F.coalesce("html", F.lit("")).cast("binary"),
    ).withColumns({
        "payload_bytes": F.octet_length("payload").cast("bigint"),
        "payload_digest": F.sha1("payload"),
    })
    repeated = (
        rows.filter((F.col("payload_bytes") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", "kept")
    )
    # A payload that a third of the pages share is split by adaptive planning.
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(F.col("page_id") != F.col("kept"), F.col("kept")).alias("refers_to"),
    )


def train_dictionary(
    pages: DataFrame, size: int = 1 << 16, sample_rows: int = 1000, sample_bytes: int = 1 << 14
) -> bytes:
    """A dictionary of payload slices; the sample is drawn by a digest of the page id."""
    rows = only(pages, page_id="page_id", part=F.col("html").substr(1, sample_bytes).cast("binary"))
    # Ids first: a task then sends the driver ids for the draw, and texts of drawn pages only.
    drawn = rows.filter(F.length("part") > 0).select("page_id").orderBy(F.xxhash64("page_id"), "page_id")
    sampled = rows.join(F.broadcast(drawn.limit(sample_rows)), "page_id").select("part").limit(sample_rows)
    parts = [bytes(row.part) for row in sampled.collect()]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes()
    except zstandard.ZstdError:
        plain = b"".join(parts)[-size:]
        return plain if len(plain) >= 8 else b""


def _record(kind: str, name: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{key}: {value}\r\n" for key, value in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def page_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """A response, or a revisit that leaves the payload out and keeps its length and digest."""
    name = f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{uuid4()}"
    headers = [
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    kind = "response" if refers_to is None else "revisit"
    return _record(kind, name, headers, answer.encode() + (payload if refers_to is None else b""))


class ArchiveWriter:
    def __init__(self, path: str, dictionary: bytes, level: int, date: str):
        self.path, self.records = path, 0
        store, place = fs.FileSystem.from_uri(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(place, compression=None)
        if dictionary:
            packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=level, dict_data=shared)
        about = b"format: WARC File Format 1.1\r\n"
        headers = [("WARC-Date", date), ("Content-Type", "application/warc-fields")]
        self.out.write(self.compressor.compress(_record("warcinfo", f"urn:uuid:{uuid4()}", headers, about)))

    def add(self, record: bytes) -> None:
        self.out.write(self.compressor.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        size = self.out.tell()
        self.out.close()
        return self.path, self.records, size


def read_archive(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, with the dictionary the archive carries."""
    store, place = fs.FileSystem.from_uri(path)
    with store.open_input_stream(place, compression=None) as file:
        waiting, dictionary = file.read(READ_BYTES), b""
        if len(waiting) >= 8 and struct.unpack_from("<I", waiting)[0] == DICTIONARY_FRAME:
            end = 8 + struct.unpack_from("<I", waiting, 4)[0]
            while len(waiting) < end:
                waiting += file.read(end - len(waiting)) or _short(path)
            dictionary, waiting = waiting[8:end], waiting[end:]
            if dictionary.startswith(ZSTD_FRAME):
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        reader = zstandard.ZstdDecompressor(dict_data=shared)
        while waiting := waiting or file.read(READ_BYTES):
            frame, parts = reader.decompressobj(), []
            while True:
                parts.append(frame.decompress(waiting))
                if frame.eof:
                    break
                waiting = file.read(READ_BYTES) or _short(path)
            waiting = frame.unused_data
            head, _, block = b"".join(parts).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")[1:]
            headers = dict(line.split(": ", 1) for line in lines)
            yield headers, block[: int(headers["Content-Length"])]


def _short(path: str) -> bytes:
    raise EOFError(f"{path} ends inside a frame")


def write_archives(
    records: DataFrame, dictionary: bytes, folder: str, level: int = 6,
    file_bytes: int = 1 << 26, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write decided records as archives of about ``file_bytes``; returns the manifest.

    A repeated task writes files of other names; the manifest, written by Spark,
    lists the files of the attempts that count.
    """

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            names = ["page_id", "url", "payload", "payload_digest", "refers_to"]
            for row in zip(*(batch[name] for name in names)):
                if writer is None:
                    writer = ArchiveWriter(f"{folder}/{uuid4().hex}.warc.zst", dictionary, level, date)
                writer.add(page_record(*(value.as_py() for value in row), date))
                if writer.out.tell() >= file_bytes:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*done)], ["path", "records", "bytes"]
            )

    return written(records.mapInArrow(archives, MANIFEST), "archive-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every page record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response are those of the payload read back, which
    must agree with its headers; those of a revisit come from its headers.
    """

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows = []
                for headers, block in read_archive(path):
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    rows.append(_parsed(path, headers, block))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    return manifest.repartition(max(1, manifest.count()), "path").mapInArrow(
        pages,
        "page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT",
    )


def _parsed(path: str, headers: dict[str, str], block: bytes) -> tuple:
    answer, _, payload = block.partition(b"\r\n\r\n")
    length = int(answer.rpartition(b"Content-Length: ")[2])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response":
        if (len(payload), hashlib.sha1(payload).hexdigest()) != (length, digest):
            raise ValueError(f"{path}: {headers['WARC-Record-ID']} does not agree with its headers")
    return _page(headers["WARC-Record-ID"]), length, digest, headers["WARC-Type"], _page(
        headers.get("WARC-Refers-To", "")
    )


def _page(name: str) -> int | None:
    return int(name[len("<urn:page:"):-1]) if name.startswith("<urn:page:") else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def archive_pages(spark: SparkSession, pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Write archives to the shared folder and read every record back."""
    folder, dictionary = new_folder(spark, "warc"), train_dictionary(pages)
    return read_archives(write_archives(decide_records(pages, least_bytes), dictionary, folder))
