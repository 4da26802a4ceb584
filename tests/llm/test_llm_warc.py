import hashlib

import pytest
import zstandard
from plateia.llm import warc
from plateia.llm.common import new_folder

SCHEMA = "page_id BIGINT, url STRING, html STRING, kept STRING, payload STRING"
LONG = "<p>" + "words and more words " * 80


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def expected(rows, least):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if p is not None and (h or "").encode() == data]
        kept = max(same, default=None)
        revisit = len(data) >= least and page_id is not None and page_id != kept
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example/x y\r\nz", LONG), (5, "http://b.example", LONG), (3, None, LONG), (4, "u", "short"),
    (6, "u", "short"), (7, "u", None), (8, "u", ""), (9, "http://é", "é" * 500), (10, "u", "WARC/1.1\r\n\r\n" * 100),
    (None, "u", LONG), (5, "http://b.example", LONG), (11, "u", "long " * 100_000),
] + [(100 + i, "u", f"<html>{i} {LONG[: i * 7]}</html>") for i in range(60)]


def test_round_trip_with_revisits(spark):
    found = warc.archive_pages(spark, pages(spark, ROWS), least_bytes=1000)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(ROWS, 1000)


def test_archives_carry_their_dictionary_and_records_stand_alone(spark):
    dictionary = warc.train_dictionary(pages(spark, ROWS), size=4096)
    assert dictionary
    records = warc.decide_records(pages(spark, ROWS))
    manifest = warc.write_archives(records, dictionary, new_folder(spark, "test"), file_bytes=2000).collect()
    assert sum(m.records for m in manifest) == len(ROWS) and len(manifest) > 3  # files roll over
    for row in manifest:
        data = open(row.path.removeprefix("file:"), "rb").read()
        assert len(data) == row.bytes
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
        size = int.from_bytes(data[4:8], "little")
        shared = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        assert shared.as_bytes() == dictionary
        frames, rest = 0, data[8 + size :]
        while rest:
            one = zstandard.ZstdDecompressor(dict_data=shared).decompressobj()
            assert one.decompress(rest).startswith(b"WARC/1.1\r\n")
            rest, frames = one.unused_data, frames + 1
        assert frames == row.records + 1


def test_a_cut_archive_is_an_error(spark, tmp_path):
    writer = warc.ArchiveWriter(f"file://{tmp_path}/a.warc.zst", b"", 3, "2024-01-01T00:00:00Z")
    writer.add(warc.page_record(1, "u", b"x" * 5000, hashlib.sha1(b"x" * 5000).hexdigest(), None, "2024-01-01T00:00:00Z"))
    writer.close()
    whole = (tmp_path / "a.warc.zst").read_bytes()
    assert len(list(warc.read_archive(f"file://{tmp_path}/a.warc.zst"))) == 2
    (tmp_path / "b.warc.zst").write_bytes(whole[:-4])
    with pytest.raises(EOFError):
        list(warc.read_archive(f"file://{tmp_path}/b.warc.zst"))


def test_no_pages(spark):
    assert warc.archive_pages(spark, pages(spark, [])).count() == 0


def test_pages_without_text(spark):
    rows = [(1, "u", None), (2, "u", "")]
    assert sorted(map(tuple, warc.archive_pages(spark, pages(spark, rows)).collect())) == expected(rows, 1000)
