"""Exact round trips of archives, their format, and reads of single records."""

import base64
import hashlib
import io

import pyarrow as pa
import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from fieldmart.llm import warc


@pytest.fixture(scope="module")
def pages(spark):
    same = "<p>same</p>"
    rows = [(1, "http://a", same), (5, "http://b", same), (5, "http://b", same), (3, None, None), (4, "u\r\nx", ""), (None, "http://n", "\r\n\r\nWARC/1.1 é 😀"),
            (None, "http://m", same)] + [(100 + i, f"http://c/{i}", f"page {i} " * 500) for i in range(80)]
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def test_round_trip(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 20_000)
    folder = warc.archive_folder(spark)
    index = warc.write_archives(pages, folder)
    found = warc.read_records(index, folder).collect()
    rows = pages.collect()
    newest = {}
    for r in rows:
        newest[r.html or ""] = max(newest.get(r.html or "", -1), -1 if r.page_id is None else r.page_id)
    expected = []
    for r in rows:
        data, top = (r.html or "").encode(), newest[r.html or ""]
        revisit = (-1 if r.page_id is None else r.page_id) != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((r.page_id, len(data), digest, "revisit" if revisit else "response", top if revisit else None, None if revisit else data))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 20_000)
    folder = warc.archive_folder(spark)
    index = warc.write_archives(pages, folder).collect()
    system, base = fs.FileSystem.from_uri(folder)
    for name in {r.bundle for r in index}:
        data = system.open_input_file(f"{base}/{name}").read()
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        table = warc.seek_table(system.open_input_file(f"{base}/{name}"))
        assert plain.startswith(b"WARC/1.1\r\n") and sum(t[2] for t in table) == len(plain)
        starts = [sum(t[2] for t in table[:k]) for k in range(len(table))]
        for r in index:
            if r.bundle == name:
                at = starts[r.frame] + r.offset
                assert warc.parse_record(plain[at:at + r.length])["page_id"] == r.page_id


def test_single_records_and_limits(spark, pages):
    folder = warc.archive_folder(spark)
    index = warc.write_archives(pages, folder, dedup_bytes=100)
    one = warc.read_records(index.filter("page_id = 133"), folder).collect()
    assert [(r.page_id, r.url, bytes(r.payload)) for r in one] == [(133, "http://c/33", b"page 33 " * 500)]
    assert warc.read_records(index, folder).filter("record_type = 'revisit'").count() == 0


def test_damage_and_nothing(spark, pages):
    record = warc.make_record(1, "u", b"abc", None, False)
    assert warc.parse_record(record)["payload"] == b"abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record.replace(b"abc", b"abd"))
    folder = warc.archive_folder(spark)
    assert warc.read_records(warc.write_archives(pages.limit(0), folder), folder).count() == 0
    assert warc.read_records(warc.write_archives(pages.select("page_id", "url", F.lit(None).cast("string").alias("html")), folder), folder).count() == pages.count()
    with pytest.raises(ValueError, match="seek"):
        warc.seek_table(pa.BufferReader(b"x" * 50))
