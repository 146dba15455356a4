"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about `frame_bytes`; a bundle is a
file of frames that ends with a seek table (a skippable frame of the frames' sizes). The
index maps each record to its bundle, frame, and offset and length inside the frame, so one
record is read by one seek and one frame. Of records with equal payloads the one with the
largest page_id holds the payload, the others are revisit records that refer to it.

Each task streams its records: a frame is all it holds. A file's name carries the task
attempt, and the index is a table written by Spark's commit protocol, so it names the files
of attempts that succeeded; a lost attempt leaves at most a file that nothing names. Files
are written through the file system that the folder's address names.

Defined results: a null html is an empty payload; null page ids are smallest; of repeated
rows with the largest page_id each is a response; every input row gives one record; other
columns are left out; an empty table gives no bundle and an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import materialized
from fieldmart.session import scratch_path

FRAME_BYTES = 512 * 1024
BUNDLE_BYTES = 256 * 1024 * 1024
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the seekable format: skippable frame, seek table.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, bundle string, frame int, offset int, length int"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(urn: str) -> int | None:
    digits = urn[len("<urn:page:"):-1]
    return int(digits) if digits else None


def parse_record(data: bytes) -> dict:
    """A record's fields; digest and size of a response are those of the payload as read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    size = int(http.decode().rpartition("Content-Length: ")[2])
    if not revisit and (base32_sha1(payload) != told or len(payload) != size):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"page_id": _number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": told, "record_type": fields["WARC-Type"],
            "refers_to": _number(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload}


class BundleWriter:
    """Frames of records behind each other, then the seek table."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.out = system.open_output_stream(path, compression=None)  # its frames are compressed already
        self.sizes: list[tuple[int, int]] = []
        self.pending: list[bytes] = []
        self.held = self.written = 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        """The record's frame, offset and length."""
        place = (len(self.sizes), self.held, len(record))
        self.pending.append(record)
        self.held += len(record)
        if self.held >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if self.pending:
            frame = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.pending))
            self.out.write(frame)
            self.sizes.append((len(frame), self.held))
            self.written += len(frame)
            self.pending, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Place, compressed and plain size of each frame, from the end of the file."""
    end = file.size()
    file.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(end - 9 - 8 * count)
    raw, at, out = file.read(8 * count), 0, []
    for packed, plain in struct.iter_unpack("<II", raw):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file: pa.NativeFile, place: tuple[int, int, int]) -> bytes:
    file.seek(place[0])
    return zstandard.ZstdDecompressor().decompress(file.read(place[1]), max_output_size=place[2])


def write_archives(pages: DataFrame, folder: str, dedup_bytes: int = 0, id_column: str = "page_id",
                   url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write the bundles under `folder` and return their index."""
    payload = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    groups = materialized(rows.groupBy("digest").agg(F.max("page_id").alias("newest")), "payloads")
    shared = F.length("payload") >= dedup_bytes
    known = rows.join(groups, "digest").select(
        "page_id", "url", "payload", F.when(shared, F.col("newest")).alias("newest"),
        (shared & ~F.col("page_id").eqNullSafe(F.col("newest"))).alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        task, writer, made = TaskContext.get(), None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, found = batch.slice(at, 64), []
                for row in part.to_pylist():
                    if writer is None:
                        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{made}.warc.zst"
                        writer, made = BundleWriter(system, f"{base}/{name}"), made + 1
                    record = make_record(row["page_id"], row["url"], row["payload"], row["newest"], row["revisit"])
                    found.append((row["page_id"], name, *writer.add(record)))
                    if writer.written >= BUNDLE_BYTES:
                        writer.close()
                        writer = None
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (
                    pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32()), strict=True)],
                    ["page_id", "bundle", "frame", "offset", "length"])
        if writer:
            writer.close()

    return materialized(known.mapInArrow(run, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index rows name: each frame is read once, records are cut out by offset."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        name = file = table = frame = data = None
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = []
                for row in batch.slice(at, 64).to_pylist():
                    if row["bundle"] != name:
                        if file:
                            file.close()
                        name, frame = row["bundle"], None
                        file = system.open_input_file(f"{base}/{name}")
                        table = seek_table(file)
                    if row["frame"] != frame:
                        frame = row["frame"]
                        data = read_frame(file, table[frame])
                    found.append(parse_record(data[row["offset"]:row["offset"] + row["length"]]))
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in zip(names, kinds, strict=True)], names)
        if file:
            file.close()

    order = ["bundle", "frame", "offset"]
    return index.repartition("bundle", F.floor(F.col("frame") / 64)).sortWithinPartitions(*order).mapInArrow(run, RECORD)


def archive_folder(session) -> str:
    """A fresh folder for bundles under the shared folder."""
    return scratch_path(session, "warc")
