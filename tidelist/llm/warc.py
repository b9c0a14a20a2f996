"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress independently; a bundle ends with a seek table in
a skippable frame, so ordinary Zstandard readers take it as one stream of records. The index maps
each record to its bundle, frame and offset within the frame.

Of records with equal payloads of at least REVISIT_BYTES bytes, that with the largest page_id is a
response and the others are revisits, which carry the headers alone.

Tasks write bundles under names of their own; only what the index lists counts, so a task that is
run again, or twice, leaves nothing behind that is read.
"""

from __future__ import annotations

import struct
from base64 import b16encode, b32decode, b32encode, b16decode
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelist.llm.common import file_system, spread, written

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20  # a frame ends at the first record that reaches as many bytes
UNDATED = "1970-01-01T00:00:00Z"  # pages have no time of their own
# Fixed values of the WARC and of the seekable Zstandard format.
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
_ENTRY = struct.Struct("<II")  # compressed and decompressed bytes of a frame
_FOOTER = struct.Struct("<IBI")  # frames, descriptor, magic


def name_of(page_id: int | None) -> bytes:
    return b"<urn:page:%d>" % page_id if page_id is not None else b"<urn:uuid:%s>" % str(uuid4()).encode()


def page_of(name: bytes) -> int | None:
    return int(name[10:-1]) if name.startswith(b"<urn:page:") else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, its HTTP headers included; a revisit if it refers to another page."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank").encode()
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: " + name_of(page_id),
        b"WARC-Date: " + UNDATED.encode(),
        b"WARC-Target-URI: " + target,
        b"WARC-Payload-Digest: sha1:" + b32encode(b16decode(digest, casefold=True)),
        b"Content-Type: application/http;msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if refers_to is not None:
        head += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + name_of(refers_to)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, at: int = 0) -> tuple[dict[bytes, bytes], dict[bytes, bytes], bytes, int]:
    """(WARC headers, HTTP headers, body, where the next record begins) of the record at a place."""
    head, at = _headers(data, at)
    end = at + int(head[b"content-length"])
    http, body = _headers(data, at)
    return head, http, data[body:end], end + 4


def _headers(data: bytes, at: int) -> tuple[dict[bytes, bytes], int]:
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].split(b"\r\n")[1:]
    fields = dict(line.split(b": ", 1) for line in lines)
    return {name.lower(): value for name, value in fields.items()}, end + 4


class Bundle:
    """A bundle that is being written."""

    def __init__(self, path: str):
        from zstandard import ZstdCompressor

        store, root = file_system(path)
        self.out = store.open_output_stream(root, compression=None)
        self.compress = ZstdCompressor(level=3).compress
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset within the frame) of the record."""
        place = len(self.frames), self.size
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self._end_frame()
        return place

    def _end_frame(self) -> None:
        frame = self.compress(b"".join(self.held))
        self.out.write(frame)
        self.frames.append((len(frame), self.size))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._end_frame()
        table = b"".join(_ENTRY.pack(*f) for f in self.frames)
        table += _FOOTER.pack(len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class Reader:
    """Frames of a bundle, by way of its seek table."""

    def __init__(self, path: str):
        from zstandard import ZstdDecompressor

        store, root = file_system(path)
        self.file = store.open_input_file(root)
        self.decompress = ZstdDecompressor().decompress
        size = self.file.size()
        count, _, magic = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        width = count * _ENTRY.size
        table = self.file.read_at(width, size - _FOOTER.size - width)
        self.frames, at = [], 0
        for packed, _ in _ENTRY.iter_unpack(table):
            self.frames.append((at, packed))
            at += packed

    def frame(self, number: int) -> bytes:
        at, size = self.frames[number]
        return self.decompress(self.file.read_at(size, at))

    def fetch(self, frame: int, offset: int) -> tuple[dict[bytes, bytes], dict[bytes, bytes], bytes]:
        """One record by its place in the index."""
        return parsed(self.frame(frame), offset)[:3]

    def records(self) -> Iterator[tuple[dict[bytes, bytes], dict[bytes, bytes], bytes]]:
        for number in range(len(self.frames)):
            data, at = self.frame(number), 0
            while at < len(data):
                head, http, body, at = parsed(data, at)
                yield head, http, body


@dataclass(frozen=True)
class Archive:
    """Written bundles; ``index``: (page_id, record_type, path, frame, offset) of each record."""

    folder: str
    index: DataFrame


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of every page."""
    html = F.coalesce("html", F.lit(""))
    digested = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"), F.sha1(html.cast("binary")).alias("digest")
    )
    repeated = (
        digested.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("latest")), F.col("latest"))
    return digested.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", refers_to.alias("refers_to")
    )


def write(pages: DataFrame, folder: str) -> Archive:
    """Write a record per row of ``pages``.

    A null html is an empty payload, a null url ``about:blank``. Rows that share a page_id and the
    payload are all responses, if theirs is the largest id; a row without page_id gets a name of
    its own and is a revisit wherever another row has its payload. Other columns are ignored.
    """
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, path = None, f"{folder}/{uuid4().hex}.warc.zst"
        for batch in batches:
            frames, offsets = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                page_id, url, payload, digest, refers_to = row
                bundle = bundle or Bundle(path)
                frame, offset = bundle.add(record(page_id, url, payload, digest, refers_to))
                frames.append(frame)
                offsets.append(offset)
            kinds = ["response" if r is None else "revisit" for r in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(kinds, pa.string()),
                    pa.array([path] * len(frames), pa.string()),
                    pa.array(frames, pa.int64()),
                    pa.array(offsets, pa.int64()),
                ],
                ["page_id", "record_type", "path", "frame", "offset"],
            )
        if bundle:
            bundle.close()

    rows = with_revisits(pages).withColumn("payload", F.col("payload").cast("binary"))
    schema = "page_id long, record_type string, path string, frame long, offset long"
    return Archive(folder, written(rows.mapInArrow(save, schema), "warc-index"))


def read(archive: Archive) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Length and digest are those of the full payload: computed from the payload of a response, of
    which the digest must agree with the header, and taken from the headers of a revisit.
    """
    from hashlib import sha1

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for head, http, body in Reader(path).records():
                    digest = b16encode(b32decode(head[b"warc-payload-digest"][5:])).decode().lower()
                    kind, refers_to = head[b"warc-type"].decode(), None
                    if kind == "response":
                        if sha1(body).hexdigest() != digest:
                            raise ValueError(f"{path}: a payload does not have its digest")
                    else:
                        refers_to = page_of(head[b"warc-refers-to"])
                    size = int(http[b"content-length"])
                    rows.append((page_of(head[b"warc-record-id"]), size, digest, kind, refers_to))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names
                )

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread(archive.index.select("path").distinct()).mapInArrow(load, schema)
