"""Dictionary-compressed WARC archives, written and read by tasks straight from and to shared storage.

An archive starts with a skippable frame that holds its Zstandard dictionary (itself compressed), trained from the
first records of that archive; every record is a Zstandard frame of its own, so a reader may start at any record.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, shared_dir, spread_join, staged

SKIPPABLE = 0x184D2A5D
MIN_REVISIT_BYTES = 100
DICTIONARY_BYTES = 64 << 10
#: An archive's dictionary is trained from at most so many of its first records and bytes.
SAMPLE_RECORDS, SAMPLE_BYTES = 1000, 4 << 20
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAME = "urn:cliptide:page:"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit's block holds the HTTP head alone; its payload is named by digest."""
    name = lambda p: f"<{_NAME}{'' if p is None else p}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page)}", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
        block = http
    else:
        block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained from the samples; too few or too uniform ones serve as a raw dictionary instead."""
    try:
        if len(samples) < 16:
            raise zstandard.ZstdError
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 10)), samples, level=LEVEL)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw if len(raw) >= 8 else raw.ljust(8, b"\r"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Streams records into one archive; the first ones wait until the dictionary is trained."""

    def __init__(self, sink):
        self.sink, self.waiting, self.waiting_bytes, self.compressor = sink, [], 0, None
        self.records = self.bytes = 0

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self._put(self.compressor.compress(data))
            return
        self.waiting.append(data)
        self.waiting_bytes += len(data)
        if len(self.waiting) >= SAMPLE_RECORDS or self.waiting_bytes >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        trained = dictionary(self.waiting)
        held = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        self._put(struct.pack("<II", SKIPPABLE, len(held)) + held)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        for data in self.waiting:
            self._put(self.compressor.compress(data))
        self.waiting, self.waiting_bytes = [], 0

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.sink.close()


class Frames(io.RawIOBase):
    """The plain bytes of frame after frame; a frame cut short raises."""

    def __init__(self, source, trained: zstandard.ZstdCompressionDict):
        self.source, self.reader = source, zstandard.ZstdDecompressor(dict_data=trained)
        self.frame, self.raw, self.plain = None, b"", memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.plain:
            if not self.raw:
                self.raw = self.source.read(1 << 16)
                if not self.raw:
                    if self.frame is not None:
                        raise ValueError("an archive is cut short")
                    return 0
            self.frame = self.frame or self.reader.decompressobj()
            self.plain = memoryview(self.frame.decompress(self.raw))
            self.raw = b""
            if self.frame.eof:
                self.raw, self.frame = self.frame.unused_data, None
        n = min(len(out), len(self.plain))
        out[:n], self.plain = self.plain[:n], self.plain[n:]
        return n


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(WARC header, block) of every record; source is a binary file object. A broken archive raises."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("an archive must start with its dictionary's skippable frame")
    trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(source.read(size)))
    plain = io.BufferedReader(Frames(source, trained), 1 << 20)
    while line := plain.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError("not a WARC record")
        head: dict[str, str] = {}
        while (line := plain.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            head[k] = v
        block = plain.read(int(head["Content-Length"]))
        if len(block) != int(head["Content-Length"]) or plain.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield head, block


def filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (page_id, url, payload, digest, refers_to) into archives below folder; returns their paths and sizes.

    Each attempt of a task writes files of its own name and only a finished attempt's names are returned, so lost
    executors and repeated attempts leave at worst unnamed files. The returned table is staged: nothing writes twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, done = None, []

        def finish() -> None:
            out.close()
            done.append((name, out.records, out.bytes))

        for b in batches:
            for page, url, payload, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name = f"{root}/{uuid.uuid4().hex}.warc.zst"
                    out = ArchiveWriter(store.open_output_stream(name))
                out.add(record(page, url, payload, digest, refers))
                if out.bytes + out.waiting_bytes >= archive_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        cols = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], ["path", "records", "bytes"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("payload").cast("binary"), "digest", F.col("refers_to").cast("long"))
    return staged(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records of the archives: page_id, url, record_type, refers_to, payload_digest, payload_bytes (and payload).

    A response's digest and size are computed from the payload read and must equal its header; a revisit's are those
    its header names.
    """
    n = max(1, min(archives.count(), 20_000))

    def number(name: str) -> int | None:
        return int(tail) if (tail := name.removeprefix(f"<{_NAME}").rstrip(">")) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(folder)
        for b in batches:
            for path, records in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(path) as f:
                    for head, block in read_archive(f):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        first = head["WARC-Type"] == "response"
                        if first and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError("a payload differs from its digest")
                        refers = None if first else number(head["WARC-Refers-To"])
                        rows.append((number(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), head["WARC-Type"], refers, digest, size, payload if payloads and first else None))
                        held += len(payload) if payloads else 100
                        seen += 1
                        if held > 4 << 20:
                            yield batch(rows)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{path} holds {seen} of {records} records")
                yield batch(rows)

    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    schema = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    out = archives.select("path", "records").repartition(n).mapInArrow(run, schema)
    return out if payloads else out.drop("payload")


def archive(pages: DataFrame) -> tuple[DataFrame, str]:
    """Archives every row of pages (page_id, url, html); returns the table of archives and their folder.

    Of equal payloads of at least MIN_REVISIT_BYTES bytes the smallest page_id is the response and larger ids revisit
    it; rows that repeat that smallest id are responses too. A null html is an empty payload, a null page_id is always
    a response, a null url is left out. Other columns are ignored. An empty table gives no archives.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    seen = staged(rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).select("page_id", "digest"), "digests")
    firsts = staged(seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null"), "firsts")
    hot = hot_keys(firsts, "digest", "n")
    repeats = spread_join(seen, firsts.select("digest", "refers_to"), "digest", hot, F.col("page_id"), "inner").where("page_id > refers_to")
    repeats = staged(repeats.select("page_id", "digest", "refers_to").distinct(), "repeats")
    if repeats.limit(1).count():  # the size of this staged table lets Spark choose between a broadcast and a shuffle
        rows = rows.join(repeats, ["page_id", "digest"], "left")
    else:
        rows = rows.withColumn("refers_to", F.lit(None).cast("long"))
    folder = shared_dir(pages.sparkSession)
    return write_archives(rows, folder), folder
