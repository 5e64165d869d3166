"""Media columns: whole texts as grey lossless WebP pictures, and features of the pictures read back."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import webp
from .common import only, staged

#: A row of a picture, and so the payload's unit; pictures have at most MAX_SIDE rows and longer payloads several.
ROW = 576


def payload_of(text: str | None) -> tuple[int, bytes]:
    data = (text or "").encode()
    return len(data), data + b"\xff" * (-len(data) % ROW if data else ROW)


def to_media(payload: bytes, rows: int = webp.MAX_SIDE) -> bytes:
    """The payload's rows as WebP files one after another."""
    samples = np.frombuffer(payload, np.uint8)
    return b"".join(webp.encode_grey(samples[a : a + rows * ROW], ROW) for a in range(0, len(samples), rows * ROW))


def pictures(media: bytes) -> Iterator[np.ndarray]:
    """Decoded grey samples of every file, rows by ROW columns."""
    at = 0
    while at < len(media):
        size = 8 + int.from_bytes(media[at + 4 : at + 8], "little")
        width, height, argb = webp.decode(media[at : at + size])
        if (argb != (argb & 255) * 0x010101 | webp.BLACK).any():
            raise ValueError("not a grey picture")
        yield (argb & 255).astype(np.uint8).reshape(height, width)
        at += size


def encode_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (the stored files) of every row; a null text is empty and makes one row of padding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(n, to_media(p)) for n, p in (payload_of(t.as_py()) for t in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([m for _, m in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def pixel_arrays(media: DataFrame) -> DataFrame:
    """doc_id, width, height and pixels (bytes, row by row) of every picture of every row of (doc_id, media)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, m in zip(b.column(0).to_pylist(), b.column(1)):
                found = list(pictures(m.as_py() or b""))
                cols = [pa.array([doc] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array([p.shape[1] for p in found], pa.int32()), pa.array([p.shape[0] for p in found], pa.int32()), pa.array([p.tobytes() for p in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "picture", "width", "height", "pixels"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, picture int, width int, height int, pixels binary")


def features(media: DataFrame) -> DataFrame:
    """Digests of the stored files and of the payload decoded from them, and a feature line, for (doc_id, n_bytes, media).

    feature: width x height, then the samples' sum, the distinct samples and the total step between neighbours.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, n, m in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                media = m.as_py()
                digest, size, total, steps, seen, tail, height = hashlib.sha256(), 0, 0, 0, np.zeros(256, bool), b"", 0
                for p in pictures(media):
                    raw = p.tobytes()
                    digest.update(raw)
                    size, height, tail = size + len(raw), height + p.shape[0], raw[-32:]
                    counts = np.bincount(p.ravel(), minlength=256)
                    total, seen = total + int(counts @ np.arange(256)), seen | (counts > 0)
                    steps += int(np.abs(np.diff(p.ravel().astype(np.int16))).sum(dtype=np.int64))
                rows.append((doc, n, size, digest.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), f"{ROW}x{height}:{total}:{int(seen.sum())}:{steps}"))
            cols = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, schema)


def media_columns(docs: DataFrame) -> DataFrame:
    """features() of the stored pictures of every row of docs (doc_id, text); other columns are ignored."""
    return features(staged(encode_documents(docs), "media"))
