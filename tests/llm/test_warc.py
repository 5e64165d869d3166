import hashlib
import io
import struct
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from cliptide.llm import queries, warc


def rows():
    page = "<html>" + "words " * 40
    out = [(k, f"http://x/{k}", f"{page}{k}</html>", "odd") for k in range(200)]
    out += [(300 + k, "http://copy/", page, "odd") for k in range(120)]  # copies
    out += [(500 + k, None, "short", "odd") for k in range(5)]
    out += [(600, "a\r\nb", None, None), (601, "", "", None), (602, "u", "ünï çödé \r\n\r\nWARC/1.1\r\n" * 9, None), (603, "v", "x" * 300_000, None), (604, "v", "x" * 300_000, None)]
    return [*out, (None, "n", page, "odd"), (300, "again", page, "odd")]


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("p"))
    df = spark.createDataFrame(rows(), "page_id long, url string, html string, digest string")
    df.repartition(3).write.mode("overwrite").parquet(f"{path}/pages.parquet")
    return path


def test_query_equals_brute_force(spark, pages):
    first = defaultdict(list)
    for k, _, h, _ in rows():
        if k is not None and len((h or "").encode()) >= 100:
            first[h].append(k)
    want = Counter()
    for k, _, h, _ in rows():
        data = (h or "").encode()
        low = min(first[h]) if h in first else None
        back = low if k is not None and low is not None and k > low else None
        want[(k, len(data), hashlib.sha256(data).hexdigest(), "response" if back is None else "revisit", back)] += 1
    assert Counter(tuple(r)[:5] for r in queries.op1_warc(spark, pages).collect()) == want


def test_archives_hold_whole_payloads(spark, pages):
    archives, folder = warc.archive(spark.read.parquet(f"{pages}/pages.parquet"))
    assert archives.agg(F.sum("records")).first()[0] == len(rows())
    read = warc.read_archives(archives, folder, payloads=True).where("record_type = 'response'").collect()
    by_id = {r[0]: (r[2] or "").encode() for r in rows()}
    assert all(bytes(r.payload) == by_id[r.page_id] for r in read)
    assert {r.url for r in read if r.page_id == 600} == {"a%0D%0Ab"}


def test_an_archive_is_a_dictionary_and_single_frames():
    sink = io.BytesIO()
    sink.close, data = lambda: None, [warc.record(k, "http://x", b"payload of some words %d " % k * 9, "00", None) for k in range(50)]
    w = warc.ArchiveWriter(sink)
    for d in data:
        w.add(d)
    w.close()
    held = sink.getvalue()
    magic, size = struct.unpack("<II", held[:8])
    assert magic == 0x184D2A5D
    trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(held[8 : 8 + size]))
    rest, out = held[8 + size :], []
    while rest:  # each record by itself, with the dictionary alone
        d = zstandard.ZstdDecompressor(dict_data=trained).decompressobj()
        out.append(d.decompress(rest))
        rest = d.unused_data
    assert out == data
    assert len(list(warc.read_archive(io.BytesIO(held)))) == 50
    with pytest.raises(Exception):
        list(warc.read_archive(io.BytesIO(held[:-5])))


def test_rolls_over_and_empty(spark, pages):
    df = spark.read.parquet(f"{pages}/pages.parquet").select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"), F.lit("00").alias("digest"), F.lit(None).cast("long").alias("refers_to"))
    from cliptide.llm.common import shared_dir

    folder = shared_dir(spark)
    archives = warc.write_archives(df.where("page_id < 100").coalesce(1), folder, archive_bytes=200)
    assert archives.count() > 1 and archives.agg(F.sum("records")).first()[0] == 100
    found, folder = warc.archive(spark.read.parquet(f"{pages}/pages.parquet").limit(0))
    assert warc.read_archives(found, folder).count() == 0
