import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cliptide.llm import media, queries, webp

from .conftest import rows_of


class Writer:
    """A plain encoder for tests that can use every tool of the format."""

    def __init__(self, pixels, width, cache_bits=0, refs=True, groups=0):
        self.pen = webp.Pen()
        self.pixels, self.width = [int(p) for p in pixels], width
        self.height = len(pixels) // width
        self.cache_bits, self.refs, self.groups = cache_bits, refs, groups

    def tokens(self, pixels, width, cache_bits, refs):
        out, at, cache, seen = [], 0, {}, {}
        note = lambda v: cache.__setitem__((webp.CACHE_FACTOR * v & 0xFFFFFFFF) >> (32 - cache_bits), v)
        while at < len(pixels):
            v = pixels[at]
            back = seen.get(tuple(pixels[at : at + 3])) if refs and at + 3 <= len(pixels) else None
            run = 0
            if back is not None:
                while at + run < len(pixels) and pixels[at + run] == pixels[back + run] and run < 4096:
                    run += 1
            if run >= 3:
                step = at - back
                near = {max(1, x + y * width): k + 1 for k, (x, y) in reversed(list(enumerate(webp.near_distances())))}
                out.append((at, "ref", run, near.get(step, step + 120)))
            elif cache_bits and cache.get((webp.CACHE_FACTOR * v & 0xFFFFFFFF) >> (32 - cache_bits), None) == v:
                out.append((at, "cache", (webp.CACHE_FACTOR * v & 0xFFFFFFFF) >> (32 - cache_bits), 0))
            else:
                out.append((at, "lit", v, 0))
            for k in range(max(run, 1) if run >= 3 else 1):
                seen[tuple(pixels[at : at + 3])] = at
                if cache_bits:
                    note(pixels[at])
                at += 1
        return out

    @staticmethod
    def prefix(value):
        return max(k for k in range(40) if webp.base_value(k) <= value)

    def image(self, pixels, width, main, cache_bits=0, refs=True, groups=0):
        pen = self.pen
        pen.put(1 if cache_bits else 0, 1)
        if cache_bits:
            pen.put(cache_bits, 4)
        group_of = lambda at: 0
        n_groups = 1
        if main:
            pen.put(1 if groups else 0, 1)
            if groups:
                block = 2
                pen.put(block - 2, 3)
                across, down = -(-width // 4), -(-(len(pixels) // width) // 4)
                kinds = [k % groups for k in range(across * down)]
                self.image([k << 8 for k in kinds], across, False)
                group_of = lambda at: kinds[(at // width >> 2) * across + (at % width >> 2)]
                n_groups = max(kinds) + 1
        todo = self.tokens(pixels, width, cache_bits, refs)
        sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
        counts = [[[0] * n for n in sizes] for _ in range(n_groups)]
        for at, kind, a, b in todo:
            c = counts[group_of(at)]
            if kind == "lit":
                for t, v in zip(c, (a >> 8 & 255, a >> 16 & 255, a & 255, a >> 24)):
                    t[v] += 1
            elif kind == "cache":
                c[0][280 + a] += 1
            else:
                c[0][256 + self.prefix(a)] += 1
                c[4][self.prefix(b)] += 1
        codes = []
        for group in counts:
            own = []
            for t in group:
                lengths = webp.code_lengths(t)
                webp.write_code(pen, lengths)
                own.append(webp.canonical(lengths))
            codes.append(own)
        for at, kind, a, b in todo:
            g = codes[group_of(at)]
            if kind == "lit":
                for t, v in zip(g, (a >> 8 & 255, a >> 16 & 255, a & 255, a >> 24)):
                    pen.put(*t[v])
            elif kind == "cache":
                pen.put(*g[0][280 + a])
            else:
                for t, v, base in ((g[0], a, 256), (g[4], b, 0)):
                    p = self.prefix(v)
                    pen.put(*t[base + p])
                    pen.put(v - webp.base_value(p), webp.extra_bits(p))

    def file(self, transforms=()):
        pen, pixels, width = self.pen, list(self.pixels), self.width
        pen.put(0x2F, 8)
        pen.put(width - 1, 14)
        pen.put(self.height - 1, 14)
        pen.put(1, 1)
        pen.put(0, 3)
        r = random.Random(1)
        for kind in transforms:
            pen.put(1 | kind << 1, 3)
            if kind == webp.PALETTE:
                table = sorted(set(pixels))
                pen.put(len(table) - 1, 8)
                sub = lambda a, b: sum((((a >> k) - (b >> k)) & 255) << k for k in (0, 8, 16, 24))
                self.image([sub(v, table[k - 1] if k else 0) for k, v in enumerate(table)], len(table), False)
                bits = webp.palette_bits(len(table))
                per, depth, packed = 1 << bits, 8 >> bits, []
                for y in range(self.height):
                    row = [table.index(v) for v in pixels[y * width : (y + 1) * width]]
                    for x in range(0, width, per):
                        packed.append(0xFF000000 | sum(v << (depth * k) for k, v in enumerate(row[x : x + per])) << 8)
                pixels, width = packed, -(-width // per)
            elif kind == webp.SUBTRACT_GREEN:
                pixels = webp.add_green(np.array(pixels, np.uint32), -1).tolist()
            else:
                block = 2
                pen.put(block - 2, 3)
                across, down = -(-width // 4), -(-self.height // 4)
                if kind == webp.PREDICTOR:
                    modes = [k % 14 for k in range(across * down)]
                    self.image([0xFF000000 | m << 8 for m in modes], across, False)
                    split = [(v >> 24, v >> 16 & 255, v >> 8 & 255, v & 255) for v in pixels]
                    find = lambda x, y: modes[(y >> 2) * across + (x >> 2)]
                    rest = [tuple((a - b) & 255 for a, b in zip(split[k], webp.predictions(find, split, width, k))) for k in range(len(split))]
                    pixels = [a << 24 | b << 16 | c << 8 | d for a, b, c, d in rest]
                else:
                    factors = [r.getrandbits(24) for _ in range(across * down)]
                    self.image(factors, across, False)
                    pixels = webp.cross(np.array(pixels, np.uint32), width, block, np.array(factors, np.uint32), -1).tolist()
        pen.put(0, 1)
        self.image(pixels, width, True, self.cache_bits, self.refs, self.groups)
        return webp.container(pen.value.to_bytes((pen.n + 7) >> 3, "little"))


def picture(width, height, colours, seed=0):
    r = random.Random(seed)
    palette = [r.getrandbits(32) for _ in range(colours)]
    out = [r.choice(palette) for _ in range(width * height)]
    for k in range(40, len(out) - 30, 90):  # passages that repeat
        out[k : k + 25] = out[k - 40 : k - 15]
    return out


P, C, G, I = webp.PREDICTOR, webp.CROSS_COLOUR, webp.SUBTRACT_GREEN, webp.PALETTE


@pytest.mark.parametrize("by_array", [True, False])
@pytest.mark.parametrize("transforms", [(), (G,), (P,), (C,), (I,), (P, C, G), (C, P), (G, C, P), (I, P)])
def test_every_transform_round_trips(transforms, by_array):
    for width, height, colours in ((13, 11, 2), (17, 9, 4), (10, 10, 15), (23, 15, 200), (1, 9, 3)):
        if I not in transforms or colours <= 256:
            pixels = picture(width, height, colours)
            file = Writer(pixels, width).file(transforms)
            assert webp.decode(file, by_array)[:2] == (width, height)
            assert webp.decode(file, by_array)[2].tolist() == pixels


@pytest.mark.parametrize("cache_bits", [0, 1, 5, 11])
@pytest.mark.parametrize("refs", [True, False])
@pytest.mark.parametrize("groups", [0, 3])
def test_cache_references_and_groups_round_trip(cache_bits, refs, groups):
    pixels = picture(29, 21, 40, 4)
    file = Writer(pixels, 29, cache_bits, refs, groups).file((G,))
    assert webp.decode(file)[2].tolist() == pixels


def test_near_distances_are_the_formats():
    near = webp.near_distances()
    assert len(near) == 120
    assert near[:6] == ((0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0)) and near[-3:] == ((-7, 7), (8, 6), (8, 7))


def test_predictors_by_hand():
    a, b, c, d = (10, 20, 30, 40), (12, 18, 33, 200), (14, 10, 30, 250), (11, 19, 29, 100)  # left, top, right, corner
    assert webp.predict(0, a, b, c, d) == (255, 0, 0, 0)
    assert [webp.predict(m, a, b, c, d) for m in (1, 2, 3, 4)] == [a, b, c, d]
    assert webp.predict(7, a, b, c, d) == (11, 19, 31, 120)
    assert webp.predict(12, a, b, c, d) == (11, 19, 34, 140)
    assert webp.predict(13, a, b, c, d) == (11, 19, 32, 130)
    assert webp.predict(11, a, b, c, d) == b  # distances: to left 1+1+4+100, to top 1+1+1+60


def test_broken_files_raise():
    good = webp.encode_grey(np.arange(576, dtype=np.uint16).astype(np.uint8), 576)
    for bad in (b"", good[:30], b"JUNK" + good[4:], good[:-40]):
        with pytest.raises(ValueError):
            webp.decode(bad)


@pytest.mark.parametrize("data", [b"\xff" * 576, b"a" * 1152, bytes(range(256)) * 9, b"ab" * 288, random.Random(1).randbytes(5760), b"x" * 575 + b"y", b"y" + b"\xff" * 575])
def test_grey_round_trip(data):
    media_bytes = media.to_media(data)
    assert b"".join(p.tobytes() for p in media.pictures(media_bytes)) == data
    two = media.to_media(data * 3, rows=1)
    assert b"".join(p.tobytes() for p in media.pictures(two)) == data * 3


def test_query_equals_brute_force(spark, docs, empty):
    got = Counter()
    for r in queries.op5_media(spark, docs).collect():
        got[tuple(r)[:5]] += 1
        assert r.media_bytes > 0 and len(r.media_sha256) == 64 and r.feature
    want = Counter()
    for d, t in rows_of(spark, docs):
        raw = (t or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        want[(d, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))] += 1
    assert got == want
    assert queries.op5_media(spark, empty).count() == 0


def test_pixel_arrays_are_the_payload(spark, docs):
    from cliptide.llm.common import staged

    df = spark.read.parquet(f"{docs}/documents.parquet").where("doc_id is not null").limit(30)
    rows = media.pixel_arrays(staged(media.encode_documents(df))).collect()
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in rows:
        assert r.width * r.height == len(r.pixels)
        assert bytes(r.pixels).startswith((texts.get(r.doc_id) or "").encode()[: len(r.pixels)])
