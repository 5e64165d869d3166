"""Lossless WebP: a decoder for every tool of the format, a small encoder, and media columns built on them.

The decoder reads prefix codes, back-references and the colour cache and inverts the predictor, cross-colour,
subtract-green and palette transforms. Where an image has one group of prefix codes and no cache, it finds all tokens
with array operations: the length of the token that would start at each bit follows from table lookups, and the chain
of starts is followed by doubling. Other images are decoded token by token.
"""

from __future__ import annotations

import heapq
import struct
from functools import lru_cache

import numpy as np

MAX_SIDE = 16384
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
MAX_BITS = 15
WINDOW_BYTES = 1 << 17
#: Fixed values of the format: the order in which lengths of code-length codes are stored, and the cache's multiplier.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
CACHE_FACTOR = 0x1E35A7BD
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
BLACK = 0xFF000000


@lru_cache(maxsize=1)
def near_distances() -> tuple[tuple[int, int], ...]:
    """(x, y) of distance codes 1 to 120: the nearest earlier pixels by distance, then by |x|, right before left."""
    near = [(x, y) for y in range(8) for x in range(-7, 9) if y or x > 0]
    return tuple(sorted(near, key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0)))


def _parts(n: int, bits: int) -> int:
    return -(-n // (1 << bits))


def extra_bits(prefix: int) -> int:
    return 0 if prefix < 4 else (prefix - 2) >> 1


def base_value(prefix: int) -> int:
    return prefix + 1 if prefix < 4 else ((2 + (prefix & 1)) << ((prefix - 2) >> 1)) + 1


def canonical(lengths) -> dict[int, tuple[int, int]]:
    """Symbol to (code, length), the code's bits reversed as they lie in the stream. A lone symbol has length 0."""
    used = sorted((n, s) for s, n in enumerate(lengths) if n)
    if len(used) == 1:
        return {used[0][1]: (0, 0)}
    code, last, out = 0, 0, {}
    for n, s in used:
        code <<= n - last
        last = n
        out[s] = (int(f"{code:0{n}b}"[::-1], 2), n)
        code += 1
    if used and code != 1 << last:
        raise ValueError("a prefix code is not complete")
    return out


class Code:
    """A prefix code as a table over the next `bits` bits: symbol << 4 | length."""

    def __init__(self, lengths):
        codes = canonical(lengths)
        if not codes:
            raise ValueError("a prefix code without symbols")
        self.bits = max(n for _, n in codes.values())
        self.mask = (1 << self.bits) - 1
        self.table = np.zeros(1 << self.bits, np.int32)
        for s, (code, n) in codes.items():
            self.table[code :: 1 << n] = s << 4 | n
        self.plain = self.table.tolist() if self.bits <= 8 else self.table.data
        self.lone = next(iter(codes)) if self.bits == 0 else None


class Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.end = data, 0, 8 * len(data)

    def read(self, n: int) -> int:
        at = self.at
        if at + n > self.end:
            raise ValueError("the image is cut short")
        self.at = at + n
        return int.from_bytes(self.data[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7) & ((1 << n) - 1)

    def symbol(self, code: Code) -> int:
        at = self.at
        got = code.plain[int.from_bytes(self.data[at >> 3 : (at >> 3) + 3], "little") >> (at & 7) & code.mask]
        self.at = at + (got & 15)
        if self.at > self.end:
            raise ValueError("the image is cut short")
        return got >> 4


def read_code(bits: Bits, size: int) -> Code:
    lengths = [0] * size
    if bits.read(1):  # one or two symbols
        two, wide = bits.read(1), bits.read(1)
        for s in [bits.read(8 if wide else 1), *([bits.read(8)] if two else [])]:
            if s >= size:
                raise ValueError("a symbol outside its alphabet")
            lengths[s] = 1
        return Code(lengths)
    order = [0] * 19
    for k in LENGTH_ORDER[: 4 + bits.read(4)]:
        order[k] = bits.read(3)
    code = Code(order)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else size
    at, last = 0, 8
    while at < size and left:
        left -= 1
        s = bits.symbol(code)
        if s < 16:
            lengths[at] = s
            at += 1
            last = s or last
            continue
        value, n = (last, 3 + bits.read(2)) if s == 16 else (0, 3 + bits.read(3)) if s == 17 else (0, 11 + bits.read(7))
        if at + n > size:
            raise ValueError("code lengths run over their alphabet")
        lengths[at : at + n] = [value] * n
        at += n
    return Code(lengths)


def _distance(code: int, width: int) -> int:
    if code > 120:
        return code - 120
    x, y = near_distances()[code - 1]
    return max(1, x + y * width)


def _pixels_by_token(bits: Bits, groups: list, group_of, width: int, n: int, cache_bits: int) -> np.ndarray:
    out, shift = [0] * n, 32 - cache_bits
    cache = [0] * (1 << cache_bits) if cache_bits else []
    at = 0
    while at < n:
        green, red, blue, alpha, far = groups[group_of(at)]
        s = bits.symbol(green)
        first = at
        if s < LITERALS:
            r, b, a = bits.symbol(red), bits.symbol(blue), bits.symbol(alpha)
            out[at] = a << 24 | r << 16 | s << 8 | b
            at += 1
        elif s < LITERALS + LENGTHS:
            length = base_value(s - LITERALS) + bits.read(extra_bits(s - LITERALS))
            d = bits.symbol(far)
            back = _distance(base_value(d) + bits.read(extra_bits(d)), width)
            if back > at or at + length > n:
                raise ValueError("a back-reference leaves the image")
            for k in range(at, at + length):
                out[k] = out[k - back]
            at += length
        else:
            out[at] = cache[s - LITERALS - LENGTHS]
            at += 1
        if cache_bits:
            for v in out[first:at]:
                cache[(CACHE_FACTOR * v & 0xFFFFFFFF) >> shift] = v
    return np.array(out, np.uint32)


@lru_cache(maxsize=1)
def _length_tables() -> tuple[np.ndarray, np.ndarray]:
    """Extra bits and base of each green symbol below LITERALS + LENGTHS; 0 and 1 for literals."""
    extra = np.zeros(LITERALS + LENGTHS, np.int64)
    base = np.ones(LITERALS + LENGTHS, np.int64)
    for k in range(LENGTHS):
        extra[LITERALS + k], base[LITERALS + k] = extra_bits(k), base_value(k)
    return extra, base


def _pixels_by_array(bits: Bits, group: list[Code], width: int, n: int) -> np.ndarray:
    green, red, blue, alpha, far = group
    data = np.frombuffer(bits.data, np.uint8)
    extra, base = _length_tables()
    far_extra = np.array([extra_bits(k) for k in range(DISTANCES)])
    plain = red.lone is not None and blue.lone is not None and alpha.lone is not None and far.lone is not None
    out, at = np.empty(n, np.uint32), 0
    if plain:  # a token's size depends on its green symbol alone
        sizes = (green.table & 15) + extra[green.table >> 4] + np.where(green.table >> 4 >= LITERALS, extra_bits(far.lone), 0)
        rest = alpha.lone << 24 | red.lone << 16 | blue.lone
    while at < n:
        byte = bits.at >> 3
        part = np.zeros(min(WINDOW_BYTES, len(data) - byte) + 12, np.uint32)
        m = len(part) - 12
        if m <= 0:
            raise ValueError("the image is cut short")
        have = data[byte : byte + m + 12]
        part[: len(have)] = have
        three = part[:-2] | part[1:-1] << 8 | part[2:] << 16
        peek = (three[:, None] >> np.arange(8, dtype=np.uint32)).ravel() & 0x7FFF
        size = 8 * m
        here = np.arange(size)
        if plain:
            after = here + sizes[peek[:size] & green.mask]
        else:
            def step(p, code):
                return code.table[peek[p] & code.mask]

            g = step(here, green)
            s, p = g >> 4, here + (g & 15)
            lit = p + (step(p, red) & 15)
            lit = lit + (step(lit, blue) & 15)
            lit = lit + (step(lit, alpha) & 15)
            ref = p + extra[s]
            d = step(ref, far)
            after = np.where(s < LITERALS, lit, ref + (d & 15) + far_extra[d >> 4])
        hop = [np.append(np.minimum(after, size), size)]  # the window's end points at itself
        for _ in range(3):
            hop.append(hop[-1][hop[-1]])
        far_hop, p, starts = hop[3].astype(np.int32).data, bits.at & 7, []
        limit = n - at  # a token makes a pixel at least
        while p < size and len(starts) * 8 < limit:
            starts.append(p)
            p = far_hop[p]
        s = np.array(starts, np.int64)
        for k in (2, 1, 0):
            s = np.stack([s, hop[k][s]], axis=1).ravel()
        s = s[: np.searchsorted(s, size)][:limit]
        g = green.table[peek[s] & green.mask]
        sym = g >> 4
        refs = np.flatnonzero(sym >= LITERALS)
        if plain:
            pixels = (sym.astype(np.uint32) << 8) | np.uint32(rest)
        else:
            p = s + (g & 15)
            r = red.table[peek[p] & red.mask]
            p = p + (r & 15)
            b = blue.table[peek[p] & blue.mask]
            p = p + (b & 15)
            a = alpha.table[peek[p] & alpha.mask]
            pixels = (a >> 4).astype(np.uint32) << 24 | (r >> 4).astype(np.uint32) << 16 | sym.astype(np.uint32) << 8 | (b >> 4).astype(np.uint32)
        done, stop = 0, len(s)
        for k in refs.tolist():
            if at + k - done >= n:
                stop = k
                break
            run = k - done
            out[at : at + run] = pixels[done:k]
            at, done = at + run, k + 1
            bits.at = 8 * byte + int(s[k]) + int(g[k] & 15)
            length = int(base[sym[k]]) + bits.read(int(extra[sym[k]]))
            dist = bits.symbol(far)
            back = _distance(base_value(dist) + bits.read(extra_bits(dist)), width)
            if back > at or at + length > n:
                raise ValueError("a back-reference leaves the image")
            while length:  # an overlapping copy repeats what it has copied
                take = min(length, back)
                out[at : at + take] = out[at - back : at - back + take]
                at, length, back = at + take, length - take, back + take
        run = min(stop - done, n - at)
        out[at : at + run] = pixels[done : done + run]
        at += run
        last = done + run - 1
        bits.at = 8 * byte + int(after[s[last]])
    if bits.at > bits.end:
        raise ValueError("the image is cut short")
    return out


def _read_pixels(bits: Bits, width: int, height: int, main: bool, by_array: bool = True) -> np.ndarray:
    cache_bits = bits.read(4) if bits.read(1) else 0
    if not 0 <= cache_bits <= 11:
        raise ValueError("bad colour cache")
    groups_at = None
    n_groups, block = 1, 0
    if main and bits.read(1):
        block = bits.read(3) + 2
        across = _parts(width, block)
        groups_at = (_read_pixels(bits, across, _parts(height, block), False, by_array) >> 8 & 0xFFFF).tolist()
        n_groups = max(groups_at) + 1
    sizes = (LITERALS + LENGTHS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCES)
    groups = [[read_code(bits, k) for k in sizes] for _ in range(n_groups)]
    if groups_at is None and not cache_bits and by_array:
        return _pixels_by_array(bits, groups[0], width, width * height)
    find = (lambda at: 0) if groups_at is None else (lambda at: groups_at[(at // width >> block) * across + (at % width >> block)])
    return _pixels_by_token(bits, groups, find, width, width * height, cache_bits)


def _channels(v: int) -> tuple[int, int, int, int]:
    return v >> 24, v >> 16 & 255, v >> 8 & 255, v & 255


def _average(a, b):
    return tuple((x + y) >> 1 for x, y in zip(a, b))


def _clamp(v: int) -> int:
    return 0 if v < 0 else 255 if v > 255 else v


def _half(v: int) -> int:
    return -(-v >> 1) if v < 0 else v >> 1  # towards zero


def predict(mode: int, left, top, right, corner):
    """The predicted channels; right is the pixel above to the right, corner the one above to the left."""
    if mode == 1:
        return left
    if mode == 2:
        return top
    if mode == 3:
        return right
    if mode == 4:
        return corner
    if mode == 5:
        return _average(_average(left, right), top)
    if mode == 6:
        return _average(left, corner)
    if mode == 7:
        return _average(left, top)
    if mode == 8:
        return _average(corner, top)
    if mode == 9:
        return _average(top, right)
    if mode == 10:
        return _average(_average(left, corner), _average(top, right))
    if mode == 11:
        to_left = sum(abs(t - c) for t, c in zip(top, corner))
        to_top = sum(abs(x - c) for x, c in zip(left, corner))
        return left if to_left < to_top else top
    if mode == 12:
        return tuple(_clamp(x + t - c) for x, t, c in zip(left, top, corner))
    if mode == 13:
        return tuple(_clamp(m + _half(m - c)) for m, c in zip(_average(left, top), corner))
    return (255, 0, 0, 0)


def predictions(mode_at, pixels: list, width: int, at: int):
    """The prediction for pixel `at` from the pixels before it."""
    x, y = at % width, at // width
    if y == 0:
        return pixels[at - 1] if x else (255, 0, 0, 0)
    if x == 0:
        return pixels[at - width]
    return predict(mode_at(x, y), pixels[at - 1], pixels[at - width], pixels[at - width + 1], pixels[at - width - 1])


def _unpredict(argb: np.ndarray, width: int, block: int, modes: np.ndarray) -> np.ndarray:
    across = _parts(width, block)
    mode = (modes >> 8 & 15).tolist()
    find = lambda x, y: mode[(y >> block) * across + (x >> block)]
    out: list = []
    for at, v in enumerate(argb.tolist()):
        p = predictions(find, out, width, at)
        out.append(tuple((c + q) & 255 for c, q in zip(_channels(v), p)))
    a = np.array(out, np.uint32)
    return a[:, 0] << 24 | a[:, 1] << 16 | a[:, 2] << 8 | a[:, 3]


def _signed(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) & 255 ^ 128) - 128


def cross(argb: np.ndarray, width: int, block: int, factors: np.ndarray, sign: int) -> np.ndarray:
    """The cross-colour transform (sign -1) or its inverse (1)."""
    at = np.arange(len(argb))
    f = factors[(at // width >> block) * _parts(width, block) + (at % width >> block)]
    to_red, green_blue, red_blue = _signed(f), _signed(f >> 8), _signed(f >> 16)
    green, red, blue = _signed(argb >> 8), (argb >> 16 & 255).astype(np.int64), (argb & 255).astype(np.int64)
    new_red = (red + sign * (to_red * green >> 5)) & 255
    true_red = new_red if sign > 0 else red
    blue = (blue + sign * ((green_blue * green >> 5) + (red_blue * _signed(true_red) >> 5))) & 255
    return (argb & np.uint32(0xFF00FF00)) | new_red.astype(np.uint32) << 16 | blue.astype(np.uint32)


def add_green(argb: np.ndarray, sign: int = 1) -> np.ndarray:
    green = argb >> 8 & 255
    red, blue = (argb >> 16) + np.uint32(sign & 0xFFFFFFFF) * green & 255, argb + np.uint32(sign & 0xFFFFFFFF) * green & 255
    return (argb & np.uint32(0xFF00FF00)) | red << 16 | blue


def palette_bits(size: int) -> int:
    return 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0


def _unindex(argb: np.ndarray, width: int, height: int, table: np.ndarray) -> np.ndarray:
    bits = palette_bits(len(table))
    per, depth = 1 << bits, 8 >> bits
    rows = (argb >> 8 & 255).reshape(height, -1)
    index = (rows[:, :, None] >> (np.arange(per, dtype=np.uint32) * depth) & ((1 << depth) - 1)).reshape(height, -1)[:, :width].ravel()
    full = np.zeros(256, np.uint32)
    full[: len(table)] = table
    return full[index]


def decode_chunk(data: bytes, by_array: bool = True) -> tuple[int, int, np.ndarray]:
    """(width, height, ARGB pixels) of a VP8L chunk's payload."""
    bits = Bits(data)
    if bits.read(8) != 0x2F:
        raise ValueError("not a lossless image")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("unknown version")
    undo, now = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in [u[0] for u in undo]:
            raise ValueError("a transform is repeated")
        if kind in (PREDICTOR, CROSS_COLOUR):
            block = bits.read(3) + 2
            undo.append((kind, now, block, _read_pixels(bits, _parts(now, block), _parts(height, block), False, by_array)))
        elif kind == PALETTE:
            size = bits.read(8) + 1
            steps = _read_pixels(bits, size, 1, False, by_array)
            sums = [np.cumsum(steps >> k & 255, dtype=np.uint32) & 255 for k in (24, 16, 8, 0)]
            undo.append((kind, now, 0, sums[0] << 24 | sums[1] << 16 | sums[2] << 8 | sums[3]))
            now = _parts(now, palette_bits(size))
        else:
            undo.append((kind, now, 0, None))
    argb = _read_pixels(bits, now, height, True, by_array)
    for kind, w, block, extra in reversed(undo):
        if kind == PREDICTOR:
            argb = _unpredict(argb, w, block, extra)
        elif kind == CROSS_COLOUR:
            argb = cross(argb, w, block, extra, 1)
        elif kind == SUBTRACT_GREEN:
            argb = add_green(argb)
        else:
            argb = _unindex(argb, w, height, extra)
    return width, height, argb


def decode(file: bytes, by_array: bool = True) -> tuple[int, int, np.ndarray]:
    """(width, height, ARGB pixels) of a simple lossless WebP file; a broken file raises ValueError."""
    if len(file) < 20 or file[:4] != b"RIFF" or file[8:16] != b"WEBPVP8L":
        raise ValueError("not a lossless WebP file")
    size = int.from_bytes(file[16:20], "little")
    if len(file) < 20 + size:
        raise ValueError("the file is cut short")
    return decode_chunk(file[20 : 20 + size], by_array)


def container(chunk: bytes) -> bytes:
    body = b"WEBPVP8L" + struct.pack("<I", len(chunk)) + chunk + b"\0" * (len(chunk) & 1)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def code_lengths(counts: list[int]) -> list[int]:
    """Lengths (15 at most) of a Huffman code for the symbols with counts; two symbols at least get one."""
    while True:
        heap = [(n, s, None) for s, n in enumerate(counts) if n]
        for s in range(len(counts)):
            if len(heap) >= 2:
                break
            if not counts[s]:
                heap.append((0, s, None))
        heapq.heapify(heap)
        key = len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], key, (a, b)))
            key += 1
        lengths, todo = [0] * len(counts), [(heap[0], 0)]
        while todo:
            (_, s, sub), depth = todo.pop()
            if sub is None:
                lengths[s] = depth
            else:
                todo += [(sub[0], depth + 1), (sub[1], depth + 1)]
        if max(lengths) <= MAX_BITS:
            return lengths
        counts = [(n + 1) >> 1 for n in counts]


class Pen:
    """Bits written from the lowest up."""

    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n


#: The encoder's code for code lengths: thirteen symbols of 4 bits and six of 5.
_HELD_LENGTHS = [4] * 13 + [5] * 6
_HELD = canonical(_HELD_LENGTHS)


def write_code(pen: Pen, lengths: list[int]) -> None:
    pen.put(0, 1)
    pen.put(15, 4)
    for k in LENGTH_ORDER:
        pen.put(_HELD_LENGTHS[k], 3)
    pen.put(0, 1)
    at, size = 0, len(lengths)
    while at < size:
        n = lengths[at]
        run = 1
        if n == 0:
            while run < 138 and at + run < size and lengths[at + run] == 0:
                run += 1
        if run >= 11:
            pen.put(*_HELD[18])
            pen.put(run - 11, 7)
        elif run >= 3:
            pen.put(*_HELD[17])
            pen.put(run - 3, 3)
        else:
            run = 1
            pen.put(*_HELD[n])
        at += run


def write_lone(pen: Pen, symbol: int) -> None:
    pen.put(0b101 if symbol > 1 else 0b001, 3)
    pen.put(symbol, 8 if symbol > 1 else 1)


def _packed(values: np.ndarray, sizes: np.ndarray, first: int) -> tuple[np.ndarray, int]:
    """32-bit words with the values at bit `first` on, one after another."""
    ends = np.cumsum(sizes) + first
    at = ends - sizes
    word, wide = at >> 5, values.astype(np.uint64) << (at & 31).astype(np.uint64)
    n = (int(ends[-1]) >> 5) + 2
    low = np.bincount(word, (wide & 0xFFFFFFFF).astype(np.float64), n)
    high = np.bincount(word + 1, (wide >> np.uint64(32)).astype(np.float64), n)
    return (low + high).astype(np.uint64).astype(np.uint32), int(ends[-1])


def encode_grey(samples: np.ndarray, width: int) -> bytes:
    """A grey picture (red, green and blue equal, opaque) as a lossless WebP file; samples: uint8, whole rows.

    Subtract-green leaves the green channel alone to be coded; a run at the end becomes a back-reference.
    """
    height = len(samples) // width
    if not 0 < height <= MAX_SIDE or height * width != len(samples) or width > MAX_SIDE:
        raise ValueError("bad picture size")
    other = np.flatnonzero(samples[:-4097:-1] != samples[-1])
    run = int(other[0]) if len(other) else min(len(samples), 4096)
    run = run - 1 if run > 8 else 0  # copied after one literal
    literal = samples[: len(samples) - run]
    counts = np.bincount(literal, minlength=LITERALS + LENGTHS).tolist()
    prefix = 0
    if run:
        prefix = max(k for k in range(LENGTHS) if base_value(k) <= run)
        counts[LITERALS + prefix] = 1
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    pen = Pen()
    pen.put(0x2F, 8)
    pen.put(width - 1, 14)
    pen.put(height - 1, 14)
    pen.put(0, 4)
    pen.put(1 | SUBTRACT_GREEN << 1, 3)
    pen.put(0, 3)  # no more transforms, no cache, one group
    write_code(pen, lengths)
    for lone in (0, 0, 255, 1):  # red, blue, alpha; distance code 2 is the pixel before
        write_lone(pen, lone)
    code, size = np.zeros(LITERALS, np.uint32), np.zeros(LITERALS, np.int64)
    for s, (c, k) in codes.items():
        if s < LITERALS:
            code[s], size[s] = c, k
    words, end = _packed(code[literal], size[literal], pen.n)
    if run:
        tail = Pen()
        tail.put(*codes[LITERALS + prefix])
        tail.put(run - base_value(prefix), extra_bits(prefix))
        words = np.append(words, np.zeros(2, np.uint32))
        more = tail.value << (end & 31)
        for k in range(3):
            if (end >> 5) + k < len(words):
                words[(end >> 5) + k] |= np.uint32(more >> 32 * k & 0xFFFFFFFF)
        end += tail.n
    body = bytearray(words.astype("<u4").tobytes()[: (end + 7) >> 3])
    head = pen.value.to_bytes((pen.n + 7) >> 3, "little")
    for k, b in enumerate(head):
        body[k] |= b
    return container(bytes(body))
