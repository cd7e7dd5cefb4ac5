"""Lossless WebP (VP8L): a decoder to pixel arrays, and encoders.

``decode_many`` handles the whole format: prefix codes (simple and normal, several groups by an entropy image),
back-references with the short-distance map, the colour cache, and the inverse predictor, cross-colour, subtract-green and
palette transforms. It decodes many files in step, vectorised over them, and is the only decoder here. ``encode`` writes any image with a choice
of these features, pixel by pixel, for tests and small images; ``store_many`` writes grey samples in bulk, with back-references, and with a
palette or predictor where these make the files smaller.
"""

from __future__ import annotations

import functools
import struct

import numpy as np

# Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS, GREEN, PALETTE = range(4)
LITERALS, LENGTHS, DISTANCES, MOST_BITS = 256, 24, 40, 15
BLACK = 0xFF000000
REVERSED = np.array([int(f"{i:08b}"[::-1], 2) for i in range(256)], np.uint8)


class WebpError(ValueError):
    pass


class Bits:
    """Reads the stream, lowest bit first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def peek(self, n: int) -> int:
        i = self.at >> 3
        return int.from_bytes(self.data[i : i + 5], "little") >> (self.at & 7) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        v = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data):
            raise WebpError("the image data ends early")
        return v


class Code:
    """A canonical prefix code as a table from the next bits to (symbol, length); reads code lengths, which are few."""

    def __init__(self, lengths: list[int]):
        used = sorted((n, s) for s, n in enumerate(lengths) if n)
        if not used:
            raise WebpError("a prefix code without symbols")
        self.most = used[-1][0] if len(used) > 1 else 0
        if self.most and sum(1 << (self.most - n) for n, _ in used) != 1 << self.most:
            raise WebpError("an incomplete prefix code")
        table = [(s, n if self.most else 0) for n, s in used for _ in range(1 << (self.most - n) if self.most else 1)]
        self.direct = [table[int(f"{k:0{self.most}b}"[::-1], 2) if self.most else 0] for k in range(1 << self.most)]


@functools.lru_cache(64)
def _code(lengths: tuple[int, ...]) -> Code:
    return Code(list(lengths))


def _read_lengths(bits: Bits, size: int) -> list[int] | int:
    """Code lengths of the symbols; of a code with one symbol only that symbol."""
    # a code length takes 14 bits at most and what stands before them 80, so all of it is in this number
    i = bits.at >> 3
    ahead, at = int.from_bytes(bits.data[i : i + 2 * size + 12], "little"), bits.at & 7
    if ahead >> at & 1:
        two, wide = ahead >> at + 1 & 1, ahead >> at + 2 & 1
        first = ahead >> at + 3 & (255 if wide else 1)
        at += 11 if wide else 4
        second = ahead >> at & 255
        bits.at = 8 * i + at + 8 * two
        if bits.at > 8 * len(bits.data):
            raise WebpError("the image data ends early")
        if not two or first == second:
            return first
        lengths = [0] * size
        lengths[first] = lengths[second] = 1
        return lengths
    n = 4 + (ahead >> at + 1 & 15)
    at += 5
    own = [0] * 19
    for k in range(n):
        own[CODE_LENGTH_ORDER[k]] = ahead >> at + 3 * k & 7
    at += 3 * n
    left = size
    if ahead >> at & 1:
        more = 2 + 2 * (ahead >> at + 1 & 7)
        left = 2 + (ahead >> at + 4 & (1 << more) - 1)
        at += 4 + more
    else:
        at += 1
    code, lengths, last = _code(tuple(own)), [], 8
    table, most, ahead = code.direct, (1 << code.most) - 1, ahead >> at
    done = 0
    while len(lengths) < size and left:
        left -= 1
        s, n = table[ahead >> done & most]
        done += n
        if s < 16:
            lengths.append(s)
            last = s or last
        else:
            value, more, least = (last, 2, 3) if s == 16 else (0, 3, 3) if s == 17 else (0, 7, 11)
            lengths += [value] * (least + (ahead >> done & (1 << more) - 1))
            done += more
            if len(lengths) > size:
                raise WebpError("too many code lengths")
    bits.at = 8 * i + at + done
    if bits.at > 8 * len(bits.data):
        raise WebpError("the image data ends early")
    used = [s for s, n in enumerate(lengths) if n]
    return used[0] if len(used) == 1 else lengths + [0] * (size - len(lengths))


def _slot(pixel: int, cache: int) -> int:
    return (0x1E35A7BD * pixel & 0xFFFFFFFF) >> (32 - cache)


def _parts(n: int, bits: int) -> int:
    return (n + (1 << bits) - 1) >> bits


class _Image:
    """An entropy-coded image whose prefix codes are read: what ``_decoded`` needs of it."""

    def __init__(self, bits: Bits, width: int, height: int, cache: int, block: int, meta: np.ndarray | None, groups: list[list[list[int]]]):
        self.bits, self.width, self.size, self.cache, self.block, self.meta, self.groups = bits, width, width * height, cache, block, meta, groups


def _image(bits: Bits, width: int, height: int, top: bool):
    """Reads what stands before the pixels; yields the _Image and is sent its pixels (ARGB numbers), which it returns."""
    cache = 0
    if bits.read(1):
        cache = bits.read(4)
        if not 1 <= cache <= 11:
            raise WebpError("no such colour cache")
    block, meta = 0, None
    if top and bits.read(1):
        block = 2 + bits.read(3)
        meta = (yield from _image(bits, _parts(width, block), _parts(height, block), False)) >> np.uint32(8) & np.uint32(0xFFFF)
    sizes = (LITERALS + LENGTHS + (cache and 1 << cache), 256, 256, 256, DISTANCES)
    groups = [[_read_lengths(bits, n) for n in sizes] for _ in range(1 if meta is None else 1 + int(meta.max()))]
    return (yield _Image(bits, width, height, cache, block, meta, groups))


@functools.lru_cache(16)
def _order(bits: int) -> np.ndarray:
    """Numbers of so many bits in the order of their bits turned round."""
    return _turned(np.arange(1 << bits), np.int64(bits))


class _Codes:
    """Prefix codes of many images: one table, in which the next bits of a code (first bit lowest) stand at its own offset."""

    def __init__(self, images: list[_Image]):
        tables, most = [], []
        self.lone: list[int | None] = []
        for lengths in (c for i in images for g in i.groups for c in g):
            if isinstance(lengths, int):
                tables.append(np.array([lengths << 4], np.uint16))
                most.append(0)
                self.lone.append(lengths)
                continue
            n = np.array(lengths, np.int64)
            used = np.nonzero(n)[0]
            if not len(used):
                raise WebpError("a prefix code without symbols")
            used = used[np.argsort(n[used], kind="stable")]
            n = n[used]
            deepest = int(n[-1])
            table = np.repeat((used << 4 | n).astype(np.uint16), 1 << (deepest - n))
            if len(table) != 1 << deepest:
                raise WebpError("an incomplete prefix code")
            tables.append(table[_order(deepest)])
            most.append(deepest)
            self.lone.append(None)
        self.table = np.concatenate(tables)
        size = np.array([len(t) for t in tables])
        self.begin, self.mask = np.cumsum(size) - size, size - 1


def _turned(value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n lowest bits of value, the other way round (n up to 24)."""
    v = value.astype(np.int64)
    whole = REVERSED[v & 255].astype(np.int64) << 16 | REVERSED[v >> 8 & 255].astype(np.int64) << 8 | REVERSED[v >> 16 & 255]
    return whole >> (24 - n)


_NEAR_X, _NEAR_Y = np.array(NEAR).T
#: Smallest length or distance of a prefix symbol, and the mask of its extra bits.
_LEAST = np.array([p + 1 if p < 4 else ((2 + (p & 1)) << ((p - 2) >> 1)) + 1 for p in range(DISTANCES)])
_EXTRA = np.array([0 if p < 4 else (p - 2) >> 1 for p in range(DISTANCES)])
_EXTRA_MASK = (1 << _EXTRA) - 1


def _decoded(images: list[_Image]) -> list[np.ndarray]:
    """The pixels of each image. All images are decoded in step, a literal, back-reference or cache symbol of each at a time."""
    data = [i.bits.data for i in images]
    begin = np.cumsum([0] + [len(d) for d in data])
    raw = np.frombuffer(b"".join(data) + bytes(8), np.uint8).astype(np.int64)
    words = raw[:-3] | raw[1:-2] << 8 | raw[2:-1] << 16 | raw[3:] << 24  # the 32 bits from each byte on
    del raw
    codes = _Codes(images)
    table, table_at, table_mask = codes.table, codes.begin, codes.mask
    size, width = np.array([i.size for i in images]), np.array([i.width for i in images])
    base = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint32)
    at = 8 * begin[:-1] + np.array([i.bits.at for i in images])
    code = 5 * (np.cumsum([len(i.groups) for i in images]) - [len(i.groups) for i in images])
    # images with one group whose literals vary in green alone, with several groups, and with a cache
    plain = np.array([len(i.groups) == 1 and None not in codes.lone[c + 1 : c + 4] for i, c in zip(images, code.tolist())])
    fixed = np.array([a << 24 | r << 16 | b if p else 0 for p, (r, b, a) in zip(plain.tolist(), ([x or 0 for x in codes.lone[c + 1 : c + 4]] for c in code.tolist()))], np.uint32)
    several, cached = np.array([i.meta is not None for i in images]), np.array([i.cache > 0 for i in images])
    all_plain, none_several, none_cached = bool(plain.all()), not several.any(), not cached.any()
    block, across = np.array([i.block for i in images]), np.array([_parts(i.width, i.block) for i in images])
    metas = [np.zeros(0, np.uint32) if i.meta is None else i.meta for i in images]
    meta, meta_at = np.concatenate(metas).astype(np.int64), np.cumsum([0] + [len(x) for x in metas])[:-1]
    slots = np.array([1 << i.cache if i.cache else 0 for i in images])
    recent, recent_at, shift = np.zeros(int(slots.sum()), np.uint32), np.cumsum(slots) - slots, np.array([32 - i.cache for i in images], np.uint64)

    def window(o):
        """At least 25 bits from bits o on."""
        return words.take(o >> 3, mode="clip") >> (o & 7)

    def symbol(c, o):
        """The next symbol of codes c at bits o, and the bits after it."""
        e = table.take(table_at.take(c) + (window(o) & table_mask.take(c)))
        return e >> 4, o + (e & 15)

    def number(prefix, o):
        """A length or distance from its prefix symbol."""
        return _LEAST.take(prefix) + (window(o) & _EXTRA_MASK.take(prefix)), o + _EXTRA.take(prefix)

    def remember(j, pixels):
        keep = cached[j]
        j, pixels = j[keep], pixels[keep]
        recent[recent_at[j] + ((pixels.astype(np.uint64) * np.uint64(0x1E35A7BD) & np.uint64(0xFFFFFFFF)) >> shift[j]).astype(np.int64)] = pixels

    # images under way; what is known of each beside; where they are in their pixels (from the first image on) and bits
    j = np.nonzero(size)[0]
    j_end, j_fixed, j_code = (base + size)[j], fixed[j], code[j]
    p, o = base[j], at[j]
    table_j, mask_j = table_at[j_code], table_mask[j_code]
    while len(j):
        c = j_code
        if none_several:
            e = table.take(table_j + (window(o) & mask_j))
            s, o = e >> 4, o + (e & 15)
        else:
            k = np.nonzero(several[j])[0]
            i = j[k]
            y, x = np.divmod(p[k] - base[i], width[i])
            c = c.copy()
            c[k] += 5 * meta[meta_at[i] + (y >> block[i]) * across[i] + (x >> block[i])]
            s, o = symbol(c, o)
        pixel = j_fixed | s.astype(np.uint32) << np.uint32(8)
        if not all_plain:
            k = np.nonzero(~plain[j] & (s < LITERALS))[0]
            parts, at_k = [], o[k]
            for part in (1, 2, 3):
                v, at_k = symbol(c[k] + part, at_k)
                parts.append(v.astype(np.uint32))
            o[k] = at_k
            pixel[k] = parts[2] << np.uint32(24) | parts[0] << np.uint32(16) | s[k].astype(np.uint32) << np.uint32(8) | parts[1]
        longer = s >= LITERALS
        k = np.nonzero(longer)[0]
        if not len(k):
            out[p] = pixel
            if not none_cached:
                remember(j, pixel)
            p = p + 1
        else:
            if not none_cached:
                x = k[s[k] >= LITERALS + LENGTHS]
                pixel[x] = recent[recent_at[j[x]] + s[x] - LITERALS - LENGTHS]
                longer[x] = False
                k = k[s[k] < LITERALS + LENGTHS]
            i = j[k]
            n, at_k = number(s[k] - LITERALS, o[k])
            d, at_k = symbol(c[k] + 4, at_k)
            d, o[k] = number(d, at_k)
            short = np.minimum(d, 120) - 1
            d = np.where(d > 120, d - 120, np.maximum(1, _NEAR_X[short] + _NEAR_Y[short] * width[i]))
            start = p[k]
            if (start - d < base[i]).any() or (start + n > j_end[k]).any():
                raise WebpError("a back-reference leaves the image")
            total = np.cumsum(n)
            off = np.arange(int(total[-1]) if len(k) else 0) - np.repeat(total - n, n)
            far = np.repeat(d, n)
            to = np.repeat(start, n)
            copied = out.take(to - far + off % far)
            out[to + off] = copied
            one = ~longer
            out[p[one]] = pixel[one]
            if not none_cached:
                remember(np.repeat(i, n), copied)
                remember(j[one], pixel[one])
            p = p + 1
            p[k] = start + n
        left = p < j_end
        if not left.all():
            at[j] = o
            j, p, o, j_end, j_fixed, j_code, table_j, mask_j = (v[left] for v in (j, p, o, j_end, j_fixed, j_code, table_j, mask_j))
    for i, a, b in zip(images, at.tolist(), begin.tolist()):
        i.bits.at = a - 8 * b
        if i.bits.at > 8 * len(i.bits.data):
            raise WebpError("the image data ends early")
    return [out[b : b + n] for b, n in zip(base.tolist(), size.tolist())]


def _channels(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _average(a, b):
    return tuple((x + y) >> 1 for x, y in zip(a, b))


def _clamp(v: int) -> int:
    return 0 if v < 0 else 255 if v > 255 else v


def _predicted(mode: int, left, top, right, corner):
    """left, top, top right and top left as channel tuples."""
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
        return tuple(_clamp(a + int((a - c) / 2)) for a, c in zip(_average(left, top), corner))
    return 255, 0, 0, 0


def _residuals(known: list[int], width: int, block: int, modes: list[int]) -> list[int]:
    """The pixels without their predictions from neighbours."""
    out, across = [0] * len(known), _parts(width, block)
    for i, p in enumerate(known):
        y, x = divmod(i, width)
        if not i:
            guess = (255, 0, 0, 0)
        elif not y:
            guess = _channels(known[i - 1])
        elif not x:
            guess = _channels(known[i - width])
        else:
            mode = modes[(y >> block) * across + (x >> block)] >> 8 & 15
            guess = _predicted(mode, *(_channels(known[i - d]) for d in (1, width, width - 1, width + 1)))
        v = [c - g & 255 for c, g in zip(_channels(p), guess)]
        out[i] = v[0] << 24 | v[1] << 16 | v[2] << 8 | v[3]
    return out


def _unpredicted(pixels: np.ndarray, width: int, height: int, block: int, modes: np.ndarray) -> np.ndarray:
    """Adds predictions to the residuals: the first row and column by sums, all else along lines x + 2 y = constant, whose pixels don't need each other."""
    out = np.stack([pixels >> np.uint32(s) & np.uint32(255) for s in (24, 16, 8, 0)], -1).astype(np.int32).reshape(height, width, 4)
    out[0, 0, 0] += 255
    out[0] = np.cumsum(out[0], axis=0) & 255
    out[:, 0] = np.cumsum(out[:, 0], axis=0) & 255
    mode = (modes >> np.uint32(8) & np.uint32(15)).astype(np.int64)
    across = _parts(width, block)
    for t in range(3, width + 2 * height - 2):
        y = np.arange(max(1, (t - width + 2) // 2), min(height - 1, (t - 1) // 2) + 1)
        x = t - 2 * y
        m = mode[(y >> block) * across + (x >> block)]
        end = x == width - 1  # to the right of the last column the current row begins
        left, top, corner = out[y, x - 1], out[y - 1, x], out[y - 1, x - 1]
        right = out[np.where(end, y, y - 1), np.where(end, 0, x + 1)]
        guess = np.zeros_like(left)
        for k in set(m.tolist()):
            some = m == k
            guess[some] = _guess(k, left[some], top[some], right[some], corner[some])
        out[y, x] = (out[y, x] + guess) & 255
    v = out.reshape(-1, 4).astype(np.uint32)
    return v[:, 0] << np.uint32(24) | v[:, 1] << np.uint32(16) | v[:, 2] << np.uint32(8) | v[:, 3]


def _guess(mode: int, left, top, right, corner):
    """The prediction of many pixels (rows of four channels) by one mode."""
    mean = lambda a, b: (a + b) >> 1
    if mode == 11:
        nearer = np.abs(top - corner).sum(1) < np.abs(left - corner).sum(1)
        return np.where(nearer[:, None], left, top)
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        a = mean(left, top)
        half = np.abs(a - corner) >> 1
        return np.clip(a + np.where(a < corner, -half, half), 0, 255)
    if 1 <= mode <= 10:
        return (left, top, right, corner, mean(mean(left, right), top), mean(left, corner), mean(left, top), mean(corner, top), mean(top, right), mean(mean(left, corner), mean(top, right)))[mode - 1]
    return np.broadcast_to(np.array([255, 0, 0, 0]), left.shape)


def _signed(v: int) -> int:
    return v - 256 if v > 127 else v


def _cross(pixels: list[int], width: int, block: int, parts: list[int]) -> list[int]:
    """The pixels with what green (and red) tells of red and blue taken off."""
    out, across = [], _parts(width, block)
    for i, p in enumerate(pixels):
        y, x = divmod(i, width)
        e = parts[(y >> block) * across + (x >> block)]
        a, r, g, b = _channels(p)
        by_green = lambda t: _signed(t) * _signed(g) >> 5
        b = (b - by_green(e >> 8 & 255) - (_signed(e >> 16 & 255) * _signed(r) >> 5)) & 255
        r = (r - by_green(e & 255)) & 255
        out.append(a << 24 | r << 16 | g << 8 | b)
    return out


def _uncrossed(pixels: np.ndarray, width: int, block: int, parts: np.ndarray) -> np.ndarray:
    y, x = np.divmod(np.arange(len(pixels)), width)
    e = parts[(y >> block) * _parts(width, block) + (x >> block)]
    byte = lambda v, s: (v >> np.uint32(s) & np.uint32(255)).astype(np.int32)
    signed = lambda v: np.where(v > 127, v - 256, v)
    g = signed(byte(pixels, 8))
    r = (byte(pixels, 16) + (signed(byte(e, 0)) * g >> 5)) & 255
    b = (byte(pixels, 0) + (signed(byte(e, 8)) * g >> 5) + (signed(byte(e, 16)) * signed(r) >> 5)) & 255
    return pixels & np.uint32(0xFF00FF00) | r.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32)


def _shift_green(pixels: list[int], sign: int) -> list[int]:
    return [p & 0xFF00FF00 | ((p >> 16 & 255) + sign * (p >> 8 & 255) & 255) << 16 | (p & 255) + sign * (p >> 8 & 255) & 255 for p in pixels]


def _with_green(pixels: np.ndarray) -> np.ndarray:
    g = pixels >> np.uint32(8) & np.uint32(255)
    return pixels & np.uint32(0xFF00FF00) | (pixels + (g << np.uint32(16)) & np.uint32(0xFF0000)) | (pixels + g & np.uint32(255))


def _add(p: int, q: int) -> int:
    return ((p & 0xFF00FF00) + (q & 0xFF00FF00) & 0xFF00FF00) | ((p & 0x00FF00FF) + (q & 0x00FF00FF) & 0x00FF00FF)


def _pack_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def _payload(file: bytes) -> bytes:
    """The VP8L data of a simple WebP file."""
    if file[:4] != b"RIFF" or file[8:12] != b"WEBP" or file[12:16] != b"VP8L":
        raise WebpError("no lossless WebP file")
    n = struct.unpack("<I", file[16:20])[0]
    if len(file) < 20 + n:
        raise WebpError("the file ends early")
    return file[20 : 20 + n]


def file_size(file: bytes, at: int = 0) -> int:
    return 8 + struct.unpack_from("<I", file, at + 4)[0]


def _file(file: bytes):
    """Reads a file up to its pixels, as ``_image`` does; returns (pixels, full width, height, transforms to undo)."""
    bits = Bits(_payload(file))
    if bits.read(8) != 0x2F:
        raise WebpError("bad signature")
    width, height = 1 + bits.read(14), 1 + bits.read(14)
    bits.read(1)
    if bits.read(3):
        raise WebpError("unknown version")
    undo, full = [], width
    while bits.read(1):
        kind = bits.read(2)
        if any(kind == k for k, *_ in undo):
            raise WebpError("a transform occurs twice")
        if kind in (PREDICTOR, CROSS):
            block = 2 + bits.read(3)
            undo.append((kind, width, block, (yield from _image(bits, _parts(width, block), _parts(height, block), False))))
        elif kind == PALETTE:
            steps = yield from _image(bits, 1 + bits.read(8), 1, False)
            undo.append((kind, width, _pack_bits(len(steps)), np.cumsum(steps[:, None].view(np.uint8).reshape(-1, 4), axis=0, dtype=np.uint8).view(np.uint32).ravel()))
            width = _parts(width, undo[-1][2])
        else:
            undo.append((kind, width, 0, None))
    return (yield from _image(bits, width, height, True)), full, height, undo


def _undone(pixels: np.ndarray, height: int, undo: list) -> np.ndarray:
    for kind, w, k, data in reversed(undo):
        if kind == PREDICTOR:
            pixels = _unpredicted(pixels, w, height, k, data)
        elif kind == CROSS:
            pixels = _uncrossed(pixels, w, k, data)
        elif kind == GREEN:
            pixels = _with_green(pixels)
        else:
            y, x = np.divmod(np.arange(w * height), w)
            bit = np.uint32(8 >> k)
            at = (pixels[y * _parts(w, k) + (x >> k)] >> np.uint32(8) & np.uint32(255)) >> (bit * (x & (1 << k) - 1).astype(np.uint32)) & np.uint32((1 << int(bit)) - 1)
            pixels = np.concatenate([data, np.zeros(256 - len(data), np.uint32)])[at]
    return pixels


def decode_many(files: list[bytes]) -> list[np.ndarray]:
    """A (height, width, 4) array of alpha, red, green and blue samples of each file. Entropy-coded images that the files have reached
    (of transforms, of prefix code groups, at last their own) are decoded together."""
    out: list = [None] * len(files)
    readers = [_file(f) for f in files]
    waiting = {k: next(r) for k, r in enumerate(readers)}
    while waiting:
        found = _decoded(list(waiting.values()))
        for k, pixels in zip(list(waiting), found):
            try:
                waiting[k] = readers[k].send(pixels)
            except StopIteration as end:
                del waiting[k]
                pixels, width, height, undo = end.value
                v = _undone(pixels, height, undo)
                out[k] = np.ascontiguousarray(v.astype(">u4")).view(np.uint8).reshape(height, width, 4)
    return out


def decode(file: bytes) -> np.ndarray:
    return decode_many([file])[0]


class _Out:
    """Bits to write, lowest first."""

    def __init__(self):
        self.value, self.n = 0, 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n


def code_lengths(counts: list[int], most: int = MOST_BITS) -> list[int]:
    """Lengths of a Huffman code of at most so many bits (two queues; flatter counts if it is deeper)."""
    used = sorted([(c, s) for s, c in enumerate(counts) if c])
    lengths = [0] * len(counts)
    if len(used) < 2:
        for _, s in used:
            lengths[s] = 1
        return lengths
    floor = 0
    while True:
        weight = [max(c, floor) for c, _ in used]
        n = len(weight)
        up, made, i, j = [0] * (2 * n - 1), [], 0, 0
        for k in range(n - 1):
            total = 0
            for _ in range(2):
                if i < n and (j >= len(made) or weight[i] <= made[j]):
                    total += weight[i]
                    up[i] = n + k
                    i += 1
                else:
                    total += made[j]
                    up[n + j] = n + k
                    j += 1
            made.append(total)
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[up[k]] + 1
        if max(depth[:n]) <= most:
            for (_, s), d in zip(used, depth):
                lengths[s] = d
            return lengths
        floor = max(2 * floor, sum(weight) >> most, 1)


def canonical(lengths: list[int]) -> list[int]:
    """The code of each symbol, first bit highest."""
    codes, code, last = [0] * len(lengths), 0, 0
    for n, s in sorted((n, s) for s, n in enumerate(lengths) if n):
        code <<= n - last
        codes[s], last = code, n
        code += 1
    return codes


#: Lengths of the code for code lengths that ``store`` and ``encode`` write: complete, 4 bits for the usual ones.
OWN_LENGTHS = [5 if s in (1, 2, 13, 14, 15, 16) else 4 for s in range(19)]
_OWN = [(int(f"{c:0{n}b}"[::-1], 2), n) for c, n in zip(canonical(OWN_LENGTHS), OWN_LENGTHS)]


#: What stands before code lengths that are written with OWN_LENGTHS: a normal code, 19 lengths of 3 bits, no limit of symbols.
_OWN_HEAD = (0 | 15 << 1 | sum(OWN_LENGTHS[s] << 5 + 3 * k for k, s in enumerate(CODE_LENGTH_ORDER)), 5 + 3 * 19 + 1)


def _put_lengths(out: _Out, lengths: list[int]) -> None:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 1 and (not used or used[0] < 256):  # one symbol takes no bits
        out.put(0b101 | (used[0] if used else 0) << 3, 11)
        return
    value, at = _OWN_HEAD
    done = 0
    for s in [*used, len(lengths)]:
        gap = s - done
        while gap >= 3:  # symbols without a code
            n = min(gap, 138)
            code, more = _OWN[17 if n < 11 else 18]
            value |= (code | (n - (3 if n < 11 else 11)) << more) << at
            at += more + (3 if n < 11 else 7)
            gap -= n
        for k in [0] * gap + ([lengths[s]] if s < len(lengths) else []):
            value |= _OWN[k][0] << at
            at += _OWN[k][1]
        done = s + 1
    out.put(value, at)


def _prefix(v: int) -> tuple[int, int, int]:
    """(prefix symbol, extra bits, their value) of a length or distance of at least 1."""
    v -= 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    return 2 * top + (v >> (top - 1) & 1), top - 1, v & ((1 << (top - 1)) - 1)


def _put_pixels(out: _Out, pixels: list[int], width: int, top: bool, cache: int = 0, references: bool = False, block: int = 0) -> None:
    """block: over 0 gives each block of 2**block by 2**block pixels one of two prefix code groups in turn."""
    out.put(1 | cache << 1, 5) if cache else out.put(0, 1)
    height, meta = len(pixels) // width, None
    if top:
        out.put(int(block > 0), 1)
        if block:
            out.put(block - 2, 3)
            w, h = _parts(width, block), _parts(height, block)
            meta = [(x + y) & 1 for y in range(h) for x in range(w)]
            if len(meta) < 2:
                meta = [0]
            _put_pixels(out, [m << 8 for m in meta], w, False)
    tokens, seen, recent, i = [], {}, [None] * (1 << cache), 0
    while i < len(pixels):
        n, d = 0, 0
        if references and i + 2 < len(pixels):
            key = tuple(pixels[i : i + 3])
            if key in seen:
                d = i - seen[key]
                while i + n < len(pixels) and n < 4096 and pixels[i + n] == pixels[i + n - d]:
                    n += 1
        p = pixels[i]
        if n >= 3:
            near = next((k for k, (x, y) in enumerate(NEAR) if max(1, x + y * width) == d), None)
            tokens.append((i, LITERALS + _prefix(n)[0], _prefix(n), _prefix(near + 1 if near is not None else d + 120)))
        elif cache and recent[_slot(p, cache)] == p:
            n = 1
            tokens.append((i, LITERALS + LENGTHS + _slot(p, cache), None, None))
        else:
            n = 1
            tokens.append((i, p >> 8 & 255, p, None))
        for k in range(i, i + n):
            if references:
                seen[tuple(pixels[k : k + 3])] = k
            if cache:
                recent[_slot(pixels[k], cache)] = pixels[k]
        i += n
    sizes = (LITERALS + LENGTHS + (cache and 1 << cache), 256, 256, 256, DISTANCES)
    count = [[[0] * n for n in sizes] for _ in range(1 + max(meta) if meta else 1)]
    of = lambda i: meta[(i // width >> block) * _parts(width, block) + (i % width >> block)] if meta else 0
    for i, s, a, b in tokens:
        c = count[of(i)]
        c[0][s] += 1
        if s < LITERALS:
            for k, shift in ((1, 16), (2, 0), (3, 24)):
                c[k][a >> shift & 255] += 1
        elif b:
            c[4][b[0]] += 1
    codes = []
    for c in count:
        own = []
        for counts in c:
            lengths = code_lengths(counts)
            used = [s for s, n in enumerate(lengths) if n]
            if len(used) == 1 and used[0] >= 256:  # such a lone symbol has no simple form: a second one completes the code
                lengths[0] = 1
            _put_lengths(out, lengths)
            lone = sum(n > 0 for n in lengths) <= 1
            own.append([(0, 0) if lone or not n else (int(f"{k:0{n}b}"[::-1], 2), n) for k, n in zip(canonical(lengths), lengths)])
        codes.append(own)
    for i, s, a, b in tokens:
        c = codes[of(i)]
        out.put(*c[0][s])
        if s < LITERALS:
            for k, shift in ((1, 16), (2, 0), (3, 24)):
                out.put(*c[k][a >> shift & 255])
        elif b:
            out.put(a[2], a[1])
            out.put(*c[4][b[0]])
            out.put(b[2], b[1])


def wrap(data: bytes) -> bytes:
    pad = len(data) & 1
    return b"RIFF" + struct.pack("<I", 12 + len(data) + pad) + b"WEBPVP8L" + struct.pack("<I", len(data)) + data + b"\0" * pad


def encode(image: np.ndarray, predictor: int | None = None, cross: tuple[int, int, int] | None = None, green: bool = False, palette: bool = False, cache: int = 0, references: bool = True, block: int = 0) -> bytes:
    """A WebP file of an image as ``decode`` gives it. predictor: a mode for all blocks, or -1 for every mode in turn."""
    height, width = image.shape[:2]
    c = image.astype(np.uint32)
    pixels = (c[..., 0] << 24 | c[..., 1] << 16 | c[..., 2] << 8 | c[..., 3]).ravel().tolist()
    out = _Out()
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    if palette:
        table = sorted(set(pixels))
        if len(table) > 256:
            raise WebpError("too many colours for a palette")
        out.put(1 | PALETTE << 1, 3)
        out.put(len(table) - 1, 8)
        step = [table[0]] + [_add(b, _add(~a & 0xFFFFFFFF, 0x01010101)) for a, b in zip(table, table[1:])]
        _put_pixels(out, step, len(table), False)
        at, k = {p: i for i, p in enumerate(table)}, _pack_bits(len(table))
        rows = []
        for y in range(height):
            for x in range(0, width, 1 << k):
                v = sum(at[p] << (8 >> k) * i for i, p in enumerate(pixels[y * width + x : y * width + min(width, x + (1 << k))]))
                rows.append(BLACK | v << 8)
        pixels, width = rows, _parts(width, k)
    if green:
        out.put(1 | GREEN << 1, 3)
        pixels = _shift_green(pixels, -1)
    if predictor is not None:
        out.put(1 | PREDICTOR << 1 | 0 << 3, 6)
        n = _parts(width, 2) * _parts(height, 2)
        modes = [BLACK | (i % 14 if predictor < 0 else predictor) << 8 for i in range(n)]
        _put_pixels(out, modes, _parts(width, 2), False)
        pixels = _residuals(pixels, width, 2, modes)
    if cross is not None:
        out.put(1 | CROSS << 1 | 0 << 3, 6)
        n = _parts(width, 2) * _parts(height, 2)
        parts = [BLACK | (cross[0] & 255) << 16 | (cross[1] & 255) << 8 | (cross[2] + i & 255) for i in range(n)]
        _put_pixels(out, parts, _parts(width, 2), False)
        pixels = _cross(pixels, width, 2, parts)
    out.put(0, 1)
    _put_pixels(out, pixels, width, True, cache, references, block)
    return wrap(out.value.to_bytes((out.n + 7) // 8, "little"))


# --- grey samples in bulk ---

WIDTH = 24
#: Shortest repetition that is looked for and that is written, longest prefix code that is written.
GRAM, SHORTEST, DEEPEST = 4, 5, 12
_NEAR_OF = np.zeros(9 * WIDTH, np.int64)
for _k, (_x, _y) in reversed(list(enumerate(NEAR))):
    _NEAR_OF[max(1, _x + _y * WIDTH)] = _k + 1


def _packed(codes: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The codes (first bit highest, up to 15 bits) one after another, as bytes of the format (lowest bit first)."""
    c, n = codes.astype(np.uint64), lens.astype(np.uint64)
    for _ in range(2):  # fours of at most 60 bits
        if len(c) & 1:
            c, n = np.append(c, np.uint64(0)), np.append(n, np.uint64(0))
        c, n = c[::2] << n[1::2] | c[1::2], n[::2] + n[1::2]
    c, n = c[n > 0], n[n > 0]
    end = np.cumsum(n)
    start = end - n
    total = int(end[-1])
    c <<= np.uint64(64) - n
    word, off = (start >> np.uint64(6)).astype(np.int64), start & np.uint64(63)
    high = c >> off
    low = np.where(off > 0, c << (np.uint64(64) - np.maximum(off, np.uint64(1))), np.uint64(0))
    first = np.nonzero(np.diff(word, prepend=-1))[0]
    words = np.zeros(int(word[-1]) + 2, np.uint64)
    words[word[first]] |= np.bitwise_or.reduceat(high, first)
    words[word[first] + 1] |= np.bitwise_or.reduceat(low, first)
    return REVERSED[words.byteswap().view(np.uint8)[: (total + 7) // 8]]


def _earlier(x: np.ndarray) -> np.ndarray:
    """For each place of x the distance to the last place before it where the same GRAM samples begin, 0 if there is none."""
    n = len(x) - GRAM + 1
    out = np.zeros(len(x), np.int32)
    if n < 2:
        return out
    low, high = (x[k : n + k].astype(np.uint16) | x[k + 1 : n + k + 1].astype(np.uint16) << np.uint16(8) for k in (0, 2))
    order = np.argsort(low, kind="stable")
    order = order[np.argsort(high[order], kind="stable")]
    gram = low.astype(np.uint32) | high.astype(np.uint32) << np.uint32(16)
    same = gram[order[1:]] == gram[order[:-1]]
    out[order[1:][same]] = (order[1:] - order[:-1])[same]
    return out


def _greens(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray, _Out, int, int]:
    """(green values to be coded, their ``_earlier``, header with the transform that is chosen, alpha of all pixels, width).

    A palette is used where it packs several samples into a pixel (at most 16 different ones), a predictor (left or top, one for the image) where
    little of the samples repeats and the entropy of the residuals is smaller by a tenth. A cross-colour transform or subtracting green have nothing to tell of samples that are
    all green, and a colour cache symbol stands for one pixel as a literal does, so neither can make these images smaller.
    """
    height, out = len(samples) // WIDTH, _Out()
    for value, bits in ((0x2F, 8), (WIDTH - 1, 14), (height - 1, 14), (0, 4)):
        out.put(value, bits)
    counts = np.bincount(samples, minlength=256)
    there = np.nonzero(counts)[0]
    if len(there) <= 16:
        k = _pack_bits(len(there))
        out.put(1 | PALETTE << 1, 3)
        out.put(len(there) - 1, 8)
        table = [BLACK | int(v) << 8 for v in there]
        _put_pixels(out, [table[0]] + [(b - a) & 0xFF00 for a, b in zip(table, table[1:])], len(table), False)
        at = np.zeros(256, np.uint8)
        at[there] = np.arange(len(there))
        grid = at[samples].reshape(height, WIDTH)
        packed = np.zeros((height, _parts(WIDTH, k)), np.uint8)
        for i in range(1 << k):
            part = grid[:, i :: 1 << k]
            packed[:, : part.shape[1]] |= part << np.uint8((8 >> k) * i)
        return packed.ravel(), _earlier(packed.ravel()), out, 255, _parts(WIDTH, k)
    earlier = _earlier(samples)
    if 4 * np.count_nonzero(earlier) > len(samples):
        return samples, earlier, out, 255, WIDTH
    best, cost = None, 0.9 * _entropy(counts)
    grid = samples.reshape(height, WIDTH)
    for mode in (1, 2):
        less = np.empty_like(grid)
        if mode == 1:
            less[:, 1:] = grid[:, 1:] - grid[:, :-1]
        else:
            less[1:, 1:] = grid[1:, 1:] - grid[:-1, 1:]
            less[0, 1:] = grid[0, 1:] - grid[0, :-1]
        less[1:, 0] = grid[1:, 0] - grid[:-1, 0]
        less[0, 0] = grid[0, 0]
        if (e := _entropy(np.bincount(less.ravel(), minlength=256))) < cost:
            best, cost = (mode, less.ravel()), e
    if best:
        out.put(1 | PREDICTOR << 1 | 7 << 3, 6)  # blocks of 512
        _put_pixels(out, [BLACK | best[0] << 8] * _parts(height, 9), 1, False)
        return best[1], _earlier(best[1]), out, 0, WIDTH
    return samples, earlier, out, 255, WIDTH


def _entropy(counts: np.ndarray) -> float:
    n = counts[counts > 0]
    return float((n * (np.log2(n.sum()) - np.log2(n))).sum())


def store_many(many: list[np.ndarray]) -> list[bytes]:
    """One image of each array of samples (a multiple of WIDTH): they are its green values, red and blue are 0, alpha is 255."""
    chosen = [_greens(x) for x in many]
    flat = np.concatenate([g for g, *_ in chosen])
    size = np.array([len(g) for g, *_ in chosen])
    base = np.cumsum(size) - size
    distance = np.concatenate([e for _, e, *_ in chosen])
    # lengths: as long as the same distance goes on, the samples are the same
    cut = np.nonzero(np.diff(distance, append=-1))[0]
    here = np.arange(len(flat), dtype=np.int32)
    n = np.where(distance > 0, np.repeat(cut.astype(np.int32), np.diff(cut, prepend=-1)) - here + np.int32(GRAM), np.int32(1))
    n = np.where(n >= SHORTEST, np.minimum(n, np.int32(4096)), np.int32(1))
    # greedy: from the first place on, each token leads to the next; all images in step
    end = base + size
    begins = np.zeros(len(flat) + 1, bool)
    at, stop = base.copy(), end
    following = here + n
    while len(at):
        begins[at] = True
        at = following[at]
        if (at >= stop).any():
            left = at < stop
            at, stop = at[left], stop[left]
    token = np.nonzero(begins[:-1])[0]
    image = np.repeat(np.arange(len(many)), np.add.reduceat(begins[:-1], base, dtype=np.int64))
    n = n[token]
    long = n > 1
    green = flat[token].astype(np.int64)
    prefix, extra, more = _prefixes(n[long].astype(np.int64))
    green[long] = LITERALS + prefix
    d = distance[token[long]].astype(np.int64)
    del distance, following, here, begins, flat
    # distances along and across the image's own rows; these are WIDTH wide unless a palette packs them
    wide = np.array([w for *_, w in chosen]) == WIDTH
    near = np.where(wide[image[long]] & (d < len(_NEAR_OF)), _NEAR_OF[np.minimum(d, len(_NEAR_OF) - 1)], 0)
    far_prefix, far_extra, far_more = _prefixes(np.where(near > 0, near, d + 120))
    counts = np.bincount(image * 280 + green, minlength=280 * len(many)).reshape(-1, 280)
    far_counts = np.bincount(image[long] * DISTANCES + far_prefix, minlength=DISTANCES * len(many)).reshape(-1, DISTANCES)
    codes, lens = np.zeros((len(many), 280), np.int64), np.zeros((len(many), 280), np.int64)
    far_codes, far_lens = np.zeros((len(many), DISTANCES), np.int64), np.zeros((len(many), DISTANCES), np.int64)
    heads, head_lens = [], []
    for i, (_, _, out, alpha, _) in enumerate(chosen):
        out.put(0, 1)  # no more transform
        out.put(0, 2)  # no cache, one group
        _put_code(out, counts[i], codes[i], lens[i])
        for s in (0, 0, alpha):  # red, blue, alpha: one symbol each
            out.put(0b101 | s << 3, 11)
        _put_code(out, far_counts[i], far_codes[i], far_lens[i])
        raw = np.frombuffer(out.value.to_bytes((out.n + 7) // 8, "little"), np.uint8)
        bits = np.full(len(raw), 8)
        bits[-1] = (out.n - 1) % 8 + 1
        heads.append(REVERSED[raw].astype(np.int64) >> (8 - bits))
        head_lens.append(bits)
    # all files' bits at once: heads, then a symbol per token (of repetitions five parts), then what fills the last byte
    parts = np.where(long, 5, 1)
    per = np.bincount(image, parts, len(many)).astype(np.int64)
    begin = np.cumsum([0] + [len(h) + k + 1 for h, k in zip(heads, per.tolist())])
    all_codes, all_lens = np.zeros(begin[-1], np.int64), np.zeros(begin[-1], np.int64)
    for b, h, hl in zip(begin.tolist(), heads, head_lens):
        all_codes[b : b + len(h)], all_lens[b : b + len(h)] = h, hl
    first = np.cumsum(parts) - parts
    first += (begin[:-1] + [len(h) for h in heads] - (np.cumsum(per) - per))[image]
    all_codes[first], all_lens[first] = codes[image, green], lens[image, green]
    x, i = first[long], image[long]
    high = far_extra // 2  # up to 18 bits: in two parts, the lower bits first
    low = far_extra - high
    for k, (c, b) in enumerate(((_turned(more, extra), extra), (far_codes[i, far_prefix], far_lens[i, far_prefix]), (_turned(far_more & (1 << low) - 1, low), low), (_turned(far_more >> low, high), high)), 1):
        all_codes[x + k], all_lens[x + k] = c, b
    total = np.add.reduceat(all_lens, begin[:-1])
    all_lens[begin[1:] - 1] = -total % 8
    edge = np.cumsum((total + 7) // 8)
    raw = _packed(all_codes, all_lens).tobytes()
    return [wrap(raw[a:b]) for a, b in zip([0, *edge.tolist()], edge.tolist())]


def _prefixes(v: np.ndarray):
    """(prefix symbol, extra bits, their value) of lengths or distances of at least 1."""
    v = v - 1
    top = np.floor(np.log2(np.maximum(v, 1) + 0.5)).astype(np.int64)
    small = v < 4
    extra = np.where(small, 0, top - 1)
    return np.where(small, v, 2 * top + (v >> np.maximum(top - 1, 0) & 1)), extra, np.where(small, 0, v & (1 << extra) - 1)


def _put_code(out: _Out, counts: np.ndarray, codes: np.ndarray, lens: np.ndarray) -> None:
    """Writes a code for the counts and notes it in codes and lens (none for a lone symbol, which takes no bits)."""
    lengths = code_lengths(counts.tolist(), DEEPEST)
    used = np.nonzero(counts)[0]
    if len(used) == 1 and used[0] >= 256:  # such a lone symbol has no simple form: a second one completes the code
        lengths[0] = 1
    _put_lengths(out, lengths)
    if sum(n > 0 for n in lengths) > 1:
        codes[:], lens[:] = canonical(lengths), lengths


def load_many(files: list[bytes]) -> list[np.ndarray]:
    """The green samples of each image."""
    return [image[..., 2].ravel() for image in decode_many(files)]
