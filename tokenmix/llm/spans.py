"""Cuts UTF-8 buffers into short spans and numbers equal spans, vectorised over the bytes.

Tokenising operators look at every word of a corpus but need to work only on distinct words. ``cut``
finds the spans from pairs of neighbouring byte classes, ``SpanTable.number`` gives equal spans equal
numbers through a fixed-size hash table (two slots per span, the older entry gives way). Hashes only say where to look: the
bytes of every span are compared with those under its number, all at once. Memory stays bounded and no per-word Python code runs for words already seen.
"""

from __future__ import annotations

import numpy as np

SPACE, LETTER, OTHER, APOSTROPHE, WIDE = range(5)  # WIDE: part of a character outside ASCII

CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[128:] = WIDE
CLASSES[[9, 10, 11, 12, 13, 32]] = SPACE
for _c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    CLASSES[_c] = LETTER
CLASSES[ord("'")] = APOSTROPHE

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pair_table(pairs) -> np.ndarray:
    """pairs: (left class, right class) between which a span ends."""
    t = np.zeros(25, bool)
    for a, b in pairs:
        t[a * 5 + b] = True
    return t


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer, and the len(texts)+1 offsets of the texts in it."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def blocks(texts: list[bytes], size: int = 1 << 20):
    """Slices of texts of about size bytes; a longer text is a slice of its own."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield slice(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def cut(buf: np.ndarray, offsets: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the spans with the end of the buffer after them, index of each text's first span)."""
    n = len(buf)
    mark = np.zeros(n + 1, bool)
    if n:
        c = CLASSES[buf]
        mark[1:n] = pairs[c[:-1] * np.uint8(5) + c[1:]]
    mark[offsets] = True
    starts = np.nonzero(mark)[0]
    return starts, np.searchsorted(starts, offsets)


class SpanTable:
    PERIOD = 1 << 12

    def __init__(self, bits: int = 20):
        self.bits = bits
        rng = np.random.default_rng(20240229)
        self.weights = rng.integers(1, 1 << 63, (2, self.PERIOD), np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        self.reset()

    def reset(self) -> None:
        n = 1 << self.bits
        self.count = 0
        self.h1, self.h2, self.at = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.full(n, -1, np.int32)
        self.bytes = Lists(np.uint8)

    def _hash(self, buf, starts, lens):
        pos = np.arange(len(buf), dtype=np.int64) - np.repeat(starts, lens)
        if len(pos) and int(lens.max()) > self.PERIOD:
            turn = pos // self.PERIOD  # long spans: the byte's weight also depends on how often the weights came round
            pos, extra = pos % self.PERIOD, (turn * 0x9E3779B9).astype(np.uint64)
        else:
            extra = None
        value, out = buf.astype(np.uint64) + np.uint64(1), []
        for w in self.weights:
            x = w[pos]
            if extra is not None:
                x = x ^ (extra << np.uint64(1))
            h = np.add.reduceat(value * x, starts) if len(starts) else np.zeros(0, np.uint64)
            out.append((h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15))
        return out

    def number(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """starts as from cut. The number of each span, and the spans numbered anew, from ``count`` on."""
        lens = np.diff(starts)
        ids, fresh = self._by_hash(buf, starts[:-1], lens)
        held, ends = self.bytes.take(ids)
        if len(held) == len(buf) and np.array_equal(ends, starts) and np.array_equal(held, buf):
            return ids, fresh
        # spans that only their hashes make equal: each occurrence gets a number of its own
        n = np.diff(ends)
        odd = n != lens
        same = np.nonzero(~odd)[0]
        where = np.repeat(starts[:-1][same] - ends[:-1][same], n[same])
        at = np.nonzero(np.repeat(~odd, n))[0]
        wrong = held[at] != buf[at + where]
        odd[np.repeat(same, n[same])[wrong]] = True
        odd = np.nonzero(odd)[0]
        raw = buf.tobytes()
        more = [raw[starts[i] : starts[i + 1]] for i in odd.tolist()]
        ids[odd] = np.arange(self.count, self.count + len(odd))
        self._add(more)
        return ids, fresh + more

    def _add(self, new: list[bytes]) -> None:
        self.bytes.append(np.frombuffer(b"".join(new), np.uint8), np.fromiter(map(len, new), np.int64, len(new)))
        self.count += len(new)

    def _by_hash(self, buf, starts, lens) -> tuple[np.ndarray, list[bytes]]:
        h1, h2 = self._hash(buf, starts, lens)
        s1 = (h1 >> np.uint64(64 - self.bits)).astype(np.int64)
        ids = self.at[s1].astype(np.int64)
        miss = np.nonzero((ids < 0) | (self.h1[s1] != h1) | (self.h2[s1] != h2))[0]
        if not len(miss):
            return ids, []
        s2 = (h2[miss] >> np.uint64(64 - self.bits)).astype(np.int64)
        other = self.at[s2].astype(np.int64)
        found = (other >= 0) & (self.h1[s2] == h1[miss]) & (self.h2[s2] == h2[miss])
        ids[miss] = np.where(found, other, -1)
        miss, s2 = miss[~found], s2[~found]
        if not len(miss):
            return ids, []
        order = np.lexsort((h2[miss], h1[miss]))
        a, b = h1[miss][order], h2[miss][order]
        first = np.ones(len(order), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        new = np.cumsum(first) - 1 + self.count
        ids[miss[order]] = new
        at = order[first]
        rep, slot2 = miss[at], s2[at]
        slot1, number = s1[rep], np.arange(self.count, self.count + len(rep), dtype=np.int32)
        slot = np.where(self.at[slot1] < 0, slot1, slot2)
        self.h1[slot], self.h2[slot], self.at[slot] = h1[rep], h2[rep], number
        # spans that fell on one slot: the last one written holds all three arrays consistently
        raw = buf.tobytes()
        fresh = [raw[x:y] for x, y in zip(starts[rep].tolist(), (starts[rep] + lens[rep]).tolist())]
        self._add(fresh)
        return ids, fresh


class Lists:
    """Growing store of integer lists, one per number."""

    def __init__(self, dtype=np.int32):
        self.flat, self.used = np.zeros(1 << 16, dtype), 0
        self.off, self.len, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def append(self, flat: np.ndarray, lens: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(lens) > len(self.off):
            self.off, self.len = (np.concatenate([x, np.zeros_like(x)]) for x in (self.off, self.len))
        self.flat[self.used : self.used + len(flat)] = flat
        to = slice(self.count, self.count + len(lens))
        self.len[to] = lens
        self.off[to] = self.used + np.cumsum(lens) - lens
        self.used += len(flat)
        self.count += len(lens)

    def take(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the lists one after another, cumulated lengths with a zero before them)."""
        n = self.len[ids]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        return self.flat[np.repeat(self.off[ids] - ends[:-1], n) + np.arange(ends[-1])], ends


class Cached:
    """Lists made once per distinct span. make(new spans) -> (integers one list after another, lengths).

    Forgets all spans when there are over ``limit`` of them, or their bytes or integers are over ``most``; so that is
    the bound of what is kept between calls."""

    def __init__(self, pairs, make, fold=None, limit: int = 500_000, most: int = 16 << 20, bits: int = 20, bulk: int = 1 << 17):
        self.pairs, self.make, self.fold, self.limit, self.most, self.bits, self.bulk = pairs, make, fold, limit, most, bits, bulk
        self.table = None

    def lists(self, texts: list[bytes]):
        """For slices of the texts in order: (slice, integers of its texts one after another, offsets of the texts)."""
        if self.table is None or self.table.count > self.limit or max(self.table.bytes.used, self.store.used) > self.most:
            self.table = self.store = None
            self.table, self.store = SpanTable(self.bits), Lists()
        new, found = [], []
        for part in blocks(texts):
            buf, offsets = join(texts[part])
            if self.fold is not None:
                buf = self.fold(buf)
            starts, first = cut(buf, offsets, self.pairs)
            numbers, fresh = self.table.number(buf, starts)
            new.extend(fresh)
            found.append((part, numbers.astype(np.int32), first))
        for i in range(0, len(new), self.bulk):
            self.store.append(*self.make(new[i : i + self.bulk]))
        del new
        for part, numbers, first in found:
            flat, ends = self.store.take(numbers)
            yield part, flat, ends[first]


def grouped(batches, column: int, size: int = 8 << 20):
    """Joins Arrow batches until their texts have size bytes, so that distinct spans are made in bulk."""
    import pyarrow as pa

    held, total = [], 0
    for b in batches:
        held.append(b)
        total += b.column(column).nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
    if held:
        t = pa.Table.from_batches(held)
        yield from t.combine_chunks().to_batches() if t.num_rows else held[:1]
