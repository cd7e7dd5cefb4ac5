"""Column-wise construction of the Burrows-Wheeler transform and common prefixes of many strings.

Each round inserts one symbol of every string, from the right: round r adds the suffix of length r of each string that has one,
at the place that the rank of its first symbol in the transform so far gives, and the length of its common prefix with its
neighbours from the smallest common prefix between the two equal symbols in the transform.

Transform and prefixes (with the suffix that each entry belongs to) are one file of eight bytes an entry, in the folder that the caller
names, which may be in any shared store. A round reads the file from front to back twice, ``CHUNK`` entries at a time (once for the ranks and
smallest prefixes, once to merge), and writes its successor from front to back; nothing is read out of order. In memory are a chunk, the strings
and a few numbers per string and symbol.

Work is the product of the collection's bytes and the longest string, so callers pass bounded strings.
"""

from __future__ import annotations

import uuid

import numpy as np

from .common import open_fs

CHUNK = 1 << 17
#: Bits of an entry, from the left: string, start, symbol, common prefix.
_STRING, _START, _SYMBOL, _COMMON = (np.uint64(x) for x in (24, 15, 9, 16))
_START_AT, _STRING_AT = _SYMBOL + _COMMON, _START + _SYMBOL + _COMMON
_SYMBOLS, _COMMONS = np.uint64((1 << 9) - 1), np.uint64((1 << 16) - 1)
_FAR = 1 << 20


class Tape:
    """A file of 64-bit entries that is written once and read from the front."""

    def __init__(self, folder: str):
        self.fs, base = open_fs(folder)
        self.path = f"{base}/{uuid.uuid4().hex}"
        self.sink, self.size = self.fs.open_output_stream(self.path), 0

    def add(self, entries: np.ndarray) -> None:
        self.sink.write(entries.tobytes())
        self.size += len(entries)

    def end(self) -> "Tape":
        self.sink.close()
        return self

    def reader(self):
        return self.fs.open_input_stream(self.path)

    def chunks(self, size: int):
        with self.reader() as source:
            for x in range(0, self.size, size):
                yield x, np.frombuffer(source.read(8 * min(size, self.size - x)), np.uint64)

    def drop(self) -> None:
        self.fs.delete_file(self.path)


class Collection:
    """An entry per suffix (the empty ones too), in order: the symbol before it (0: the string begins there), its common
    prefix with the one before it, its string and start."""

    def __init__(self, flat: np.ndarray, lens: np.ndarray, folder: str, chunk: int | None = None):
        """flat: bytes of the strings one after another; folder: where the files go, a URL."""
        self.lens, self.chunk = lens.astype(np.int64), chunk or CHUNK
        self.ends = np.cumsum(self.lens)
        if len(lens) >= 1 << int(_STRING) or len(lens) and self.lens.max() >= 1 << int(_START):
            raise ValueError("too many or too long strings for one collection")
        self.fs, base = open_fs(folder)
        self.fs.create_dir(base, recursive=True)
        used = np.zeros(256, bool)
        used[flat] = True
        number = np.zeros(256, np.uint16)
        number[used] = np.arange(1, used.sum() + 1)
        self.symbols, self.sigma = number[flat], int(used.sum()) + 1
        self.type = np.uint8 if self.sigma <= 256 else np.uint16
        self.folder = folder
        self.tape = self._built()

    def _built(self) -> Tape:
        m = len(self.lens)
        live = np.nonzero(self.lens > 0)[0]
        first = np.zeros(m, np.uint64)
        first[live] = self.symbols[self.ends[live] - 1]
        tape = Tape(self.folder)
        tape.add(np.arange(m, dtype=np.uint64) << _STRING_AT | self.lens.astype(np.uint64) << _START_AT | first << _COMMON)
        tape.end()
        total = np.bincount(first.astype(np.int64), minlength=self.sigma)
        at, begun = live, first[live].astype(np.int64)  # places of the strings' longest suffixes so far, rising; their symbols
        for r in range(1, (int(self.lens.max()) if m else 0) + 1):
            head = m + np.cumsum(total) - total - total[0]  # places of the first suffix that begins with each symbol
            which, new, before, changed, common = self._ranks(tape, at, head)
            live = live[which]
            left = self.lens[live] >= r + 1
            begun = np.zeros(len(live), np.int64)
            begun[left] = self.symbols[self.ends[live[left]] - 1 - r]
            entries = live.astype(np.uint64) << _STRING_AT | (self.lens[live] - r).astype(np.uint64) << _START_AT | begun.astype(np.uint64) << _COMMON | before.astype(np.uint64)
            grown = self._merged(tape, new, entries, changed, common)
            tape.drop()
            tape = grown
            total = total + np.bincount(begun, minlength=self.sigma)
            live, at = live[left], new[left]
        return tape

    def _ranks(self, tape: Tape, at: np.ndarray, head: np.ndarray):
        """One pass over the entries. at: places of those to be continued (rising). Returns, by rising new place: which of them, their new
        places and common prefixes with the suffix before; and (place, common prefix) of suffixes whose one before is new."""
        seen, least, marked = np.zeros(self.sigma, np.int64), np.full(self.sigma, _FAR, np.int64), np.zeros(self.sigma, bool)
        out, lo = [], 0
        for x, e in tape.chunks(self.chunk):
            n = len(e)
            symbol, common = (e >> _COMMON & _SYMBOLS).astype(self.type), (e & _COMMONS).astype(np.uint16)
            hi = lo + int(np.searchsorted(at[lo:], x + n))
            mine = at[lo:hi] - x
            mark = np.zeros(n, bool)
            mark[mine] = True
            count = np.bincount(symbol, minlength=self.sigma)
            order = np.argsort(symbol, kind="stable")[count[0] :]
            inside = np.cumsum(count) - count - count[0]  # where a symbol's group begins in order
            there = np.nonzero(count)[0]
            there = there[there > 0]
            # those that are marked, and those behind a marked one with the same symbol
            wanted = np.zeros(len(order) + 1, bool)
            wanted[:-1] = mark[order]
            hit = np.nonzero(wanted)[0]
            wanted[hit + 1] = True
            wanted[inside[there]] = marked[there] | mark[order[inside[there]]]
            q = np.nonzero(wanted[:-1])[0]
            p = order[q]
            sq = symbol[p].astype(np.int64)
            rank = q - inside[sq]
            value = np.zeros(len(q), np.int64)
            near = rank > 0  # the entry before with the same symbol is in this chunk
            value[near] = self._least(common, order[q[near] - 1] + 1, p[near] + 1) + 1
            far = ~near & (seen[sq] > 0)
            if far.any():
                value[far] = np.minimum(least[sq[far]], np.minimum.accumulate(common)[p[far]]) + 1
            is_new = mark[p]
            out.append((lo + np.searchsorted(mine, p), head[sq] + seen[sq] + rank, value, is_new))
            lo = hi
            if x + n < tape.size:  # what the next chunk has to know of each symbol
                tail = np.append(np.minimum.accumulate(common[::-1])[::-1].astype(np.int64), _FAR)
                last = order[inside[there] + count[there] - 1]
                least = np.minimum(least, tail[0])
                least[there], marked[there] = tail[last + 1], mark[last]
                seen += count
        number, place, value, is_new = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        by = np.argsort(place, kind="stable")
        number, place, value, is_new = number[by], place[by], value[by], is_new[by]
        return number[is_new], place[is_new], value[is_new], place[~is_new], value[~is_new]

    def _merged(self, tape: Tape, new: np.ndarray, entries: np.ndarray, changed: np.ndarray, common: np.ndarray) -> Tape:
        """The file with entries at the places new, and other common prefixes at the places changed."""
        grown = Tape(self.folder)
        total, a, c = tape.size + len(new), 0, 0
        with tape.reader() as source:
            for y in range(0, total, self.chunk):
                n = min(self.chunk, total - y)
                b, d = a + int(np.searchsorted(new[a:], y + n)), c + int(np.searchsorted(changed[c:], y + n))
                old = np.ones(n, bool)
                old[new[a:b] - y] = False
                out = np.empty(n, np.uint64)
                out[old] = np.frombuffer(source.read(8 * (n - (b - a))), np.uint64)
                out[new[a:b] - y] = entries[a:b]
                i = changed[c:d] - y
                out[i] = out[i] & ~_COMMONS | common[c:d].astype(np.uint64)
                grown.add(out)
                a, c = b, d
        return grown.end()

    @staticmethod
    def _least(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The smallest of values[start:stop] for each pair; start < stop."""
        if not len(start):
            return np.zeros(0, np.int64)
        by = np.argsort(-start, kind="stable")  # falling starts, so that what lies between two ranges costs nothing
        pairs = np.empty(2 * len(by), np.int64)
        pairs[::2], pairs[1::2] = start[by], stop[by]
        if (pairs >= len(values)).any():
            values = np.append(values, np.iinfo(values.dtype).max)
        out = np.empty(len(by), np.int64)
        out[by] = np.minimum.reduceat(values, pairs)[::2]
        return out

    def entries(self):
        """(string, start, symbol, common prefix) of all suffixes in order, a chunk at a time."""
        for _, e in self.tape.chunks(self.chunk):
            yield (e >> _STRING_AT).astype(np.int64), (e >> _START_AT & np.uint64((1 << int(_START)) - 1)).astype(np.int64), (e >> _COMMON & _SYMBOLS).astype(np.int64), (e & _COMMONS).astype(np.int64)

    def classes(self, width: int):
        """(string, start, class) of every suffix of at least width bytes; equal classes: equal first width bytes."""
        number, out = 0, []
        for string, start, _, common in self.entries():
            kind = np.cumsum(common < width) + number
            number = int(kind[-1]) if len(kind) else number
            some = self.lens[string] - start >= width
            out.append((string[some], start[some], kind[some]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3

    def close(self) -> None:
        self.tape.drop()
