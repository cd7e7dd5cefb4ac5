"""Anchors of fixed-length byte windows.

The anchor of a window of ``width`` bytes is its ``k``-gram with the smallest hash (the leftmost of equal
ones), so equal windows have equal anchors at equal offsets. Consecutive windows of a text with one anchor form a
segment; any two equal windows lie in segments whose anchors have the same hash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PIECE = 1 << 18  # bytes hashed at once
_POSITION = np.uint64((1 << 20) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def grams(buf: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes from each position on; the last k-1 positions are left out."""
    h, size = _mix((buf.astype(np.uint64) + np.uint64(1)) * _M1), 1
    while size < k:
        step = min(size, k - size)
        h = h[: len(h) - step] * _M1 + h[step:]
        h = h ^ (h >> np.uint64(31))
        size += step
    return h * _M2


@dataclass
class Segments:
    """row: text of the segment; start: its first window; n: its windows; anchor: hash of its k-gram (mixed again, as the smallest hashes are all small); same: hash of all its bytes."""

    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    anchor: np.ndarray
    same: np.ndarray

    def take(self, at) -> "Segments":
        return Segments(*(getattr(self, f)[at] for f in ("row", "start", "n", "anchor", "same")))

    @staticmethod
    def joined(many: list["Segments"]) -> "Segments":
        if not many:
            return Segments(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64)))
        return Segments(*(np.concatenate([getattr(s, f) for s in many]) for f in ("row", "start", "n", "anchor", "same")))


def _pieces(texts, width: int):
    """(rows, starts in the texts, pieces): pieces of texts, overlapping by width-1 bytes, about PIECE bytes at a time."""
    rows, starts, parts, total = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - width + 1), PIECE - width + 1):
            part = t[a : a + PIECE]
            if len(part) < width:
                continue
            if total and total + len(part) > 2 * PIECE:
                yield rows, starts, parts
                rows, starts, parts, total = [], [], [], 0
            rows.append(i)
            starts.append(a)
            parts.append(part)
            total += len(part)
    if parts:
        yield rows, starts, parts


def segments(texts: list[bytes], width: int, k: int) -> Segments:
    """The segments of whole texts."""
    out = []
    for rows, starts, parts in _pieces(texts, width):
        buf = np.frombuffer(b"".join(parts), np.uint8)
        lens = np.array([len(p) for p in parts], np.int64)
        first = np.cumsum(lens) - lens
        h = grams(buf, k)
        span = width - k + 1
        low, size = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64), 1
        while size < span:
            step = min(size, span - size)
            low = np.minimum(low[: len(low) - step], low[step:])
            size += step
        at = (low & _POSITION).astype(np.int32)  # anchor of the window from each position on
        ok = np.zeros(len(at) + 1, bool)  # windows within a piece
        edge = np.zeros(len(buf) + 1, np.int8)
        edge[first] += 1
        np.add.at(edge, first + lens - width + 1, -1)
        ok[: len(at)] = np.cumsum(edge[: len(at)], dtype=np.int8) > 0
        begin = np.empty(len(at), bool)
        begin[0] = True
        np.not_equal(at[1:], at[:-1], out=begin[1:])
        begin[1:] |= ~ok[: len(at) - 1]
        begin[first[first < len(at)]] = True
        begin &= ok[: len(at)]
        s = np.nonzero(begin)[0]
        if not len(s):
            continue
        stop = np.nonzero(~ok)[0]
        n = np.minimum(np.append(s[1:], len(at)), stop[np.searchsorted(stop, s)]) - s
        which = np.searchsorted(first, s, side="right") - 1
        total = n + width - 1
        same = total.astype(np.uint64) * _M1 + (at[s] - s).astype(np.uint64)
        for off in range(0, 2 * width, k):  # k-grams that cover the segment
            same = _mix(same * _M1 + h[s + np.minimum(off, total - k)])
            if off > int(total.max()) - k:
                break
        out.append(Segments(np.array(rows, np.int64)[which], s - first[which] + np.array(starts, np.int64)[which], n, _mix(h[at[s]]), same))
    return Segments.joined(out)
