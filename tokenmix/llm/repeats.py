"""Exact removal of repeated passages: every byte covered by a ``WIDTH``-byte string that also starts earlier.

Earlier means a smaller doc_id, or the same document and an earlier start; strings are judged on the input. The
verdict on two different pieces of text comes from the Burrows-Wheeler transform and common prefixes of a multi-document
collection, built column by column in sequential files (``bcr``). That construction costs its bytes times the longest string, so it is
never given whole documents but *segments*: stretches of consecutive windows with the same anchor (``windows``), at most
2 * WIDTH bytes long. Equal windows always lie in segments with equal anchors, so:

1. documents are range partitioned by doc_id into blocks of about ``BLOCK`` bytes, written once as a table bucketed by block;
2. each block sends, per bucket of anchors, the (anchor, hash) pairs of its segments, equal segments of a block once (pre-aggregation: a
   passage that fills a third of all rows is one entry per block);
3. a bucket answers each block: nothing for an anchor that occurs once, else that the segment is to be sent, or, if the anchor has over
   ``CROWD`` different ones, that its windows are to be anchored again by longer strings (``SIZES``; at last the whole window, where all segments of an
   anchor are equal);
4. blocks send those segments' bytes to the bucket. It compares them: of equal ones the first stays and the others go. Windows of different
   segments that have no equal hash in their bucket cannot repeat; what is left is cut down to the rest, and the
   collection of that finds the classes of equal windows from the common prefixes; all but the first of each class go;
5. each block unites the windows' bytes and cuts its documents.

Hashes choose what is compared. Nothing is removed but after a comparison of bytes, or by the construction.

No task grows with the data: an anchor has at most ``CROWD`` different segments before it is anchored again, and beyond ``FAN`` blocks both the entries
(3) and the bytes (4) are merged in rounds of at most FAN blocks (of one anchor at most CROWD hashes, of equal bytes only the first, go on).

Defined cases: null text -> empty; documents under WIDTH bytes are kept whole; a null doc_id comes before all others; rows with equal doc_id are
different documents, in the order of the XXH64 of their texts; equal rows: the first of them stays, whichever; very long texts are cut into pieces when
hashed, so that memory follows the block; an empty table gives an empty result; other columns are not read (``cut_texts`` keeps them).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import windows
from .bcr import Collection
from .common import deleted, dropped, free_name, kept, ready, shared_dir, written

WIDTH, SIZES = 100, (40, 64, 100)
BLOCK = 8 << 20
#: Different segments of an anchor beyond which it is anchored again; blocks whose messages meet in one task.
CROWD, FAN = 2000, 4096
SEND, AGAIN = 1, 2
#: Kinds of messages: windows that go, bytes for a bucket, entries for a bucket, segments that wait for the answer to their entries, answers.
GONE, BYTES, ENTRY, KEPT, ANSWER = range(5)
MAIL = "kind int, level int, bucket long, blk long, row binary, start binary, n binary, anchors binary, bytes binary"
MAIL_SCHEMA = pa.schema([("kind", pa.int32()), ("level", pa.int32()), ("bucket", pa.int64()), ("blk", pa.int64()), *((c, pa.binary()) for c in ("row", "start", "n", "anchors", "bytes"))])


def mail(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(MAIL_SCHEMA), MAIL_SCHEMA.types)], schema=MAIL_SCHEMA)


def _arrays(t: pa.Table, column: str, dtype) -> list[np.ndarray]:
    return [np.zeros(0, dtype) if not x.is_valid else np.frombuffer(x.as_buffer(), dtype) for x in t.column(column)]


def _one(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _runs(values: np.ndarray):
    """(value, from, to) of runs of equal values."""
    cuts = np.nonzero(values[1:] != values[:-1])[0] + 1
    edges = [0, *cuts.tolist(), len(values)] if len(values) else []
    return ((int(values[a]), a, b) for a, b in zip(edges, edges[1:]))


def _heads(*columns: np.ndarray) -> np.ndarray:
    """True where a row of the columns is not as the row before."""
    head = np.ones(len(columns[0]), bool)
    if len(head):
        head[1:] = False
        for c in columns:
            head[1:] |= c[1:] != c[:-1]
    return head


def _buckets(anchor: np.ndarray, n: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def unlike(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """Which of the strings raw[a : a + size] differ from raw[b : b + size]."""
    out, x = np.zeros(len(a), bool), 0
    ends = np.cumsum(size)
    while x < len(a):
        y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + most, side="right")))
        n = size[x:y]
        first = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(first, n)
        out[x:y] = np.logical_or.reduceat(raw[np.repeat(a[x:y], n) + step] != raw[np.repeat(b[x:y], n) + step], first)
        x = y
    return out


class Block:
    """The documents of a block in order, and the segments of its windows."""

    def __init__(self, table: pa.Table, width: int = WIDTH):
        from xxhash import xxh64_intdigest

        kept("repeats")
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        tie = np.array([42 if t is None else xxh64_intdigest(r, 42) for t, r in zip(texts, raw)], np.uint64).view(np.int64).tolist()  # as in _blocks
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, tie[i], raw[i]))
        self.ids, self.texts, self.width = [ids[i] for i in self.order], [raw[i] for i in self.order], width

    def segments(self, k: int) -> "Segments":
        return Segments(windows.segments(self.texts, self.width, k), self.width, lambda r, a, b: self.texts[r][a:b])


class Segments:
    """Segments of a block, by anchor and hash; equal ones (by their bytes) are one, the first, and the others are in ``copies``."""

    def __init__(self, segs: windows.Segments, width: int, text):
        self.width = width
        order = np.lexsort((segs.start, segs.row, segs.same, segs.anchor))
        segs = segs.take(order)
        head = _heads(segs.anchor, segs.same, segs.n)
        if not head.all():  # hashes say what may be equal
            some = ~head
            some[:-1] |= some[1:]
            at = np.nonzero(some)[0]
            raw, first = _bytes_of(segs.take(at), width, text)
            place = np.zeros(len(head), np.int64)
            place[at] = first
            later = np.nonzero(~head)[0]
            before = np.nonzero(head)[0][np.cumsum(head)[later] - 1]
            head[later[unlike(raw, place[later], place[before], segs.n[later] + width - 1)]] = True
        self.copies, self.segs, self.text = segs.take(~head), segs.take(head), text

    def bytes(self, at) -> np.ndarray:
        return _bytes_of(self.segs.take(at), self.width, self.text)[0]


def _bytes_of(segs: windows.Segments, width: int, text) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the segments one after another, where each begins)."""
    size = segs.n + width - 1
    return np.frombuffer(b"".join([text(r, s, s + n) for r, s, n in zip(segs.row.tolist(), segs.start.tolist(), size.tolist())]), np.uint8), np.cumsum(size) - size


def _gone(number: int, segs: windows.Segments) -> list[tuple]:
    return [(GONE, 0, -1, number, segs.row.astype(np.uint32).tobytes(), segs.start.tobytes(), segs.n.astype(np.uint16).tobytes(), None, None)] if len(segs.n) else []


def _places(segs: windows.Segments):
    return segs.row.astype(np.uint32).tobytes(), segs.start.tobytes(), segs.n.astype(np.uint16).tobytes(), segs.anchor.tobytes()


def _asked(s: Segments, number: int, level: int, buckets: int, crowd: int) -> list[tuple]:
    """Entries of the segments: anchors, 32 bits of hash, and how often (here once); of an anchor at most crowd + 1."""
    anchor, same = s.segs.anchor, s.segs.same
    nth = np.arange(len(anchor)) - np.maximum.accumulate(np.where(_heads(anchor), np.arange(len(anchor)), 0))
    few = nth <= crowd
    anchor, same = anchor[few], (same[few] >> np.uint64(32)).astype(np.uint32)
    return [(ENTRY, level, b, number, None, None, np.ones(y - x, np.uint8).tobytes(), anchor[x:y].tobytes(), same[x:y].tobytes()) for b, x, y in _runs(_buckets(anchor, buckets))]


def _acts(s: Segments, answers: pa.Table) -> np.ndarray:
    """What to do with each segment; an answer is (anchors, acts) for what is not left as it is."""
    act = np.zeros(len(s.segs.n), np.uint8)
    said, what = _one(_arrays(answers, "anchors", np.uint64), np.uint64), _one(_arrays(answers, "n", np.uint8), np.uint8)
    if len(said) and len(act):
        by = np.argsort(said, kind="stable")
        said, what = said[by], what[by]
        i = np.minimum(np.searchsorted(said, s.segs.anchor), len(said) - 1)
        act[said[i] == s.segs.anchor] = what[i][said[i] == s.segs.anchor]
    return act


def _sent(s: Segments, number: int, level: int, answers: pa.Table, buckets: int, sizes, crowd: int) -> list[tuple]:
    """The segments' bytes that buckets ask for, entries of those that are anchored again, and these segments themselves; and copies that go."""
    act, rows = _acts(s, answers), _gone(number, s.copies)
    send = np.nonzero(act == SEND)[0]
    for b, x, y in _runs(_buckets(s.segs.anchor[send], buckets)):
        rows.append((BYTES, level, b, number, *_places(s.segs.take(send[x:y])), s.bytes(send[x:y]).tobytes()))
    again = np.nonzero(act == AGAIN)[0]
    if len(again):
        old = s.segs.take(again[np.lexsort((s.segs.start[again], s.segs.row[again]))])
        parts = [s.text(r, a, a + n + s.width - 1) for r, a, n in zip(old.row.tolist(), old.start.tolist(), old.n.tolist())]
        deeper = Segments(windows.segments(parts, s.width, sizes[level + 1]), s.width, lambda r, a, b: parts[r][a:b])
        home = lambda x: windows.Segments(old.row[x.row], old.start[x.row] + x.start, x.n, x.anchor, x.same)
        rows += _gone(number, home(deeper.copies)) + _asked(deeper, number, level + 1, buckets, crowd)
        rows.append((KEPT, level + 1, -1, number, *_places(home(deeper.segs)), deeper.segs.same.tobytes() + deeper.bytes(slice(None)).tobytes()))
    return rows


def _read(t: pa.Table, width: int):
    """(blk of each string, segments, bytes, where each begins) of rows with bytes."""
    row, start = _arrays(t, "row", np.uint32), _arrays(t, "start", np.int64)
    n, anchor, raw = _arrays(t, "n", np.uint16), _arrays(t, "anchors", np.uint64), _arrays(t, "bytes", np.uint8)
    blk = np.repeat(t.column("blk").to_numpy(), [len(x) for x in row])
    n = _one(n, np.uint16).astype(np.int64)
    segs = windows.Segments(_one(row, np.uint32).astype(np.int64), _one(start, np.int64), n, _one(anchor, np.uint64), np.zeros(len(n), np.uint64))
    return blk, segs, _one(raw, np.uint8), np.cumsum(n + width - 1) - (n + width - 1)


def _waiting(t: pa.Table, width: int) -> Segments:
    """The segments of a KEPT row; their text is what the row holds."""
    _, segs, raw, _ = _read(t.set_column(t.schema.get_field_index("bytes"), "bytes", pa.array([None] * t.num_rows, pa.binary())), width)
    held = t.column("bytes")[0].as_buffer()
    segs.same = np.frombuffer(held, np.uint64, len(segs.n))
    size = segs.n + width - 1
    first = 8 * len(size) + np.cumsum(size) - size
    place = dict(zip(zip(segs.row.tolist(), segs.start.tolist()), first.tolist()))
    view = held.to_pybytes()
    return Segments(segs, width, lambda r, a, b: view[place[r, a] : place[r, a] + b - a])


def _entries(t: pa.Table):
    """(number of the row, anchor, hash, times) of all entries, by anchor and hash."""
    anchors = _arrays(t, "anchors", np.uint64)
    which = np.repeat(np.arange(len(anchors)), [len(a) for a in anchors])
    anchor, same, times = _one(anchors, np.uint64), _one(_arrays(t, "bytes", np.uint32), np.uint32), _one(_arrays(t, "n", np.uint8), np.uint8)
    by = np.lexsort((same, anchor))
    return which[by], anchor[by], same[by], times[by]


def _answers(t: pa.Table, again: bool, crowd: int) -> pa.Table:
    """To each block that sent entries of a bucket and level: (anchors, acts) of those that are not alone."""
    which, anchor, same, times = _entries(t)
    new = _heads(anchor)
    group = np.cumsum(new) - 1
    different = np.bincount(group, _heads(anchor, same))[group]
    act = np.where(np.bincount(group, times)[group] > 1, SEND, 0)
    if again:
        act[different > crowd] = AGAIN
    return _replies(t, which, anchor, act)


def _replies(t: pa.Table, which: np.ndarray, anchor: np.ndarray, act: np.ndarray) -> pa.Table:
    some = np.nonzero(act)[0]
    some = some[np.lexsort((anchor[some], which[some]))]
    some = some[_heads(which[some], anchor[some])]
    level, bucket, blk = t.column("level")[0].as_py(), t.column("bucket")[0].as_py(), t.column("blk")
    return mail([(ANSWER, level, bucket, blk[k].as_py(), None, None, act[some[x:y]].astype(np.uint8).tobytes(), anchor[some[x:y]].tobytes(), None) for k, x, y in _runs(which[some])])


def _merged_entries(t: pa.Table, fan: int, crowd: int) -> pa.Table:
    """The entries of up to fan blocks as if of one: equal ones once with how often (at most 2), of an anchor at most crowd + 1."""
    _, anchor, same, times = _entries(t)
    new = _heads(anchor, same)
    at = np.nonzero(new)[0]
    often = np.minimum(np.add.reduceat(times.astype(np.int64), at), 2).astype(np.uint8)
    anchor, same = anchor[at], same[at]
    few = np.arange(len(at)) - np.maximum.accumulate(np.where(_heads(anchor), np.arange(len(at)), 0)) <= crowd
    return mail([(ENTRY, t.column("level")[0].as_py(), t.column("bucket")[0].as_py(), t.column("blk")[0].as_py() // fan, None, None, often[few].tobytes(), anchor[few].tobytes(), same[few].tobytes())])


def _passed_on(t: pa.Table, above: pa.Table) -> pa.Table:
    """The answers to merged entries as answers to those that were merged."""
    if not t.num_rows or not above.num_rows:
        return mail([])
    which, anchor, _, _ = _entries(t)
    said, what = _one(_arrays(above, "anchors", np.uint64), np.uint64), _one(_arrays(above, "n", np.uint8), np.uint8)
    i = np.minimum(np.searchsorted(said, anchor), len(said) - 1)
    return _replies(t, which, anchor, np.where(said[i] == anchor, what[i], 0))


def later_windows(strings: np.ndarray, lens: np.ndarray, width: int, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of windows that are equal to a window of an earlier string, or of an earlier start in the same one."""
    c = Collection(strings, lens, folder)
    string, start, kind = c.classes(width)
    c.close()
    by = np.lexsort((start, string, kind))
    later = ~_heads(kind[by])
    return string[by][later], start[by][later]


def _hashes(raw: np.ndarray, first: np.ndarray, size: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """A hash of each of the strings raw[first : first + size] (of 8 bytes or more; first rises)."""
    out, x, ends = np.zeros(len(first), np.uint64), 0, first + size
    while x < len(first):
        y = max(x + 1, int(np.searchsorted(ends, first[x] + most, side="right")))
        n = size[x:y] - 7
        begin = np.cumsum(n) - n
        step = np.arange(int(n.sum())) - np.repeat(begin, n)
        h = windows.grams(raw[first[x] : ends[y - 1]], 8)[np.repeat(first[x:y] - first[x], n) + step]
        out[x:y] = np.add.reduceat(h * (step.astype(np.uint64) * np.uint64(2) + np.uint64(1)), begin)
        x = y
    return out


def _by_bytes(raw, first, size, place, *major):
    """(order of the strings by the columns major, hash and place; which of them are the first of their bytes there)."""
    mixed = _hashes(raw, first, size)
    order = np.lexsort((place, size, mixed, *major))
    head = _heads(mixed[order], size[order], *(c[order] for c in major))
    later = np.nonzero(~head)[0]
    before = np.nonzero(head)[0][np.cumsum(head)[later] - 1]
    head[later[unlike(raw, first[order[later]], first[order[before]], size[order[later]])]] = True
    return order, head


def _equal_first(blk, segs: windows.Segments, raw, first, width: int):
    """(order of the strings by anchor, hash and place; which of them are the first of their bytes)."""
    place = np.empty(len(blk), np.int64)
    place[np.lexsort((segs.start, segs.row, blk))] = np.arange(len(blk))
    return _by_bytes(raw, first, segs.n + width - 1, place, segs.anchor)


def _recurring(hashes, begin, n):
    """(strings, first and last offset) of windows of which another has the same hash; n: windows of the string that begins there."""
    string = np.repeat(np.arange(len(begin)), n)
    off = np.arange(len(string)) - np.repeat(np.cumsum(n) - n, n)
    h = hashes[begin[string] + off]
    by = np.argsort(h, kind="stable")
    twice = ~_heads(h[by])
    twice[:-1] |= twice[1:]
    at = np.sort(by[twice])
    here = np.nonzero(_heads(string[at]))[0]
    return string[at[here]], off[at[here]], off[at[np.append(here[1:], len(at)) - 1]] if len(at) else off[:0]


def _went(blk, row, start, n) -> list[tuple]:
    """GONE rows of runs of windows, by block."""
    order = np.lexsort((start, row, blk))
    blk, row, start, n = blk[order], row[order], start[order], n[order]
    return [(GONE, 0, -1, k, row[x:y].astype(np.uint32).tobytes(), start[x:y].tobytes(), n[x:y].astype(np.uint16).tobytes(), None, None) for k, x, y in _runs(blk)]


def _collapsed(t: pa.Table, width: int) -> pa.Table:
    """Of equal segments of some blocks the first remains to be judged, the others go."""
    blk, segs, raw, first = _read(t, width)
    order, head = _equal_first(blk, segs, raw, first, width)
    gone, stay = order[~head], np.sort(order[head])
    rows = _went(blk[gone], segs.row[gone], segs.start[gone], segs.n[gone])
    level, bucket = t.column("level")[0].as_py(), t.column("bucket")[0].as_py()
    stay = stay[np.lexsort((segs.start[stay], segs.row[stay], segs.anchor[stay], blk[stay]))]
    for k, x, y in _runs(blk[stay]):
        some = stay[x:y]
        rows.append((BYTES, level, bucket, k, *_places(segs.take(some)), b"".join([raw[f : f + s].tobytes() for f, s in zip(first[some].tolist(), (segs.n[some] + width - 1).tolist())])))
    return mail(rows)


def _judged(t: pa.Table, width: int, folder: str) -> pa.Table:
    """Windows that go, by block, of a bucket's segments."""
    blk, segs, raw, first = _read(t, width)
    order, head = _equal_first(blk, segs, raw, first, width)
    gone = order[~head]
    rows = _went(blk[gone], segs.row[gone], segs.start[gone], segs.n[gone])
    # anchors with different segments
    firsts = order[head]
    group = np.cumsum(_heads(segs.anchor[firsts])) - 1
    some = firsts[np.bincount(group)[group] > 1] if len(group) else firsts
    some = some[np.lexsort((segs.start[some], segs.row[some], blk[some]))]  # strings in document order
    size = segs.n[some] + width - 1
    if not len(some):
        return mail(rows)
    at = np.repeat(first[some] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    flat = raw[at]
    # strings are cut down to what lies between their first and last window that has an equal hash elsewhere; what is then equal
    # by its bytes goes but for the first, until nothing changes
    home, low, begin = some, np.zeros(len(some), np.int64), np.cumsum(size) - size
    hashes = np.concatenate([windows.grams(flat[x : x + windows.PIECE + width - 1], width) for x in range(0, len(flat) - width + 1, windows.PIECE)])
    while True:
        some, first_at, last_at = _recurring(hashes, begin, size - width + 1)
        same = len(some) == len(size) and not first_at.any() and bool((last_at == size - width).all())
        home, low, begin, size = home[some], low[some] + first_at, begin[some] + first_at, last_at - first_at + width
        if not len(home):
            return mail(rows)
        order, head = _by_bytes(flat, begin, size, np.arange(len(home)))
        gone, stay = order[~head], np.sort(order[head])
        if len(gone):
            rows += _went(blk[home[gone]], segs.row[home[gone]], segs.start[home[gone]] + low[gone], size[gone] - width + 1)
            home, low, begin, size = home[stay], low[stay], begin[stay], size[stay]
        elif same:
            break
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    which, start = later_windows(flat[at], size, width, folder)
    own = home[which]
    b, r, s = blk[own], segs.row[own], segs.start[own] + low[which] + start
    by = np.lexsort((s, r, b))
    b, r, s = b[by], r[by], s[by]
    head = np.ones(len(b), bool)  # runs of consecutive windows
    head[1:] = (b[1:] != b[:-1]) | (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)
    at = np.nonzero(head)[0]
    return mail(rows + _went(b[at], r[at], s[at], np.diff(np.append(at, len(b)))))


def _cut(block: Block, gone: pa.Table):
    """Per document: (removed bytes, spans as (start, end), kept bytes)."""
    take = lambda name, t: np.concatenate([np.zeros(0, t), *(np.frombuffer(x.as_buffer(), t) for x in gone.column(name))])
    row, start, n = take("row", np.uint32).astype(np.int64), take("start", np.int64), take("n", np.uint16).astype(np.int64)
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], start[order] + n[order] + block.width - 1
    edge = np.searchsorted(row, np.arange(len(block.texts) + 1)).tolist()
    for i, text in enumerate(block.texts):
        x, y = edge[i], edge[i + 1]
        if x == y:
            yield 0, [], text
            continue
        s, e = start[x:y], np.maximum.accumulate(end[x:y])
        head = np.ones(len(s), bool)
        head[1:] = s[1:] > e[:-1]
        s, e = s[head].tolist(), e[np.append(np.nonzero(head)[0][1:] - 1, len(e) - 1)].tolist()
        kept, last = [], 0
        for a, b in zip(s, e):
            kept.append(text[last:a])
            last = b
        kept.append(text[last:])
        yield sum(e) - sum(s), list(zip(s, e)), b"".join(kept)


def _blocks(docs: DataFrame, columns: list[str], blk: str, size: int) -> tuple[str, int]:
    """Name of a table of docs with blk, bucketed by it; and the number of blocks."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0]["n"] or 0
    n = max(1, int(total // size) + 1)
    name = f"tokenmix_blocks_{uuid.uuid4().hex}"
    placed = docs.select(*columns).repartitionByRange(n, F.col("doc_id"), F.xxhash64("text")).withColumn(blk, F.spark_partition_id().cast("long"))
    buckets = max(1, min(n, -(-int(total) // (4 * size)) + spark.sparkContext.defaultParallelism))
    placed.write.option("compression", "zstd").bucketBy(buckets, blk).saveAsTable(name)
    return name, n


def _decided(entries: DataFrame, n: int, again: bool, crowd: int, fan: int) -> DataFrame:
    """Answers to the entries of n blocks: in one task per bucket if there are few, else by way of merged entries."""
    if n <= fan:
        return entries.groupBy("level", "bucket").applyInArrow(lambda t: _answers(t, again, crowd), MAIL)
    wide = lambda df, name: df.withColumn(name, F.floor(F.col("blk") / fan).cast("long"))
    merged = written(wide(entries, "part").groupBy("level", "bucket", "part").applyInArrow(lambda t: _merged_entries(t, fan, crowd), MAIL), "merged")
    above = _decided(merged, -(-n // fan), again, crowd, fan)
    below = wide(entries, "part").groupBy("level", "bucket", "part")
    return below.cogroup(above.withColumn("part", F.col("blk")).groupBy("level", "bucket", "part")).applyInArrow(_passed_on, MAIL)


def run(docs: DataFrame, shape, columns: list[str], make, width: int = WIDTH, sizes=SIZES, block: int = BLOCK, crowd: int = CROWD, fan: int = FAN) -> DataFrame:
    """The frame that make(Block, cuts, table) gives for each block, written in the shared folder (all else is deleted); cuts as from ``_cut``."""
    spark = ready(docs.sparkSession)
    blk = free_name(columns, "block")
    name, n = _blocks(docs, columns, blk, block)
    table, tapes = spark.table(name), shared_dir(spark, "tapes")
    buckets, boxes = max(64, 4 * n), []  # many small ones, so that partitions of them are even
    needed = table.select(blk, "doc_id", "text")
    # closures below go to the executors: they hold plain values only
    first = lambda key, t: mail(_asked(Block(t, width).segments(sizes[0]), key[0].as_py(), 0, buckets, crowd))
    entries = asking = written(needed.groupBy(blk).applyInArrow(first, MAIL), "entries")
    for level in range(len(sizes)):
        answers = _decided(entries, n, level + 1 < len(sizes), crowd, fan)
        if level == 0:

            def reply(key, docs, answers):
                return mail(_sent(Block(docs, width).segments(sizes[0]), key[0].as_py(), 0, answers, buckets, sizes, crowd) if docs.num_rows else [])

            got = needed.groupBy(blk).cogroup(answers.groupBy("blk")).applyInArrow(reply, MAIL)
        else:
            held = boxes[-1].where(F.col("kind") == KEPT)

            def reply_again(key, t):
                is_kept = pa.compute.equal(t.column("kind"), KEPT)
                waiting = t.filter(is_kept)
                return mail(_sent(_waiting(waiting, width), key[0].as_py(), level, t.filter(pa.compute.invert(is_kept)), buckets, sizes, crowd) if waiting.num_rows else [])

            got = held.unionByName(answers).groupBy("blk").applyInArrow(reply_again, MAIL)
        boxes.append(written(got, f"segments{level}", "zstd"))
        if level == 0:
            dropped(asking)  # answered
        entries = boxes[-1].where(F.col("kind") == ENTRY)
        if level + 1 < len(sizes) and entries.isEmpty():
            break
    union = lambda kind: _union([b.where(F.col("kind") == kind) for b in boxes])
    asked, gone, step = union(BYTES), [union(GONE)], fan
    while step < n:
        part = F.floor(F.col("blk") / step).cast("long").alias("part")
        boxes_now = written(asked.groupBy("level", "bucket", part).applyInArrow(lambda t: _collapsed(t, width), MAIL), "collapsed", "zstd")
        boxes.append(boxes_now)
        asked, step = boxes_now.where(F.col("kind") == BYTES), step * fan
        gone.append(boxes_now.where(F.col("kind") == GONE))
    gone.append(asked.groupBy("level", "bucket").applyInArrow(lambda t: _judged(t, width, tapes), MAIL))
    gone = written(_union(gone).select("blk", "row", "start", "n"), "gone")
    for b in boxes:
        dropped(b)
    deleted(spark, tapes)

    def finish(key, docs, gone):
        if not docs.num_rows:
            return make(None, [], docs)
        b = Block(docs, width)
        return make(b, _cut(b, gone), docs)

    out = written(table.groupBy(blk).cogroup(gone.groupBy("blk")).applyInArrow(finish, shape), "repeats")
    dropped(gone)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


SHAPE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def measures(docs: DataFrame, **options) -> DataFrame:
    """``SHAPE`` of every document."""

    def make(block, cuts, _):
        rows = [] if block is None else [(i, len(t), removed, len(spans), hashlib.sha256(kept).hexdigest()) for i, t, (removed, spans, kept) in zip(block.ids, block.texts, cuts)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run(docs, SHAPE, ["doc_id", "text"], make, **options)


def _whole(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """text without the characters that lie wholly in a span."""
    out, last = [], 0
    for a, b in spans:
        while a < b and text[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        out.append(text[last:a])
        last = b
    return b"".join([*out, text[last:]])


def cut_texts(docs: DataFrame, **options) -> DataFrame:
    """docs with its columns: repeated passages are cut out of text (whole characters only), n_chars (if there) follows; documents that lose all their text go."""
    columns = docs.columns
    shape = docs.schema

    def make(block, cuts, t):
        if block is None:
            return t.select(columns)
        texts = [_whole(raw, spans) for raw, (_, spans, _) in zip(block.texts, cuts)]
        t = t.select(columns).take(pa.array(block.order, pa.int64()))
        was = t.column("text").to_pylist()
        new = [None if w is None else x.decode("utf-8", "surrogatepass") for w, x in zip(was, texts)]
        keep = [bool(x) or not w for w, x in zip(was, new)]
        changed = [x != w for w, x in zip(was, new)]
        t = t.set_column(columns.index("text"), "text", pa.array(new, t.schema.field("text").type))
        if "n_chars" in columns:
            n = [len(x) if c else k for x, c, k in zip(new, changed, t.column("n_chars").to_pylist())]
            t = t.set_column(columns.index("n_chars"), "n_chars", pa.array(n, t.schema.field("n_chars").type))
        return t.filter(pa.array(keep, pa.bool_()))

    return run(docs, shape, columns, make, **options)
